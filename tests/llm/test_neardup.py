import random
import re

import numpy as np

from faresight.llm import neardup
from faresight.llm.components import components

WORDS = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, words, percent=80):
    """Component and set size of each row index, by all pairs."""
    sets = []
    for _, text in rows:
        w = WORDS.findall(lower(text or ""))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = (min(ids) if ids else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def corpus(seed=1, n=260):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "of", "é"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 6, 12, 40, 120]))) for _ in range(n // 3)]
    while len(texts) < n:                                  # copies, edits of copies, and edits of edits: chains
        w = rnd.choice(texts).split(" ")
        for _ in range(rnd.choice([0, 1, 1, 2, 4, 8])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        texts.append(" ".join(w) if rnd.random() < 0.8 else " \n".join(w).upper())
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def run(spark, rows, words):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, node int")
    got = neardup.near_duplicates(df, words).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr)


def test_equals_all_pairs(spark):
    rows = corpus()
    assert run(spark, rows, 2) == brute(rows, 2)


def test_five_words_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = corpus(2, 150)
    assert run(spark, rows, 5) == brute(rows, 5)


def test_near_copies_of_near_copies(spark, monkeypatch):
    rnd, rows = random.Random(6), []
    vocabulary = [f"v{i}" for i in range(5000)]
    for _ in range(40):
        base = [rnd.choice(vocabulary) for _ in range(100)]
        for share in (0.12, 0.01, 0.12, 0.01):
            rows.append((len(rows), " ".join(base)))
            base = [rnd.choice(vocabulary) if rnd.random() < share else w for w in base]
    monkeypatch.setattr(neardup, "BLOCK", 2)
    assert run(spark, rows, 2) == brute(rows, 2)


def test_links_within_a_family(spark, monkeypatch):
    """What a hub's links leave apart is found by comparing the family's other nodes with all of it."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = np.random.default_rng(8)
    base = np.arange(100)
    sets = {n: np.unique(np.where(rng.random(100) < rng.choice([0.02, 0.2]), rng.integers(1000, 9000, 100), base)) for n in range(1, 25)}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    known = components(spark.createDataFrame([x for x in sorted(links)[:4]], "a long, b long"))
    families = spark.createDataFrame([(n, 1) for n in sets], "node long, root long")
    frame = spark.createDataFrame([(n, [int(x) for x in s]) for n, s in sets.items()], "node long, shingles array<long>")
    root = {r.node: r.root for r in known.collect()}
    got = {(r.a, r.b) for r in neardup.family_links(families, known, frame, 80).collect()}
    core = max({root.get(n, n) for n in sets}, key=lambda r: (sum(root.get(n, n) == r for n in sets), r))
    want = {tuple(sorted((root.get(i, i), root.get(j, j)))) for i, j in links if root.get(i, i) != root.get(j, j)}
    assert got == want and any(core not in pair for pair in want)


def test_links_between_families(spark):
    """A list whose hub is like none of its nodes: the nodes' pairs are still counted."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 62, 50)
    tokens = {1: common, 2: common, 3: np.concatenate([common[:8], rng.integers(0, 1 << 62, 42)])}
    nodes = spark.createDataFrame([(n, 50, [int(x) for x in t[:48]]) for n, t in tokens.items()], "node long, n_shingles long, tokens array<long>")
    posted = spark.createDataFrame([(n, int(t), 1) for n in (1, 2, 3) for t in common[:8]], "node long, token long, weight long")
    families = spark.createDataFrame([], "node long, root long")
    got = neardup.crossing_pairs(posted, families, nodes, 20, 80).collect()
    assert [(r.a, r.b, r.na, r.nb) for r in got] == [(1, 2, 50, 50)]


def test_long_lists_of_several_families(spark, monkeypatch):
    """Every pair of two families of a list meets in a call; where one family has most of the list, its own pairs don't, and copies stay few."""
    monkeypatch.setattr(neardup, "BLOCK", 10)
    lists = {1: [1] * 200 + [2, 2, 3, 4], 2: [5] * 6 + [6] * 4, 3: list(range(7, 37)), 4: [8] * 25, 5: [1] * 15 + [2] * 15}
    rows = [(t, 1000 * t + k, root) for t, roots in lists.items() for k, root in enumerate(roots)]
    dealt = neardup.dealt_lists(spark.createDataFrame(rows, "token long, node long, root long")).collect()
    root, met = {n: r for _, n, r in rows}, set()
    for call in {(r.token, r.i, r.j) for r in dealt}:
        own = [r for r in dealt if (r.token, r.i, r.j) == call]
        for x in own:
            for y in own:
                if x.side != neardup.ANY and x.node != y.node and root[x.node] != root[y.node] and (x.side != neardup.OUTER or y.side == neardup.ANY):
                    met.add((min(x.node, y.node), max(x.node, y.node)))
    assert met == {(a, b) for t, a, r in rows for u, b, q in rows if t == u and a < b and r != q}
    copies = {t: sum(r.token == t for r in dealt) for t in lists}
    assert copies == {1: 204 + 4 * 21, 2: 10, 3: 30 * 3, 4: 0, 5: 30 * 2 + 15 * 3} and all(r.side != neardup.OUTER or r.root != 1 for r in dealt if r.token == 1)


def test_linked_counts_all_pairs():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 12, rng.integers(1, 12)).astype(np.uint64)) for _ in range(60)]
    want = [(i, j) for j in range(60) for i in range(30) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert sorted(neardup.linked(sets[:30], sets, 80)) == sorted(want)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (None, "one"), (6, "a b"), (6, "a b"), (7, "x " * 30_000), (None, "lone text here"), (8, "a  b")]
    got = run(spark, rows, 2)
    want = [(d, n, c, k if d is not None or c is not None else True) for d, n, c, k in brute(rows, 2)]
    assert got == sorted(want, key=repr)
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_threshold_keeps_links():
    t = neardup.match_threshold(80)
    rng = np.random.default_rng(0)
    seen = []
    for _ in range(400):
        n = int(rng.integers(20, 400))
        common, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (8 * n, n, n))
        x, y = (neardup.signature(np.concatenate([common, z])) for z in (a, b))
        seen.append(int((x == y).sum()))
    assert min(seen) >= t and abs(np.mean(seen) / neardup.COORDINATES - 0.64) < 0.02


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 103), (103, 101), (7, 7), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
