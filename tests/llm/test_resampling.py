"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from faresight.llm import resampling


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def crcs(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    s, t = (Counter(c % 10000 for _, text in rows for c in crcs(text)) for rows in (docs, target))
    more_s, more_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log(((t[b] + 1) * more_s) / ((s[b] + 1) * more_t))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        own = crcs(text)
        weight = sum(gain[c % 10000] for c in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    able = sorted((i for i, r in enumerate(rows) if r[4] >= 20), key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0]))
    ranks = {i: k + 1 for k, i in enumerate(able[:5 * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(i)) for i, r in enumerate(rows)), key=repr)


def run(spark, docs, target, **more):
    documents = spark.createDataFrame([(*d, 1.5, "x") for d in docs], "doc_id long, text string, weight double, row string").repartition(5)
    items = spark.createDataFrame(target, "item_id long, text string")
    return sorted((tuple(r) for r in resampling.resample(documents, items, **more).collect()), key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdeÉé日9" for b in ("", "x", "LONG" * 5, "é" * 40, "Q" * 64)] + ["z" * 63, "z" * 64, "z" * 65, "y" * 700]
    text = lambda k, v: "".join(rng.choice(v) + rng.choice([" ", "--", ".\n", "\t"]) for _ in range(k))
    docs = [(k, text(rng.choice([0, 1, 2, 19, 20, 21, 90]), vocabulary)) for k in range(n)]
    docs += [(7, docs[7][1]), (None, text(40, vocabulary)), (None, None), (9000, None), (9001, ""), (9002, " ,. "), (9003, text(20000, vocabulary)), (9004, "w" * 200_000)]
    return docs, [(k, text(30, vocabulary[:9])) for k in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    docs, target = corpus(seed)
    assert run(spark, docs, target) == brute(docs, target)


def test_runs_of_words_keep_to_their_text():
    texts = ["a b", None, "", "c", "d " + "e" * 80 + " f", ""]
    n, runs = resampling.features(texts)
    got = Counter((int(o), int(c)) for own, crc in runs for o, c in zip(own, crc))
    assert n.tolist() == [2, 0, 0, 1, 3, 0] and got == Counter((i, c) for i, t in enumerate(texts) for c in crcs(t))
    assert [len(x) for x in (resampling.features([])[0], resampling.features([""])[0])] == [0, 1]


def test_sorted_in_many_parts(spark, monkeypatch):
    """Ties by score across parts of the sort, repeated rows and rows without an id."""
    monkeypatch.setattr(resampling, "SORT_ROWS", 7)
    scored = [(i, None if i % 11 == 0 else i // 3, 30, i % 5) for i in range(300)]
    from faresight.llm.components import stored
    rows = stored(spark.createDataFrame(scored, "row long, doc_id long, n_words long, score long"), "test")
    got = {r["row"]: r["rank"] for r in resampling.drawn(rows, percent=50).collect()}
    order = sorted(scored, key=lambda r: (-r[3], r[1] is None, r[1], r[0]))
    assert got == {r[0]: k + 1 for k, r in enumerate(order[:150])}


def test_empty_tables(spark):
    docs, target = corpus(3, 60)
    assert run(spark, [], target) == []
    assert run(spark, docs, []) == brute(docs, [])
    few = [(1, "a " * 25), (2, "b")]
    assert run(spark, few, target) == brute(few, target)                  # a twentieth of one document is none


def test_gains_follow_the_target():
    source, target = np.array([10, 0, 5]), np.array([0, 10, 5])
    g = resampling.gains(source, target)
    assert g[0] < 0 < g[1] and g[2] == 0
