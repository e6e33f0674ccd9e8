import hashlib
import random
import re

import numpy as np
import pytest

from faresight.llm import substring

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, window):
    seen = {}
    words = [WORDS.findall(t or "") for _, t in rows]
    for w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if any(gone) else None))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "The", "the"]
    passage = [rnd.choice(vocabulary) for _ in range(50)]
    rows = []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 3, 34, 35, 36, 80, 300]))]
        kind = rnd.random()
        if kind < 0.3:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 15):rnd.randint(34, 50)]
        elif kind < 0.45 and rows:
            w = WORDS.findall(rnd.choice(rows)[1])
            for _ in range(rnd.choice([0, 1, 3])):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        elif kind < 0.5:
            w = w + w
        elif kind < 0.55:
            w = [rnd.choice(["la", "lo"])] * rnd.randint(20, 200)
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, row int").repartition(4)


@pytest.mark.parametrize("seed,window,many", [(1, 35, 2000), (2, 35, 2), (3, 8, 2000), (4, 3, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, window, many):
    monkeypatch.setattr(substring, "MANY_SEGMENTS", many)
    monkeypatch.setattr(substring, "SHARD_WORDS", 900)
    rows = corpus(seed)
    want = brute(rows, window)
    got = substring.repeated_words(frame(spark, rows), window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == [w[:4] for w in want]
    if window == 35 and many == 2:
        texts = dict(rows)
        got = substring.without_repeats(frame(spark, rows), window).collect()
        assert sorted((r.doc_id, r.text, r.row) for r in got) == sorted((w[0], texts[w[0]] if w[4] is None else w[4], 5) for w in want)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a " * 40), (4, "b " * 34), (5, long), (5, long), (6, long + " end"), (None, None)]
    got = substring.repeated_words(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == [w[:4] for w in brute(rows, 35)]
    empty = frame(spark, rows).limit(0)
    assert substring.repeated_words(empty).count() == 0 and substring.without_repeats(empty).count() == 0


def test_index_counts_patterns():
    rng = np.random.default_rng(7)
    lengths = rng.integers(0, 40, 30)
    symbols = rng.integers(1, 5, lengths.sum())
    weights = rng.integers(1, 4, 30)
    index = substring.FMIndex(symbols, lengths, weights)
    parts = np.split(symbols, np.cumsum(lengths)[:-1])
    for _ in range(300):
        pattern = rng.integers(1, 5, rng.integers(1, 6))
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            low, high = index.extend(np.array([c]), low, high)
        count = [sum((p[i:i + len(pattern)] == pattern).all() for i in range(len(p) - len(pattern) + 1)) for p in parts]
        assert high[0] - low[0] == sum(count)
        assert index.weight[high[0]] - index.weight[low[0]] == (np.array(count) * weights).sum()
