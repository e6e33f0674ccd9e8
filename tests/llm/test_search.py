import math

import numpy as np
import pytest

from faresight.llm import search


def brute(vectors, queries, k):
    out = []
    for q, qv in queries:
        best = {}
        for i, v in vectors:
            if i != q:
                n = min(len(v), len(qv))
                score = sum(a * b for a, b in zip(qv[:n], v[:n]))
                best[i] = max(best.get(i, score), score)
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


@pytest.mark.parametrize("share,largest", [(1.0, 60), (0.1, 3), (0.5, 1 << 25)])
def test_equals_brute_force(spark, share, largest):
    rng = np.random.default_rng(int(share * 10))
    values = rng.integers(-largest, largest + 1, (120, 12)) * (rng.random((120, 12)) < share)
    values[50:60] = values[49]
    rows = [(int(i), [int(x) for x in v]) for i, v in zip(rng.permutation(120), values)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = search.search(df.filter("vec_id % 7 = 0"), df, 5, shard_rows=37, block=6).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, [r for r in rows if r[0] % 7 == 0], 5)


def test_odd_vectors(spark):
    rows = [(0, [0.5, -0.001, 1.0]), (0, [0.5, -0.001, 1.0]), (50, [0.25]), (1, []), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [math.inf]), (None, [1.0]), (6, [-1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    vectors = search.integer_vectors(df)
    usable = [(0, [128, -1, 256]), (50, [64]), (1, []), (6, [-256, 512])]
    assert sorted((r.vec_id, r.v) for r in vectors.collect()) == sorted(usable)
    got = search.search(vectors.filter("vec_id % 50 = 0"), vectors).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(usable, usable[:2], 5)
    assert search.search(vectors.limit(0), vectors).count() == 0 and search.search(vectors, vectors.limit(0)).count() == 0


def test_vectors_of_one_id(spark):
    rows = [(1, [3, 0]), (1, [0, 5]), (2, [1, 1]), (3, [9, 0]), (4, [0, 4])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = search.search(df.filter("vec_id = 2"), df, 2).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 3, 9), (2, 1, 5)]
    got = search.search(df.filter("vec_id = 1"), df, 2).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 3, 27), (2, 4, 20)]


def test_parts_meet_once_and_copies_are_few(spark):
    """Each shard and block meet in one of the rounds; a row is copied once for each part of the other side."""
    df = spark.range(200).selectExpr("id AS vec_id", "array(id, 1L) AS v")
    queries, cells = df.filter("vec_id % 4 = 0"), []
    copies = [0, 0]
    for first in (True, False):
        left, right = (x.collect() for x in search.dealt(queries, df, 7, 4, first))
        copies[0] += len(left)
        copies[1] += len(right)
        met = {(r.shard, r.block) for r in left}
        assert met == {(r.shard, r.block) for r in right} and len(met) == (4 if first else 24)
        cells += met
    assert len(cells) == len(set(cells)) == 28 and copies == [50 * 7, 200 * 4]
    assert (search.parts(10 ** 9, 64), search.parts(2 * 10 ** 7, 64), search.parts(0, 0), search.parts(5, 1 << 30), search.parts(10, 3, 4)) == (30_518, 611, 1, 5, 3)


def test_threshold_of_the_first_shard_holds_back_the_rest():
    rng = np.random.default_rng(1)
    values = rng.integers(-50, 50, (300, 16))
    shard, own = search.Shard(np.arange(300), values), rng.integers(-50, 50, (1, 16))
    scores = values @ own[0]
    for least in (-np.inf, np.sort(scores)[-3], scores.max(), scores.max() + 1):
        ((ids, found),) = shard.best(np.array([-1]), own, np.array([least], float), 5)
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s >= least)[:5]
        assert [(-s, i) for i, s in zip(ids.tolist(), found.tolist())] == want


def test_many_vectors_of_one_id(spark):
    """A third of all rows have one id: they are dealt to all shards and take one place."""
    rng = np.random.default_rng(2)
    rows = [(int(i) if i % 3 else 50, [int(x) for x in rng.integers(-9, 10, 4)]) for i in range(1, 240)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").distinct()
    rows = [(r.vec_id, r.v) for r in df.collect()]
    got = search.search(df.filter("vec_id % 50 = 0"), df, 5, shard_rows=20, block=5).collect()
    want = {}
    for q, v in [r for r in rows if r[0] % 50 == 0]:
        for i, x in rows:
            if i != q:
                score = sum(a * b for a, b in zip(v, x))
                want.setdefault(q, {})[i] = max(want.get(q, {}).get(i, score), score)
    want = [(q, n + 1, i, s) for q, found in want.items() for n, (i, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:5])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)
