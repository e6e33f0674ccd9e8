"""Exact top-k search by integer inner product with MaxScore.

Components are the terms and a term's postings are the vectors that hold it (a column, where most do).
In a shard the largest product that a term can add bounds it, and what is left of a query's and the
longest vector's norm bounds any set of terms together. A query's terms are taken in order of their bound.
The last ones, which together stay below the k-th best score known, are non-essential: the essential
postings are traversed, which gives candidates with partial scores, and the others are probed block by
block for those candidates whose partial score and the bound still to come can reach the threshold.

Rows are dealt to shards by hash, and queries to blocks of the same size; each shard meets each block once, so that a
row of either side is copied once for each part of the other. A block first meets one shard. The k-th best found
there goes with each query to all other shards as its threshold: these return only what is as good or better. The shards'
best are merged under a limit for each query before the last ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.components import stored

TOP, QUERY_EVERY, SCALE = 5, 50, 256
PART = 1 << 21                                # components of a shard, and of a block of queries: 16 MB
SEEDS, PROBES, TOGETHER = 64, 8, 64           # vectors scored for a first threshold; terms probed, and queries traversed, at once
RESULT = "query_id long, vec_id long, score long"


def padded(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Shard:
    """Postings of one shard, in order of vec_id; ``rows`` holds the same components by vector, for probing."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], np.ascontiguousarray(values[order])
        self.size, self.width = self.rows.shape
        self.largest, self.least = self.rows.max(axis=0, initial=0), self.rows.min(axis=0, initial=0)
        self.norm = float(np.sqrt((self.rows.astype(float) ** 2).sum(axis=1).max(initial=0)))
        held = (self.rows != 0).sum(axis=0)
        self.dense = held * 2 > self.size
        self.postings = [None if self.dense[d] else np.flatnonzero(self.rows[:, d]) for d in range(self.width)]
        self.floats: np.ndarray | None = None

    def best(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the k best (vec_id, score) of at least its score in ``least``, its own id left out; ties go to the smaller id."""
        q = np.zeros((len(queries), self.width), np.int64)
        q[:, :queries.shape[1]] = queries[:, :self.width]
        norms = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        rows = self.rows
        if self.norm * float(norms.max(initial=0)) < 1 << 52 and self.width * max(1, int(np.abs(q).max(initial=0))) * int(np.abs(rows).max(initial=0)) < 1 << 52:
            # All sums are whole numbers that doubles hold exactly, and are faster there.
            self.floats = rows.astype(float) if self.floats is None else self.floats
            rows, q = self.floats, q.astype(float)
        bound = np.maximum(q * self.largest, q * self.least)
        order = np.argsort(-bound, axis=1, kind="stable")
        place = np.argsort(order, axis=1)                                # of each term in its query's order
        none = np.zeros((len(q), 1))
        rest = lambda x: np.hstack([np.cumsum(np.take_along_axis(x, order, 1)[:, ::-1], axis=1)[:, ::-1].astype(float), none])
        # The most that the terms from each place on can add.
        tail = np.minimum(rest(bound), np.sqrt(rest(q.astype(float) ** 2)) * self.norm * (1 + 1e-9))
        leading = rows @ np.where(place < PROBES, q, 0).T
        own = [np.arange(*np.searchsorted(self.ids, (i, i + 1))) for i in query_ids.tolist()]
        threshold = np.array([max(least[i], self._first_threshold(q[i], rows, leading[:, i], own[i], k)) for i in range(len(q))])
        essential = np.minimum(self.width, (tail >= threshold[:, None]).sum(axis=1))    # the terms after these stay below the threshold together
        traversed = np.where(place < essential[:, None], q, 0)
        partials = rows @ np.where(self.dense, traversed, 0).T
        for i in range(len(q)):
            partial, terms = partials[:, i], order[i, :essential[i]]
            seen = np.full(self.size, bool(self.dense[terms].any()) or threshold[i] <= 0)
            for d in terms[~self.dense[terms]]:
                found = self.postings[d]
                partial[found] += q[i, d] * rows[found, d]
                seen[found] = True
            seen[own[i]] = False
            stay = np.flatnonzero(seen & (partial + tail[i, essential[i]] >= threshold[i]))
            yield self._probe(stay, partial[stay], q[i], order[i], int(essential[i]), tail[i], threshold[i], rows, k)

    def _probe(self, stay: np.ndarray, partial: np.ndarray, q: np.ndarray, order: np.ndarray, at: int, tail: np.ndarray, threshold: float,
               rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Add the non-essential terms to the candidates that stay competitive; the k best of them."""
        while at < self.width:
            some = order[at:at + PROBES]
            at += len(some)
            partial = partial + rows[np.ix_(stay, some)] @ q[some]
            competitive = partial + tail[at] >= threshold
            stay, partial = stay[competitive], partial[competitive]
        ids, scores = self._by_id(stay, partial.astype(np.int64))
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        first = np.lexsort((ids, -scores))[:k]
        return ids[first], scores[first]

    def _by_id(self, rows: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``rows`` (in order), each once, and the best score of each."""
        ids = self.ids[rows]
        begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
        return ids[begin], np.maximum.reduceat(scores, begin) if len(ids) else scores

    def _first_threshold(self, q: np.ndarray, rows: np.ndarray, leading: np.ndarray, own: np.ndarray, k: int) -> float:
        """The k-th best id's score among a few vectors that are large in the query's leading terms; below any score while there are fewer than k."""
        n = min(self.size, SEEDS + k)
        seeds = np.setdiff1d(np.argpartition(leading, self.size - n)[self.size - n:], own)
        scores = self._by_id(seeds, rows[seeds] @ q)[1]
        return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def integer_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v: components as floor(scale * x). Rows with a null id, a null vector, or a null or non-finite component are left out; identical rows count once.

    Components are integers of at most 2^26: a larger one stops the job, since sums would lose exactness.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    small = F.forall(x, lambda c: F.abs(c * scale) <= float(1 << 26))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = embeddings.filter(usable & F.col(id_column).isNotNull())
    return rows.select(F.col(id_column).cast("long").alias("vec_id"),
                       F.when(small, whole).otherwise(F.raise_error(F.lit("vector component beyond 2^26")).cast("array<long>")).alias("v")).distinct()


def parts(rows: int, width: int, of: int | None = None) -> int:
    """Into how many shards, or blocks, ``rows`` vectors of ``width`` components are dealt; ``of``: the rows of each, where that is given."""
    return max(1, -(-rows // (of or max(1, PART // max(1, width)))))


def dealt(queries: DataFrame, vectors: DataFrame, shards: int, blocks: int, first: bool) -> tuple[DataFrame, DataFrame]:
    """Both sides with the shard and the block where they meet: in the ``first`` round block b meets shard b modulo shards, then all others."""
    block, shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    home = F.pmod("block", F.lit(shards)) == F.col("shard")
    left = queries.withColumn("block", block)
    left = left.withColumn("shard", F.pmod("block", F.lit(shards))) if first else left.withColumn("shard", each(shards)).filter(~home)
    return left, vectors.withColumn("shard", shard).withColumn("block", each(blocks)).filter(home if first else ~home)


def search(queries: DataFrame, vectors: DataFrame, k: int = TOP, shard_rows: int | None = None, block: int | None = None) -> DataFrame:
    """The k best of ``vectors`` for each of ``queries`` (both vec_id, v): query_id, rank from 1, vec_id, score.

    A query's own id is no answer to it. Vectors of unlike length are padded with zeros. A vec_id with
    several vectors has each of them searched for and found, and is listed once with its best score.
    Fewer than k others give fewer ranks; empty tables an empty result. Shards and blocks have ``shard_rows``
    and ``block`` rows; where these are not given, as many as hold PART components.
    """
    (n, wide), (m, widest) = (x.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first() for x in (vectors, queries))
    shards, blocks = parts(n, max(wide, widest), shard_rows), parts(m, max(wide, widest), block)

    def meet(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(own) and len(others):
            shard = Shard(others["vec_id"].to_numpy(), padded(others["v"]))
            for lo in range(0, len(own), TOGETHER):
                some = own.iloc[lo:lo + TOGETHER]
                least = some["least"].fillna(-np.inf).to_numpy(float)
                for query_id, (ids, scores) in zip(some["vec_id"], shard.best(some["vec_id"].to_numpy(), padded(some["v"]), least, k)):
                    found += zip([query_id] * len(ids), ids, scores)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    def best(queries: DataFrame, first: bool) -> DataFrame:
        left, right = dealt(queries, vectors, shards, blocks, first)
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(meet, RESULT)

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank).filter(F.col("rank") <= k)

    queries = queries.select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"))    # columns apart from those of ``vectors``, which may be the same table
    found = best(queries.withColumn("least", F.lit(None).cast("double")), True)
    if shards > 1:
        found = stored(found, "first-shard")
        least = ranked(found).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
        found = found.union(best(queries.join(least, "vec_id", "left"), False))
    return ranked(found).select("query_id", "rank", "vec_id", "score")


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(vectors.filter(F.col("vec_id") % QUERY_EVERY == 0), vectors)


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
