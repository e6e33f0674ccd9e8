"""Importance resampling towards a target distribution, over hashed word n-grams.

Documents and target texts are bags of all runs of one to three successive words, hashed into a fixed number of
buckets. What a bucket's share in the target is over its share in the documents is its gain; a document's
weight is the sum of its features' gains, and weight plus seeded Gumbel noise is its score. The highest
scores are a sample without replacement in proportion to exp(weight).

A batch's texts are joined with separators and one regular expression finds the words of all. The offsets of
the documents in the joined text say which word is whose, so runs that cross documents are masked before the
buckets are counted. A run's crc32 is not computed from its text: crc32 is linear, so that of "u v" follows from
those of u and v and the length of v.

Only bucket counts (a fixed number) and the bins of the scores reach the driver. Which scores are drawn is
found by the bins, and only documents in the last bins are sorted, by range.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.components import stored
from faresight.llm.text import slices

BUCKETS, ORDER, SMOOTHING = 10_000, 3, 1
PERCENT, MIN_WORDS, SEED = 5, 20, 42
SCORE_BINS = 4096                             # of all scores, of which the driver gets the counts
SORT_ROWS = 500_000                           # drawn rows sorted in one task
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")    # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of UTF-8 whose A-Z are lower-cased
SEPARATOR = b"\n"
TABLED = 64                                   # longest suffix in bytes whose crc32 shift has a table
_tables: dict[str, np.ndarray] = {}


def _shifts() -> np.ndarray:
    """[n, k, b]: what byte k of a crc32, being b, becomes when n zero bytes follow."""
    if "shifts" not in _tables:
        byte = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
        byte ^= byte[0]                       # crc32 is affine: without its constant it is the linear step
        table = np.zeros((TABLED + 1, 4, 256), np.uint32)
        table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
        for n in range(TABLED):
            table[n + 1] = byte[table[n] & np.uint32(255)] ^ (table[n] >> np.uint32(8))
        _tables["shifts"] = table
    return _tables["shifts"]


def _followed(crc: np.ndarray, length: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """crc32 of texts that have ``crc``, each followed by one of ``length`` bytes that has ``tail``."""
    shifts = _shifts()
    out = tail.copy()
    for k in range(4):
        out ^= shifts[length, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def features(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each text; then for 1 to ``order`` words the index of the text and the crc32 of every run in it."""
    parts = [b"" if t is None else t.encode() for t in texts]
    at = np.zeros(len(parts), np.int64)
    np.cumsum([len(p) + len(SEPARATOR) for p in parts[:-1]], out=at[1:])
    found = list(WORDS.finditer(SEPARATOR.join(parts).lower()))
    n = len(found)
    starts = np.fromiter(map(re.Match.start, found), np.int64, n)
    sizes = np.fromiter(map(re.Match.end, found), np.int64, n) - starts
    own = np.searchsorted(at, starts, "right") - 1

    def runs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        crc = word = np.fromiter(map(zlib.crc32, map(re.Match.group, found)), np.uint32, n)
        yield own, word
        sizes_after = np.minimum(sizes + 1, TABLED)
        space = np.full(n, zlib.crc32(b" "), np.uint32)
        spaced = _followed(space, np.minimum(sizes, TABLED), word)        # of a space and the word
        untabled = np.flatnonzero(sizes >= TABLED)
        for i in untabled.tolist():
            spaced[i] = zlib.crc32(b" " + found[i].group())
        for k in range(1, order):
            if n <= k:
                return
            crc = _followed(crc[:n - k], sizes_after[k:], spaced[k:])
            for i in np.unique((untabled[:, None] - np.arange(1, k + 1)).ravel()).tolist():
                if 0 <= i < n - k:            # a later word is too long for the table
                    crc[i] = zlib.crc32(b" ".join(m.group() for m in found[i:i + k + 1]))
            inside = own[:n - k] == own[k:]
            yield own[:n - k][inside], crc[inside]

    return np.bincount(own, minlength=len(parts)), runs()


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """How many features of all texts fall in each bucket; the driver gets one sum for each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                for _, crc in features(batch.column("text").slice(lo, hi - lo).to_pylist(), order)[1]:
                    held += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["bucket", "n"])

    sums = rows.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"]] = sums["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in target over that in source) of each bucket."""
    more_s, more_t = (float(x.sum() + SMOOTHING * len(x)) for x in (source, target))
    return np.array([math.floor(1000 * math.log((float(t + SMOOTHING) * more_s) / (float(s + SMOOTHING) * more_t)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(documents: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = gain.astype(np.float64)       # sums of whole numbers far below 2^53: exact
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                some = batch.slice(lo, hi - lo)
                words, runs = features(some.column("text").to_pylist(), order)
                number, weight = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
                for own, crc in runs:
                    number += np.bincount(own, minlength=hi - lo)
                    weight += np.bincount(own, value[crc % np.uint32(len(gain))], hi - lo)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in (words, number, weight)]],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 8 hex digits of sha256 of ``seed:doc_id``. A null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """row, rank of the highest ``percent`` of the scores among documents of ``min_words`` or more; ties to smaller doc_id, nulls last, then row.

    scored (row, doc_id, n_words, score) must be a written table. Counts by bin say where the last place lies;
    rows of that bin and above are sorted by range, so that no task holds them all.
    """
    may = scored.filter(F.col("n_words") >= min_words)
    n, least, most = may.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    wanted = percent * n // 100
    if not wanted:
        return scored.sparkSession.createDataFrame([], "row long, rank long")
    width = (most - least) // SCORE_BINS + 1
    bin_ = F.floor((F.col("score") - least) / width)
    sizes = sorted(((r["bin"], r["n"]) for r in may.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    above, last = 0, 0
    for last, size in sizes:
        above += size
        if above >= wanted:
            break
    parts = -(-above // SORT_ROWS)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    dealt = may.filter(bin_ >= last).select("row", "doc_id", "score").repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    placed = stored(dealt.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order))).select("row", "part", "place"), "drawn")
    before, offsets = 0, []
    for part, size in sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets += [F.lit(part), F.lit(before)]
        before += size
    rank = F.col("place") + F.element_at(F.create_map(*offsets), F.col("part"))
    return placed.select("row", rank.cast("long").alias("rank")).filter(F.col("rank") <= wanted)


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn.

    A null text has no words, so no features and weight 0. Rows with a null doc_id draw the noise of the empty
    id and stand behind equal scores with one; repeated rows are drawn one by one, in any order among
    themselves. With no target text every bucket's gain follows from the smoothing alone; an
    empty table of documents gives an empty result. Other columns, of either table, are ignored.
    """
    gain = gains(bucket_counts(documents, buckets, order), bucket_counts(target, buckets, order))
    scored = weights(documents, gain, order).withColumn("score", F.col("weight") + gumbel(seed)).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    return scored.join(drawn(scored, percent, min_words), "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: crc32 bit by bit: each bit of a feature's bytes, low bits first, is shifted into the register.
ORACLE_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
words AS (
  SELECT kind, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT kind, r, array_to_string(w[i:i + n - 1], ' ') AS f
  FROM (SELECT kind, r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (VALUES (1), (2), (3)) sizes(n))),
bits AS (
  SELECT f, CAST(encode(f) AS BIT) AS b FROM (SELECT DISTINCT f FROM runs)),
buckets AS (
  SELECT f, xor(list_reduce(list_transform(range(bit_length(b)), lambda k: CAST(get_bit(b, CAST(k // 8 * 8 + 7 - k % 8 AS INTEGER)) AS BIGINT)),
         lambda c, x: xor(c >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM bits),
counts AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM runs JOIN buckets USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counts),
docs AS (
  SELECT words.r, words.id AS doc_id, len(w) AS n_words, count(f) AS n_features, CAST(coalesce(sum(gain), 0) AS BIGINT) AS weight
  FROM words LEFT JOIN runs ON runs.r = words.r AND runs.kind = 'd' LEFT JOIN buckets USING (f) LEFT JOIN gains USING (bucket)
  WHERE words.kind = 'd' GROUP BY words.r, words.id, len(w)),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM docs),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CAST(CASE WHEN place <= 5 * n // 100 THEN place END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
