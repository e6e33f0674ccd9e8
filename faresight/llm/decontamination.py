"""Benchmark decontamination: a prefix-filtered set join of item windows and documents, by DataFrame functions alone.

An item's windows are its runs of ten successive words (all its words, if it has fewer). A window is a set of
shingles, runs of three words with their places. A document holds a window if it holds all its shingles,
so the least overlap is the whole set and its necessary prefix is a single shingle: in the order of rarity, the
window's rarest. Rarity is counted over all documents. A document's shingles are joined with those prefixes only; where one
stands says where its window must begin, so a window that would begin before the text or end beyond it is passed over
(the bounds on position and length); of what is left, the words of the item-sized window of the document are compared one by one.

The document's words are at hand where its shingles are joined, so neither texts nor shingles are shuffled:
only verified windows are. The windows of the benchmark are broadcast in blocks of bounded size, each joined with
all documents; their number grows with the benchmark and not with the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.components import stored

WINDOW, SHINGLE = 10, 3
BLOCK_WORDS = 2_000_000                       # of the windows broadcast together: some tens of MB
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-/:-`{-\x7f]+"               # what parts words, once A-Z are lower-cased


def normal(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, joined by one space. Null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Letters beyond ASCII keep their case. Texts without any take the faster way.
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.trim(F.regexp_replace(low, NO_WORD, " "))


def _words(normalised: Column) -> Column:
    return F.split(normalised, " ")


def _shingle(words: str, place: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.col(words)[place + k] for k in range(size)])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words: every window of every item, an item of fewer words being one. Items without words have none."""
    rows = items.select("item_id", normal(F.col("text")).alias("t")).filter("t <> ''").select("item_id", _words(F.col("t")).alias("all"))
    at = rows.select("item_id", "all", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))).alias("at"))
    return at.select("item_id", F.slice("all", F.col("at"), window).alias("words"))


def _shingles(windows: DataFrame, size: int) -> DataFrame:
    """name, words, place, h of the shingles of ``size`` words of windows; one of fewer words than SHINGLE is one shingle."""
    own = windows.filter(F.size("words") >= SHINGLE if size == SHINGLE else F.size("words") == size)
    return own.select("name", "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("place")).withColumn("h", _shingle("words", F.col("place"), size))


def _placed(documents: DataFrame, size: int) -> DataFrame:
    """row, n_words, all, at, h of every shingle of ``size`` words of documents."""
    rows = documents.filter(F.col("n_words") >= size).select("row", "n_words", _words(F.col("normalised")).alias("all"))
    return rows.select("row", "n_words", "all", F.explode(F.sequence(F.lit(0), (F.col("n_words") - size).cast("int"))).alias("at")) \
               .withColumn("h", _shingle("all", F.col("at"), size))


def occurrences(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """row, begin, size, name of every occurrence of a window (name, words) in documents (row, n_words, normalised: a written table)."""
    found = None
    for size in range(1, SHINGLE + 1):
        own = stored(_shingles(windows, size), "shingles")
        if own.isEmpty():
            continue
        wanted = own.select("h").distinct()
        seen = _placed(documents, size).select("h").join(F.broadcast(wanted), "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        ranked = own.join(seen, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        prefix = ranked.groupBy("name").agg(F.min(F.struct("n", "place", "h", "words")).alias("rarest"))
        # A shingle that no document holds rules its window out without a look at any.
        prefix = stored(prefix.filter("rarest.n > 0").select("name", "rarest.place", "rarest.h", "rarest.words"), "prefix")
        begin = F.col("at") - F.col("place")
        near = _placed(documents, size).join(F.broadcast(prefix), "h").filter((begin >= 0) & (begin + F.size("words") <= F.col("n_words")))
        exact = near.filter(F.slice("all", begin + 1, F.size("words")) == F.col("words")).select("row", begin.alias("begin"), F.size("words").alias("size"), "name")
        found = exact if found is None else found.unionByName(exact)
    return found if found is not None else documents.sparkSession.createDataFrame([], "row long, begin int, size int, name long")


def contaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans (begin, end of hit words) of every document.

    A null text has no words and is hit by nothing; an item without words occurs nowhere. Null and repeated doc_ids and
    repeated rows give a row each. Items of one item_id are one item, and a null item_id is written as the empty text.
    With an empty benchmark nothing is hit; an empty table of documents gives an empty result. Other columns,
    of either table, are ignored.
    """
    t = normal(F.col("text"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("normalised"), F.monotonically_increasing_id().alias("row"))
    n_words = F.when(F.col("normalised") == "", F.lit(0)).otherwise(F.length("normalised") - F.length(F.replace(F.col("normalised"), F.lit(" "), F.lit(""))) + 1)
    docs = stored(docs.withColumn("n_words", n_words.cast("long")), "normalised")
    own = stored(item_windows(items, window).withColumn("name", F.xxhash64("words")), "windows")
    distinct = stored(own.groupBy("name").agg(F.min("words").alias("words")), "windows")
    total = distinct.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    found = None
    for b in range(blocks):
        block = distinct.filter(F.pmod(F.xxhash64("name", F.lit(1)), F.lit(blocks)) == b) if blocks > 1 else distinct
        some = occurrences(docs, block)
        found = some if found is None else found.unionByName(some)
    found = stored(found, "occurrences")
    covered = found.groupBy("row", "begin").agg(F.max("size").alias("size"))
    order = Window.partitionBy("row").orderBy("begin")
    end = F.col("begin") + F.col("size")
    reached = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = covered.select("row", F.greatest("begin", reached).alias("begin"), end.alias("end")).filter("begin < end")
    hits = parts.groupBy("row").agg(F.sum(F.col("end") - F.col("begin")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    names = own.select("name", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    held = found.select("row", "name").distinct().join(names, "name").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = docs.select("row", "doc_id", "n_words").join(hits, "row", "left").join(held, "row", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", items_).cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "spans")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("spans")


ORACLE_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:least(len(w), i + 9)] AS words FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM win),
run AS (SELECT r, i, w[i:i + n - 1] AS words FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes)),
hit AS (SELECT r, i, run.words, item_id FROM run JOIN win ON run.words = win.words),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + len(words))) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS name FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
