"""MinHash near-duplicates by a signature-coordinate inverted join.

Each document's set of word shingles has a signature of COORDINATES values; a coordinate's value is the
pair of its minima under two hash functions, so that at similarity s two documents agree in it with
chance s^2, and unrelated ones almost never. Documents are posted under each coordinate and value. A pair is
retained when it collides in at least ``match_threshold`` coordinates, a number so far below the mean at the
required similarity that a link is missed with chance 1e-7. With the rarest values first, two such
documents share a value among the first (number of values - threshold + 1) of each: only these prefixes are merged, values
that one document has alone are not posted at all, and documents without enough shared values are skipped.

Copies are one node. In each posting list every node is first compared with the list's hub, the node that
shares most values with others. The retained pairs form families; pairs of a list that are in different
families are counted against each other, in blocks, and the full sets of all retained pairs
are compared. Where that leaves a family in several components, those outside the largest one are
compared on full sets with all its nodes, again in blocks: a family of thousands of near copies never becomes a row for each pair.
A shingle is a 64-bit hash and a node the 64-bit hash of its set.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.components import components, fresh, stored
from faresight.llm.text import held_by, mix, slices, take_over, word_hashes, words_of

COORDINATES, MISSED = 48, 1e-7
BLOCK = 1024                                  # nodes of a long posting list, or of a family, that are compared with each other at once
OUTER, ANY = -2, -1                           # sides of a call: a node outside the list's largest family, any node; else the node's block
GROUP_ROWS, GROUP_SETS = 20_000, 4_000        # postings of short lists, or sets of small families, that one call compares
_ODDS = (np.random.default_rng(20_260).integers(0, 1 << 31, 2 * COORDINATES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_STEP = np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_P = np.uint64(0x9DDFEA08EB382D69)


def match_threshold(percent: int) -> int:
    """Most collisions that a pair of that similarity reaches but for the chance ``MISSED``."""
    p, below = (percent / 100) ** 2, 0.0
    for t in range(COORDINATES):
        below += comb(COORDINATES, t) * p ** t * (1 - p) ** (COORDINATES - t)
        if below > MISSED:
            return max(t, 1)
    return COORDINATES


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased; a text of fewer words is one shingle, one of none has none."""
    data, starts, ends, first = words_of(texts, lower=True)
    hashes, counts = word_hashes(data, starts, ends), np.diff(first)
    n = max(0, len(hashes) - words + 1)
    chained = np.full(n, words, np.uint64)
    for k in range(words):
        chained = mix(chained * _P + hashes[k:k + n])
    out = []
    for a, m in zip(first.tolist(), counts.tolist()):
        if m >= words:
            out.append(np.unique(chained[a:a + m - words + 1]))
        else:
            one = np.full(min(m, 1), m, np.uint64)
            for k in range(m):
                one = mix(one * _P + hashes[a + k])
            out.append(one)
    return out


def node_of(shingles: np.ndarray) -> int:
    """The name of a set: a hash of its size and the sum of its mixed members."""
    return int(mix(np.array([mix(shingles ^ _P).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def signature(shingles: np.ndarray) -> np.ndarray:
    """The coordinates' values, each made one number with its coordinate."""
    least = np.full(2 * COORDINATES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), 2048):
        np.minimum(least, (_ODDS[:, None] * short[lo:lo + 2048]).min(axis=1), out=least)
    value = (least[::2].astype(np.uint64) << np.uint64(32)) | least[1::2]
    return mix(value + _STEP).view(np.int64)


def features(documents: DataFrame, words: int, least: int, row: Column) -> DataFrame:
    """row, doc_id, none, key, n_shingles, node, tokens (null below ``least`` shingles: so small sets are only like their copies).

    none and key find a text again: its doc_id, or where it has none a hash of it, so that such texts don't meet under one key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", 2 << 20):
                some = batch.slice(lo, hi - lo)
                sets = shingle_sets(some.column("text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in ("row", "doc_id", "none", "key")], pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([signature(s) if len(s) >= least else None for s in sets], pa.list_(pa.int64()))],
                    names=["row", "doc_id", "none", "key", "n_shingles", "node", "tokens"])

    return documents.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *_found(), "text").mapInArrow(
        held_by("neardup", run), "row long, doc_id long, none boolean, key long, n_shingles long, node long, tokens array<long>")


def _found() -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.xxhash64("text")).alias("key")]


def prefixes(nodes: DataFrame, threshold: int) -> DataFrame:
    """node, token, weight: of each node with enough shared values, the rarest ones, of which every retained pair has one in common.

    weight is the number of postings that a node's values share: the more, the nearer it is to the middle of its like.
    """
    posted = nodes.filter("tokens IS NOT NULL").select("node", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = posted.join(shared, "token").groupBy("node").agg(F.sum("df").alias("weight"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own"))
    return own.filter(F.size("own") >= threshold) \
              .select("node", "weight", F.explode(F.slice("own", 1, F.size("own") - threshold + 1)).alias("one")).select("node", F.col("one.token").alias("token"), "weight")


def retained(pairs: DataFrame, nodes: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose set sizes allow the similarity and that collide in ``threshold`` coordinates."""
    one = lambda c: nodes.select(F.col("node").alias(c), F.col("tokens").alias(f"t{c}"), F.col("n_shingles").alias(f"n{c}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b")
    sized = (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
    return both.filter(sized & (F.size(F.array_intersect("ta", "tb")) >= threshold)).select("a", "b", "na", "nb")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, na, nb) those whose full sets have the similarity."""
    one = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(one("a"), "a").join(one("b"), "b").withColumn("common", common)
    return both.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def full_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, shingles of the nodes in ``wanted`` (node; none, key: where a document that has the set is found)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                sets = [s for s in shingle_sets(batch.column("text").slice(lo, hi - lo).to_pylist(), words) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()),
                                                  pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    rows = documents.select(*_found(), "text").join(wanted.select("none", "key").distinct(), ["none", "key"], "left_semi").select("text")
    return rows.mapInArrow(held_by("neardup", run), "node long, shingles array<long>").join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def dealt_lists(named: DataFrame) -> DataFrame:
    """token, i, j, side, node, root: the postings (token, node, root) of lists of several families, copied to the calls (i, j) that compare them.

    A list of up to BLOCK nodes is one call. A longer one is cut into blocks, and each pair of blocks is a call (side: the node's block). Where one
    family has at least half of the list, every pair of two families has a node outside it: only those (OUTER) meet all (ANY), and
    the copies grow with the nodes outside times the blocks, not with the square of the list.
    """
    lists = named.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).filter("low <> high")
    lists = stored(lists.select("token", "n", F.ceil(F.col("n") / BLOCK).alias("blocks")), "mixed-lists")
    long = lists.filter("blocks > 1")
    if long.isEmpty():
        cored = long.select("token", F.col("n").alias("core"), "blocks").withColumnRenamed("blocks", "outer")
    else:
        parts = named.join(long, "token").groupBy("token", "n", "root").agg(F.count(F.lit(1)).alias("own")).filter("2 * own >= n")
        cored = parts.groupBy("token", "n").agg(F.max(F.struct("own", "root")).alias("core"))
        cored = cored.select("token", F.col("core.root").alias("core"), F.ceil((F.col("n") - F.col("core.own")) / BLOCK).alias("outer"))
    block = lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    calls = lambda c, one: F.transform(F.sequence(F.lit(0).cast("long"), F.col(c) - 1), one)
    call = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    pairs = calls("blocks", lambda o: call(F.least(block("blocks"), o), F.greatest(block("blocks"), o), block("blocks")))
    outer = calls("blocks", lambda o: call(block("outer"), o, F.lit(OUTER).cast("long")))
    every = calls("outer", lambda o: call(o, block("blocks"), F.lit(ANY).cast("long")))
    own = F.when(F.col("core").isNull(), pairs).when(F.col("root") == F.col("core"), every).otherwise(F.concat(outer, every))
    return named.join(lists.join(cored, "token", "left"), "token").select("token", F.explode(own).alias("call"), "node", "root").select("token", "call.*", "node", "root")


def crossing_pairs(posted: DataFrame, families: DataFrame, nodes: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) that share a posting list, lie in different families and collide often enough.

    Lists within one family are skipped. The calls on a long list are counted by themselves; only retained pairs leave one.
    """
    named = dealt_lists(posted.select("node", "token").join(families, "node", "left").withColumn("root", F.coalesce("root", "node")))
    named = stored(named, "crossing")
    groups = max(1, -(-named.count() // GROUP_ROWS))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        take_over("neardup")
        found: list[tuple] = []
        for (_, i, j), own in rows.groupby(["token", "i", "j"], sort=False):
            if len(own) < 2 or own["root"].nunique() < 2:
                continue
            tokens, node, root = np.stack(own["tokens"].to_numpy()), own["node"].to_numpy(), own["root"].to_numpy()
            size, side = own["n_shingles"].to_numpy(), own["side"].to_numpy()
            for k in np.flatnonzero(side != ANY).tolist():
                near = (root != root[k]) & (100 * size >= percent * size[k]) & (100 * size[k] >= percent * size)
                if side[k] == OUTER:
                    near &= side == ANY
                else:
                    near[:k + 1] = False
                    near &= (i == j) | (side != side[k])
                at = np.flatnonzero(near)
                at = at[(tokens[at] == tokens[k]).sum(axis=1) >= threshold]
                found += zip([node[k]] * len(at), node[at], [size[k]] * len(at), size[at])
        return pd.DataFrame(found, columns=["a", "b", "na", "nb"]).astype("int64")

    full = named.join(nodes.select("node", "n_shingles", "tokens"), "node")
    pairs = full.groupBy(F.pmod(F.xxhash64("token", "i", "j"), F.lit(groups))).applyInPandas(count, "a long, b long, na long, nb long")
    least = F.col("a") < F.col("b")
    pick = lambda x, y: F.when(least, F.col(x)).otherwise(F.col(y))
    return pairs.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("na", "nb").alias("na"), pick("nb", "na").alias("nb")).distinct()


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Index pairs of sets of the two sides that have the similarity, by counting along the left sides' members."""
    members = np.concatenate(left)
    order = np.argsort(members, kind="stable")
    values, begin = np.unique(members[order], return_index=True)
    owner = np.repeat(np.arange(len(left)), list(map(len, left)))[order]
    ends, sizes, out = np.append(begin[1:], len(owner)), np.array(list(map(len, left))), []
    for j, own in enumerate(right):
        at = np.minimum(np.searchsorted(values, own), len(values) - 1)
        at = at[values[at] == own]
        many = ends[at] - begin[at]
        places = np.repeat(begin[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(owner[places], minlength=len(left))
        out += [(i, j) for i in np.flatnonzero(100 * common >= percent * (sizes + len(own) - common)).tolist()]
    return out


def family_links(families: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of each family: nodes outside its largest component, in blocks, with all its nodes, in blocks."""
    named = families.withColumnRenamed("root", "family").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = named.groupBy("family", "root").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("family").agg(F.max(F.struct("n", "root")).alias("core"), F.sum("n").alias("n")).filter("core.n < n")
    whole = whole.select("family", F.col("core.root").alias("core"), F.ceil((F.col("n") - F.col("core.n")) / BLOCK).alias("outer"), F.ceil(F.col("n") / BLOCK).alias("all"))
    named = named.join(whole, "family")
    until = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    outer = named.filter("root <> core").select("family", own("outer").alias("i"), until("all").alias("j"), F.lit(True).alias("outer"), "node", "root")
    every = named.select("family", until("outer").alias("i"), own("all").alias("j"), F.lit(False).alias("outer"), "node", "root")
    dealt = stored(outer.union(every), "families")
    groups = max(1, -(-dealt.count() // GROUP_SETS))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        take_over("neardup")
        found: list[tuple] = []
        for _, part in rows.groupby(["family", "i", "j"], sort=False):
            left, right = part[part["outer"]], part[~part["outer"]]
            if len(left) and len(right):
                a, b, ra, rb = left["node"].to_numpy(), right["node"].to_numpy(), left["root"].to_numpy(), right["root"].to_numpy()
                found += {(min(ra[i], rb[j]), max(ra[i], rb[j])) for i, j in linked(list(left["shingles"]), list(right["shingles"]), percent) if a[i] != b[j] and ra[i] != rb[j]}
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    full = dealt.join(sets, "node")
    return full.groupBy(F.pmod(F.xxhash64("family", "i", "j"), F.lit(groups))).applyInPandas(compare, "a long, b long")


def _rooted(documents: DataFrame, words: int, percent: int, row: Column) -> tuple[DataFrame, DataFrame]:
    """The features of all rows, and of each node its component's root, its smallest doc_id and its first row: by doc_id, nulls last, then by ``row``."""
    threshold = match_threshold(percent)
    # Different sets of fewer shingles can't be that similar: one of n is at most n / (n + 1) like another.
    least = next(n for n in range(1, 101) if 100 * n >= percent * (n + 1)) if percent < 100 else 1 << 62
    docs = stored(features(documents, words, least, row), "features")
    nodes = stored(docs.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("none", "key")).alias("found"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.max("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens")), "nodes")
    posted = stored(prefixes(nodes, threshold), "postings")
    hubs = posted.groupBy("token").agg(F.max(F.struct("weight", "node")).alias("hub")).select("token", F.col("hub.node").alias("hub"))
    star = posted.join(hubs, "token").filter("hub <> node").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    star = stored(retained(star, nodes, threshold, percent), "pairs")
    families = components(star)
    pairs = stored(star.union(crossing_pairs(posted, families, nodes, threshold, percent)), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(full_sets(documents, nodes.join(wanted, "node", "left_semi").select("node", "found.none", "found.key"), words), "sets")
    labels = components(confirmed(pairs, sets, percent))
    more = stored(family_links(families, labels, sets, percent).distinct(), "more-links")
    if not more.isEmpty():
        joined = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
        alone = joined.join(labels.select("root"), "root", "left_anti").select(F.col("root").alias("node"), "root")
        labels = labels.union(alone).join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    rooted = nodes.select("node", "rep", "first").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return docs, rooted


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document; links join sets with 100 * intersection >= percent * union.

    component_id is the smallest doc_id of the documents that links reach, and kept holds for that
    document. Null and wordless texts have no shingles and are linked with nothing. Rows with one doc_id are
    kept alike if their component says so; rows without one are in components like others and are
    only kept where all of the component's are. An empty table gives an empty result; other columns are ignored.
    """
    docs, rooted = _rooted(documents, words, percent, F.lit(0).cast("long"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_node = rooted.join(smallest, "root").select("node", "component_id", F.lit(True).alias("_in"))
    out = docs.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("_in"), F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents, of each component only one: the first by doc_id, nulls last.

    Rows with equal texts, repeated rows among them, are in one component. Rows without a word (a null text is one) are in
    none and all stay. An empty table gives an empty result. Columns may have any names and types: rows are told
    apart by a number that they get in a written copy.
    """
    row = fresh(documents.columns, "row")
    rows = stored(documents.withColumn(row, F.monotonically_increasing_id()), "rows")
    docs, rooted = _rooted(rows, words, percent, F.col(row))
    first = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    gone = docs.filter("node IS NOT NULL").select("row").join(first, "row", "left_anti").withColumnRenamed("row", row)
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
