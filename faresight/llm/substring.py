"""Substring duplicates by a compressed FM-index for each shard.

A window of WINDOW words is routed by its minimizer, the least hash among its runs of GRAM words: equal
windows have equal minimizers, so they meet in one shard, and successive windows of a document with one
minimizer travel together as a segment. Minimizers that occur once in all can't hold a repeat and go no further.
Of the others each distinct segment is kept once, with its number of occurrences: a passage that
is in a third of all documents is a few segments. A shard indexes its segments: suffix array, its
Burrows-Wheeler transform in a wavelet matrix, and the occurrences summed along it. The segments are streamed
against the index: backward search finds the longest part before each place that occurs twice
(the matching statistics), and every window within one of at least WINDOW words is a repeat.

A minimizer with very many distinct segments (the edges of a very common passage) is split: its
windows are routed one by one by their own hash. Words are compared themselves in the index; hashes of 64
bits only route and name segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.components import fresh, once, stored
from faresight.llm.text import held_by, mix, slices, take_over, word_hashes, words_of

WINDOW, GRAM = 35, 12
LONGEST_RUN = 24                              # windows of a segment
MANY_SEGMENTS = 2_000                         # distinct ones of a minimizer that is split
SHARD_WORDS = 300_000
_ODD = 0xD1342543DE82EF95


def _chained(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over word hashes, and the inverse powers that move a part of it to the front."""
    n = len(hashes)
    up, down = np.full(n + 1, _ODD, np.uint64), np.full(n + 1, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return sums, down


def segments(texts: list[str | None], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Segments of all texts: index of the text, first word in it, windows, minimizer, a hash of the words, and whether the minimizer's run stands in it more than once."""
    data, starts, ends, first = words_of(texts)
    hashes = word_hashes(data, starts, ends)
    n, gram = len(hashes), min(GRAM, window)
    if n < window:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums, down = _chained(hashes)
    grams = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
    least, reach, width = grams, 1, window - gram + 1                    # least of the next ``reach`` grams
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:len(least) - step], least[step:])
        reach += step
    own = np.repeat(np.arange(len(texts)), np.diff(first))
    at = np.flatnonzero(own[:n - window + 1] == own[window - 1:])        # windows within one text
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    least = least[at]
    begins = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (own[at[1:]] != own[at[:-1]])]))
    size = np.diff(np.append(begins, len(at)))
    parts = -(-size // LONGEST_RUN)
    begins = np.repeat(begins, parts) + LONGEST_RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    size = np.diff(np.append(begins, len(at)))
    place = at[begins]
    words = (sums[place + size + window - 1] - sums[place]) * down[place]
    name = mix(words + size.astype(np.uint64))
    spread = np.arange(LONGEST_RUN + width - 1)
    inside = spread < (size + width - 1)[:, None]
    same = grams[np.minimum(place[:, None] + spread, len(grams) - 1)] == least[begins][:, None]
    return own[place], place - first[own[place]], size, least[begins].view(np.int64), name.view(np.int64), (same & inside).sum(axis=1) > 1


class FMIndex:
    """Over sequences of symbols 1 and up (0 parts them), with a weight for each sequence."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> None:
        total = int(lengths.sum())
        n = total + len(lengths)
        text = np.zeros(n, np.int64)
        ends = np.cumsum(lengths + 1)                                    # each sequence, then its separator
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        text[inside] = symbols
        order, reach = self._suffixes(text, np.flatnonzero(~inside), int(lengths.max(initial=0))), int(symbols.max(initial=0)) + 1
        weight = np.repeat(weights, lengths + 1) * inside
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=reach))])
        self.size = n
        self._wavelet(text[order - 1], reach)

    @staticmethod
    def _suffixes(text: np.ndarray, parts: np.ndarray, longest: int) -> np.ndarray:
        """Suffix array by prefix doubling. Separators are less than symbols, the earlier the less, so no suffix is compared beyond its own."""
        n = len(text)
        rank = text + len(parts)
        rank[parts] = np.arange(len(parts))
        reach = 1
        order = np.argsort(rank, kind="stable")
        while reach <= longest:
            later = np.full(n, 0, np.int64)
            later[:n - reach] = rank[reach:] + 1
            key = rank * (n + len(parts) + 2) + later if reach == 1 else rank * (n + 2) + later
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            reach *= 2
        return order

    def _wavelet(self, symbols: np.ndarray, reach: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits = max(1, int(reach - 1).bit_length())
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.uint8)
            packed = np.zeros(len(bit) // 64 + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))]).astype(np.int32)
            zeros = len(bit) - int(bit.sum())
            self.levels.append((packed, ones, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.base = self._walk(np.arange(reach), np.zeros(reach, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the places ``at`` lead on the way down to ``symbol``."""
        for level, (packed, ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            word = at >> 6
            rank = ones[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbol >> level & 1, zeros + rank, at - rank)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns that ``symbol`` stands before."""
        both = self._walk(np.concatenate([symbol, symbol]), np.concatenate([low, high])) - np.tile(self.base[symbol], 2)
        return self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]


def repeats(symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(sequence, first, last): windows of the sequences, by their first word, that occur at least twice in all.

    From the right, the longest part that ends at a place and occurs twice is found by backward search;
    the next place is the last where a longer one to the left is possible.
    """
    index = FMIndex(symbols, lengths, weights)
    start = np.cumsum(lengths) - lengths
    seq = np.flatnonzero(lengths >= window)
    end = lengths[seq].copy()
    at, low, high = end.copy(), np.zeros(len(seq), np.int64), np.full(len(seq), index.size)
    found: list[tuple[int, int, int]] = []
    while len(seq):
        lo, hi = index.extend(symbols[start[seq] + at - 1], low, high)
        more = index.weight[hi] - index.weight[lo] >= 2
        at = at - more
        low, high = np.where(more, lo, low), np.where(more, hi, high)
        stop = ~more | (at == 0)
        hit = stop & (end - at >= window)
        found += zip(seq[hit].tolist(), at[hit].tolist(), (end[hit] - window).tolist())
        end = np.where(stop, np.minimum(end - 1, at + window - 1), end)
        stay = ~stop | (at > 0) & (end >= window)
        at, low, high = np.where(stop, end, at), np.where(stop, 0, low), np.where(stop, index.size, high)
        seq, end, at, low, high = seq[stay], end[stay], at[stay], low[stay], high[stay]
    return found


def _row() -> Column:
    """Names a row by its id and text: equal rows share a name and have the same result."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text"))


def _extract(wanted: DataFrame, window: int) -> DataFrame:
    """route, unit, minimizer, name, place, times, words: the segments in ``wanted`` (text, parts), or the windows of those to be split."""
    fields = ["route", "unit", "minimizer", "name", "place", "times", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, parts in zip(batch.column("text"), batch.column("parts").to_pylist()):
                words = text.as_py().encode().split()
                for p in parts:
                    own = words[p["first"]:p["first"] + p["size"] + window - 1]
                    if not p["split"]:
                        rows.append((p["minimizer"], p["name"], p["minimizer"], p["name"], 0, p["times"], b" ".join(own).decode()))
                        continue
                    for i in range(p["size"]):
                        one = b" ".join(own[i:i + window])
                        name = int.from_bytes(hashlib.blake2b(one, digest_size=8).digest(), "little", signed=True)
                        rows.append((name, name, p["minimizer"], p["name"], i, p["times"], one.decode()))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)

    return wanted.select("text", "parts").mapInArrow(held_by("substring", run), "route long, unit long, minimizer long, name long, place int, times long, words string")


def covered(documents: DataFrame, window: int = WINDOW, equal_rows_are_one: bool = False) -> DataFrame:
    """row, spans (begin, end of words) of every row of documents that holds a repeated window. Equal rows repeat each other unless they are taken for one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", 2 << 20):
                some = batch.slice(lo, hi - lo)
                own, first, size, minimizer, name, again = segments(some.column("text").to_pylist(), window)
                yield pa.RecordBatch.from_arrays([some.column("row").take(pa.array(own)), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)),
                                                  pa.array(minimizer), pa.array(name), pa.array(again.astype(np.int32))], names=["row", "first", "size", "minimizer", "name", "again"])

    rows = documents.select(_row().alias("row"), "text").filter("text IS NOT NULL")
    rows = once(rows, "row") if equal_rows_are_one else rows
    cuts = rows.mapInArrow(held_by("substring", cut), "row long, first int, size int, minimizer long, name long, again int")
    shared = cuts.groupBy("minimizer").agg(F.sum(1 + F.col("again")).alias("n")).filter("n > 1").select("minimizer")
    found = stored(cuts.drop("again").join(shared, "minimizer"), "segments")
    distinct = found.groupBy("minimizer", "name").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "first", "size")).alias("one"))
    many = distinct.groupBy("minimizer").agg((F.count(F.lit(1)) > MANY_SEGMENTS).alias("split"))
    wanted = distinct.join(many, "minimizer").select("one.row", F.struct("one.first", "one.size", "minimizer", "name", "times", "split").alias("part"))
    wanted = rows.join(wanted.groupBy("row").agg(F.collect_list("part").alias("parts")), "row")
    units = stored(_extract(wanted, window), "units")
    # Windows routed by themselves are combined before they meet; a segment already is one row.
    split = units.filter("route = unit").groupBy("route", "unit").agg(F.sum("times").alias("times"), F.min("words").alias("words"))
    dealt = units.filter("route <> unit").select("route", "unit", "times", "words").union(split)
    volume = units.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, -(-int(volume) // (6 * SHARD_WORDS)))

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        take_over("substring")
        one = shard.groupby(["route", "unit"], sort=False).agg({"times": "sum", "words": "first"}).reset_index()
        words = one["words"].str.split(" ")
        lengths = words.str.len().to_numpy(np.int64)
        symbols = pd.factorize(np.concatenate(words.map(np.array).to_numpy()))[0].astype(np.int64) + 1
        hits = repeats(symbols, lengths, one["times"].to_numpy(np.int64), window)
        seq = [h[0] for h in hits]
        return pd.DataFrame({"route": one["route"].to_numpy()[seq], "unit": one["unit"].to_numpy()[seq], "low": [h[1] for h in hits], "high": [h[2] for h in hits]}).astype("int64")

    hits = dealt.groupBy(F.pmod(F.xxhash64("route"), F.lit(shards))).applyInPandas(search, "route long, unit long, low long, high long")
    placed = units.select("route", "unit", "minimizer", "name", "place").join(hits, ["route", "unit"]) \
                  .select("minimizer", "name", (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high")).distinct()
    spans = found.join(placed, ["minimizer", "name"]).select("row", (F.col("first") + F.col("low")).alias("begin"), (F.col("first") + F.col("high") + window).alias("end"))
    return spans.distinct().groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def kept_words(text: str | None, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    """Number of words, and the words outside all spans."""
    words = (text or "").encode().split()
    if not spans:
        return len(words), words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [s["begin"] for s in spans], 1)
    np.add.at(edge, [s["end"] for s in spans], -1)
    return len(words), list(compress(words, np.cumsum(edge)[:-1] == 0))


def _with_spans(documents: DataFrame, window: int, spans: str, equal_rows_are_one: bool = False) -> DataFrame:
    row = fresh(documents.columns, "row")
    found = covered(documents, window, equal_rows_are_one).withColumnsRenamed({"row": row, "spans": spans})
    return documents.withColumn(row, _row()).join(found, row, "left")


def repeated_words(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document: words in a window that also starts elsewhere are removed.

    A null or wordless text has no words. Rows that are equal repeat each other. Null and repeated doc_ids
    give a row each; an empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("_spans").to_pylist()):
                n, kept = kept_words(text.as_py(), spans)
                rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string()))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_spans(own, window, "_spans").select("doc_id", "text", "_spans").mapInArrow(held_by("substring", run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The same rows and columns; a text with repeated windows becomes its other words, joined by one space (empty if none is left).

    Rows with one doc_id and one text are one document here: they lose what also stands in another one, not what they share.
    A null text stays null. An empty table gives an empty result.
    """
    names = documents.columns
    place, spans = names.index("text"), fresh(names, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", 8 << 20):
                some = batch.slice(lo, hi - lo)
                texts = [t if not s else b" ".join(kept_words(t, s)[1]).decode() for t, s in zip(some.column(place).to_pylist(), some.column(len(names)).to_pylist())]
                yield some.select(names).set_column(place, some.schema.field(place), pa.array(texts, some.schema.field(place).type))

    return _with_spans(documents, window, spans, equal_rows_are_one=True).select(*[F.col(f"`{c}`") for c in names], spans).mapInArrow(held_by("substring", run), documents.schema)


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
