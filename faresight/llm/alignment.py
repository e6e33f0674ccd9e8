"""Cross-tokenizer alignment: whitespace-token anchors split documents into windows of token ids, aligned once each.

Every text is tokenized whole by a byte-level vocabulary (A) and by a piece vocabulary (B). Where a token of both
ends and the next one of both is marked with a space lies an anchor; the shared ends are verified: only texts
whose tokens' bytes give the text on both sides are aligned. Anchors split a document into windows, which
are nearly always words, and a window's alignment depends on its token ids alone. It is computed when a worker
first meets the two tuples of ids and looked up from then on.

Within a window, byte offsets where tokens of both end cut groups; all pairs of an A and a B token of a group are
linked. How many documents hold a pair is counted over the corpus. The most frequent pairs (a bounded table) are
known to every task; a document's other pairs are sent to their counts and come back as sums.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.bpe import byte_characters
from faresight.llm.components import stored
from faresight.llm.text import held_by, kept, slices

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: the byte-level vocabulary's pre-tokenizer.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_BLANK = 4096                             # white space in a row
BLANK = re.compile(r"\s{%d}" % LONG_BLANK)
SPACE_MARK = "▁"                         # stands for a space in pieces
MEMO_WINDOWS, MEMO_TOKENS = 200_000, 64       # windows that a worker keeps; longer ones are aligned each time
LARGE_GROUP = 1 << 16                         # links of a group from which its ids are counted before they are paired
SLICE = 2 << 20                               # bytes of text tokenized at a time
HEAD = 262_144                                # pairs that every task knows the count of
COUNTED = 4 << 20                             # pairs that a task holds before it hands on their counts

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_NONE = np.zeros(0, np.int64)
_aligners: dict[tuple[str, str], "Aligner"] = {}
kept(_aligners.clear)


def _marks(ends: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size + 1, bool)
    out[ends] = True
    return out


def _shared(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A, and of B, that end where one of the other ends. Both end together at last."""
    size = int(end_a[-1])
    return np.flatnonzero(_marks(end_b, size)[end_a]), np.flatnonzero(_marks(end_a, size)[end_b])


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` that begin and have sizes as given, one after the other."""
    return flat[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


class Strings:
    """Byte strings by number, in one array."""

    def __init__(self, all_: list[bytes]) -> None:
        self.flat, self.size = np.frombuffer(b"".join(all_), np.uint8), np.array(list(map(len, all_)))
        self.begin = np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return _gathered(self.flat, self.begin[numbers], self.size[numbers])


class Aligner:
    """Two vocabulary files and the windows aligned so far. ``aligner(a, b)`` keeps one for each worker.

    Ids of B are counted on from the last of A where both stand in one array. A window's key is its ids, first those of A.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            said = json.load(f)
        as_byte = {c: b for b, c in enumerate(byte_characters())}
        special = {t["id"] for t in said["added_tokens"]}
        of_a = {i: bytes(as_byte[c] for c in t) for t, i in said["model"]["vocab"].items() if i not in special}
        # The vocabulary's merges stand in the order of its ids, so the ids are the ranks of this faster encoder of the same tokens.
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in of_a.items()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = max(of_a) + 1, len(pieces)
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(SPACE_MARK, " ").encode()
                   for i, p in enumerate(pieces)]
        self.tokens = Strings([of_a.get(i, b"") for i in range(self.size_a)] + bytes_b)
        self.marked = np.array([of_a.get(i, b"")[:1] == b" " for i in range(self.size_a)] + [p[:1] == SPACE_MARK for p in pieces])
        self.names = Strings([b"%d," % i for n in (self.size_a, self.size_b) for i in range(n)])
        self.path_a, self.library = path_a, None
        self.forget(0)

    def forget(self, first: int) -> None:
        """Drop all windows but the first ones."""
        if not first:
            self.known: dict[bytes, int] = {}
            self.texts: list[bytes] = []
            self.numbers, self.codes, self.times = np.zeros((4, 0), np.int64), _NONE, _NONE
            return
        for key in [k for k, i in self.known.items() if i >= first]:
            del self.known[key]
        held = int(self.numbers[2:, first - 1].sum())
        self.texts, self.numbers, self.codes, self.times = self.texts[:first], self.numbers[:, :first], self.codes[:held], self.times[:held]

    def tokenize(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which texts have tokens; the ids of A and B of these, one after the other; and of each its number of tokens of A, of B, and its bytes."""
        some = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in some]
        data = [t.encode() for t in spaced]
        ids_a = [self._encode(t) for t in spaced]
        ids_b = [np.array(x, np.uint32) + np.uint32(self.size_a) for x in (self.b.encode([texts[i] for i in some], num_threads=1) if some else [])]
        same = [k for k in range(len(some)) if self._is(ids_a[k], data[k]) and self._is(ids_b[k], data[k])]
        sizes = [np.array([len(x[k]) for k in same], np.int64) for x in (ids_a, ids_b, data)]
        joined = [np.concatenate([x[k] for k in same] or [_NONE]).astype(np.uint32) for x in (ids_a, ids_b)]
        return np.array([some[k] for k in same], np.int64), *joined, *sizes

    def _encode(self, text: str) -> np.ndarray:
        """Ids of A. The faster encoder's stack does not hold the longest runs of white space: texts with such go to the vocabulary's own library."""
        if len(text) < LONG_BLANK or not BLANK.search(text):
            return self.a.encode_to_numpy(text, disallowed_special=())
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path_a)
            self.library.encode_special_tokens = True
            self.library.no_padding()
            self.library.no_truncation()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _is(self, ids: np.ndarray, data: bytes) -> bool:
        return int(self.tokens.size[ids].sum()) == len(data) and self.tokens.joined(ids).tobytes() == data

    def anchors(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of documents one after the other: for each window its first A token, its first B token and its document (the first two: one more)."""
        end_a = np.cumsum(self.tokens.size[a])
        at_a, at_b = _shared(end_a, np.cumsum(self.tokens.size[b]))
        bounds = np.cumsum(sizes)
        marked = self.marked[a[np.minimum(at_a + 1, len(a) - 1)]] & self.marked[b[np.minimum(at_b + 1, len(b) - 1)]]
        cut = _marks(bounds, int(bounds[-1]))[end_a[at_a]] | marked
        first = np.zeros(1, np.int64)
        return np.concatenate([first, at_a[cut] + 1]), np.concatenate([first, at_b[cut] + 1]), np.searchsorted(bounds, end_a[at_a[cut]])

    def learn(self, new: list[bytes]) -> None:
        """Align windows that are new, all at once."""
        ids = np.frombuffer(b"".join(new), "<u4")
        of_b = ids >= self.size_a
        a, b = ids[~of_b], ids[of_b]
        ends = np.cumsum(list(map(len, new))) // 4
        at_a, at_b = _shared(np.cumsum(self.tokens.size[a]), np.cumsum(self.tokens.size[b]))
        # Group g has the A tokens from low_a[g] to at_a[g], and so for B; its window is where its last token is.
        low_a, low_b = np.concatenate([[0], at_a[:-1] + 1]), np.concatenate([[0], at_b[:-1] + 1])
        window = np.searchsorted(ends, at_a + at_b + 1, "right")
        size_b = at_b + 1 - low_b
        links = (at_a + 1 - low_a) * size_b
        small = np.where(links < LARGE_GROUP, links, 0)
        group = np.repeat(np.arange(len(links)), small)
        place = np.arange(len(group)) - np.repeat(np.cumsum(small) - small, small)
        pair = lambda x, y: x.astype(np.int64) * self.size_b + y - self.size_a
        code = pair(a[low_a[group] + place // size_b[group]], b[low_b[group] + place % size_b[group]])
        owner, times = window[group], np.ones(len(group), np.int64)
        for g in np.flatnonzero(links >= LARGE_GROUP).tolist():
            one, n_one = np.unique(a[low_a[g]:at_a[g] + 1], return_counts=True)
            two, n_two = np.unique(b[low_b[g]:at_b[g] + 1], return_counts=True)
            owner = np.concatenate([owner, np.full(len(one) * len(two), window[g])])
            code = np.concatenate([code, pair(one[:, None], two).ravel()])
            times = np.concatenate([times, (n_one[:, None] * n_two).ravel()])
        if (links >= LARGE_GROUP).any():
            order = np.argsort(owner, kind="stable")
            owner, code, times = owner[order], code[order], times[order]
        pairs = np.bincount(owner, minlength=len(new))
        total = np.bincount(window, links, len(new)).astype(np.int64)
        self.numbers = np.concatenate([self.numbers, np.stack([np.bincount(window, minlength=len(new)), total, pairs, len(self.codes) + np.cumsum(pairs) - pairs])], axis=1)
        self.codes, self.times = np.concatenate([self.codes, code]), np.concatenate([self.times, times])
        self.texts += self._written(a, b, low_b, at_a, at_b, window, len(new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))

    def _written(self, a: np.ndarray, b: np.ndarray, low_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, window: np.ndarray, n: int) -> list[bytes]:
        """The groups of each window as text: ids of A, a bar, ids of B, with a semicolon between groups."""
        ids = np.empty(len(a) + len(b), np.int64)
        # Before an A token of a group stand all B tokens of earlier groups, before a B token all A tokens up to its own group's last.
        ids[np.arange(len(a)) + np.repeat(low_b, np.diff(at_a, prepend=-1))] = a
        ids[np.arange(len(b)) + np.repeat(at_a + 1, np.diff(at_b, prepend=-1))] = b
        text = self.names.joined(ids)
        ends = np.cumsum(self.names.size[ids])
        text[ends[at_a + low_b] - 1] = ord("|")
        text[ends[at_a + at_b + 1] - 1] = ord(";")
        last = np.flatnonzero(np.diff(window, append=n))                  # a window's last group
        edges = [0, *ends[(at_a + at_b + 1)[last]].tolist()]
        data = text.tobytes()
        return [data[i:j - 1] for i, j in zip(edges, edges[1:])]

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """n_a, n_b, n_groups, n_links, groups (their text) and pairs (code, times) of every text."""
        n = len(texts)
        out = {k: np.zeros(n, np.int64) for k in COUNTS} | {"groups": [b""] * n, "pairs": [(_NONE, _NONE)] * n}
        kept, a, b, n_a, n_b, sizes = self.tokenize(texts)
        if not len(kept):
            return out
        from_a, from_b, own = self.anchors(a, b, sizes)
        both = np.empty(len(a) + len(b), "<u4")
        both[np.arange(len(a)) + np.repeat(from_b[:-1], np.diff(from_a))] = a
        both[np.arange(len(b)) + np.repeat(from_a[1:], np.diff(from_b))] = b
        data, edges = both.tobytes(), (4 * (from_a + from_b)).tolist()
        keys = [data[i:j] for i, j in zip(edges, edges[1:])]
        if len(self.known) > MEMO_WINDOWS:
            self.forget(0)
        new = set(keys).difference(self.known)
        long = [k for k in new if len(k) > 8 * MEMO_TOKENS]
        stays = len(self.known) + len(new) - len(long)
        for some in (list(new.difference(long)), long):
            if some:
                self.learn(some)
        which = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        groups, links, pairs, begin = self.numbers[:, which]
        total = lambda x: np.bincount(own, x, len(kept)).astype(np.int64)
        out["n_a"][kept], out["n_b"][kept], out["n_groups"][kept], out["n_links"][kept] = n_a, n_b, total(groups), total(links)
        doc = np.repeat(own, pairs) << 40
        seen, times = _summed(doc | _gathered(self.codes, begin, pairs), _gathered(self.times, begin, pairs))
        edges, places = np.searchsorted(seen >> 40, np.arange(len(kept) + 1)).tolist(), np.searchsorted(own, np.arange(len(kept) + 1)).tolist()
        code, text = seen & ((1 << 40) - 1), list(map(self.texts.__getitem__, which.tolist()))
        for k, i in enumerate(kept.tolist()):
            out["pairs"][i] = code[edges[k]:edges[k + 1]], times[edges[k]:edges[k + 1]]
            out["groups"][i] = b";".join(text[places[k]:places[k + 1]])
        if long:
            self.forget(stays)                # they hardly recur, and without them the memo's size is bounded
        return out


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the times of each."""
    more = times > 1
    held = np.sort(keys)
    begin = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else _NONE
    sums, held = np.diff(begin, append=len(keys)), held[begin]
    if more.any():
        sums += np.bincount(np.searchsorted(held, keys[more]), times[more] - 1, len(held)).astype(np.int64)
    return held, sums


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def aligned(documents: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 of every document, its distinct linked pairs (codes, little-endian 64-bit)
    with the links of each (times, 32-bit), and on request the groups' text. A code is the A id times the size of B, plus the B id."""
    kinds = [("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary())] + [("groups", pa.string())] * with_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for lo, hi in slices(batch, "text", SLICE):
                some = batch.slice(lo, hi - lo)
                found = both.align(some.column("text").to_pylist())
                columns = [[hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]],
                           [c.astype("<i8").tobytes() for c, _ in found["pairs"]], [t.astype("<u4").tobytes() for _, t in found["pairs"]],
                           [g.decode() for g in found["groups"]]]
                yield pa.RecordBatch.from_arrays([some.column("doc_id")] + [pa.array(found[c]) for c in COUNTS] + [pa.array(c, k) for c, (_, k) in zip(columns, kinds)],
                                                 names=["doc_id", *COUNTS, *[k for k, _ in kinds]])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary" + ", groups string" * with_groups
    return rows.mapInArrow(held_by("alignment", run), schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """code, n: how many rows of ``aligned`` hold each pair. Tasks hand on sums of bounded blocks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held or [_NONE]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for one in batch.column("codes"):
                held.append(np.frombuffer(one.as_buffer(), "<i8"))
                size += len(held[-1])
                if size >= COUNTED:
                    yield summed()
                    held, size = [], 0
        yield summed()

    return rows.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def frequent(pairs: DataFrame, head: int = HEAD) -> pd.DataFrame:
    """The bins of frequency from the top that hold at most ``head`` pairs together, sorted by code."""
    bin_ = F.floor(F.log2("n") * 8)
    sizes = pairs.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("pairs")).toPandas().sort_values("bin", ascending=False)
    inside = sizes["bin"][sizes["pairs"].cumsum() <= head]
    return pairs.filter(bin_ >= int(inside.min() if len(inside) else 1 << 20)).toPandas().sort_values("code")


def align(documents: DataFrame, path_a: str, path_b: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A null or empty text, and one whose tokens' bytes differ from it on either side, has no tokens: zeros, and an
    empty groups_sha256. Null and repeated doc_ids and repeated rows give a row each and count each; an empty
    table gives an empty result; other columns are ignored. Pairs of equal count are all the best of their A id.
    """
    size_b = aligner(path_a, path_b).size_b
    rows = stored(aligned(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pair-counts").withColumn("a", F.floor(F.col("code") / size_b))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))              # at most a row for each id of A
    pairs = stored(counts.join(F.broadcast(most), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    top = frequent(pairs, head)
    codes, n, best = top["code"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)
    rest = pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column("codes")]
            times = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column("times")] or [_NONE]).astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(list(map(len, own)))]).astype(np.int64)
            code = np.concatenate(own or [_NONE])
            doc = np.repeat(np.arange(len(own)), np.diff(edges))
            at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            known = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            sums = []
            for value in (best, n) if len(codes) else ():
                running = np.concatenate([[0], np.cumsum(np.where(known, times * value[at], 0))])
                sums.append(running[edges[1:]] - running[edges[:-1]])
            n_best, count_sum = sums or [np.zeros(len(own), np.int64)] * 2
            other = pa.StructArray.from_arrays([pa.array(code[~known]), pa.array(times[~known])], names=["code", "times"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[~known], np.arange(len(own) + 1)).astype(np.int32)), other)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(n_best), pa.array(count_sum), lists.cast(rest)],
                                             names=[*kept, "n_best", "count_sum", "rest"])

    kept = ["row", "doc_id", *COUNTS, "groups_sha256"]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<struct<code: long, times: long>>"
    known = stored(rows.select(*kept, "codes", "times").mapInArrow(look_up, schema), "looked-up")
    sent = known.select("row", F.explode("rest").alias("one")).select("row", "one.code", "one.times")
    back = sent.join(pairs, "code").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                                       F.sum(F.col("times") * F.col("n")).alias("more_count"))
    own = lambda c: F.coalesce(F.col(c), F.lit(0))
    return known.drop("rest").join(back, "row", "left").select(
        "doc_id", *COUNTS, (F.col("n_best") + own("more_best")).alias("n_best"), (F.col("count_sum") + own("more_count")).alias("count_sum"), "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(documents, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY))
