"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree are the ranks of the neighbouring pairs of a pre-token; the root yields the
leftmost lowest rank, which is the next merge. A merge removes one leaf and changes its two neighbours:
three point updates of logarithmic cost, until the root says that no mergeable pair remains.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from faresight.llm.text import held_by, kept, slices

VOCABULARY = "byte_bpe_50k.json"
CACHE_CHUNKS, CACHE_LETTERS = 400_000, 200   # distinct chunks whose ids a worker keeps, none longer; beyond it, it starts anew
TREE_CELLS = 1 << 18                         # leaves of the trees that advance together
FEW = 8                                      # words of like length, or less, whose trees advance one by one
NONE = 1 << 30                               # rank of a pair without a merge

# The pre-tokenizer's pattern, and Unicode's white space, which its \s stands for.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
#: White space never joins what stands on its two sides, but for one space before a word.
CHUNK = " ?[^" + SPACE + "]+|[" + SPACE + "]+(?![^" + SPACE + "])|[" + SPACE + "]+"

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_codecs: dict[str, "Codec"] = {}
kept(_codecs.clear)


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one from 256."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in prints)}
    return [chr(rest.get(b, b)) for b in range(256)]


class Codec:
    """A byte-level BPE vocabulary file. ``codec(path)`` keeps one for each worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        chars = byte_characters()
        as_byte = {c: b for b, c in enumerate(chars)}
        vocab = said["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        self.single = np.array([vocab[c] for c in chars])
        self.width = len(vocab)
        pairs = np.array([vocab[a] * self.width + vocab[b] for a, b in merges])
        self.pair_ranks = np.argsort(pairs)
        self.pair_keys, self.merged = pairs[self.pair_ranks], np.array([vocab[a + b] for a, b in merges])
        self.ranks, self.merged_ids = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist())), self.merged.tolist()
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        text = {**{i: bytes(as_byte[c] for c in t) for t, i in vocab.items()}, **{i: t.encode() for t, i in self.special.items()}}
        self.bytes_of = [text.get(i, b"") for i in range(max(text) + 1)]
        self.words, self.chunks = regex.compile(PATTERN), re.compile(CHUNK)
        self.split = re.compile(f"({'|'.join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))})") if self.special else None
        self.known: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where there is no merge (an id of -1 is beyond an end)."""
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens of like length, whose trees advance together.

        Row w of ``tree`` is the segment tree of word w, root at 1 and leaves from ``size`` on. Leaf i holds
        the rank of the pair that begins at place i, with i in its low bits: the smallest key at the root is
        the leftmost pair of lowest rank. Places 0 and n + 1 stand for the word's two ends.
        """
        longest = max(map(len, words))
        size = 1 << (longest + 1).bit_length()
        shift, n = size.bit_length() - 1, np.array(list(map(len, words)))
        ids = np.full((len(words), size), -1, np.int64)
        ids[(np.arange(size) > 0) & (np.arange(size) <= n[:, None])] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.tile(np.arange(1, size + 1), (len(words), 1)), np.tile(np.arange(-1, size - 1), (len(words), 1))
        tree = np.full((len(words), 2 * size), NONE << shift, np.int64)
        tree[:, size:-1] = (self.rank(ids[:, :-1], ids[:, 1:]) << shift) | np.arange(size - 1)
        for k in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        while len(row := np.flatnonzero(tree[:, 1] < NONE << shift)):
            root = tree[row, 1]
            i = root & (size - 1)
            j = after[row, i]
            ids[row, i], ids[row, j] = self.merged[root >> shift], -1
            k, h = after[row, j], before[row, i]
            after[row, i], before[row, k] = k, i
            place = np.concatenate([j, i, h])
            ranks = np.concatenate([np.full(len(row), NONE), self.rank(ids[row, i], ids[row, k]), self.rank(ids[row, h], ids[row, i])])
            rows, node = np.tile(row, 3), size + place
            tree[rows, node] = (ranks << shift) | place
            while node[0] > 1:
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        left = ids >= 0
        data, ends = ids[left].astype("<u4").tobytes(), (4 * np.cumsum(left.sum(axis=1))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def merge_one(self, word: bytes) -> bytes:
        """Ids of one pre-token: the same tree in plain integers. Where few trees advance together, a step's numpy calls cost more than the step."""
        n = len(word)
        size = 1 << n.bit_length()
        shift = size.bit_length() - 1
        single = self.single[np.frombuffer(word, np.uint8)]
        level = np.full(size, NONE << shift, np.int64)
        level[:n - 1] = (self.rank(single[:-1], single[1:]) << shift) | np.arange(n - 1)
        levels = [level]
        while len(level) > 1:
            levels.append(level := np.minimum(level[::2], level[1::2]))
        tree = [NONE << shift, *np.concatenate(levels[::-1]).tolist()]
        ids, after, before = single.tolist(), list(range(1, n + 1)), list(range(-1, n))
        rank = lambda i, j: self.ranks.get(ids[i] * self.width + ids[j], NONE) if j < n else NONE

        def put(place: int, rank: int) -> None:
            value, node = (rank << shift) | place, size + place
            tree[node] = value
            while node > 1:
                value = min(value, tree[node ^ 1])
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        while (root := tree[1]) < NONE << shift:
            i = root & (size - 1)
            j, h = after[i], before[i]
            k = after[j]
            ids[i], ids[j] = self.merged_ids[root >> shift], -1
            after[i], before[k] = k, i
            put(j, NONE)
            put(i, rank(i, k))
            if h >= 0:
                put(h, rank(h, i))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens, by groups of like length and bounded size."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            data = w.encode()
            groups.setdefault((len(data) + 1).bit_length(), []).append((w, data))
        out = {}
        for bits, own in groups.items():
            step = max(1, TREE_CELLS >> bits)
            for lo in range(0, len(own), step):
                names, data = zip(*own[lo:lo + step])
                out.update(zip(names, map(self.merge_one, data) if len(data) <= FEW else self.merge(data)))
        return out

    def learn(self, texts: list[str]) -> None:
        """Encode what is new among the chunks of these texts."""
        known = self.known
        if len(known) > CACHE_CHUNKS:
            known.clear()
        new = {c: self.words.findall(c) for c in set(chain.from_iterable(texts)).difference(known)}
        ids = self.encode_words(list(set(chain.from_iterable(new.values()))))
        for c, words in new.items():
            known[c] = ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; the strings of special tokens become their ids."""
        plain = [self.split.split(t) if self.split else [t] for t in texts]
        chunks = [[self.chunks.findall(p) for p in parts[::2]] for parts in plain]
        self.learn([c for own in chunks for c in own])
        ids = [[b"".join(map(self.known.__getitem__, c)) for c in own] for own in chunks]
        for long in [c for own in chunks for part in own for c in part if len(c) > CACHE_LETTERS]:
            self.known.pop(long, None)
        marks = [[self.special[m].to_bytes(4, "little") for m in parts[1::2]] + [b""] for parts in plain]
        return [b"".join(chain.from_iterable(zip(a, b))) for a, b in zip(ids, marks)]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_decode(documents: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded).

    A null text is empty and has no token. Null or repeated doc_ids and repeated rows give a row each, an
    empty table none; other columns are ignored.
    """
    schema = RESULT + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for some in (b.slice(lo, hi - lo) for b in batches for lo, hi in slices(b, "text", 4 << 20)):
            rows = []
            for ids in own.encode_all([t or "" for t in some.column("text").to_pylist()]):
                back = own.decode(ids)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                            + ((np.frombuffer(ids, "<i4"), back) if with_ids else ()))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays([some.column("doc_id").cast(pa.int64())] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:1 + len(rows[0])])

    return documents.select("doc_id", "text").mapInArrow(held_by("bpe", run), schema)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))
