"""Packing: power-of-two decomposition.

A document of L tokens is cut into pieces whose lengths are the binary digits of L (as many pieces of the
largest length as fit, then one for each digit that is set). Every piece is a sequence of its own
and belongs to the bucket of its length, from which a trainer draws batches of equal shape: no sequence
crosses documents and none needs padding.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.text import held_by, kept, slices

VOCABULARY = "word_bpe_49k.json"
MAX_LENGTH, END_ID = 4096, 2
TOGETHER = 20_000                            # parts tokenized in one call
CACHE_WORDS, CACHE_LETTERS = 600_000, 200    # words whose ids a worker keeps, none longer; beyond it, it keeps those that it has just met again

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
_state: dict[str, tuple] = {}
kept(_state.clear)


def _tokenizer(path: str) -> tuple:
    if path not in _state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"                  # a Spark task is one thread; its neighbours have the other cores
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        _state[path] = tokenizer, {}
    return _state[path]


def parts_of(text: str) -> list[str]:
    """The parts between spaces and line feeds; in lower case, to meet fewer, where the ids are certainly the same.

    That is ASCII that can't hold a special token, which is matched in its own case. Other letters are composed
    before the tokenizer lower-cases them.
    """
    if text.isascii() and "<|" not in text:
        return text.lower().replace("\n", " ").split(" ")
    raw = text.replace("\n", " ").split(" ")
    if "<|" in text:
        return [p.lower() if p.isascii() and "<|" not in p else p for p in raw]
    return [a if b.isascii() else b for a, b in zip(text.lower().replace("\n", " ").split(" "), raw)]


def stays_letter(c: str) -> bool:
    """Whether a text that ends in ``c`` ends in a letter once it is composed and lower-cased. Some letters are taken apart and end in a mark."""
    return c.isalpha() and (c.isascii() or unicodedata.normalize("NFC", unicodedata.normalize("NFC", c).lower())[-1].isalpha())


def _learn(new: set[str], path: str) -> None:
    """Tokenize parts that are new. A letter is never merged with a full stop or comma: a word that one of them ends is the word and the sign."""
    tokenizer, known = _tokenizer(path)
    ended = [p for p in new if p[-1:] in (".", ",") and len(p) > 1 and stays_letter(p[-2])]
    words = list(new.difference(ended).union(p[:-1] for p in ended).union(".,").difference(known))
    for lo in range(0, len(words), TOGETHER):
        some = words[lo:lo + TOGETHER]
        known.update((w, array("I", e.ids).tobytes()) for w, e in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)))
    known.update((p, known[p[:-1]] + known[p[-1]]) for p in ended)


def encode(texts: list[str | None], path: str) -> list[bytes]:
    """Token ids of whole texts, little-endian unsigned 32-bit.

    This tokenizer drops white space and never merges across it, so a text's ids are those of its parts
    between spaces and line feeds, and each distinct part is tokenized once.
    """
    known = _tokenizer(path)[1]
    parts = [[] if t is None else parts_of(t) for t in texts]
    met = set().union(*parts)
    if len(known) > CACHE_WORDS:
        frequent = {w: known[w] for w in met.intersection(known)}
        known.clear()
        known.update(frequent)
    new = met.difference(known)
    _learn(new, path)
    out = [b"".join(map(known.__getitem__, p)) for p in parts]
    for w in new:
        if len(w) > CACHE_LETTERS:            # with its part before a last sign
            known.pop(w, None)
            known.pop(w[:-1], None)
    return out


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Power-of-two lengths, longest first, that add up to n."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def decompose(documents: DataFrame, vocabulary: str, longest: int = MAX_LENGTH, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, ids.

    A null text is empty: its one piece holds the end id. A null doc_id and repeated rows are packed like
    any other; sequence_id is unique for each piece whatever the ids are. It follows from the place of the
    row in the input files, so a task that runs again gives the same numbers. Other columns are ignored. ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", 4 << 20):
                doc_ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                out = []
                for doc_id, ids in zip(doc_ids, encode(batch.column("text").slice(lo, hi - lo).to_pylist(), vocabulary)):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for n in piece_lengths(total, longest):
                        piece = ids[4 * start:4 * (start + n)]
                        out.append((doc_id, start, n, zlib.crc32(piece), total, np.frombuffer(piece, "<i4") if with_ids else None))
                        start += n
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.list_(pa.int32()))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    pieces = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(held_by("packing", cut), PIECES)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket"), "ids")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences with one folder per length: a trainer reads batches of one shape from each."""
    pieces.write.partitionBy("bucket").parquet(path)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decompose(documents, public_tokenizers.path(VOCABULARY), with_ids=False).drop("bucket", "ids")
