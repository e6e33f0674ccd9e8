"""Language identification by error-correcting output codes.

Each language has a codeword; a binary n-gram classifier predicts each of its bits, and loss-weighted
decoding chooses the language whose codeword fits the predicted margins best. Character bigrams and
trigrams within words are counted for each language over all learning documents (hashed to a fixed number of
buckets, so the counts of a language have a fixed size whatever the corpus is). The classifier of a
bit compares the languages that have it with those that don't, each language with the same weight: a
language with a third of all documents doesn't outweigh the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.text import held_by, kept, slices

BUCKETS = 1 << 15
SMOOTHING = 0.5                               # added to each bucket's count, in shares of the mean count
LARGEST_WEIGHT = 6.0                          # of one n-gram, in nats
EXHAUSTIVE = 7                                # up to so many languages, every way to split them in two is a bit
SLICE = 1 << 20                               # bytes of text whose n-grams are held at once
AMBIGUOUS_MARGIN = 0.25                       # of the two best languages' losses
UNKNOWN = "und"
_tables: dict[str, np.ndarray] = {}
kept(_tables.clear)


def letters_of() -> np.ndarray:
    """By code point: the lower-case letter, or 0 for what is no letter."""
    if "letters" not in _tables:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables["letters"] = table
    return _tables["letters"]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all bigrams and trigrams (a letter with what stands before, and on both sides), and the index of the text of each."""
    data = [("" if t is None else t) + "\n" for t in texts]
    ends = np.cumsum([len(t) for t in data])
    codes = letters_of()[np.frombuffer("".join(data).encode("utf-32-le", "surrogatepass"), "<u4")]
    before, after = np.empty_like(codes), np.empty_like(codes)
    before[:1], before[1:] = 0, codes[:-1]
    after[-1:], after[:-1] = 0, codes[1:]
    at = np.flatnonzero(codes)
    own = np.searchsorted(ends, at, "right")
    pair = (before[at] * np.uint32(0x9E3779B1)) ^ (codes[at] * np.uint32(0x85EBCA77))
    triple = (pair * np.uint32(0xC2B2AE3D)) ^ (after[at] * np.uint32(0x27D4EB2F)) ^ np.uint32(0x165667B1)
    both = np.concatenate([pair, triple])
    both ^= both >> np.uint32(15)
    both *= np.uint32(0x2C1B3C6D)
    return (both >> np.uint32(32 - 15)).astype(np.int64) & (BUCKETS - 1), np.concatenate([own, own])


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1. Few languages: all splits in two; more: the best of a fixed series of random codes by its least distance."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))                              # the first language always has the same bit
        return np.where(splits >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    bits, best, least = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]                 # a bit that all share tells nothing
        distance = int(((code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(n)).min())
        if distance > least:
            best, least = code, distance
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray                          # languages x bits
    weights: np.ndarray                       # buckets x bits: log odds of the n-gram for the bit
    trust: np.ndarray                         # of each bit's classifier
    scale: np.ndarray | None = None           # languages x 2: what an n-gram says for the codeword on average, if all are equally likely, and in the language
    limits: np.ndarray | None = None          # least fit of a language's texts: see ``calibrated``

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log odds of each bit for each text, and its number of n-grams."""
        grams, own = ngrams(texts)
        n = np.bincount(own, minlength=len(texts))
        total = np.stack([np.bincount(own, self.weights[grams, b], len(texts)) for b in range(self.code.shape[1])], axis=1)
        return total / np.maximum(n, 1)[:, None], n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language (``und`` for no letter), score from 0 to 1, and whether the choice is ambiguous, of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        names, score, unclear, _, _ = self.decode(texts)
        return names, score, unclear

    def decode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``predict``, and of each text the index of its language and how well it fits the codeword: about 0 for letters without any
        language, 1 for n-grams as the language has them, whatever the text's length."""
        margin, n = self.margins(texts)
        sure = margin * np.sqrt(np.minimum(n, 400))[:, None]             # more n-grams make surer, up to a point
        loss = np.stack([(np.logaddexp(0, -sure * word) * self.trust).sum(axis=1) for word in self.code], axis=1)
        best = loss.argmin(axis=1)
        rows = np.arange(len(texts))
        share = np.exp(loss[rows, best][:, None] - loss)
        score = np.where(n > 0, 1 / share.sum(axis=1), 0.0)
        second = np.partition(loss, min(1, len(self.languages) - 1), axis=1)[:, min(1, len(self.languages) - 1)]
        wrong = (np.sign(margin) != self.code[best]).sum(axis=1)
        apart = (self.code.shape[1] - self.code @ self.code.T) / 2
        radius = 0 if len(self.languages) < 2 else int((apart + 2 * self.code.shape[1] * np.eye(len(apart))).min() - 1) // 2
        unclear = (n == 0) | (len(self.languages) > 1) & ((second - loss[rows, best] < AMBIGUOUS_MARGIN) | (wrong > radius))
        fit = np.ones(len(texts))
        if self.scale is not None:
            even, usual = self.scale[best].T
            own = (margin * self.code[best] * self.trust).sum(axis=1) / self.trust.sum()
            fit = np.where(usual > even, (own - even) / np.where(usual > even, usual - even, 1), 1.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], score, unclear, best, fit

    def speaks(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text is in a learned language: it has a letter, and it fits its codeword no worse than the language's limit.

        Without anything to learn from no language is known, and that says nothing about a text: all with a letter pass.
        """
        if not self.languages:
            return np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
        names, _, _, best, fit = self.decode(texts)
        return np.array([x != UNKNOWN for x in names], bool) & (fit >= (self.limits[best] if self.limits is not None else -np.inf))


def held_out() -> F.Column:
    """crc32 of the doc_id's text leaves 1 of 3. A null id counts as the empty text, which is not held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(documents: DataFrame) -> Model:
    """Learn from text and lang of all rows given. What reaches the driver is one count for each language and bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lo, hi in slices(batch, "text", SLICE):
                langs = np.array(batch.column("lang").slice(lo, hi - lo).to_pylist(), object)
                grams, own = ngrams(batch.column("text").slice(lo, hi - lo).to_pylist())
                names, code = np.unique(langs.astype(str), return_inverse=True)
                counts = np.bincount(code[own] * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, c in zip(names.tolist(), counts):
                    held[name] = held[name] + c if name in held else c
        for name, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))],
                                             names=["lang", "bucket", "n"])

    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    found = rows.mapInArrow(held_by("language", count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(found["lang"]))
    counts = np.zeros((len(names), BUCKETS))
    counts[np.searchsorted(names, found["lang"]) if names else [], found["bucket"]] = found["n"]
    counts += SMOOTHING * counts.mean(axis=1, keepdims=True) + 1e-9
    shares = counts / counts.sum(axis=1, keepdims=True)
    code = codewords(len(names))
    weights, trust = np.zeros((BUCKETS, code.shape[1]), np.float32), np.ones(code.shape[1])
    for b in range(code.shape[1] if names else 0):                       # a single language is told from even shares
        yes, no = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0) if len(names) > 1 else np.full(BUCKETS, 1 / BUCKETS)
        odds = np.clip(np.log(yes / no), -LARGEST_WEIGHT, LARGEST_WEIGHT)
        trust[b] = ((yes - no) * odds).sum()                             # how far apart the two sides are
        weights[:, b] = odds
    trust = trust / max(trust.mean(), 1e-9)
    scale = np.zeros((len(names), 2))
    for k in range(len(names)):
        says = weights @ (code[k] * trust) / trust.sum()
        scale[k] = says.mean(), shares[k] @ says
    return Model(names, code, weights, trust, scale)


FIT_BINS, FIT_WIDTH = 1024, 0.01              # bins of the fit of labelled texts, 0 in the middle
FIT_PRIOR = 20                                # texts of all languages that count with a language's own
REJECTED_BEYOND, LEAST_SPREAD = 8.0, 0.1      # robust standard deviations below a language's median fit, and the least that one is taken for
LIMITS = 0.25, 0.6                            # a limit is between these, whatever the rows are


def calibrated(documents: DataFrame, model: Model) -> Model:
    """``model`` with each language's limit, from the fit of all labelled rows that it gives their own language.

    A limit lies REJECTED_BEYOND robust standard deviations (from the median to the lower quartile) below the median, so that
    documents of a language stay, odd ones too, and well between letters without a language and the language. Few labelled rows lean on those of all languages. The driver gets
    one count for each language and bin.
    """
    if not model.languages:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(model.languages), FIT_BINS), np.int64)
        for batch in batches:
            for lo, hi in slices(batch, "text", SLICE):
                names, _, _, best, fit = model.decode(batch.column("text").slice(lo, hi - lo).to_pylist())
                own = np.array(names, object) == np.array(batch.column("lang").slice(lo, hi - lo).to_pylist(), object)
                at = np.clip(np.floor(fit / FIT_WIDTH) + FIT_BINS // 2, 0, FIT_BINS - 1).astype(np.int64)
                np.add.at(held, (best[own], at[own]), 1)
        lang, at = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (lang, at)] + [pa.array(held[lang, at])], names=["lang", "bin", "n"])

    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(held_by("language", count), "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(model.languages), FIT_BINS))
    counts[found["lang"], found["bin"]] = found["n"]
    pooled = counts.sum(axis=0)
    counts = counts + FIT_PRIOR * pooled / max(pooled.sum(), 1)
    share = np.cumsum(counts, axis=1) / np.maximum(counts.sum(axis=1, keepdims=True), 1e-9)
    median, low = ((np.argmax(share >= q, axis=1) - FIT_BINS // 2) * FIT_WIDTH for q in (0.5, 0.25))
    return replace(model, limits=np.clip(median - REJECTED_BEYOND * np.maximum((median - low) / 0.6745, LEAST_SPREAD), *LIMITS))


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous, of every whole text; text is all that a prediction sees.

    A null text and one without a letter are ``und`` with score 0. Null or repeated doc_ids and repeated rows
    give a row each; an empty table gives an empty result; other columns are ignored. A text as likely in
    two languages goes to the first by name and is ambiguous. Without anything to learn from, all are ``und``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", SLICE):
                some = batch.slice(lo, hi - lo)
                language, score, unclear = model.predict(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("held_out"), pa.array(language, pa.string()), pa.array(score), pa.array(unclear)],
                                                 names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(held_by("language", run), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def with_language(documents: DataFrame, model: Model) -> DataFrame:
    """The same rows and columns of documents whose text is in a language that the model knows (:meth:`Model.speaks`).

    Null texts and those without a letter go; ambiguous ones stay. Repeated rows are treated alike; an empty table gives
    an empty result. Without a calibrated model, or one that has learned nothing, all texts with a letter stay.
    """
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text", SLICE):
                some = batch.slice(lo, hi - lo)
                yield some.filter(pa.array(model.speaks(some.column(place).to_pylist()), pa.bool_()))

    return documents.mapInArrow(held_by("language", run), documents.schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(documents, train(documents.filter(~held_out())))
