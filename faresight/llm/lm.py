"""Language-model scoring: exact unigram counts over the corpus, and a gated recurrent model of whole documents.

Counts of all words come from a shuffle by word. Then every document is read once more and becomes the ids that the
network knows, which are written; training and scoring read those and no text. The HEAD most frequent words (a bounded table) are
known to every task; a document's other words are sent to their counts and come back as sums, so no
task holds the whole vocabulary. The recurrent model knows the most frequent VOCABULARY words;
another word costs the model's chance of an unknown word times its share of the unknown words' counts,
so that the chances of all words add up to one.

The recurrent model is trained in rounds. In each, every trainer task starts from the same parameters and
learns from its documents by truncated backpropagation; the mean of the trainers' parameters, summed as
vectors by a tree of tasks, starts the next round. Their number follows the number of tokens, so training grows with the corpus and no
task with it. Every document to learn from trains the network in one of the rounds (by hash, whole).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm import gru
from faresight.llm.components import stored
from faresight.llm.text import held_by, mix, slices, word_hashes, words_of

HEAD, VOCABULARY = 131_072, 2_048             # words that every task knows the count of, and those the network knows
ROUNDS, TRAINER_TOKENS = 2, 4_000_000
SCORE_TOKENS, TRAIN_TOKENS = 8 << 20, 1 << 20 # of documents that run side by side, or are cut into parts together
FAN_IN = 32                                   # trainers' parameters that one task sums
EDGE = int(mix(np.array([0xE0D], np.uint64))[0])                         # stands for the end token among word hashes


def held_out() -> Column:
    """crc32 of the doc_id's text leaves 2 of 7. A null id counts as the empty text, which is not held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of all texts, and where each text's begin (one more than texts): its words with A-Z lower-cased, then one end."""
    data, starts, ends, first = words_of(texts, lower=True)
    out = np.full(len(starts) + len(texts), EDGE, np.uint64)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(texts)), np.diff(first))] = word_hashes(data, starts, ends)
    return out, first + np.arange(len(texts) + 1)


def word_counts(documents: DataFrame) -> DataFrame:
    """word (its hash), n: occurrences in all texts, the end of each among them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                word, n = np.unique(tokens_of(batch.column("text").slice(lo, hi - lo).to_pylist())[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return documents.select("text").mapInArrow(held_by("lm", count), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent words by hash, with their counts and their ids in the network; totals over all words."""
    words: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    by_id: np.ndarray                         # counts by id, that of unknown words among them
    tokens: int
    types: int
    unknown_tokens: int
    unknown_types: int

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash in the head (any, where it is in none), and whether it is there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def network_ids(self, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.where(known, self.ids[at], gru.UNKNOWN).astype(np.int32) if len(self.ids) else np.full(len(at), gru.UNKNOWN, np.int32)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From word counts. Of these the driver gets how many words fall in each bin of frequency, then the bins from
    the top that hold at most HEAD words together."""
    bin_ = F.floor(F.log2("n") * 8)
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    sizes = counts.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("words")).toPandas().sort_values("bin", ascending=False)
    inside = sizes["bin"][sizes["words"].cumsum() <= HEAD]
    top = counts.filter(bin_ >= int(inside.min() if len(inside) else 1 << 20)).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words, n = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    rank = np.cumsum(words != EDGE) + 1                                  # ids from 2 by frequency; the end has its own
    ids = np.where(words == EDGE, gru.END, np.where(rank < VOCABULARY, rank, gru.UNKNOWN))
    by_id = np.zeros(min(VOCABULARY, int(rank[-1]) + 1 if len(rank) else 2), np.int64)
    inside = ids != gru.UNKNOWN
    by_id[ids[inside]] = n[inside]
    tokens, types = int(total[0] or 0), int(total[1])
    by_id[gru.UNKNOWN] = tokens - n[inside].sum()
    order = np.argsort(words)
    return Vocabulary(words[order], n[order], ids[order], by_id, tokens, types, int(by_id[gru.UNKNOWN]), types - int(inside.sum()))


IDS = "<u2"                                   # ids of the network: VOCABULARY is less


def id_slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Row ranges of ``batch`` whose ids hold about ``limit`` tokens together, and the ids of each row."""
    ids = [np.frombuffer(x.as_buffer(), IDS) for x in batch.column("ids")]
    ends = np.cumsum(list(map(len, ids)))
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield lo, hi, [x.astype(np.int32) for x in ids[lo:hi]]
        lo = hi


def encoded(documents: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Of every document (doc_id, held_out, learns, text): n_tokens; n_known and base, the log10 counts, over the head's words; the network's ids; extra,
    what its unknown words cost beyond the network's unknown id; rare, its words outside the head."""
    unknown = np.log10(vocab.unknown_tokens + vocab.unknown_types + 1)
    own_columns = ["doc_id", "held_out", "learns"]
    kinds = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("extra", pa.float64()), ("ids", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(vocab.counts + 1.0)
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                some, n = batch.slice(lo, hi - lo), hi - lo
                hashes, first = tokens_of(some.column("text").to_pylist())
                at, inside = vocab.find(hashes)
                number = vocab.network_ids(at, inside)
                own = np.repeat(np.arange(n), np.diff(first))
                log = np.where(inside, logs[at], 0.0) if len(logs) else np.zeros(len(at))
                total = lambda x: np.bincount(own, x, n)                 # noqa: E731, B023
                data, edges = number.astype(IDS).tobytes(), (2 * first).tolist()
                columns = [np.diff(first), total(inside).astype(np.int64), total(log), total(np.where(number == gru.UNKNOWN, log - unknown, 0.0)),
                           [data[i:j] for i, j in zip(edges, edges[1:])]]
                yield pa.RecordBatch.from_arrays([some.column(c) for c in own_columns] + [pa.array(c, k) for c, (_, k) in zip(columns, kinds)]
                                                 + [_rare(hashes[~inside], own[~inside], n)], names=own_columns + [k for k, _ in kinds] + ["rare"])

    return documents.select(*own_columns, "text").mapInArrow(
        held_by("lm", run), "doc_id long, held_out boolean, learns boolean, n_tokens long, n_known long, base double, extra double, ids binary, rare array<struct<word: long, times: int>>")


def _mean(trained: DataFrame) -> np.ndarray | None:
    """The trainers' parameters weighted by their tokens: vectors (w: little-endian doubles, n: tokens) summed by a tree of tasks, FAN_IN at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n = None, 0
        for batch in batches:
            for one, seen in zip(batch.column("w"), batch.column("n").to_pylist()):
                value = np.frombuffer(one.as_buffer(), "<f8")
                w, n = value.copy() if w is None else w + value, n + seen
        if w is not None:
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([n])], names=["w", "n"])

    rows = trained.count()
    while rows > 1:
        groups = -(-rows // FAN_IN)
        trained = stored(trained.repartition(groups).mapInArrow(held_by("lm", add), "w binary, n long"), "sums")
        rows = trained.count()
    first = trained.first()
    return None if first is None else np.frombuffer(first["w"], "<f8") / first["n"]


def train(rows: DataFrame, vocab: Vocabulary) -> gru.Parameters:
    """The network after ROUNDS rounds over the ids of all ``rows`` (doc_id, ids), each of them in one. The driver gets the mean of the parameters."""
    p = gru.start(vocab.by_id)
    like = {k: np.zeros_like(v) for k, v in p.items()}
    spread = F.xxhash64(F.lit("train"), "doc_id", "ids")
    trainers = max(1, -(-vocab.tokens // (ROUNDS * TRAINER_TOKENS)))
    for r in range(ROUNDS):
        values = gru.flat(p)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, seen = gru.Trainer(gru.unflat(like, values)), 0     # noqa: B023
            for batch in batches:
                for _, _, ids in id_slices(batch, TRAIN_TOKENS):
                    trainer.learn(ids)
                    seen += sum(map(len, ids))
            if seen:
                trainer.finish()
                yield pa.RecordBatch.from_arrays([pa.array([(gru.flat(trainer.p).astype("<f8") * seen).tobytes()], pa.binary()), pa.array([seen])], names=["w", "n"])

        share = rows.filter(F.pmod(spread, F.lit(ROUNDS)) == r).select("ids", spread.alias("s"))
        dealt = share.repartition(trainers, "s").select("ids")
        mean = _mean(stored(dealt.mapInArrow(held_by("lm", learn), "w binary, n long"), "trained"))
        if mean is not None:
            p = gru.unflat(like, mean)
    return p


def score(documents: DataFrame, learns: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every document; the model learns from those where ``learns``.

    A null text is empty: its one token is the end. Null and repeated doc_ids and repeated rows give a row
    each; an empty table gives an empty result; other columns are ignored. With nothing to learn from no token
    is known: base_score is that of equal chances, and the network is as it was initialised.
    """
    counts = stored(word_counts(documents.filter(learns)), "word-counts")
    vocab = vocabulary(counts)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce(learns, F.lit(False)).alias("learns"), "text")
    first = stored(encoded(rows, vocab).withColumn("row", F.monotonically_increasing_id()), "encoded")
    values = gru.flat(p := train(first.filter("learns").select("doc_id", "ids"), vocab))
    like = {k: np.zeros_like(v) for k, v in p.items()}
    scale = np.log10(vocab.tokens + vocab.types + 1)                     # N + 1 * (V + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = gru.unflat(like, values)
        for batch in batches:
            for lo, hi, ids in id_slices(batch, SCORE_TOKENS):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), pa.array(gru.log_probabilities(p, ids) / np.log(10))], names=["row", "net"])

    net = first.select("row", "ids").mapInArrow(held_by("lm", run), "row long, net double")
    sent = first.select("row", F.explode("rare").alias("one")).select("row", "one.word", "one.times")
    back = sent.join(counts, "word").groupBy("row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_base"))
    own = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.drop("rare", "ids").join(net, "row").join(back, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + own("rare_known")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + own("rare_base") - F.col("n_tokens") * F.lit(float(scale))).alias("base_score"),
        (F.col("net") + F.col("extra") + own("rare_base")).alias("score"))


def _rare(hashes: np.ndarray, own: np.ndarray, n: int) -> pa.Array:
    """For each of n texts, its words outside the head, each with the times it occurs."""
    order = np.lexsort((hashes, own))
    hashes, own = hashes[order], own[order]
    begin = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])])) if len(hashes) else np.zeros(0, np.int64)
    times = np.diff(np.append(begin, len(hashes)))
    edges = np.searchsorted(own[begin], np.arange(n + 1)).astype(np.int32)
    words = pa.StructArray.from_arrays([pa.array(hashes[begin].view(np.int64)), pa.array(times.astype(np.int32))], names=["word", "times"])
    return pa.ListArray.from_arrays(pa.array(edges), words)


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(documents, ~held_out())
