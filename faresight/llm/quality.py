"""Quality rules: counted statistics, and robust multivariate outliers by minimum covariance determinant.

Every document has a vector of transformed statistics. For each language and source the vector's centre
and spread are estimated from the part of the documents that lie closest together (the minimum covariance determinant),
so bad documents don't widen what counts as usual; what lies too far by Mahalanobis distance is rejected.

The estimate follows the published fast algorithm for many rows: each group is dealt into blocks, a block
finds its best subset by concentration steps from several starts, the union of the blocks' subsets starts
the group, and concentration steps over all its rows follow. An estimate is drawn to that of the language and of the
corpus, the more the fewer documents it rests on. A step needs each group's distances in order: rows
are summed by distance bin, so a group of any size passes through map-side sums and meets as a bounded
number of bins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.components import stored
from faresight.llm.text import held_by, mix, slices, word_hashes, words_of

SEPARATORS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Statistics with the pseudo-counts that keep a short text's from straying, and the least spread taken for usual: what
#: counting a page of text lets them vary by. Signs that stand alone (a table's, a list's) are text; those on words are not.
FEATURES = ("log_word_length", "glued_symbol_rate", "dup_line_share", "repeat_share")
PRIOR_WORDS, PRIOR_LENGTH, PRIOR_SYMBOLS, PRIOR_LINES = 100, 6.0, 100, 10
FLOORS = np.array([0.05, 0.015, 0.03, 0.04])
SUBSET = 0.75                                 # share of a group that the estimate is made from
BLOCK_ROWS, STARTS, STEPS = 2048, 8, 2
SHRINK = 50                                   # documents that a group's language, or a language's corpus, counts for in its estimate
BINS = 32                                     # of distance, for each doubling
# Fixed values of the chi-squared distribution: of 4 degrees of freedom (the number of statistics), and for CONSISTENCY
# of 6 degrees at the 0.75 quantile of 4, 5.385269: the covariance of a normal vector's nearest rows is narrower than that of all.
CHI_LIMIT = 18.466827                         # at 0.999
CONSISTENCY = SUBSET / 0.504572               # over the chi-squared distribution function of 6 degrees at that quantile
CUTOFF = CHI_LIMIT ** 0.5                     # rejected beyond so many robust standard deviations
_ALONE = re.compile(f"(?<![^{SEPARATORS}])[{re.escape(SYMBOLS)}]+(?![^{SEPARATORS}])")
STATS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, n_glued long, n_alone long"


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, how many words lie in a window of five found twice or more in it. first: each text's first word (one more)."""
    counts, n = np.diff(first), len(hashes)
    if n < WINDOW:
        return np.zeros(len(counts), np.int64)
    own = np.repeat(np.arange(len(counts)), counts)
    m = n - WINDOW + 1
    key = own[:m].astype(np.uint64)
    for k in range(WINDOW):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[k:m + k])
    inside = np.flatnonzero(own[:m] == own[WINDOW - 1:])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = order[np.append(same, False) | np.append(False, same)] if len(order) else order
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    return np.bincount(own[np.cumsum(cover[:-1]) > 0], minlength=len(counts))


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    return len(lines), len(lines) - len(set(lines))


def symbol_counts(text: str) -> tuple[int, int, int]:
    """Symbols, how many of them are in words with other characters, and words that are symbols alone."""
    n = sum(map(text.count, SYMBOLS))
    alone = [m.end() - m.start() for m in _ALONE.finditer(text)] if n else []
    return n, n - sum(alone), len(alone)


def statistics(documents: DataFrame) -> DataFrame:
    """Counts over every whole text: doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, n_glued, n_alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                some = batch.slice(lo, hi - lo)
                texts = [t or "" for t in some.column("text").to_pylist()]
                data, starts, ends, first = words_of(texts)
                lines, symbols = [line_counts(t) for t in texts], [symbol_counts(t) for t in texts]
                columns = [np.diff(first), [len(t) - sum(map(t.count, SEPARATORS)) for t in texts], [n for n, _, _ in symbols],
                           [d for _, d in lines], [n for n, _ in lines], repeated_words(word_hashes(data, starts, ends), first), [g for _, g, _ in symbols], [a for _, _, a in symbols]]
                yield pa.RecordBatch.from_arrays([some.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(np.asarray(c, np.int64)) for c in columns],
                                                 names=[c.split()[0] for c in STATS.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                            F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(held_by("quality", run), STATS)


def features() -> list[Column]:
    words, alone = F.col("n_words"), F.col("n_symbols") - F.col("n_glued")
    return [F.log((F.col("word_chars") - alone + PRIOR_WORDS * PRIOR_LENGTH) / (words - F.col("n_alone") + PRIOR_WORDS)),
            F.col("n_glued") / (F.col("word_chars") + PRIOR_SYMBOLS),
            F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES),
            F.col("n_repeat_words") / (words + PRIOR_WORDS)]


def _key(level: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(level), *[e for c in columns for e in (F.col(c).isNull(), F.col(c))])


P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
SUMS = [f"s{i}" for i in range(1 + P + len(PAIRS))]


def _moments(x: np.ndarray) -> list[float]:
    return [float(len(x)), *x.sum(axis=0), *[float((x[:, i] * x[:, j]).sum()) for i, j in PAIRS]]


def _spread(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of what was summed."""
    n, s = max(moments[0], 1.0), moments[1:1 + P]
    mean, cov = s / n, np.zeros((P, P))
    for (i, j), v in zip(PAIRS, moments[1 + P:]):
        cov[i, j] = cov[j, i] = v / n - mean[i] * mean[j]
    return mean, cov


def _floored(cov: np.ndarray) -> np.ndarray:
    """A covariance (or many) whose variances are the floors at least."""
    variances = np.diagonal(cov, axis1=-2, axis2=-1)
    return cov + np.maximum(FLOORS ** 2 - variances, 0)[..., None] * np.eye(P) + 1e-9 * np.eye(P)


def _estimate(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean, cov = _spread(moments)
    return mean, _floored(cov)


def _distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d)


def best_subset(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Rows of the subset with the least determinant: concentration steps from several starts, each until it stays."""
    n = len(x)
    h, rng = max(1, int(np.ceil(SUBSET * n))), np.random.default_rng(seed)
    middle = np.median(x, axis=0)
    starts = [np.argsort((((x - middle) / FLOORS) ** 2).sum(axis=1), kind="stable")[:max(1, n // 2)]]
    starts += [rng.choice(n, min(n, P + 2), replace=False) for _ in range(STARTS - 1)]
    best, least = np.arange(n), np.inf
    for rows in starts:
        for _ in range(12):
            mean, cov = _estimate(np.array(_moments(x[rows])))
            new = np.sort(np.argsort(_distances(x, mean, cov), kind="stable")[:h])
            if len(new) == len(rows) and (new == rows).all():
                break
            rows = new
        size = np.linalg.slogdet(_estimate(np.array(_moments(x[rows])))[1])[1]
        if size < least:
            best, least = rows, size
    return best


MEANS, SPREADS, PRECISIONS = [f"m{i}" for i in range(P)], [f"c{i}{j}" for i, j in PAIRS], [f"p{i}{j}" for i, j in PAIRS]
_PARAMETER_SCHEMA = "g long, n double, " + ", ".join(f"{c} double" for c in MEANS + SPREADS + PRECISIONS)


def _precision(cov: np.ndarray) -> list[np.ndarray]:
    """The inverse of a floored covariance (or of many), as factors of the products of differences."""
    inverse = np.linalg.inv(_floored(cov))
    return [inverse[..., i, j] * (1 if i == j else 2) for i, j in PAIRS]


def _parameters(g: int, n: float, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame([[g, n, *mean, *[cov[i, j] for i, j in PAIRS], *_precision(cov)]], columns=["g", "n", *MEANS, *SPREADS, *PRECISIONS])


def _distance() -> Column:
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    return sum((F.col(f"p{i}{j}") * d[i] * d[j] for i, j in PAIRS), F.lit(0.0))


def _concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    """New estimate of a group from the sums by distance bin: the nearest share of its rows, the last bin in part."""
    sums = bins.sort_values("bin")[SUMS].to_numpy()
    n = sums[:, 0]
    take = np.clip((SUBSET * n.sum() - (np.cumsum(n) - n)) / n, 0, 1)
    mean, cov = _spread((sums * take[:, None]).sum(axis=0))
    return _parameters(int(bins["g"].iloc[0]), float(n.sum()), mean, CONSISTENCY * cov)


def estimates(rows: DataFrame) -> DataFrame:
    """Rows, centre, spread and precision of each group g of ``rows`` (g, row, x0 ...)."""
    xs = [f"x{i}" for i in range(P)]
    # Written, so that its size is known when the rows are joined: they are not dealt out by group for a table of groups.
    blocks = stored(rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks")), "blocks")

    def subset(block: pd.DataFrame) -> pd.DataFrame:
        x = block.sort_values("row")[xs].to_numpy()
        return pd.DataFrame([[block["g"].iloc[0], *_moments(x[best_subset(x)])]], columns=["g", *SUMS])

    def begin(sums: pd.DataFrame) -> pd.DataFrame:
        mean, cov = _spread(sums[SUMS].to_numpy()[0])
        return _parameters(int(sums["g"].iloc[0]), float(sums["s0"].iloc[0]), mean, CONSISTENCY * cov)

    schema = "g long, " + ", ".join(f"{s} double" for s in SUMS)
    dealt = rows.join(blocks, "g").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    start = dealt.groupBy("g", "block").applyInPandas(subset, schema).groupBy("g").agg(*[F.sum(s).alias(s) for s in SUMS])
    now = stored(start.groupBy("g").applyInPandas(begin, _PARAMETER_SCHEMA), "mcd")
    for _ in range(STEPS):
        binned = rows.join(now.drop("n"), "g").withColumn("bin", F.floor(F.log2(1 + F.greatest(_distance(), F.lit(0.0))) * BINS))
        terms = [F.lit(1.0), *[F.col(x) for x in xs], *[F.col(f"x{i}") * F.col(f"x{j}") for i, j in PAIRS]]
        now = stored(binned.groupBy("g", "bin").agg(*[F.sum(t).alias(s) for t, s in zip(terms, SUMS)]).groupBy("g").applyInPandas(_concentrate, _PARAMETER_SCHEMA), "mcd")
    return now


def shrunk(n: np.ndarray, mean: np.ndarray, cov: np.ndarray, to_mean: np.ndarray, to_cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of groups of n documents, drawn towards wider ones as if SHRINK documents of those were among them."""
    own = (n / (n + SHRINK))[:, None]
    apart = mean - to_mean
    spread = own[..., None] * cov + (1 - own[..., None]) * to_cov + (own * (1 - own))[..., None] * apart[:, :, None] * apart[:, None, :]
    return own * mean + (1 - own) * to_mean, spread


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The estimate by which the documents of each (lang, source) are judged: its own drawn to its language's, that drawn to the corpus's."""
    for rows in batches:
        mean, cov = np.zeros((len(rows), P)), np.broadcast_to(np.diag(FLOORS ** 2), (len(rows), P, P))
        for level in (2, 1, 0):
            of = lambda names: rows[[f"{c}_{level}" for c in names]].fillna(0.0).to_numpy(float)  # noqa: E731, B023
            n, own, flat = of(["n"])[:, 0], of(MEANS), of(SPREADS)
            spread = np.zeros((len(rows), P, P))
            for k, (i, j) in enumerate(PAIRS):
                spread[:, i, j] = spread[:, j, i] = flat[:, k]
            mean, cov = shrunk(n, own, spread, own if level == 2 else mean, cov)
        found = pd.DataFrame(np.column_stack([mean, *_precision(cov)]), columns=MEANS + PRECISIONS)
        yield pd.concat([rows["pair"].reset_index(drop=True), found], axis=1)


def quality(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept, for every document.

    A null text has no words and fails the base rules. Null languages and sources are groups like others. Every
    group has an estimate, the fewer its documents the nearer to its language's, and that to the corpus's; so
    verdicts change gradually with a group's size. Base failures are left out of the estimates; where all documents are
    such, no distance is known (null). Repeated rows count each; an empty table gives an empty result; other columns are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = stored(statistics(documents).withColumns({"base_failed": failed, **{f"x{i}": f for i, f in enumerate(features())},
                                                     "row": F.monotonically_increasing_id(), "pair": _key(0, "lang", "source")}), "quality")
    keys = [F.col("pair"), _key(1, "lang"), _key(2)]
    xs = [f"x{i}" for i in range(P)]
    found = estimates(rows.filter(~F.col("base_failed")).select("row", *xs, F.explode(F.array(*keys)).alias("g")))
    pairs = rows.select("lang", "source", "pair").distinct().select("pair", *[k.alias(f"g{i}") for i, k in enumerate(keys)])
    for i in range(len(keys)):
        pairs = pairs.join(found.select(F.col("g").alias(f"g{i}"), *[F.col(c).alias(f"{c}_{i}") for c in ["n", *MEANS, *SPREADS]]), f"g{i}", "left")
    schema = "pair long, " + ", ".join(f"{c} double" for c in MEANS + PRECISIONS)
    limits = stored(pairs.filter("n_2 IS NOT NULL").mapInPandas(_combined, schema), "groups")
    judged = rows.join(limits, "pair", "left")
    distance = F.when(F.col("m0").isNotNull(), F.sqrt(F.greatest(_distance(), F.lit(0.0))))
    return judged.withColumn("distance", distance).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))).alias("kept"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
