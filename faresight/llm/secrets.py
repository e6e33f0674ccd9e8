"""Secret scans: fixed patterns, and a randomness test battery under length-aware false-discovery control.

Besides the patterns, every long enough run of key characters is a candidate; of a run that patterns cover in
part, what they leave. Its encoding is the narrowest alphabet that holds its characters. Three tests say how
unlikely the run is as language (words, names, paths, dates; letters of any case alike):

* uniformity: the chi-squared statistic of the alphabet's symbols against their shares in language. It must also
  be no surprise if all symbols of the alphabet are equally likely: fill characters and repeats are not random;
* runs: how often the character class (lower, upper, digit) changes, for runs of several classes. A capital
  before small letters begins a word and is no change;
* serial correlation: vowels and consonants alternate in language, and neighbouring digits of numbers are near
  each other, more often than in random characters.

The p-values (small: too random for language) are combined by Fisher's method. Within each document,
Benjamini-Hochberg control with weights in proportion to length accepts candidates: a long run has
better evidence and may spend more of the allowance than a short one.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from faresight.llm.text import held_by

# The patterns' definitions. Letters of the first match in either ASCII case.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINT = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

MIN_LENGTH = 20                               # of a candidate
FALSE_DISCOVERIES = 0.01                      # accepted share
UNEVEN = 1e-3                                 # a run whose symbols are less likely than this to be evenly drawn is not random
CHANGE = 0.18                                 # chance that the class changes within language
ALTERNATE = 0.58                              # chance that neighbouring letters are a vowel and a consonant, or digits at most one apart
FEW = 4                                       # letters, digits or neighbours that a test needs
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
# Shares (per mille) of the letters a to z in names and words of English, French, Spanish and German, and
# shares (per cent) of the digits 0 to 9 in dates, versions and counts.
LETTER_SHARES = (80, 18, 38, 42, 118, 20, 22, 30, 68, 4, 9, 45, 32, 70, 60, 28, 4, 64, 70, 72, 38, 14, 13, 6, 13, 5)
DIGIT_SHARES = (26, 20, 18, 9, 8, 7, 6, 5, 4, 3)
_UPPER, _LOWER, _DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
#: Alphabets from narrow to wide; the last one takes what is left.
ENCODINGS = (("digits", _DIGITS), ("hex", _DIGITS + "abcdef"), ("hex", _DIGITS + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER), ("base32", _UPPER + "234567"),
             ("base36", _DIGITS + _LOWER), ("base36", _DIGITS + _UPPER), ("letters", _UPPER + _LOWER), ("base62", _DIGITS + _UPPER + _LOWER),
             ("base64", _DIGITS + _UPPER + _LOWER + "+/_-="))

Span = tuple[int, int, str]                   # begin, end (code points), kind


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns by begin, then kind as listed."""
    found: list[Span] = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINT):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def encoding_of(run: str) -> tuple[str, str]:
    """The narrowest encoding whose alphabet holds all characters of ``run``."""
    used = set(run)
    return next(((name, alphabet) for name, alphabet in ENCODINGS if used <= set(alphabet)), ENCODINGS[-1])


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _exceeds(x: float, mean: float, variance: float) -> float:
    """Chance that a gamma variable of this mean and variance is beyond x (by the normality of its cube root)."""
    k = 9 * mean * mean / variance
    return _upper(((max(x, 0.0) / mean) ** (1 / 3) - (1 - 1 / k)) * math.sqrt(k))


def _chi_squared(counts: np.ndarray, shares: np.ndarray) -> tuple[float, float, float]:
    """The statistic of counts against shares, and its exact mean and variance if those are right."""
    n, k = float(counts.sum()), len(shares)
    x = float(((counts - n * shares) ** 2 / (n * shares)).sum())
    return x, k - 1, 2 * (k - 1) + (float((1 / shares).sum()) - k * k - 2 * k + 2) / n


def _shares(values: tuple[int, ...]) -> np.ndarray:
    return np.array(values) / sum(values)


def p_even(run: str) -> float:
    """Chance that symbols drawn evenly from the inferred alphabet are spread as unevenly as those of ``run``. Fill at the end is passed over."""
    run = run.rstrip("=") or run
    alphabet = encoding_of(run)[1]
    counts = np.array([run.count(c) for c in alphabet])
    return _exceeds(*_chi_squared(counts, np.full(len(alphabet), 1 / len(alphabet))))


def p_language(run: str) -> float:
    """Chance that language looks as random as ``run``: the tests that apply to it, combined by Fisher's method."""
    codes = np.frombuffer(run.encode("ascii"), np.uint8).astype(np.int64)
    is_upper, is_digit = (codes >= 65) & (codes <= 90), (codes >= 48) & (codes <= 57)
    folded = np.where(is_upper, codes + 32, codes)
    is_letter = (folded >= 97) & (folded <= 122)
    tests = []
    parts = [_chi_squared(np.bincount(of - first, minlength=len(values)), _shares(values))
             for of, first, values in ((folded[is_letter], 97, LETTER_SHARES), (codes[is_digit], 48, DIGIT_SHARES)) if len(of) >= FEW]
    if parts:
        tests.append(_exceeds(*map(sum, zip(*parts))))
    kind = np.where(is_digit, 2, np.where(is_upper, 1, np.where(is_letter, 0, 3)))
    before, after = kind[:-1], kind[1:]
    steps = int(((before < 3) & (after < 3)).sum())                      # signs part the words of names and paths
    if len(set(kind.tolist()) - {3}) > 1 and steps:
        changes = int(((before < 3) & (after < 3) & (before != after) & ~((before == 1) & (after == 0))).sum())
        tests.append(_upper((changes - 0.5 - CHANGE * steps) / math.sqrt(steps * CHANGE * (1 - CHANGE))))
    vowel = np.isin(folded, [ord(c) for c in "aeiou"])
    letters, digits = is_letter[:-1] & is_letter[1:], is_digit[:-1] & is_digit[1:]
    turns = int((letters & (vowel[:-1] != vowel[1:])).sum() + (digits & (np.abs(np.diff(codes)) <= 1)).sum())
    n = int(letters.sum() + digits.sum())
    if n >= FEW:
        tests.append(_upper((ALTERNATE * n - turns - 0.5) / math.sqrt(n * ALTERNATE * (1 - ALTERNATE))))
    x = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-x) * sum(x ** i / math.factorial(i) for i in range(len(tests))) if tests else 1.0


def p_value(run: str) -> float:
    return p_language(run) if p_even(run) >= UNEVEN else 1.0


def accepted(p_values: list[float], lengths: list[int], share: float = FALSE_DISCOVERIES) -> list[bool]:
    """Weighted Benjamini-Hochberg: weights in proportion to length, with mean 1."""
    if not p_values:
        return []
    p = np.array(p_values) * np.mean(lengths) / np.array(lengths)
    order = np.argsort(p, kind="stable")
    below = np.flatnonzero(p[order] <= share * np.arange(1, len(p) + 1) / len(p))
    out = np.zeros(len(p), bool)
    out[order[:below[-1] + 1 if len(below) else 0]] = True
    return out.tolist()


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Runs of key characters, and of those that base spans cover in part, what they leave, if it is long enough."""
    found, k = [], 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(base) and base[k][1] <= at:
            k += 1
        i = k
        while i < len(base) and base[i][0] < end:
            found += [(at, base[i][0])] if base[i][0] - at >= MIN_LENGTH else []
            at, i = max(at, base[i][1]), i + 1
        found += [(at, end)] if end - at >= MIN_LENGTH else []
    return found


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a whole text."""
    base = base_spans(text)
    some = candidates(text, base)
    keep = accepted([p_value(text[a:b]) for a, b in some], [b - a for a, b in some])
    extra = [(a, b, "random") for (a, b), k in zip(some, keep) if k]
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))


def say(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``."""
    out, at = [], 0
    for a, b, _ in spans:
        if b > at:
            out += [text[at:a], mark] if a >= at else []
            at = b
    return "".join([*out, text[at:]])


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, of every whole text.

    A null text is empty; null or repeated doc_ids and repeated rows give a row each; an empty table gives
    an empty result; other columns are ignored.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, spans = scan(text.as_py() or "")
                kinds = [s[2] for s in base]
                rows.append((*map(kinds.count, KINDS[:3]), hashlib.sha256(say(base).encode()).hexdigest(), say(spans)))
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64())] + [pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return documents.select("doc_id", "text").mapInArrow(held_by("secrets", run), schema)


def redact_documents(documents: DataFrame) -> DataFrame:
    """The same rows and columns with secrets in ``text`` replaced by ``[SECRET]``; texts without any are unchanged, null ones null.

    Repeated rows are changed alike; an empty table gives an empty result; other columns are kept whatever they are.
    """
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redact(t, scan(t)[1]) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return documents.mapInArrow(held_by("secrets", run), documents.schema)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
