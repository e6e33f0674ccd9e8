import random
import re

import numpy as np

from faresight.llm import quality

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORDS.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    cover = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover), n < 10 or 100 * len(cover) > 20 * n


def document(rnd, n, junk=False):
    w = ["".join(rnd.choice("abcdefgh é"[:9]) for _ in range(rnd.randint(2, 9))) + ("$$$" if junk else "") for _ in range(n)]
    return " ".join(w)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, g int")


def test_counts_equal_brute_force(spark):
    rnd = random.Random(1)
    texts = [None, "", "a b c d e", "a b c d e " * 3, "x\nx\n \n\nx y\n x", "|#|\n<>&", "é " * 30, "a b c d e f a b c d e g h i j k l m n o p q r s t u v w x y z 1 2 3"]
    texts += ["".join(rnd.choice("ab \n\t#x") for _ in range(rnd.randint(0, 120))) for _ in range(120)]
    got = quality.quality(frame(spark, [(i, t, "l", None) for i, t in enumerate(texts)])).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert r.kept <= (not r.base_failed) and r.distance is not None
    assert len(got) == len(texts)


def test_outliers_go_and_others_stay(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_ROWS", 100)
    rnd = random.Random(2)
    rows = []
    for i in range(900):
        junk = i % 11 == 0
        rows.append((i, document(rnd, rnd.choice([12, 40, 150]) if not junk else 80, junk), "l", ["s", None, f"few{i}"][i % 30 // 14]))
    got = {r.doc_id: r for r in quality.quality(frame(spark, rows)).collect()}
    assert len(got) == 900 and all(r.distance is not None for r in got.values())
    assert all(got[i].kept == (i % 11 != 0) for i in got if not got[i].base_failed)


def test_odd_tables(spark):
    rows = [(None, "a b", None, None), (1, None, None, "s"), (1, "w " * 60_000, "x", "s")] + [(2, "one two three four five six seven eight nine ten", None, None)] * 3
    got = quality.quality(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [(0, 2, False), (1, 0, False), (1, 60_000, False), (2, 10, True), (2, 10, True), (2, 10, True)]
    assert quality.quality(frame(spark, [])).count() == 0


def plain(x, seed=0):
    """The estimate of a group of one block: subset, then two steps over all rows in order of distance (by the same bins)."""
    def spread(part):
        m = part.mean(axis=0)
        return m, (part - m).T @ (part - m) / len(part)

    def floored(c):
        return c + np.diag([max(f * f - v, 0) + 1e-9 for f, v in zip(quality.FLOORS, np.diag(c))])

    mean, cov = spread(x[quality.best_subset(x)])
    for _ in range(quality.STEPS):
        d = [(r - mean) @ np.linalg.inv(floored(quality.CONSISTENCY * cov)) @ (r - mean) for r in x]
        bins = np.array([int(np.floor(np.log2(1 + v) * quality.BINS)) for v in d])
        left, weight = quality.SUBSET * len(x), np.zeros(len(x))
        for b in sorted(set(bins)):
            share = min(1.0, left / (bins == b).sum())
            weight[bins == b] = share
            left -= share * (bins == b).sum()
            if left <= 1e-12:
                break
        mean = weight @ x / weight.sum()
        cov = (x - mean).T @ ((x - mean) * weight[:, None]) / weight.sum()
    return len(x), mean, quality.CONSISTENCY * cov


def test_distance_and_verdict_equal_a_plain_version(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(260):
        lang, source = rnd.choice([("a", "s"), ("a", "s"), ("a", "t"), ("b", "s"), (None, None)])
        if i in (3, 4):
            lang, source = "b", "once"
        text = document(rnd, rnd.randint(12, 200), junk=i % 13 == 0)
        rows.append((i, text + ("\nsame line\nsame line" if i % 9 == 0 else ""), lang, source))
    got = {r.doc_id: r for r in quality.quality(frame(spark, rows)).collect()}
    vectors = {}
    for i, text, lang, source in rows:
        n, chars, _, dup, repeated, failed = brute(text)
        if not failed:
            words = WORDS.findall(text)
            glued = sum(sum(c in quality.SYMBOLS for c in w) for w in words if any(c not in quality.SYMBOLS for c in w))
            lines = sum(bool(WORDS.search(x)) for x in text.split("\n"))
            spoken = [w for w in words if any(c not in quality.SYMBOLS for c in w)]
            vectors[i] = np.array([np.log((sum(map(len, spoken)) + 600) / (len(spoken) + 100)), glued / (chars + 100), dup / (lines + 10), repeated / (n + 100)])
    order = sorted(vectors)                   # rows of a small table come in the order of doc_id
    def group(*keys):
        return np.array([vectors[i] for i in order if keys == tuple(rows[i][2:2 + len(keys)])])
    for i in order:
        levels = [plain(group()), plain(group(rows[i][2])), plain(group(*rows[i][2:]))]
        mean, cov = levels[0][1], np.diag(quality.FLOORS ** 2)
        for n, m, c in levels:
            w, apart = n / (n + quality.SHRINK), m - mean
            cov = w * c + (1 - w) * cov + w * (1 - w) * np.outer(apart, apart)
            mean = w * m + (1 - w) * mean
        cov = cov + np.diag([max(f * f - v, 0) + 1e-9 for f, v in zip(quality.FLOORS, np.diag(cov))])
        d = float(np.sqrt((vectors[i] - mean) @ np.linalg.inv(cov) @ (vectors[i] - mean)))
        assert abs(got[i].distance - d) < 1e-6 * max(d, 1) and got[i].kept == (d <= quality.CUTOFF), i
    assert sum(not r.kept and not r.base_failed for r in got.values()) >= 15


def test_planted_kinds_go_and_clean_texts_stay(spark):
    """Signs on words, doubled words, repeated lines, letter noise; tables and short texts are clean. Groups of 3 to 900 documents."""
    rnd = random.Random(9)
    sounds = "the of and ing tion er re on at en nd st es or ti he ha ou ea th".split()
    word = lambda: "".join(rnd.choices(sounds, k=rnd.randint(1, 4)))
    line = lambda: " ".join(word() for _ in range(rnd.randint(6, 14)))
    text = lambda: "\n".join(line() for _ in range(rnd.randint(4, 30)))
    spoil = {"signs": lambda t: re.sub(r"(\S+)", r"\1#", t), "double": lambda t: re.sub(r"(\S+)", r"\1\1", t),
             "lines": lambda t: "\n".join(x for k, x in enumerate(t.split("\n")) for _ in range(2 if k % 3 else 1)), "noise": lambda t: re.sub(r"\S+", lambda m: m.group() * 3, t)}
    rows, kinds = [], []
    for i in range(1500):
        kind = rnd.choice([*spoil, "table", "short"]) if i % 10 == 0 else "plain"
        t = text()
        t = spoil[kind](t) if kind in spoil else " | ".join(t.split()[:60]) if kind == "table" else t[:80] if kind == "short" else t
        rows.append((i, t, "l", rnd.choice(["big"] * 30 + ["mid"] * 3 + [f"few{k}" for k in range(3)])))
        kinds.append(kind)
    got = {r.doc_id: r.kept for r in quality.quality(frame(spark, rows)).collect()}
    share = lambda wanted: np.mean([got[i] for i, k in enumerate(kinds) if k in wanted])
    assert all(share([k]) <= 0.1 for k in spoil) and share(["plain"]) >= 0.97 and share(["table"]) >= 0.9 and share(["short"]) >= 0.9


def test_no_jump_at_any_size(spark):
    """A group's estimate moves gradually from its language's to its own as it grows."""
    n = np.arange(0.0, 2000)
    mean, cov = quality.shrunk(n, np.tile([1.0, 0, 0, 0], (2000, 1)), np.tile(np.eye(4), (2000, 1, 1)), np.zeros((2000, 4)), np.tile(np.diag(quality.FLOORS ** 2), (2000, 1, 1)))
    assert mean[0, 0] == 0 and mean[-1, 0] > 0.97 and 0 < np.diff(mean[:, 0]).max() <= 1 / quality.SHRINK
    assert np.abs(np.diff(cov[:, 0, 0])).max() < 2 / quality.SHRINK


def test_subset_leaves_outliers_out():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, quality.P)) * quality.FLOORS * 3
    x[:80] += 2
    rows = quality.best_subset(x)
    assert len(rows) == 300 and rows.min() >= 80
    mean, cov = quality._estimate(np.array(quality._moments(x[rows])))
    far = quality._distances(x, mean, cov)
    assert far[:80].min() > far[80:].max()


def test_covariance_is_consistent():
    """A normal vector's spread comes out right, though it is estimated from the nearest part."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (2000, quality.P)) * [1.0, 0.5, 2.0, 0.8]
    _, _, cov = plain(x)
    assert np.allclose(np.sqrt(np.diag(cov)), [1.0, 0.5, 2.0, 0.8], rtol=0.08)
