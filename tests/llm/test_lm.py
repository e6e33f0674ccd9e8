import math
import random
import re
import zlib

import numpy as np
import pytest

from faresight.llm import gru, lm

WORDS = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tokens(text):
    return [*WORDS.findall(lower(text or "")), None]


def out_of_training(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def brute(rows):
    counts = {}
    for doc_id, text in rows:
        if not out_of_training(doc_id):
            for t in tokens(text):
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    return sorted(((d, out_of_training(d), len(tokens(t)), sum(x in counts for x in tokens(t)), n,
                    round(sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in tokens(t)), 6)) for d, t in rows), key=repr)


def corpus(n=150):
    rnd = random.Random(2)
    follow = {w: rnd.choice(["alpha", "beta", "gamma", "delta"]) for w in ("alpha", "beta", "gamma", "delta")}
    rows = []
    for i in range(n):
        w = [rnd.choice(list(follow))]
        for _ in range(rnd.choice([3, 20, 90])):
            w.append(follow.get(w[-1], "alpha") if rnd.random() < 0.9 else rnd.choice([*follow, f"rare{rnd.randrange(500)}", "É", "e"]))
        rows.append((i, " ".join(w) if i % 3 else "\n".join(w).upper()))
    return rows


def scored(spark, rows, **small):
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(3)
    return lm.score(df, ~lm.held_out()).collect()


def base(got):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 6)
    monkeypatch.setattr(lm, "VOCABULARY", 5)


def test_base_scores_equal_brute_force(spark, small):
    rows = corpus()
    assert base(scored(spark, rows)) == brute(rows)


def test_network_learns_what_follows(monkeypatch):
    monkeypatch.setattr(gru, "LANES", 16)
    names = {w: i for i, w in enumerate([None, "unknown", "alpha", "beta", "gamma", "delta"])}
    ids = [np.array([names.get(t, 1) for t in tokens(text)], np.int32) for _, text in corpus(900)]
    counts = np.bincount(np.concatenate(ids[:800]), minlength=6)
    trainer = gru.Trainer(gru.start(counts))
    for lo in range(0, 800, 50):
        trainer.learn(ids[lo:lo + 50])
    before, after = (gru.log_probabilities(p, ids[800:]).sum() for p in (gru.start(counts), trainer.p))
    assert after > 0.9 * before


def test_training_reaches_the_scores(spark):
    got = [r for r in scored(spark, corpus(600)) if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


@pytest.mark.parametrize("doc_id", [1, 2, 3])
def test_every_document_trains_the_network(spark, doc_id):
    """Whichever document it is, and however few tokens it has."""
    df = spark.createDataFrame([(doc_id, "one two three one two")], "doc_id long, text string")
    vocab = lm.vocabulary(lm.word_counts(df))
    rows = lm.encoded(df.selectExpr("*", "false held_out", "true learns"), vocab)
    before, after = gru.start(vocab.by_id), lm.train(rows, vocab)
    assert any((before[k] != after[k]).any() for k in before)


def test_odd_rows(spark, small):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "x " * 40_000), (4, "unseen"), (16, "unseen Unseen"), (None, None)]
    got = scored(spark, rows)
    assert base(got) == brute(rows) and all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert scored(spark, []) == []
    alone = next(i for i in range(100) if out_of_training(i))
    (only,) = scored(spark, [(alone, "nothing to learn from")])
    assert (only.n_known, only.train_tokens, only.base_score) == (0, 0, 0.0) and math.isfinite(only.score)


def test_chances_of_all_words_add_up():
    p = gru.start(np.array([5, 9, 8, 4, 4, 1]))
    ends = [np.array([2, w], np.int32) for w in range(6)]
    first = gru.log_probabilities(p, [np.array([2], np.int32)])[0]
    assert abs(np.exp(gru.log_probabilities(p, ends) - first).sum() - 1) < 1e-3


def test_mean_of_trainers_is_summed_by_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    w, n = rng.normal(size=(20, 7)), rng.integers(1, 50, 20)
    rows = spark.createDataFrame([(bytearray((v * k).astype("<f8").tobytes()), int(k)) for v, k in zip(w, n)], "w binary, n long")
    assert np.allclose(lm._mean(rows), (w * n[:, None]).sum(axis=0) / n.sum()) and lm._mean(rows.limit(0)) is None


def test_parts_hold_every_token_with_the_one_before(monkeypatch):
    monkeypatch.setattr(gru, "PART", 5)
    documents = [np.arange(100 * k, 100 * k + n) for k, n in enumerate((0, 1, 5, 6, 17), 1)]
    parts, before = gru.parts_of(documents)
    assert sorted(np.concatenate(parts).tolist()) == sorted(np.concatenate(documents).tolist()) and [len(p) for p in parts] == sorted((len(p) for p in parts), reverse=True)
    for p, b in zip(parts, before):
        assert b == (gru.END if p[0] % 100 == 0 else p[0] - 1)
    inputs, targets, _ = next(gru._windows(parts, before))
    assert (inputs[0] == before).all() and (targets[0] == [p[0] for p in parts]).all()


def plain_log_probability(p, ids):
    """The forward pass of one document, number by number."""
    h, total = [0.0] * gru.HIDDEN, 0.0
    dot = lambda x, m, j: sum(a * float(m[i][j]) for i, a in enumerate(x))
    soft = lambda scores, k: scores[k] - max(scores) - math.log(sum(math.exp(s - max(scores)) for s in scores))
    for before, wanted in zip([gru.END, *ids[:-1]], ids):
        x = [float(v) for v in p["embed"][before]]
        n = gru.HIDDEN
        z, r, c = ([dot(x, p["w"], g * n + j) + float(p["b"][g * n + j]) for j in range(n)] for g in range(3))
        u = [[dot(h, p["u"], g * n + j) for j in range(n)] for g in range(3)]
        z, r = ([1 / (1 + math.exp(-(a + b))) for a, b in zip(own, u[g])] for g, own in enumerate((z, r)))
        c = [math.tanh(a + k * b) for a, k, b in zip(c, r, u[2])]
        h = [(1 - k) * new + k * old for k, new, old in zip(z, c, h)]
        kind, word = divmod(int(wanted), gru.WIDTH)
        total += soft([dot(h, p["cw"], j) + float(p["cb"][j]) for j in range(len(p["cb"]))], kind)
        total += soft([dot(h, p["ow"][kind], j) + float(p["ob"][kind][j]) for j in range(gru.WIDTH)], word)
    return total


def test_forward_pass_equals_a_plain_one():
    rng = np.random.default_rng(4)
    p = gru.start(np.sort(rng.integers(1, 100, 150))[::-1].copy())
    p = {k: v if k in ("cb", "ob") else v * 4 for k, v in p.items()}
    documents = [rng.integers(0, 150, n).astype(np.int32) for n in (1, 5, 40, 70)]
    assert np.allclose(gru.log_probabilities(p, documents), [plain_log_probability(p, d) for d in documents], rtol=1e-4)


def test_rows_far_below_the_bound_of_the_scores():
    """Scores that the weights allow to be 400 apart: the rows far below that are shifted by their own largest score."""
    w = np.zeros((3, 4), np.float32)
    w[0, 0], w[2] = 400, [-400, 0, -1, -1e4]
    states = np.array([[1, 0, 1], [-1, 0.5, 1], [0.5, 0, 1]], np.float32)
    targets = np.array([0, 2, 1])
    logp, d = gru._softmax(states, w, targets, True)
    scores = states.astype(float) @ w
    wanted = scores - scores.max(axis=1, keepdims=True)
    wanted -= np.log(np.exp(wanted).sum(axis=1, keepdims=True))
    assert np.allclose(logp, wanted[np.arange(3), targets], atol=1e-5)
    assert np.allclose(d, np.exp(wanted) - np.eye(4)[targets], atol=1e-6)


def test_state_carries_over_windows(monkeypatch):
    rng = np.random.default_rng(0)
    p = gru.start(np.arange(50, 0, -1))
    documents = [rng.integers(0, 50, n).astype(np.int32) for n in (0, 1, 31, 32, 33, 64, 65, 200)]
    whole = gru.log_probabilities(p, documents)
    monkeypatch.setattr(gru, "STEPS", 1000)
    assert np.allclose(whole, gru.log_probabilities(p, documents), rtol=1e-4)


def test_gradients():
    rng = np.random.default_rng(0)
    trainer = gru.Trainer(gru.start(np.sort(rng.integers(1, 100, 100))[::-1].copy()))
    trainer.p = {k: np.maximum(v.astype(float) * 3, -50) for k, v in trainer.p.items()}
    trainer.grads = {k: np.zeros_like(v) for k, v in trainer.p.items()}
    documents = sorted((rng.integers(0, 100, n) for n in (9, 20, 3, 31)), key=len, reverse=True)
    trainer.learn(documents)
    for k, v in trainer.p.items():
        for _ in range(5):
            i = tuple(rng.integers(0, s) for s in v.shape)
            i = (documents[0][0], i[1]) if k == "embed" else i
            losses = []
            for e in (0.01, -0.02):
                v[i] += e
                losses.append(-gru.log_probabilities(trainer.p, documents).sum())
            v[i] += 0.01
            assert abs((losses[0] - losses[1]) / 0.02 - trainer.grads[k][i]) < 0.02 + 0.01 * abs(trainer.grads[k][i]), (k, i)
