import random

import numpy as np

from faresight.llm import language

SOUNDS = {"aa": "ka lu mo wi pao nui", "bb": "sch tz ich pf ung ßen", "cc": "ción ñu ez rra llo que", "dd": "eau oux è ç ille ment"}


def corpus(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice([*SOUNDS, "aa", "aa", "aa"])
        sounds = SOUNDS[lang].split()
        rows.append((i, " ".join("".join(rnd.choices(sounds, k=rnd.randint(1, 4))) for _ in range(rnd.randint(5, 60))), lang, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string"), {r[0]: r[2] for r in rows}


def test_held_out_accuracy(spark):
    df, truth = corpus(spark)
    model = language.train(df.filter(~language.held_out()))
    got = language.identify(df, model).collect()
    assert len(got) == 400 and all(0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert 80 < len(out) < 190 and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F
    df, _ = corpus(spark, 120)
    other = df.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("lang_pred", F.lit("q"))
    runs = [sorted(map(tuple, language.identify(d, language.train(d.filter(~language.held_out()))).collect())) for d in (df, other)]
    assert runs[0] == runs[1]


def test_odd_rows(spark):
    df, _ = corpus(spark, 90)
    model = language.train(df)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 -- 😀"), (None, "ción que"), (4, "schtz " * 60_000), (4, "schtz"), (4, "schtz")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.lang_pred, r.score > 0) for r in language.identify(odd, model).collect()))
    assert got == [(0, "cc", True), (1, "und", False), (2, "und", False), (3, "und", False), (4, "bb", True), (4, "bb", True), (4, "bb", True)]
    assert language.with_language(odd, model).count() == 4
    assert language.identify(odd.limit(0), model).count() == 0
    none = language.train(df.limit(0))
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}
    one = language.train(df.filter("lang = 'bb'"))
    assert {r.lang_pred for r in language.identify(df, one).collect()} == {"bb"}


def test_texts_stay_where_nothing_could_be_learned(spark):
    rows = [(1, "some words", None), (2, "é", None), (3, "12 --", None), (4, None, None), (None, "x1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.with_language(df, language.train(df)).collect()
    assert sorted(r.text for r in got) == ["some words", "x1", "é"]


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 8, 40):
        code = language.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2 + 1000 * np.eye(n)
        assert code.shape[0] == n and apart.min() >= (1 if n == 2 else 2), n
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_wrong_bits_are_corrected():
    """A codeword with a flipped bit is still nearest to its own language, and flagged only beyond the correction radius."""
    code = language.codewords(4)
    model = language.Model(list("abcd"), code, np.zeros((language.BUCKETS, code.shape[1]), np.float32), np.ones(code.shape[1]))
    for row in range(4):
        for bit in range(code.shape[1]):
            margin = code[row].copy()
            margin[bit] *= -1
            model.margins = lambda texts, m=margin: (m[None] * 0.3, np.array([100]))
            names, _, unclear = model.predict(["x"])
            assert names == ["abcd"[row]] and not unclear[0]


def noise(rnd, n):
    return " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(n))


def test_verdict_rejects_what_a_letter_test_would_keep(spark):
    """Letter noise and scripts that no row teaches go; held-out documents of the languages stay, short ones too."""
    df, _ = corpus(spark)
    train = df.filter(~language.held_out())
    model = language.calibrated(train, language.train(train))
    held = [r.text for r in df.filter(language.held_out()).collect()]
    assert model.speaks(held).mean() >= 0.99 and model.speaks([t[:40] for t in held]).mean() >= 0.97
    rnd = random.Random(6)
    bad = [noise(rnd, n) for n in (20, 40, 200) for _ in range(30)] + ["吾輩は猫である。名前はまだ無い。" * 4, "Съешь же ещё этих мягких французских булок " * 3]
    assert all(any(map(str.isalpha, t)) for t in bad) and model.speaks(bad).mean() <= 0.02
    assert not model.speaks([None, "", "12 --"]).any() and len(model.speaks([])) == 0
    mixed = spark.createDataFrame([(i, t, {"a": 1}) for i, t in enumerate(held[:20] + bad[:20])], "doc_id long, text string, more map<string,int>")
    got = language.with_language(mixed, model)
    assert got.columns == mixed.columns and sorted(r.doc_id for r in got.collect()) == list(range(20))


def test_limits_follow_all_labelled_rows(spark):
    """Few rows of a language lean on the others' limit, and the plain distances give the same ones."""
    df, _ = corpus(spark, 300, seed=3)
    model = language.calibrated(df, language.train(df))
    rows = df.collect()
    names, _, _, best, fit = model.decode([r.text for r in rows])
    bins = [[] for _ in model.languages]
    for r, name, b, x in zip(rows, names, best, fit):
        if name == r.lang:
            bins[b].append(min(max(int(np.floor(x / language.FIT_WIDTH)), -language.FIT_BINS // 2), language.FIT_BINS // 2 - 1) * language.FIT_WIDTH)
    every = sorted(x for own in bins for x in own)
    for k, own in enumerate(bins):
        weighted = sorted([(x, 1.0) for x in own] + [(x, language.FIT_PRIOR / len(every)) for x in every])
        total = sum(w for _, w in weighted)
        at = lambda q: next(x for i, (x, _) in enumerate(weighted) if sum(w for y, w in weighted[:i + 1]) + sum(w for y, w in weighted[i + 1:] if y == x) >= q * total - 1e-9)  # noqa: E731, B023
        limit = at(0.5) - language.REJECTED_BEYOND * max((at(0.5) - at(0.25)) / 0.6745, language.LEAST_SPREAD)
        assert abs(min(max(limit, language.LIMITS[0]), language.LIMITS[1]) - model.limits[k]) < 1e-6
