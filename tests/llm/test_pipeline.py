import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from faresight.llm import language, secrets
from test_neardup import brute as near
from test_substring import brute as repeats

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], COLUMNS)


def rows():
    from test_neardup import corpus
    shared = " ".join(f"shared{i}" for i in range(60))
    own = [(i, f"{t} {shared if i % 17 == 3 else ''}", "en") for i, t in corpus(4, 90)]
    words = [(5000 + k, " ".join(f"u{k}x{i}" for i in range(30)) + f" password: hunter{k}abc {shared} tail{k}", "en") for k in range(6)]
    rnd = random.Random(8)
    noise = [(7000 + k, " ".join("".join(rnd.choices("bcdfghjklmnpqrstvwxzäöü", k=6)) for _ in range(60)), None) for k in range(10)]
    return [*own, *words, *noise, (9001, None, "en"), (9002, "", "en"), (9003, "12 345 --", "en"), (9004, "lone", None), (9004, "lone", None)]


def test_stages_equal_brute_force(spark):
    docs, now = documents(spark, rows()), rows()
    for step, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if name == "packing":
            break
        assert out.columns == docs.columns
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
        pairs = [(i, t) for i, t, *_ in now]
        if name == "language":
            speaks = language.calibrated(docs, language.train(docs)).speaks([t for _, t in pairs])
            want = [p for p, s in zip(pairs, speaks) if s]
            letters = {i for i, t in pairs if any(c.isalpha() for c in t or "")}
            assert {i for i, _ in want} < letters and not {i for i, _ in want} & set(range(7000, 7010))
            assert letters - {i for i, _ in want} <= set(range(7000, 7010)) | {9004}
        elif name == "near_duplicates":
            kept = {i for i, _, _, k in near(pairs, 5) if k}
            want = sorted({(i, t) for i, t in pairs if i in kept}, key=repr)
        elif name == "substring":
            gone = {w[0]: w[4] for w in repeats(pairs, 35) if w[4] is not None}
            want = [(i, gone.get(i, t)) for i, t in pairs]
            assert any(i in gone for i, _ in pairs)
        else:
            want = [(i, secrets.redact(t, secrets.scan(t)[1])) for i, t in pairs]
            assert sum("[SECRET]" in t for _, t in want) >= 6
        assert got == sorted(want, key=repr), name
        now = got
        docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in now], COLUMNS)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    for i, t in now:
        if i != 9004:
            assert [x for _, ids in sorted(pieces[i]) for x in ids] == lib.encode(t, add_special_tokens=False).ids + [2]


def test_run_writes_and_rereads_every_stage(spark, tmp_path):
    documents(spark, rows()).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "start", "length", "ids", "sequence_id"} <= set(got.columns) and got.count() > 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_row_of_each_group_goes_through(spark):
    """Repeated rows and copies without an id neither stay beside their document nor take its text away."""
    long = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"]
    given = [(1, long[0], "en"), (1, long[0], "en"), (2, long[1], "en"), (None, long[1], "en"), (None, long[1].upper(), "en"), (None, long[2], "en"), (None, long[2], "en"),
             (None, long[2] + " more", "en"), (4, long[3], "en"), (5, long[3] + " end", "en"), (5, long[4], "en"), (4, long[4] + " end", "en"), (None, long[5], "en"), (None, "-", "en"), (None, "", "en")]
    docs = corpus_pipeline.drop_near_duplicates(spark, documents(spark, given), "")
    got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    (third,) = {t for i, t in got if i is None and t.startswith("c")}
    want = [(1, long[0]), (2, long[1]), (None, third), (4, long[3]), (4, long[4] + " end"), (None, long[5]), (None, "-"), (None, "")]
    assert got == sorted(want, key=repr) and third in (long[2], long[2] + " more")
    after = corpus_pipeline.cut_repeats(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=repr) == got
    both = documents(spark, [(1, long[0], "en"), (1, long[0], "en"), (2, long[0] + " own", "en"), (3, long[1], "en"), (3, long[1], "en")])
    cut = sorted((r.doc_id, r.text) for r in corpus_pipeline.cut_repeats(spark, both, "").collect())
    assert cut == [(1, ""), (1, ""), (2, "own"), (3, long[1]), (3, long[1])]


def test_columns_of_any_name_and_type_go_through(spark):
    """Names that the stages use themselves, maps, repeated rows and nulls: every column comes out as it went in."""
    long = [" ".join(f"{name}{i}" for i in range(60)) for name in "abc"]
    given = [(1, long[0], "en", 7, "s", {"k": 1}, [1, 2]), (1, long[0], "en", 7, "s", {"k": 1}, [1, 2]), (2, long[0], "en", 8, "t", None, None),
             (3, long[1] + " " + long[2], "en", 9, None, {}, []), (4, long[2] + " own words", "en", None, "u", {"a": None}, [None]), (5, None, None, 5, "v", {"z": 2}, [5])]
    kinds = "doc_id long, text string, lang string, _row long, _spans string, row map<string,int>, spans array<int>"
    docs = spark.createDataFrame(given, kinds)
    some = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert some.columns == docs.columns and sorted(map(tuple, some.collect()), key=repr) == sorted(map(tuple, [given[0], *given[3:]]), key=repr)
    for stage in (corpus_pipeline.cut_repeats, corpus_pipeline.mask_secrets):
        out = stage(spark, some, "")
        assert out.columns == docs.columns
        assert {r.doc_id: tuple(r)[2:] for r in out.collect()} == {g[0]: g[2:] for g in [given[0], *given[3:]]}
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, some, "").collect()}
    assert cut == {1: long[0], 3: long[1], 4: "own words", 5: None}


def test_one_of_many_repeated_rows_stays(spark):
    rows = [(None if k % 3 else 1, " ".join(f"x{i}" for i in range(80)), "en") for k in range(300)] + [(None, "a b c d e f g h", "en")] * 50
    got = sorted(((r.doc_id, r.text[:2]) for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").collect()), key=repr)
    assert got == [(1, "x0"), (None, "a ")]
