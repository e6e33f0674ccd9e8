import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faresight.llm import bpe, packing

ODD = ["", " ", "a  b\n\n c", "don't WE'LL it's", "été ¡ñandú! 你好　世界", "x\x1cy\x85z\xa0", "<|endoftext|>a <|endoftext|>",
       "12345 67 ½ Ⅷ", "\t\t a\r\n b ", "🙂🙂 é ﬁ", "a" * 3000, "_" * 500 + " ", "the the the", "́abc", "İ ſ K", "ΟΔΟΣ. Σ, σ", "İİ, Å. é. a,. b.. c)., 3. it's. ①. ²."]


def random_texts(n=300, seed=5):
    rnd = random.Random(seed)
    letters = "abet nosh   \n\n\t'.,;123é你\x1c\x85 ŒA-_<|>#"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200))) for _ in range(n)]


def test_ids_of_words_and_signs_equal_library():
    path = public_tokenizers.path(packing.VOCABULARY)
    lib, rnd = Tokenizer.from_file(path), random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzéèçñßöüœěžāÆØİΣσςıªµ.,'´<|>\u0301"
    texts = [" ".join("".join(rnd.choices(letters, k=rnd.randint(1, 9))) for _ in range(60)) for _ in range(60)] + ["a<|endoftext|>b. <|startoftext|>, ok"]
    for text, ids in zip(texts, packing.encode(texts, path)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_ids_of_capitals_equal_library():
    path = public_tokenizers.path(packing.VOCABULARY)
    lib, rnd = Tokenizer.from_file(path), random.Random(10)
    texts = ["<|ENDOFTEXT|>", "a <|EndOfText|> B <|startoftext|>C", "H\u0331 T\u0308 J\u030c É E\u0301. W\u030a, A\u030aB", "ÉTÉ K İ. ΟΔΟΣ ẞ HELLO, World.", "<| ENDOFTEXT |> <|X", "H\u0331<|ENDOFTEXT|>."]
    letters = "aBcDeHJTWYéÉÜßÆİΣςKŐǅ.,'<|>\u0301\u0308\u030a\u030c\u0331"
    texts += ["".join(rnd.choices(letters + "  \n", k=rnd.randint(1, 60))) for _ in range(1500)]
    for text, ids in zip(texts, packing.encode(texts, path)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_bpe_equals_library():
    path = public_tokenizers.path(bpe.VOCABULARY)
    lib, own = Tokenizer.from_file(path), bpe.Codec(path)
    texts = ODD + random_texts()
    for text, got in zip(texts, own.encode_all(texts)):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert own.decode(got) == lib.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_one_tree_and_many_equal_library(monkeypatch, few):
    """Trees that advance together, and one by one, on the same words."""
    monkeypatch.setattr(bpe, "FEW", few)
    path = public_tokenizers.path(bpe.VOCABULARY)
    lib, own, rnd = Tokenizer.from_file(path), bpe.Codec(path), random.Random(11)
    texts = ODD + random_texts(80, 12) + ["".join(rnd.choices("etaoinshé你", k=n)) for n in (1, 2, 3, 63, 64, 65, 700)] + ["ab" * 500, "é" * 300, "Z"]
    for text, got in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_a_long_unbroken_run():
    path = public_tokenizers.path(bpe.VOCABULARY)
    text = "".join(random.Random(13).choices("etaoinshrdlu", k=200_000))
    (got,) = bpe.Codec(path).encode_all([text])
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_bpe_query_on_odd_rows(spark):
    path = public_tokenizers.path(bpe.VOCABULARY)
    df = spark.createDataFrame([(1, None, 2), (None, "a b", 3), (1, "", 4), (1, "", 4)], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_decode(df, path, with_ids=True).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 2), (1, 0), (1, 0), (1, 0)]
    assert bpe.encode_decode(df.limit(0), path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 8191, 100_003])
def test_piece_lengths(n):
    got = packing.piece_lengths(n)
    assert sum(got) == n and all(x & (x - 1) == 0 and x <= 4096 for x in got) and got == sorted(got, reverse=True)
    assert len([x for x in got if x < 4096]) == len({x for x in got if x < 4096})


def test_packing_holds_every_id_once(spark):
    path = public_tokenizers.path(packing.VOCABULARY)
    lib = Tokenizer.from_file(path)
    texts = dict(enumerate(ODD + random_texts(60) + [None, "word " * 9000]))
    df = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, length int").repartition(3)
    rows = packing.decompose(df, path).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    for k, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start)
        want = lib.encode(text or "", add_special_tokens=False).ids + [2]
        assert [i for r in own for i in r.ids] == want
        at = 0
        for r in own:
            piece = np.array(want[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, r.bucket) == (at, len(want), zlib.crc32(piece), len(piece) // 4)
            at += r.length
    with pytest.raises(ValueError):
        packing.decompose(df, path, 1000)


def test_packing_odd_tables(spark, tmp_path):
    path = public_tokenizers.path(packing.VOCABULARY)
    df = spark.createDataFrame([(None, None), (7, "a"), (7, "a")], "doc_id long, text string")
    rows = packing.decompose(df, path).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 1), (7, 2), (7, 2)]
    assert packing.decompose(df.limit(0), path).count() == 0
    packing.write_buckets(packing.decompose(df, path), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == len(rows)


def test_every_letter_before_a_sign_equals_library():
    """Every code point before a full stop, a comma and a letter: letters that composition takes apart end in a mark, which the sign joins."""
    path = public_tokenizers.path(packing.VOCABULARY)
    lib = Tokenizer.from_file(path)
    points = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    for lo in range(0, len(points), 40_000):
        some = [c for c in points[lo:lo + 40_000] if c.isalpha()] + [c for c in points[lo:lo + 40_000:7] if not c.isalpha()]
        texts = [f"{c}. x{c}, {c}a" for c in some]
        for text, ids, e in zip(texts, packing.encode(texts, path), lib.encode_batch_fast(texts, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == e.ids, text.encode("unicode_escape")
    assert not packing.stays_letter("\u09dc") and packing.stays_letter("é") and not packing.stays_letter("İ")


def test_long_parts_are_not_kept():
    path = public_tokenizers.path(packing.VOCABULARY)
    lib = Tokenizer.from_file(path)
    texts = ["a " + "b" * 5000 + ". c", "é" * 3000 + ", " + "d" * 201]
    assert [np.frombuffer(i, "<u4").tolist() for i in packing.encode(texts, path)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, packing._tokenizer(path)[1])) <= packing.CACHE_LETTERS + 1
    own = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    own.encode_all(["x " + "ab" * 3000, "y " + "ab" * 3000])
    assert max(map(len, own.known)) <= bpe.CACHE_LETTERS


def test_another_operator_drops_what_a_worker_kept():
    from faresight.llm import text
    text.take_over("one")
    packing.encode(["some words"], public_tokenizers.path(packing.VOCABULARY))
    text.take_over("one")
    assert packing._state
    seen = list(text.held_by("two", lambda batches: (b for b in batches))(iter([1, 2])))
    assert not packing._state and seen == [1, 2]
