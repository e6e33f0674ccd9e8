"""Cross-tokenizer alignment against a brute-force version on the two libraries' own output."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest

from faresight.llm import alignment
from faresight.llm.bpe import byte_characters

A, B = P.path(alignment.BYTE_VOCABULARY), P.path(alignment.PIECE_VOCABULARY)
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def groups_of(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    t, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    as_byte = {c: b for b, c in enumerate(byte_characters())}

    def of_piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def cut(ids, data):
        ends, at = [], 0
        for d in data:
            at += len(d)
            ends.append(at)
        return ids, ends, b"".join(data)

    for text in texts:
        if not text:
            yield None
            continue
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        a, end_a, data_a = cut(a, [bytes(as_byte[c] for c in t.id_to_token(i)) for i in a])
        b, end_b, data_b = cut(b, [of_piece(i) for i in b])
        if not data_a == data_b == (" " + text).encode():
            yield None
            continue
        found, low = [], 0
        for end in sorted(set(end_a) & set(end_b)):
            found.append(([i for i, e in zip(a, end_a) if low < e <= end], [i for i, e in zip(b, end_b) if low < e <= end]))
            low = end
        yield found


def brute(docs):
    found = list(groups_of([t for _, t in docs]))
    links = [[(x, y) for a, b in g or [] for x in a for y in b] for g in found]
    count = Counter(p for own in links for p in set(own))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), g, own in zip(docs, found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out.append((doc_id, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), len(own), sum(count[p] == most[p[0]] for p in own),
                    sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def run(spark, docs, **more):
    documents = spark.createDataFrame([(*d, b"x", 3) for d in docs], "doc_id long, text string, codes binary, row int").repartition(3)
    return sorted((tuple(r[n] for n in NAMES) for r in alignment.align(documents, A, B, **more).collect()), key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    pieces = ["the", "ciónñrr", " naïve", "  ", "\n", "\t", "日本語", "🙂👩‍👩‍👧", "don't", "1234", "́", "ß", "\xa0", "�", "<|endoftext|>", "<s>", "aaaa", "_", "…", "x" * 30, "한국", "عرب", "\r\n"]
    docs = [(k, "".join(rng.choice(pieces) + rng.choice(["", " ", " ", "."]) for _ in range(rng.randrange(40)))) for k in range(n)]
    docs += [(900, None), (901, ""), (902, " "), (903, "a▁b"), (904, "\x00"), (None, "the the"), (None, None), (5, docs[5][1]), (5, docs[5][1]),
             (905, "word " * 3000), (906, "ab" * 5000), (907, "<0x41>"), (908, " x"), (909, "x  "), (910, "the " + " " * 9000 + "end")]
    return docs


@pytest.mark.parametrize("head", [alignment.HEAD, 50, 0])
def test_brute_force(spark, head):
    docs = corpus(head)
    assert run(spark, docs, head=head) == brute(docs)


def test_windows_are_aligned_once(monkeypatch):
    """The memo gives the same whether windows are known, forgotten, long or in large groups."""
    texts = [t for _, t in corpus(7, 60)]
    plain = alignment.Aligner(A, B).align(texts)
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 20)
    monkeypatch.setattr(alignment, "MEMO_TOKENS", 2)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 3)
    own = alignment.Aligner(A, B)
    for lo in range(0, len(texts), 9):
        got = own.align(texts[lo:lo + 9])
        for k in (*alignment.COUNTS, "groups"):
            assert list(got[k]) == list(plain[k][lo:lo + 9])
        for (c, n), (d, m) in zip(got["pairs"], plain["pairs"][lo:lo + 9]):
            assert c.tolist() == d.tolist() and n.tolist() == m.tolist()
        assert len(own.known) == len(own.texts) == own.numbers.shape[1] and len(own.codes) == own.numbers[2].sum()


def test_same_ids_as_the_vocabulary_file():
    from tokenizers import Tokenizer
    t, own = Tokenizer.from_file(A), alignment.aligner(A, B)
    t.encode_special_tokens = True
    rng = random.Random(5)
    tokens = [x for x in (own.tokens.joined([i]).tobytes().decode(errors="ignore") for i in range(own.size_a)) if x]
    texts = tokens[::5] + ["".join(rng.choices(tokens, k=4)) for _ in range(5000)] + [" " * 5000 + "a", "\n" * 30_000]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert own._encode(text).tolist() == e.ids


def test_empty_and_bare_tables(spark):
    assert run(spark, []) == []
    none = [(1, None), (2, "")]
    assert run(spark, none) == brute(none)


def test_groups_on_request(spark):
    rows = alignment.aligned(spark.createDataFrame([(1, "hello hello")], "doc_id long, text string"), A, B, with_groups=True).collect()
    assert hashlib.sha256(rows[0]["groups"].encode()).hexdigest() == rows[0]["groups_sha256"] and rows[0]["groups"].count(";") + 1 == rows[0]["n_groups"]
