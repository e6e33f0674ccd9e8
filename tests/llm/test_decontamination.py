"""Benchmark decontamination against a brute-force version."""

import hashlib
import random
import re

import pytest

from faresight.llm import decontamination

DOCS, ITEMS = "doc_id long, text string, n_words int", "item_id long, text string, row string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = [(i, w[k:k + 10]) for i, t in items if (w := words(t)) for k in range(max(1, len(w) - 9))]
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item, w in windows:
            for k in range(len(own) - len(w) + 1):
                if own[k:k + len(w)] == w:
                    hit.update(range(k, k + len(w)))
                    found.add("" if item is None else str(item))
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    documents = spark.createDataFrame([(*d, 1) for d in docs], DOCS)
    benchmark = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = decontamination.contaminated(documents, benchmark, **more)
    rows = found.collect()
    for r in rows:
        assert sum(s["end"] - s["begin"] for s in r["spans"] or []) == r["n_hit"]
    return sorted((tuple(r)[:6] for r in rows), key=repr)


def case(seed):
    """Texts of few words, so that shingles repeat; items of 0 to 30 words, pieces of which stand in documents."""
    rng = random.Random(seed)
    vocabulary = ["de", "La", "été", "ÉTÉ", "x1", "日本", "the", "of", "a", "Z9"]
    text = lambda n, v=vocabulary: "".join(rng.choice(v) + rng.choice([" ", "  ", ".\n", ", ", "-"]) for _ in range(n))
    items = [(k, text(rng.choice([3, 8, 10, 11, 25, 30]), vocabulary + [f"w{k}", f"v{k}"])) for k in range(12)]
    items += [(100, "the"), (101, "of a"), (102, None), (103, ""), (104, " .;"), (None, items[3][1]), (3, items[4][1]), (3, items[3][1]), (105, items[5][1])]
    docs = [(k, text(rng.randrange(0, 60))) for k in range(30)]
    for k in range(40):
        part = words(rng.choice(items[:12])[1])
        lo = rng.randrange(len(part))
        docs.append((200 + k, text(rng.randrange(4)) + " ".join(part[lo:lo + rng.randrange(1, 25)]).upper() + " " + text(rng.randrange(4))))
    docs += [(k, items[4][1] * 3) for k in (300, 300, 301)] + [(None, items[4][1]), (None, None), (400, None), (401, ""), (402, "..")]
    docs.append((500, text(3000) + items[6][1] + text(3000) + items[7][1]))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    docs, items = case(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_give_the_same(spark):
    docs, items = case(3)
    assert run(spark, docs, items, block_words=100) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = case(4)
    assert run(spark, [], items) == []
    assert run(spark, docs[:5], []) == brute(docs[:5], [])
    assert run(spark, docs[:5], [(1, None), (2, " ")]) == brute(docs[:5], [])


def test_an_item_that_many_documents_hold(spark):
    docs = [(k, f"q{k} " + " ".join(f"p{i}" for i in range(12))) for k in range(300)]
    rows = run(spark, docs, [(k, " ".join(f"p{i}" for i in range(12))) for k in range(50)])
    assert all(r[2:4] == (12, 50) for r in rows) and len(rows) == 300


def test_no_python_on_the_way(spark):
    from faresight.llm.components import stored
    documents = spark.createDataFrame([(1, "a b c d", 4)], "row long, normalised string, n_words long")
    windows = spark.createDataFrame([(7, ["b", "c", "d"])], "name long, words array<string>")
    plan = decontamination.occurrences(stored(documents, "test"), stored(windows, "test"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
