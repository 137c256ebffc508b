import re

import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import LOWER, edge_docs, empty_docs
from workbench.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, window):
    wins = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add("" if name is None else str(name))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in wins}:
            for k in range(len(w) - size + 1):
                if (win := tuple(w[k:k + size])) in wins:
                    hit |= set(range(k, k + size))
                    found |= wins[win]
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def run(docs, bench, **options):
    got = decontam.contamination(docs, bench, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in got), key=str)


def pairs(docs):
    return [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("shard_words", [200_000, 400])
def test_documents_equal_plain_version(spark, shard_words):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(3)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = run(docs, bench, shard_words=shard_words)
    assert got == plain(pairs(docs), items, 10)
    assert any(r[4] for r in got)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "word5 and word6"),
         (2, "Same text"), (None, "zzz; É日本"), (4, ""), (5, None), (6, "?!"), (7, "a"),
         (8, "b b b b b b b b b b b b"), (9, "two three four")]


@pytest.mark.parametrize("shard_words", [200_000, 5])
def test_edges_short_items_and_shards(spark, shard_words):
    more = [(100, "one two three four five six seven eight nine ten eleven", *(None,) * 11),
            (101, "TWO three, four five. six seven eight nine ten eleven twelve b b", *(None,) * 11),
            (102, "b " * 30, *(None,) * 11), (103, "one two three x two three four", *(None,) * 11)]
    docs = edge_docs(spark)
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema)).repartition(2)
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert run(docs, bench, shard_words=shard_words) == plain(pairs(docs), ITEMS, 10)
    kept = decontam.drop_contaminated(docs, bench, shard_words=shard_words)
    assert kept.columns == docs.columns
    bad = sum(r[4] for r in plain(pairs(docs), ITEMS, 10))
    assert kept.count() == docs.count() - bad
    cut = decontam.cut_spans(docs, bench, shard_words=shard_words)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r.doc_id: r.text for r in cut.filter("doc_id > 99").collect()}
    assert texts == {100: "", 101: " twelve b b", 102: " ", 103: "one two three x "}


def test_limits(spark):
    docs = spark.createDataFrame([(1, "x " * 50 + "two three four"), (2, "two three four")], "doc_id int, text string")
    bench = spark.createDataFrame([(9, "two three four")], "item_id int, text string")
    assert decontam.drop_contaminated(docs, bench, max_span=3, max_coverage=0.5).collect()[0].doc_id == 1
    assert decontam.drop_contaminated(docs, bench, max_span=2, max_coverage=1.0).count() == 0


def test_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert run(empty_docs(spark), bench) == []
    got = run(edge_docs(spark), bench.limit(0))
    assert len(got) == 16 and not any(r[4] for r in got)


def test_property_automaton_equals_plain_windows():
    import random
    random.seed(5)
    for _ in range(300):
        items = [(str(k), [random.randint(0, 2) for _ in range(random.randint(1, 9))]) for k in range(3)]
        seq = [random.randint(-1, 2) for _ in range(40)]
        window = random.randint(1, 5)
        spans, found = decontam.Automaton(items, window).stream(seq)
        hit, names = set(), set()
        for name, s in items:
            for i in range(max(1, len(s) - window + 1)):
                win = s[i:i + window]
                for k in range(len(seq) - len(win) + 1):
                    if seq[k:k + len(win)] == win:
                        hit |= set(range(k, k + len(win)))
                        names.add(name)
        assert {i for a, b in spans for i in range(a, b + 1)} == hit and found == names
