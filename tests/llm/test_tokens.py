import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs
from workbench.llm import bpe, tokencount
from workbench.llm.tokenfiles import Vocabulary

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PARTS = [*"abc ABC''stre12  \t\n\x0b\x1c\x1f\x85\xa0 　éÉ日本ßİΣσ.,!?<|>😀́​٣Ⅳ²",
         "<|endoftext|>", "<|startoftext|>", "'ll", " the", "aaaa", "\n\n  x"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def random_texts(n):
    random.seed(4)
    return ["".join(random.choices(PARTS, k=random.randint(0, 50))) for _ in range(n)]


def check(docs, spark):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault(r.doc_id, []).append(r.text or "")
    words, counts = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)

    def expected(t):
        ids = words.encode(t, add_special_tokens=False).ids
        return len(ids), sha(" ".join(map(str, ids))), sha(words.decode(ids, skip_special_tokens=False))

    got = {}
    for r in bpe.round_trip(docs, WORD).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(map(expected, v)) for k, v in rows.items()}
    got = {}
    for r in tokencount.token_counts(docs, BYTE).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens, r.over_limit))
    lens = {k: sorted((len(t.encode()), n := len(counts.encode(t, add_special_tokens=False).ids), n > 1024)
                      for t in v) for k, v in rows.items()}
    assert {k: sorted(v) for k, v in got.items()} == lens


def test_edges(spark):
    check(edge_docs(spark), spark)


def test_random_texts(spark):
    check(spark.createDataFrame(list(enumerate(random_texts(1500))), "doc_id bigint, text string"), spark)


def test_documents(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark)


def test_empty_table(spark):
    assert bpe.round_trip(empty_docs(spark), WORD).count() == 0
    assert tokencount.token_counts(empty_docs(spark), BYTE).count() == 0


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_a_merge_only_makes_symbols_of_later_merges(path):
    """What the pair index relies on: one merge makes each symbol, and uses of it rank higher."""
    v = Vocabulary(path)
    made = {union: rank for rank, union in v.ranks.values()}
    assert len(made) == len(v.ranks)
    low = (1 << v.SHIFT) - 1
    assert all(made.get(pair >> v.SHIFT, -1) < rank > made.get(pair & low, -1)
               for pair, (rank, _) in v.ranks.items())


def test_a_long_word_and_small_memory(spark, monkeypatch):
    monkeypatch.setattr(tokencount, "LONG_TEXT", 100)
    monkeypatch.setattr(tokencount, "REMEMBER", 3)
    monkeypatch.setattr(bpe, "INDEXED", 2)
    monkeypatch.setattr(bpe, "REMEMBER", 5)
    rows = [(1, "x" * 30_000), (2, "the cat " * 300), *enumerate(random_texts(60), 10)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), spark)


def test_one_worker_encodes_and_decodes(spark):
    """Two Python steps in a task would hold two vocabularies at once."""
    docs = spark.createDataFrame([(1, "the cat")], "doc_id bigint, text string")
    plan = bpe.round_trip(docs, WORD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
