import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import test_decontam, test_simhash
from tests.llm.helpers import edge_docs, empty_docs
from workbench.llm.common import stored


def test_run_equals_brute_force_after_the_classifier(spark):
    """Each later stage in plain Python, on what the classifier keeps."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in
                  stages["quality classifier"](spark, docs, SF_SMALL).collect())
    assert 0.6 * docs.count() < len(rows) < docs.count()
    seen = set()
    rows = [(i, t) for i, t in rows
            if (n := re.sub(r"[\x20\x09-\x0D]+", " ", t)) not in seen and not seen.add(n)]
    firsts = {c for _, _, c in test_simhash.plain(rows)}
    rows = [(i, t) for i, t in rows if i in firsts]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = {r[0] for r in test_decontam.plain(rows, items, 10) if not r[4]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t in rows:
        if i in clean:
            ids = tokenizer.encode(t, add_special_tokens=False).ids
            expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == expected


def test_stages_stand_edges_and_empty_tables(spark):
    for docs, least in ((edge_docs(spark), 1), (empty_docs(spark), 0)):
        now = stored(docs, "test")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, SF_SMALL)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            now = stored(out, "test")
            assert least <= now.count() <= docs.count()


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination",
        "BPE encoding and decoding"]
