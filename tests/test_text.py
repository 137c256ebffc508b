"""Text: tokens, stop words (T27), lemmas, vocabulary order (T28), IDF two forms."""

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from workbench.operators import text as X


def _docs(spark):
    rows = [(1, "The cat sat on the mat. The CAT!"), (2, ""), (3, "Cat"),
            (4, "Élan vital über 42 cafés, the dogs ran"), (5, "ox at it be cats went")]
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_terms_rules(spark):
    got = {r.doc_id: r.terms for r in X.doc_terms(_docs(spark), "doc_id", "text").collect()}
    assert got[1] == ["cat", "sat", "mat", "cat"]  # "The" removed once lower-cased
    assert 2 not in got and 3 not in got  # empty, and a single term
    assert got[4] == ["élan", "vital", "über", "cafés", "dogs", "ran"]  # digits dropped
    assert got[5] == ["cats", "went"]  # two-letter words dropped


def test_case_sensitive_keeps_capital_stop_word(spark):
    got = {r.doc_id: r.terms for r in
           X.doc_terms(_docs(spark), "doc_id", "text", case_sensitive=True).collect()}
    assert got[1] == ["the", "cat", "sat", "mat", "the", "cat"]


def test_lemmas(spark):
    lem = spark.createDataFrame([("went", "go"), ("cats", "cat")], "form string, lemma string")
    got = {r.doc_id: r.terms for r in
           X.doc_terms(_docs(spark), "doc_id", "text", lemmas=lem, min_terms=1).collect()}
    assert got[5] == ["cat"]  # "went" -> "go", then too short (the test is on the lemma)


def test_vocabulary_ties_by_term_and_idf_forms_agree(spark):
    terms = X.doc_terms(_docs(spark), "doc_id", "text", min_terms=1)
    tf = X.term_freq(terms, "doc_id")
    vocab = X.vocabulary(tf, 3).collect()
    assert [r.term for r in vocab] == ["cat", "cafés", "cats"]  # cat (3), then ties by term
    full = X.vocabulary(tf, 1000)
    idf = {r.term: r.idf for r in X.idf(tf, "doc_id", full).collect()}
    n = terms.count()
    assert math.isclose(idf["cat"], math.log((n + 1) / (2 + 1)))
    long = X.tfidf(tf, "doc_id", X.idf(tf, "doc_id", full))
    vecs, vmap = X.tfidf_vectors(terms, "doc_id", 1000)
    a = long.agg(F.sum("tfidf")).first()[0]
    b = vecs.select(F.aggregate(vector_to_array("tfidfVec"), F.lit(0.0),
                                lambda s, v: s + v).alias("w")).agg(F.sum("w")).first()[0]
    assert math.isclose(a, b, rel_tol=1e-9)
    assert vmap.count() == full.count()


def test_page_text(spark):
    html = ('<html><head><title>A &amp; B</title><script>var x="<p>";</script></head>'
            '<body><!-- c --><p>Hello&nbsp;<b>world</b></p><style>p{}</style></body></html>')
    df = spark.createDataFrame([(1, html), (2, "<html><body> </body></html>")], "id int, html string")
    rows = X.page_text(df, "html", keep=["id"]).collect()
    assert [(r.id, r.title, r.content) for r in rows] == [(1, "A & B", "Hello world")]


def test_long_form_from_text_equals_array_form(spark):
    docs = _docs(spark)
    lem = spark.createDataFrame([("went", "go"), ("cats", "cat"), ("dogs", "dog")],
                                "form string, lemma string")
    for kw in ({}, {"lemmas": lem}):
        a = X.term_freq(X.doc_terms(docs, "doc_id", "text", **kw), "doc_id")
        b = X.term_freq_from_text(docs, "doc_id", "text", **kw)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_lists_and_tables_of_words_agree_and_nulls_are_no_words(spark):
    docs = _docs(spark)
    stop = spark.createDataFrame([(w,) for w in X.STOP_WORDS] + [(None,), ("the",)], "word string")
    pairs = [("went", "go"), ("cats", "cat")]
    lem = spark.createDataFrame([*pairs, (None, "x"), ("dogs", None)], "form string, lemma string")
    for make in (X.term_freq_from_text, lambda *a, **k: X.term_freq(X.doc_terms(*a, **k), "doc_id")):
        plain = make(docs, "doc_id", "text", lemmas=pairs)
        table = make(docs, "doc_id", "text", stop_words=stop, lemmas=lem)
        rows = sorted(map(tuple, plain.collect()))
        assert rows and rows == sorted(map(tuple, table.collect()))


def test_whole_token_rule(spark):
    df = spark.createDataFrame([(1, "covid19 hit (Paris), b2b d'accord über-alles; end.")], "doc_id int, text string")
    cut, = X.doc_terms(df, "doc_id", "text").collect()
    whole, = X.doc_terms(df, "doc_id", "text", letters_only=True).collect()
    assert "covid" in cut.terms and whole.terms == ["hit", "paris", "end"]


def test_header_is_no_head_and_entities_by_number(spark):
    html = "<html><head lang='x'><title>T</title></head><header>Top</header> <p>a &#8212; b&apos;s &#x27;c&#x27; &#0; &#x1F600;</p></html>"
    df = spark.createDataFrame([(1, html), (2, "<header>x</header></head>y")], "id int, html string")
    rows = {r.id: r.content for r in X.page_text(df, "html", keep=["id"]).collect()}
    assert rows[1] == "Top a \u2014 b's 'c' &#0; \U0001F600" and rows[2] == "x y"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_before_they_are_shuffled(spark):
    stop = spark.createDataFrame([(w,) for w in X.STOP_WORDS], "word string")
    for kw in ({}, {"stop_words": stop}, {"lemmas": X.LEMMAS}):
        assert "Exchange" not in _plan(X.doc_terms(_docs(spark), "doc_id", "text", **kw))
        p = _plan(X.term_freq_from_text(_docs(spark), "doc_id", "text", **kw))
        assert p.count("Exchange hashpartitioning(doc_id") == p.count("Exchange") == 1
        assert "partial_count" in p[p.index("Exchange"):]


def test_long_lists_are_joined_with_the_same_result(spark, monkeypatch):
    lem = [("went", "go"), ("cats", "cat"), ("dogs", "dog")]
    for kw in ({}, {"lemmas": lem}, {"case_sensitive": True, "min_terms": 1}, {"letters_only": True}):
        results = []
        for most in (2_000, 1):
            monkeypatch.setattr(X, "INLINE_WORDS", most)
            terms = {r.doc_id: r.terms for r in X.doc_terms(_docs(spark), "doc_id", "text", **kw).collect()}
            tf = sorted(map(tuple, X.term_freq_from_text(_docs(spark), "doc_id", "text", **kw).collect()))
            results.append((terms, tf))
        assert results[0] == results[1] and results[0][1]


def test_page_parts_are_computed_once(spark):
    df = spark.createDataFrame([(1, "<p>x</p>")], "id int, html string")
    plan = X.page_text(df, "html", keep=["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<style") == plan.count("<title") == 1


def test_python_annotator(spark):
    got = X.doc_terms_in_pandas(_docs(spark).unionAll(spark.createDataFrame([(9, None)], "a int, b string")),
                                "doc_id", "text", lambda: lambda t: t.split()).collect()
    assert {r.doc_id: len(r.terms) for r in got} == {1: 8, 4: 8, 5: 6}
