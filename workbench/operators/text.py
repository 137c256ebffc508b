"""Text to term weights: page text extraction, tokens, stop words, lemmas, term
counts, vocabulary, inverse document frequency and TF-IDF.

The per-word steps run inside the row of a document: split, lower-case, map to lemmas, drop
short words and stop words, so that no word leaves its document before it is counted. Lists and
dictionaries beyond a stated size are joined to exploded words instead. The corpus steps are
aggregations with map-side combine (term counts, document frequencies); the vocabulary is a
bounded top-k.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workbench.functions.bounded import TooManyRows, collected
from workbench.functions.partitions import widened

# English stop words removed from the terms (one word per entry).
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any",
    "are", "as", "at", "be", "because", "been", "before", "being", "below", "between",
    "both", "but", "by", "can", "did", "do", "does", "doing", "down", "during", "each",
    "few", "for", "from", "further", "had", "has", "have", "having", "he", "her", "here",
    "hers", "herself", "him", "himself", "his", "how", "i", "if", "in", "into", "is", "it",
    "its", "itself", "just", "me", "more", "most", "my", "myself", "no", "nor", "not",
    "now", "of", "off", "on", "once", "only", "or", "other", "our", "ours", "ourselves",
    "out", "over", "own", "same", "she", "should", "so", "some", "such", "than", "that",
    "the", "their", "theirs", "them", "themselves", "then", "there", "these", "they",
    "this", "those", "through", "to", "too", "under", "until", "up", "very", "was", "we",
    "were", "what", "when", "where", "which", "while", "who", "whom", "why", "will",
    "with", "you", "your", "yours", "yourself", "yourselves",
]

# Irregular English word forms and their lemma.
LEMMAS = [
    ("went", "go"), ("gone", "go"), ("goes", "go"), ("made", "make"), ("makes", "make"),
    ("said", "say"), ("says", "say"), ("took", "take"), ("taken", "take"),
    ("takes", "take"), ("came", "come"), ("comes", "come"), ("better", "good"),
    ("best", "good"), ("children", "child"), ("men", "man"), ("women", "woman"),
    ("people", "person"), ("thought", "think"), ("thinks", "think"), ("knew", "know"),
    ("known", "know"), ("knows", "know"), ("saw", "see"), ("seen", "see"),
    ("sees", "see"), ("gave", "give"), ("given", "give"), ("gives", "give"),
    ("found", "find"), ("finds", "find"), ("told", "tell"), ("tells", "tell"),
    ("became", "become"), ("becomes", "become"), ("left", "leave"), ("leaves", "leave"),
    ("felt", "feel"), ("feels", "feel"), ("brought", "bring"), ("brings", "bring"),
    ("began", "begin"), ("begun", "begin"), ("begins", "begin"), ("kept", "keep"),
    ("keeps", "keep"), ("held", "hold"), ("holds", "hold"), ("wrote", "write"),
    ("written", "write"), ("writes", "write"), ("stood", "stand"), ("stands", "stand"),
]

# HTML entities decoded in page text (ampersand last).
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&amp;", "&")]
NUMBERED_ENTITY = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

# Stop words, and forms of a dictionary, that are tested inside a document's row.
INLINE_WORDS, INLINE_FORMS = 2_000, 1_000
# Words of a document that are looked at first to tell whether it has enough terms.
LOOK = 64

NON_LETTERS = r"[^\p{L}]+"
BLANKS = r"[ \t\n\r\f]+"


def _numbered(entity: Column) -> Column:
    """The character of ``&#8212;`` or ``&#x2014;``; the entity itself if there is none."""
    body = F.regexp_replace(entity, "[&#;]", "")
    code = F.when(F.lower(body).startswith("x"), F.conv(F.substring(body, 2, 6), 16, 10)) \
        .otherwise(body).cast("int")
    real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)


def unescape(c: Column) -> Column:
    """Entities by number, then by name (the ampersand last)."""
    found = F.concat(F.transform(F.regexp_extract_all(c, F.lit(NUMBERED_ENTITY), F.lit(0)), _numbered),
                     F.array(F.lit("")))
    c = F.when(c.contains("&#"), F.array_join(
        F.zip_with(F.split(c, NUMBERED_ENTITY, -1), found, lambda a, b: F.concat(a, b)), "")).otherwise(c)
    for ent, ch in HTML_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def page_text(df: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Raw page → (title, content): the ``<title>`` text and the visible text of the
    page (scripts, styles and comments removed, tags turned to blanks, entities
    decoded, blanks collapsed). Pages with no content give no row."""
    h = F.col(html)
    title = F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)
    body = F.regexp_replace(h, r"(?is)<head(?:\s[^>]*)?>.*?</head>", " ")
    body = F.regexp_replace(body, r"(?is)<script[^>]*>.*?</script>", " ")
    body = F.regexp_replace(body, r"(?is)<style[^>]*>.*?</style>", " ")
    body = F.regexp_replace(body, r"(?s)<!--.*?-->", " ")
    body = F.regexp_replace(body, r"<[^>]*>", " ")
    parts = _once(widened(df.select(*keep, html)), keep, title=title, body=body)
    clean = {out: F.trim(F.regexp_replace(unescape(F.col(c)), BLANKS, " "))
             for out, c in (("title", "title"), ("content", "body"))}
    return _once(parts, keep, **clean).where(F.length("content") > 0)


def _once(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """The columns ``keep`` and new ones, each computed once for a row whatever reads it: an
    array of one struct is exploded, which the optimizer does not copy into later steps."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.explode(F.array(row)).alias("_r")).select(
        *keep, *[F.col("_r")[n].alias(n) for n in columns])


def _words_table(spark: SparkSession, words: Sequence[str] | DataFrame) -> DataFrame:
    """(term): the distinct words of a list or of a table's first column, nulls dropped."""
    if not isinstance(words, DataFrame):
        words = spark.createDataFrame([(w,) for w in words], "term string")
    return words.select(F.col(words.columns[0]).alias("term")).where("term IS NOT NULL").distinct()


def _lemma_table(spark: SparkSession, lemmas: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """(form, lemma) with one lemma per form, nulls dropped."""
    if not isinstance(lemmas, DataFrame):
        lemmas = spark.createDataFrame(list(lemmas), "form string, lemma string")
    form, lemma = lemmas.columns[:2]
    return (lemmas.select(F.col(form).alias("form"), F.col(lemma).alias("lemma"))
            .where("form IS NOT NULL AND lemma IS NOT NULL")
            .groupBy("form").agg(F.max("lemma").alias("lemma")))


def _small_list(words: Sequence[str] | DataFrame) -> list[str] | None:
    """The distinct words, or None if there are more than ``INLINE_WORDS``."""
    if isinstance(words, DataFrame):
        try:
            return [r[0] for r in collected(_words_table(words.sparkSession, words), INLINE_WORDS)]
        except TooManyRows:
            return None
    listed = sorted({w for w in words if w is not None})
    return listed if len(listed) <= INLINE_WORDS else None


def _small_dictionary(spark: SparkSession, lemmas) -> dict[str, str] | None:
    """Form to lemma, or None if there are more than ``INLINE_FORMS``."""
    if lemmas is None:
        return {}
    try:
        return dict(map(tuple, collected(_lemma_table(spark, lemmas), INLINE_FORMS)))
    except TooManyRows:
        return None


class _Lists(NamedTuple):
    """What a word is tested against, as expressions over one word."""

    stop: list[str]
    forms: dict[str, str]
    min_len: int
    case_sensitive: bool

    def term(self, word: Column) -> Column:
        """The word as it is tested: in lower case, and its lemma if it has one."""
        w = word if self.case_sensitive else F.lower(word)
        if not self.forms:
            return w
        table = F.create_map(*[F.lit(x) for pair in sorted(self.forms.items()) for x in pair])
        return F.when(w.isin(*self.forms), table[w]).otherwise(w)

    def kept(self, term: Column) -> Column:
        long = F.length(term) >= self.min_len
        return long & ~term.isin(*self.stop) if self.stop else long


def _small_lists(spark: SparkSession, *, stop_words: Sequence[str] | DataFrame = STOP_WORDS,
                 lemmas: Sequence[tuple[str, str]] | DataFrame | None = None, min_len: int = 3,
                 case_sensitive: bool = False, letters_only: bool = False) -> _Lists | None:
    """The lists of ``token_rows`` where they are short enough to be tested in a row."""
    stop, forms = _small_list(stop_words), _small_dictionary(spark, lemmas)
    # (an empty word is never a term, whatever the least length)
    return None if stop is None or forms is None else _Lists(stop, forms, max(min_len, 1), case_sensitive)


def _words_of(text: str, letters_only: bool) -> Column:
    """The words of a text in order; there may be empty ones."""
    if not letters_only:
        return F.split(F.col(text), NON_LETTERS)
    words = F.transform(F.split(F.col(text), BLANKS), lambda w: F.regexp_replace(
        w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.filter(words, lambda w: w.rlike(r"^\p{L}+$"))


def token_rows(df: DataFrame, key: str, text: str, *,
               stop_words: Sequence[str] | DataFrame = STOP_WORDS,
               lemmas: Sequence[tuple[str, str]] | DataFrame | None = None, min_len: int = 3,
               case_sensitive: bool = False, letters_only: bool = False) -> DataFrame:
    """(key, pos, term): a document's terms with their places. Words are cut at everything
    that is no letter, lower-cased (before the stop-word test unless ``case_sensitive``),
    mapped to their lemma, at least ``min_len`` long and not a stop word. With
    ``letters_only``, words are cut at white space, marks around them are taken off, and
    one that still holds something else than letters is dropped whole (``covid19``).

    Stop words and lemmas are joined, whatever their number; Spark broadcasts them when
    they are small. Words are exploded first, so all tests are plain column expressions."""
    spark = df.sparkSession
    word = F.col("word")
    if letters_only:
        words = df.select(key, F.posexplode(F.split(F.col(text), BLANKS)).alias("pos", "word"))
        words = words.withColumn("word", F.regexp_replace(
            "word", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")).where(word.rlike(r"^\p{L}+$"))
    else:
        words = df.select(key, F.posexplode(F.split(F.col(text), NON_LETTERS)).alias("pos", "word"))
        words = words.where(F.length("word") > 0)
    words = words.select(key, "pos", (word if case_sensitive else F.lower("word")).alias("term"))
    if lemmas is not None:
        words = words.join(_lemma_table(spark, lemmas), F.col("term") == F.col("form"), "left").select(
            key, "pos", F.coalesce("lemma", "term").alias("term"))
    kept = words.where(F.length("term") >= min_len).join(_words_table(spark, stop_words), "term", "left_anti")
    return kept.select(key, "pos", F.lower("term").alias("term"))


def doc_terms_in_pandas(df: DataFrame, key: str, text: str,
                        make_annotator: Callable[[], Callable[[str], list[str]]], *,
                        min_terms: int = 2) -> DataFrame:
    """(key, terms) by an annotator that column functions cannot express (a tagger, a
    lemmatiser model). ``make_annotator()`` runs once per partition; documents stream
    through in Arrow batches, and no document leaves its partition. A null text has no
    terms."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        annotate = make_annotator()
        for pdf in batches:
            terms = pdf[text].map(lambda t: annotate(t) if isinstance(t, str) else [])
            keep = terms.map(len) >= min_terms
            yield pdf.loc[keep, [key]].assign(terms=terms[keep].values)
    return df.select(key, text).mapInPandas(run, f"{key} {key_type}, terms array<string>")


def doc_terms(df: DataFrame, key: str, text: str, *, min_terms: int = 2, **options) -> DataFrame:
    """(key, terms), in text order, of documents with at least ``min_terms`` terms; options
    as in ``token_rows``. Row by row, without a shuffle, unless a list of words is too long
    for that: then the terms are shuffled once, by their document."""
    lists = _small_lists(df.sparkSession, **options)
    if lists is not None:
        words = F.transform(_words_of(text, options.get("letters_only", False)), lists.term)
        kept = F.filter(words, lists.kept)
        terms = F.transform(kept, F.lower) if lists.forms or lists.case_sensitive else kept
        return _once(widened(df.select(key, text)), [key], terms=terms).where(F.size("terms") >= min_terms)
    rows = token_rows(df, key, text, **options)
    placed = F.sort_array(F.collect_list(F.struct("pos", "term")))
    return (rows.groupBy(key).agg(F.transform(placed, lambda p: p["term"]).alias("terms"))
            .where(F.size("terms") >= min_terms))


def term_freq(terms: DataFrame, key: str) -> DataFrame:
    """Long form (key, term, tf)."""
    return (terms.select(key, F.explode("terms").alias("term"))
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_freq_from_text(df: DataFrame, key: str, text: str, *, min_terms: int = 2,
                        **options) -> DataFrame:
    """Long form (key, term, tf) straight from the text, same rules as ``doc_terms``. Words are
    counted in the task of their document before the one exchange, which is of the counts.

    Whether a document has enough terms is told by its first ``LOOK`` words, or else by all;
    the words of those that have are exploded, so that the tests on them are compiled."""
    lists = _small_lists(df.sparkSession, **options)
    if lists is not None:
        words = _once(widened(df.select(key, text)), [key], words=_words_of(text, options.get("letters_only", False)))

        def enough(some: Column) -> Column:
            return F.size(F.filter(some, lambda w: lists.kept(lists.term(w)))) >= min_terms

        first = F.slice("words", 1, LOOK)
        rows = words.where(F.when(enough(first), True).otherwise(enough(F.col("words"))))
        rows = rows.select(key, F.explode("words").alias("word")).select(key, lists.term(F.col("word")).alias("term"))
        rows = rows.where(lists.kept(F.col("term"))).select(key, F.lower("term").alias("term"))
        return rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    rows = token_rows(df, key, text, **options)
    tf = rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    enough = tf.groupBy(F.col(key).alias("_k")).agg(F.sum("tf").alias("_n")).where(F.col("_n") >= min_terms)
    return tf.join(enough, F.col(key).eqNullSafe(F.col("_k")), "left_semi")


def vocabulary(tf: DataFrame, vocab_size: int = 20000) -> DataFrame:
    """(term_id, term, count, df): the ``vocab_size`` terms with the largest total count,
    ties by term; ids 0.. in that order; ``df`` = documents holding the term. One
    aggregation over the term counts gives both statistics; then a bounded top-k and a
    numbering of at most ``vocab_size`` rows."""
    stats = tf.groupBy("term").agg(F.sum("tf").alias("count"), F.count(F.lit(1)).alias("df"))
    top = stats.orderBy(F.col("count").desc(), F.col("term")).limit(vocab_size)
    w = Window.orderBy(F.col("count").desc(), F.col("term"))
    return top.select((F.row_number().over(w) - 1).alias("term_id"), "term", "count", "df")


def idf(tf: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """(term_id, term, df, idf) with idf = ln((N + 1) / (df + 1)), N = documents.
    Document frequencies come with the vocabulary when it carries them."""
    n_docs = tf.select(key).distinct().agg(F.count(F.lit(1))).scalar()
    if "df" not in vocab.columns:
        dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        vocab = F.broadcast(vocab).join(dfreq, "term")
    return vocab.select("term_id", "term", "df",
                        F.log((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def tfidf(tf: DataFrame, key: str, idf_table: DataFrame) -> DataFrame:
    """(key, term_id, term, tf, tfidf) for vocabulary terms (the idf table is bounded
    by the vocabulary size, so it is broadcast)."""
    return (tf.join(F.broadcast(idf_table.select("term_id", "term", "idf")), "term")
            .select(key, "term_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")))


def tfidf_vectors(terms: DataFrame, key: str, vocab_size: int = 20000,
                  vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Spark ML form: term-count vectors + IDF → ((key, tfidf vector), (term_id, term)).
    The document key stays beside its vector (no positional id map).

    With ``vocab`` (term_id, term, …, at most ``vocab_size`` rows, e.g. from
    ``vocabulary``) the vector slots follow that deterministic order; otherwise
    ``CountVectorizer`` picks the vocabulary (ties in count in any order)."""
    if vocab is not None:
        words = [r.term for r in collected(vocab.orderBy("term_id").select("term"), vocab_size)]
        cv_model = CountVectorizerModel.from_vocabulary(words, inputCol="terms",
                                                        outputCol="termFreqs")
    else:
        cv_model = CountVectorizer(inputCol="terms", outputCol="termFreqs",
                                   vocabSize=vocab_size).fit(terms)
    freqs = cv_model.transform(terms)
    idf_model = IDF(inputCol="termFreqs", outputCol="tfidfVec").fit(freqs)
    vectors = idf_model.transform(freqs).select(key, "tfidfVec")
    spark = terms.sparkSession
    vocab_table = spark.createDataFrame(list(enumerate(cv_model.vocabulary)),
                                        "term_id int, term string")
    return vectors, vocab_table
