"""Fixtures and plain Python versions shared by the tests of the subpackage."""

import re

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, r int, "
           "row_no int, kept int, score string, spans int, n_words int, first string")
LONG = " ".join(f"word{k % 977} and" for k in range(40_000))


def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    def row(doc_id, text):
        return (doc_id, text, "en", "src0", 1, "x", 2, 3, 4, "5", 6, 7, "8")
    texts = [(5, "The same text."), (3, "The  same\ttext."), (9, "the same text."), (4, None), (7, ""),
             (8, " \t\n"), (2, LONG), (11, LONG + " end"), (None, "The same text."), (None, None),
             (12, "É日本 😀 x@y.org +1 (234) 555-1234 <|endoftext|>"), (13, "a"), (13, "a"), (13, "b")]
    return [row(*x) for x in texts] + [(None,) * 13] + [row(2, LONG)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text):
    """Words of the contracts that go by white space, in lower case."""
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


class Groups:
    """Plain union-find."""

    def __init__(self, items):
        self.up = {x: x for x in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
