"""Lemmas of words that no dictionary lists: suffix rules induced from (form, lemma) pairs.

A pair says what to cut from the end of the form and what to add: all after the longest
common prefix. Every suffix of a form, down to the empty one, votes for its pair's change;
the commonest change of a suffix with enough votes is its rule. A form takes the rule of its
longest suffix that has one: the rules are the nodes of a trie over reversed words, kept as a
table. A rule that says the same as the next shorter one is left out, and forms that the
rules get wrong are exceptions. All steps are joins and aggregates over distinct words.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workbench.session import materialised

MAX_SUFFIX, MIN_VOTES = 6, 2


class Rules(NamedTuple):
    """``suffixes``: (suffix, cut, added, votes); ``exceptions``: (form, lemma)."""

    suffixes: DataFrame
    exceptions: DataFrame


def _change() -> tuple[Column, Column]:
    """Letters to cut from ``form`` and letters to add for ``lemma``."""
    shorter = F.least(F.length("form"), F.length("lemma"))
    shared = F.size(F.filter(F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))), lambda i: (
        (i <= shorter) & (F.col("form").substr(F.lit(1), i) == F.col("lemma").substr(F.lit(1), i)))))
    return F.length("form") - shared, F.substring(F.col("lemma"), shared + 1, F.length("lemma"))


def _suffixes(df: DataFrame, max_suffix: int) -> DataFrame:
    """``df`` once for each suffix of ``form``, from the empty one to ``max_suffix`` letters."""
    sizes = F.explode(F.sequence(F.lit(0), F.least(F.length("form"), F.lit(max_suffix)))).alias("size")
    cut = df.select("*", sizes)
    return cut.withColumn("suffix", F.substring(F.col("form"), F.length("form") - F.col("size") + 1, F.col("size")))


def _clean(pairs: DataFrame) -> DataFrame:
    """(form, lemma): distinct pairs without nulls and empty words."""
    return pairs.select(F.col(pairs.columns[0]).alias("form"), F.col(pairs.columns[1]).alias("lemma")).where(
        (F.length("form") > 0) & (F.length("lemma") > 0)).distinct()


def induce(pairs: DataFrame, *, max_suffix: int = MAX_SUFFIX, min_votes: int = MIN_VOTES) -> Rules:
    """Rules and exceptions from a table whose first columns are (form, lemma)."""
    known = materialised(_clean(pairs), "pairs")
    cut, added = _change()
    votes = _suffixes(known.select("form", cut.alias("cut"), added.alias("added")), max_suffix)
    # a suffix is at least as long as what its change cuts
    counted = votes.where(F.col("size") >= F.col("cut")).groupBy("size", "suffix", "cut", "added").agg(
        F.count(F.lit(1)).alias("votes")).where(F.col("votes") >= min_votes)
    order = Window.partitionBy("suffix").orderBy(F.desc("votes"), "cut", "added")
    best = materialised(counted.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k"), "rules")
    # the shorter suffix next to a rule's own that has a rule: one that says the same makes it needless
    shorter = _suffixes(best.where("size > 0").select(F.substring(F.col("suffix"), F.lit(2), F.length("suffix"))
                                                      .alias("form"), F.col("suffix").alias("of")), max_suffix)
    above = shorter.join(best.select("suffix", F.struct("size", "cut", "added").alias("rule")), "suffix").groupBy(
        "of").agg(F.max("rule").alias("rule"))
    needless = above.select(F.col("of").alias("suffix"), F.col("rule.cut").alias("cut"), F.col("rule.added").alias("added"))
    rules = materialised(best.join(needless, ["suffix", "cut", "added"], "left_anti")
                         .select("suffix", "cut", "added", "votes"), "suffix-rules")
    guessed = _guess(known.select("form").distinct(), rules, max_suffix)
    # of several lemmas of one form the greatest counts
    right = known.groupBy("form").agg(F.max("lemma").alias("lemma"))
    wrong = right.join(guessed.withColumnRenamed("lemma", "_guess"), "form").where("lemma != _guess")
    return Rules(rules, materialised(wrong.select("form", "lemma"), "exceptions"))


def _guess(words: DataFrame, rules: DataFrame, max_suffix: int) -> DataFrame:
    """(form, lemma) by the rule of the longest suffix; without one, the form itself."""
    found = _suffixes(words, max_suffix).join(rules.select("suffix", "cut", "added"), "suffix").groupBy("form").agg(
        F.max(F.struct("size", "cut", "added")).alias("r"))
    changed = F.concat(F.substring(F.col("form"), F.lit(1), F.length("form") - F.col("r.cut")), F.col("r.added"))
    return words.join(found, "form", "left").select("form", F.coalesce(changed, "form").alias("lemma"))


def lemmatise(words: DataFrame, rules: Rules, *, max_suffix: int = MAX_SUFFIX) -> DataFrame:
    """(form, lemma) of each distinct word of the first column of ``words``: its exception, or
    else the rule of its longest suffix, or else itself."""
    forms = words.select(F.col(words.columns[0]).alias("form")).where(F.length("form") > 0).distinct()
    by_rule = _guess(forms, rules.suffixes, max_suffix).withColumnRenamed("lemma", "_guess")
    return by_rule.join(rules.exceptions, "form", "left").select("form", F.coalesce("lemma", "_guess").alias("lemma"))
