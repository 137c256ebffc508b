"""Nested markup and induced lemma rules."""

import random
from collections import Counter, defaultdict

import pytest

from workbench.operators import lemmas, markup


@pytest.mark.parametrize("text,want", [
    ("a {{b|c={{d}}}} e", "a e"),
    ("[[x|y]] z [[w]]", "y z w"),
    ("[[File:a.png|thumb|cap [[q|r]] {{s}} t]] end", "end"),
    ("{| a | b {| c |} |} d", "d"),
    ("{| x\n|-\n| [[a|b]]\n|}tail", "tail"),
    ("x<ref name=a>{{cite|b}}</ref>y<ref name=b/>z", "xyz"),
    ("[[a|{{t}} b|c [[d|e]]]]", "c e"),
    ("{{a|[[b]]}} | c", "| c"),
    ("'''bold''' ''it'' == Head ==\nline", "bold it == Head line"),
    ("== Head ==\nline", "Head line"),
    ("[http://x.y lab el] [https://z] t", "lab el t"),
    ("<!-- {{ --> a <b>c</b>", "a c"),
    ("{{p|{{{1|x}}}}} b {{{c}}} d", "b d"),
    # never closed, never opened, closed in the wrong order
    ("{{open a [[b|c]] d", "open a c d"), ("a }} b ]] c", "a b c"), ("[[a|b {{c]] d}} e", "b c d e"),
    ("<ref>x", "x"), ("<!-- x", ""), ("{|", ""), ("", ""),
])
def test_constructs(text, want):
    assert markup.plain_text(text) == want


def made_up(rng, depth):
    """(markup, visible text) of a random tree of constructs."""
    out, seen = [], []
    for _ in range(rng.randint(1, 4)):
        word = f"w{rng.randrange(99)}"
        kind = rng.randrange(7) if depth else 0
        inner, text = made_up(rng, depth - 1) if kind else (word, word)
        made = {0: (inner, text), 1: ("{{t|" + inner + "}}", ""), 2: ("[[page|" + inner + "]]", text),
                3: ("<ref>" + inner + "</ref>", ""), 4: ("{| " + inner + " |}", ""),
                5: ("[[File:x|" + inner + "]]", ""), 6: ("<b>" + inner + "</b>", text)}[kind]
        out.append(made[0])
        seen.append(made[1])
    return " ".join(out), " ".join(seen)


def test_random_trees():
    rng = random.Random(4)
    for _ in range(500):
        text, want = made_up(rng, 4)
        assert markup.plain_text(text) == " ".join(want.split()), text


def test_deep_nesting_is_one_pass():
    n = 50_000
    assert markup.plain_text("{{" * n + "x" + "}}" * n + " y") == "y"
    assert markup.plain_text("[[a|" * n + "x" + "]]" * n) == "x"


def test_markup_of_a_table(spark):
    df = spark.createDataFrame([(1, "a {{b}}"), (2, None), (3, "{{x}}"), (None, "[[c|d]]")], "k int, m string")
    assert sorted(map(tuple, markup.markup_text(df, "k", "m").collect()), key=str) == [(1, "a"), (None, "d")]


# ---- lemmas ---------------------------------------------------------------------------
def plain_rules(pairs, max_suffix=6, min_votes=2):
    def change(form, lemma):
        n = 0
        while n < min(len(form), len(lemma)) and form[n] == lemma[n]:
            n += 1
        return len(form) - n, lemma[n:]
    votes = defaultdict(Counter)
    for form, lemma in pairs:
        cut, added = change(form, lemma)
        for size in range(cut, min(len(form), max_suffix) + 1):
            votes[form[len(form) - size:]][cut, added] += 1
    rules = {}
    for suffix, counts in votes.items():
        best = min(((-n, *c) for c, n in counts.items() if n >= min_votes), default=None)
        if best:
            rules[suffix] = best[1:]

    def guess(form):
        for size in range(min(len(form), max_suffix), -1, -1):
            if form[len(form) - size:] in rules:
                cut, added = rules[form[len(form) - size:]]
                return form[:len(form) - cut] + added
        return form
    lemma_of = {}
    for form, lemma in sorted(pairs):
        lemma_of[form] = lemma
    wrong = {f: x for f, x in lemma_of.items() if guess(f) != x}
    return lambda form: wrong.get(form, guess(form)), wrong


def english(rng, n):
    out = set()
    for _ in range(n):
        w = "".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(2)) + rng.choice(["n", "y", "sh", "t", "e"])
        out.add((w[:-1] + "ies" if w[-1] == "y" else w + ("es" if w.endswith("sh") else "s"), w))
        out.add((w[:-1] + "ied" if w[-1] == "y" else w + ("d" if w[-1] == "e" else "ed"), w))
    return sorted(out)


def test_rules_equal_plain_version_and_hold_for_unseen_words(spark):
    pairs = english(random.Random(1), 200) + [("went", "go"), ("mice", "mouse"), ("été", "être"), ("x", "xx")]
    held = [p for p in english(random.Random(2), 150) if p not in pairs]
    rows = [*pairs, *pairs[:5], (None, "a"), ("a", None), ("", "b")]
    rules = lemmas.induce(spark.createDataFrame(rows, "form string, lemma string").repartition(3))
    guess, wrong = plain_rules(pairs)
    assert {r.form: r.lemma for r in rules.exceptions.collect()} == wrong
    assert wrong["went"] == "go" and len(wrong) < 30
    words = [f for f, _ in held] + ["went", "mice", "été", "zzz", "s", "a"]
    got = {r.form: r.lemma for r in lemmas.lemmatise(
        spark.createDataFrame([(w,) for w in words] + [(None,), ("",)], "w string"), rules).collect()}
    assert got == {w: guess(w) for w in words}
    assert sum(got[f] == x for f, x in held) / len(held) > 0.9
    # no rule says the same as the next shorter suffix with a rule
    kept = {r.suffix: (r.cut, r.added) for r in rules.suffixes.collect()}
    for s, change in kept.items():
        above = next((kept[s[k:]] for k in range(1, len(s) + 1) if s[k:] in kept), None)
        assert above != change


def test_no_pairs(spark):
    rules = lemmas.induce(spark.createDataFrame([], "form string, lemma string"))
    words = spark.createDataFrame([("cats",)], "w string")
    assert [tuple(r) for r in lemmas.lemmatise(words, rules).collect()] == [("cats", "cats")]
