import math
import random
import re
from collections import defaultdict

from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs
from workbench.llm import pii

# The contract's own patterns, and checks in plain Python.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain(text):
    found = [(m.start(), no, m.end(), k) for no, (k, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if passes(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def check(docs):
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(plain(r.text))
    got = {}
    rows = pii.find(docs).collect()
    for r in rows:
        got.setdefault(r.doc_id, []).append(r.base)
        base, spans = ([s for s in x.split(",") if s] for x in (r.base, r.spans))
        assert set(base) <= set(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in PATTERNS]
        order = [(int(s.split(":")[1]), list(PATTERNS).index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    return rows


def test_documents_and_random_texts(spark):
    random.seed(3)
    parts = ["1", "2", "55", ".", "-", " ", "(", ")", "+", "@", "a", "b.c", "x%", "é", "😀", "\n", "255.",
             "1.2.3.4", "4111111111111111", "+1 (234) 555-1234", "a@b.co", ","]
    rows = [(-i, "".join(random.choices(parts, k=random.randint(0, 25)))) for i in range(1, 1500)]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    check(docs.unionAll(spark.createDataFrame(rows, "doc_id bigint, text string")).repartition(3))


def test_long_runs_do_not_blow_up(spark):
    rows = [(1, "1" * 100_000), (2, "a" * 100_000), (3, "1 " * 30_000), (4, "+1" + "." * 50_000),
            (5, "x@" * 30_000), (6, "1." * 30_000), (7, "a@b.c " * 2_000)]
    check(spark.createDataFrame(rows, "doc_id int, text string"))


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please reach me at user{i}.x@mail.com today") for i in range(9)]
    rows += [(100, "please reach me at user77(a)mail7 today"), (101, "we were at 7 places, or 8"),
             (102, "nothing here"), (103, "please reach me at the gate 5")]
    rows += [(200 + i, f"call +1 (234) 555-12{i:02d} or ring +1/234/555/12{i:02d} now") for i in range(5)]
    got = {r.doc_id: r for r in check(spark.createDataFrame(rows, "doc_id int, text string"))}
    assert got[100].spans == "email:19:33" and got[100].base == ""
    assert all(got[i].spans == got[i].base for i in (*range(9), 101, 102, 103))


def plain_rounds(found, rounds=3, confident=0.6, support=3):
    """The scoring of patterns and instances over the rows of ``pii.instances``, in plain Python."""
    edges, seed, failed = defaultdict(set), {}, {}
    for r in found:
        for p in r.patterns:
            edges[p].add(r.instance)
        if r.seed_no is not None:
            seed[r.instance] = max(r.seed_no, seed.get(r.instance, -1))
        if r.failed_no is not None:
            failed[r.instance] = r.failed_no
    reliable, belief, votes = {}, {}, {}
    for _ in range(rounds):
        reliable = {}
        for p, members in edges.items():
            for k in range(4):
                n = sum(seed.get(i) == k for i in members)
                held = sum(1 - math.exp(sum(d for q, d in votes[i, k].items() if q != p))
                           for i in members if i not in seed and belief.get(i, (None,))[0] == k)
                if n >= support and (n + held) / len(members) >= confident:
                    reliable[p, k] = (n + held) / len(members)
        votes = defaultdict(dict)
        for (p, k), c in reliable.items():
            for i in edges[p]:
                if i not in seed and failed.get(i) != k:
                    votes[i, k][p] = math.log(max(1 - c, 1e-9))
        belief = {}
        for (i, k), by in sorted(votes.items(), key=lambda x: x[0][1]):
            b = 1 - math.exp(sum(by.values()))
            if any(not p.startswith(pii.SHAPE) for p in by) and b > belief.get(i, (0, -1.0))[1]:
                belief[i] = (k, b)
    return reliable, belief


def test_rounds_equal_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(8)
    rows = []
    for k in range(400):
        places = {"mail to": [f"u{k}@x{k % 9}.org", f"u{k}(at)x.org"], "call us on": [
                      f"+1 (234) 555-{1000 + k}", f"234-555-{1000 + k}"],
                  "server at": [f"10.0.{k % 250}.7", f"10.0.{k % 900}.7"], "card no": [f"41111111{10_000_000 + k}"],
                  "see page": [str(k), f"u{k}@x.org"]}
        before = rng.choice(list(places))
        # mostly what belongs there, and of that mostly what has the usual look
        among = places[before] if rng.random() < 0.9 else places["see page"]
        what = among[0] if rng.random() < 0.8 else among[-1]
        rows.append((10_000 + k, f"{before} {what} {rng.choice(['now', 'today', 'please'])}"))
    both = docs.unionAll(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = pii.stored(pii.instances(pii.stored(pii._matches(both.select(
        both.doc_id.alias("id"), "text").na.fill("", ["text"])), "m")), "i")
    reliable, beliefs = pii.discover(found)
    want_patterns, want_beliefs = plain_rounds(found.collect())
    got = {(r.pattern, r.kind_no): r.confidence for r in reliable.collect()}
    assert got.keys() == want_patterns.keys() and len(got) > 3
    assert all(math.isclose(got[k], want_patterns[k], abs_tol=1e-9) for k in got)
    held = {r.instance: (r.kind_no, r.belief) for r in beliefs.collect()}
    assert held.keys() == want_beliefs.keys() and held
    assert all(held[i][0] == k and math.isclose(held[i][1], b, abs_tol=1e-9) for i, (k, b) in want_beliefs.items())


def test_look_alikes_that_fail_are_not_discovered(spark):
    """Numbers that fail the check digit, among cards and in their contexts."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220", "6011000990139424",
            "3530111333300000", "5105105105105100", "4000056655665556"]
    rows = [(i, f"paid with card {n} yesterday") for i, n in enumerate(good)]
    rows += [(100 + i, f"paid with card {int(n) + 1} yesterday") for i, n in enumerate(good[:3])]
    rows += [(200, "order 5731080387325255 came"), (300, "paid with card 4111/1111/1111/1112 yesterday")]
    got = {r.doc_id: r for r in check(spark.createDataFrame(rows, "doc_id int, text string"))}
    assert all(got[i].spans == "" for i in (100, 101, 102, 200))
    assert all(got[i].spans == got[i].base != "" for i in range(len(good)))
    assert got[300].spans == "card:15:34"  # unlike any card, where only cards stand


def test_long_words_of_a_context_differ(spark):
    y = "y" * 100
    rows = [(i, f"{y} is {'w' * 90}{y} u{i}@x.org") for i in range(5)] + [(9, f"q{y} is {'v' * 90}{y} code7")]
    got = {r.doc_id: r for r in check(spark.createDataFrame(rows, "doc_id int, text string"))}
    assert got[9].spans == ""


def test_copies_lend_no_weight(spark):
    """One address, copied often, is one instance: too little support for its context."""
    rows = [(i, "write to only@one.org soon") for i in range(50)] + [(99, "write to somebody5 soon")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[99].spans == ""


def test_edges_and_empty_table(spark):
    assert len(check(edge_docs(spark))) == 16
    assert pii.find(empty_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.find(edge_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
