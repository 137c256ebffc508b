"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base entities (email, ip, card, phone) are found by pattern and checked. They are the
seeds: every run of words with a digit or @ is an instance, every instance has patterns (the
two words before it; the word before or after it with its shape; its exact shape), and
instances that are a base entity are certain. Pattern and instance tables then score each
other: a pattern's confidence in a kind is the share of its distinct instances that are
held to be of that kind, and an instance not yet known is held to be of a kind by the
noisy-or of its reliable patterns (confidence of at least ``confident``, at least ``support``
seeds). What a pattern makes of an instance does not count for that pattern: an instance
is held by a pattern's other evidence only (leave one out), so no pattern confirms itself.
An instance that looks like a kind and fails the kind's check is never of that kind, and
counts against the patterns it has; a shape alone holds nothing, a word must stand by it.
After ``rounds`` rounds the instances so found are added as spans, wherever a reliable
pattern with a word meets them and no base span lies.

Distinct (pattern, instance) pairs count once, so copies of a text lend no weight; all sums
are partial aggregates, so a pattern that a third of all rows has is no hot spot.

Patterns are written so that matching is linear in the text: possessive runs, tried only
where a run of their characters begins or the last match ended.

Defined results: a null or empty text has no spans; rows that repeat have the same spans
each; null ids stay; spans are in code points, end exclusive; an empty table gives an empty
result. Columns are taken by name and others ignored. Texts and words of any length are read
whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workbench.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# What the base entities look like (the same languages as the plain patterns
# `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`, `[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)`,
# `[0-9]([\x20-]?[0-9])+` and `\+[0-9][\x20().0-9-]+[0-9]`, leftmost and longest).
LOOKS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"^(?:{BYTE}\.){{3}}{BYTE}$"
TOKEN = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
RUN = rf"(?<![^\x20\x09-\x0D]){TOKEN}(?:\x20{TOKEN})*+"
OPENING, CLOSING = r"^[\"'<({\[*#$%&|!?.,;:=]*+", r"[\"'>)}\]*#$%&|!?.,;:=]++$"
# The two words before a run and the word after it, whole.
LAST_TWO = r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++)?[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+$"
NEXT = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
SHAPE = "shape\t"
ROUNDS, CONFIDENT, SUPPORT = 3, 0.6, 3


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit counts twice."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))
        .otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern is an entity."""
    digits = _digits(match)
    if kind == "ip":
        return match.rlike(IP)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _pieces(guard: Column, pattern: str) -> tuple[Column, Column]:
    """(texts between matches, matches); both empty where ``guard`` does not hold."""
    none = F.array().cast("array<string>")
    return (F.when(guard, F.split("text", pattern, -1)).otherwise(none),
            F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))


def _matches(rows: DataFrame) -> DataFrame:
    """(r, id, one array per kind of (gap, match), runs (gap, match, left, right)): every
    match with the number of characters since the last one; runs with their context."""
    digit, at = F.col("text").rlike("[0-9]"), F.col("text").contains("@")
    guards = {"email": at, "ip": digit, "card": digit, "phone": digit & F.col("text").contains("+")}
    cut, both = {}, {**{k: (guards[k], LOOKS[k]) for k in KINDS}, "runs": (digit | at, RUN)}
    for k, (guard, pattern) in both.items():
        cut[f"{k}_gaps"], cut[f"{k}_found"] = _pieces(guard, pattern)
    split = rows.select("id", *[c.alias(k) for k, c in cut.items()])
    zipped = [F.zip_with(F.slice(f"{k}_gaps", 1, F.size(f"{k}_found")), f"{k}_found",
                         lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("match"))).alias(k)
              for k in KINDS]
    n = F.size("runs_found")
    left = F.transform(F.slice("runs_gaps", 1, n), lambda p: F.struct(
        F.length(p).alias("gap"), F.regexp_extract(p, LAST_TWO, 0).alias("left")))
    right = F.transform(F.slice("runs_gaps", 2, n), lambda p: F.regexp_extract(p, NEXT, 0))
    runs = F.transform(F.arrays_zip(left.alias("l"), F.col("runs_found").alias("m"), right.alias("x")),
                       lambda z: F.struct(z["l"]["gap"].alias("gap"), z["m"].alias("match"),
                                          z["l"]["left"].alias("left"), z["x"].alias("right")))
    return split.select(F.monotonically_increasing_id().alias("r"), "id", *zipped, runs.alias("runs"))


def _placed(exploded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, pos, gap, match, ...) with the match's start and end in its text."""
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    return (exploded.withColumn("end", F.sum(F.col("gap") + size).over(before).cast("int"))
            .withColumn("start", F.col("end") - size))


def base_spans(matches: DataFrame) -> DataFrame:
    """(r, kind_no, start, end) of the entities that pass."""
    by_kind = [matches.select("r", F.lit(no).alias("kind_no"), F.posexplode(kind).alias("pos", "m"))
               .select("r", "kind_no", "pos", "m.gap", "m.match") for no, kind in enumerate(KINDS)]
    placed = _placed(reduce(DataFrame.unionAll, by_kind), ["r", "kind_no"])
    ok = reduce(lambda c, no: c.when(F.col("kind_no") == no, passes(KINDS[no], F.col("match"))),
                range(len(KINDS)), F)
    return placed.filter(ok).select("r", "kind_no", "start", "end")


def _looks(kind: str) -> Column:
    return F.col("core").rlike(f"^(?:{LOOKS[kind]})$")


def _of_kind(test) -> Column:
    """Number of the first kind that passes ``test``, or null."""
    return reduce(lambda c, no: c.when(test(KINDS[no]), F.lit(no)), range(len(KINDS)), F)


def instances(matches: DataFrame) -> DataFrame:
    """(r, start, end, instance, seed_no, failed_no, patterns) of every run, without the marks
    around it; ``seed_no``: number of the kind that it is a base entity of, or null;
    ``failed_no``: of the kind that it looks like and whose check it fails."""
    runs = _placed(matches.select("r", F.posexplode("runs").alias("pos", "m"))
                   .select("r", "pos", "m.*"), ["r"])
    lead = F.length(F.regexp_extract("match", OPENING, 0))
    core = F.regexp_replace(F.expr("substring(match, lead + 1)"), CLOSING, "")
    words = F.filter(F.split(F.lower("left"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    after = F.filter(F.split(F.lower("right"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cored = (runs.withColumn("lead", lead).withColumn("core", core).filter(F.col("core") != "")
             .withColumn("before", words).withColumn("after", after))
    exact = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "core", r"\p{Lu}++", "A"), r"\p{Ll}++", "a"), "[0-9]", "9")
    shape = F.regexp_replace(exact, "9++", "9")
    last, last2 = F.element_at("before", -1), F.element_at("before", -2)
    none = F.lit(None).cast("string")
    patterns = F.array_compact(F.array(
        F.when(F.size("before") > 1, F.concat_ws("\t", F.lit("two"), last2, last)).otherwise(none),
        F.when(F.size("before") > 0, F.concat_ws("\t", F.lit("left"), last, shape)).otherwise(none),
        F.when(F.size("after") > 0, F.concat_ws("\t", F.lit("right"), shape, F.element_at("after", 1)))
        .otherwise(none),
        F.concat(F.lit(SHAPE), exact)))
    seed = _of_kind(lambda k: _looks(k) & passes(k, F.col("core")))
    failed = _of_kind(lambda k: _looks(k) & ~passes(k, F.col("core")))
    return cored.select("r", (F.col("start") + F.col("lead")).alias("start"),
                        (F.col("start") + F.col("lead") + F.length("core")).alias("end"),
                        F.lower("core").alias("instance"), seed.alias("seed_no"),
                        failed.alias("failed_no"), patterns.alias("patterns"))


def discover(found: DataFrame, *, rounds: int = ROUNDS, confident: float = CONFIDENT,
             support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Reliable patterns (pattern, kind_no, confidence, support) and discovered instances
    (instance, kind_no, belief) of the table of ``instances``."""
    edges = stored(found.select("instance", "seed_no", "failed_no", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "instance").agg(F.max("seed_no").alias("seed_no"),
                                                       F.max("failed_no").alias("failed_no")), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    # (a pattern with too few seeds can never matter)
    seeds = (edges.filter("seed_no is not null").groupBy("pattern", F.col("seed_no").alias("kind_no"))
             .agg(F.count("*").alias("support")).filter(F.col("support") >= support).join(sizes, "pattern"))
    seeds = stored(seeds, "pii-seeds")
    others = edges.filter("seed_no is null")
    held, beliefs = None, None
    for _ in range(rounds):
        scored = seeds.withColumn("held", F.lit(0.0)) if held is None else seeds.join(
            held, ["pattern", "kind_no"], "left").fillna(0.0, ["held"])
        reliable = stored(scored.withColumn("confidence", (F.col("support") + F.col("held")) / F.col("size"))
                          .filter(F.col("confidence") >= confident)
                          .select("pattern", "kind_no", "confidence", "support"), "pii-patterns")
        doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))
        votes = (others.join(reliable, "pattern")
                 .filter(F.col("failed_no").isNull() | (F.col("failed_no") != F.col("kind_no")))
                 .select("pattern", "instance", "kind_no", doubt.alias("doubt")))
        votes = stored(votes, "pii-votes")
        by_kind = votes.groupBy("instance", "kind_no").agg(
            F.sum("doubt").alias("doubts"), F.max(~F.col("pattern").startswith(SHAPE)).alias("worded")).filter("worded")
        by_kind = stored(by_kind.withColumn("belief", 1 - F.exp("doubts")), "pii-kinds")
        best = by_kind.groupBy("instance").agg(F.max(F.struct("belief", -F.col("kind_no"))).alias("b"))
        beliefs = stored(best.select("instance", (-F.col("b.col2")).cast("int").alias("kind_no"),
                                     F.col("b.belief").alias("belief")), "pii-beliefs")
        # what each pattern's instances are held to be by everything but the pattern itself
        own = votes.select("pattern", "instance", "kind_no", "doubt")
        told = others.select("pattern", "instance").join(
            beliefs.select("instance", "kind_no").join(by_kind, ["instance", "kind_no"]), "instance").join(
            own, ["pattern", "instance", "kind_no"], "left")
        rest = F.col("doubts") - F.coalesce("doubt", F.lit(0.0))
        held = told.groupBy("pattern", "kind_no").agg(F.sum(1 - F.exp(rest)).alias("held"))
    return reliable, beliefs


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_no"] + 1), s["start"], s["end"])), ",")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row: counts and list of
    the base entities, and the list of all spans, as kind:start:end joined by commas."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    matches = stored(_matches(rows), "pii-matches")
    base = stored(base_spans(matches), "pii-base")
    found = stored(instances(matches), "pii-instances")
    reliable, beliefs = discover(found, **options)
    new = (found.filter("seed_no is null").join(beliefs, "instance")
           .withColumn("pattern", F.explode("patterns")).filter(~F.col("pattern").startswith(SHAPE))
           .join(reliable.select("pattern", "kind_no"), ["pattern", "kind_no"], "left_semi")
           .select("r", "kind_no", "start", "end").distinct())
    old = base.select("r", F.col("start").alias("s"), F.col("end").alias("e"))
    free = new.join(old, (new["r"] == old["r"]) & (new["start"] < old["e"]) & (old["s"] < new["end"]),
                    "left_anti")
    span = F.struct("start", "kind_no", "end")
    per_text = (base.withColumn("is_base", F.lit(True))
                .unionByName(free.withColumn("is_base", F.lit(False)))
                .groupBy("r").agg(
                    *[F.count_if(F.col("is_base") & (F.col("kind_no") == no)).alias(f"n_{k}")
                      for no, k in enumerate(KINDS)],
                    _joined(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
                    _joined(F.collect_list(span)).alias("spans")))
    zero, blank = F.lit(0).cast("bigint"), F.lit("")
    return matches.select("r", "id").join(per_text, "r", "left").select(
        F.col("id").alias("doc_id"), *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in KINDS],
        F.coalesce("base", blank).alias("base"), F.coalesce("spans", blank).alias("spans"))
