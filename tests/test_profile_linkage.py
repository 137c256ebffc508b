"""Profiling, transposed summaries, group comparison, pair score, cross-tabs (T1–T4),
constant columns (AG20)."""

import math

from workbench.operators import linkage, profile

PAIRS = ("id_1 int, id_2 int, cmp_fname_c1 double, cmp_lname_c1 double, cmp_plz int, "
         "cmp_by int, cmp_bd int, cmp_bm int, is_match boolean")


def _pairs(spark):
    rows = [
        (1, 2, 1.0, 1.0, 1, 1, 1, 1, True),      # score 5
        (1, 3, None, 1.0, 1, 1, 1, None, True),  # score 4 exactly
        (2, 3, 0.5, None, None, None, None, None, False),  # all-null compare -> 0
        (4, 5, 0.2, 0.5, 0, 1, 0, 0, False),     # 1.5
        (6, 7, 0.9, 1.0, 1, 0, 1, 0, None),      # null label
    ]
    return spark.createDataFrame(rows, PAIRS)


def test_value_counts_and_sql_agree(spark):
    df = _pairs(spark)
    a = sorted(map(tuple, profile.value_counts(df, "is_match").collect()), key=str)
    b = sorted(map(tuple, profile.value_counts_sql(df, "is_match").collect()), key=str)
    assert a == b and dict(a)[True] == 2 and dict(a)[None] == 1


def test_transpose_matches_describe(spark):
    df = _pairs(spark)
    desc = profile.summary(df)
    t = {r.field: r for r in profile.transpose_summary(desc).collect()}
    assert t["cmp_fname_c1"]["count"] == 4.0
    assert math.isclose(t["cmp_fname_c1"]["mean"], (1.0 + 0.5 + 0.2 + 0.9) / 4)
    assert t["cmp_bm"]["max"] == 1.0 and t["cmp_bm"]["min"] == 0.0
    assert "is_match" not in t  # booleans are not summarised


def test_grouped_summary_equals_filter_then_describe(spark):
    df = _pairs(spark)
    g = {(r.is_match, r.field): r for r in profile.grouped_summary(df, "is_match").collect()}
    for flag, cond in ((True, "is_match = true"), (False, "is_match = false")):
        t = {r.field: r for r in profile.transpose_summary(
            profile.summary(df.where(cond))).collect()}
        for field, row in t.items():
            mine = g[(flag, field)]
            for m in ("count", "mean", "min", "max"):
                assert (row[m] is None and mine[m] is None) or math.isclose(row[m], mine[m])


def test_compare_groups_excludes_and_orders(spark):
    out = profile.compare_groups(_pairs(spark), "is_match", exclude=["id_1", "id_2"]).collect()
    fields = [r.field for r in out]
    assert "id_1" not in fields and len(fields) == 6
    deltas = [r.delta for r in out if r.delta is not None]
    assert deltas == sorted(deltas, reverse=True)


def test_additive_score_null_is_zero(spark):
    cols = ["cmp_lname_c1", "cmp_plz", "cmp_by", "cmp_bd", "cmp_bm"]
    s = sorted(r.score for r in linkage.additive_score(_pairs(spark), cols).collect())
    assert s == [0.0, 1.5, 3.0, 4.0, 5.0]


def test_crosstab_threshold_and_null_cells(spark):
    cols = ["cmp_lname_c1", "cmp_plz", "cmp_by", "cmp_bd", "cmp_bm"]
    scored = linkage.additive_score(_pairs(spark), cols, keep=["is_match"])
    t4 = {r.above: (r["true"], r["false"]) for r in
          linkage.threshold_crosstab(scored, "score", "is_match", 4.0).collect()}
    # score exactly 4 counts as above; the null-label row is in no cell; empty cell is null
    assert t4 == {True: (2, None), False: (None, 2)}


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, None, None), (1.0, None, 2.0)],
                               "a double, b double, c double")
    flags = {r.field: r.constant for r in profile.constant_columns(df).collect()}
    assert flags == {"a": True, "b": True, "c": False}
    assert profile.drop_constant_columns(df).columns == ["c"]


def test_column_ranges(spark):
    r = profile.column_ranges(_pairs(spark), ["id_1", "id_2"]).first()
    assert (r.min_id_1, r.max_id_1, r.min_id_2, r.max_id_2) == (1, 6, 2, 7)
