"""Readers and line parsers, on hand-made edge lines (T5, T6, T7, T8)."""

import pytest
from pyspark.sql import functions as F

from workbench.operators import recommend
from workbench.session import scratch_path
from workbench.sources import files, lines


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_strict_parse_good_lines(spark):
    out = lines.parse_fields_strict(_lines(spark, ["1 2 3", "4 5 6"]), ["u", "a", "c"])
    assert sorted(map(tuple, out.collect())) == [(1, 2, 3), (4, 5, 6)]


@pytest.mark.parametrize("bad", ["1 2", "1 2 3 4", "1 x 3", " 1 2 3"])
def test_strict_parse_fails_on_bad_line(spark, bad):
    df = lines.parse_fields_strict(_lines(spark, ["1 2 3", bad]), ["u", "a", "c"])
    with pytest.raises(Exception):
        df.collect()


def test_at_least_two_fields(spark):
    out = lines.parse_fields_strict(_lines(spark, ["1 2 3", "4 5"]), ["u", "a"], exact=False)
    assert sorted(map(tuple, out.collect())) == [(1, 2), (4, 5)]


def test_lenient_id_name(spark):
    vals = ["12\tGood Name", "13 no tab", "14\t", " 15 \tX", "99999999999\tBig",
            "16\tA\tB", "+17\t  padded  ", "x18\tbad"]
    out = dict(map(tuple, lines.parse_id_name_lenient(_lines(spark, vals)).collect()))
    assert out == {12: "Good Name", 14: "", 16: "A\tB", 17: "padded"}


def test_lenient_pairs_and_alias_resolution(spark):
    vals = ["10\t1", "\t5", "11\t", "20\t2", "20\t3", "30\t20"]
    alias = lines.parse_pairs_lenient(_lines(spark, vals))
    got = sorted(map(tuple, alias.collect()))
    assert got == [(10, 1), (20, 2), (20, 3), (30, 20)]
    plays = _lines(spark, ["1 10 5", "1 30 2", "2 20 1", "2 7 1", "1 10 5"])
    counts = recommend.build_counts(plays, alias)
    rows = sorted(map(tuple, counts.collect()))
    # one hop (30 -> 20, not 2), duplicate alias -> max, unknown kept, duplicates kept
    assert rows == [(1, 1, 5), (1, 1, 5), (1, 20, 2), (2, 3, 1), (2, 7, 1)]
    agg = recommend.build_counts(plays, alias, aggregate=True)
    assert sorted(map(tuple, agg.collect())) == [(1, 1, 10), (1, 20, 2), (2, 3, 1), (2, 7, 1)]


def test_csv_null_marker_and_schema(spark):
    df = spark.createDataFrame([(1, None, True), (2, 0.5, False)],
                               "id int, x double, flag boolean")
    path = files.write_csv(df, scratch_path(spark, "t-csv"), null_value="?")
    raw = spark.read.text(path).where(F.col("value").contains("?")).count()
    assert raw == 1
    back = files.read_csv(spark, path, null_value="?", schema="id int, x double, flag boolean")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, None, True), (2, 0.5, False)]
    inferred = files.read_csv(spark, path, null_value="?")
    assert dict(inferred.dtypes)["flag"] == "boolean"


def test_positional_names_checked(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    path = files.write_csv(df, scratch_path(spark, "t-pos"), header=False)
    assert files.read_csv(spark, path, header=False, names=["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        files.read_csv(spark, path, header=False, names=["x"])


def test_xml_records_roundtrip(spark):
    df = spark.createDataFrame([("t1", "a < b & c"), ("t2", "plain")], "title string, text string")
    path = files.write_xml_records(df, scratch_path(spark, "t-xml"), "page", "root")
    back = files.read_xml_records(spark, path, "page", "title string, text string")
    assert sorted(map(tuple, back.collect())) == [("t1", "a < b & c"), ("t2", "plain")]


def test_word_set(spark):
    words = _lines(spark, ["the", " and ", "", "the"])
    path = files.write_lines(words, "value", scratch_path(spark, "t-words"))
    assert sorted(r.word for r in files.read_word_set(spark, path).collect()) == ["and", "the"]


def test_typed_view(spark):
    from workbench.sources.schema import typed_view
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert typed_view(df, "b double, a int").columns == ["b", "a"]
    with pytest.raises(TypeError):
        typed_view(df, "a bigint")
    with pytest.raises(TypeError):
        typed_view(df, "z int")


def test_strict_id_name_fails_on_corrupt_line(spark):
    good = lines.parse_id_name_strict(_lines(spark, ["12\tA", "13\t B "]))
    assert sorted(map(tuple, good.collect())) == [(12, "A"), (13, "B")]
    with pytest.raises(Exception):
        lines.parse_id_name_strict(_lines(spark, ["12\tA", "no id here"])).collect()
