from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rarespark.operators import quality
from rarespark.plans.fixtures import FEATURES
from rarespark.plans.ingest_queries import raw_csv
from rarespark.sources import preamble_csv

PREAMBLE = ["Free text, with commas", "", "a,b,c"]


def write(tmp_path, lines, name="in.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_short_and_long_lines(spark, tmp_path):
    path = write(
        tmp_path,
        [*PREAMBLE, "class,f1,f2", "pos,1,na", "neg,NaN,2.5", "", "neg,,x", "pos,1", "neg,1,2,3"],
    )
    rows, rejects = preamble_csv.read_preamble_csv(spark, path)
    assert rows.columns == ["class", "f1", "f2"]
    assert [r["line"] for r in rejects.collect()] == ["neg,1,2,3"]
    cleaned = preamble_csv.numeric_coerce(preamble_csv.na_to_null(rows, ["f1", "f2"]), ["f1", "f2"])
    got = sorted((r["class"], r["f1"], r["f2"]) for r in cleaned.fillna(-1.0).collect())
    assert got == [("neg", -1.0, -1.0), ("neg", -1.0, 2.5), ("pos", 1.0, -1.0), ("pos", 1.0, -1.0)]
    with pytest.raises(Exception, match="too many fields"):
        preamble_csv.load_file(spark, path).count()


def test_missing_header(spark, tmp_path):
    path = write(tmp_path, [*PREAMBLE, "pos,1,2"])
    with pytest.raises(ValueError, match="no header"):
        preamble_csv.read_preamble_csv(spark, path)


def test_header_too_late(spark, tmp_path):
    path = write(tmp_path, ["text"] * 30 + ["class,f1", "pos,1"])
    with pytest.raises(ValueError, match="no header"):
        preamble_csv.read_preamble_csv(spark, path)
    path = write(tmp_path, ["text"] * 29 + ["class,f1", "pos,1"], "ok.csv")
    assert preamble_csv.read_preamble_csv(spark, path)[0].count() == 1


def test_unknown_label(spark, tmp_path):
    path = write(tmp_path, ["class,f1", "pos,1", "maybe,2"])
    with pytest.raises(Exception, match="unknown label in 'class': maybe"):
        preamble_csv.load_file(spark, path).count()
    path = write(tmp_path, ["class,f1", "pos,1", ",2"], "gap.csv")
    with pytest.raises(Exception, match="<missing>"):
        preamble_csv.load_file(spark, path).select("f1").collect()


def test_headers_of_all_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        write(folder, [*PREAMBLE[:i], "class,f1", f"pos,{i}", "", "neg,na"], f"{i}.csv")
    assert preamble_csv.load_file(spark, str(folder)).count() == 6
    write(folder, ["class,f2", "pos,1"], "3.csv")
    with pytest.raises(Exception, match="headers differ"):
        preamble_csv.load_file(spark, str(folder)).count()
    write(folder, ["no header"], "3.csv")
    with pytest.raises(Exception, match="no header"):
        preamble_csv.load_file(spark, str(folder)).count()


def test_split_settings_may_change_between_building_and_running(spark, sensor_pdf):
    df, pdf = sensor_pdf
    out = preamble_csv.load_file(spark, raw_csv(spark, df.coalesce(2)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert out.count() == len(pdf)
        assert out.select("row_id").distinct().count() == len(pdf)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_splits_keep_all_rows(spark, sensor_pdf, sf):
    df, pdf = sensor_pdf
    path = raw_csv(spark, df.coalesce(2))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        out = preamble_csv.load_file(spark, path)
        assert out.rdd.getNumPartitions() > 5
        assert out.count() == len(pdf)
        sums = out.agg(*[F.sum(c).alias(c) for c in FEATURES]).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for c in FEATURES:
        assert sums[c] == pytest.approx(pdf[c].sum())


def test_split_widths_must_agree(spark, tmp_path):
    a = write(tmp_path, ["class,f1", "pos,1"], "a.csv")
    b = write(tmp_path, ["class,f1,f2", "pos,1,2"], "b.csv")
    with pytest.raises(ValueError, match="f2"):
        preamble_csv.load_split_pair(spark, a, b)


def test_rules_fail_when_they_should(spark):
    df = spark.createDataFrame([(0,), (2,)], "y int")
    assert not quality.label_domain_rule(df).first()["ok"]
    even = spark.createDataFrame([(0,), (1,)], "y int")
    assert quality.label_domain_rule(even).first()["ok"]
    assert not quality.imbalance_rule(even).first()["ok"]
    checks = {r["rule"]: r["ok"] for r in quality.split_leak_check(even, even).collect()}
    assert checks == {"labels_complete": True, "train_larger": False, "test_not_resampled": False}


def test_overlap_treats_nulls_as_equal(spark):
    schema = "row_id int, a double, b double"
    train = spark.createDataFrame([(1, 1.0, None), (2, 1.0, None), (3, 2.0, 2.0)], schema)
    test = spark.createDataFrame([(10, 1.0, None), (11, 2.0, None)], schema)
    assert [r["row_id"] for r in quality.row_overlap(train, test, ["a", "b"]).collect()] == [10]


def test_overlap_of_a_hot_tuple(spark):
    """One tuple that most rows of both sides have."""
    rows = spark.range(3000).selectExpr("id as row_id", "if(id % 10 < 9, 1.0, cast(id as double)) as a")
    got = quality.row_overlap(rows.where("row_id % 2 = 0"), rows.where("row_id % 2 = 1"), ["a"])
    assert got.count() == rows.where("row_id % 2 = 1 and a = 1.0").count()


def test_blank_rows_break_the_schema_rules(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, None)], "row_id int, y int, f double")
    got = {r["rule"]: (r["ok"], r["detail"]) for r in quality.schema_rules(df, df, "y", width=3).collect()}
    assert got["rows_filled"] == (False, "blank=2 of 4") and got["expected_width"][0]
