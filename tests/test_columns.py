"""Column functions: expected values from the reference's tests."""

import datetime as dt

from pyspark.sql import functions as F

from keepsake.functions import columns as U


def _one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(expr.alias("x")).first()["x"]


def test_backup_table_id(spark):
    got = _one(spark, U.backup_table_id("p", "d", "t", F.col("ts").cast("timestamp_ntz")),
               p="test-project", d="test_dataset", t="test_table", ts="1901-12-22 05:15:15")
    assert got == "19011222_051515_test_project_test_dataset_test_table"
    got = _one(spark, U.backup_table_id("p", "d", "t", F.col("ts").cast("timestamp_ntz"), "q"),
               p="a-b", d="d", t="t", ts="2018-01-01 00:00:00", q="20180101")
    assert got == "20180101_000000_a_b_d_t_partition_20180101"
    long = _one(spark, U.backup_table_id("p", "d", "t", F.col("ts").cast("timestamp_ntz")),
                p="p", d="d", t="x" * 2000, ts="2018-01-01 00:00:00")
    assert len(long) == 1021 and long[1000] == "_"  # 1000 + "_" + 20-char checksum


def test_backup_table_id_null_is_error(spark):
    df = spark.createDataFrame([(None, "d", "t")], "p string, d string, t string")
    assert df.select(U.backup_table_id("p", "d", "t", F.current_timestamp()).alias("id")).first()["id"] is None


def test_backup_dataset_id(spark):
    assert _one(spark, U.backup_dataset_id(F.to_date(F.lit("1901-12-21")), F.lit("US"), F.lit("project123"))) \
        == "1901_51_US_project123"
    assert _one(spark, U.backup_dataset_id(F.to_date(F.lit("2016-01-01")), F.lit("EU"), F.lit("a-b"))) \
        == "2016_53_EU_a_b"


def test_table_reference(spark):
    df = spark.createDataFrame([("proj321:dataset123.tableabc$20180226",), ("proj_321:dataset.table",),
                                ("project:dataset.table",), ("project:dataset",), ("p0:d.t",)], "s string")
    out = {r["s"]: r["r"] for r in df.select("s", U.parse_table_ref("s").alias("r")).collect()}
    ok = out["proj321:dataset123.tableabc$20180226"]
    assert (ok.project_id, ok.dataset_id, ok.table_id, ok.partition_id) == \
        ("proj321", "dataset123", "tableabc", "20180226")
    assert out["proj_321:dataset.table"] is None
    assert out["project:dataset"] is None
    assert out["p0:d.t"] is None  # no '0' allowed in a project
    assert out["project:dataset.table"].partition_id is None


def test_backup_key(spark):
    import base64
    good = base64.b64encode(b'"Table", 6394035673497600, "Backup", 5629499534213120').decode()
    bad = base64.b64encode(b'"Table", 6394035673497600, "Backup"').decode()
    df = spark.createDataFrame([(good,), (bad,), ("%%%",)], "k string")
    out = [r["r"] for r in df.select(U.parse_backup_key("k").alias("r")).collect()]
    assert (out[0].table_id, out[0].backup_id) == (6394035673497600, 5629499534213120)
    assert out[1] is None and out[2] is None


def test_camel_case_and_iso(spark):
    df = spark.createDataFrame([("In Progress",), ("Done",), ("unknown",)], "s string")
    assert [r["c"] for r in df.select(U.camel_case("s").alias("c")).collect()] == ["inProgress", "done", "unknown"]
    ts = spark.createDataFrame([(dt.datetime(2017, 1, 2, 3, 4, 5),), (dt.datetime(2017, 1, 2, 3, 4, 5, 6),),
                                (None,)], "t timestamp_ntz")
    assert [r["i"] for r in ts.select(U.iso_text("t").alias("i")).collect()] == \
        ["2017-01-02T03:04:05", "2017-01-02T03:04:05.000006", None]


def test_copy_request_key_nfkd(spark):
    df = spark.createDataFrame([("p:d.tábla$20180101",)], "ref string")
    got = df.select(U.copy_request_key(F.to_date(F.lit("2018-02-01")), F.col("ref"), F.lit(2),
                                       F.lit(None)).alias("k")).first()["k"]
    assert got == "2018-02-01_p_d_tabla_20180101_2_None"


def test_copy_errors_message(spark):
    df = spark.createDataFrame([([("backendError", "boom"), ("invalid", None)],)],
                               "e array<struct<reason:string,message:string>>")
    assert df.select(U.copy_errors_message("e").alias("m")).first()["m"] == \
        "Copy job finished with errors: backendError:boom, invalid:No message provided"


def test_json_is_told_from_text_as_by_the_parser(spark):
    """The test on the beginning of a text spares the parser, but never decides otherwise."""
    values = ['{"a":1}', "[1,2]", '"x"', "1", "-1", "1.5e3", "true", "false", "null", " true ", '\n\t{"a": [ ]}', "note", "tree", "nul", "nan", "NaN",
              "Infinity", "-Infinity", "+1", ".5", "", "  ", "a:1", "{a:1}", "'x'", "//c\n1", "﻿1", " 1", "\x0b1", "01", "trueish", "x{", "\x001",
              None, "#c\n1", "/*c*/1", "T", "n", "-", "é", "low priority"]
    got = spark.createDataFrame([(x,) for x in values], "s string").select(
        "s", U.json_or_text("s")[0].alias("is_json"), F.when(F.col("s").isNotNull(), F.try_parse_json("s").isNotNull()).alias("parsed")).collect()
    assert [r.s for r in got if r.is_json != r.parsed] == []
    assert {r.s for r in got if r.is_json} >= {'{"a":1}', "[1,2]", '"x"', "1", "true", "null", " true "}
