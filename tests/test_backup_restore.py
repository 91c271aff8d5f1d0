"""Golden cases for backup predicates, partition limits, as-of lookup,
restore status and SLI checks (inputs → expected from the reference's tests)."""

import datetime as dt


from keepsake.operators import backup as B
from keepsake.operators import restore as RS
from keepsake.operators import sli as S
from tests.helpers import backup, backups_df, tables_df

D = dt.datetime


def _needs(spark, unit_lm, unit_bytes, unit_rows, last_lm, last_bytes, has_copy=True):
    units = spark.createDataFrame(
        [("p", "d", "t", None, True, True, False, "US", False, "found", unit_lm, unit_bytes, unit_rows, False)],
        "project_id string, dataset_id string, table_id string, partition_id string, table_exists boolean, "
        "is_schema_defined boolean, is_external_or_view boolean, location string, "
        "has_partition_expiration boolean, lookup_status string, unit_last_modified timestamp_ntz, "
        "unit_num_bytes long, unit_num_rows long, non_day_partitioning boolean")
    t = tables_df(spark, [(1, "p", "d", "t", None, D(2017, 1, 1))])
    bs = [backup(1, last_lm + dt.timedelta(minutes=10), num_bytes=last_bytes)] if has_copy else []
    j = B.attach_last_backup(B.copyable(units), t, backups_df(spark, bs))
    return j.select(B.needs_backup(j).alias("n")).first()["n"]


def test_needs_backup_cases(spark):
    t15, t16 = D(2017, 1, 1, 15), D(2017, 1, 1, 16)
    assert _needs(spark, t16, 10, 5, t15, 10) is True          # modified after the copy
    assert _needs(spark, t15, 10, 5, t15, 10) is False         # same time, same size
    assert _needs(spark, D(2017, 1, 1, 14), 11, 5, t15, 10) is True  # older, size differs
    assert _needs(spark, t16, 0, 0, t15, 123) is False         # empty source, copy has bytes
    assert _needs(spark, t16, 10, 5, t15, 10, has_copy=False) is True


def test_copyable_reasons(spark):
    units = spark.createDataFrame([
        (False, False, False, None), (True, False, False, 5), (True, True, True, 5), (True, True, False, 0),
        (True, True, False, 5)], "table_exists boolean, is_schema_defined boolean, "
                                 "is_external_or_view boolean, unit_num_rows long")
    out = [(r["copyable"], r["reason"]) for r in B.copyable(units).collect()]
    assert out == [(False, "Table not found"), (False, "This table is without schema"),
                   (False, "This table is external or view type"), (True, "This table is empty"),
                   (True, "This table is valid")]


def test_max_partition_days(spark):
    t = tables_df(spark, [(1, "p", "d", "t", "20180215", None), (2, "p", "d", "t", "20180214", None),
                          (3, "p", "d", "t", "20180213", None), (4, "p", "d", "u", None, None)])
    got = sorted(r["id"] for r in RS.max_partition_days(t, D(2018, 2, 15), 2).collect())
    assert got == [1, 2, 4]


def test_last_copy_not_newer_than(spark):
    t = tables_df(spark, [(1, "p", "d", "t", None, None)])
    bs = backups_df(spark, [backup(1, D(2017, 2, d), id=d) for d in (3, 4, 5, 6)])
    req = spark.createDataFrame([(1, "p", "d", "t", None, D(2017, 2, 7)), (2, "p", "d", "x", None, D(2017, 2, 7)),
                                 (3, "p", "d", "t", None, D(2017, 2, 1))],
                                "request_id long, project_id string, dataset_id string, table_id string, "
                                "partition_id string, not_newer_than timestamp_ntz")
    out = {r["request_id"]: r for r in RS.as_of_backup(req, t, bs).collect()}
    assert out[1]["backup_created"] == D(2017, 2, 6) and out[1]["error"] is None
    assert out[2]["error"] == "Table not found in datastore: p:d.x"
    assert out[3]["error"] == "Backup not found for p:d.t before 2017-02-01 00:00:00"


def test_restore_status_unknown_items(spark):
    jobs = spark.createDataFrame([("j", D(2017, 1, 1), 10, "CREATE_IF_NEEDED", "WRITE_EMPTY")],
                                 "id string, created timestamp_ntz, items_count long, "
                                 "create_disposition string, write_disposition string")
    statuses = ["Done"] + ["In Progress"] * 2 + ["Failed"] * 3
    items = spark.createDataFrame([(i, "j", s) for i, s in enumerate(statuses)],
                                  "id long, job_id string, status string")
    res = {r["result"]: r["count"] for r in RS.item_results(jobs, items).collect()}
    assert res == {"done": 1, "inProgress": 2, "failed": 3, "unknown": 4}
    st = RS.job_status(jobs, items).first()
    assert st["state"] == "In progress" and st["result"] is None
    assert RS.warnings_only(items).count() == 3


def test_first_terminal_status_wins(spark):
    items = spark.createDataFrame([(1, "In Progress", None, None), (2, "Done", None, D(2017, 1, 1))],
                                  "id long, status string, status_message string, completed timestamp_ntz")
    ev = spark.createDataFrame([(1, D(2017, 1, 2), "Failed", "boom"), (1, D(2017, 1, 3), "Done", None),
                                (2, D(2017, 1, 2), "Failed", "late")],
                               "item_id long, event_time timestamp_ntz, status string, message string")
    out = {r["id"]: r for r in RS.fold_item_status(items, ev).collect()}
    assert (out[1]["status"], out[1]["status_message"], out[1]["completed"]) == ("Failed", "boom", D(2017, 1, 2))
    assert out[2]["status"] == "Done" and out[2]["status_message"] is None


def test_partition_existence_check(spark):
    sli = spark.createDataFrame([("p", "d", "t", "20180101")],
                                "projectId string, datasetId string, tableId string, partitionId string")
    live = spark.createDataFrame([("p", "d", "t", "found", True, None, None, 5, True, True)],
                                 "project_id string, dataset_id string, table_id string, lookup_status string, "
                                 "table_exists boolean, creation_time timestamp_ntz, last_modified_time timestamp_ntz, "
                                 "num_rows long, is_schema_defined boolean, has_time_partitioning boolean")
    parts = spark.createDataFrame([], "project_id string, dataset_id string, table_id string, "
                                      "partition_id string, last_modified timestamp_ntz")
    j = S.with_partition(S.with_live(sli, live), parts, "partitionId")
    assert j.select(S.source_exists("partitionId").alias("e")).first()["e"] is False


def test_copy_not_in_census_size_differs(spark):
    rows = spark.createDataFrame([(None, 10, True, 11)], "backupLastModifiedTime timestamp_ntz, "
                                 "backupEntityNumBytes long, lc_exists boolean, lc_num_bytes long")
    assert rows.select(S.copy_not_in_census().alias("x")).first()["x"] is False


def test_validate_restore_requests_order(spark):
    df = spark.createDataFrame([("bad_project!", "bad-ds", None, None, "WRITE_X", "CREATE_X"),
                                (None, None, "ok-project", "ok_ds", "WRITE_X", "CREATE_X"),
                                ("", "", "", "", "", "")],
                               "source_project_id string, source_dataset_id string, target_project_id string, "
                               "target_dataset_id string, write_disposition string, create_disposition string")
    errs = [r["error"] for r in RS.validate_restore_requests(df).collect()]
    assert errs[0].startswith("Invalid project value: 'bad_project!'")
    assert errs[1].startswith("Invalid write disposition: 'WRITE_X'")
    assert errs[2] is None


def test_orderings(spark):
    t = tables_df(spark, [(1, "p", "d", "t", None, D(2017, 1, 2)), (2, "p", "d", "t", "20180214", D(2017, 1, 1)),
                          (3, "p", "d", "t", "20180215", D(2017, 1, 1))])
    assert [r["id"] for r in RS.partitions_first(t).collect()] == [3, 2, 1]
    assert [r["id"] for r in RS.retention_order(t).collect()] == [2, 3, 1]
    bs = backups_df(spark, [backup(1, D(2017, 2, d), id=d) for d in (3, 5, 4)])
    assert [r["id"] for r in RS.backups_newest_first(bs).collect()] == [5, 4, 3]
