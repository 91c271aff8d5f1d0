"""More golden cases from the reference's unit tests: table-reference
naming, backup-key parsing, the grace-period filter and partition limits."""

import base64
import datetime as dt

import pytest

from keepsake.functions import columns as U
from keepsake.operators import restore as RS
from keepsake.operators import retention as R
from tests.helpers import backup, backups_df, live_df, tables_df

D = dt.datetime

ACCEPTED = ["proj321:dataset123.tableabc$20180226", "proj321:dataset123.tableabc", "proj321:dataset123.tableabc_123",
            "proj321:datas_et123.tableabc123", "proj-321:dataset123.tableabc123",
            "dev-project-x:smoke_test_EU.epd_none_direct___cpd_indirect___rm_manual___sharded_20170804"]
REJECTED = ["proj321dataset123.tableabc", "proj321dataset123tableabc", "proj321:dataset123.tableabc$dsfsf",
            "proj321dataset123tableabc$20180501", "proj321:dataset123.table-abc$20180501",
            "proj321:datase-t123.tableabc$20180501", "proj_321:dataset123.tableabc$20180501"]


def test_table_reference_naming(spark):
    df = spark.createDataFrame([(s,) for s in ACCEPTED + REJECTED], "s string")
    got = {r["s"]: r["r"] for r in df.select("s", U.parse_table_ref("s").alias("r")).collect()}
    assert all(got[s] is not None for s in ACCEPTED)
    assert all(got[s] is None for s in REJECTED)
    assert tuple(got["proj321:dataset123.tableabc$20180226"]) == ("proj321", "dataset123", "tableabc", "20180226")
    back = df.select(U.format_table_ref(U.parse_table_ref("s")).alias("t")).collect()
    assert sorted(r["t"] for r in back if r["t"]) == sorted(ACCEPTED)


def b64(text):
    return base64.b64encode(text.encode()).decode()


def test_backup_key_cases(spark):
    keys = [b64('"Table", 6394035673497600, "Backup", 5629499534213120'), "nonbase64",
            b64("part1,part2, part3"), b64("part1,123,part3,non-int")]
    req = spark.createDataFrame([(i, k, None) for i, k in enumerate(keys)] + [(9, None, None), (10, keys[0], "x")],
                                "request_id long, backupBqKey string, backupUrlSafeKey string")
    out = {r["request_id"]: r for r in RS.parse_list_requests(req).collect()}
    assert (out[0]["table_entity_id"], out[0]["backup_id"], out[0]["error"]) == \
        (6394035673497600, 5629499534213120, None)
    assert out[1]["error"].startswith("Unable to parse backup BQ key: nonbase64")
    assert out[2]["error"] == f"Unable to parse backup BQ key: {keys[2]}, key doesn't consist of 4 parts"
    assert out[3]["error"] == f"Unable to parse backup BQ key: {keys[3]}"
    assert out[9]["error"] == RS.MISSING_KEY and out[10]["error"] == RS.BOTH_KEYS


GRACE = [
    # name, copy created, last_checked, exists, partition asked, table partitioned, kept
    ("deleted only recently", D(2015, 6, 1), D(2017, 7, 1), False, None, False, True),
    ("young kept although deleted", D(2017, 6, 1), D(2017, 7, 1), False, None, False, True),
    ("gone for long", D(2015, 6, 1), D(2015, 7, 1), False, None, False, False),
    ("partition of a table no longer partitioned", D(2015, 6, 1), D(2015, 7, 1), True, "20180805", False, False),
    ("source still exists", D(2015, 6, 1), D(2015, 7, 1), True, None, False, True),
]


@pytest.mark.parametrize("name,created,seen,exists,partition,partitioned,kept", GRACE, ids=[g[0] for g in GRACE])
def test_grace_period_cases(spark, name, created, seen, exists, partition, partitioned, kept):
    t = tables_df(spark, [(1, "p", "d", "t", partition, seen)])
    live = live_df(spark, [("p", "d", "t", exists, partitioned)])
    retained = backups_df(spark, [backup(1, created)])
    out = R.grace_filter(retained, t, live, D(2017, 8, 20), 7)
    assert (out.count() == 1) == kept


def test_grace_period_empty_list(spark):
    t = tables_df(spark, [(1, "p", "d", "t", None, D(2015, 7, 1))])
    out = R.grace_filter(backups_df(spark, []), t, live_df(spark, [("p", "d", "t", False, False)]),
                         D(2017, 8, 20), 7)
    assert out.count() == 0


PARTITION_DAYS = [
    (-1, ["20180214"], []),
    (0, ["20180214"], []),
    (0, [None], [None]),
    (1, ["20180215", "20180214"], ["20180215"]),
    (1, ["20180214"], []),
    (2, ["20180215", "20180214", "20180213"], ["20180215", "20180214"]),
    (2, ["20180215", "20180213"], ["20180215"]),
]


@pytest.mark.parametrize("n,partitions,expected", PARTITION_DAYS)
def test_max_partition_days_cases(spark, n, partitions, expected):
    t = tables_df(spark, [(i, "p1", "d1", "t", p, None) for i, p in enumerate(partitions)])
    got = sorted((r["partition_id"] or "") for r in RS.max_partition_days(t, D(2018, 2, 15), n).collect())
    assert got == sorted((p or "") for p in expected)


JOB_SCHEMA = "id string, created timestamp_ntz, items_count long, create_disposition string, write_disposition string"
ITEM_SCHEMA = ("id long, job_id string, status string, status_message string, completed timestamp_ntz, "
               "source_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
               "target_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
               "custom_parameters string")
SRC, TGT = ("bp", "bk", "copy1", None), ("p", "d", "t", "20180101")


def _status(spark, items_count, items):
    jobs = spark.createDataFrame([("j", D(2018, 1, 1), items_count, "CREATE_IF_NEEDED", "WRITE_EMPTY")], JOB_SCHEMA)
    its = spark.createDataFrame([(i, "j", st, None, comp, SRC, TGT, cp) for i, (st, comp, cp) in enumerate(items)],
                                ITEM_SCHEMA)
    st = RS.job_status(jobs, its).first()
    res = {r["result"]: r["count"] for r in RS.item_results(jobs, its).collect()}
    listing = RS.item_listing(its).orderBy("id").collect()
    return st, res, listing


def test_status_without_items(spark):
    st, res, _ = _status(spark, 1, [])
    assert (st["state"], st["result"]) == ("In progress", None) and res == {"unknown": 1}


def test_status_done_with_and_without_completed(spark):
    st, res, listing = _status(spark, 2, [("Done", D(2018, 1, 2, 3, 4, 5), None), ("Done", None, None)])
    assert (st["state"], st["result"]) == ("Done", "Success") and res == {"done": 2}
    assert [r["completed"] for r in listing] == ["2018-01-02T03:04:05", None]
    assert listing[0]["sourceTable"] == "bp:bk.copy1" and listing[0]["targetTable"] == "p:d.t$20180101"


def test_status_custom_parameters(spark):
    _, res, listing = _status(spark, 3, [("In Progress", None, '{"a": 1}'), ("Done", None, "not json {"),
                                         ("Done", None, None)])
    assert res == {"inProgress": 1, "done": 2}
    assert [(r["customParameters"], r["customParametersIsJson"]) for r in listing] == \
        [('{"a": 1}', True), ("not json {", False), (None, None)]


def test_status_finished_with_failures(spark):
    st, res, _ = _status(spark, 2, [("Done", None, None), ("Failed", None, None)])
    assert (st["state"], st["result"]) == ("Done", "Failed") and res == {"done": 1, "failed": 1}


def test_dataset_restore_items(spark):
    t = tables_df(spark, [(1, "src", "ds", "plain", None, None), (2, "src", "ds", "nobackup", None, None),
                          (3, "src", "ds", "part", "20171206", None), (4, "src", "ds", "part", "20171205", None),
                          (5, "src", "ds", "part", "20171203", None), (6, "src", "other", "x", None, None)])
    bs = backups_df(spark, [backup(1, D(2017, 12, 1), table_id="b1_old", dataset="bk0", id=11),
                            backup(1, D(2017, 12, 2), table_id="b1_gone", dataset="bk0", id=12,
                                   deleted=D(2017, 12, 3)),
                            backup(3, D(2017, 12, 6), table_id="b3", dataset="bk1", id=13),
                            backup(4, D(2017, 12, 5), table_id="b4", dataset="bk1", id=14),
                            backup(5, D(2017, 12, 3), table_id="b5", dataset="bk1", id=15),
                            backup(6, D(2017, 12, 3), table_id="b6", dataset="bk1", id=16)])
    req = spark.createDataFrame([("r1", "src", "ds", "TARGET-PROJECT", None, None),
                                 ("r2", "src", "ds", "restoration", "custom_target_dataset_id", 2)],
                                "request_id string, project_id string, dataset_id string, target_project_id string, "
                                "target_dataset_id string, max_partition_days int")
    out = RS.dataset_restore_items(req, t, bs, D(2017, 12, 6), "backup-project")
    got = sorted((r["request_id"], r["backup_id"], tuple(r["source_table"]), tuple(r["target_table"]))
                 for r in out.collect())
    assert got == sorted([
        # newest *available* copy per table; tables without one yield nothing
        ("r1", 11, ("backup-project", "bk0", "b1_old", None), ("TARGET-PROJECT", "ds", "plain", None)),
        ("r1", 13, ("backup-project", "bk1", "b3", "20171206"), ("TARGET-PROJECT", "ds", "part", "20171206")),
        ("r1", 14, ("backup-project", "bk1", "b4", "20171205"), ("TARGET-PROJECT", "ds", "part", "20171205")),
        ("r1", 15, ("backup-project", "bk1", "b5", "20171203"), ("TARGET-PROJECT", "ds", "part", "20171203")),
        # max_partition_days = 2: partitions of the last two days and every non-partitioned table
        ("r2", 11, ("backup-project", "bk0", "b1_old", None), ("restoration", "custom_target_dataset_id", "plain", None)),
        ("r2", 13, ("backup-project", "bk1", "b3", "20171206"), ("restoration", "custom_target_dataset_id", "part", "20171206")),
        ("r2", 14, ("backup-project", "bk1", "b4", "20171205"), ("restoration", "custom_target_dataset_id", "part", "20171205")),
    ])
    assert {r["status"] for r in out.collect()} == {"In Progress"}


def _live_from_docs(spark, docs):
    """Typed live rows from raw metadata documents."""
    import json
    from keepsake.sources.catalog import live_catalog
    rows = [("p", "d", "t", status, json.dumps(doc) if doc is not None else None) for status, doc in docs]
    return live_catalog(spark.createDataFrame(rows, "project_id string, dataset_id string, table_id string, "
                                                    "lookup_status string, document string"))


def test_schema_defined_like_the_reference(spark):
    live = _live_from_docs(spark, [("found", {"schema": {"fields": []}}), ("found", {}),
                                   ("found", {"schema": {"fields": [{"name": "a", "type": "STRING"}]}})])
    assert [r["is_schema_defined"] for r in live.collect()] == [True, False, True]


EXISTS_CASES = [
    # name, lookup doc (None = not found), partition asked, partitions listed, exists
    ("not existing table", None, None, [], False),
    ("existing table", {"schema": {"fields": []}}, None, [], True),
    ("missing partition", {"schema": {"fields": []}, "timePartitioning": {"type": "DAY"}}, "20180808", [], False),
    ("existing partition", {"schema": {"fields": []}, "timePartitioning": {"type": "DAY"}}, "20180808",
     ["20180808"], True),
    ("no schema", {}, None, [], False),
    ("partition of a non-partitioned table is not looked up", {"schema": {"fields": []}}, "20180808", [], True),
]


@pytest.mark.parametrize("name,doc,partition,listed,exists", EXISTS_CASES, ids=[c[0] for c in EXISTS_CASES])
def test_source_exists_cases(spark, name, doc, partition, listed, exists):
    from keepsake.operators import sli as S
    live = _live_from_docs(spark, [("found" if doc is not None else "not_found", doc)])
    sli = spark.createDataFrame([("p", "d", "t", partition)],
                                "projectId string, datasetId string, tableId string, partitionId string")
    parts = spark.createDataFrame([("p", "d", "t", x, None) for x in listed],
                                  "project_id string, dataset_id string, table_id string, partition_id string, "
                                  "last_modified timestamp_ntz")
    j = S.with_partition(S.with_live(sli, live), parts, "partitionId")
    assert j.select(S.source_exists("partitionId").alias("e")).first()["e"] is exists


LATENCY_CONFIRM = [
    # name, exists, recreated, has backup, empty, lookup error, kept
    ("exists, not recreated, no backup, empty", True, False, False, True, False, True),
    ("exists, not recreated, has backup, empty", True, False, True, True, False, False),
    ("lookup error keeps the row", True, False, True, True, True, True),
    ("gone", False, False, False, False, False, False),
    ("recreated", True, True, False, False, False, False),
]


@pytest.mark.parametrize("name,exists,recreated,has_backup,empty,error,kept", LATENCY_CONFIRM,
                         ids=[c[0] for c in LATENCY_CONFIRM])
def test_latency_confirmation_cases(spark, name, exists, recreated, has_backup, empty, error, kept):
    from keepsake.operators import sli as S
    census_created = D(2018, 1, 1)
    doc = {"schema": {"fields": []}, "numRows": "0" if empty else "5",
           "creationTime": str(int(((D(2018, 2, 1) if recreated else D(2017, 12, 1)) - D(1970, 1, 1))
                                   .total_seconds() * 1000))}
    status = "error" if error else ("found" if exists else "not_found")
    live = _live_from_docs(spark, [(status, doc if status == "found" else None)])
    rows = spark.createDataFrame(
        [(D(2018, 3, 1), "p", "d", "t", "None", census_created, D(2018, 2, 20),
          D(2018, 2, 10) if has_backup else D(1970, 1, 1), D(1970, 1, 1), "4")],
        "snapshotTime timestamp_ntz, projectId string, datasetId string, tableId string, partitionId string, "
        "creationTime timestamp_ntz, lastModifiedTime timestamp_ntz, backupCreated timestamp_ntz, "
        "backupLastModified timestamp_ntz, xDays string")
    parts = spark.createDataFrame([], "project_id string, dataset_id string, table_id string, partition_id string, "
                                      "last_modified timestamp_ntz")
    assert (S.confirm_latency(rows, live, parts).count() == 1) is kept


@pytest.mark.parametrize("live_ms,expected", [(1618522714837, True), (1518522714837, False), (1418522714837, False)])
def test_newer_modification_cases(spark, live_ms, expected):
    from keepsake.operators import sli as S
    live = _live_from_docs(spark, [("found", {"schema": {"fields": []}, "lastModifiedTime": str(live_ms)})])
    census_lm = D(1970, 1, 1) + dt.timedelta(milliseconds=1518522714837)
    sli = spark.createDataFrame([("p", "d", "t", None, census_lm)],
                                "projectId string, datasetId string, tableId string, partitionId string, "
                                "lastModifiedTime timestamp_ntz")
    parts = spark.createDataFrame([], "project_id string, dataset_id string, table_id string, partition_id string, "
                                      "last_modified timestamp_ntz")
    j = S.with_partition(S.with_live(sli, live), parts, "partitionId")
    assert j.select(S.is_newer("partitionId").alias("n")).first()["n"] is expected


@pytest.mark.parametrize("copy_bytes,census_time,expected", [
    (100, None, True), (12345, None, False), (12345, D(2017, 7, 14), False), (None, None, False)])
def test_copy_not_seen_by_census_cases(spark, copy_bytes, census_time, expected):
    from keepsake.operators import sli as S
    rows = spark.createDataFrame([(census_time, 100, copy_bytes is not None, copy_bytes)],
                                 "backupLastModifiedTime timestamp_ntz, backupEntityNumBytes long, "
                                 "lc_exists boolean, lc_num_bytes long")
    assert rows.select(S.copy_not_in_census().alias("x")).first()["x"] is expected


T15 = D(2016, 11, 13, 15)
NEEDS = [
    # name, exists, schema, view, source modified, bytes, rows, last copy (modified, bytes) or None, expected
    ("no schema", True, False, False, T15, 123, 5, None, False),
    ("empty, no copies", True, True, False, T15, 0, 0, None, True),
    ("table gone", False, True, False, T15, 123, 5, None, False),
    ("view", True, True, True, T15, 123, 5, None, False),
    ("no copies", True, True, False, T15, 123, 5, None, True),
    ("changed after last copy", True, True, False, D(2016, 11, 13, 16), 123, 5, (T15, 123), True),
    ("changed at the copy time, same size", True, True, False, T15, 123, 5, (T15, 123), False),
    ("changed before the copy", True, True, False, D(2016, 11, 13, 14), 123, 5, (T15, 123), False),
    ("changed before, size differs", True, True, False, D(2016, 11, 13, 14), 456, 5, (T15, 123), True),
    ("now empty, copy not empty", True, True, False, D(2018, 11, 13, 17), 0, 0, (T15, 123), False),
    ("now empty, copy empty too", True, True, False, D(2018, 11, 13, 17), 0, 0, (T15, 0), True),
]


@pytest.mark.parametrize("name,exists,schema,view,modified,nbytes,nrows,last,expected", NEEDS,
                         ids=[c[0] for c in NEEDS])
def test_needs_backup_cases(spark, name, exists, schema, view, modified, nbytes, nrows, last, expected):
    from keepsake.operators import backup as B
    units = spark.createDataFrame(
        [("p", "d", "t", None, exists, schema, view, "US", False, "found", modified, nbytes, nrows, False)],
        "project_id string, dataset_id string, table_id string, partition_id string, table_exists boolean, "
        "is_schema_defined boolean, is_external_or_view boolean, location string, "
        "has_partition_expiration boolean, lookup_status string, unit_last_modified timestamp_ntz, "
        "unit_num_bytes long, unit_num_rows long, non_day_partitioning boolean")
    t = tables_df(spark, [(1, "p", "d", "t", None, D(2016, 1, 1))])
    copies = []
    if last:
        b = list(backup(1, last[0] + dt.timedelta(minutes=10), num_bytes=last[1]))
        b[2] = last[0]  # last_modified = copy start = the source state it holds
        copies = [tuple(b)]
    j = B.attach_last_backup(B.copyable(units), t, backups_df(spark, copies))
    assert j.select(B.needs_backup(j).alias("n")).first()["n"] is expected
