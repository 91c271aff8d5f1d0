"""Restore planning and status: set-at-a-time over request frames.

Requests (dataset restores, table restores "as of" a time, lists of backup
keys) are DataFrames; each becomes restore items by joins with the table
entities and their copies.  Errors are rows with a message, never
exceptions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.config import (CREATE_DISPOSITIONS, STATUS_DONE, STATUS_FAILED, STATUS_IN_PROGRESS,
                             WRITE_DISPOSITIONS)
from keepsake.functions import columns as U
from keepsake.functions.timeutil import days_before, ts_lit, yyyymmdd
from keepsake.operators.asof import newest_before
from keepsake.operators.catalog import newest_available
from keepsake.session import written

KEYS = ["project_id", "dataset_id", "table_id", "partition_id"]

# Error texts of the reference's restore requests.
TABLE_NOT_FOUND = "Table not found in datastore: "
BACKUP_NOT_FOUND = "Backup not found for "
WRONG_DATE = "Wrong date value format for parameter 'restoration_date'. Should be 'YYYY-mm-dd'"
NO_TABLES = "No Tables was found in Datastore for project {}, dataset {}"
NO_BACKUPS = "No Backups was found in Datastore for project {}, dataset {}"
MISSING_KEY = "There are missing 'backupUrlSafeKey' or 'backupBqKey' variables in request body."
BOTH_KEYS = "Please specify either 'backupUrlSafeKey' or 'backupBqKey' element in single item."
BAD_KEY = "Unable to parse backup BQ key: {}"
BAD_KEY_PARTS = ", key doesn't consist of 4 parts"
DUPLICATED = ("There are duplicated backup items - more than one 'backupUrlSafeKey' or 'backupBqKey' are "
              "pointing to the same backup. Duplicated backup item: {}")
NO_BACKUP_ENTITY = "Backup entity (key={}) doesn't exist in datastore."
NO_ANCESTOR = "Backup ancestor doesn't exists: '{}:{}'. "


def _fmt(template: str, *cols) -> F.Column:
    """Fill the `{}` slots of a fixed message with column values."""
    parts = template.split("{}")
    out = [F.lit(parts[0])]
    for c, text in zip(cols, parts[1:]):
        out += [c.cast("string"), F.lit(text)]
    return F.concat(*out)


def max_partition_days(tables: DataFrame, as_of: dt.datetime, n: int) -> DataFrame:
    """P10: partitions of the last n days (string compare with
    yyyymmdd(as_of − (n−1) days), so '__UNPARTITIONED__' passes) UNION ALL
    every non-partitioned table; n ≤ 0 keeps only non-partitioned among past
    days."""
    oldest = (as_of - dt.timedelta(days=n - 1)).strftime("%Y%m%d")
    recent = tables.filter(F.col("partition_id") >= F.lit(oldest))
    return recent.unionByName(tables.filter(F.col("partition_id").isNull()))


def _newest_per_request(requests: DataFrame, backups: DataFrame, time_col: str) -> DataFrame:
    """Newest available copy with `created <= time_col` per request
    (`request_id`, `entity_id`).  The copies of the asked tables and the
    distinct times are merged in one order (`asof`), so neither a table with a
    third of all copies nor one with many request times multiplies rows."""
    found = ("backup_created", "backup_id", "backup_dataset_id", "backup_table_id")
    b = backups.filter(F.col("deleted").isNull()).select(
        F.col("parent_id").alias("entity_id"), F.col("created").alias("backup_created"), F.col("id").alias("backup_id"),
        F.col("dataset_id").alias("backup_dataset_id"), F.col("table_id").alias("backup_table_id"))
    asked = b.join(requests.select("entity_id").distinct(), "entity_id", "left_semi")
    keys = ["entity_id", time_col]
    newest = newest_before(requests.select(*keys).distinct(), asked, "entity_id", time_col, "backup_created")
    newest = newest.select(*keys, *[F.col("_row").getField(c).alias(c) for c in found])
    return requests.select("request_id", *keys).join(newest, keys).select("request_id", *found)


def attach_entity(requests: DataFrame, tables: DataFrame) -> DataFrame:
    t = tables.select(*[F.col(k).alias("e_" + k) for k in KEYS], F.col("id").alias("entity_id"))
    cond = None
    for k in KEYS:
        c = requests[k].eqNullSafe(t["e_" + k])
        cond = c if cond is None else cond & c
    return requests.join(t, cond, "left").drop(*["e_" + k for k in KEYS])


def as_of_backup(requests: DataFrame, tables: DataFrame, backups: DataFrame) -> DataFrame:
    """Newest available copy with created <= `not_newer_than` per
    request (request_id + 4-part reference + not_newer_than).  Errors as
    rows: table not found, backup not found (texts below)."""
    r = attach_entity(requests, tables)
    newest = _newest_per_request(r.filter(F.col("entity_id").isNotNull()), backups, "not_newer_than")
    out = r.join(newest, "request_id", "left")
    ref = U.format_table_ref(U.table_ref("project_id", "dataset_id", "table_id", "partition_id"))
    err = (F.when(F.col("entity_id").isNull(), F.concat(F.lit(TABLE_NOT_FOUND), ref))
           .when(F.col("backup_id").isNull(),
                 F.concat(F.lit(BACKUP_NOT_FOUND), ref, F.lit(" before "),
                          F.date_format("not_newer_than", "yyyy-MM-dd HH:mm:ss"))))
    return out.withColumn("error", err)


def request_time(date_text: F.Column, as_of: dt.datetime) -> F.Column:
    """a calendar-date request means that day 23:59:59; no date means
    as_of; an invalid date gives NULL (reported as an error)."""
    return F.when(date_text.isNull(), ts_lit(as_of)).otherwise(U.end_of_day(date_text))


def validate_restore_requests(df: DataFrame) -> DataFrame:
    """+ error (NULL = valid).  Only non-empty parameters are checked,
    in this order: source project, source dataset, target project, target
    dataset, write disposition, create disposition."""
    def nonempty(c):
        return F.col(c).isNotNull() & (F.col(c) != "")

    def bad_project(c):
        return nonempty(c) & ~F.col(c).rlike(U.PROJECT_ID_PATTERN)

    def bad_dataset(c):
        return nonempty(c) & ~F.col(c).rlike(U.DATASET_ID_PATTERN)

    def project_msg(c):
        return F.concat(F.lit("Invalid project value: '"), F.col(c),
                        F.lit("'. Project IDs may contain letters, numbers, and dash"))

    def dataset_msg(c):
        return F.concat(F.lit("Invalid dataset value: '"), F.col(c),
                        F.lit("'. Dataset IDs may contain letters, numbers, and underscores"))

    err = (F.when(bad_project("source_project_id"), project_msg("source_project_id"))
           .when(bad_dataset("source_dataset_id"), dataset_msg("source_dataset_id"))
           .when(bad_project("target_project_id"), project_msg("target_project_id"))
           .when(bad_dataset("target_dataset_id"), dataset_msg("target_dataset_id"))
           .when(nonempty("write_disposition") & ~F.col("write_disposition").isin(*WRITE_DISPOSITIONS),
                 F.concat(F.lit("Invalid write disposition: '"), F.col("write_disposition"),
                          F.lit("'. The following values are supported: " + ", ".join(WRITE_DISPOSITIONS)
                                + ".")))
           .when(nonempty("create_disposition") & ~F.col("create_disposition").isin(*CREATE_DISPOSITIONS),
                 F.concat(F.lit("Invalid create disposition: '"), F.col("create_disposition"),
                          F.lit("'. The following values are supported: " + ", ".join(CREATE_DISPOSITIONS)
                                + "."))))
    return df.withColumn("error", err)


def warnings_only(items: DataFrame) -> DataFrame:
    """P20: drop 'Done' and 'In Progress' items."""
    return items.filter(~F.col("status").isin(STATUS_DONE, STATUS_IN_PROGRESS))


def items_count(items: DataFrame) -> DataFrame:
    """Number of items attached to each job."""
    return items.groupBy("job_id").agg(F.count(F.lit(1)).alias("items"))


def item_results(jobs: DataFrame, items: DataFrame) -> DataFrame:
    """A3: per job, count per status plus `unknown = items_count − n` only
    when positive; keys camelCased ('In Progress' → inProgress).  Long
    format: job_id, result, count."""
    per_status = items.groupBy("job_id", "status").agg(F.count(F.lit(1)).alias("count"))
    known = per_status.select("job_id", U.camel_case("status").alias("result"), "count")
    n = items_count(items)
    unknown = (jobs.select(F.col("id").alias("job_id"), "items_count")
               .join(n, "job_id", "left")
               .select("job_id", F.lit("unknown").alias("result"),
                       (F.col("items_count") - F.coalesce(F.col("items"), F.lit(0))).alias("count"))
               .filter(F.col("count") > 0))
    return known.unionByName(unknown)


def job_status(jobs: DataFrame, items: DataFrame) -> DataFrame:
    """A4: finished iff nothing in progress and every expected item exists;
    state 'Done'/'In progress'; result 'Success' iff all done, only when
    finished."""
    counts = items.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == STATUS_IN_PROGRESS).alias("in_progress"),
        F.count_if(F.col("status") == STATUS_DONE).alias("done"))
    j = jobs.join(counts, jobs.id == counts.job_id, "left")
    n, ip, done = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "in_progress", "done"))
    finished = (ip == 0) & (n == F.col("items_count"))
    return j.select(F.col("id").alias("job_id"), "items_count", "create_disposition", "write_disposition",
                    F.when(finished, "Done").otherwise("In progress").alias("state"),
                    F.when(finished, F.when(done == F.col("items_count"), "Success").otherwise("Failed"))
                    .alias("result"))


def item_listing(items: DataFrame) -> DataFrame:
    """Item part of the status document: status, message, completed as ISO
    text (F15), custom parameters (JSON or raw text, F13), references as
    text (U3)."""
    is_json, text = U.json_or_text("custom_parameters")
    return items.select("job_id", "id", "status", F.col("status_message").alias("statusMessage"),
                        U.iso_text("completed").alias("completed"),
                        text.alias("customParameters"), is_json.alias("customParametersIsJson"),
                        U.format_table_ref("source_table").alias("sourceTable"),
                        U.format_table_ref("target_table").alias("targetTable"))


def dataset_tables(requests: DataFrame, tables: DataFrame, backups: DataFrame) -> DataFrame:
    """Per dataset-restore request the table entities of its dataset, each with its newest available copy (NULL if none).

    A request without a table is one row without an entity; partitions are not
    limited yet.  Both A7 and the items of Q6 are taken from these rows."""
    r = requests.select("request_id", F.col("project_id").alias("r_project"), F.col("dataset_id").alias("r_dataset"),
                        "target_project_id", "target_dataset_id", "max_partition_days")
    t = tables.select(F.col("id").alias("entity_id"), *KEYS)
    newest = newest_available(backups.select("parent_id", "created", "id", "dataset_id", "table_id", "deleted")).select(
        F.col("parent_id").alias("entity_id"), F.col("id").alias("backup_id"),
        F.col("dataset_id").alias("backup_dataset_id"), F.col("table_id").alias("backup_table_id"))
    j = r.join(t, (t.project_id == r.r_project) & (t.dataset_id == r.r_dataset), "left")
    return j.join(newest, "entity_id", "left")


def _recent_enough(as_of: dt.datetime) -> F.Column:
    oldest = yyyymmdd(days_before(ts_lit(as_of), (F.col("max_partition_days") - 1).cast("int")))
    return F.col("partition_id").isNull() | (F.col("partition_id") >= oldest)


def dataset_checks(found: DataFrame, datasets: DataFrame, backup_datasets: DataFrame, as_of: dt.datetime) -> DataFrame:
    """A7 over `dataset_tables`."""
    j = found.filter(F.col("entity_id").isNull() | F.col("max_partition_days").isNull() | _recent_enough(as_of))
    first = F.min(F.when(F.col("backup_dataset_id").isNotNull(), F.struct("entity_id", "backup_dataset_id")))
    per = j.groupBy("request_id", "r_project", "r_dataset", "target_project_id", "target_dataset_id").agg(
        F.count("entity_id").alias("tables"), first.getField("backup_dataset_id").alias("any_backup_dataset"))
    ds = datasets.select(F.col("project_id").alias("d_project"), F.col("dataset_id").alias("d_dataset"),
                         F.col("location").alias("target_location"))
    bl = backup_datasets.select(F.col("dataset_id").alias("b_dataset"), F.col("location").alias("backup_location"))
    per = (per.join(ds, (per.target_project_id == ds.d_project) & (per.target_dataset_id == ds.d_dataset), "left")
           .join(bl, per.any_backup_dataset == bl.b_dataset, "left"))
    err = (F.when(F.col("target_project_id").isNull(), "Required target project id parameter is None")
           .when(F.col("tables") == 0, _fmt(NO_TABLES, F.col("r_project"), F.col("r_dataset")))
           .when(F.col("any_backup_dataset").isNull(), _fmt(NO_BACKUPS, F.col("r_project"), F.col("r_dataset")))
           .when(F.col("target_location").isNotNull()
                 & ~F.col("target_location").eqNullSafe(F.col("backup_location")),
                 "Target dataset already exist and has different location than backup dataset"))
    return per.select("request_id", "tables", err.alias("error"))


def dataset_restore_check(requests: DataFrame, tables: DataFrame, backups: DataFrame,
                          datasets: DataFrame, backup_datasets: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per dataset-restore request: any table entity? any available copy?
    (two distinct errors), then — when the target dataset exists — its
    location must equal that of the dataset of an actual copy: the newest copy
    of the first table (by id) that has one.  `max_partition_days` NULL =
    every table; otherwise P10 (0 included)."""
    return dataset_checks(dataset_tables(requests, tables, backups), datasets, backup_datasets, as_of)


def dataset_items(found: DataFrame, as_of: dt.datetime, backup_project: str) -> DataFrame:
    """Q6 item generation over `dataset_tables`: per request the dataset's
    tables (P10 when max_partition_days is set and non-zero, else all), the
    newest available copy of each (tables without one yield nothing), and
    source/target references (U7).  Items start 'In Progress'."""
    limited = F.coalesce(F.col("max_partition_days"), F.lit(0)) != 0
    out = found.filter(F.col("backup_id").isNotNull() & (~limited | _recent_enough(as_of)))
    return out.select(
        "request_id", "entity_id", "backup_id",
        U.restore_source(backup_project, "backup_dataset_id", "backup_table_id", "partition_id")
        .alias("source_table"),
        U.restore_target("target_project_id", "target_dataset_id", "project_id", "dataset_id", "table_id",
                         "partition_id").alias("target_table"),
        F.lit(STATUS_IN_PROGRESS).alias("status"))


def dataset_restore_items(requests: DataFrame, tables: DataFrame, backups: DataFrame,
                          as_of: dt.datetime, backup_project: str) -> DataFrame:
    """`dataset_items` of requests that need no check."""
    return dataset_items(dataset_tables(requests, tables, backups), as_of, backup_project)


def duplicate_requests(requests: DataFrame) -> DataFrame:
    """U-4: lists that name the same copy twice (in either key format) are
    rejected whole: list_id, table_entity_id, backup_id, times (an id names a
    copy below its parent only)."""
    # requests without a copy count as none; a filter on backup_id would be pushed into the parsing and repeat it
    return (requests.groupBy("list_id", "table_entity_id", "backup_id").agg(F.count("backup_id").alias("times"))
            .filter(F.col("times") > 1))


def parse_list_requests(requests: DataFrame) -> DataFrame:
    """U4 over a list of requests: exactly one of the two key columns must
    be given; base64 keys are parsed; url-safe store keys are not supported.
    + table_entity_id, backup_id, error and request_row (the row as JSON)."""
    both = F.col("backupBqKey").isNotNull() & F.col("backupUrlSafeKey").isNotNull()
    none = F.col("backupBqKey").isNull() & F.col("backupUrlSafeKey").isNull()
    key = F.col("_key")
    err = (F.when(none, MISSING_KEY).when(both, BOTH_KEYS)
           .when(F.col("backupBqKey").isNull(), "Url-safe store keys are not supported")
           .when(key.isNull(), F.concat(_fmt(BAD_KEY, F.col("backupBqKey")),
                                        F.when(F.size("_parts") != 4, F.lit(BAD_KEY_PARTS)).otherwise(F.lit("")))))
    row = F.to_json(F.struct(*requests.columns), {"ignoreNullFields": "false"})
    # step by step: written into one another these columns would decode each key some twenty times
    parsed = (requests.withColumn("_parts", U.backup_key_parts("backupBqKey"))
              .withColumn("_key", U.backup_key(F.col("_parts"))).withColumn("_error", err))
    ok = F.col("_error").isNull()
    return parsed.select(*requests.columns, row.alias("request_row"), F.when(ok, key.getField("table_id")).alias("table_entity_id"),
                         F.when(ok, key.getField("backup_id")).alias("backup_id"), F.col("_error").alias("error"))


def resolve_backup_keys(parsed: DataFrame, backups: DataFrame, tables: DataFrame) -> DataFrame:
    """Key → copy → parent table entity, by the whole key (parent and id);
    a missing copy or parent is a validation error for that request."""
    b = backups.select(F.col("id").alias("b_id"), F.col("parent_id").alias("b_parent"),
                       F.col("dataset_id").alias("backup_dataset_id"), F.col("table_id").alias("backup_table_id"))
    t = tables.select(F.col("id").alias("t_id"), *KEYS)
    j = parsed.join(b, (parsed.backup_id == b.b_id) & (parsed.table_entity_id == b.b_parent), "left")
    j = j.join(t, j.b_parent == t.t_id, "left")
    err = F.coalesce(F.col("error"),
                     F.when(F.col("b_id").isNull(), _fmt(NO_BACKUP_ENTITY, F.col("backup_id")))
                     .when(F.col("t_id").isNull(), _fmt(NO_ANCESTOR, F.col("backup_dataset_id"),
                                                        F.col("backup_table_id"))))
    return j.withColumn("error", err).drop("b_id", "t_id")


def fold_item_status(items: DataFrame, events: DataFrame) -> DataFrame:
    """M3: the first terminal event per item (by event time, then arrival)
    sets status, completed = event time, message only for failures; later
    events and items already terminal are left alone."""
    terminal = events.filter(F.col("status").isin(STATUS_DONE, STATUS_FAILED))
    order = ["event_time"] + (["arrival"] if "arrival" in events.columns else [])
    first = (terminal.groupBy("item_id")
             .agg(F.min(F.struct(*order, "status", "message")).alias("_e"))
             .select(F.col("item_id").alias("id"), F.col("_e.status").alias("e_status"),
                     F.col("_e.event_time").alias("e_time"), F.col("_e.message").alias("e_message")))
    j = items.join(first, "id", "left")
    apply = (F.col("status") == STATUS_IN_PROGRESS) & F.col("e_status").isNotNull()
    cols = []
    for c in items.columns:
        if c == "status":
            cols.append(F.when(apply, F.col("e_status")).otherwise(F.col("status")).alias("status"))
        elif c == "completed":
            cols.append(F.when(apply, F.col("e_time")).otherwise(F.col("completed")).alias("completed"))
        elif c == "status_message":
            cols.append(F.when(apply, F.when(F.col("e_status") == STATUS_FAILED, F.col("e_message")))
                        .otherwise(F.col("status_message")).alias("status_message"))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def create_job(jobs: DataFrame, new: DataFrame) -> DataFrame:
    """M5: a job id that exists already is ignored (nothing restored for
    it); returns the jobs actually created."""
    known = jobs.select("id").join(new.select("id"), "id", "left_semi")  # narrow the job table first
    return new.join(known, "id", "left_anti").dropDuplicates(["id"])


def prepare_targets(items: DataFrame, datasets: DataFrame, live: DataFrame, source_live: DataFrame) -> DataFrame:
    """The creations a restore needs first: every target dataset that
    does not exist (created in the source's location) and, for partition
    targets, every target table that does not exist (empty, same schema and
    partitioning as the source).  Output: action, project_id, dataset_id,
    table_id, location."""
    t = items.select(F.col("target_table.project_id").alias("project_id"),
                     F.col("target_table.dataset_id").alias("dataset_id"),
                     F.col("target_table.table_id").alias("table_id"),
                     F.col("target_table.partition_id").alias("partition_id"),
                     F.col("source_table.dataset_id").alias("source_dataset_id"))
    src_loc = source_live.select(F.col("dataset_id").alias("source_dataset_id"), "location").distinct()
    ds = (t.join(src_loc, "source_dataset_id", "left")
          .groupBy("project_id", "dataset_id").agg(F.min("location").alias("location"))
          .join(datasets.select("project_id", "dataset_id"), ["project_id", "dataset_id"], "left_anti")
          .select(F.lit("create_dataset").alias("action"), "project_id", "dataset_id",
                  F.lit(None).cast("string").alias("table_id"), "location"))
    tb = (t.filter(F.col("partition_id").isNotNull()).select("project_id", "dataset_id", "table_id").distinct()
          .join(live.filter("table_exists").select("project_id", "dataset_id", "table_id"),
                ["project_id", "dataset_id", "table_id"], "left_anti")
          .select(F.lit("create_table").alias("action"), "project_id", "dataset_id", "table_id",
                  F.lit(None).cast("string").alias("location")))
    return ds.unionByName(tb)


def list_restore_items(resolved: DataFrame, backup_project: str, target_project: str | None = None,
                       target_dataset: str | None = None) -> DataFrame:
    """Q8 items: lists naming a copy twice are rejected whole (U-4); other
    requests with an error are reported; the rest become 'In Progress'
    items (U7) with the request row kept as custom_parameters."""
    dup_lists = duplicate_requests(resolved).groupBy("list_id").agg(F.min("backup_id").alias("_dup"))
    dup_lists = written(dup_lists, "duplicate-lists")  # known to be small where it is: the requests then stay where they lie
    j = resolved.join(dup_lists, "list_id", "left")
    err = F.coalesce(F.col("error"), F.when(F.col("_dup").isNotNull(), _fmt(DUPLICATED, F.col("_dup"))))
    tp = F.lit(target_project) if target_project else F.lit(None).cast("string")
    td = F.lit(target_dataset) if target_dataset else F.lit(None).cast("string")
    ok = err.isNull()
    return j.select(
        "list_id", "request_id", err.alias("error"),
        F.when(ok, U.restore_source(backup_project, "backup_dataset_id", "backup_table_id", "partition_id"))
        .alias("source_table"),
        F.when(ok, U.restore_target(tp, td, "project_id", "dataset_id", "table_id", "partition_id"))
        .alias("target_table"),
        F.when(ok, F.lit(STATUS_IN_PROGRESS)).alias("status"),
        F.col("request_row").alias("custom_parameters"))


# ---------------------------------------------------------------- orderings
ORDERS = {
    "L1": lambda: [F.col("created").desc(), F.col("id").desc()],
    "L2": lambda: [F.col("last_checked").asc(), F.col("id").asc()],
    "L3": lambda: [F.col("partition_id").desc_nulls_last(), F.col("id").asc()],
}


def backups_newest_first(backups: DataFrame) -> DataFrame:
    """L1: copies by created descending (ties: id descending)."""
    return backups.orderBy(*ORDERS["L1"]())


def retention_order(tables: DataFrame) -> DataFrame:
    """L2: retention visits tables by (last_checked, id)."""
    return tables.orderBy(*ORDERS["L2"]())


def partitions_first(tables: DataFrame) -> DataFrame:
    """L3: partitions by partition id descending, then non-partitioned
    tables (NULL last); ties by id."""
    return tables.orderBy(*ORDERS["L3"]())
