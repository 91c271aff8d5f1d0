"""Per-row helpers as column expressions.

Invalid inputs give NULL plus an error column instead of raising, so a bad
row never fails a job over millions of good ones.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.config import MAX_BACKUP_TABLE_ID, MAX_COPY_REQUEST_KEY

# The table-reference pattern of the reference (no '0' in the
# project part, unescaped '.'), and the restore-request patterns.
TABLE_REFERENCE_PATTERN = r"^[a-zA-Z1-9\-]+:\w+.\w+(\$\d{8})?$"
PROJECT_ID_PATTERN = r"^[a-zA-Z0-9-]+$"
DATASET_ID_PATTERN = r"^[a-zA-Z0-9_]+$"
NO_MESSAGE = "No message provided"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# U1 ---------------------------------------------------------------------------
def backup_table_id(project: Column | str, dataset: Column | str, table: Column | str,
                    ts: Column | str, partition: Column | str | None = None) -> Column:
    """`yyyyMMdd_HHmmss_<project -→_>_<dataset>_<table>[_partition_<p>]`;
    over 1024 characters: the first 1000, `_`, a 20-character checksum, cut
    to 1024.  NULL, the mark of an error, when any of the first four is NULL."""
    p = F.lit(None).cast("string") if partition is None else _c(partition)
    name = F.concat(F.concat_ws("_", F.date_format(_c(ts), "yyyyMMdd_HHmmss"),
                                F.replace(_c(project), F.lit("-"), F.lit("_")), _c(dataset), _c(table)),
                    F.coalesce(F.concat(F.lit("_partition_"), p), F.lit("")))
    long_name = F.substring(F.concat(F.substring(name, 1, 1000), F.lit("_"),
                                     F.substring(F.sha2(name, 256), 1, 20)), 1, MAX_BACKUP_TABLE_ID)
    ok = _c(project).isNotNull() & _c(dataset).isNotNull() & _c(table).isNotNull() & _c(ts).isNotNull()
    return F.when(ok, F.when(F.length(name) > MAX_BACKUP_TABLE_ID, long_name).otherwise(name))


# U2 ---------------------------------------------------------------------------
def backup_dataset_id(date: Column | str, location: Column | str, project: Column | str) -> Column:
    """`<calendar year>_<ISO week, 2 digits>_<location>_<project>`, every '-'
    → '_' (2016-01-01 → `2016_53_…`, calendar year kept on purpose)."""
    d = _c(date)
    s = F.concat_ws("_", F.year(d).cast("string"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
                    _c(location), _c(project))
    ok = d.isNotNull() & _c(location).isNotNull() & _c(project).isNotNull()
    return F.when(ok, F.replace(s, F.lit("-"), F.lit("_")))


#: What the text of a JSON value can begin with, and more: signs and words that a lenient parser takes as numbers.
JSON_BEGINNING = r"\A[ \t\r\n]*(?:[\[{\"0-9+.NI-]|true|false|null)"


# U3 ---------------------------------------------------------------------------
def parse_table_ref(s: Column | str) -> Column:
    """`project:dataset.table[$yyyymmdd]` → struct(project_id, dataset_id,
    table_id, partition_id); NULL when the text does not parse."""
    s = _c(s)
    parts = F.split(s, ":")
    rest = F.try_element_at(parts, F.lit(2))
    dt_parts = F.split(rest, r"\.")
    table_part = F.try_element_at(dt_parts, F.lit(2))
    tp = F.split(table_part, r"\$")
    ok = (s.rlike(TABLE_REFERENCE_PATTERN) & (F.size(parts) == 2) & (F.size(dt_parts) == 2))
    return F.when(ok, F.struct(F.try_element_at(parts, F.lit(1)).alias("project_id"),
                               F.try_element_at(dt_parts, F.lit(1)).alias("dataset_id"),
                               F.try_element_at(tp, F.lit(1)).alias("table_id"),
                               F.when(F.size(tp) > 1, F.try_element_at(tp, F.lit(2))).alias("partition_id")))


def format_table_ref(ref: Column | str) -> Column:
    r = _c(ref)
    base = F.concat(r.getField("project_id"), F.lit(":"), r.getField("dataset_id"), F.lit("."),
                    r.getField("table_id"))
    return F.when(r.isNotNull(), F.concat(base, F.coalesce(F.concat(F.lit("$"), r.getField("partition_id")),
                                                           F.lit(""))))


def table_ref(project, dataset, table, partition=None) -> Column:
    p = F.lit(None).cast("string") if partition is None else _c(partition)
    return F.struct(_c(project).alias("project_id"), _c(dataset).alias("dataset_id"),
                    _c(table).alias("table_id"), p.alias("partition_id"))


# U4 ---------------------------------------------------------------------------
def backup_key_parts(key: Column | str) -> Column:
    """base64 text → strip quotes and spaces → its comma parts; NULL if it is not base64."""
    raw = F.try_to_binary(_c(key), F.lit("base64"))
    return F.split(F.regexp_replace(raw.cast("string"), r'["\s]', ""), ",")


def backup_key(parts: Column) -> Column:
    """4 parts → struct(table_kind, table_id LONG, backup_kind, backup_id LONG);
    NULL if there are not 4 or an id is no integer."""
    tid = F.try_element_at(parts, F.lit(2)).try_cast("long")
    bid = F.try_element_at(parts, F.lit(4)).try_cast("long")
    ok = (F.size(parts) == 4) & tid.isNotNull() & bid.isNotNull()
    return F.when(ok, F.struct(F.try_element_at(parts, F.lit(1)).alias("table_kind"), tid.alias("table_id"),
                               F.try_element_at(parts, F.lit(3)).alias("backup_kind"), bid.alias("backup_id")))


def parse_backup_key(key: Column | str) -> Column:
    """base64 text → strip quotes and spaces → 4 comma parts → struct(
    table_kind, table_id LONG, backup_kind, backup_id LONG); NULL if any step
    fails (bad base64, wrong part count, non-integer id)."""
    return backup_key(backup_key_parts(key))


# U5 ---------------------------------------------------------------------------
@F.pandas_udf(T.StringType())
def _nfkd_ascii(s: pd.Series) -> pd.Series:
    """NFKD then drop non-ASCII: no built-in Spark function normalises
    Unicode, so this one step runs Arrow-batched in Python."""
    return s.map(lambda v: None if v is None else
                 unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii"))


def copy_request_key(date: Column | str, source_ref: Column | str, retry: Column | str,
                     suffix: Column | str) -> Column:
    """Idempotency key of a copy request: date, source reference, retry
    count and suffix joined by '_'; `$ . : space` → '_'; NFKD → ASCII;
    NULL when longer than 500 (then it is never deduplicated)."""
    joined = F.concat_ws("_", F.date_format(_c(date), "yyyy-MM-dd"), _c(source_ref),
                         _c(retry).cast("string"), F.coalesce(_c(suffix).cast("string"), F.lit("None")))
    cleaned = F.regexp_replace(joined, r"[$.: ]", "_")
    # Python UDFs are evaluated for every row of the stage, so ASCII rows pass
    # NULL (no work, nothing but a null crosses to Python).
    is_ascii = cleaned.rlike(r"^[\x00-\x7F]*$")
    ascii_ = F.when(is_ascii, cleaned).otherwise(_nfkd_ascii(F.when(~is_ascii, cleaned)))
    return F.when(F.length(ascii_) <= MAX_COPY_REQUEST_KEY, ascii_)


# U6 ---------------------------------------------------------------------------
def camel_case(s: Column | str) -> Column:
    """'In Progress' → 'inProgress' (lower, words joined, later words
    capitalised)."""
    words = F.split(F.lower(_c(s)), "[ _]+")
    rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.concat(F.try_element_at(words, F.lit(1)), F.array_join(F.transform(rest, lambda w: F.initcap(w)), ""))


# U7 ---------------------------------------------------------------------------
def restore_source(backup_project: str, backup_dataset: Column | str, backup_table: Column | str,
                   entity_partition: Column | str) -> Column:
    """Source of a restore: the copy in the backup project, plus the table
    entity's partition."""
    return table_ref(F.lit(backup_project), backup_dataset, backup_table, entity_partition)


def restore_target(target_project, target_dataset, entity_project, entity_dataset, entity_table,
                   entity_partition) -> Column:
    """Target: the request's project/dataset when given, else the entity's
    own; table and partition of the entity."""
    return table_ref(F.coalesce(_c(target_project), _c(entity_project)),
                     F.coalesce(_c(target_dataset), _c(entity_dataset)), entity_table, entity_partition)


# F9 / F13 / F14 / F15 ------------------------------------------------------------
def end_of_day(date_text: Column | str) -> Column:
    """'YYYY-MM-DD' → that day 23:59:59; NULL for invalid text."""
    d = F.try_to_timestamp(_c(date_text), F.lit("yyyy-MM-dd"))
    return (d.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(23), mins=F.lit(59),
                                                           secs=F.lit(59)))


def json_or_text(s: Column | str) -> tuple[Column, Column]:
    """(is_json, text) — valid JSON is parsed by readers, invalid text
    is passed through unchanged."""
    c = _c(s)
    # plain text is told by its beginning: parsing it would throw and catch an exception for each row
    return F.when(c.isNotNull(), c.rlike(JSON_BEGINNING) & F.try_parse_json(c).isNotNull()), c


def copy_errors_message(errors: Column | str) -> Column:
    """`Copy job finished with errors: reason:message, …`."""
    items = F.transform(_c(errors), lambda e: F.concat(e.getField("reason"), F.lit(":"),
                                                       F.coalesce(e.getField("message"), F.lit(NO_MESSAGE))))
    return F.concat(F.lit("Copy job finished with errors: "), F.array_join(items, ", "))


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text as Python's isoformat() writes it (microseconds
    only when non-zero); NULL stays NULL."""
    c = _c(ts)
    micros = F.unix_micros(c.cast("timestamp")) % 1000000
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(micros == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
