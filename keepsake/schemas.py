"""Declared schemas of the catalog entities (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, TS, B, D = T.StringType(), T.LongType(), T.TimestampNTZType(), T.BooleanType(), T.DateType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# D1 table entity
TABLES = T.StructType([_f("id", L, False), _f("project_id", S), _f("dataset_id", S),
                       _f("table_id", S), _f("partition_id", S), _f("last_checked", TS)])

# D2 backup record; `parent_id` replaces the document-store key path
BACKUPS = T.StructType([_f("id", L, False), _f("parent_id", L, False), _f("last_modified", TS),
                        _f("created", TS), _f("dataset_id", S), _f("table_id", S),
                        _f("num_bytes", L), _f("deleted", TS)])

# D3/D4 export envelope
EXPORT_KEY = T.StructType([_f("namespace", S), _f("app", S), _f("path", S), _f("kind", S),
                           _f("name", S), _f("id", L)])
EXPORT_ENVELOPE = [_f("__key__", EXPORT_KEY), _f("__error__", T.ArrayType(S)),
                   _f("__has_error__", B)]
TABLE_EXPORT = T.StructType([f for f in TABLES.fields if f.name != "id"] + EXPORT_ENVELOPE)
BACKUP_EXPORT = T.StructType([_f("created", TS), _f("deleted", TS), _f("last_modified", TS),
                              _f("numBytes", L), _f("table_id", S), _f("dataset_id", S)]
                             + EXPORT_ENVELOPE)

# D5/D6 census snapshots
CENSUS_TABLES = T.StructType([_f("projectId", S), _f("datasetId", S), _f("tableId", S),
                              _f("snapshotTime", TS), _f("snapshot_date", D),
                              _f("lastModifiedTime", TS), _f("creationTime", TS),
                              _f("numRows", L), _f("numBytes", L), _f("type", S),
                              _f("timePartitioning", T.StructType([_f("type", S)]))])
CENSUS_PARTITIONS = T.StructType([f for f in CENSUS_TABLES.fields
                                  if f.name not in ("type", "timePartitioning")]
                                 + [_f("partitionId", S)])

# D7 raw live table metadata document (strings as the API returns them)
_TABLE_REF = T.StructType([_f("projectId", S), _f("datasetId", S), _f("tableId", S)])
LIVE_DOCUMENT = T.StructType([
    _f("tableReference", _TABLE_REF),
    _f("schema", T.StructType([_f("fields", T.ArrayType(T.StructType(
        [_f("name", S), _f("type", S), _f("mode", S)])))])),
    _f("timePartitioning", T.StructType([_f("type", S), _f("expirationMs", L)])),
    _f("numBytes", S), _f("numRows", S), _f("creationTime", S), _f("lastModifiedTime", S),
    _f("type", S), _f("location", S)])

# D8 restoration job, D9 restore item
TABLE_REFERENCE = T.StructType([_f("project_id", S), _f("dataset_id", S), _f("table_id", S),
                                _f("partition_id", S)])
RESTORATION_JOBS = T.StructType([_f("id", S, False), _f("created", TS), _f("items_count", L),
                                 _f("create_disposition", S), _f("write_disposition", S)])
RESTORE_ITEMS = T.StructType([_f("id", L, False), _f("job_id", S), _f("status", S),
                              _f("status_message", S), _f("completed", TS),
                              _f("source_table", TABLE_REFERENCE),
                              _f("target_table", TABLE_REFERENCE), _f("custom_parameters", S)])

# D10 latency SLI row, D11 quality SLI row
LATENCY_SLI = T.StructType([_f("snapshotTime", TS), _f("projectId", S), _f("datasetId", S),
                            _f("tableId", S), _f("partitionId", S), _f("creationTime", TS),
                            _f("lastModifiedTime", TS), _f("backupCreated", TS),
                            _f("backupLastModified", TS), _f("xDays", S)])
QUALITY_SLI = T.StructType([_f("snapshotTime", TS), _f("projectId", S), _f("datasetId", S),
                            _f("tableId", S), _f("partitionId", S), _f("backupDatasetId", S),
                            _f("backupTableId", S), _f("lastModifiedTime", TS),
                            _f("backupLastModifiedTime", TS), _f("backupEntityLastModifiedTime", TS),
                            _f("numBytes", L), _f("backupNumBytes", L), _f("backupEntityNumBytes", L),
                            _f("numRows", L), _f("backupNumRows", L)])

# D12 copy-job result document
_ERR = T.StructType([_f("reason", S), _f("message", S)])
COPY_JOB_RESULT = T.StructType([
    _f("jobReference", T.StructType([_f("projectId", S), _f("jobId", S)])),
    _f("configuration", T.StructType([_f("copy", T.StructType([
        _f("sourceTable", _TABLE_REF), _f("destinationTable", _TABLE_REF),
        _f("createDisposition", S), _f("writeDisposition", S)]))])),
    _f("status", T.StructType([_f("state", S), _f("errorResult", _ERR),
                               _f("errors", T.ArrayType(_ERR))])),
    _f("statistics", T.StructType([_f("startTime", S), _f("endTime", S)]))])
