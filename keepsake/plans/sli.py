"""SLI jobs: Q11–Q16 as compositions of the SLI operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from keepsake.config import LATENCY_X_DAYS, Config
from keepsake.operators import catalog as C
from keepsake.operators import sli as S
from keepsake.sources import export as X
from keepsake.sources import sli_sink as K
from keepsake.sources.catalog import select_projects


def last_available_backups(tables: DataFrame, backups: DataFrame) -> DataFrame:
    """The read side of the metadata export: S2, S3 → J1 → W6."""
    lt = X.last_table(X.to_export(tables, "Table"))
    lb = X.last_backup(X.to_export(backups, "Backup"))
    return C.last_available_backup(C.all_backups(lb, lt))


def all_backups(tables: DataFrame, backups: DataFrame) -> DataFrame:
    lt = X.last_table(X.to_export(tables, "Table"))
    lb = X.last_backup(X.to_export(backups, "Backup"))
    return C.all_backups(lb, lt)


def latency_sli(census_tables: DataFrame, census_partitions: DataFrame, last_available: DataFrame,
                x: int, as_of: dt.datetime, cfg: Config) -> DataFrame:
    """Q11: tables/partitions violating the x-day backup latency."""
    modified = S.modified_before(census_tables, census_partitions, x, as_of)
    return S.latency_sli(modified, last_available, x, as_of, cfg)


def latency_run(spark: SparkSession, census_tables: DataFrame, census_partitions: DataFrame,
                last_available: DataFrame, live: DataFrame, partitions: DataFrame,
                run_time: dt.datetime, cfg: Config,
                x_days: Sequence[int] = LATENCY_X_DAYS) -> DataFrame:
    """Q12: Q11 for every x in one plan (one census scan, one aggregation
    keyed by (x, table), one join with the last copies) → skip list (P5) →
    typed rows (S16); one marker (S11) per run and x; violations confirmed
    against the live catalog (P17).  Returns the D10 rows the run appends."""
    modified = S.modified_before_multi(census_tables, census_partitions, list(x_days), run_time)
    sli = S.latency_sli_multi(modified, last_available, run_time, cfg)
    sli = select_projects(sli, (), cfg.projects_to_skip, column="projectId")
    rows = K.typed_latency_rows(sli, run_time, None)
    markers = reduce(DataFrame.unionByName,
                     [K.conform(K.snapshot_marker(spark, "latency", run_time, x), "latency") for x in x_days])
    return markers.unionByName(K.conform(S.confirm_latency(rows, live, partitions), "latency"))


def quality_sli(census_tables: DataFrame, census_partitions: DataFrame, last_available: DataFrame,
                census_copies: DataFrame, as_of: dt.datetime, cfg: Config) -> DataFrame:
    """Q13: copies whose size or row count differs from the unchanged source."""
    sources = S.quality_sources(census_tables, census_partitions, as_of, cfg)
    in_census = S.last_backup_in_census(last_available, census_copies, cfg.backup_project)
    return S.quality_sli(sources, in_census, as_of)


def quality_run(spark: SparkSession, census_tables: DataFrame, census_partitions: DataFrame,
                last_available: DataFrame, census_copies: DataFrame, live: DataFrame,
                partitions: DataFrame, live_copies: DataFrame, run_time: dt.datetime,
                cfg: Config) -> DataFrame:
    """Q14: Q13 → P5 → S16 → S11 → P18."""
    sli = quality_sli(census_tables, census_partitions, last_available, census_copies, run_time, cfg)
    sli = select_projects(sli, (), cfg.projects_to_skip, column="source_project_id")
    rows = K.typed_quality_rows(sli, run_time)
    marker = K.conform(K.snapshot_marker(spark, "quality", run_time), "quality")
    return marker.unionByName(K.conform(S.confirm_quality(rows, live, partitions, live_copies), "quality"))


def orphaned_backups(census_copies: DataFrame, tables: DataFrame, backups: DataFrame,
                     as_of: dt.datetime, cfg: Config) -> DataFrame:
    """Q16."""
    return S.orphaned_backups(census_copies, all_backups(tables, backups), as_of, cfg.backup_project)


def sli_current(latency_history: DataFrame, quality_history: DataFrame, as_of: dt.datetime) -> dict:
    """Q15: the 'current' views over today's ingest partition of the SLI
    history tables: newest latency snapshot per x (W4), violations per x
    (A1), newest quality snapshot (W5) and the last snapshot times (A2)."""
    latency = S.newest_latency_snapshot(latency_history, as_of)
    return {"latency": latency, "latency_by_count": S.latency_by_count(latency),
            "quality": S.newest_quality_snapshot(quality_history, as_of),
            "latency_last_snapshot": S.last_snapshot_time(latency_history, as_of),
            "quality_last_snapshot": S.last_snapshot_time(quality_history, as_of)}
