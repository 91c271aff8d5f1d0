"""Q3 backup_plan, Q5 on-demand plan; the copy side lives in sources.copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.functions import columns as U
from keepsake.functions.timeutil import date_lit, ts_lit
from keepsake.operators import backup as B
from keepsake.sources.catalog import enumerate_sources

PLAN_COLUMNS = ["project_id", "dataset_id", "table_id", "partition_id", "entity_id", "copyable", "reason",
                "needs_backup", "target_dataset_id", "target_table_id", "request_key", "location",
                "has_partition_expiration"]


def backup_plan(live: DataFrame, partitions: DataFrame, tables: DataFrame, backups: DataFrame,
                cfg: Config) -> DataFrame:
    """Q3: S7 → P4 → P1 → P2 → ids.

    One row per table or day partition the run looks at: copyable and why,
    whether it needs a copy, and where the copy would go.  M1 (entity
    upsert) consumes this frame.
    """
    sources = enumerate_sources(live, cfg.custom_projects, cfg.projects_to_skip)
    units = B.copyable(B.route_partitions(sources, partitions))
    j = B.attach_last_backup(units, tables, backups)
    need = B.needs_backup(j)
    ref = U.format_table_ref(U.table_ref("project_id", "dataset_id", "table_id", "partition_id"))
    return j.select(
        "project_id", "dataset_id", "table_id", "partition_id", "entity_id", "copyable", "reason",
        need.alias("needs_backup"),
        U.backup_dataset_id(date_lit(cfg.as_of), F.col("location"), F.col("project_id")).alias("target_dataset_id"),
        U.backup_table_id("project_id", "dataset_id", "table_id", ts_lit(cfg.as_of), "partition_id")
        .alias("target_table_id"),
        U.copy_request_key(ts_lit(cfg.as_of), ref, F.lit(0), F.lit(None)).alias("request_key"),
        "location", "has_partition_expiration", "unit_last_modified", "unit_num_bytes")


def copy_plan(plan: DataFrame) -> DataFrame:
    """The rows that get a copy."""
    return plan.filter(F.col("needs_backup"))


def on_demand_plan(live: DataFrame, requests: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Q5, planning: every request with its action and error (P3), and the copies to make for the accepted ones."""
    checked = B.on_demand_backup(live, requests)
    loc = live.select("project_id", "dataset_id", "table_id", "location", "has_partition_expiration")
    todo = (checked.filter(F.col("action") == "backup").join(loc, ["project_id", "dataset_id", "table_id"], "left")
            .select("project_id", "dataset_id", "table_id", "partition_id",
                    U.backup_dataset_id(date_lit(cfg.as_of), F.coalesce("location", F.lit("US")), F.col("project_id"))
                    .alias("target_dataset_id"),
                    U.backup_table_id("project_id", "dataset_id", "table_id", ts_lit(cfg.as_of), "partition_id")
                    .alias("target_table_id"), "has_partition_expiration"))
    return checked, todo


def on_demand_entities(tables: DataFrame, todo: DataFrame, cfg: Config) -> DataFrame:
    """M1 for the accepted requests of Q5: known entities are marked as checked, unknown ones created."""
    entity = todo.select(*B.KEYS, F.lit(True).alias("needs_backup"))
    existing = tables.select(*[F.col(k).alias("e_" + k) for k in B.KEYS], F.col("id").alias("_id"))
    # a whole table has a NULL partition: equal to the NULL of its entity
    plan = (entity.join(existing, B.keys_match(entity, existing, "e_"), "left")
            .select(F.col("_id").alias("entity_id"), *B.KEYS, "needs_backup"))
    return B.upsert_last_checked(tables, plan, cfg.as_of)
