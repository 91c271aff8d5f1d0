"""Hot-key behaviour: one table holding a third of all copies.

The table entities and copies are the driver's tables with every third copy
moved to table 0 (a rule, not new data); the retention plan must still match
the DuckDB oracle built with the same rule, and the per-table work must stay
in aggregates (no window over the hot table's raw copies)."""

import os

import duckdb
from pyspark.sql import functions as F

from keepsake.checks import oracle as O
from keepsake.plans.retention import retention_plan
from keepsake.sources.testviews import TestViews, default_config
from tools.oracle_check import normalise
from tools.plan_report import physical_plan

SF = "/root/testdata/sf0.01"


def _oracle_sql():
    hot = ("SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 0 ELSE parent_id END AS parent_id) FROM ("
           + O.CTES["backups"][0] + ")")
    saved = O.CTES["backups"]
    O.CTES["backups"] = (hot, saved[1])
    try:
        return O.build("SELECT * FROM retention_plan", ("retention_plan",))
    finally:
        O.CTES["backups"] = saved


def test_hot_table_retention_matches_oracle(spark):
    v = TestViews.of(spark, SF)
    hot = v.backups.withColumn("parent_id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("parent_id")))
    plan = retention_plan(v.tables, hot, v.live, default_config())
    got = plan.toPandas()
    con = duckdb.connect()
    for t in ("orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    want = con.execute(_oracle_sql()).df()
    assert (got["parent_id"] == 0).mean() > 0.3
    a, b = normalise(got), normalise(want)
    assert len(a) == len(b) and a.equals(b)
    p = physical_plan(plan)
    # raw copies reach the hot table only through partial aggregates and id-keyed joins
    specs = __import__("re").findall(r"windowspecdefinition\(([^)]*)", p)
    assert all("young" in s for s in specs)


class HotCensusViews(TestViews):
    """The driver's tables with every third census snapshot moved to table 0."""

    def _read(self, name):
        df = super()._read(name)
        if name == "events":
            df = df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
        return df


def test_hot_census_table_sli_matches_oracle(spark):
    from keepsake.checks.oracle import build
    from keepsake.checks.q_sli import LAT_NEEDS, QUAL_NEEDS, sql_latency, sql_quality
    from keepsake.plans import sli as PS
    from keepsake.sources.testviews import AS_OF
    v = HotCensusViews(spark, SF)
    cfg = default_config()
    la = PS.last_available_backups(v.tables, v.backups)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{SF}/orders.parquet')")
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END "
                f"AS user_id) FROM read_parquet('{SF}/events.parquet')")
    assert con.execute("SELECT avg(CAST(user_id = 0 AS INTEGER)) FROM events").fetchone()[0] > 0.3
    cases = [(PS.latency_sli(v.census_tables, v.census_partitions, la, x, AS_OF, cfg),
              build(sql_latency(x, AS_OF), LAT_NEEDS)) for x in (0, 4)]
    cases.append((PS.quality_sli(v.census_tables, v.census_partitions, la, v.census_copies, AS_OF, cfg),
                  build(sql_quality(AS_OF), QUAL_NEEDS)))
    for df, sql in cases:
        a, b = normalise(df.toPandas()), normalise(con.execute(sql).df())
        assert len(a) == len(b) and a.equals(b)
