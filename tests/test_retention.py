"""Retention golden cases (the reference's policy tests) and properties."""

import datetime as dt

from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.operators import retention as R
from keepsake.plans.retention import retention_plan
from tests.helpers import backup, backups_df, live_df, tables_df

D = dt.datetime


def _plan(spark, backups, as_of, last_checked=None, exists=True, keep=10):
    t = tables_df(spark, [(1, "p", "d", "t", None, last_checked or as_of)])
    live = live_df(spark, [("p", "d", "t", exists, False)])
    cfg = Config(as_of=as_of, keep_young=keep)
    return retention_plan(t, backups_df(spark, backups), live, cfg)


def _deleted_created(plan):
    return sorted(r["created"] for r in plan.filter(~F.col("retained")).collect())


def test_eleven_daily_copies_oldest_deleted(spark):
    bs = [backup(1, D(2017, 8, 1) + dt.timedelta(days=i)) for i in range(11)]
    plan = _plan(spark, bs, D(2017, 8, 20))
    assert _deleted_created(plan) == [D(2017, 8, 1)]


def test_same_day_duplicates_earlier_deleted(spark):
    days = [D(2017, 8, 1) + dt.timedelta(days=i) for i in range(10)]
    bs = [backup(1, d) for d in days] + [backup(1, d + dt.timedelta(hours=2)) for d in days[:5]]
    plan = _plan(spark, bs, D(2017, 8, 20))
    assert _deleted_created(plan) == days[:5]


def test_old_copies_keep_only_newest(spark):
    bs = [backup(1, D(2016, 7, 31)), backup(1, D(2016, 8, 1))]
    plan = _plan(spark, bs, D(2017, 8, 20), last_checked=D(2017, 8, 19))
    assert _deleted_created(plan) == [D(2016, 7, 31)]


def test_source_gone_past_grace_deletes_all(spark):
    bs = [backup(1, D(2017, 1, 17)), backup(1, D(2017, 1, 18))]
    plan = _plan(spark, bs, D(2017, 8, 20), last_checked=D(2017, 1, 19), exists=False)
    assert _deleted_created(plan) == [D(2017, 1, 17), D(2017, 1, 18)]


def test_one_young_one_old_gone_recently_kept(spark):
    bs = [backup(1, D(2017, 8, 1)), backup(1, D(2016, 8, 1))]
    plan = _plan(spark, bs, D(2017, 8, 20), last_checked=D(2017, 8, 1), exists=False)
    assert _deleted_created(plan) == []


def test_age_split_boundary(spark):
    bs = [backup(1, D(2017, 1, d)) for d in (18, 19, 20, 21)]
    out = R.age_split(backups_df(spark, bs), D(2017, 8, 20), 7).collect()
    young = sorted(r["created"].day for r in out if r["young"])
    assert young == [20, 21]


def test_duplicate_physical_copy_skips_table(spark):
    bs = [backup(1, D(2017, 8, 1), table_id="same"), backup(1, D(2017, 8, 2), table_id="same"),
          backup(1, D(2016, 1, 1))]
    plan = _plan(spark, bs, D(2017, 8, 20))
    rows = plan.collect()
    assert all(r["retained"] and r["reason"] == "duplicate_table_id" for r in rows)
    dup = R.duplicate_copies(backups_df(spark, bs)).collect()
    assert [(r["table_id"], r["copies"]) for r in dup] == [("same", 2)]


def test_properties_on_driver_tables(spark):
    from keepsake.sources.testviews import TestViews, default_config
    v = TestViews(spark, "/root/testdata/sf0.001")
    cfg = default_config()
    plan = retention_plan(v.tables, v.backups, v.live, cfg).cache()
    cand = R.retention_candidates(v.tables, cfg.as_of, cfg.grace_months).select(F.col("id").alias("parent_id"))
    avail = R.available(v.backups).join(cand, "parent_id", "left_semi")
    # retained ∪ deleted = available, disjoint
    assert plan.count() == avail.count() == plan.select("id").distinct().count()
    # at most keep young + 1 old per table after retention
    kept = R.age_split(plan.filter("retained").join(v.backups.select("id"), "id"), cfg.as_of, cfg.young_months)
    per = kept.groupBy("parent_id", "young").count().collect()
    assert all(r["count"] <= (cfg.keep_young if r["young"] else 1) for r in per
               if r["parent_id"] != 7)
    # a second run over the marked-deleted copies deletes nothing more
    outcomes = plan.filter(~F.col("retained")).select("id", F.lit("deleted").alias("outcome"))
    after = R.mark_deleted(v.backups, outcomes, cfg.as_of)
    again = retention_plan(v.tables, after, v.live, cfg)
    assert again.filter(~F.col("retained")).count() == 0


def test_newest_id_is_latest_by(spark):
    """Ties in time, NULL times, the ends of both ranges."""
    from keepsake.operators.common import latest_by, newest_id
    a, z, t = dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(1, None, 5), (1, None, 7), (2, a, -2 ** 63), (2, a, -3), (2, None, 9), (3, t, 2 ** 63 - 1), (3, t, 1),
            (4, z, 0), (4, t, 8), (None, t, 4), (None, t, 3)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, id long")
    want = latest_by(df, ["k"], "t", ["id"]).select("k", "t", "id")
    assert sorted(map(str, newest_id(df, ["k"], "t", "id").collect())) == sorted(map(str, want.collect()))
    assert newest_id(df.limit(0), ["k"], "t", "id").count() == 0
