"""The reference's retention-policy scenarios (as of 2017-08-20, 7 months,
10 young versions), each as one table through the whole Q1 plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.plans.retention import retention_plan
from tests.helpers import backup, backups_df, live_df, tables_df

D = dt.datetime
AS_OF = D(2017, 8, 20)
SEEN = D(2017, 8, 19)


def daily(n, start):
    return [start + dt.timedelta(days=i) for i in range(n)]


TWO_OLD = [D(2016, 7, 31), D(2016, 8, 1)]
CASES = [
    # name, copies (created), last_checked, source exists, expected deleted
    ("single young", [D(2017, 8, 1)], SEEN, True, []),
    ("3 young", daily(3, D(2017, 8, 1)), SEEN, True, []),
    ("10 young", daily(10, D(2017, 8, 1)), SEEN, True, []),
    ("11 young", daily(11, D(2017, 8, 1)), SEEN, True, [D(2017, 8, 1)]),
    ("same-day duplicates",
     daily(5, D(2017, 6, 1, 12)) + daily(5, D(2017, 6, 6, 12)) + daily(5, D(2017, 6, 1, 14)), SEEN, True,
     daily(5, D(2017, 6, 1, 12))),
    ("today duplicates and 11th young, old kept",
     daily(10, D(2017, 8, 1)) + [D(2017, 8, 19, h) for h in (10, 9, 8, 7)] + [D(2016, 8, 19, 10)], SEEN, True,
     [D(2017, 8, 1)] + [D(2017, 8, 19, h) for h in (9, 8, 7)]),
    ("single old", [D(2016, 8, 1)], SEEN, True, []),
    ("two old", TWO_OLD, SEEN, True, [D(2016, 7, 31)]),
    ("young + old", [D(2017, 8, 1), D(2016, 8, 1)], SEEN, True, []),
    ("3 young + old", daily(3, D(2017, 8, 1)) + [D(2016, 8, 1)], SEEN, True, []),
    ("10 young + old", daily(10, D(2017, 8, 1)) + [D(2016, 8, 1)], SEEN, True, []),
    ("11 young + old", daily(11, D(2017, 8, 1)) + [D(2016, 8, 1)], SEEN, True, [D(2017, 8, 1)]),
    ("two old + young", TWO_OLD + [D(2017, 8, 1)], SEEN, True, [D(2016, 7, 31)]),
    ("two old + 3 young", TWO_OLD + daily(3, D(2017, 8, 1)), SEEN, True, [D(2016, 7, 31)]),
    ("two old + 10 young", TWO_OLD + daily(10, D(2017, 8, 1)), SEEN, True, [D(2016, 7, 31)]),
    ("two old + 11 young", TWO_OLD + daily(11, D(2017, 8, 1)), SEEN, True, [D(2016, 7, 31), D(2017, 8, 1)]),
    ("same day, source exists", [D(2017, 1, 1, 13, 15), D(2017, 1, 1, 16, 30)], SEEN, True,
     [D(2017, 1, 1, 13, 15)]),
    ("source gone 7 months", [D(2017, 1, 17), D(2017, 1, 18)], D(2017, 1, 19), False,
     [D(2017, 1, 17), D(2017, 1, 18)]),
    ("source gone recently", [D(2017, 8, 1), D(2016, 1, 17)], D(2017, 8, 1), False, []),
    ("above last 10 young, source gone", [D(2017, 6, 1)] + daily(10, D(2017, 6, 2)), AS_OF, False,
     [D(2017, 6, 1)]),
]


@pytest.mark.parametrize("name,created,last_checked,exists,expected", CASES, ids=[c[0] for c in CASES])
def test_reference_retention_case(spark, name, created, last_checked, exists, expected):
    t = tables_df(spark, [(1, "example-project-id", "example-dataset-id", "example-table-id", None, last_checked)])
    live = live_df(spark, [("example-project-id", "example-dataset-id", "example-table-id", exists, False)])
    bs = backups_df(spark, [backup(1, c) for c in created])
    plan = retention_plan(t, bs, live, Config(as_of=AS_OF))
    deleted = sorted(r["created"] for r in plan.filter(~F.col("retained")).collect())
    assert deleted == sorted(expected)
