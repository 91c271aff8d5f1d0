"""Registered copy-verification query (Q19).  Copies themselves write files
and are checked end to end in tests/test_copy.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepsake.registry import register
from keepsake.sources import copy as CP
from keepsake.sources.testviews import TestViews


_COLUMNS = ("created", "id", "last_modified", "num_bytes", "parent_id")
_TEXT = " || ".join(f"'{c}=' || coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-') || ';'" for c in _COLUMNS)
_SIDE = """
SELECT dataset_id, table_id, count(*) AS n, CAST(sum(strlen(t)) AS BIGINT) AS b,
       CAST(sum(CAST(('0x' || substr(md5(t), 1, 15)) AS BIGINT)) AS VARCHAR) AS c
FROM (SELECT dataset_id, table_id, {text} AS t FROM {source}) GROUP BY 1, 2"""


@register("q19_verify_copy", f"""
SELECT coalesce(s.dataset_id, k.dataset_id) AS dataset_id, coalesce(s.table_id, k.table_id) AS table_id,
       coalesce(s.n, 0) AS source_rows, coalesce(s.b, 0) AS source_bytes, s.c AS source_checksum,
       coalesce(k.n, 0) AS copy_rows, coalesce(k.b, 0) AS copy_bytes, k.c AS copy_checksum, true AS same_schema,
       coalesce(s.n, 0) = coalesce(k.n, 0) AND coalesce(s.b, 0) = coalesce(k.b, 0) AND s.c IS NOT DISTINCT FROM k.c AS equal
FROM ({_SIDE.format(text=_TEXT, source="avail_all")}) s
FULL JOIN ({_SIDE.format(text=_TEXT, source="listed_copies")}) k USING (dataset_id, table_id)""",
          ("avail_all", "listed_copies"))
def q19(spark, sf):
    """Q19 per copy: its records against what the backup project lists of it,
    column by column; they differ where a copy is recorded twice or has
    another size."""
    v = TestViews.of(spark, sf)
    columns = ("dataset_id", "table_id", *_COLUMNS)
    source = v.backups.filter(F.col("deleted").isNull()).select(*columns)
    out = CP.verify_copy(source, v.listed_copies.select(*columns), ["dataset_id", "table_id"])
    # checksums as text: exact sums, readable by any client
    return out.withColumns({c: F.col(c).cast("string") for c in ("source_checksum", "copy_checksum")})
