import datetime as dt

from keepsake.schemas import BACKUPS, TABLES


def tables_df(spark, rows):
    """rows: (id, project, dataset, table, partition, last_checked)"""
    return spark.createDataFrame(rows, TABLES)


_counter = [1000]


def backup(parent, created, table_id=None, deleted=None, num_bytes=100, dataset="bk0", id=None):
    if id is None:
        _counter[0] += 1
        id = _counter[0]
    return (id, parent, created - dt.timedelta(minutes=10), created, dataset,
            table_id or f"copy_{id}", num_bytes, deleted)


def backups_df(spark, rows):
    return spark.createDataFrame(rows, BACKUPS)


def live_df(spark, rows):
    """rows: (project, dataset, table, found?, partitioned?)"""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "project_id string, dataset_id string, table_id string, "
                                     "found boolean, partitioned boolean")
    return df.select("project_id", "dataset_id", "table_id",
                     F.when(F.col("found"), "found").otherwise("not_found").alias("lookup_status"),
                     F.col("found").alias("table_exists"), F.col("partitioned").alias("has_time_partitioning"))
