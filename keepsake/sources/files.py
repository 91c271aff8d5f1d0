"""File-system work inside tasks: listing folders, reading Parquet footers, removing folders.

The folders to work on are rows of a frame; the driver neither lists nor holds
them. Tasks reach the store through `pyarrow.fs` (local folders, hdfs, s3, gs,
abfs); the number of tasks is stated, as the rows are too small for AQE to
leave them spread out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.session import written

FOUND, NOT_FOUND, ERROR = "found", "not_found", "error"
DELETED = "deleted"
#: Spark's names for other schemes of one store.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def _hidden(name: str) -> bool:
    """As Spark's file listing has it: a partition folder may begin with an underscore."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _open(path: str):
    """(file system, path within it)."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), os.path.abspath(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """`df` dealt over a stated number of tasks by `keys`."""
    return df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism, *keys)


def _mapped(df: DataFrame, path: str, fn, schema: str) -> DataFrame:
    """Rows of `fn(path)`, tuples in the order of `schema`, beside the other columns of `df`."""
    others = [c for c in df.columns if c != path]
    names = [c.split()[0] for c in schema.split(", ")]
    out = df.select(*others, *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")]).schema

    def run(batches: Iterator):
        import pyarrow as pa

        types = pa.schema([pa.field(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]])
                           for n, c in zip(names, schema.split(", "))])
        for batch in batches:
            table = pa.Table.from_batches([batch])
            take, rows = [], []
            for i, p in enumerate(table[path].to_pylist()):
                for row in fn(p):
                    take.append(i)
                    rows.append(dict(zip(names, row)))
            found = pa.Table.from_pylist(rows, types)
            picked = pa.array(take, pa.int64())
            yield from pa.table([table[c].take(picked) for c in others] + [found[n] for n in names], names=others + names).to_batches()

    return df.mapInArrow(run, out)


def children(df: DataFrame, path: str = "path") -> DataFrame:
    """One row for each entry in the folder `path` of each row, beside the other columns: status, name, child, is_folder, bytes, modified.

    modified is in microseconds. A folder without entries, one that is not
    there and one that cannot be read are one row without a name, by `status`
    found, not_found or error. Hidden names are left out.
    """
    def one(p: str):
        from pyarrow import fs as pf

        try:
            fs, inside = _open(p)
            if fs.get_file_info(inside).type != pf.FileType.Directory:
                return [(NOT_FOUND, None, None, None, None, None)]
            entries = fs.get_file_info(pf.FileSelector(inside))
        except Exception:  # noqa: BLE001 - a failed lookup is a row
            return [(ERROR, None, None, None, None, None)]
        rows = [(FOUND, e.base_name, f"{p.rstrip('/')}/{e.base_name}", e.type == pf.FileType.Directory, e.size or 0, (e.mtime_ns or 0) // 1_000_000 * 1000)
                for e in entries if not _hidden(e.base_name)]
        return rows or [(FOUND, None, None, None, None, None)]

    return _mapped(df, path, one, "status string, name string, child string, is_folder boolean, bytes long, modified long")


def files_below(df: DataFrame, path: str = "path") -> DataFrame:
    """One row for each file below the folder `path` of each row, at any depth: file, bytes, modified."""
    def one(p: str):
        from pyarrow import fs as pf

        fs, inside = _open(p)
        todo, rows = [(inside, p.rstrip("/"))], []
        while todo:
            at, name = todo.pop()
            for e in fs.get_file_info(pf.FileSelector(at, allow_not_found=True)):
                if _hidden(e.base_name):
                    continue
                if e.type == pf.FileType.Directory:
                    todo.append((e.path, f"{name}/{e.base_name}"))
                else:
                    rows.append((f"{name}/{e.base_name}", e.size or 0, (e.mtime_ns or 0) // 1_000_000 * 1000))
        return rows

    return _mapped(df, path, one, "file string, bytes long, modified long")


def footers(df: DataFrame, path: str = "file") -> DataFrame:
    """The rows of each Parquet file by its footer: num_rows, beside the other columns."""
    def one(p: str):
        import pyarrow.parquet as pq

        fs, inside = _open(p)
        with fs.open_input_file(inside) as f:
            return [(pq.read_metadata(f).num_rows,)]

    return _mapped(df, path, one, "num_rows long")


def remove(folders: DataFrame, path: str = "path", tasks: int | None = None) -> DataFrame:
    """Remove the folder `path` of each row; the other columns and `outcome`: deleted, not_found or error.

    The outcomes are written to the checkpoint folder before they are returned,
    so reading them removes nothing again. A task that is tried again finds its
    folders gone, which is as good.
    """
    def one(p: str):
        from pyarrow import fs as pf

        try:
            fs, inside = _open(p)
            kind = fs.get_file_info(inside).type
            if kind == pf.FileType.NotFound:
                return [(NOT_FOUND,)]
            (fs.delete_dir if kind == pf.FileType.Directory else fs.delete_file)(inside)
            return [(DELETED,)]
        except Exception:  # noqa: BLE001 - a failed deletion is a row
            return [(ERROR,)]

    return written(_mapped(spread(folders, path, tasks=tasks), path, one, "outcome string"), "outcomes")
