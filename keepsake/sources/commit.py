"""Publishing written files so that a job can stop anywhere and be run again.

A write goes to a staging folder first. Its manifest (files to move in, files
they replace, outcome of each item) then appears in one rename: from there on
the write is decided. Publishing moves the replaced files out and the staged
ones in; every move is done once at most, so publishing a manifest again ends
what an earlier run began. A published manifest stays as the record of its
items' outcomes. A write without a manifest never happened.

    <folder>/<n>.json          decided
             <n>.done.json     published
             staging-<uuid>/   files on their way
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import Any
from urllib.parse import quote


class FileSystem:
    """Hadoop file system access through the session's configuration, so it works on any cluster store."""

    def __init__(self, spark):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _p(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._p(path)
        return bool(fs.exists(p))

    def committed(self, path: str) -> bool:
        """A finished table: its writer left a `_SUCCESS` marker."""
        return self.exists(path + "/_SUCCESS")

    def folder(self, path: str) -> bool:
        p, fs = self._p(path)
        return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())

    def names(self, path: str) -> list[str]:
        p, fs = self._p(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def touch(self, path: str) -> None:
        p, fs = self._p(path)
        fs.create(p, True).close()

    def make(self, path: str) -> None:
        p, fs = self._p(path)
        fs.mkdirs(p)

    def files(self, path: str) -> dict[str, int]:
        """Parquet files below `path`, relative to it, with their bytes."""
        p, fs = self._p(path)
        if not fs.exists(p):
            return {}
        top = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
        out, it = {}, fs.listFiles(p, True)
        while it.hasNext():
            s = it.next()
            if s.getPath().getName().endswith(".parquet"):
                out[s.getPath().toUri().getPath().removeprefix(top)] = int(s.getLen())
        return out

    def data_files(self, path: str) -> bool:
        """Any parquet data file under path (recursively)?"""
        p, fs = self._p(path)
        if not fs.exists(p):
            return False
        it = fs.listFiles(p, True)
        while it.hasNext():
            if it.next().getPath().getName().endswith(".parquet"):
                return True
        return False

    def size(self, path: str) -> int:
        p, fs = self._p(path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    def rename(self, src: str, dst: str) -> bool:
        p, fs = self._p(src)
        return bool(fs.rename(p, self._jvm.org.apache.hadoop.fs.Path(dst)))

    def delete(self, path: str) -> bool:
        p, fs = self._p(path)
        return bool(fs.delete(p, True))

    def read(self, path: str) -> str:
        p, fs = self._p(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        p, fs = self._p(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()


def restore_ledger(fs: FileSystem, root: str, job: str, target: tuple[str, str, str]) -> "Ledger":
    """What one restore job has decided for one target table."""
    return Ledger(fs, f"{root.rstrip('/')}/_restores/{quote(job, safe='')}/{'.'.join(quote(x, safe='') for x in target)}")


class Ledger:
    """What was decided for one target; a folder is used by one ledger at a time."""

    def __init__(self, fs: FileSystem, folder: str):
        self.fs, self.folder = fs, folder

    def recover(self) -> list[dict[str, Any]]:
        """Outcomes recorded by earlier runs; what was decided and not published is published, what was not decided goes."""
        found, names = [], self.fs.names(self.folder)
        for name in names:
            if name.endswith(".json"):
                manifest = json.loads(self.fs.read(f"{self.folder}/{name}"))
                if not name.endswith(".done.json"):
                    self._publish(name, manifest)
                found += manifest["outcomes"]
        for name in self.fs.names(self.folder):
            if name.startswith("staging-") or name.endswith(".tmp"):
                self.fs.delete(f"{self.folder}/{name}")
        return found

    def forget(self) -> None:
        """Drop the records of what was published."""
        for name in self.fs.names(self.folder):
            if name.endswith(".done.json"):
                self.fs.delete(f"{self.folder}/{name}")

    def staging(self) -> str:
        return f"{self.folder}/staging-{uuid.uuid4().hex}"

    def commit(self, outcomes: list[dict[str, Any]], target: str = "", staging: str = "", moves: Iterable[tuple[str, str]] = (),
               replaced: Iterable[str] = ()) -> None:
        """Decide and publish: `moves` are (staged file, its place below `target`), `replaced` files below `target` go."""
        name = f"{uuid.uuid4().hex}.json"
        manifest = {"outcomes": outcomes, "target": target, "staging": staging, "moves": list(moves), "replaced": list(replaced)}
        self.fs.make(self.folder)
        self.fs.write(f"{self.folder}/{name}.tmp", json.dumps(manifest, default=str))
        self._move(f"{self.folder}/{name}.tmp", f"{self.folder}/{name}")
        self._publish(name, manifest)

    def _move(self, src: str, dst: str) -> None:
        if not self.fs.rename(src, dst):
            raise OSError(f"cannot rename {src} to {dst}")

    def _publish(self, name: str, manifest: dict[str, Any]) -> None:
        fs, target, staging = self.fs, manifest["target"], manifest["staging"]
        # replaced files leave first: a reader in between misses rows, but never counts both versions
        for i, old in enumerate(manifest["replaced"]):
            if fs.exists(f"{target}/{old}"):
                fs.make(f"{staging}/replaced")
                self._move(f"{target}/{old}", f"{staging}/replaced/{i}")
        for src, place in manifest["moves"]:
            if fs.exists(src):
                fs.make(f"{target}/{place}".rsplit("/", 1)[0])
                self._move(src, f"{target}/{place}")
            elif not fs.exists(f"{target}/{place}"):
                raise OSError(f"neither {src} nor {target}/{place} exists")
        if target:
            fs.make(target)
            fs.touch(f"{target}/_SUCCESS")
        self._move(f"{self.folder}/{name}", f"{self.folder}/{name.removesuffix('.json')}.done.json")
        if staging:
            fs.delete(staging)
