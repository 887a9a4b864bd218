"""A table made of folders that a versioned list names, so that a change of many folders is one atomic step.

Every version is a small JSON file ``_manifest/v<number>.json``.  It is written under another name and renamed where
no such version exists: a reader sees the old list or the new one, and of two writers one fails.  Folders are
written before the list that names them; what a crash leaves behind is named by no list, and :meth:`Manifest.vacuum`
removes it.  All of it goes through Hadoop's file systems, so a path may be local, HDFS or an object store whose
connector can rename.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Versions that stay readable after newer ones.
KEPT = 10


@dataclass(frozen=True)
class Run:
    """One folder: what it is (``kind``), its level, and the numbers of the first and last batch in it."""

    name: str
    kind: str
    level: int
    first: int
    last: int


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._root = self._fs.Path(self.path).getFileSystem(self._conf)

    def _file(self, version: int):
        return self._fs.Path(f"{self.path}/_manifest/v{version:012d}.json")

    def _versions(self) -> list[int]:
        folder = self._fs.Path(f"{self.path}/_manifest")
        if not self._root.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._root.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _load(self, version: int) -> dict:
        stream = self._root.open(self._file(version))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, list[Run]]:
        """Number and runs of the newest version; (0, []) before the first."""
        versions = self._versions()
        if not versions:
            return 0, []
        return versions[-1], [Run(**r) for r in self._load(versions[-1])["runs"]]

    def commit(self, version: int, runs: Sequence[Run], schema: StructType) -> None:
        """Make ``runs`` version ``version + 1``; raises if another writer made that version first."""
        body = json.dumps({"runs": [asdict(r) for r in runs], "schema": json.loads(schema.json())}).encode()
        temp = self._fs.Path(f"{self.path}/_manifest/.new-{uuid.uuid4().hex}")
        out = self._root.create(temp, True)
        out.write(body)
        out.close()
        context = self._fs.FileContext.getFileContext(self._root.getUri(), self._conf)
        none = self.spark._sc._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        context.rename(self._root.makeQualified(temp), self._root.makeQualified(self._file(version + 1)), none)
        for old in [v for v in self._versions() if v <= version + 1 - KEPT]:
            self._root.delete(self._file(old), False)

    def write(self, df: DataFrame, kind: str, level: int, first: int, last: int) -> Run:
        """A new folder with ``df``; no version names it yet."""
        run = Run(f"{kind}-{level}-{uuid.uuid4().hex}", kind, level, first, last)
        df.write.parquet(f"{self.path}/{run.name}")
        return run

    def read(self, runs: Sequence[Run], schema: StructType | None = None) -> DataFrame:
        """All rows of the ``runs`` (empty, of the last schema, if there are none)."""
        if schema is None:
            versions = self._versions()
            if not versions:
                raise ValueError(f"{self.path} holds no batch yet")
            schema = StructType.fromJson(self._load(versions[-1])["schema"])
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{r.name}" for r in runs])

    def vacuum(self) -> int:
        """Delete the folders that none of the kept versions names; returns their number.  No writer may be active."""
        named = {r["name"] for v in self._versions() for r in self._load(v)["runs"]}
        gone = 0
        if self._root.exists(self._fs.Path(self.path)):
            for f in self._root.listStatus(self._fs.Path(self.path)):
                name = f.getPath().getName()
                if f.isDirectory() and not name.startswith("_") and name not in named:
                    self._root.delete(f.getPath(), True)
                    gone += 1
        return gone
