"""A report pack that is whole or not there.

Each write of a pack goes to a folder of its own, table by table, with Spark's writers. When
all tables are written and counted, the manifest is; last of all a commit file of the next
number is moved into place in one step, and names that folder. Readers follow the highest
commit, so until then they see the version before, and a failed or lost write leaves nothing
that anyone reads. Two writers can't take the same number: the second one's move fails, and
it tries the next. All file work goes through Hadoop's file systems, whatever the path."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import sheet_name


class ReportPack:
    """Versions of a set of named tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _commits(self) -> dict[int, str]:
        """Number of each commit and its version's folder."""
        at = self._path("_commits")
        if not self._fs.exists(at):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        found = (n.partition("-") for n in names if not n.startswith((".", "_")))
        return {int(number): folder for number, _, folder in found}

    def versions(self) -> list[int]:
        return sorted(self._commits())

    def _commit(self, folder: str) -> int:
        """Take the next free number: a marker of that number alone is made, which only one
        writer can do, then the commit is named."""
        self._fs.mkdirs(self._path("_commits"))
        self._fs.mkdirs(self._path("_numbers"))
        number = max([0, *self._commits()]) + 1
        while not self._take(self._path(f"_numbers/{number:012d}")):
            number += 1
        staged = self._path(f"_versions/{folder}/_commit")
        self._fs.create(staged, False).close()
        if not self._fs.rename(staged, self._path(f"_commits/{number:012d}-{folder}")):
            raise OSError(f"version {number} of {self.root} could not be committed")
        return number

    def _take(self, marker) -> bool:
        """Make a file that nobody else has made. Hadoop's local file system looks and then writes, so two could."""
        if self._fs.getUri().getScheme() == "file":
            return self._jvm.java.io.File(self._fs.makeQualified(marker).toUri().getPath()).createNewFile()
        return self._fs.createNewFile(marker)

    def write(self, tables: Mapping[str, DataFrame]) -> int:
        """Write all ``tables`` as the next version and return its number. If one of them
        fails, the version before stays the current one. Names whose first 31 characters
        (a sheet's label) are the same are an error."""
        labels = Counter(sheet_name(name).lower() for name in tables)
        if repeated := [name for name in tables if labels[sheet_name(name).lower()] > 1]:
            raise ValueError(f"table names with the same 31 characters: {', '.join(repeated)}")
        folder = uuid.uuid4().hex
        try:
            rows = []
            for name, df in tables.items():
                path = f"_versions/{folder}/{quote(name, safe='').replace('%20', '+')}"
                writer = df.write.mode("errorifexists")
                (writer.option("header", True) if self.fmt == "csv" else writer).format(self.fmt).save(f"{self.root}/{path}")
                n = self._load(path, df.schema).count()
                rows.append((name, sheet_name(name), path, int(n), list(df.columns), df.schema.json()))
            manifest = self.spark.createDataFrame(rows, "name string, sheet string, path string, rows long, columns array<string>, schema string")
            manifest.coalesce(1).write.parquet(f"{self.root}/_versions/{folder}/_manifest")
            return self._commit(folder)
        except BaseException:
            self._fs.delete(self._path(f"_versions/{folder}"), True)
            raise

    def _load(self, path: str, like: T.StructType) -> DataFrame:
        return self.spark.read.schema(like).option("header", True).format(self.fmt).load(f"{self.root}/{path}")

    def _stored(self, version: int | None) -> tuple[int, DataFrame]:
        commits = self._commits()
        if not commits:
            raise FileNotFoundError(f"no report pack in {self.root}")
        version = max(commits) if version is None else version
        if version not in commits:
            raise FileNotFoundError(f"no version {version} in {self.root}")
        return version, self.spark.read.parquet(f"{self.root}/_versions/{commits[version]}/_manifest")

    def manifest(self, version: int | None = None) -> DataFrame:
        """``(version, name, sheet, path, rows, columns)`` of the current or a given version."""
        number, stored = self._stored(version)
        return stored.select(F.lit(number).cast("long").alias("version"), "name", "sheet", "path", "rows", "columns")

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the current or a given version, with the schema that it was written with."""
        row = self._stored(version)[1].filter(F.col("name") == name).first()  # a row for each table
        if row is None:
            raise KeyError(name)
        return self._load(row["path"], T.StructType.fromJson(json.loads(row["schema"])))

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the last ``keep`` versions, and folders that were never committed;
        the numbers deleted. Not to be run while a write is under way."""
        if keep < 1:
            raise ValueError("keep at least one version")
        commits = self._commits()
        old = sorted(commits)[:-keep]
        for number in old:
            self._fs.delete(self._path(f"_commits/{number:012d}-{commits[number]}"), False)
        kept = {commits[n] for n in commits if n not in old}
        if self._fs.exists(self._path("_versions")):
            for s in self._fs.listStatus(self._path("_versions")):
                if s.getPath().getName() not in kept:
                    self._fs.delete(s.getPath(), True)
        return old
