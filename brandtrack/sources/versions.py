"""Lasting tables that change as a whole: a version is there completely or not at all.

Tables are written into a folder of their own first. Only when all of them are complete is a manifest put beside the
earlier ones, by renaming a finished file, and the new version is there. A writer that dies before leaves the last
version as it was, and a reader that has opened a version goes on reading its files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .publish import _place, is_published, remove

MANIFESTS = "_versions"


class VersionedTables:
    """Named tables below one folder, in numbered versions.

    One writer at a time is meant: of two that commit the same number the second fails and leaves nothing, where the file
    system refuses to rename onto an existing file.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        """The numbers of the complete versions, ascending."""
        path = f"{self.folder}/{MANIFESTS}"
        if not is_published(self.spark, path):
            return []
        system, place = _place(self.spark, path)
        names = [status.getPath().getName() for status in system.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def _manifest(self, version: int | None) -> dict:
        version = self.latest() if version is None else version
        if version is None:
            return {}
        path = f"{self.folder}/{MANIFESTS}/{version:09d}.json"
        return json.loads(self.spark.read.option("wholetext", True).text(path).first()[0])

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self._manifest(version))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table of a version, by default the last one. Later versions do not change what was opened."""
        entry = self._manifest(version)[table]
        schema = StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{entry['path']}")

    def rows(self, version: int | None = None) -> dict[str, int]:
        """The number of rows of each table, as counted when it was written."""
        return {name: entry["rows"] for name, entry in sorted(self._manifest(version).items())}

    def write(self, **tables: DataFrame) -> int:
        """Write tables, which may read the last version, and commit them as the next one. Others carry over."""
        before = self.latest()
        entries = self._manifest(before)
        stage = f"data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            watch = Observation(f"rows of {name}")
            path = f"{stage}/{name}"
            df.observe(watch, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.folder}/{path}")
            entries[name] = {"path": path, "rows": watch.get["rows"], "schema": df.schema.jsonValue()}
        return self._commit((before or 0) + 1, entries, stage)

    def _commit(self, version: int, entries: dict, stage: str) -> int:
        folder = f"{self.folder}/{MANIFESTS}"
        system, draft = _place(self.spark, f"{folder}/_draft-{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        stream.write(bytearray(json.dumps(entries).encode()))
        stream.close()
        _, place = _place(self.spark, f"{folder}/{version:09d}.json")
        if system.exists(place) or not system.rename(draft, place):
            system.delete(draft, False)
            remove(self.spark, f"{self.folder}/{stage}")
            raise RuntimeError(f"version {version} has been committed by another writer")
        return version

    def prune(self, keep: int = 2) -> None:
        """Forget all but the last versions and remove the files that none of these names.

        That includes what dead writers have left, so no writer may be at work.
        """
        known = self.versions()
        kept = {e["path"].rsplit("/", 1)[0] for v in known[-keep:] for e in self._manifest(v).values()}
        for version in known[:-keep]:
            remove(self.spark, f"{self.folder}/{MANIFESTS}/{version:09d}.json")
        system, data = _place(self.spark, f"{self.folder}/data")
        if system.exists(data):
            for status in system.listStatus(data):
                if f"data/{status.getPath().getName()}" not in kept:
                    system.delete(status.getPath(), True)
