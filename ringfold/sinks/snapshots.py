"""A table of snapshots: folders of Parquet files and a JSON manifest for each snapshot.

It stands in for open table formats whose libraries are not here: appends and overwrites are
atomic (a manifest appears whole or not at all; a version belongs to the writer that created its claim file,
which needs a file system with exclusive creation), old snapshots stay readable, readers see one
snapshot. It is not their format and other engines cannot read its manifests.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import ConfigError
from .scratch import file_system, read_text, write_text


COMMIT_ATTEMPTS = 120


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        kind, _, fs = file_system(self.spark, self.path)
        at = kind(f"{self.path}/metadata")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict | None:
        found = self.versions()
        if not found:
            return None
        version = found[-1] if version is None else version
        if version not in found:
            raise ConfigError(f"no snapshot {version}; there are {found}")
        return json.loads(read_text(self.spark, f"{self.path}/metadata/v{version:06d}.json"))

    def _commit(self, df: DataFrame, append: bool) -> int:
        """Write the rows, then claim the next version; who loses the claim waits for the winner's manifest and builds on it."""
        if append:
            self._same_columns(df)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        kind, _, fs = file_system(self.spark, self.path)
        for _ in range(COMMIT_ATTEMPTS):
            version = (self.versions() or [0])[-1] + 1
            if not fs.createNewFile(kind(f"{self.path}/metadata/v{version:06d}.claim")):
                time.sleep(0.25)
                continue
            now = self._same_columns(df) if append else None
            folders = [*(now["folders"] if now else []), folder]
            text = json.dumps({"version": version, "schema": json.loads(df.schema.json()), "folders": folders})
            write_text(self.spark, f"{self.path}/metadata/v{version:06d}.json", text)
            return version
        raise ConfigError(f"another writer has claimed snapshot {version} and not finished")

    def _same_columns(self, df: DataFrame) -> dict | None:
        now = self.manifest()
        if now and [(f["name"], f["type"]) for f in now["schema"]["fields"]] != [(f["name"], f["type"]) for f in json.loads(df.schema.json())["fields"]]:
            raise ConfigError("the columns are not the table's")
        return now

    def append(self, df: DataFrame) -> int:
        """Add rows; returns the snapshot's number. The columns must be the table's."""
        return self._commit(df, True)

    def overwrite(self, df: DataFrame) -> int:
        return self._commit(df, False)

    def read(self, version: int | None = None) -> DataFrame:
        now = self.manifest(version)
        if now is None:
            raise ConfigError(f"no table at {self.path}")
        return self.spark.read.schema(T.StructType.fromJson(now["schema"])).parquet(*now["folders"])
