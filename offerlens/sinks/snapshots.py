"""Tables that change together: a new version of each in a folder of its own, and one manifest row written last.

A reader sees the tables of the newest manifest row only, so a job that dies between two tables has changed nothing.
Every commit names its batch; a batch that is committed already is recognised and left out when it is repeated.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from offerlens.session import local_frame

MANIFEST = "version long, batch string, locations map<string,string>"


class Snapshots:
    """``schemas``: the tables' names and DDL schemas. One writer at a time; two commits of one version are an error."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str]):
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), schemas

    def manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self) -> Row | None:
        rows = self.manifest()
        if rows is None:
            return None
        last = rows.orderBy(rows["version"].desc()).limit(2).collect()
        if len(last) == 2 and last[0]["version"] == last[1]["version"]:
            raise RuntimeError(f"two writers committed version {last[0]['version']}")
        return last[0] if last else None

    def has(self, batch: str) -> bool:
        rows = self.manifest()
        return rows is not None and not rows.filter(rows["batch"] == batch).isEmpty()

    def read(self, name: str) -> DataFrame:
        """The table's newest version; empty before the first one."""
        last = self.latest()
        place = (last["locations"] if last else {}).get(name)
        if place is None:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{place}")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in self.schemas}

    def commit(self, batch: str, tables: dict[str, DataFrame]) -> int:
        """Write the given tables, then the manifest row that makes them the current ones. Others stay as they are."""
        last = self.latest()
        version = last["version"] + 1 if last else 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        places = dict(last["locations"]) if last else {}
        for name, rows in tables.items():
            columns = self.spark.createDataFrame([], self.schemas[name]).columns
            rows.select(*columns).write.parquet(f"{self.path}/{folder}/{name}")
            places[name] = f"{folder}/{name}"
        local_frame(self.spark, [(version, batch, list(places.items()))], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return version
