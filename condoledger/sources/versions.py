"""Versioned ledger tables with a commit marker per step.

Every step of a load writes its tables under a new folder and then commits by
writing one manifest row per table. The manifest of a step is a single small
Parquet file, so it is there as a whole or not at all, and nothing that a step
wrote counts before it is. A run that dies leaves at most folders that no
manifest names; the next run starts behind the last manifest.

A table is replaced by a step (its manifest row names the only folder) or
appended to (the row adds a folder to those of earlier steps).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import shuffles_freed

class Versions:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]):
        """``tables``: name -> columns as DDL."""
        self.spark, self.root, self.ddl = spark, root, tables
        self.paths: dict[str, list[str]] = {}
        self.done = 0
        for step, name, path, appended in self._manifests():
            self.done = step
            self.paths[name] = [*self.paths.get(name, []), path] if appended else [path]

    def _manifests(self) -> list[tuple]:
        try:
            rows = self.spark.read.parquet(f"{self.root}/manifest").select("step", "name", "path", "appended").collect()
        except AnalysisException as e:              # no step has committed yet
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []
        return sorted((r["step"], r["name"], r["path"], r["appended"]) for r in rows if r["path"] is not None)

    def read(self, name: str) -> DataFrame:
        paths = self.paths.get(name)
        if not paths:
            return self.spark.createDataFrame([], self.ddl[name])
        return self.spark.read.schema(self.ddl[name]).parquet(*paths)

    def write(self, step: int, name: str, df: DataFrame) -> tuple[str, dict[str, int]]:
        """Write one table of a step; its path and the counts taken while it was
        written (rows, and those inserted and updated where it has actions)."""
        path = f"{self.root}/data/{step:03d}-{uuid.uuid4().hex}/{name}"
        seen = Observation()
        action = F.col("action") if "action" in df.columns else F.lit("INSERT")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(action == "INSERT").alias("inserted"),
                        F.count_if(action == "UPDATE").alias("updated"))
        schema = self.spark.createDataFrame([], self.ddl[name]).schema
        with shuffles_freed(df.sparkSession):
            df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.parquet(path)
        return path, seen.get

    def commit(self, step: int, written: dict[str, tuple[str, bool]]) -> None:
        """Make a step's tables (name -> path, whether it is appended) the current ones."""
        rows = [(name, path, appended) for name, (path, appended) in written.items()] or [(None, None, False)]
        m = self.spark.createDataFrame(rows, "name string, path string, appended boolean")
        m.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/step={step}")
        for name, (path, appended) in written.items():
            self.paths[name] = [*self.paths.get(name, []), path] if appended else [path]
        self.done = step
