"""Store of fitted objects (S11): scalers, thresholds, reports and models, by name and version.

An object is written into a folder of its own first and becomes visible only by its commit record, one JSON line
under ``commits/<name>/<version>`` that names the folder. A writer that dies leaves a folder that no record names;
readers never list data folders. Versions count from 1; a second writer of the same version fails on the record.
Tables are Parquet, models go through Spark ML's own writers; trees are tables. ``root`` is a folder that driver and executors share.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import path_exists
from .models import FittedModel, KernelMap, load_pipeline
from .trees import TreeModel

RECORD = "version long, kind string, folder string, model_id string"
KINDS = ("table", "model")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _records(self, name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
            raise ValueError(f"not a name for a stored object: {name!r}")
        return f"{self.root.rstrip('/')}/commits/{name}"

    def versions(self, name: str) -> DataFrame:
        """The committed versions of ``name``: (version, kind, folder, model_id), none if it was never stored."""
        path = self._records(name)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).json(f"{path}/version=*")

    def _commit(self, name: str, kind: str, folder: str, model_id: str | None) -> int:
        last = self.versions(name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        self.spark.createDataFrame([(version, kind, folder, model_id)], RECORD).coalesce(1) \
            .write.mode("errorifexists").json(f"{self._records(name)}/version={version}")
        return version

    def _folder(self, name: str) -> str:
        self._records(name)
        return f"{self.root.rstrip('/')}/data/{name}/{uuid.uuid4().hex}"

    def save_table(self, name: str, table: DataFrame) -> int:
        """Writes a scaler, a threshold table or a report; returns its version."""
        folder = self._folder(name)
        table.write.parquet(folder)
        return self._commit(name, "table", folder, None)

    def save_model(self, name: str, model: FittedModel) -> int:
        folder = self._folder(name)
        if model.pipeline is not None:
            model.pipeline.write().save(f"{folder}/pipeline")
        if model.trees is not None:
            model.trees.head(self.spark).write.parquet(f"{folder}/cuts")
            model.trees.trees.write.parquet(f"{folder}/trees")
        if model.kernel is not None:
            model.kernel.to_rows(self.spark).write.parquet(f"{folder}/kernel")
        return self._commit(name, "model", folder, model.model_id)

    def _record(self, name: str, version: int | None, kind: str):
        found = self.versions(name).where(F.col("kind") == kind)
        if version is not None:
            found = found.where(F.col("version") == version)
        got = found.orderBy(F.col("version").desc()).first()
        if got is None:
            raise LookupError(f"no stored {kind} {name!r}" + (f" of version {version}" if version is not None else ""))
        return got

    def load_table(self, name: str, version: int | None = None) -> DataFrame:
        """The latest committed table, or the given version; LookupError if there is none."""
        return self.spark.read.parquet(self._record(name, version, "table").folder)

    def load_model(self, name: str, version: int | None = None) -> FittedModel:
        r = self._record(name, version, "model")
        kernel = None
        if path_exists(self.spark, f"{r.folder}/kernel"):
            kernel = KernelMap.from_rows(self.spark.read.parquet(f"{r.folder}/kernel"))
        if path_exists(self.spark, f"{r.folder}/trees"):
            read = self.spark.read.parquet
            return FittedModel(r.model_id, trees=TreeModel.of(read(f"{r.folder}/cuts"), read(f"{r.folder}/trees")))
        return FittedModel(r.model_id, load_pipeline(f"{r.folder}/pipeline"), kernel)

    def available(self, names: list[str]) -> list[str]:
        """Those of the names that have a committed model (M15 chooses the fallback by it)."""
        return [n for n in names if not self.versions(n).where(F.col("kind") == "model").isEmpty()]
