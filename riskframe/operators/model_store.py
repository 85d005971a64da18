"""Versions of saved models with a manifest.

``save`` writes every model of a version and then its manifest aside, under a
folder of their own, and names the version last, by creating one empty commit
file. Readers take the newest commit, so they never see half a version, and a
version once read stays where it is while others are written:

    <root>/versions/<version>/<model key>/...     one PipelineModel each
    <root>/versions/<version>/manifest/...        a row a model
    <root>/commits/<number>-<version>             empty; the highest is current
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .train import DEFAULT_MODEL, REGISTRY, load_model, save_models

_MANIFEST = ("version string, model string, name string, place int, needs_scaler boolean, "
             "features array<string>, label string, note string")


@dataclass(frozen=True)
class Version:
    number: int
    name: str


class ModelStore:
    """Saved models under ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def versions(self) -> list[Version]:
        """The committed versions, oldest first."""
        fs, folder = self._fs(f"{self.root}/commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        found = [n.split("-", 1) for n in names if "-" in n and not n.startswith((".", "_"))]
        return sorted((Version(int(number), name) for number, name in found), key=lambda v: (v.number, v.name))

    def current(self) -> Version:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no saved model under {self.root}")
        return known[-1]

    def _folder(self, version: Version | None) -> str:
        return f"{self.root}/versions/{(version or self.current()).name}"

    def save(self, models: Mapping[str, PipelineModel], features: Sequence[str], label: str, note: str = "") -> Version:
        """Write the models as a new version and make it the current one."""
        unknown = [k for k in models if k not in REGISTRY]
        if unknown or not models:
            raise KeyError(f"models to save: {list(models)}; known: {list(REGISTRY)}")
        name = uuid.uuid4().hex
        folder = f"{self.root}/versions/{name}"
        save_models(dict(models), folder)
        places = list(REGISTRY)
        rows = [(name, k, REGISTRY[k].name, places.index(k), REGISTRY[k].needs_scaler, list(features), label, note)
                for k in places if k in models]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
        known = self.versions()
        version = Version(known[-1].number + 1 if known else 1, name)
        fs, commit = self._fs(f"{self.root}/commits/{version.number:08d}-{name}")
        if not fs.createNewFile(commit):  # creates it whole or not at all
            raise FileExistsError(f"{commit} exists")
        return version

    def manifest(self, version: Version | None = None) -> DataFrame:
        """version, model, name, place in the registry, needs_scaler, features, label, note."""
        return self.spark.read.schema(_MANIFEST).parquet(f"{self._folder(version)}/manifest")

    def load(self, key: str = DEFAULT_MODEL, version: Version | None = None) -> tuple[str, PipelineModel]:
        """K2: the model ``key`` of a version (the current one by default), or
        the first that the version holds in registry order; with its key."""
        return load_model(self.spark, self._folder(version), key)

    def load_all(self, version: Version | None = None) -> dict[str, PipelineModel]:
        """Every model of one version, in registry order."""
        version = version or self.current()
        keys = [r["model"] for r in self.manifest(version).orderBy("place").collect()]  # a row a model
        return {k: self.load(k, version)[1] for k in keys}
