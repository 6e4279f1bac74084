"""Versioned stores: feature sets with their cached features, and expectation suites.

What a version holds is written under a name of its own; then a small manifest, ``name=<name>/version=<n>/manifest``,
is created, which only one writer can do. Readers follow manifests alone: a write that was cut off is never read, and of two
writers at once each gets a number. The latest version is the largest one.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows
from tidemill.operators.features import FeatureSet, fit_feature_set, transform
from tidemill.operators.quality import IN_SET, Suite, generate_suite
from tidemill.sources.tables import read_if_exists


def version_number(version: str | int) -> int:
    return int(str(version).removeprefix("v"))


class _Documents:
    """JSON documents by name and version under one folder, as the manifests of versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self) -> DataFrame | None:
        """``(value, name, version)`` of whole documents; partition columns come from the path."""
        docs = read_if_exists(partial(self.spark.read.text, wholetext=True), self.root)
        if docs is None:
            return None
        # a writer that ended between claiming a number and writing leaves no JSON object behind
        whole = F.try_parse_json("value").isNotNull()
        return docs.where(whole).select("value", F.col("name").cast("string"), F.col("version").cast("int"))

    def latest(self, name: str) -> int:
        docs = self.table()
        if docs is None:
            return 0
        return docs.where(F.col("name") == name).agg(F.max("version")).first()[0] or 0

    def write(self, name: str, version: int, text: str) -> None:
        """Fails if the version has been claimed."""
        if not _claim(self.spark, f"{self.root}/name={name}/version={version}/manifest", text):
            raise FileExistsError(f"{name} has a version {version}")

    def append(self, name: str, text: Callable[[int], str]) -> int:
        """Write the document of the next free version, which ``text`` makes from its number."""
        version = self.latest(name) + 1
        while not _claim(self.spark, f"{self.root}/name={name}/version={version}/manifest", text(version)):
            version += 1
        return version

    def read(self, name: str, version: str | int | None) -> str:
        number = self.latest(name) if version is None else version_number(version)
        docs = self.table()
        found = None
        if docs is not None:
            found = docs.where((F.col("name") == name) & (F.col("version") == number)).select("value").first()
        if found is None:
            raise FileNotFoundError(f"{name} {'latest' if version is None else version} not found under {self.root}")
        return found[0]


def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content, unless it is there; one writer only can.

    A file system of a cluster creates exclusively itself; Hadoop's local one looks first and then writes, so that there
    the operating system is asked.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        return False
    if files.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


class FeatureStore:
    """Feature sets fitted once per version, and their transformed tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = _Documents(spark, f"{self.root}/schemas")
        self.cached_tables = _Documents(spark, f"{self.root}/cached")

    def create(
        self,
        df: DataFrame,
        name: str,
        numeric: list[str],
        categorical: list[str] | None = None,
        target: str | None = None,
        version: str | None = None,
    ) -> FeatureSet:
        fitted = fit_feature_set(df, name, numeric, categorical, target, "")
        if version is not None:
            numbered = replace(fitted, version=f"v{version_number(version)}")
            self.schemas.write(name, version_number(version), numbered.to_json())
            return numbered
        number = self.schemas.append(name, lambda n: replace(fitted, version=f"v{n}").to_json())
        return replace(fitted, version=f"v{number}")

    def load(self, name: str, version: str | int | None = None) -> FeatureSet:
        return FeatureSet.from_json(self.schemas.read(name, version))

    def transform(self, df: DataFrame, name: str, version: str | int | None = None) -> DataFrame:
        return transform(df, self.load(name, version))

    def cache(self, df: DataFrame, name: str, version: str | int | None = None, keep: list[str] | None = None) -> str:
        """Transform and write as parquet; returns the path. A version may be cached anew: the last one counts.

        The table has a path of its own, and counts when its manifest is there; what readers have open stays as it is.
        """
        fitted = self.load(name, version)
        number = version_number(fitted.version)
        path = f"{self.root}/features/name={name}/version={number}/{uuid.uuid4().hex}"
        transform(df, fitted, keep).write.mode("error").parquet(path)
        self.cached_tables.append(f"{name}@{number}", lambda n: json.dumps({"path": path}))
        return path

    def cached(self, name: str, version: str | int | None = None) -> DataFrame:
        """Read a cached version, the latest cached one by default."""
        docs = self.cached_tables.table()
        if docs is None:
            raise FileNotFoundError(f"no feature table of {name} below {self.root}")
        parts = F.split("name", "@")
        found = docs.select("value", parts[0].alias("set"), parts[1].cast("int").alias("number"), "version").where(F.col("set") == name)
        if version is not None:
            found = found.where(F.col("number") == version_number(version))
        last = found.agg(F.max_by("value", F.struct("number", "version"))).first()[0]
        if last is None:
            raise FileNotFoundError(f"no feature table of {name} {version or ''} below {self.root}")
        return self.spark.read.parquet(json.loads(last)["path"])

    def catalog(self) -> DataFrame:
        """``(feature_set_name, version, created_at, numeric_features, categorical_features, target_column)``."""
        docs = self.schemas.table()
        schema = (
            "name string, version string, created_at string, numeric map<string,struct<mean:double,sd:double>>, "
            "categorical map<string,struct<mode:string>>, target string"
        )
        if docs is None:
            docs = local_rows(self.spark, [], "value string, name string, version int")
        doc = F.from_json("value", schema)
        return docs.select(doc.alias("doc")).select(
            F.col("doc.name").alias("feature_set_name"),
            "doc.version",
            "doc.created_at",
            F.map_keys("doc.numeric").alias("numeric_features"),
            F.map_keys("doc.categorical").alias("categorical_features"),
            F.col("doc.target").alias("target_column"),
        )

    def transform_if_registered(self, df: DataFrame, model_name: str) -> DataFrame:
        """Apply the feature set named like the model; without one the features pass unchanged."""
        if self.schemas.latest(model_name) == 0:
            return df
        return self.transform(df, model_name)


class SuiteStore:
    """Expectation suites by dataset and version; large value sets are parquet tables beside the document."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.documents = _Documents(spark, f"{self.root}/expectations")

    def next_version(self, dataset: str) -> int:
        return self.documents.latest(dataset) + 1

    def save(self, suite: Suite) -> None:
        """Write a suite under its own version, which must be free."""
        self.documents.write(suite.dataset_name, version_number(suite.version), json.dumps(self._held(suite)))

    def _held(self, suite: Suite) -> dict:
        """The suite's document, after its large value sets have been written to places of their own."""
        held = json.loads(suite.to_json())
        for e in held["expectations"]:
            if e["kwargs"].get("value_table"):
                path = f"{self.root}/value_sets/name={suite.dataset_name}/{uuid.uuid4().hex}"
                suite.large_sets[e["kwargs"]["column"]].write.mode("error").parquet(path)
                e["kwargs"]["value_table"] = path
        return held

    def load(self, dataset: str, version: str | int | None = None) -> Suite:
        suite = Suite.from_json(self.documents.read(dataset, None if version == "latest" else version))
        for e in suite.expectations:
            if e["expectation_type"] == IN_SET and e["kwargs"].get("value_table"):
                suite.large_sets[e["kwargs"]["column"]] = self.spark.read.parquet(e["kwargs"]["value_table"])
                e["kwargs"]["value_table"] = True
        return suite

    def generate(self, df: DataFrame, dataset: str, overwrite: bool = False) -> Suite:
        """The stored latest suite, or a new one under the next version."""
        latest = self.documents.latest(dataset)
        if latest and not overwrite:
            return self.load(dataset, latest)
        held = self._held(generate_suite(df, dataset, f"v{latest + 1}"))
        number = self.documents.append(dataset, lambda n: json.dumps(held | {"version": f"v{n}"}))
        return self.load(dataset, number)
