"""Request batches scored as they arrive: variant, validation, features, prediction, confidence, and one log of it all.

A batch is written under its own number, and counts from the moment when the ledger names it. Readers follow the ledger
alone, so a batch that was cut off leaves nothing to see, and one that comes again adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.columns import epoch_seconds, local_rows, quoted, value_of
from tidemill.operators.abtest import LATEST, ABTest, assign_variants
from tidemill.operators.features import transform
from tidemill.operators.models import Trained
from tidemill.operators.quality import row_errors
from tidemill.sources.stores import FeatureStore
from tidemill.sources.tables import read_if_exists

LOG = (
    "request string, user string, ts timestamp, variant string, model_name string, model_version string, "
    "prediction string, confidence double, latency double, metrics map<string,double>"
)
REJECTED = "request string, user string, ts timestamp, variant string, model_name string, model_version string, errors array<string>"
LEDGER = "scored bigint, rejected bigint, job string, batch bigint"


@dataclass
class Scorer:
    """Models by name and version, and how requests reach them.

    ``key``, ``user`` and ``ts`` name columns of a request. Without a ``test`` all requests go to ``model``. A model's
    ``ranges`` are what a request must fill and lie within; others are logged as rejected, with what is wrong. A feature
    set with the name of the model in ``store`` makes the features, else the request's columns are taken as they are.
    ``now`` is the moment a batch is scored at: latency is the time since the request.
    """

    root: str
    models: Mapping[tuple[str, str], Trained]
    key: str
    user: str
    ts: str
    test: ABTest | None = None
    model: tuple[str, str] | None = None
    ranges: Mapping[str, Mapping[str, tuple[float, float]]] = field(default_factory=dict)
    store: FeatureStore | None = None
    now: Callable[[], Column] = F.current_timestamp
    job: str = "scoring"

    def assigned(self, requests: DataFrame) -> DataFrame:
        if self.test is not None:
            return assign_variants(requests, self.test, [self.user])
        name, version = self.model or next(iter(self.models))
        return requests.withColumns(
            {"variant": F.lit(None).cast("string"), "model_name": F.lit(name), "model_version": F.lit(version or LATEST)}
        )

    def used(self, requests: DataFrame) -> DataFrame:
        """The columns that scoring reads; a feature set may read any."""
        if self.store is not None:
            return requests
        named = {self.key, self.user, self.ts}.union(*self.ranges.values(), *[m.features for m in self.models.values()])
        # whatever the case, and also a field of a column
        read = {part for c in named for part in (c.strip("`").lower(), c.strip("`").lower().split(".")[0])}
        return requests.select(*[F.col(quoted(c)) for c in requests.columns if c.lower() in read])

    def score(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of the log, and the rejected ones. A request for a model that is not there is rejected."""
        return self.score_assigned(self.assigned(requests), requests.columns)

    def score_assigned(self, assigned: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """As ``score``, of requests of these columns that have their variant and model."""
        about = [F.col(self.key).cast("string").alias("request"), F.col(self.user).cast("string").alias("user"), F.col(self.ts).cast("timestamp").alias("ts")]
        about += [F.col(c) for c in ("variant", "model_name", "model_version")]
        known = F.lit(False)
        scored, rejected = [], []
        for (name, version), trained in self.models.items():
            here = (F.col("model_name") == name) & (F.col("model_version") == version)
            known = known | here
            checked = self._checked(assigned.where(here), name, trained)
            rejected.append(checked.where("not is_valid").select(*about, "errors"))
            valid = checked.where("is_valid").select(F.struct(*about).alias("_about"), *columns)
            features = valid if self.store is None else self._features(valid, name)
            found = trained.predict(features)
            sure = F.col("confidence") if "confidence" in found.columns else F.lit(None).cast("double")
            metrics = F.when(sure.isNotNull(), F.create_map(F.lit("confidence"), sure))
            waited = (epoch_seconds(self.now()) - epoch_seconds(F.col("_about.ts"))).cast("double")
            scored.append(
                found.select("_about.*", F.col("prediction").cast("string").alias("prediction"), sure.alias("confidence"), waited.alias("latency"), metrics.alias("metrics"))
            )
        missing = assigned.where(~known).select(*about, F.array(F.lit("model not found")).alias("errors"))
        return reduce(DataFrame.unionByName, scored), reduce(DataFrame.unionByName, [*rejected, missing])

    def _checked(self, requests: DataFrame, name: str, trained: Trained) -> DataFrame:
        """With ``errors`` and ``is_valid``: also a feature that the model takes as it is must be filled."""
        ranges = self.ranges.get(name, {})
        checked = row_errors(requests, ranges)
        if self.store is not None and self.store.schemas.latest(name):
            return checked
        plain = [c for c in trained.features if c not in ranges]
        gaps = F.array_compact(F.array(*[F.when(value_of(requests, c).isNull(), f"{c}: missing value") for c in plain], F.lit(None).cast("string")))
        return checked.withColumn("errors", F.concat("errors", gaps)).withColumn("is_valid", F.size("errors") == 0)

    def _features(self, valid: DataFrame, name: str) -> DataFrame:
        """The registered features beside the row they are of."""
        if self.store.schemas.latest(name) == 0:
            return valid
        return transform(valid, self.store.load(name), ["_about"])

    def process(self, batch: DataFrame, number: int) -> bool:
        """Score and log one batch, unless the ledger has it; whether it was new."""
        spark = batch.sparkSession
        done = ledger(spark, self.root).where((F.col("job") == self.job) & (F.col("batch") == number))
        if done.take(1):
            return False
        batch = self.used(batch)
        # every model and both tables read the requests: their variants are drawn once
        assigned = self.assigned(batch).persist()
        try:
            counts = []
            for kind, rows in zip(("log", "rejected"), self.score_assigned(assigned, batch.columns), strict=True):
                path = f"{self.root}/{kind}/job={self.job}/batch={number}"
                rows.write.mode("overwrite").parquet(path)
                counts.append(spark.read.parquet(path).count())
        finally:
            assigned.unpersist()
        entry = local_rows(spark, [(*counts, self.job, number)], LEDGER)
        entry.drop("job", "batch").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/job={self.job}/batch={number}")
        return True

    def run(self, requests: DataFrame, checkpoint: str) -> None:
        """Everything that is there now of a stream of requests."""
        query = (
            requests.writeStream.foreachBatch(lambda batch, number: self.process(batch, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """``(scored, rejected, job, batch)``: the batches that count."""
    found = read_if_exists(partial(_read, spark, LEDGER), f"{root}/ledger")
    return local_rows(spark, [], LEDGER) if found is None else found


def _read(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _committed(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    whole = f"{schema}, job string, batch bigint"
    found = read_if_exists(partial(_read, spark, whole), f"{root}/{kind}")
    found = local_rows(spark, [], whole) if found is None else found
    return found.join(ledger(spark, root).select("job", "batch"), ["job", "batch"], "left_semi").select(*StructType.fromDDL(schema).names)


def prediction_log(spark: SparkSession, root: str) -> DataFrame:
    """The scored requests of all batches in the ledger; what the results of a test and the metrics of a model read."""
    return _committed(spark, root, "log", LOG)


def rejected_requests(spark: SparkSession, root: str) -> DataFrame:
    """Requests that failed validation, with their errors."""
    return _committed(spark, root, "rejected", REJECTED)
