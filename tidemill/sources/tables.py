"""Dataset readers chosen by file extension, and append-only result sinks."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.columns import value_of


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multiline_json: bool = True
) -> DataFrame:
    """Read csv, tsv, json or parquet by extension and drop rows that are null throughout.

    Without ``schema`` the text formats are read twice, once to infer the types. ``multiline_json=False`` reads
    one document per line, which splits large files.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if extension in (".csv", ".tsv"):
        df = reader.csv(
            path, header=True, sep="\t" if extension == ".tsv" else ",", inferSchema=schema is None, enforceSchema=False
        )
    elif extension == ".json":
        df = reader.json(path, multiLine=multiline_json)
    elif extension == ".parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"no reader for files ending in {extension}")
    return drop_empty_rows(df)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is missing, NaN included. The columns stay as they are, so that filters on
    them still reach the file scan."""
    filled = F.lit(False)
    for c in df.columns:
        filled = filled | value_of(df, c).isNotNull()
    return df.where(filled)


def read_if_exists(reader, path: str) -> DataFrame | None:
    """Apply a reader method to a path; None when nothing has been written there yet."""
    try:
        return reader(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_validation(results: DataFrame, path: str, dataset: str, run_id: str) -> None:
    """Append one validation run, partitioned by dataset and run."""
    stamped = results.withColumns(
        {"dataset": F.lit(dataset), "run_id": F.lit(run_id), "validated_at": F.current_timestamp()}
    )
    stamped.write.mode("append").partitionBy("dataset", "run_id").parquet(path)


def read_validations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_drift_summary(summary: DataFrame, drift_by_feature: DataFrame, path: str) -> None:
    """Append one JSON line: time, share and counts, and the verdict per column (bounded by the schema)."""
    features = drift_by_feature.agg(
        F.sort_array(F.collect_list(F.struct("column", "statistic", "drift_detected"))).alias("drift_by_feature")
    )
    verdicts = features.scalar()
    summary.select(F.current_timestamp().alias("timestamp"), "*", verdicts.alias("drift_by_feature")).write.mode(
        "append"
    ).json(path)
