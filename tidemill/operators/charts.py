"""The table behind each chart; drawing is left to the caller."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import (
    AGG_WIDTH,
    broadcast_if,
    local_rows,
    long_rows,
    numeric_columns,
    one_row,
    require_columns,
    small_or_none,
    unpivot_values,
    value_of,
)
from tidemill.functions.ranking import SMALL_GROUPS, exact_quantiles
from tidemill.operators.features import fit_numeric, scaled

# Limits and defaults of the charts.
HISTOGRAM_BINS = 30
WHISKER = 1.5
PIE_SLICES, PIE_KEPT, PIE_REST = 8, 7, "Others"
KDE_GRID, KDE_CUT = 200, 3.0
# Values and grid points that meet in one matrix of a density.
KDE_CELLS = 1 << 20


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``(column, bin, low, high, count)``: equal-width bins, the last one closed; empty bins are left out."""
    columns = list(columns or numeric_columns(df))
    limits = one_row(
        df,
        {(end, c): f(value_of(df, c).cast("double")) for c in columns for end, f in (("lo", F.min), ("hi", F.max))},
    )
    filled = [c for c in columns if limits[("lo", c)] is not None]
    rows, low, width = {}, F.lit(None).cast("double"), F.lit(None).cast("double")
    for c in filled:
        lo, step = limits[("lo", c)], (limits[("hi", c)] - limits[("lo", c)]) / bins
        value = value_of(df, c).cast("double")
        place = F.floor((value - F.lit(lo)) / F.lit(step)) if step else F.lit(0)
        # least() would take the last bin for a missing value
        rows[c] = {"bin": F.when(value.isNotNull(), F.least(place, F.lit(bins - 1))).cast("int")}
        low = F.when(F.col("column") == c, lo).otherwise(low)
        width = F.when(F.col("column") == c, step).otherwise(width)
    counted = (
        df.select(long_rows(rows))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counted.select(
        "column",
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        "count",
    )


def boxplot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, n, q1, median, q3, whisker_low, whisker_high, outliers)`` with exact quartiles.

    A whisker ends at the last value within 1.5 interquartile ranges of the box; values beyond are outliers.
    """
    keys = [*by, "column"]
    q = F.col("q")
    boxes, small = _held(
        exact_quantiles(df, columns, [0.25, 0.5, 0.75], by).select(
            *keys, "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
        )
    )
    values = unpivot_values(df, columns, by).join(broadcast_if(boxes, small), keys)
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return values.groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def _held(boxes: DataFrame) -> tuple[DataFrame, bool]:
    """The boxes as a local table if there are few of them, which is checked; else as they are."""
    rows = small_or_none(boxes, SMALL_GROUPS)
    return (boxes, False) if rows is None else (local_rows(boxes.sparkSession, rows, boxes.schema), True)


def outliers(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The values beyond the whiskers: ``(by..., column, x)``."""
    keys = [*by, "column"]
    q = F.col("q")
    boxes, small = _held(
        exact_quantiles(df, [column], [0.25, 0.75], by).select(*keys, q[0].alias("q1"), q[1].alias("q3"))
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    values = unpivot_values(df, [column], by).join(broadcast_if(boxes, small), keys)
    return values.where((F.col("x") < F.col("q1") - reach) | (F.col("x") > F.col("q3") + reach)).select(*keys, "x")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(x, y, correlation)``: Pearson, the lower triangle, each pair over its common rows."""
    columns = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    values = {c: value_of(df, c).cast("double") for c in columns}
    parts = []
    for start in range(0, len(pairs), AGG_WIDTH):
        some = pairs[start : start + AGG_WIDTH]
        wide = df.agg(*[F.corr(values[a], values[b]).alias(f"r{i}") for i, (a, b) in enumerate(some)])
        rows = F.array(
            *[
                F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("correlation"))
                for i, (a, b) in enumerate(some)
            ]
        )
        parts.append(wide.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def counts_of(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``(value, count)``, most frequent first: all values, or the ``top`` ones."""
    ordered = counts_of(df, column).orderBy(F.col("count").desc(), "value")
    return ordered if top is None else ordered.limit(top)


def count_plot(df: DataFrame, column: str) -> DataFrame:
    return value_counts(df, column)


def top_and_others(df: DataFrame, column: str, slices: int = PIE_SLICES, kept: int = PIE_KEPT) -> DataFrame:
    """``(value, count, share)``: all values if there are at most ``slices``, else the ``kept`` largest and the rest."""
    counts = counts_of(df, column).withColumn("value", F.col("value").cast("string"))
    rows = counts.agg(F.sum("count")).scalar()
    # the first slices + 1 rows tell whether values have to be merged
    ordered = counts.orderBy(F.col("count").desc(), "value")
    many = ordered.limit(slices + 1).agg(F.count(F.lit(1)) > slices).scalar()
    first = ordered.limit(kept)
    all_few = ordered.limit(slices).where(~many)
    rest = first.where(many).agg(F.sum("count").alias("top")).where(F.col("top").isNotNull()).select(
        F.lit(PIE_REST).alias("value"), (rows - F.col("top")).alias("count")
    )
    merged = all_few.unionByName(first.where(many)).unionByName(rest)
    return merged.select("value", "count", (F.col("count") / rows).alias("share"))


def group_means(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """``(group, variable, mean)``: wide means per group turned long, so no row is copied."""
    require_columns(df, [group, *columns])
    kept = [c for c in columns if c != group]
    wide = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.avg(value_of(df, c)).alias(f"m{i}") for i, c in enumerate(kept)]
    )
    return wide.select(group, long_rows({c: {"mean": F.col(f"m{i}")} for i, c in enumerate(kept)}, "variable"))


def group_mean(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value_of(df, column)).alias("mean"))


def pca_2d(df: DataFrame, key: str, columns: Sequence[str], hue: str | None = None) -> tuple[DataFrame, list[float]]:
    """``(key, [hue,] pc1, pc2)`` of the standardized columns, and the explained share of both components.

    Rows with a missing value are left out.
    """
    columns = [c for c in columns if c in numeric_columns(df)]
    if len(columns) < 2:
        raise ValueError("a projection to two components takes two numeric columns or more")
    complete = df.dropna(subset=columns)
    fitted = fit_numeric(complete, columns)
    extra = [hue] if hue else []
    standard = complete.select(
        key, *extra, *[scaled(value_of(complete, c), p["mean"], p["sd"]).alias(f"_z{i}") for i, (c, p) in enumerate(fitted.items())]
    )
    vectors = VectorAssembler(inputCols=[f"_z{i}" for i in range(len(columns))], outputCol="_v").transform(standard)
    model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(vectors)
    points = vector_to_array("_pc")
    out = model.transform(vectors).select(key, *extra, points[0].alias("pc1"), points[1].alias("pc2"))
    return out, [float(v) for v in model.explainedVariance]


def kde(df: DataFrame, columns: str | Sequence[str], grid: int = KDE_GRID, cut: float = KDE_CUT) -> DataFrame:
    """``([column,] x, density)``: Gaussian densities on grids over the ranges widened by ``cut`` bandwidths (Scott's rule).

    One pass: each task adds up its kernels at every grid point of every column, and only these sums, as many for each
    task as there are points, are shuffled. ``column`` is there if a list of columns is given.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    values = {c: value_of(df, c).cast("double") for c in names}
    stats = one_row(
        df,
        {
            (name, c): f(v)
            for c, v in values.items()
            for name, f in (("n", F.count), ("sd", F.stddev_samp), ("lo", F.min), ("hi", F.max))
        },
    )
    grids = []
    for c in names:
        n, sd, lo, hi = (stats[name, c] for name in ("n", "sd", "lo", "hi"))
        if not n or not sd:
            raise ValueError(f"{c} has no spread to estimate a density from")
        h = sd * n**-0.2
        low, high = lo - cut * h, hi + cut * h
        points = np.array([low + (high - low) * i / (grid - 1) for i in range(grid)])
        grids.append((points, h, 1.0 / (n * h * math.sqrt(2 * math.pi))))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(grids), grid))
        for batch in batches:
            for i, (points, h, _) in enumerate(grids):
                found, counts = np.unique(batch.column(i).drop_null().to_numpy(), return_counts=True)
                step = max(1, KDE_CELLS // grid)
                for start in range(0, len(found), step):
                    z = (found[start : start + step, None] - points) / h
                    sums[i] += counts[start : start + step] @ np.exp(-0.5 * z * z)
        place = np.indices(sums.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place[0]), pa.array(place[1]), pa.array(sums.ravel())], ["c", "i", "k"])

    summed = (
        df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
        .mapInArrow(partial, "c int, i int, k double")
        .groupBy("c", "i")
        .agg(F.sum("k").alias("k"))
    )
    rows = [(i, j, c, float(x), norm) for i, (c, (points, _, norm)) in enumerate(zip(names, grids)) for j, x in enumerate(points)]
    table = local_rows(df.sparkSession, rows, "c int, i int, column string, x double, norm double")
    found = table.join(summed, ["c", "i"]).withColumn("density", F.col("k") * F.col("norm"))
    return found.select(*([] if isinstance(columns, str) else ["column"]), "x", "density")


def sorted_series(df: DataFrame, x: str, columns: Sequence[str]) -> DataFrame:
    """``(x, variable, value)`` in order of a numeric x; other x values keep the table's order."""
    ys = [c for c in columns if c != x]
    rows = {c: {"value": value_of(df, c).cast("double")} for c in ys}
    ordered = df.orderBy(x) if x in numeric_columns(df) else df
    return ordered.select(x, long_rows(rows, "variable"))


def scatter(df: DataFrame, x: str, y: str, hue: str | None = None, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """``(x, y[, hue])``; ``fraction`` below 1 is a seeded sample, for drawing."""
    points = df.select(x, y, *([hue] if hue and hue in df.columns else []))
    return points if fraction >= 1.0 else points.sample(fraction=fraction, seed=seed)


def pair_columns(df: DataFrame, columns: Sequence[str] | None = None, hue: str | None = None) -> DataFrame:
    """The columns (default: all numeric ones) and the hue, the table under a pair plot."""
    kept = list(columns or numeric_columns(df))
    return df.select(*kept, *([hue] if hue and hue in df.columns and hue not in kept else []))


# The chart types and the operator behind each.
CHARTS = {
    "histogram": histogram,
    "boxplot": boxplot,
    "scatter": scatter,
    "correlation": correlation_matrix,
    "pairplot": pair_columns,
    "line": sorted_series,
    "bar": value_counts,
    "pie": top_and_others,
    "pca": pca_2d,
    "count": count_plot,
    "distribution": kde,
}


def chart_data(df: DataFrame, chart: str, *args, **kwargs):
    """The data of a chart type by name."""
    if chart not in CHARTS:
        raise ValueError(f"no chart is named {chart}")
    return CHARTS[chart](df, *args, **kwargs)

