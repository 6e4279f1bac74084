"""Exact order statistics without sorting a whole column in one task.

Every helper first brackets the wanted ranks with a bounded sketch or a hash prefix, counts the brackets with
map-side aggregation, and only then sorts the rows of the brackets that hold a wanted rank. The sketch decides
how much is sorted, never what the answer is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.columns import (
    broadcast_if,
    local_rows,
    md5_key,
    number,
    one_row,
    quoted,
    small_or_none,
    value_of,
    value_sql,
)

SKETCH_ACCURACY = 10_000
# Sketch rows held on the driver at most; each is a group key and a few doubles.
SMALL_GROUPS = 10_000


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> dict[str, tuple[int, list[float]]]:
    """Count and linear-interpolation quantiles of whole columns, exact; columns without values are left out.

    Three passes over the needed columns: sketch the neighbourhood of every wanted rank, count the rows below and
    at each sketch edge, and look up the ranks that fall between two edges among the few values there. A rank
    among the copies of an edge is answered by the counts, so columns of few values need no third pass.
    """
    base = df.select(*[value_of(df, c).cast("double").alias(f"x{j}") for j, c in enumerate(columns)])
    cuts = _edge_probs(probs, accuracy)
    sketch = one_row(
        base,
        {("n", j): F.expr(f"count(x{j})") for j in range(len(columns))}
        | {("e", j): F.percentile_approx(f"x{j}", cuts, accuracy) for j in range(len(columns))},
    )
    edges = {j: sorted(set(sketch[("e", j)])) for j in range(len(columns)) if sketch[("n", j)]}
    counts = one_row(
        base,
        {("lt", j, e): F.expr(f"count_if(x{j} < {number(e)})") for j in edges for e in edges[j]}
        | {("le", j, e): F.expr(f"count_if(x{j} <= {number(e)})") for j in edges for e in edges[j]},
    )

    value: dict[tuple[int, int], float] = {}
    gaps: dict[tuple[int, int], dict[int, int]] = {}
    for j, ends in edges.items():
        below, upto = ([counts[(kind, j, e)] for e in ends] for kind in ("lt", "le"))
        found, missing = _place_ranks(ends, below, upto, sketch[("n", j)], probs)
        value |= {(j, k): x for k, x in found.items()}
        gaps |= {(j, bucket): ranks for bucket, ranks in missing.items()}
    if gaps:
        value |= _values_in_gaps(base, edges, gaps)
    return {
        columns[j]: (sketch[("n", j)], _interpolate(sketch[("n", j)], probs, {k: x for (i, k), x in value.items() if i == j}))
        for j in edges
    }


def _place_ranks(
    edges: Sequence[float], below: Sequence[int], upto: Sequence[int], n: int, probs: Sequence[float]
) -> tuple[dict[int, float], dict[int, dict[int, int]]]:
    """Values of the ranks that fall on an edge, and for the others ``{bucket: {rank: rank within the bucket}}``.

    ``below`` and ``upto`` count the rows under, and at or under, each edge; bucket b lies between the edges b - 1
    and b.
    """
    value: dict[int, float] = {}
    gaps: dict[int, dict[int, int]] = {}
    for k in {k for p in probs for k in _around(p, n)}:
        bucket = sum(c <= k for c in upto)
        if bucket < len(edges) and below[bucket] <= k:
            value[k] = edges[bucket]
        else:
            gaps.setdefault(bucket, {})[k] = k - (upto[bucket - 1] if bucket else 0)
    return value, gaps


def _interpolate(n: int, probs: Sequence[float], value: dict[int, float]) -> list[float]:
    out = []
    for p in probs:
        low, high = _around(p, n)
        out.append(value[low] + (value[high] - value[low]) * (p * (n - 1) - low))
    return out


def _edge_probs(probs: Sequence[float], accuracy: int) -> list[float]:
    margin = 2.0 / accuracy
    return sorted({min(max(p + s * margin, 0.0), 1.0) for p in probs for s in (-1, 1)})


def _around(p: float, n: int) -> tuple[int, int]:
    low = math.floor(p * (n - 1))
    return low, min(low + 1, n - 1)


def _values_in_gaps(
    base: DataFrame, edges: dict[int, list[float]], gaps: dict[tuple[int, int], dict[int, int]]
) -> dict[tuple[int, int], float]:
    """Values at ranks (counted within the gap) of the open intervals between edges."""
    hits, entries = [], []
    for j, bucket in gaps:
        hit = f"(x{j} IS NOT NULL"
        if bucket > 0:
            hit += f" AND x{j} > {number(edges[j][bucket - 1])}"
        if bucket < len(edges[j]):
            hit += f" AND x{j} < {number(edges[j][bucket])}"
        hits.append(hit + ")")
        entries.append(f"if({hits[-1]}, named_struct('j', {j}, 'bucket', {bucket}, 'x', x{j}), null)")
    in_order = W.partitionBy("j", "bucket").orderBy("x")
    ranked = (
        base.where(" OR ".join(hits))
        .select(F.expr(f"inline(array_compact(array({', '.join(entries)})))"))
        .groupBy("j", "bucket", "x")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("upto", F.sum("c").over(in_order))
    )
    asked = [
        f"(j = {j} AND bucket = {bucket} AND upto > {r} AND upto - c <= {r})"
        for (j, bucket), ranks in gaps.items()
        for r in ranks.values()
    ]
    out = {}
    for row in ranked.where(" OR ".join(asked)).collect():
        for k, r in gaps[(row["j"], row["bucket"])].items():
            if row["upto"] - row["c"] <= r < row["upto"]:
                out[(row["j"], k)] = row["x"]
    return out


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Linear-interpolation quantiles per group and column: ``(by..., column, n, q array<double>)``.

    Works as :func:`column_quantiles`, with one sketch per group. Up to SMALL_GROUPS groups their sketches and
    counts are held by the driver; more of them stay in tables throughout. Groups with a null key are left out,
    as are columns without any value.
    """
    by, columns = list(by), list(columns)
    spark = df.sparkSession
    if not by:
        found = column_quantiles(df, columns, probs, accuracy)
        return local_rows(spark, [(c, n, q) for c, (n, q) in found.items()], "column string, n bigint, q array<double>")
    base = df.dropna(subset=by).select(
        *by, *[value_of(df, c).cast("double").alias(f"x{j}") for j, c in enumerate(columns)]
    )
    cuts = _edge_probs(probs, accuracy)
    spots = [(j, i) for j in range(len(columns)) for i in range(len(cuts))]
    sketch = base.groupBy(*by).agg(
        *[F.count(f"x{j}").alias(f"n{j}") for j in range(len(columns))],
        *[F.percentile_approx(f"x{j}", cuts, accuracy).alias(f"e{j}") for j in range(len(columns))],
    )
    held = small_or_none(sketch, SMALL_GROUPS)
    if held is not None:
        return _held_quantiles(base, by, columns, probs, len(cuts), sketch, held)
    edged = base.join(sketch.drop(*[f"n{j}" for j in range(len(columns))]), by)

    # rows below, and at or below, every edge: one row per group
    counts = edged.groupBy(*by).agg(
        *[F.expr(f"count_if(x{j} < get(e{j}, {i})) AS lt{j}_{i}") for j, i in spots],
        *[F.expr(f"count_if(x{j} <= get(e{j}, {i})) AS le{j}_{i}") for j, i in spots],
    )

    def listed(kind: str, j: int) -> Column:
        return F.expr(f"array({', '.join(f'{kind}{j}_{i}' for i in range(len(cuts)))}) AS {kind}")

    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{j}").alias("n"),
            F.col(f"e{j}").alias("edges"),
            listed("lt", j),
            listed("le", j),
        )
        for j, c in enumerate(columns)
    ]
    info = sketch.join(counts, by).select(*by, F.inline(F.array(*per_column)))

    # Bucket b holds what lies above edge b - 1 and not above edge b.
    keys = [*by, "column"]
    position = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    wanted = []
    for i, pos in enumerate(position):
        low = F.floor(pos)
        wanted += [
            F.struct(F.lit(i).alias("i"), F.lit(0).alias("side"), low.alias("k")),
            F.struct(F.lit(i).alias("i"), F.lit(1).alias("side"), F.least(low + 1, F.col("n") - 1).alias("k")),
        ]
    previous = F.col("bucket") - 1
    targets = (
        info.where(F.col("n") > 0)
        .select(*keys, "n", "edges", "lt", "le", F.inline(F.array(*wanted)))
        .withColumn("bucket", F.size(F.filter("le", lambda c: c <= F.col("k"))))
        .withColumns(
            {
                "rank": F.col("k") - F.when(previous >= 0, F.get("le", previous)).otherwise(0),
                "known": F.when(F.get("lt", F.col("bucket")) <= F.col("k"), F.get("edges", F.col("bucket"))),
                "low": F.when(previous >= 0, F.get("edges", previous)),
                "high": F.get("edges", F.col("bucket")),
            }
        )
        .select(*keys, "n", "i", "side", "rank", "bucket", "low", "high", "known")
    )
    open_targets = targets.where(F.col("known").isNull())
    gap = F.struct("bucket", "low", "high")
    gaps = open_targets.groupBy(*by).agg(
        *[F.collect_set(F.when(F.col("column") == c, gap)).alias(f"w{j}") for j, c in enumerate(columns)]
    )
    entries = []
    for j, c in enumerate(columns):
        x = F.col(f"x{j}")
        holding = F.filter(
            f"w{j}", lambda g: (g["low"].isNull() | (x > g["low"])) & (g["high"].isNull() | (x < g["high"]))
        )
        bucket = F.get(holding, F.lit(0))["bucket"]
        entry = F.struct(F.lit(c).alias("column"), bucket.alias("bucket"), x.alias("x"))
        entries.append(F.when(x.isNotNull() & bucket.isNotNull(), entry))
    in_value_order = W.partitionBy(*keys, "bucket").orderBy("x")
    candidates = (
        base.join(gaps, by)
        .select(*by, F.inline(F.array_compact(F.array(*entries))))
        .groupBy(*keys, "bucket", "x")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("upto", F.sum("c").over(in_value_order))
    )
    picked = candidates.join(open_targets, [*keys, "bucket"]).where(
        (F.col("rank") >= F.col("upto") - F.col("c")) & (F.col("rank") < F.col("upto"))
    )
    answered = targets.where(F.col("known").isNotNull()).withColumnRenamed("known", "x")
    found = [*keys, "n", "i", "side", "x"]

    ends = (
        answered.select(found)
        .unionByName(picked.select(found))
        .groupBy(*keys, "n")
        .agg(
            *[
                F.expr(f"max(if(i = {i} AND side = {side}, x, null)) AS e{i}_{side}")
                for i in range(len(probs))
                for side in (0, 1)
            ]
        )
    )
    quantiles = [
        F.col(f"e{i}_0") + (F.col(f"e{i}_1") - F.col(f"e{i}_0")) * (pos - F.floor(pos))
        for i, pos in enumerate(position)
    ]
    return ends.select(*keys, "n", F.array(*quantiles).alias("q"))


def _held_quantiles(
    base: DataFrame,
    by: list[str],
    columns: list[str],
    probs: Sequence[float],
    cuts: int,
    sketch: DataFrame,
    held: list[Row],
) -> DataFrame:
    """Quantiles of a bounded number of groups: two or three plain passes, the ranks placed by the driver."""
    spark, width = base.sparkSession, len(by)
    spots = [(j, i) for j in range(len(columns)) for i in range(cuts)]
    local = local_rows(spark, held, sketch.schema).drop(*[f"n{j}" for j in range(len(columns))])
    counted = (
        base.join(F.broadcast(local), by)
        .groupBy(*by)
        .agg(
            *[F.expr(f"count_if(x{j} < get(e{j}, {i}))") for j, i in spots],
            *[F.expr(f"count_if(x{j} <= get(e{j}, {i}))") for j, i in spots],
        )
        .collect()
    )
    counts = {tuple(r[:width]): r[width:] for r in counted}
    value: dict[tuple, dict[int, float]] = {}
    gap_rows, asked_rows, sizes = [], [], {}
    for row in held:
        group = tuple(row[:width])
        for j, c in enumerate(columns):
            n, edges = row[f"n{j}"], row[f"e{j}"]
            if not n:
                continue
            sizes[(group, j)] = n
            below = counts[group][j * cuts : (j + 1) * cuts]
            upto = counts[group][len(spots) + j * cuts : len(spots) + (j + 1) * cuts]
            value[(group, j)], gaps = _place_ranks(edges, below, upto, n, probs)
            for bucket, ranks in gaps.items():
                low = edges[bucket - 1] if bucket else None
                high = edges[bucket] if bucket < len(edges) else None
                gap_rows.append((*group, j, bucket, low, high))
                asked_rows += [(*group, j, bucket, k, r) for k, r in ranks.items()]
    keys = T.StructType([base.schema[c] for c in by])
    if gap_rows:
        gap = T.StructType.fromDDL("j int, bucket int, low double, high double")
        asked = T.StructType.fromDDL("j int, bucket int, k bigint, rank bigint")
        x = "CASE j " + " ".join(f"WHEN {j} THEN x{j}" for j in range(len(columns))) + " END"
        in_value_order = W.partitionBy(*by, "j", "bucket").orderBy("x")
        answers = (
            base.join(F.broadcast(local_rows(spark, gap_rows, T.StructType(keys.fields + gap.fields))), by)
            .selectExpr(*map(quoted, by), "j", "bucket", "low", "high", f"{x} AS x")
            .where("x IS NOT NULL AND (low IS NULL OR x > low) AND (high IS NULL OR x < high)")
            .groupBy(*by, "j", "bucket", "x")
            .agg(F.count(F.lit(1)).alias("c"))
            .withColumn("upto", F.sum("c").over(in_value_order))
            .join(F.broadcast(local_rows(spark, asked_rows, T.StructType(keys.fields + asked.fields))), [*by, "j", "bucket"])
            .where("rank < upto AND rank >= upto - c")
            .select(*by, "j", "k", "x")
        )
        for r in answers.collect():
            value[(tuple(r[:width]), r["j"])][r["k"]] = r["x"]
    rows = [(*g, columns[j], n, _interpolate(n, probs, value[(g, j)])) for (g, j), n in sizes.items()]
    found = T.StructType.fromDDL("column string, n bigint, q array<double>")
    return local_rows(spark, rows, T.StructType(keys.fields + found.fields))


def ks_statistic(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per column: ``(column, n_reference, n_current, statistic)``.

    Equal values are counted first, so that a hot value is one row. The counts are then range-partitioned by column
    and value, and each partition walks its own piece of both distributions. How far the two have drifted apart
    before a piece only shifts all its gaps, so the extremes of the piece and its totals are all that leaves the
    task. Columns without values on a side are left out.
    """
    sizes = {}
    for side, df in (("n", reference), ("m", current)):
        found = one_row(df, {c: F.expr(f"count({value_sql(df, c)})") for c in columns})
        sizes |= {(side, c): n for c, n in found.items()}
    kept = [c for c in columns if sizes[("n", c)] and sizes[("m", c)]]
    known = {c: (sizes[("n", c)], sizes[("m", c)]) for c in kept}
    if not kept:
        return local_rows(
            reference.sparkSession, [], "column string, n_reference bigint, n_current bigint, statistic double"
        )

    def tagged(df: DataFrame, r: int) -> DataFrame:
        rows = [f"named_struct('column', {j}, 'x', CAST({value_sql(df, c)} AS DOUBLE))" for j, c in enumerate(kept)]
        return df.selectExpr(f"inline(array({', '.join(rows)}))", f"{r} AS r").where("x IS NOT NULL")

    def extremes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[int, list] = {}
        for batch in batches:
            for j, part in batch.groupby("column", sort=False):
                n, m = known[kept[j]]
                piece = pieces.setdefault(j, [part["x"].iloc[0], 0, 0, np.inf, -np.inf])
                r, c = piece[1] + part["r"].to_numpy().cumsum(), piece[2] + part["c"].to_numpy().cumsum()
                apart = r / n - c / m
                piece[1:] = [int(r[-1]), int(c[-1]), min(piece[3], apart.min()), max(piece[4], apart.max())]
        yield pd.DataFrame(
            [(kept[j], *piece) for j, piece in pieces.items()], columns=["column", "first", "r", "c", "low", "high"]
        )

    counted = (
        tagged(reference, 1)
        .unionByName(tagged(current, 0))
        .groupBy("column", "x")
        .agg(F.sum("r").alias("r"), F.sum(1 - F.col("r")).alias("c"))
    )
    pieces = (
        counted.repartitionByRange("column", "x")
        .sortWithinPartitions("column", "x")
        .mapInPandas(extremes, "column string, first double, r bigint, c bigint, low double, high double")
    )
    # one row per column and partition
    before = W.partitionBy("column").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    totals = local_rows(
        reference.sparkSession,
        [(c, *known[c]) for c in kept],
        "column string, n_reference bigint, n_current bigint",
    )
    start = F.coalesce(F.sum("r").over(before), F.lit(0)) / F.col("n_reference") - F.coalesce(
        F.sum("c").over(before), F.lit(0)
    ) / F.col("n_current")
    return (
        pieces.join(F.broadcast(totals), "column")
        .withColumn("start", start)
        .groupBy("column", "n_reference", "n_current")
        .agg(F.max(F.expr("greatest(abs(start + low), abs(start + high))")).alias("statistic"))
    )


def hash_order(key: Column, seed: int) -> Column:
    return md5_key(F.lit(seed), key)


def smallest_by_hash(df: DataFrame, key: str, seed: int, quota: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flag exactly ``quota`` rows per group, in hash order of a key: adds ``selected boolean``.

    Rows that share a key are ordered by a hash of the whole row, so only equal rows stay together.

    ``quota`` holds ``(by..., quota)``, one row per group. Hashes are uniform, so their top 16 bits split every
    group evenly; counts per prefix find the prefix that holds the last wanted row and only that one is sorted.
    """
    by = list(by)
    spark = df.sparkSession
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    hashed = df.withColumn("_h", hash_order(F.col(key), seed)).withColumns(
        {"_p": F.shiftright("_h", 44), "_r": F.xxhash64(F.lit(seed), *plain)}
    )
    in_order = W.partitionBy(*by).orderBy("_p")
    prefixes = hashed.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("m"))
    upto = prefixes.withColumn("upto", F.sum("m").over(in_order))
    if by:
        upto = upto.join(quota, by)
    else:
        upto = upto.withColumn("quota", F.lit(quota.first()["quota"]))
    border = upto.where((F.col("quota") <= F.col("upto")) & (F.col("quota") > F.col("upto") - F.col("m"))).select(
        *by, "_p", (F.col("quota") - (F.col("upto") - F.col("m"))).alias("_left")
    )
    # one row for each group: with few groups only the rows at a border move
    edges = small_or_none(border, SMALL_GROUPS)
    if edges is not None:
        border = local_rows(spark, edges, border.schema)
    ranked = W.partitionBy(*by).orderBy("_h", key, "_r")
    last = (
        hashed.select(*dict.fromkeys([*by, key]), "_h", "_p", "_r")
        .join(broadcast_if(border, edges is not None), by + ["_p"])
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == F.col("_left"))
        .select(*by, F.col("_h").alias("_last_h"), F.col(key).alias("_last_key"), F.col("_r").alias("_last_r"))
    )
    rows = small_or_none(last, SMALL_GROUPS)
    if not by:
        # one row, or none for a quota of 0
        end = rows[0] if rows else (None, None, None)
        joined = hashed.withColumns({"_last_h": F.lit(end[0]), "_last_key": F.lit(end[1]), "_last_r": F.lit(end[2])})
    else:
        if rows is not None:
            last = local_rows(spark, rows, last.schema)
        joined = hashed.join(broadcast_if(last, rows is not None), by, "left")
    tied = (F.col(key) < F.col("_last_key")) | ((F.col(key) == F.col("_last_key")) & (F.col("_r") <= F.col("_last_r")))
    within = (F.col("_h") < F.col("_last_h")) | ((F.col("_h") == F.col("_last_h")) & tied)
    return joined.select(*df.columns, F.coalesce(within, F.lit(False)).alias("selected"))
