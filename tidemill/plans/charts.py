"""Chart data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import charts
from tidemill.plans.base import LINEITEM_NUMBERS, LINEITEM_STRINGS, query, rounded, union_sql

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _bins_sql(x: str) -> str:
    return f"""SELECT '{x}' AS "column", CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 4) AS low, round(lo + (bin + 1) * w, 4) AS high, n AS count
FROM (SELECT least(floor(({x} - lo) / w), 29) AS bin, lo, w, count(*) AS n
  FROM lineitem, (SELECT min({x}) AS lo, (max({x}) - min({x})) / 30 AS w FROM lineitem) GROUP BY ALL)"""


@query("v1_histogram", union_sql([_bins_sql(x) for x in COLUMNS]))
def histogram(t):
    return rounded(charts.histogram(t.lineitem, COLUMNS), 4)


FIVE = [*COLUMNS, "l_partkey"]


@query("v1_histogram_five_columns", union_sql([_bins_sql(x) for x in FIVE]))
def histogram_five_columns(t):
    return rounded(charts.histogram(t.lineitem, FIVE), 4)


def _box_sql(x: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = f"USING ({by})" if by else "ON true"
    return f"""SELECT {keys}'{x}' AS "column", n, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
  round(min({x}) FILTER (WHERE {x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max({x}) FILTER (WHERE {x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT {x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM t JOIN (SELECT {keys}count({x}) AS n, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS q2,
  quantile_cont({x}, 0.75) AS q3 FROM t {group}) {on} GROUP BY ALL"""


_BOXED = ["value", "k"]
_BOX_SOURCE_SQL = """WITH t AS (SELECT event_type, value * value / 100 AS value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""


def _boxed(t):
    return t.events.select(
        "event_type",
        (F.col("value") * F.col("value") / 100).alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


@query("v2_boxplot", f"{_BOX_SOURCE_SQL} {union_sql([_box_sql(x) for x in _BOXED])}")
def boxplot(t):
    return rounded(charts.boxplot(_boxed(t), _BOXED))


@query("v2_boxplot_by_group", f"{_BOX_SOURCE_SQL} {union_sql([_box_sql(x, 'event_type') for x in _BOXED])}")
def boxplot_by_group(t):
    return rounded(charts.boxplot(_boxed(t), _BOXED, ["event_type"]))


@query(
    "v2_outliers",
    f"""{_BOX_SOURCE_SQL} SELECT 'value' AS "column", round(value, 6) AS x FROM t, (SELECT quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM t) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def outliers(t):
    return rounded(charts.outliers(_boxed(t), "value"))


@query(
    "v3_correlation_matrix",
    union_sql(
        [
            f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM lineitem"
            for i, a in enumerate(COLUMNS)
            for b in COLUMNS[:i]
        ]
    ),
)
def correlation_matrix(t):
    return rounded(charts.correlation_matrix(t.lineitem, COLUMNS))


@query(
    "v4_value_counts",
    "SELECT c_mktsegment AS value, count(*) AS count FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def value_counts(t):
    return charts.value_counts(t.customer, "c_mktsegment", top=10)


@query(
    "v4_value_counts_too_many",
    "SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY 1",
)
def value_counts_too_many(t):
    """Far more values than a chart has room for: all of them."""
    return charts.value_counts(t.lineitem, "l_partkey")


@query(
    "v4_count_plot",
    "SELECT p_brand AS value, count(*) AS count FROM part GROUP BY 1",
)
def count_plot(t):
    return charts.count_plot(t.part, "p_brand")


def _pie_sql(table: str, column: str) -> str:
    return f"""WITH c AS (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rn, count(*) OVER () AS many, sum(n) OVER () AS total FROM c)
SELECT CASE WHEN many > 8 AND rn > 7 THEN 'Others' ELSE value END AS value, CAST(sum(n) AS BIGINT) AS count,
  round(sum(n) / max(total), 6) AS share FROM r GROUP BY 1"""


@query("v5_top_n_others", _pie_sql("part", "p_brand"))
def top_n_others(t):
    return rounded(charts.top_and_others(t.part, "p_brand"))


@query("v5_all_slices", _pie_sql("customer", "c_mktsegment"))
def all_slices(t):
    return rounded(charts.top_and_others(t.customer, "c_mktsegment"))


@query("v6_group_mean", "SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean FROM lineitem GROUP BY 1")
def group_mean(t):
    return rounded(charts.group_mean(t.lineitem, "l_returnflag", "l_extendedprice"))


@query(
    "v7_melt_group_mean",
    union_sql([f"SELECT l_returnflag, '{c}' AS variable, round(avg({c}), 6) AS mean FROM lineitem GROUP BY 1" for c in COLUMNS]),
)
def melt_group_mean(t):
    return rounded(charts.group_means(t.lineitem, "l_returnflag", COLUMNS))


@query(
    "v8_pca_2d",
    """WITH s AS (SELECT corr(l_quantity, l_extendedprice) AS r, avg(l_quantity) AS ma, stddev_pop(l_quantity) AS sa,
  avg(l_extendedprice) AS mb, stddev_pop(l_extendedprice) AS sb FROM lineitem)
SELECT l_orderkey, l_returnflag, round(abs((l_quantity - ma) / sa + sign(r) * (l_extendedprice - mb) / sb) / sqrt(2), 4) AS pc1,
  round(abs((l_quantity - ma) / sa - sign(r) * (l_extendedprice - mb) / sb) / sqrt(2), 4) AS pc2,
  round((1 + abs(r)) / 2, 6) AS share1, round((1 - abs(r)) / 2, 6) AS share2 FROM lineitem, s""",
)
def pca_2d(t):
    """Two columns: the components lie on the diagonals. Their signs are arbitrary."""
    points, shares = charts.pca_2d(t.lineitem, "l_orderkey", ["l_quantity", "l_extendedprice"], "l_returnflag")
    found = points.withColumns({c: F.round(F.abs(c), 4) for c in ("pc1", "pc2")})
    return rounded(found.withColumns({"share1": F.lit(shares[0]), "share2": F.lit(shares[1])}))


@query("v8_pca_2d_four_columns")
def pca_2d_four_columns(t):
    """Four columns onto two components. Their signs are arbitrary."""
    points, shares = charts.pca_2d(t.lineitem, "l_orderkey", COLUMNS, "l_returnflag")
    found = points.withColumns({c: F.round(F.abs(c), 4) for c in ("pc1", "pc2")})
    return rounded(found.withColumns({"share1": F.lit(shares[0]), "share2": F.lit(shares[1])}))


def _density_sql(x: str) -> str:
    return f"""SELECT '{x}' AS "column", round(x, 4) AS x, round(avg(exp(-0.5 * (({x} - x) / h) * (({x} - x) / h))) / max(h * sqrt(2 * pi())) * 1e6, 4) AS density
FROM (SELECT (lo - 3 * h) + ((hi + 3 * h) - (lo - 3 * h)) * i / 199 AS x, h FROM (
  SELECT stddev_samp({x}) * pow(count(*), -0.2) AS h, min({x}) AS lo, max({x}) AS hi FROM lineitem), range(200) r(i)), lineitem GROUP BY x"""


@query("v9_kde", f"SELECT x, density FROM ({_density_sql('l_extendedprice')})")
def kde(t):
    found = charts.kde(t.lineitem, "l_extendedprice")
    return rounded(found.withColumn("density", F.col("density") * 1e6), 4)


_DENSE = ["l_extendedprice", "l_quantity"]


@query("v9_kde_columns", union_sql([_density_sql(x) for x in _DENSE]))
def kde_columns(t):
    found = charts.kde(t.lineitem, _DENSE)
    return rounded(found.withColumn("density", F.col("density") * 1e6), 4)


@query(
    "v10_sorted_series",
    """SELECT o_orderkey, 'o_totalprice' AS variable, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders""",
)
def sorted_series(t):
    return charts.sorted_series(t.orders, "o_orderkey", ["o_orderkey", "o_totalprice", "o_custkey"])


@query("v11_scatter", "SELECT l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def scatter(t):
    return charts.scatter(t.lineitem, "l_quantity", "l_extendedprice", "l_returnflag")


_PAIRED = [*LINEITEM_NUMBERS[:5], "l_tax"]


@query("v11_pair_columns", f"SELECT {', '.join(_PAIRED)}, l_returnflag FROM lineitem")
def pair_columns(t):
    return charts.pair_columns(t.lineitem, _PAIRED, LINEITEM_STRINGS[0])


@query("v11_pair_all_columns", f"SELECT {', '.join(LINEITEM_NUMBERS)}, l_returnflag FROM lineitem")
def pair_all_columns(t):
    return charts.pair_columns(t.lineitem, None, LINEITEM_STRINGS[0])
