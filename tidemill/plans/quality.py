"""Expectation and row-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import quality
from tidemill.plans.base import (
    BEFORE_SQL,
    LINEITEM_COLUMNS,
    LINEITEM_NUMBERS,
    LINEITEM_STRINGS,
    SINCE_SQL,
    before,
    query,
    rounded,
    since,
    union_sql,
)
from tidemill.sources.stores import SuiteStore
from tidemill.sources.tables import append_validation, read_validations


def _suite_rows(source: str) -> list[str]:
    """SQL of the suite derived from a relation: one SELECT per expectation, in order."""
    rows = []

    def add(kind, column=None, low="NULL", high="NULL", mostly="NULL", columns="NULL", values="NULL"):
        name = "NULL" if column is None else f"'{column}'"
        rows.append(
            f"""SELECT CAST({len(rows)} AS INTEGER) AS position, '{kind}' AS expectation_type,
  CAST({name} AS VARCHAR) AS "column", CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value,
  CAST({mostly} AS DOUBLE) AS mostly, CAST({columns} AS VARCHAR) AS expected_columns,
  CAST({values} AS VARCHAR) AS value_set FROM {source} HAVING count(*) > 0"""
        )

    add(quality.ROW_COUNT, low="1", high="count(*) * 2")
    add(quality.COLUMN_COUNT, low=str(len(LINEITEM_COLUMNS)), high=str(len(LINEITEM_COLUMNS)))
    names = ",".join(LINEITEM_COLUMNS)
    add(quality.COLUMN_LIST, columns=f"'{names}'")
    for c in LINEITEM_COLUMNS:
        filled = f"greatest(1.0 - (1.0 - count({c}) / count(*) + 0.05), 0)"
        if c in LINEITEM_STRINGS:
            add(quality.IN_SET, c, mostly="0.95", values=f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {source}))")
            add(quality.NOT_NULL, c, mostly=filled)
        elif c in LINEITEM_NUMBERS:
            add(quality.VALUES_BETWEEN, c, f"min({c}) - 3 * stddev_samp({c})", f"max({c}) + 3 * stddev_samp({c})", "0.99")
            add(quality.MEAN_BETWEEN, c, f"avg({c}) - stddev_samp({c})", f"avg({c}) + stddev_samp({c})")
            add(quality.NOT_NULL, c, mostly=filled)
    return rows


def _suite_sql(source: str) -> str:
    return f"""SELECT position, expectation_type, "column", round(min_value, 5) AS min_value,
  round(max_value, 5) AS max_value, round(mostly, 5) AS mostly, expected_columns, value_set
FROM ({union_sql(_suite_rows(source))})"""


def _flat(table):
    lists = ["expected_columns", "value_set"]
    return rounded(table.withColumns({c: F.array_join(c, ",") for c in lists}), 5)


@query("q1_generate_suite", _suite_sql("lineitem"))
def generate_suite(t):
    return _flat(quality.generate_suite(t.lineitem, "lineitem").table(t.spark))


def _checks_sql(kinds: set[str] | None = None) -> str:
    """Expectations of the shipments before the split day, checked on those since."""
    suite = f"WITH r AS ({BEFORE_SQL}), c AS ({SINCE_SQL}), suite AS ({union_sql(_suite_rows('r'))})"
    parts = []
    position = 0

    def add(kind, observed, success, column="NULL"):
        nonlocal position
        if kinds is None or kind in kinds:
            name = column if column == "NULL" else f"'{column}'"
            parts.append(
                f"""SELECT s.position, s.expectation_type, CAST({name} AS VARCHAR) AS "column", {success} AS success,
  round(CAST(o.v AS DOUBLE), 6) AS observed, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT * FROM suite WHERE position = {position}) s, (SELECT {observed} AS v FROM c) o"""
            )
        position += 1

    between = "o.v >= s.min_value AND o.v <= s.max_value"
    add(quality.ROW_COUNT, "count(*)", between)
    add(quality.COLUMN_COUNT, str(len(LINEITEM_COLUMNS)) + " + 0 * count(*)", "true")
    add(quality.COLUMN_LIST, str(len(LINEITEM_COLUMNS)) + " + 0 * count(*)", "true")
    for c in LINEITEM_COLUMNS:
        filled = f"avg(CASE WHEN {c} IS NULL THEN 0.0 ELSE 1.0 END)"
        if c in LINEITEM_STRINGS:
            add(quality.IN_SET, f"avg(CASE WHEN {c} IN (SELECT {c} FROM r) THEN 1.0 ELSE 0.0 END)", "o.v >= s.mostly", c)
            add(quality.NOT_NULL, filled, "o.v >= s.mostly", c)
        elif c in LINEITEM_NUMBERS:
            inside = (
                f"avg(CASE WHEN {c} >= (SELECT min({c}) - 3 * stddev_samp({c}) FROM r) "
                f"AND {c} <= (SELECT max({c}) + 3 * stddev_samp({c}) FROM r) THEN 1.0 ELSE 0.0 END)"
            )
            add(quality.VALUES_BETWEEN, inside, "o.v >= s.mostly", c)
            add(quality.MEAN_BETWEEN, f"avg({c})", between, c)
            add(quality.NOT_NULL, filled, "o.v >= s.mostly", c)
    return suite + "\n" + union_sql(parts)


def _checked(t, kinds: set[str] | None = None):
    suite = quality.generate_suite(before(t.lineitem), "lineitem")
    if kinds is not None:
        known = suite.expectations
        unknown = {"expectation_type": "not_checked", "kwargs": {}}
        suite.expectations = [e if e["expectation_type"] in kinds else unknown for e in known]
    return rounded(quality.validate(since(t.lineitem), suite))


def _register_kind(name: str, kind: str) -> None:
    query(name, _checks_sql({kind}))(lambda t: _checked(t, {kind}))


_register_kind("q2_row_count_between", quality.ROW_COUNT)
_register_kind("q3_column_count_equal", quality.COLUMN_COUNT)
_register_kind("q4_columns_match_ordered", quality.COLUMN_LIST)
_register_kind("q5_values_in_set", quality.IN_SET)
_register_kind("q6_not_null_mostly", quality.NOT_NULL)
_register_kind("q7_values_between_mostly", quality.VALUES_BETWEEN)
_register_kind("q8_mean_between", quality.MEAN_BETWEEN)


@query("q9_validate", _checks_sql())
def validate(t):
    return _checked(t)


@query(
    "q9_validation_summary",
    f"""SELECT bool_and(success) AS passed, count(*) AS total_expectations,
  count(*) FILTER (WHERE success) AS passing_expectations, count(*) FILTER (WHERE NOT success) AS failing_expectations,
  round(100.0 * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent FROM ({_checks_sql()})""",
)
def validation_summary(t):
    return rounded(quality.summarize(_checked(t)))


@query(
    "q5_values_in_large_set",
    f"""WITH r AS ({BEFORE_SQL}), c AS ({SINCE_SQL})
SELECT count(*) AS n, round(avg(CASE WHEN p IN (SELECT 'part-' || l_partkey FROM r) THEN 1.0 ELSE 0.0 END), 6) AS observed
FROM (SELECT 'part-' || l_partkey AS p FROM c)""",
)
def values_in_large_set(t):
    """A value set too large for the suite itself is a table, compared by value counts."""
    part = F.concat(F.lit("part-"), F.col("l_partkey")).alias("p")
    ours, theirs = before(t.lineitem).select(part), since(t.lineitem).select(part)
    check = {"expectation_type": quality.IN_SET, "kwargs": {"column": "p", "value_table": True, "mostly": 0.95}}
    suite = quality.Suite("parts", "v1", [check], large_sets={"p": ours.select(F.col("p").alias("value")).distinct()})
    rows = theirs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rounded(quality.validate(theirs, suite).select(rows.alias("n"), "observed"))


@query(
    "q10_suite_store",
    f"SELECT *, 'v2' AS version, CAST(3 AS INTEGER) AS next_version FROM ({_suite_sql('lineitem')})",
)
def suite_store(t):
    store = SuiteStore(t.spark, scratch_path(t.spark, "suites"))
    store.generate(before(t.lineitem), "lineitem")
    store.generate(t.lineitem, "lineitem", overwrite=True)
    suite = store.load("lineitem")
    return _flat(suite.table(t.spark)).select(
        "*", F.lit(suite.version).alias("version"), F.lit(store.next_version("lineitem")).alias("next_version")
    )


@query("s7_validation_result_sink", f"SELECT *, 'lineitem' AS dataset FROM ({_checks_sql()})")
def validation_result_sink(t):
    path = scratch_path(t.spark, "validations")
    append_validation(_checked(t), path, "lineitem", "run-1")
    return read_validations(t.spark, path).drop("run_id", "validated_at")


RANGES = {"l_quantity": (1.0, 45.0), "l_discount": (0.0, 0.09), "l_tax": (0.0, 0.07)}


def _errors_sql() -> str:
    checks = []
    for c, (low, high) in RANGES.items():
        checks.append(
            f"CASE WHEN {c} IS NULL THEN '{c}: missing value' WHEN {c} < {low} THEN '{c}: below {low}' "
            f"WHEN {c} > {high} THEN '{c}: above {high}' END"
        )
    return f"concat_ws('; ', {', '.join(checks)})"


_ROWS_SQL = f"""SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, {_errors_sql()} AS errors
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, nullif(l_quantity, 7) AS l_quantity, l_discount, l_tax
  FROM lineitem)"""


def _requests(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"),
        "l_discount",
        "l_tax",
    )


@query(
    "q11_row_schema_check",
    f"SELECT l_orderkey, l_linenumber, errors, errors = '' AS is_valid FROM ({_ROWS_SQL})",
)
def row_schema_check(t):
    checked = quality.row_errors(_requests(t), RANGES)
    return checked.select("l_orderkey", "l_linenumber", F.array_join("errors", "; ").alias("errors"), "is_valid")


@query(
    "q11_schema_verdict",
    f"SELECT bool_and(errors = '') AS is_valid, count(*) FILTER (WHERE errors <> '') AS invalid_rows FROM ({_ROWS_SQL})",
)
def schema_verdict(t):
    return quality.schema_verdict(quality.row_errors(_requests(t), RANGES))


@query(
    "q12_quarantine_split",
    f"""WITH e AS ({_ROWS_SQL})
SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE errors <> '') AS validation_failures,
  count(*) FILTER (WHERE errors = '') AS accepted FROM e GROUP BY ALL""",
)
def quarantine_split(t):
    valid, rejected = quality.quarantine_split(_requests(t), RANGES)
    by = ["l_returnflag", "l_linestatus"]
    failures = quality.validation_failures(rejected, by)
    return failures.join(valid.groupBy(*by).agg(F.count(F.lit(1)).alias("accepted")), by)


@query(
    "q13_column_alias_map",
    """SELECT l_orderkey, l_quantity / 10 + 3 AS sepal_length, l_discount * 20 + 2 AS sepal_width,
  l_quantity / 8 AS petal_length, l_tax * 30 AS petal_width,
  l_quantity / 10 + 3 BETWEEN 4 AND 8 AND l_discount * 20 + 2 BETWEEN 2 AND 4.5 AND l_quantity / 8 BETWEEN 1 AND 7
  AND l_tax * 30 BETWEEN 0.1 AND 2.5 AS is_valid FROM lineitem""",
)
def column_alias_map(t):
    flowers = t.lineitem.select(
        "l_orderkey",
        (F.col("l_quantity") / 10 + 3).alias("sepal length (cm)"),
        (F.col("l_discount") * 20 + 2).alias("sepal width (cm)"),
        (F.col("l_quantity") / 8).alias("petal length (cm)"),
        (F.col("l_tax") * 30).alias("petal width (cm)"),
    )
    return quality.row_errors(quality.rename_aliases(flowers), quality.schema_ranges("iris")).drop("errors")
