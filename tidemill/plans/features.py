"""Feature set, imputation and encoding queries, with the stores behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows
from tidemill.functions.lineage import scratch_path
from tidemill.operators import dictionary
from tidemill.operators import features as fs
from tidemill.plans.base import before, query, rounded, since, union_sql
from tidemill.sources.stores import FeatureStore

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
FLAGS = ["A", "N", "R"]
STATUSES = ["F", "O"]

# Missing values are made by rule, so that SQL can make the same ones.
_INPUT_SQL = """SELECT l_orderkey, l_linenumber, nullif(l_quantity, 25) AS l_quantity, l_extendedprice,
  nullif(l_discount, 0.05) AS l_discount, l_tax, CASE WHEN l_quantity > 48 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus, l_shipdate FROM lineitem"""


def inputs(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_quantity", F.lit(25.0)).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_discount") == 0.05, float("nan")).otherwise(F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.when(F.col("l_quantity") <= 48, F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        "l_shipdate",
    )


def _fit_numeric_sql(source: str) -> str:
    return union_sql(
        [
            f"""SELECT '{c}' AS "column", avg({c}) AS mean,
  (SELECT stddev_pop(coalesce({c}, (SELECT avg({c}) FROM {source}))) FROM {source}) AS sd FROM {source}"""
            for c in NUMERIC
        ]
    )


@query(
    "f1_fit_numeric",
    f"""WITH i AS ({_INPUT_SQL}), p AS ({_fit_numeric_sql('i')})
SELECT "column", round(mean, 6) AS mean, round(sd, 6) AS sd FROM p""",
)
def fit_numeric(t):
    fitted = fs.fit_numeric(inputs(t), NUMERIC)
    rows = [(c, p["mean"], p["sd"]) for c, p in fitted.items()]
    return rounded(local_rows(t.spark, rows, "column string, mean double, sd double"))


def _mode_sql(c: str, source: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "f2_fit_categorical",
    f"WITH i AS ({_INPUT_SQL})\n"
    + union_sql(
        [
            f"""SELECT '{c}' AS "column", {_mode_sql(c, 'i')} AS mode,
  (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM i WHERE {c} IS NOT NULL)) AS categories"""
            for c in CATEGORICAL
        ]
    ),
)
def fit_categorical(t):
    fitted = fs.fit_categorical(inputs(t), CATEGORICAL)
    rows = [(c, p["mode"], ",".join(p["categories"])) for c, p in fitted.items()]
    return local_rows(t.spark, rows, "column string, mode string, categories string")


def _scaled_sql(columns: list[str]) -> str:
    return ", ".join(
        f"round((coalesce(i.{c}, p_{c}.mean) - p_{c}.mean) / CASE WHEN p_{c}.sd = 0 THEN 1 ELSE p_{c}.sd END, 6) AS {c}_scaled"
        for c in columns
    )


def _params_sql(columns: list[str], source: str = "i") -> str:
    return ", ".join(
        f"""p_{c} AS (SELECT avg({c}) AS mean, stddev_pop(coalesce({c}, (SELECT avg({c}) FROM {source}))) AS sd
  FROM {source})"""
        for c in columns
    )


def _onehot_sql(flag: str = "l_returnflag", source: str = "i") -> str:
    parts = [
        f"CASE WHEN coalesce({flag}, {_mode_sql(flag, source)}) = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {flag}_{v}"
        for v in FLAGS
    ]
    parts += [f"CASE WHEN l_linestatus = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_linestatus_{v}" for v in STATUSES]
    return ", ".join(parts)


@query(
    "f3_transform_numeric",
    f"""WITH i AS ({_INPUT_SQL}), {_params_sql(NUMERIC)}
SELECT l_orderkey, l_linenumber, {_scaled_sql(NUMERIC)} FROM i, p_l_quantity, p_l_extendedprice, p_l_discount""",
)
def transform_numeric(t):
    fitted = fs.fit_feature_set(inputs(t), "lineitem", NUMERIC)
    return rounded(fs.transform(inputs(t), fitted, ["l_orderkey", "l_linenumber"]))


@query("f4_transform_onehot", f"WITH i AS ({_INPUT_SQL}) SELECT l_orderkey, l_linenumber, {_onehot_sql()} FROM i")
def transform_onehot(t):
    fitted = fs.fit_feature_set(inputs(t), "lineitem", [], CATEGORICAL)
    return fs.transform(inputs(t), fitted, ["l_orderkey", "l_linenumber"])


@query(
    "f4_unknown_category",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_returnflag_A,
  CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_returnflag_N FROM lineitem""",
)
def unknown_category(t):
    fitted = fs.fit_feature_set(t.lineitem.where("l_returnflag <> 'R'"), "lineitem", [], ["l_returnflag"])
    return fs.transform(t.lineitem, fitted, ["l_orderkey", "l_linenumber"])


@query(
    "f5_missing_column_fill",
    f"""WITH i AS ({_INPUT_SQL}), {_params_sql(NUMERIC)}
SELECT l_orderkey, l_linenumber, {_scaled_sql(["l_quantity", "l_extendedprice"])}, 0.0::DOUBLE AS l_discount_scaled
FROM i, p_l_quantity, p_l_extendedprice""",
)
def missing_column_fill(t):
    fitted = fs.fit_feature_set(inputs(t), "lineitem", NUMERIC)
    return rounded(fs.transform(inputs(t).drop("l_discount"), fitted, ["l_orderkey", "l_linenumber"]))


@query(
    "f6_target_passthrough",
    f"""WITH i AS ({_INPUT_SQL}), {_params_sql(["l_quantity"])}
SELECT l_orderkey, l_linenumber, {_scaled_sql(["l_quantity"])}, l_linestatus FROM i, p_l_quantity""",
)
def target_passthrough(t):
    fitted = fs.fit_feature_set(inputs(t), "lineitem", ["l_quantity"], [], "l_linestatus")
    return rounded(fs.transform(inputs(t), fitted, ["l_orderkey", "l_linenumber"]))


_FULL_SQL = f"""WITH i AS ({_INPUT_SQL}), {_params_sql(NUMERIC)}
SELECT l_orderkey, l_linenumber, {_scaled_sql(NUMERIC)}, {_onehot_sql()}
FROM i, p_l_quantity, p_l_extendedprice, p_l_discount"""


def _store(t) -> FeatureStore:
    return FeatureStore(t.spark, scratch_path(t.spark, "features"))


@query("s3_feature_cache", _FULL_SQL)
def feature_cache(t):
    """The latest version is written, read back and equal to the transform of that version."""
    store = _store(t)
    store.create(before(inputs(t)), "lineitem", ["l_quantity"])
    store.create(inputs(t), "lineitem", NUMERIC, CATEGORICAL)
    store.cache(inputs(t), "lineitem", 1, ["l_orderkey"])
    store.cache(inputs(t), "lineitem", keep=["l_orderkey", "l_linenumber"])
    return rounded(store.cached("lineitem"))


@query(
    "s4_feature_set_catalog",
    """SELECT name AS feature_set_name, version, numeric_features, categorical_features, target_column FROM (VALUES
  ('lineitem', 'v1', 'l_quantity', '', NULL), ('lineitem', 'v2', 'l_extendedprice,l_quantity', 'l_returnflag', 'l_linestatus'),
  ('orders', 'v1', 'o_totalprice', 'o_orderpriority', 'o_orderstatus'))
  v(name, version, numeric_features, categorical_features, target_column)""",
)
def feature_set_catalog(t):
    store = _store(t)
    store.create(t.lineitem, "lineitem", ["l_quantity"])
    store.create(t.lineitem, "lineitem", ["l_quantity", "l_extendedprice"], ["l_returnflag"], "l_linestatus")
    store.create(t.orders, "orders", ["o_totalprice"], ["o_orderpriority"], "o_orderstatus")
    lists = {c: F.array_join(F.array_sort(c), ",") for c in ["numeric_features", "categorical_features"]}
    return store.catalog().withColumns(lists).drop("created_at")


@query(
    "f7_feature_version",
    f"""WITH i AS ({_INPUT_SQL}), b AS (SELECT * FROM i WHERE l_shipdate < TIMESTAMP '1998-06-01')
SELECT 'v1' AS version, round(avg(l_quantity), 6) AS mean FROM b
UNION ALL SELECT 'v2', round(avg(l_quantity), 6) FROM i""",
)
def feature_version(t):
    store = _store(t)
    store.create(before(inputs(t)), "lineitem", ["l_quantity"])
    store.create(inputs(t), "lineitem", ["l_quantity"])
    rows = [(s.version, s.numeric["l_quantity"]["mean"]) for s in (store.load("lineitem", "v1"), store.load("lineitem"))]
    return rounded(local_rows(t.spark, rows, "version string, mean double"))


@query(
    "f8_train_impute",
    f"""WITH i AS ({_INPUT_SQL}), r AS (SELECT * FROM i WHERE l_shipdate < TIMESTAMP '1998-06-01')
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM r)), 6) AS l_quantity,
  round(coalesce(l_discount, (SELECT avg(l_discount) FROM r)), 6) AS l_discount,
  coalesce(l_returnflag, {_mode_sql("l_returnflag", "r")}) AS l_returnflag, 0.0::DOUBLE AS nothing, 'missing' AS no_text
FROM i WHERE l_shipdate >= TIMESTAMP '1998-06-01'""",
)
def train_impute(t):
    """Fill values come from the earlier shipments and fill the later ones."""
    empty = {"nothing": F.lit(None).cast("double"), "no_text": F.lit(None).cast("string")}
    table = inputs(t).withColumns(empty)
    fills = fs.fit_imputer(before(table), ["l_quantity", "l_discount", "l_returnflag", "nothing", "no_text"])
    return rounded(fs.impute(since(table), fills).select("l_orderkey", "l_linenumber", *fills))


_DUMMIES_SQL = """SELECT l_orderkey, l_quantity, CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_returnflag_N,
  CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_returnflag_R,
  CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_linestatus_O"""


@query("f9_dummies_drop_first", _DUMMIES_SQL + " FROM lineitem")
def dummies_drop_first(t):
    columns = ["l_quantity", *CATEGORICAL]
    return fs.encode_dummies(t.lineitem, fs.fit_dummies(t.lineitem, columns), ["l_orderkey"])


@query(
    "f10_dummies_align",
    _DUMMIES_SQL
    + """ FROM (SELECT l_orderkey, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'new' ELSE l_returnflag END AS l_returnflag,
  l_linestatus FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01')""",
)
def dummies_align(t):
    """Scoring rows lack one training category and have a new one: the columns stay those of training."""
    columns = ["l_quantity", *CATEGORICAL]
    encoding = fs.fit_dummies(before(t.lineitem), columns)
    flag = F.when(F.col("l_returnflag") == "R", "new").otherwise(F.col("l_returnflag"))
    return fs.encode_dummies(since(t.lineitem).withColumn("l_returnflag", flag), encoding, ["l_orderkey"])


@query("f11_required_feature_check", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def required_feature_check(t):
    return fs.require_features(t.lineitem, ["l_orderkey", "l_quantity", "l_returnflag"])


@query(
    "f12_preprocess_if_registered",
    f"""WITH i AS ({_INPUT_SQL}), {_params_sql(["l_quantity"])}
SELECT 'lineitem-model' AS model, {_scaled_sql(["l_quantity"]).replace("l_quantity_scaled", "feature")} FROM i, p_l_quantity
UNION ALL SELECT 'other-model', round(l_quantity, 6) FROM i""",
)
def preprocess_if_registered(t):
    store = _store(t)
    store.create(inputs(t), "lineitem-model", ["l_quantity"])
    table = inputs(t).select("l_quantity")
    known, unknown = (store.transform_if_registered(table, m) for m in ("lineitem-model", "other-model"))
    return rounded(
        known.select(F.lit("lineitem-model").alias("model"), F.col("l_quantity_scaled").alias("feature")).unionByName(
            unknown.select(F.lit("other-model").alias("model"), F.col("l_quantity").alias("feature"))
        )
    )


@query(
    "f2_dictionary",
    """SELECT 'l_orderkey' AS "column", CAST(l_orderkey AS VARCHAR) AS value, count(*) AS n,
  row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 AS index FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'l_shipmode', l_linestatus || l_returnflag, count(*), row_number() OVER (ORDER BY l_linestatus || l_returnflag) - 1
FROM lineitem GROUP BY l_linestatus || l_returnflag""",
)
def dictionary_table(t):
    """Every category of two columns, one of them with as many as there are orders, numbered in order."""
    return dictionary.fit_dictionary(_coded(t), ["l_orderkey", "l_shipmode"]).table(t.spark)


def _coded(t):
    return t.lineitem.select(
        "l_linenumber", "l_quantity", F.col("l_orderkey").cast("string").alias("l_orderkey"), F.concat("l_linestatus", "l_returnflag").alias("l_shipmode")
    )


@query(
    "f4_sparse_features",
    """WITH d AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem)),
m AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM (SELECT DISTINCT l_linestatus || l_returnflag AS k FROM lineitem)),
s AS (SELECT avg(l_quantity) AS mean, stddev_pop(l_quantity) AS sd FROM lineitem), w AS (SELECT count(*) AS n FROM d)
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber, 1 + w.n + (SELECT count(*) FROM m) AS size,
  '0,' || (1 + d.i) || ',' || (1 + w.n + m.i) AS places, round((l_quantity - mean) / sd, 6) AS first, 2.0::DOUBLE AS others
FROM lineitem JOIN d ON d.k = CAST(l_orderkey AS VARCHAR) JOIN m ON m.k = l_linestatus || l_returnflag, s, w""",
)
def sparse_rows(t):
    """A scaled number and two categories of every line, as places and values of one sparse vector."""
    coded = _coded(t)
    fitted = dictionary.fit_dictionary(coded, ["l_orderkey", "l_shipmode"], numeric=["l_quantity"])
    found = dictionary.sparse_features(coded, fitted, ["l_orderkey", "l_linenumber"])
    rest = F.aggregate(F.slice("values", 2, 9), F.lit(0.0), lambda a, v: a + v)
    return rounded(
        found.select("l_orderkey", "l_linenumber", "size", F.array_join("indices", ",").alias("places"), F.get("values", F.lit(0)).alias("first"), rest.alias("others"))
    )
