"""Training, scoring and explanation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, spread
from tidemill.functions.letters import letter_counts
from tidemill.functions.lineage import scratch_path
from tidemill.operators import evaluate, explain, models, neighbors, training
from tidemill.operators.splits import random_split
from tidemill.operators.tree_shap import tree_shap
from tidemill.plans.base import query, rounded, union_sql

DIMENSIONS = 64
VECTOR = [f"e{i}" for i in range(DIMENSIONS)]


def vectors(t):
    """One column per dimension of the embedding; the label has ten classes."""
    columns = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VECTOR)]
    return t.embeddings.select("vec_id", "label", *columns)


# Letters whose shares tell languages apart.
LETTERS = "abcdefghijklmnopqrstuvwxyzäçèéêíñóöüß"
SHARES = [f"share_{i}" for i in range(len(LETTERS))]


def languages(t):
    """The share of each letter in a document, in tenths; the label is its language."""
    text = F.lower("text")
    known = t.documents.where("text IS NOT NULL AND lang IS NOT NULL")
    size = F.greatest(F.length(text), F.lit(1)) / 10
    counted = known.select("doc_id", "lang", size.alias("size"), letter_counts(text, LETTERS).alias("counts"))
    shares = [(F.col("counts")[i] / F.col("size")).alias(name) for i, name in enumerate(SHARES)]
    return counted.select("doc_id", F.col("lang").alias("label"), *shares)


def two_languages(t):
    return languages(t).withColumn("label", F.when(F.col("label") == "en", "English").otherwise("other"))


# What must hold for any classifier on the held-out fifth, classes split one by one.
_CLAIMS_SQL = """SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS rows, {classes} AS classes, true AS probabilities_add_up,
  true AS prediction_is_likeliest, true AS beats_largest_class FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL"""


def claims(scored, label: str):
    """One row: how many rows were held out, whether probabilities and predictions are what they must be, and whether the
    model, which has not seen these rows, does better on them than their largest class."""
    total = F.aggregate(F.map_values("probability"), F.lit(0.0), lambda a, v: a + v)
    chosen = F.element_at("probability", F.col("prediction"))
    hits = scored.agg(F.count(F.when(F.col("prediction") == F.col(label), 1))).first()[0]
    largest = scored.groupBy(label).count().agg(F.max("count")).first()[0]
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.size("probability")).cast("bigint").alias("classes"),
        F.bool_and(F.abs(total - 1) < 1e-6).alias("probabilities_add_up"),
        F.bool_and(F.abs(chosen - F.col("confidence")) < 1e-9).alias("prediction_is_likeliest"),
        F.lit(hits > largest).alias("beats_largest_class"),
    )


def _classify(name: str, model: str, parameters: dict | None = None, table=languages, classes: str = "count(DISTINCT lang)") -> None:
    def run(t):
        _, scored = models.train_and_test(table(t).persist(), "doc_id", model, SHARES, "label", parameters)
        return claims(scored.persist(), "label")

    query(name, _CLAIMS_SQL.format(classes=classes))(run)


_classify("m3_random_forest_classifier", "random_forest")
_classify("m4_decision_tree_classifier", "decision_tree")
_classify("m5_gradient_boosting", "gradient_boosting", None, two_languages, "2::BIGINT")
_classify("m5_gradient_boosting_ten_classes", "gradient_boosting")
_classify("m6_logistic_regression", "logistic_regression")
_classify("m8_linear_svm", "svm", None, two_languages, "2::BIGINT")
_classify("m8_linear_svm_ten_classes", "svm")
_classify("m9_knn_fitted", "knn_classifier", {"weights": "distance"})
_classify("m10_mlp_classifier", "mlp_classifier")
_classify("m11_naive_bayes_estimator", "naive_bayes")
_classify("m12_adaboost", "adaboost", None, two_languages, "2::BIGINT")
_classify("m12_adaboost_ten_classes", "adaboost")


def _regress(name: str, model: str) -> None:
    """A feature of two values: every tree that is grown on all rows predicts the mean of each."""
    sql = """SELECT large, count(*) AS n, round(max(m), 4) AS prediction FROM (
  SELECT l_quantity > 25 AS large, avg(l_extendedprice) OVER (PARTITION BY l_quantity > 25) AS m FROM lineitem) GROUP BY large"""

    def run(t):
        rows = t.lineitem.select(
            (F.col("l_quantity") > 25).cast("double").alias("x"), (F.col("l_quantity") > 25).alias("large"), "l_extendedprice"
        )
        trained = models.train(rows, model, ["x"], "l_extendedprice")
        found = trained.predict(rows).groupBy("large")
        return rounded(found.agg(F.count(F.lit(1)).alias("n"), F.max("prediction").alias("prediction")), 4)

    query(name, sql)(run)


_regress("m4_decision_tree_regressor", "decision_tree_regressor")


@query(
    "m3_random_forest_regressor",
    "SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS rows, true AS beats_mean FROM part",
)
def random_forest_regressor(t):
    """Default parameters: better than the mean on the held-out parts, whose price goes in cycles of a thousand keys.

    Prices of order lines depend on nothing else in these tables, so no model of them can beat the mean.
    """
    parts = t.part.select("p_partkey", (F.col("p_partkey") % 1000).alias("cycle"), "p_size", "p_retailprice")
    _, scored = models.train_and_test(spread(parts), "p_partkey", "random_forest_regressor", ["cycle", "p_size"], "p_retailprice")
    scored = scored.persist()
    found = evaluate.regression_metrics(scored, "p_retailprice", "prediction")
    return scored.agg(F.count(F.lit(1)).alias("rows")).crossJoin(found.select((F.col("r2") > 0).alias("beats_mean")))


@query(
    "m12_adaboost_one_round",
    """SELECT l_linestatus, l_returnflag AS prediction FROM lineitem GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY l_linestatus ORDER BY count(*) DESC, l_returnflag) = 1""",
)
def adaboost_one_round(t):
    """One round on a feature of two values is the most frequent class of each."""
    rows = t.lineitem.select((F.col("l_linestatus") == "F").cast("double").alias("x"), "l_linestatus", "l_returnflag")
    trained = models.train(rows, "adaboost", ["x"], "l_returnflag", {"n_estimators": 1})
    return trained.predict(rows.drop("l_returnflag").distinct()).select("l_linestatus", "prediction")


@query("m6_logistic_optimum", "SELECT 10::BIGINT AS classes, true AS optimal FROM (SELECT count(*) FROM embeddings)")
def logistic_optimum(t):
    """At the optimum the predicted probabilities of a class add up to its rows, as the intercepts are not penalized."""
    trained = models.train(vectors(t), "logistic_regression", VECTOR, "label", {"max_iter": 500, "tol": 1e-10})
    each = trained.predict(vectors(t)).select("label", F.explode("probability").alias("class", "p"))
    off = each.groupBy("class").agg((F.sum("p") - F.count(F.when(F.col("label") == F.col("class"), 1))).alias("off"))
    return off.agg(F.count(F.lit(1)).alias("classes"), F.bool_and(F.abs("off") < 0.05).alias("optimal"))


@query("m11_estimator_against_expressions", "SELECT count(*) AS rows, 0::BIGINT AS differences FROM embeddings")
def naive_bayes_forms(t):
    """The fitted estimator and the densities as expressions agree on every row."""
    trained = models.train(vectors(t), "naive_bayes", VECTOR, "label")
    ours = trained.predict(vectors(t)).select("vec_id", F.col("prediction").alias("first"))
    fitted = models.fit_gaussian_nb(vectors(t), VECTOR, "label")
    theirs = models.predict_gaussian_nb(vectors(t), fitted, VECTOR).select("vec_id", F.col("prediction").alias("second"))
    return ours.join(theirs, "vec_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("first") != F.col("second"), 1)).alias("differences")
    )


@query("m2_train_stratified", "SELECT label, CAST(count(*) AS BIGINT) AS n, true AS share_kept FROM embeddings GROUP BY label")
def train_stratified(t):
    """Ten classes: each gives its share of the test rows, rounded up or down."""
    split = random_split(vectors(t), "vec_id", 0.2, stratify="label")
    found = split.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_test"), 1)).alias("k"))
    return found.select("label", "n", (F.abs(F.col("k") - F.col("n") * 0.2) < 1).alias("share_kept"))


# A raw table: missing numbers and strings made of what is there.
_RAW_SQL = """SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity FROM lineitem"""


def raw_lines(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("l_quantity"),
    )


@query(
    "m16_train_raw_table",
    """SELECT count(*) AS rows, CAST(ceil(0.2 * count(*)) AS BIGINT) AS test_rows, 0::BIGINT AS differences,
  'l_quantity,l_returnflag_N,l_returnflag_R' AS columns FROM lineitem""",
)
def train_raw_table(t):
    """Imputed, encoded, split, fitted, saved and loaded: the reloaded model scores every raw row alike."""
    fitted, scored = training.train_table(raw_lines(t), "l_extendedprice", "linear_regression", ["l_quantity", "l_returnflag"])
    path = scratch_path(t.spark, "table-model")
    fitted.save(path)
    again = training.TableModel.load(t.spark, path)
    test_rows = scored.count()
    keyed = raw_lines(t).withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber")).where("id IS NOT NULL")
    # a row takes its first prediction along to the second model, so that only rows that differ are brought together
    both = again.predict(fitted.predict(keyed).withColumnRenamed("prediction", "first"))
    differing = F.when(~F.col("first").eqNullSafe(F.col("prediction")), F.col("id"))
    apart = F.abs(F.sum("first") - F.sum("prediction")) > 1e-9
    found = both.groupBy(differing.alias("differing")).agg(F.count(F.lit(1)).alias("n"), apart.alias("apart"))
    return found.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("differing").isNotNull() & F.col("apart")).alias("differences"),
        F.lit(test_rows).cast("bigint").alias("test_rows"),
        F.lit(",".join(fitted.encoding.encoded_columns)).alias("columns"),
    )


_CENTERED_SQL = """SELECT regr_sxy(l_extendedprice, l_quantity) AS sxy, regr_sxx(l_extendedprice, l_quantity) AS sxx,
  avg(l_quantity) AS mx, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem"""


def _line(name: str, model: str, slope: str, alpha: float | None = None, digits: int = 4) -> None:
    """One feature: the penalized slopes have closed forms."""
    sql = f"""WITH s AS ({_CENTERED_SQL}), w AS (SELECT {slope} AS w, mx, my FROM s)
SELECT 'l_quantity' AS feature, round(w, {digits}) AS weight FROM w
UNION ALL SELECT '(intercept)', round(my - w * mx, {digits}) FROM w"""

    def run(t):
        parameters = None if alpha is None else {"alpha": alpha}
        trained = models.train(t.lineitem, model, ["l_quantity"], "l_extendedprice", parameters)
        return rounded(models.linear_coefficients(trained), digits)

    query(name, sql)(run)


_line("m7_linear_regression", "linear_regression", "sxy / sxx")
_line("m7_ridge_regression", "ridge_regression", "sxy / (sxx + 100000)", 100000.0)
_line("m7_lasso_regression", "lasso_regression", "sign(sxy) * greatest(abs(sxy / n) - 500, 0) / (sxx / n)", 500.0, 2)


_NEIGHBORS_SQL = """SELECT q.vec_id, x.vec_id AS neighbor, x.label, row_number() OVER (PARTITION BY q.vec_id
  ORDER BY list_sum([(q.e[i] - x.e[i]) * (q.e[i] - x.e[i]) FOR i IN range(1, 65)]), x.vec_id) AS rank
FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) q
JOIN (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings) x ON q.vec_id <> x.vec_id"""


@query(
    "m9_knn_classify",
    f"""SELECT vec_id, label AS prediction, count(*) AS votes FROM ({_NEIGHBORS_SQL}) WHERE rank <= 5 GROUP BY vec_id, label
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) = 1""",
)
def knn_classify(t):
    """Every vector is judged by its five nearest others."""
    return models.knn_classify(t.embeddings, t.embeddings, "vec_id", "embedding", "label")


@query(
    "m9_knn_regress",
    f"SELECT vec_id, round(avg(label), 6) AS prediction FROM ({_NEIGHBORS_SQL}) WHERE rank <= 5 GROUP BY vec_id",
)
def knn_regress(t):
    return rounded(models.knn_regress(t.embeddings, t.embeddings, "vec_id", "embedding", "label"))


_NB_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("m9_knn_approximate", "SELECT count(*) AS queries, 5 * count(*) AS neighbors, true AS recall_reached, true AS distances_exact FROM embeddings")
def knn_approximate(t):
    """Every vector's five nearest others by the hash-bucket index: at least nine tenths of those the exact search finds."""
    rows = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    index = neighbors.approximate_index(rows, "vec_id", "embedding", "label")
    found = neighbors.approximate_neighbors(index, rows, "vec_id", "embedding")
    exact = models.knn_neighbors(rows, rows, "vec_id", "embedding", "label")
    same = exact.select("vec_id", "neighbor", F.col("distance2").alias("exact"))
    joined = found.join(same, ["vec_id", "neighbor"], "left")
    return joined.agg(
        F.countDistinct("vec_id").alias("queries"),
        F.count(F.lit(1)).alias("neighbors"),
        (F.count("exact") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
        F.bool_and(F.coalesce(F.abs(F.col("distance2") - F.col("exact")) < 1e-9, F.lit(True))).alias("distances_exact"),
    )


def _nb_sql() -> str:
    floor = "(SELECT 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in _NB_FEATURES) + ") FROM lineitem)"
    params = ", ".join(f"avg({c}) AS m{i}, var_pop({c}) + {floor} AS v{i}" for i, c in enumerate(_NB_FEATURES))
    density = " ".join(
        f"- 0.5 * ln(2 * pi() * v{i}) - ({c} - m{i}) * ({c} - m{i}) / (2 * v{i})" for i, c in enumerate(_NB_FEATURES)
    )
    return f"""WITH p AS (SELECT l_returnflag AS class, count(*) / (SELECT count(*) FROM lineitem) AS prior, {params}
  FROM lineitem GROUP BY 1), d AS (SELECT l_orderkey, l_linenumber, {", ".join(_NB_FEATURES)}, class, ln(prior) {density} AS score FROM lineitem, p)
SELECT prediction, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM (
  SELECT l_orderkey, l_linenumber, arg_max(class, score) AS prediction FROM d GROUP BY ALL) GROUP BY 1"""


@query(
    "m11_gaussian_nb",
    _nb_sql().replace("GROUP BY ALL)", "GROUP BY l_orderkey, l_linenumber, " + ", ".join(_NB_FEATURES) + ")"),
)
def gaussian_nb(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *_NB_FEATURES).distinct()
    fitted = models.fit_gaussian_nb(t.lineitem, _NB_FEATURES, "l_returnflag")
    scored = models.predict_gaussian_nb(rows, fitted, _NB_FEATURES)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query(
    "m13_model_catalog",
    union_sql(
        [
            f"""SELECT '{name}' AS name, '{spec.task}' AS task, n FROM (SELECT count(DISTINCT l_quantity) AS d, count(*) AS n FROM lineitem)
WHERE {"" if spec.task == "classification" else "NOT"} (d < 10 OR d / n < 0.05)"""
            for name, spec in models.CATALOG.items()
        ]
    ),
)
def model_catalog(t):
    """The models that suit the number of different values in a column, each with the rows it would see."""
    task = models.detect_task(t.lineitem, "l_quantity").first()["task"]
    rows = t.lineitem.agg(F.count(F.lit(1)).alias("n"))
    return models.model_catalog(t.spark, task).select("name", "task").crossJoin(rows)


@query(
    "m14_param_filter",
    f"""WITH s AS ({_CENTERED_SQL}) SELECT 'l_quantity' AS feature, round(sxy / sxx, 4) AS weight FROM s
UNION ALL SELECT '(intercept)', round(my - sxy / sxx * mx, 4) FROM s""",
)
def param_filter(t):
    """A parameter the model does not know is ignored."""
    trained = models.train(
        t.lineitem, "linear_regression", ["l_quantity"], "l_extendedprice", {"n_trees": 7, "fit_intercept": True}
    )
    return rounded(models.linear_coefficients(trained), 4)


@query(
    "m16_batch_predict",
    "SELECT vec_id, 10::BIGINT AS classes, true AS adds_up, true AS prediction_is_likeliest FROM embeddings",
)
def batch_predict(t):
    """Prediction, class probabilities and confidence of every vector."""
    trained = models.train(vectors(t), "logistic_regression", VECTOR, "label")
    total = F.aggregate(F.map_values("probability"), F.lit(0.0), lambda a, v: a + v)
    return trained.predict(vectors(t)).select(
        "vec_id",
        F.size("probability").cast("bigint").alias("classes"),
        (F.abs(total - 1) < 1e-6).alias("adds_up"),
        (F.element_at("probability", F.col("prediction")) == F.col("confidence")).alias("prediction_is_likeliest"),
    )


@query("s8_model_save_load", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differences FROM embeddings")
def model_save_load(t):
    """The reloaded model scores every row as the original does: one row with the number of differences."""
    trained = models.train(vectors(t), "random_forest", VECTOR, "label", {"n_estimators": 5, "max_depth": 5})
    path = scratch_path(t.spark, "model")
    models.save_model(trained, path)
    loaded = models.load_model(t.spark, path)
    ours = trained.predict(vectors(t)).select("vec_id", F.col("prediction").alias("first"))
    theirs = loaded.predict(vectors(t)).select("vec_id", F.col("prediction").alias("second"))
    return ours.join(theirs, "vec_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("first") != F.col("second"), 1)).alias("differences")
    )


@query("e5_feature_importance", "SELECT 64::BIGINT AS features, 1.0::DOUBLE AS total, true AS sorted FROM (SELECT count(*) FROM embeddings)")
def feature_importance(t):
    """Importances of a forest add up to one and come largest first."""
    trained = models.train(vectors(t), "random_forest", VECTOR, "label")
    found = [r["importance"] for r in models.feature_importance(trained).collect()]
    rows = [(len(found), round(sum(found), 9), found == sorted(found, reverse=True))]
    return local_rows(t.spark, rows, "features bigint, total double, sorted boolean")


def _sized_parts(t):
    parts = t.part.select(
        "p_partkey", F.col("p_size").cast("double"), F.length("p_name").cast("double").alias("name_length"), "p_retailprice"
    )
    return parts, ["p_size", "name_length"]


@query(
    "x2_sampled_shap",
    """WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(length(p_name) AS DOUBLE) AS b, p_retailprice AS y FROM part),
s AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS cy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM p),
w AS (SELECT (bb * ay - ab * cy) / (aa * bb - ab * ab) AS u, (aa * cy - ab * ay) / (aa * bb - ab * ab) AS v, ma, mb, my FROM s),
z AS (SELECT a AS a0, b AS b0 FROM p ORDER BY p_partkey LIMIT 1)
SELECT p_partkey, round(my + u * (a0 - ma) + v * (b0 - mb), 4) AS base_value, feature, round(CASE feature WHEN 'p_size' THEN u * (a - a0) ELSE v * (b - b0) END, 4) + 0.0 AS impact,
  CASE feature WHEN 'p_size' THEN a ELSE b END AS value FROM p, w, z, (VALUES ('p_size'), ('name_length')) f(feature)""",
)
def sampled_shap(t):
    """Under a linear model and one background row every walk gives the exact impacts."""
    parts = t.part.select(
        "p_partkey", F.col("p_size").cast("double"), F.length("p_name").cast("double").alias("name_length"), "p_retailprice"
    )
    features = ["p_size", "name_length"]
    trained = models.train(parts, "linear_regression", features, "p_retailprice")
    background = explain.background_sample(parts, "p_partkey", features, 1)
    found = explain.sampled_shap(trained, parts, "p_partkey", features, background, samples=4)
    return rounded(explain.top_impacts(found).select("p_partkey", "base_value", F.inline("impacts")), 4)


@query(
    "x2_sampled_shap_background",
    """WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(length(p_name) AS DOUBLE) AS b, p_retailprice AS y FROM part),
s AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS cy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM p),
w AS (SELECT (bb * ay - ab * cy) / (aa * bb - ab * ab) AS u, (aa * cy - ab * ay) / (aa * bb - ab * ab) AS v, ma, mb, my FROM s),
z AS (SELECT avg(a) AS a0, avg(b) AS b0 FROM (SELECT a, b FROM p ORDER BY p_partkey LIMIT 100))
SELECT p_partkey, round(my + u * (a0 - ma) + v * (b0 - mb), 4) AS base_value, feature, round(CASE feature WHEN 'p_size' THEN u * (a - a0) ELSE v * (b - b0) END, 4) + 0.0 AS impact,
  CASE feature WHEN 'p_size' THEN a ELSE b END AS value FROM p, w, z, (VALUES ('p_size'), ('name_length')) f(feature)""",
)
def sampled_shap_background(t):
    """Under a linear model the walks from the whole background sample give the impacts against its means."""
    parts, features = _sized_parts(t)
    trained = models.train(parts, "linear_regression", features, "p_retailprice")
    background = explain.background_sample(parts, "p_partkey", features)
    found = explain.sampled_shap(trained, parts, "p_partkey", features, background)
    return rounded(explain.top_impacts(found).select("p_partkey", "base_value", F.inline("impacts")), 4)


@query("x2_sampled_shap_tree")
def sampled_shap_tree(t):
    """Impacts on the price of every part under a fitted tree, with the whole background sample."""
    parts, features = _sized_parts(t)
    trained = models.train(parts, "decision_tree_regressor", features, "p_retailprice", {"max_depth": 5})
    background = explain.background_sample(parts, "p_partkey", features)
    found = explain.sampled_shap(trained, parts, "p_partkey", features, background)
    return explain.top_impacts(found).select("p_partkey", "base_value", F.inline("impacts"))


@query(
    "x2_sampled_shap_per_class",
    "SELECT label AS class, (SELECT count(*) FROM embeddings) AS rows, true AS adds_up, true AS one_base FROM embeddings GROUP BY label",
)
def sampled_shap_per_class(t):
    """All features of a tree at its default parameters: impacts and base value add up to the probability of every class."""
    trained = models.train(vectors(t), "decision_tree", VECTOR, "label")
    background = explain.background_sample(vectors(t), "vec_id", VECTOR)
    found = explain.sampled_shap(trained, vectors(t), "vec_id", VECTOR, background, per_class=True)
    total = F.col("base_value") + F.aggregate("impacts", F.lit(0.0), lambda a, e: a + e["impact"])
    own = trained.predict(vectors(t)).select("vec_id", F.explode("probability").alias("class", "p"))
    joined = found.select("vec_id", "class", "base_value", total.alias("total")).join(own, ["vec_id", "class"])
    return joined.groupBy("class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.abs(F.col("total") - F.col("p")) < 1e-9).alias("adds_up"),
        (F.max("base_value") - F.min("base_value") < 1e-9).alias("one_base"),
    )


@query(
    "x2_tree_shap",
    """WITH r AS (SELECT p_partkey, (p_size > 25)::DOUBLE AS a, (p_retailprice > 950)::DOUBLE AS b, p_retailprice AS y FROM part),
f AS (SELECT a, b, avg(y) AS m, count(*) AS n FROM r GROUP BY a, b),
z AS (SELECT a, b, count(*) / sum(count(*)) OVER () AS w FROM (SELECT a, b FROM r ORDER BY p_partkey LIMIT 100) GROUP BY a, b)
SELECT x.a, x.b, x.n, round(sum(w * zz.m), 4) AS base_value,
  round(sum(w * ((xz.m - zz.m) + (x.m - zx.m)) / 2), 4) + 0.0 AS impact_a, round(sum(w * ((zx.m - zz.m) + (x.m - xz.m)) / 2), 4) + 0.0 AS impact_b
FROM f x CROSS JOIN z JOIN f zz ON zz.a = z.a AND zz.b = z.b JOIN f xz ON xz.a = x.a AND xz.b = z.b JOIN f zx ON zx.a = z.a AND zx.b = x.b
GROUP BY x.a, x.b, x.n""",
)
def exact_tree_shap(t):
    """Two features of two values: the tree is the mean of each of four cells, and both orders are written out in SQL."""
    parts = t.part.select(
        "p_partkey", (F.col("p_size") > 25).cast("double").alias("a"), (F.col("p_retailprice") > 950).cast("double").alias("b"), "p_retailprice"
    )
    trained = models.train(parts, "decision_tree_regressor", ["a", "b"], "p_retailprice")
    found = tree_shap(trained, parts, "p_partkey", explain.background_sample(parts, "p_partkey", ["a", "b"]))
    a, b = (F.get("impacts", F.lit(i)) for i in (0, 1))
    each = found.select("base_value", a["value"].alias("a"), a["impact"].alias("ia"), b["value"].alias("b"), b["impact"].alias("ib"))
    return rounded(
        each.groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("n"), F.max("base_value").alias("base_value"), F.max("ia").alias("impact_a"), F.max("ib").alias("impact_b")
        ),
        4,
    )


@query(
    "x2_tree_shap_per_class",
    "SELECT label AS class, (SELECT count(*) FROM embeddings) AS rows, true AS adds_up, true AS one_base FROM embeddings GROUP BY label",
)
def exact_tree_shap_per_class(t):
    """64 features, ten classes, the tree at its default parameters and the whole background: impacts add up for every row."""
    trained = models.train(vectors(t), "decision_tree", VECTOR, "label")
    found = tree_shap(trained, vectors(t), "vec_id", explain.background_sample(vectors(t), "vec_id", VECTOR), per_class=True)
    total = F.col("base_value") + F.aggregate("impacts", F.lit(0.0), lambda a, e: a + e["impact"])
    own = trained.predict(vectors(t)).select("vec_id", F.explode("probability").alias("class", "p"))
    joined = found.select("vec_id", "class", "base_value", total.alias("total")).join(own, ["vec_id", "class"])
    return joined.groupBy("class").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.abs(F.col("total") - F.col("p")) < 1e-9).alias("adds_up"),
        (F.max("base_value") - F.min("base_value") < 1e-9).alias("one_base"),
    )
