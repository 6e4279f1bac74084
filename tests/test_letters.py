"""Letter shares: the counts of the replaced form, from one look at each text."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from tidemill.plans import models

TEXTS = ["", "a", "ÄÖÜSS ß É İ ẞ Ã\x00 日本 😀 ä", "Ça Ñ́ Ù ñ ã", "zz zz éé", None]


def _documents(spark):
    rows = [(i, text, "en" if i % 2 else "de") for i, text in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (len(rows), "no language", None)], "doc_id long, text string, lang string")


def test_shares_are_those_of_replaced_letters(spark):
    documents = _documents(spark)
    found = models.languages(SimpleNamespace(documents=documents))
    text = F.lower("text")
    size = F.greatest(F.length(text), F.lit(1)) / 10
    shares = [
        ((F.length(text) - F.length(F.replace(text, F.lit(c)))) / size).alias(name) for c, name in zip(models.LETTERS, models.SHARES)
    ]
    wanted = documents.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", F.col("lang").alias("label"), *shares)
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_a_text_is_read_once_for_all_letters(spark):
    found = models.languages(SimpleNamespace(documents=_documents(spark)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan
    assert plan.count("counted(") == 1
