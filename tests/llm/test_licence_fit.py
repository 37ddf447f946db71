"""The licence model is fitted and calibrated on every ordinary line."""

from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from tidemark.llm import license_scan


def test_every_ordinary_wording_counts(spark):
    """More lines than the weight that they have together, most of which look the same to the model."""
    n = license_scan.WEIGHT + 500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("the lamps of the house in row number "), F.col("id").cast("string"), F.lit(" belong to nobody who would sell them any more")).alias("text"))
    wordings = license_scan._wordings(license_scan._cases(docs))
    vocabulary = license_scan._templates(spark).select(license_scan.word_ngrams(F.col("text")).alias("grams"))
    rows = license_scan._ordinary(wordings, CountVectorizer(inputCol="grams", outputCol="x", binary=True).fit(vocabulary)).collect()
    assert sum(r.n for r in rows) == n and len(rows) < 50 and {r.unseen for r in rows} == {True, False}


def test_threshold_is_that_of_all_weights(spark):
    rows = [(i / 1000, 1.0 if i % 2 else 3.0) for i in range(1000)]
    t = license_scan._threshold(spark.createDataFrame(rows, "p double, weight double"))
    above = lambda x: sum(w for p, w in rows if p > x) / sum(w for _, w in rows)
    assert above(t) <= license_scan.FALSE_ALARMS < above(t - 2 / license_scan.STEPS - 0.002)
    assert license_scan._threshold(spark.createDataFrame([], "p double, weight double")) == 0.0
