"""Fits take a bounded number of rows, whatever ids are null or repeated."""

import pytest
from pyspark.sql import functions as F

from sftlake.llm import common, pu_quality, quality_rules


@pytest.fixture(scope="module")
def docs(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    text = F.concat(F.lit("some words of text number "), F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")))
    return spark.range(30_000).select(ids.cast("long").alias("doc_id"), text.alias("text"))


def test_rows_are_bounded(docs):
    n = common.bounded_rows(docs, 1000, "doc_id", "text").count()
    assert 300 < n < 1300
    assert common.bounded_rows(docs.limit(50), 1000, "doc_id", "text").count() == 50


def test_fits_are_bounded(spark, docs, monkeypatch):
    taken = []
    labels = spark.createDataFrame([(7, 1), (8, 0), (11, 1), (14, 0), (None, 1)], "doc_id long, quality int")
    plain = pu_quality._rows
    monkeypatch.setattr(pu_quality, "_rows", lambda df: taken.append(len(x := plain(df))) or x)
    pu_quality.fit(docs, labels, 500)
    assert len(taken) == 2 and max(taken) < 800
    learned = []
    monkeypatch.setattr(quality_rules, "learn", lambda x, bad: learned.append(len(x)) or [])
    quality_rules.fit(docs, labels, 500)
    assert learned[0] < 800
