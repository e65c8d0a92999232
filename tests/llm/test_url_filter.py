import pytest
from pyspark.sql import functions as F

from claimloom.llm import queries, url_filter


@pytest.fixture(scope="module")
def weights(spark):
    return url_filter.train(spark.createDataFrame(queries.LABELLED_URLS, "url string, label int"))


def judged(spark, urls, weights):
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("score", F.lit(1))
    return [tuple(r) for r in url_filter.judge(rows, queries.URL_RULES, weights).orderBy("page_id").drop("score").collect()]


def test_parts_and_rules(spark, weights):
    found = judged(
        spark,
        ["HTTP://Blog.Example.ORG/es/1?x=/", "https://example.org/en/12#a", "x://example.org/en/2", "a://b.com/fr/x://y", "a://b.com/de/", "a://b.com",
         "a://xcom/de/", None, "", "no scheme", "a://?q", "s://example.org.net/es/", "k://İ.com/de/#"],
        weights,
    )
    told = [(r[1], r[2], r[3], r[4] if r[3] else None) for r in found]
    assert told == [
        ("blog.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("b.com", "/fr/x://y", "com/fr/", "allow"), ("b.com", "/de/", "com/de/", "block"),
        ("b.com", "", None, None), ("xcom", "/de/", None, None), ("", "", None, None), ("", "", None, None), ("", "", None, None),
        ("", "", None, None), ("example.org.net", "/es/", None, None), ("İ.com", "/de/", "com/de/", "block"),
    ]
    assert {r[4] for r in found} <= {"allow", "block"}


def test_the_classifier_learns(spark, weights):
    spam = ["http://cheap-pills.shop.net/en/4", "https://www.spam-farm.site.net/de/99", "http://mega-casino.win.net/bonus"]
    plain = ["https://blog.thereis.example.net/en/77", "http://library.city.net/catalog/item/9", "https://m.therin.example.com/en/3"]
    assert [r[4] for r in judged(spark, spam + plain, weights)] == ["block"] * 3 + ["allow"] * 3


def test_limits(spark):
    none = url_filter.train(spark.createDataFrame([], "url string, label int"))
    assert set(none) == {0.0}
    rows = [(None, 1), ("a://b", None), ("a://spam", 1), ("a://spam", 1), ("a://fine", 0)]
    assert any(url_filter.train(spark.createDataFrame(rows, "url string, label int")))
    with pytest.raises(ValueError):
        url_filter.train(spark.range(600).select(F.concat(F.lit("a://"), "id").alias("url"), F.lit(1).alias("label")))


def test_no_python_in_the_plan(spark, weights):
    pages = spark.createDataFrame([(1, "a://b")], "page_id long, url string")
    plan = url_filter.judge(pages, queries.URL_RULES, weights)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
