"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for all other urls.

Everything is DataFrame expressions. Training runs in one expression over the labelled urls, which are few by contract (``MAX_LABELLED``
at most, else an error): with weights kept as one factor per labelled url, a step of gradient descent only needs the
inner products of the urls, a matrix of labels by labels. The weights of the hash slots, ``SLOTS`` numbers, are then a sum
over the n-grams; as a constant of fixed size they go into the scoring expression, so scoring is a single scan.

Null urls and urls without ``://`` have an empty host and path; they fit no rule and are judged like any other by the
method. Equal rows each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.sources import scratch

GRAM = 4
SLOTS = 1 << 12
MAX_LABELLED = 512
STEPS = 200
RATE = 4.0
DECAY = 0.002


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def slots(host: Column, path: Column) -> Column:
    """Distinct hash slots of the n-grams of host and path, the two kept apart."""

    def grams(kind: str, text: Column) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (GRAM - 1), F.lit(1)))
        return F.transform(starts, lambda k: F.pmod(F.xxhash64(F.lit(kind), F.substring(marked, k, F.lit(GRAM))), F.lit(SLOTS)).cast("int"))

    return F.array_distinct(F.concat(grams("host", host), grams("path", path)))


def train(labelled: DataFrame) -> list[float]:
    """Weights of the slots, then the bias, from rows (url, label; 1: block). Rows without url or label are left out."""
    rows = labelled.filter("url IS NOT NULL AND label IS NOT NULL").select("url", F.col("label").cast("double").alias("label"))
    rows = rows.groupBy("url").agg(F.max("label").alias("label"))
    if rows.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    rows = rows.select("url", "label", slots(host(F.col("url")), path(F.col("url"))).alias("slots"))
    every = rows.agg(F.sort_array(F.collect_list(F.struct("url", "label", "slots"))).alias("rows"))
    # A shared constant slot is the bias; vectors have length 1 before it.
    common = lambda a, b: F.size(F.array_intersect(a, b)) / F.sqrt(F.size(a).cast("double") * F.size(b))
    every = every.withColumn("near", F.transform("rows", lambda a: F.transform("rows", lambda b: common(a["slots"], b["slots"]) + 1.0)))
    every = scratch.written(every, "labelled")  # else the optimizer puts the matrix into each step
    n = F.greatest(F.size("rows"), F.lit(1)).cast("double")

    def step(factors: Column, _: Column) -> Column:
        margin = lambda k: F.aggregate(
            F.zip_with(F.element_at("near", k + 1), factors, lambda x, f: x * f), F.lit(0.0), lambda s, x: s + x
        )
        error = lambda f, k: F.element_at("rows", k + 1)["label"] - 1 / (1 + F.exp(-margin(k)))
        return F.transform(factors, lambda f, k: f * (1 - RATE * DECAY) + RATE / n * error(f, k))

    start = F.transform("rows", lambda r: F.lit(0.0))
    every = every.withColumn("factors", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step))
    every = scratch.written(every, "factors")
    pairs = every.select(F.explode(F.arrays_zip("rows", "factors")).alias("p")).select("p.rows.slots", F.col("p.factors").alias("factor"))
    weighted = pairs.select((F.col("factor") / F.sqrt(F.size("slots"))).alias("w"), F.explode("slots").alias("slot"))
    found = {r["slot"]: r["w"] for r in weighted.groupBy("slot").agg(F.sum("w").alias("w")).collect()}  # SLOTS rows at most
    bias = pairs.agg(F.sum("factor")).first()[0] or 0.0
    return [found.get(k, 0.0) for k in range(SLOTS)] + [bias]


def score(own: Column, weights: list[float]) -> Column:
    """Probability that a url with the given slots is to be blocked."""
    table = F.lit(weights[:-1]).cast("array<double>")
    total = F.aggregate(own, F.lit(0.0), lambda s, k: s + F.element_at(table, k + 1))
    return 1 / (1 + F.exp(-(total / F.sqrt(F.greatest(F.size(own), F.lit(1))) + weights[-1])))


def fitting(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the rules (verdict, host, path prefix) that fits the host or a parent domain and the path, as a struct of
    rule and verdict, or null. Of rules of equal length the first in the list wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        found = F.coalesce(found, F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    return found


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], weights: list[float]) -> DataFrame:
    """``page_id``, host, path, rule, verdict, score for every row of ``pages`` (page_id, url; other columns are ignored)."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("slots", slots(F.col("host"), F.col("path")))
    rows = rows.withColumn("fit", fitting(F.col("host"), F.col("path"), rules)).withColumn("score", score(F.col("slots"), weights))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "score")
