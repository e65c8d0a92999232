"""Rows that every operator on documents has to take: nulls, empty and long texts, equal rows, extra columns whose names
clash with the operators' own."""

from pyspark.sql import functions as F

#: Two different words that polynomials of their letters modulo a power of two cannot tell apart.
ALIKE = ["".join("ab"[(bin(k).count("1") + odd) % 2] for k in range(2048)) for odd in (0, 1)]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "A B c d e f"), (7, long), (8, long), (None, "no id here at all"), (9, "z" * 5000)]
    return [(i, t, None, "src0", None) for i, t in texts]


def documents(spark, more=()):
    df = spark.createDataFrame([*rows(), *more], SCHEMA)
    clash = "digest number score label print symbol ids decoded rank kept block words n_words share cosine _score"
    return df.withColumns({name: F.lit("clash") for name in clash.split()})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(found):
    return sorted((tuple(r) for r in found), key=repr)
