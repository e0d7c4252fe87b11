"""Morphological profiles of words, and vectors of their characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.text import encode, types

#: Code of a character that the table does not have, in vectors of characters.
UNKNOWN = 116


def profiles(words: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers and shares of letters, digits and marks, the mean code, and the
    word as a string of the types."""
    kinds = words.select(*keys, "text", types(F.col("text")).alias("profile")).where("profile <> ''")
    n = F.length("profile")
    count = lambda k: n - F.length(F.replace("profile", F.lit(k)))
    total = F.aggregate(encode(F.col("text")), F.lit(0).cast("bigint"), lambda a, c: a + c)
    return kinds.select(
        *keys, n.alias("n_chars"), count("a").alias("n_letters"), count("n").alias("n_digits"), count("e").alias("n_marks"),
        (count("a") / n).alias("letters"), (count("n") / n).alias("digits"), (count("e") / n).alias("marks"),
        (total / n).alias("mean_code"), "profile",
    )


def characters(words: DataFrame, keys: list[str]) -> DataFrame:
    """place (from 1) and code of every character."""
    return words.select(*keys, F.posexplode(encode(F.col("text"))).alias("i", "code")).select(*keys, (F.col("i") + 1).alias("place"), "code")


def line_characters(words: DataFrame, keys: list[str], x: str, unknown: int = UNKNOWN) -> DataFrame:
    """place (from 1), in the whole line, and code of every character of the words,
    which are taken in the order of x; unknown characters have their own code."""
    coded = words.select(*keys, x, "word_no", encode(F.col("text"), unknown).alias("codes"))
    before = F.coalesce(F.sum(F.size("codes")).over(W.partitionBy(*keys).orderBy(x, "word_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = coded.withColumn("before", before)  # a generator beside a window would come before it
    return placed.select(*keys, "before", F.posexplode("codes").alias("i", "code")).select(*keys, (F.col("before") + F.col("i") + 1).alias("place"), "code")
