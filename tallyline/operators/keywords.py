"""Keyword search: weighted n-gram similarity of words with a lexicon.

The score of a word and an entry is LEXICAL times the weighted mean of their
cosines over n = 2..5, plus the rest times the likeness of their statistics where
the lexicon has those (`with_statistics`). Only entries that share an n-gram are scored: an entry that
shares none has at most 1 - LEXICAL, which no threshold accepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import MAX_CODE, encode, grams, normal

# Fixed values of the score.
WEIGHTS = {2: 0.5, 3: 0.7, 4: 0.85, 5: 1.0}
LEXICAL = 0.7
LONGEST = 20.0
#: Thresholds by an entry's length: up to 6, up to 10, beyond.
THRESHOLDS = ((6, 0.70), (10, 0.65), (None, 0.60))
#: Field entries, and header entries, with their category.
FIELDS = (("subtotal", "subtotal"), ("proveedor", "supplier"), ("fechaemision", "date"), ("foliofiscal", "folio"), ("montototal", "total"))
HEADINGS = (("cantidad", "quantity"), ("descripcion", "description"), ("producto", "description"), ("preciounitario", "unit_price"), ("precio", "unit_price"), ("importe", "amount"))


def lexicon(spark: SparkSession, fields=FIELDS, headings=HEADINGS) -> DataFrame:
    """cand_id, word, key_field, header_category. Words are unique; the order of
    entries breaks ties."""
    words = list(dict.fromkeys([w for w, _ in fields] + [w for w, _ in headings]))
    of_field, of_heading = dict(fields), dict(headings)
    rows = [(i, w, of_field.get(w), of_heading.get(w)) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "cand_id int, word string, key_field string, header_category string")


def threshold(length: Column, by_length=THRESHOLDS) -> Column:
    out = F.lit(by_length[-1][1])
    for most, value in reversed(by_length[:-1]):
        out = F.when(length <= most, value).otherwise(out)
    return out


def _moments(word: Column) -> tuple[Column, Column, Column]:
    """Length, mean and variance of a word's codes."""
    codes, n = encode(word), F.length(word)
    mean = F.coalesce(F.try_divide(F.aggregate(codes, F.lit(0.0), lambda a, c: a + c), n), F.lit(0.0))
    var = F.try_divide(F.aggregate(codes, F.lit(0.0), lambda a, c: a + (c - mean) * (c - mean)), n)
    return n, mean, F.coalesce(var, F.lit(0.0))


def statistics(word: Column, var_min, var_max, std_min, std_max) -> Column:
    """Length, mean, variance and deviation of a word's codes, as shares of
    their bounds (numbers or columns); 1 where bounds are equal."""
    n, mean, var = _moments(word)

    def spread(v: Column, lo, hi) -> Column:
        lo, hi = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lo, hi))
        return F.when(hi == lo, F.lit(1.0)).otherwise((v - lo) / (hi - lo))

    return F.array(F.least(n / LONGEST, F.lit(1.0)), mean / MAX_CODE, spread(var, var_min, var_max), spread(F.sqrt(var), std_min, std_max))


_BOUNDS = ("var_min", "var_max", "std_min", "std_max")


def with_statistics(entries: DataFrame) -> DataFrame:
    """entries with the bounds of their field, over its own words, and with their
    statistics; entries of no field have none."""
    _, _, var = _moments(F.col("word"))
    each = entries.where("key_field IS NOT NULL").select("key_field", var.alias("v"))
    bounds = each.groupBy("key_field").agg(F.min("v").alias("var_min"), F.max("v").alias("var_max"), F.min(F.sqrt("v")).alias("std_min"), F.max(F.sqrt("v")).alias("std_max"))
    return entries.join(bounds, "key_field", "left").withColumn("stats", F.when(F.col("var_min").isNotNull(), statistics(F.col("word"), *map(F.col, _BOUNDS))))


def info(entries: DataFrame, weights=WEIGHTS, by_length=THRESHOLDS) -> DataFrame:
    """What the lexicon holds, in one row."""
    known = F.count("stats") if "stats" in entries.columns else F.lit(0).cast("long")
    return entries.agg(F.count("*").alias("total_words"), F.count("key_field").alias("field_words"), F.count("header_category").alias("header_words"), known.alias("words_with_statistics"),
                       F.lit(float(by_length[-1][1])).alias("threshold"), F.lit(min(weights)).alias("n_min"), F.lit(max(weights)).alias("n_max"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    lengths = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.try_divide(dot(a, b), lengths), F.lit(0.0))


def _grams(df: DataFrame, key: str, sizes) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), grams(F.col("word"), n).alias("g")) for n in sizes])).alias("x")
    return df.select(key, each).select(key, "x.n", F.size("x.g").alias("size"), F.explode("x.g").alias("gram"))


def match(words: DataFrame, entries: DataFrame, weights=WEIGHTS, by_length=THRESHOLDS) -> DataFrame:
    """query (a distinct normalised word of words(word)), word_found, key_field,
    header_category, similarity: the best entry, if it reaches its threshold."""
    queries = words.select(normal(F.col("word")).alias("word")).where("word <> ''").distinct()
    mine = _grams(queries.withColumn("q", F.col("word")), "q", weights)
    theirs = _grams(entries, "cand_id", weights).withColumnRenamed("size", "size2")
    few = entries.count() <= 10_000
    held = F.broadcast if few else (lambda df: df)
    shared = mine.join(held(theirs), ["n", "gram"]).groupBy("q", "cand_id", "n", "size", "size2").agg(F.count("*").alias("i"))
    weight = F.element_at(F.create_map(*[F.lit(x) for p in weights.items() for x in p]), F.col("n"))
    lexical = F.sum(F.round(weight * F.col("i") / F.sqrt(F.col("size") * F.col("size2")), 12)) * LEXICAL / sum(weights.values())
    scored = shared.groupBy("q", "cand_id").agg(lexical.alias("similarity")).join(held(entries), "cand_id")
    if "stats" in entries.columns:
        like = cosine(statistics(F.col("q"), *map(F.col, _BOUNDS)), F.col("stats"))
        scored = scored.withColumn("similarity", F.col("similarity") + (1 - LEXICAL) * F.coalesce(like, F.lit(0.0)))
    best = F.row_number().over(W.partitionBy("q").orderBy(F.round("similarity", 9).desc(), "cand_id"))
    top = scored.withColumn("r", best).where("r = 1")
    return top.where(F.round("similarity", 9) >= threshold(F.length("word"), by_length)).select(F.col("q").alias("query"), F.col("word").alias("word_found"), "key_field", "header_category", "similarity")


def header_lines(assigned: DataFrame, entries: DataFrame) -> DataFrame:
    """doc_id, header_line: the topmost line with a word that matches."""
    words = assigned.where("ocr_text IS NOT NULL").withColumn("query", normal(F.col("ocr_text")))
    found = match(words.select(F.col("ocr_text").alias("word")), entries).select("query")
    return words.join(found, "query", "left_semi").groupBy("doc_id").agg(F.min("line_no").alias("header_line"))
