"""Correction of words against a dictionary, with costs of a scanner's mistakes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

# What it costs to read one character for the other; pairs of more
# than one character are never met by a comparison of single ones.
CONFUSED = {
    ("0", "o"): 0.3, ("1", "l"): 0.3, ("1", "i"): 0.3, ("5", "s"): 0.3, ("6", "g"): 0.3, ("8", "b"): 0.3, ("9", "g"): 0.3,
    ("c", "e"): 0.4, ("n", "m"): 0.4, ("u", "v"): 0.4,
}
CHEAPEST = 0.3
NEAREST, MOST, SURE = 5, 2.0, 1.5
#: Texts under this confidence are corrected.
LOW_CONFIDENCE = 70.0
# Shares of letters in Spanish text; others have RARE.
LETTERS = {
    "e": 0.1368, "a": 0.1253, "o": 0.0868, "i": 0.0625, "s": 0.0798, "n": 0.0671, "r": 0.0687, "u": 0.0393, "l": 0.0497,
    "t": 0.0463, "d": 0.0586, "c": 0.0468, "p": 0.0251, "m": 0.0315, "b": 0.0142, "g": 0.0101, "y": 0.0109, "f": 0.0070,
    "v": 0.0090, "k": 0.0002, "h": 0.0070, "q": 0.0088, "j": 0.0044, "x": 0.0022, "z": 0.0052, "w": 0.0001,
}
RARE = 0.001
# Abbreviations of products, and forms of abbreviations and codes.
SHORT = (
    "kg", "cm", "mm", "m", "l", "ml", "g", "mg", "oz", "lb", "pz", "pcs", "tl", "tlf", "tel", "fax", "cel", "mob", "sk", "sku", "upc",
    "pal", "red", "delg", "punt", "clav", "torn", "tuerc", "arand", "caja", "bols", "paq", "unid", "doc", "docena", "caj",
)
CODE_FORMS = (
    r"^[a-z]+[0-9]+$", r"^[0-9]+[a-z]+$", r"^[a-z]+/[a-z0-9]+$", r"^[a-z]+\.[a-z\.]*$", r"^[0-9]+x[0-9]+$", r"^[a-z]{1,2}[0-9]{1,2}$",
    r"^[a-z]+[0-9]+[a-z]*$", r"^[0-9]+[a-z]+[0-9]*$", r"^[a-z]+[0-9]+[a-z]+$",
)
# What a character is often read as.
READ_AS = {
    "a": "oe", "o": "ae", "e": "ao", "i": "l1", "l": "i1", "1": "il", "n": "mh", "m": "nh", "h": "nm", "r": "nm", "u": "vw", "v": "uw",
    "s": "5f", "5": "sf", "f": "s5", "t": "7f", "7": "tf", "g": "9q", "9": "gq", "q": "g9", "z": "2s", "2": "zs", "b": "8h", "8": "bh",
    "c": "eo", "d": "bp", "p": "bd",
}
# Endings of verbs, and of their infinitives.
ENDINGS = ("ar", "er", "ir", "ando", "endo", "ado", "ido", "aba", "ía", "ará", "erá", "irá", "aste", "iste")
INFINITIVES = ("ar", "er", "ir")


def weighted_distance(a: str, b: str) -> float:
    """Edit distance in which confusable characters are cheap to swap."""
    row = [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], float(i)
        for j, y in enumerate(b, 1):
            swap = 0.0 if x == y else CONFUSED.get((x, y), CONFUSED.get((y, x), 1.0))
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + swap)
    return row[-1]


def _distances(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def likelihood(word: Column) -> Column:
    """Product of the letters' shares."""
    shares = F.create_map(*[F.lit(x) for p in LETTERS.items() for x in p])
    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(1.0), lambda a, c: a * F.coalesce(F.try_element_at(shares, c), F.lit(RARE)))


def band(words: DataFrame, dictionary: DataFrame, width: int = 2) -> DataFrame:
    """word, entry: pairs whose lengths differ by at most width. An equi-join on
    length, each word under every length that it may meet."""
    mine = words.select("word").distinct().withColumn("n", F.explode(F.sequence(F.length("word") - width, F.length("word") + width)))
    return mine.join(dictionary.select(F.col("word").alias("entry"), F.length("word").alias("n")), "n").drop("n")


def candidates(words: DataFrame, dictionary: DataFrame, most: float = MOST) -> DataFrame:
    """word, entry, distance, score and rank of the NEAREST entries within most;
    likelier entries score as a little nearer. No change costs less than CHEAPEST,
    so the plain distance rules most pairs out before the weighted one is computed."""
    distance = F.pandas_udf(_distances, "double")  # made here: workers import this module without a session
    bound = int(most / CHEAPEST)
    met = band(words, dictionary.select("word").distinct()).where(F.levenshtein(F.lower("word"), "entry", bound) >= 0)
    near = met.withColumn("distance", distance(F.lower("word"), "entry")).where(F.round("distance", 9) <= most)
    scored = near.withColumn("score", F.col("distance") - 0.1 * likelihood(F.col("entry")))
    rank = F.row_number().over(W.partitionBy("word").orderBy(F.round("score", 9), "entry"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= NEAREST)


def is_abbreviation(word: Column) -> Column:
    """A listed abbreviation, a form of a code, no vowels, or a capital beside a
    small letter."""
    low = F.lower(word)
    found = low.isin(*SHORT) | ~low.rlike("[aeiouáéíóúü]") | word.rlike("[a-z][A-Z]|[A-Z][a-z]")
    for form in CODE_FORMS:
        found = found | low.rlike(form)
    return found


def variations(word: Column) -> Column:
    """The words that one misread character makes of it, in order."""
    pairs = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, ys in READ_AS.items() for y in ys])
    one = lambda i: F.transform(F.filter(pairs, lambda p: p.a == F.substring(word, i, F.lit(1))), lambda p: F.concat(F.substring(word, F.lit(1), i - 1), p.b, F.substring(word, i + 1, F.length(word))))
    none = F.expr("cast(array() AS array<string>)")
    return F.when(F.length(word) > 0, F.flatten(F.transform(F.sequence(F.lit(1), F.length(word)), one))).otherwise(none)


def lemmas(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """word, lemma: the infinitive of the dictionary that a word's ending, the
    longest first, leads to; else the word, lower-case. Words of the dictionary are
    their own lemmas."""
    each = words.select("word").distinct().withColumn("low", F.lower("word"))
    forms = sorted(((e, i) for e in ENDINGS for i in INFINITIVES), key=lambda x: (-len(x[0]), ENDINGS.index(x[0]), INFINITIVES.index(x[1])))
    made = [
        F.when(F.endswith("low", F.lit(e)) & (F.length("low") > len(e) + 2), F.struct(F.lit(k).alias("k"), F.concat(F.expr(f"left(low, length(low) - {len(e)})"), F.lit(i)).alias("verb")))
        for k, (e, i) in enumerate(forms)
    ]
    own = dictionary.select(F.col("word").alias("verb")).distinct()
    tried = each.select("word", F.explode(F.array_compact(F.array(F.struct(F.lit(-1).alias("k"), F.col("low").alias("verb")), *made))).alias("x")).select("word", "x.k", "x.verb")
    best = tried.join(own, "verb").groupBy("word").agg(F.min(F.struct("k", "verb")).alias("best"))
    return each.join(best, "word", "left").select("word", F.coalesce("best.verb", "low").alias("lemma"))


def correct(words: DataFrame, dictionary: DataFrame, names: DataFrame | None = None, sure: float = SURE) -> DataFrame:
    """word, corrected, changed: abbreviations, words and names of the dictionaries,
    and words whose lemma is one, stay; others become their nearest entry if its
    score is at most sure."""
    every = words.select("word").distinct()
    held = dictionary.select("word") if names is None else dictionary.select("word").unionByName(names.select("word"))
    entries = dictionary.select(F.col("word").alias("lemma")).distinct()
    stays = every.where(is_abbreviation(F.col("word")))
    stays = stays.unionByName(every.join(held.select(F.col("word").alias("low")).distinct(), F.lower("word") == F.col("low"), "left_semi"))
    stays = stays.unionByName(lemmas(every, dictionary).join(entries, "lemma", "left_semi").select("word"))
    best = candidates(every.join(stays.distinct(), "word", "left_anti"), dictionary).where((F.col("rank") == 1) & (F.round("score", 9) <= sure)).select("word", "entry")
    done = every.join(best, "word", "left").select("word", F.coalesce("entry", "word").alias("corrected"))
    return done.withColumn("changed", F.col("corrected") != F.col("word"))


def correct_texts(texts: DataFrame, dictionary: DataFrame, names: DataFrame | None = None, low: float = LOW_CONFIDENCE) -> DataFrame:
    """key, text, corrected, original_length, corrected_length, text_changed of
    texts(key, text, confidence). Texts of a confidence under low are corrected word
    by word, with one space between words; others stay as they are. Keys are unique."""
    unsure = texts.where(F.col("confidence") < low)
    split = F.filter(F.split(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")), " "), lambda w: w != "")
    words = unsure.select("key", F.posexplode(split).alias("i", "word"))
    fixed = words.join(correct(words, dictionary, names).select("word", "corrected"), "word")
    joined = fixed.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "corrected"))), lambda x: x.corrected), " ").alias("done"))
    corrected = F.coalesce("done", "text", F.lit(""))
    out = texts.join(joined, "key", "left").select("key", "text", corrected.alias("corrected"))
    return out.select("*", F.length(F.coalesce("text", F.lit(""))).alias("original_length"), F.length("corrected").alias("corrected_length"), (F.col("corrected") != F.coalesce("text", F.lit(""))).alias("text_changed"))
