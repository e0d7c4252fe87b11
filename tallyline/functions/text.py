"""Column functions on recognised text: codes of characters, numbers, clean-up,
n-grams, and scores of tax ids and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A character's code is its place in this string.
DENSITY = (
    "0123456789"
    ".,$¢/#°()%—<>+-=*^\";\\|[]{}@&_¿?¡!~`':©®™"
    "ÓÁÚÜÑWXZYQUKHOGFLJEVTIRMNSBDPCA"
    "wküúyxñóqjévfzhígápbudmltcnoisrae"
)
MAX_CODE = 113
#: Words under this confidence stay only if they look like numbers or codes.
MIN_CONFIDENCE = 70.0
#: A column is quantitative from this share of number-like cells on.
NUMERIC_RATIO = 0.6
# Letters with accents, and without.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"
NUMBER = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
NAMED = r"^[+-]?(nan|inf|infinity)$"


def compact(text: Column) -> Column:
    """text without any white space, no-break spaces included."""
    return F.regexp_replace(text, r"(?U)\s+", "")


#: Private letters that stand for the codes while a text is encoded; a text's own
#: become one that stands for none.
_CODED = 0xE000
_LETTERS = "".join(chr(_CODED + i) for i in range(len(DENSITY)))
_NO_LETTER = chr(_CODED + 0xFF)
#: Types by code: digits' to 9, marks' to 55, letters'.
_TYPES = "".join("n" if i <= 9 else "e" if i <= 55 else "a" for i in range(len(DENSITY)))


def encode(text: Column, unknown: int = 0) -> Column:
    """Codes of the characters of text."""
    chars = F.filter(F.split(F.translate(compact(text), DENSITY + _LETTERS, _LETTERS + _NO_LETTER * len(_LETTERS)), ""), lambda c: c != "")
    code = lambda c: F.ascii(c) - _CODED
    return F.transform(chars, lambda c: F.when(code(c).between(0, MAX_CODE), code(c)).otherwise(unknown))


def types(text: Column) -> Column:
    """A string of the types of the characters of text: n, e or a; unknown ones have
    code 0 and are n."""
    return F.regexp_replace(F.translate(compact(text), DENSITY, _TYPES), "(?s)[^nea]", "n")


def stripped(value: Column) -> Column:
    """value without $ , % and spaces."""
    return F.regexp_replace(value, r"[$,% ]", "")


def is_number(value: Column) -> Column:
    """Whether the stripped value reads as a number."""
    s = F.trim(stripped(value))
    return F.coalesce(s.rlike(NUMBER) | F.lower(s).rlike(NAMED), F.lit(False))


def number(value: Column) -> Column:
    """The stripped value as a double; null for other texts and for nan."""
    s = F.trim(stripped(value))
    plain = F.when(s.rlike(NUMBER), F.regexp_replace(s, "_", "").cast("double"))
    return F.when(F.lower(s).rlike(r"^[+]?inf(inity)?$"), F.lit(float("inf"))).when(F.lower(s).rlike(r"^-inf(inity)?$"), F.lit(float("-inf"))).otherwise(plain)


def parsed(value: Column) -> Column:
    """A cell of a payload: without commas; a number, else null."""
    s = F.regexp_replace(F.trim(value), ",", "")
    return F.when(s.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"), s.cast("double"))


def formatted(value: Column | str, pattern: str) -> Column:
    """A number by a decimal pattern; halves as they are in binary."""
    return F.call_function("format_number", F.col(value) if isinstance(value, str) else value, F.lit(pattern))


def money(value: Column) -> Column:
    """Whole numbers without decimals, others with two."""
    return F.when(value == F.floor(value), formatted(value, "0")).otherwise(formatted(value, "0.00"))


def looks_coded(text: Column) -> Column:
    return text.rlike("[0-9]") | text.isin("$", "€", "£")


def is_junk(text: Column, confidence: Column) -> Column:
    """Empty; unsure and unlike a number or code; or marks alone."""
    t = F.coalesce(text, F.lit(""))
    return (F.trim(t) == "") | ((F.coalesce(confidence, F.lit(0.0)) < MIN_CONFIDENCE) & ~looks_coded(t)) | t.rlike(r"^[\s.\-_,;:]+$")


def clean_token(token: Column) -> Column:
    """Marks other than . and , go; one of ` ' ´ , between digits is a point."""
    dotted = F.regexp_replace(token, r"(?<=[0-9])[`'´,](?=[0-9])", ".")
    return F.regexp_replace(dotted, r"(?U)[^\w\s.,]", "")


def normal(word: Column) -> Column:
    """Lower case, without accents, letters and digits alone."""
    return F.regexp_replace(F.translate(F.lower(F.trim(word)), ACCENTED, PLAIN), "[^a-z0-9]", "")


def grams(word: Column, n: int) -> Column:
    """The distinct runs of n characters; none in shorter words."""
    none = F.expr("cast(array() AS array<string>)")
    return F.when(F.length(word) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, F.lit(n))))).otherwise(none)


def tax_id_score(text: Column) -> Column:
    """How surely noisy text (lower case) holds a tax id, or is the word that
    announces one: by its length, then by patterns that are searched in it."""
    t = F.coalesce(text, F.lit(""))
    size = F.length(t)
    held = t.rlike(r"(?id)[a-z]{3,5}[0-9]{5,7}[a-z0-9]{2,4}") | t.rlike(r"(?id)[a-z]{3,4}.*[0-9]{4,6}.*[a-z0-9]{1,3}")
    whole = F.when(t.rlike(r"^[a-z]{4}[0-9]{6}[a-z0-9]{3}"), 0.95).when(size <= 15, 0.85).otherwise(0.75)
    word = F.when(t.rlike(r"(?d)\Ar.?f.?c\z"), 0.8).otherwise(0.7)
    return F.when((size >= 10) & held, whole).when(size.between(2, 5) & t.rlike(r"(?id)r.{0,2}f.{0,2}c"), word).otherwise(0.0)


#: Date formats: parts of a day, month, year of four or two digits, and what is
#: between them; parts are read from the left, as far as they match.
DATES = ("d/m/Y", "d-m-Y", "d.m.Y", "d/m/y", "d-m-y", "d.m.y", "Y/m/d", "Y-m-d", "Y.m.d", "dmY", "dmy")
_PARTS = {"d": "(3[0-1]|[1-2][0-9]|0[1-9]|[1-9])", "m": "(1[0-2]|0[1-9]|[1-9])", "Y": "([0-9]{4})", "y": "([0-9]{2})", ".": "[.]"}
DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
#: Words that announce a date or time, with noise; the last one stands for either.
ANNOUNCING = ("f.{0,2}e.{0,2}c.{0,2}h.{0,2}a", "h.{0,2}o.{0,2}r.{0,2}a", "[fh].{0,3}[eo].{0,3}[cr].{0,3}[ha]")


def _is_date(text: Column, form: str) -> Column:
    pattern = "^" + "".join(_PARTS.get(c, c) for c in form)
    order = [c for c in form if c in "dmYy"]
    part = {c.lower(): F.try_to_number(F.nullif(F.regexp_extract(text, pattern, k + 1), F.lit("")), F.lit("9999")).cast("int") for k, c in enumerate(order)}
    d, m, y = part["d"], part["m"], part["y"]
    # a year of two digits is a leap year where 1900 + it or 2000 + it is; only 00 differs
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    exists = (d <= F.element_at(F.array(*map(F.lit, DAYS)), F.coalesce(m, F.lit(1)))) & ((m != 2) | (d < 29) | leap)
    whole = F.regexp_extract(text, pattern, 0) == text
    return F.coalesce((text != "") & whole & exists & ((y > 0) if "Y" in form else F.lit(True)), F.lit(False))


def date_score(text: Column) -> Column:
    """0.95 for a text whose digits and / - . are a date in one of DATES; less for
    a word that announces a date or time; else 0."""
    t = F.coalesce(text, F.lit(""))
    clean = F.regexp_replace(t, r"[^0-9/\-.]", "")
    any_date = F.lit(False)
    for form in DATES:
        any_date = any_date | _is_date(clean, form)
    score = F.when(any_date, 0.95)
    for word in ANNOUNCING[:2]:
        near = rf"(?d)\A{word.replace('{0,2}', '{0,1}')}\z"
        score = score.when(t.rlike(f"(?id){word}"), F.when(t.rlike(near), 0.85).otherwise(0.75))
    return score.when(t.rlike(f"(?id){ANNOUNCING[2]}"), 0.7).otherwise(0.0)


def search(text: Column) -> Column:
    """What text is by patterns alone: a struct of field, word_found, similarity,
    query and method, of a tax id before a date; null where it is neither, or shorter
    than two characters."""
    tax, date = tax_id_score(text), date_score(text)
    word = (
        F.when(date == 0.95, "fecha")
        .when(text.rlike(f"(?id){ANNOUNCING[0]}"), "fecha")
        .when(text.rlike(f"(?id){ANNOUNCING[1]}") | text.rlike("(?d)h.*o.*r"), "hora")
        .otherwise("fecha")
    )
    found = lambda field, word, score, method: F.struct(F.lit(field).alias("field"), word.alias("word_found"), score.alias("similarity"), text.alias("query"), F.lit(method).alias("method"))
    id_word = F.when(F.length(text) <= 5, "rfc").otherwise("registrofederaldecontribuyentes")
    long = F.length(text) >= 2
    return F.when(long & (tax > 0), found("RFCProveedor", id_word, tax, "regex_rfc")).when(long & (date > 0), found("FechaDocumento", word, date, "regex_fecha"))


def number_or(value: Column, default: float = 0.0) -> Column:
    """The value as a double, default where it reads as none."""
    return F.coalesce(value.try_cast("double"), F.lit(default))
