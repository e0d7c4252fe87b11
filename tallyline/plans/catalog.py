"""The registered queries: each takes (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geometry, text
from ..operators import correct, density, keywords, lines, pixels, reconcile, sinks, structure, updates, vectors
from ..sources import fixtures
from ..sources.fixtures import table
from ..sources.shared import written

PAGE_SIZE = 600.0 * 800.0
_ROUND = 6


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places; sums in another order differ beyond."""
    return df.select(*[(F.round(c, _ROUND) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.lines(_assigned(spark, sf))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return written(lines.assign(fixtures.invoices(spark, sf)), "assigned")


def _text_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.word_layout(spark, sf).select("doc_id", "line_no", "word_no", "text", "confidence")


def polygon_bbox_centroid(spark: SparkSession, sf: str) -> DataFrame:
    w = fixtures.word_layout(spark, sf)
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = F.array(p("xmin", "ymin"), p("xmax", "ymin"), p("xmax", "ymax"), p("xmin", "ymax"))
    return w.select("doc_id", "line_no", "word_no", *geometry.box(corners))


def crop_padding(spark: SparkSession, sf: str) -> DataFrame:
    w = fixtures.word_layout(spark, sf)
    x1, x2 = geometry.padded(F.col("xmin"), F.col("xmax"), F.lit(1000))
    y1, y2 = geometry.padded(F.col("ymin"), F.col("ymax"), F.lit(1000))
    boxes = w.select("doc_id", "line_no", "word_no", x1.alias("px1"), x2.alias("px2"), y1.alias("py1"), y2.alias("py2")).where("px2 > px1 AND py2 > py1")
    return boxes.select("*", ((F.col("px1") + F.col("px2")) / 2).alias("pcx"), ((F.col("py1") + F.col("py2")) / 2).alias("pcy"))


def density_encode_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(density.statistics(_text_lines(spark, sf), ["doc_id", "line_no"]))


def morphological_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(vectors.profiles(_words(spark, sf), ["doc_id", "line_no", "word_no"]))


def atomic_vectors(spark: SparkSession, sf: str) -> DataFrame:
    each = vectors.characters(_words(spark, sf), ["doc_id", "line_no", "word_no"])
    return each.groupBy("doc_id", "place").agg(F.count("*").alias("n"), F.sum("code").alias("codes"))


def junk_filter(spark: SparkSession, sf: str) -> DataFrame:
    w = _words(spark, sf)
    return w.where(~text.is_junk(F.col("text"), F.col("confidence"))).select("doc_id", "line_no", "word_no", "text")


def clean_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _words(spark, sf).select("doc_id", "line_no", "word_no", text.clean_token(F.col("text")).alias("cleaned"))


def numeric_parse(spark: SparkSession, sf: str) -> DataFrame:
    cells = fixtures.triples(spark, sf, "documented")
    return _rounded(cells.select("doc_id", "row_id", "col_id", text.is_number(F.col("text")).alias("numeric"), text.number(F.col("text")).alias("value"), text.parsed(F.col("text")).alias("parsed")))


def line_reconstruct(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_lines(spark, sf).select("doc_id", "line_no", "text", "n_words", "xmin", "ymin", "xmax", "ymax", "cx", "cy"))


def line_geometry_features(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(density.geometry(_lines(spark, sf), PAGE_SIZE))


def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(density.scaled(density.features(_lines(spark, sf), PAGE_SIZE)))


def _labels(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    found = _lines(spark, sf)
    return found, density.clusters(density.scaled(density.features(found, PAGE_SIZE)))


def dbscan_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf)[1]


def dbscan_points(spark: SparkSession, sf: str) -> DataFrame:
    """Two dimensions of the vectors of each label, with a core of four points."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    points = table(spark, sf, "embeddings").where("label IS NOT NULL").select(F.col("label").alias("doc_id"), F.col("vec_id").cast("int").alias("line_no"), at(0).alias("x"), at(1).alias("y"))
    return density.clusters(density.scaled(points, ("x", "y")), 0.3, ("x", "y"), 4)


def main_cluster_interval(spark: SparkSession, sf: str) -> DataFrame:
    return density.tabular_interval(_labels(spark, sf)[1])


def tabular_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The whole detector."""
    found, labels = _labels(spark, sf)
    return density.mark_tabular(found, density.tabular_interval(labels)).select("doc_id", "line_no", "tabular_line")


def keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    words = fixtures.invoices(spark, sf).select(F.col("ocr_text").alias("word"))
    return _rounded(keywords.match(words, keywords.lexicon(spark)))


def header_line(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.header_lines(_assigned(spark, sf), keywords.lexicon(spark))


#: Entries of fields with several words, whose statistics count.
FIELD_WORDS = (("subtotal", "subtotal"), ("total", "total"), ("montototal", "total"), ("importetotal", "total"), ("fecha", "date"), ("fechaemision", "date"), ("iva", "tax"), ("folio", "folio"), ("foliofiscal", "folio"))


def keyword_match_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The entries' own words, whole and without one of their letters, against a
    lexicon with statistics."""
    entries = keywords.with_statistics(keywords.lexicon(spark, FIELD_WORDS, ()))
    without = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1), F.substring(F.col("word"), i + 1, F.length("word"))))
    asked = entries.select(F.explode(F.concat(F.array("word"), without)).alias("word"))
    return _rounded(keywords.match(asked, entries).drop("header_category"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    """day and code of every order: dates, tax ids and words, with noise."""
    o = table(spark, sf, "orders")
    at = lambda f: F.date_format("o_orderdate", f)
    days = (at("dd/MM/yyyy"), at("yyyy-MM-dd"), at("d.M.yyyy"), F.concat(F.lit("31/02/"), at("yyyy")), F.concat(F.lit("Fecha: "), at("dd/MM/yyyy")), at("ddMMyyyy"), at("dd-MM-yy"), *map(F.lit, ("fecha", "fxecxxha", "hora de", "hoxxxra", "total")))
    code = lambda a, b: F.concat(F.lit(a), at("yyMMdd"), F.lit(b))
    codes = (code("abcd", "xy1"), code("abc", "x1"), code("abc ", " a"), F.lit("rfc"), F.lit("r.f.c"), F.lit("r..fc"), code("rfc: abc", "xy1"), F.lit("abc"), F.lit("ABCDE-9"), F.lit("R.F.C."))
    pick = lambda xs: F.element_at(F.array(*xs), (F.col("o_orderkey") % len(xs) + 1).cast("int"))
    return o.select("o_orderkey", pick(days).alias("day"), pick(codes).alias("code"))


def regex_search(spark: SparkSession, sf: str) -> DataFrame:
    each = _codes(spark, sf).select("o_orderkey", F.posexplode(F.array("day", "code")).alias("which", "q"))
    return each.select("o_orderkey", "which", text.search(F.col("q")).alias("s")).where("s IS NOT NULL").select("o_orderkey", "which", "s.*")


def rfc_score(spark: SparkSession, sf: str) -> DataFrame:
    return _codes(spark, sf).select("o_orderkey", "code", text.tax_id_score(F.col("code")).alias("score"))


def date_score(spark: SparkSession, sf: str) -> DataFrame:
    return _codes(spark, sf).select("o_orderkey", "day", text.date_score(F.col("day")).alias("score"))


def _table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, lines: the words of the lines of each invoice, its header first. A
    page stays in its row from the boxes on, so nothing is dealt out or written."""
    pages = lines.folded(fixtures.invoice_pages(spark, sf).where("doc_id IS NOT NULL"))
    return pages.select("doc_id", F.transform(lines.spans(), lambda x: F.transform(F.slice("w", x.first + 1, x.n), lambda b: b.box)).alias("lines"))


def structured_cells(spark: SparkSession, sf: str) -> DataFrame:
    return structure.page_cells(_table_pages(spark, sf))


def column_types(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.column_types(fixtures.triples(spark, sf, "documented"))


def role_votes(spark: SparkSession, sf: str) -> DataFrame:
    cells = fixtures.triples(spark, sf, "documented")
    return reconcile.role_votes(cells, reconcile.column_types(cells), "documented")


def role_winner(spark: SparkSession, sf: str) -> DataFrame:
    cells = fixtures.triples(spark, sf, "coded")
    types = reconcile.column_types(cells)
    return reconcile.role_winner(reconcile.role_votes(cells, types, "coded"), types)


def reconcile_coded(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.reconcile(fixtures.triples(spark, sf, "coded"), "coded")


def reconcile_documented(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.reconcile(fixtures.triples(spark, sf, "documented"), "documented", keep_fills=True)


def invoice_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes to lines, to cells, to reconciled cells."""
    return reconcile.reconcile_pages(reconcile.page_tables(structure.page_rows(_table_pages(spark, sf))), "documented")


def detail_payload(spark: SparkSession, sf: str) -> DataFrame:
    cells = fixtures.triples(spark, sf, "documented")
    types = reconcile.column_types(cells)
    winner = reconcile.role_winner(reconcile.role_votes(cells, types, "documented"), types)
    return _rounded(sinks.details(cells, winner))


def recent_records(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.recent(table(spark, sf, "events"), "ts", "event_id").select("event_id", "user_id", "event_type", "value")


def orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.orphans(table(spark, sf, "lineitem"), table(spark, sf, "orders"), "l_orderkey", "o_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


def pixel_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(pixels.statistics(fixtures.pixels(spark, sf)))


def contrast_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(pixels.contrast(pixels.statistics(fixtures.pixels(spark, sf))))


def sharpness_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(pixels.sharpness(fixtures.pixels(spark, sf)))


def salt_pepper(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(pixels.salt_pepper(fixtures.pixels(spark, sf)))


def otsu_binarized(spark: SparkSession, sf: str) -> DataFrame:
    p = fixtures.pixels(spark, sf)
    return pixels.binarized(p, pixels.otsu(p)).groupBy("img_id").agg(F.sum((F.col("v") > 0).cast("long")).alias("light"))


def line_differentials(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(lines.line_differentials(_assigned(spark, sf)))


def polygon_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(lines.polygon_gaps(_assigned(spark, sf)))


def orphan_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of users that are no customer in credit."""
    credit = table(spark, sf, "customer").where("c_acctbal > 0")
    return sinks.orphans(table(spark, sf, "events"), credit, "user_id", "c_custkey").groupBy("event_type").agg(F.count("*").alias("n"))


def record_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as records; those of no known type have the default one."""
    kind = F.when(F.col("o_orderstatus") == "F", "factura").when(F.col("o_orderstatus") == "O", "nota")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("FolioDocumento"), kind.alias("TipoDocumento"), F.col("o_totalprice").alias("MontoTotalDocumento"))
    made = sinks.records(rows).groupBy("TipoDocumento").agg(F.countDistinct("IDRegistro").alias("n"), F.sum("MontoTotalDocumento").cast("double").alias("total"))
    return made.withColumn("total", F.round("total", 2))


def line_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Places and codes of the characters of whole lines."""
    each = vectors.line_characters(fixtures.word_layout(spark, sf), ["doc_id", "line_no"], "xmin")
    return each.groupBy("doc_id", "line_no").agg(F.count("*").alias("n"), F.sum(F.col("place") * F.col("code")).cast("long").alias("weighted"))


def abbreviations(spark: SparkSession, sf: str) -> DataFrame:
    words = _words(spark, sf).select(F.col("text").alias("word")).distinct()
    return words.withColumn("abbreviation", correct.is_abbreviation(F.col("word")))


def header_texts(spark: SparkSession, sf: str) -> DataFrame:
    placed = _assigned(spark, sf)
    header = placed.groupBy("doc_id").agg(F.min("line_no").alias("header_line"))
    return updates.header_texts(placed, header).select("doc_id", F.array_join("header", "|").alias("header"))


def recognised_update(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each line read again, but for every third."""
    w = _words(spark, sf).withColumnRenamed("text", "ocr_text")
    new = F.when(F.col("word_no") % 3 != 0, F.struct(F.concat("ocr_text", F.lit("~")).alias("text"), (F.col("word_no") % 100 + 0.5).cast("double").alias("confidence")))
    lists = w.groupBy("doc_id", "line_no").agg(F.array_sort(F.collect_list(F.struct("word_no", new.alias("new")))).alias("x"))
    results = lists.select("doc_id", "line_no", F.transform("x", lambda x: x.word_no).alias("ids"), F.transform("x", lambda x: x.new).alias("results"))
    return updates.recognised(w, results, ["doc_id", "line_no"], "word_no")


def image_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as images whose sides are made of their ids and urls."""
    name = F.concat(F.lit("page_"), F.col("page_id").cast("string"))
    p = table(spark, sf, "pages").select(
        name.alias("doc_id"), F.concat(name, F.lit(".png")).alias("image_name"), F.lit("png").alias("format"), (F.col("page_id") % 5 * 100).alias("width"), F.length(F.coalesce("url", F.lit(""))).alias("height"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"), F.lit("2024-01-01").alias("date_creation"), F.when(F.col("page_id") % 2 == 0, "L").alias("color"),
    )
    return updates.metadata(p).drop("date_creation")


def correction_candidates(spark: SparkSession, sf: str) -> DataFrame:
    words = fixtures.invoices(spark, sf).select(F.lower("ocr_text").alias("word")).where("word RLIKE '^[a-z]{3,}$'").distinct()
    names = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    heads = keywords.lexicon(spark).select("word")
    return _rounded(correct.candidates(words, names.unionByName(heads)))


def correction_band(spark: SparkSession, sf: str) -> DataFrame:
    words = fixtures.invoices(spark, sf).select(F.lower("ocr_text").alias("word")).where("word RLIKE '^[a-z]{3,}$'")
    return _rounded(correct.band(words, keywords.lexicon(spark)).withColumn("likelihood", F.round(F.log(correct.likelihood(F.col("entry"))), 6)))


QUERIES = {
    f.__name__: f
    for f in (
        reconcile_documented, reconcile_coded, column_types, role_votes, role_winner, detail_payload, numeric_parse, polygon_bbox_centroid, crop_padding,
        density_encode_stats, morphological_profile, atomic_vectors, junk_filter, clean_tokens, line_reconstruct, line_geometry_features, standard_scale,
        dbscan_labels, main_cluster_interval, tabular_lines, keyword_match, header_line, rfc_score, date_score, structured_cells, invoice_tables,
        recent_records, orphan_orders, pixel_stats, contrast_decision, sharpness_decision, salt_pepper, otsu_binarized, line_differentials, polygon_gaps,
        correction_candidates, correction_band, dbscan_points, keyword_match_statistics, regex_search, orphan_events, record_inserts, line_vectors,
        abbreviations, header_texts, recognised_update, image_metadata,
    )
}
