"""Tables from lines: rows are cut into as many columns as the header has words."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geometry import cosine

#: Overlapping words count as this far apart.
TOUCHING = 0.001


def header_before(lines: DataFrame) -> DataFrame:
    """doc_id, header_line: the last line before the first tabular one."""
    first = lines.where("tabular_line").groupBy("doc_id").agg(F.min("line_no").alias("first"))
    return lines.join(first, "doc_id").where("line_no < first").groupBy("doc_id").agg(F.max("line_no").alias("header_line"))


def cells(words: DataFrame, header: DataFrame) -> DataFrame:
    """doc_id, row_id, col_id, text of every cell, empty ones too.

    words(doc_id, line_no, poly_no, ocr_text, box): those of the header line and
    of the rows below it; header(doc_id, header_line). With at least as many words
    as columns, the widest gaps cut the row; a single word goes to the column
    whose header has the likest direction from the origin; fewer words than
    columns fill them from the left."""
    w = words.join(header, "doc_id").where("line_no >= header_line")
    each = w.groupBy("doc_id", "line_no").agg(F.collect_list(F.struct("poly_no", "ocr_text", "xmin", "ymin", "xmax", "ymax")).alias("words"), F.min("header_line").alias("header_line"))
    pages = each.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "words"))).alias("lines"), F.min("header_line").alias("header_line"))
    return page_cells(pages.where(F.get("lines", F.lit(0)).line_no == F.col("header_line")).select("doc_id", F.transform("lines", lambda x: x.words).alias("lines")))


def page_rows(pages: DataFrame) -> DataFrame:
    """doc_id, row_id, texts: the texts of a row's cells, by column. pages(doc_id,
    lines): the words of each line, that of the header first. A row is cut where it
    lies: its words are never dealt out."""
    ordered = lambda ws: F.sort_array(F.transform(ws, lambda x: F.struct(x.xmin.isNull().alias("last"), x.xmin.alias("xmin"), x.poly_no.alias("poly_no"), x.alias("w"))))
    centre = lambda x: F.struct(((x.w.xmin + x.w.xmax) / 2).alias("x"), ((x.w.ymin + x.w.ymax) / 2).alias("y"))
    heads = pages.select("doc_id", "lines", F.transform(ordered(F.get("lines", F.lit(0))), centre).alias("heads"))
    body = heads.select("doc_id", "heads", F.size("heads").alias("h"), F.posexplode_outer("lines").alias("row_id", "ws")).where("row_id > 0")
    body = body.select("doc_id", "row_id", "heads", "h", ordered("ws").alias("ws")).withColumn("lk", F.size("ws"))

    def gap(x, i):
        g = F.get("ws", i + 1).xmin - x.w.xmax
        return F.struct(F.when(g < 0, TOUCHING).otherwise(g).alias("g"), (-i).alias("i"))

    # the widest gaps, of equals the first; each ends a column
    gaps = F.sort_array(F.filter(F.transform("ws", gap), lambda x: x.g.isNotNull()), asc=False)
    ends = F.sort_array(F.transform(F.slice(gaps, F.lit(1), F.col("h") - 1), lambda x: 1 - x.i))
    at = F.get("ws", F.lit(0)).w
    liked = F.transform("heads", lambda x, j: F.struct(F.round(cosine((at.xmin + at.xmax) / 2, (at.ymin + at.ymax) / 2, x.x, x.y), 12).alias("c"), (-j).alias("j")))
    body = body.select("doc_id", "row_id", "h", "lk", F.transform("ws", lambda x: F.coalesce(x.w.ocr_text, F.lit(""))).alias("t"), F.when(F.col("lk") >= F.col("h"), ends).alias("ends"), F.when((F.col("lk") < F.col("h")) & (F.col("lk") == 1), -F.array_max(liked).j).alias("only"))

    def text(j):
        first, last = F.when(j == 0, 0).otherwise(F.get("ends", j - 1)), F.coalesce(F.get("ends", j), F.col("lk"))
        cut = F.array_join(F.slice("t", first + 1, last - first), " ")
        return F.coalesce(F.trim(F.when(F.col("ends").isNotNull(), cut).when(F.col("only").isNotNull(), F.when(F.col("only") == j, F.get("t", F.lit(0)))).otherwise(F.get("t", j))), F.lit(""))

    return body.select("doc_id", "row_id", F.transform(F.sequence(F.lit(0), F.col("h") - 1), text).alias("texts"))


def page_cells(pages: DataFrame) -> DataFrame:
    """The cells of `page_rows`. Of a plain explode Spark infers filters that repeat
    what the lists are made by; none is empty."""
    return page_rows(pages).select("doc_id", "row_id", F.posexplode_outer("texts").alias("col_id", "text"))
