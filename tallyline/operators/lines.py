"""Text lines from word boxes: an ordered fold whose state is the band of the
line so far. It runs inside a page; pages are independent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

OVERLAP = 0.3
FLAT = 1e-5


def grouped(polygons: DataFrame) -> DataFrame:
    """doc_id, boxes: a row a page, whose boxes hold all other columns. Boxes that
    are null belong to no line and go."""
    box = polygons.where("doc_id IS NOT NULL AND ymin IS NOT NULL AND ymax IS NOT NULL")
    return box.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in polygons.columns if c != "doc_id"])).alias("boxes"))


def folded(pages: DataFrame) -> DataFrame:
    """doc_id, w, starts: the boxes (cy, box) of each page (doc_id, boxes) in order,
    and where in them a line begins: words in order of their centres' y (then
    poly_no) stay in a line while they overlap its mean band by more than OVERLAP
    of the lower of both heights."""
    words = pages.select("doc_id", F.sort_array(F.transform("boxes", lambda x: F.struct(((x.ymin + x.ymax) / 2).alias("cy"), x.poly_no.alias("poly_no"), x.alias("box")))).alias("w"))

    def step(a, e):
        # sums, not means, are the state: y0 and y1 are sums over the line's n words
        x, top, bottom = e.box, a.y0 / a.n, a.y1 / a.n
        low = F.least(bottom - top, x.ymax - x.ymin)
        joins = (low > FLAT) & (F.greatest(F.lit(0.0), F.least(bottom, x.ymax) - F.greatest(top, x.ymin)) > OVERLAP * low)
        state = lambda starts, n, y0, y1: F.struct(starts.alias("starts"), (a.i + 1).alias("i"), n.alias("n"), y0.alias("y0"), y1.alias("y1"))
        # the first word finds a band without height, which nothing joins
        return F.when(joins, state(a.starts, a.n + 1, a.y0 + x.ymin, a.y1 + x.ymax)).otherwise(state(F.concat(a.starts, F.array(a.i)), F.lit(1), x.ymin, x.ymax))

    start = F.expr("named_struct('starts', cast(array() AS array<int>), 'i', 0, 'n', 1, 'y0', 0D, 'y1', 0D)")
    return words.select("doc_id", "w", F.aggregate("w", start, step, lambda a: a.starts).alias("starts"))


def spans() -> Column:
    """The lines of `folded` pages: first and n, the place of their first word and
    how many they have."""
    return F.transform("starts", lambda s, i: F.struct(s.alias("first"), (F.coalesce(F.get("starts", i + 1), F.size("w")) - s).alias("n")))


def assign(polygons: DataFrame) -> DataFrame:
    """The polygons with line_no from 1 and the place in the line, as `folded` finds
    them. The columns travel with the words of the page: nothing is joined back."""
    # of a plain explode Spark infers filters that repeat the fold; no list here is empty
    cut = folded(grouped(polygons)).select("doc_id", "w", F.posexplode_outer(spans()).alias("line_no", "line"))
    members = cut.select("doc_id", (F.col("line_no") + 1).alias("line_no"), F.posexplode_outer(F.expr("slice(w, line.first + 1, line.n)")).alias("place", "p")).where("p.poly_no IS NOT NULL")
    return members.select("doc_id", "p.box.poly_no", "line_no", "place", *[f"p.box.{c}" for c in polygons.columns if c not in ("doc_id", "poly_no")])


def lines(assigned: DataFrame) -> DataFrame:
    """A row a line: text of the words in their order, poly_nos, extent in x and
    mean band in y, and the centre."""
    each = assigned.groupBy("doc_id", "line_no").agg(
        F.array_sort(F.collect_list(F.struct("place", "poly_no", F.coalesce("ocr_text", F.lit("")).alias("t")))).alias("w"),
        F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.avg("ymin").alias("ymin"), F.avg("ymax").alias("ymax"),
    )
    return each.select(
        "doc_id", "line_no", F.format_string("line_%04d", "line_no").alias("line_id"), F.trim(F.array_join(F.transform("w", lambda x: x.t), " ")).alias("text"),
        F.transform("w", lambda x: x.poly_no).alias("poly_nos"), F.size("w").alias("n_words"), "xmin", "ymin", "xmax", "ymax",
        ((F.col("xmin") + F.col("xmax")) / 2).alias("cx"), ((F.col("ymin") + F.col("ymax")) / 2).alias("cy"),
    )


def polygon_gaps(assigned: DataFrame) -> DataFrame:
    """Distance to the next word of the line, 0 for the last; and the angles of
    the word's centre."""
    nxt = F.lead("xmin").over(W.partitionBy("doc_id", "line_no").orderBy("xmin", "poly_no"))
    cx, cy = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    return assigned.select("doc_id", "line_no", "poly_no", F.coalesce(nxt - F.col("xmax"), F.lit(0.0)).alias("gap"), F.atan2(cy, cx).alias("angle_x"), F.atan2(cx, cy).alias("angle_y"))


def line_differentials(assigned: DataFrame) -> DataFrame:
    """Extent of each line and its distance to the next."""
    each = assigned.groupBy("doc_id", "line_no").agg(F.avg("ymin").alias("top"), F.avg("ymax").alias("bottom"), F.min("xmin").alias("left"), F.max("xmax").alias("right"))
    nxt = F.lead("top").over(W.partitionBy("doc_id").orderBy("line_no"))
    return each.withColumn("to_next", F.coalesce(nxt - F.col("bottom"), F.lit(0.0)))
