"""Arithmetic reconciliation: which columns are quantity, unit price and amount,
and cells that make quantity times price equal amount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.geometry import close
from ..functions.text import NUMERIC_RATIO, is_number, money, number
from ..sources.shared import written

TOLERANCE = 0.05
ROLES = ("c", "pu", "mtl")


def valued(cells: DataFrame) -> DataFrame:
    """cells with v, the number in the text, and numeric; as they are if they have
    them already."""
    if "v" in cells.columns:
        return cells
    return cells.select("doc_id", "row_id", "col_id", "text", number(F.col("text")).alias("v"), is_number(F.col("text")).alias("numeric"))


def column_types(cells: DataFrame, ratio: float = NUMERIC_RATIO) -> DataFrame:
    """doc_id, col_id, semantic_type, q: the place among quantitative columns."""
    each = valued(cells).groupBy("doc_id", "col_id").agg(F.avg(F.col("numeric").cast("double")).alias("share"))
    typed = each.withColumn("semantic_type", F.when(F.col("share") >= ratio, "cuantitativo").otherwise("texto"))
    place = F.row_number().over(W.partitionBy("doc_id", "semantic_type").orderBy("col_id"))
    return typed.select("doc_id", "col_id", "semantic_type", F.when(F.col("semantic_type") == "cuantitativo", place).alias("q"))


def valid(c: Column, pu: Column, mtl: Column, axioms: str) -> Column:
    """Whether a row's three values can play the roles. coded: the amount is at
    most the price; documented: at least. Either way it is no less than quantity
    times price, within TOLERANCE."""
    ordered = pu >= mtl if axioms == "coded" else mtl >= pu
    return (c > 0) & (pu > 0) & (mtl > 0) & (mtl >= c * pu) & ordered & close(c * pu, mtl, TOLERANCE)


def role_votes(cells: DataFrame, types: DataFrame, axioms: str = "coded") -> DataFrame:
    """doc_id, c, pu, mtl (column ids), score. A row with one valid assignment
    gives it a vote, one with two gives each half a vote, one with more none."""
    values = valued(cells).where("v IS NOT NULL").join(types.where("q IS NOT NULL").select("doc_id", "col_id"), ["doc_id", "col_id"]).select("doc_id", "row_id", "col_id", "v")
    # a row's values lie in one array: no join is needed to pair them
    rows = values.groupBy("doc_id", "row_id").agg(F.array_sort(F.collect_list(F.struct("col_id", "v"))).alias("a"))
    c = rows.select("doc_id", "row_id", "a", F.explode("a").alias("c"))
    pu = c.select("doc_id", "row_id", "a", "c", F.explode("a").alias("pu")).where("pu.col_id <> c.col_id")
    all3 = pu.select("doc_id", "row_id", "c", "pu", F.explode("a").alias("mtl")).where("mtl.col_id NOT IN (c.col_id, pu.col_id)")
    fits = all3.where(valid(F.col("c.v"), F.col("pu.v"), F.col("mtl.v"), axioms))
    n = F.count("*").over(W.partitionBy("doc_id", "row_id"))
    voted = fits.withColumn("vote", F.when(n == 1, 1.0).when(n == 2, 0.5).otherwise(0.0))
    return voted.groupBy("doc_id", *[F.col(f"{r}.col_id").alias(r) for r in ROLES]).agg(F.sum("vote").alias("score"))


def role_winner(votes: DataFrame, types: DataFrame) -> DataFrame:
    """The assignment with the most votes of each document with three or more
    quantitative columns; of equals the first by columns."""
    enough = types.groupBy("doc_id").agg(F.max("q").alias("n")).where("n >= 3").select("doc_id")
    best = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("score"), *ROLES))
    return votes.where("score > 0").join(enough, "doc_id", "left_semi").withColumn("r", best).where("r = 1").drop("r")


def corrected(cells: DataFrame, types: DataFrame, winner: DataFrame, keep_fills: bool = False) -> DataFrame:
    """doc_id, row_id, col_id, text. Where one of three values is missing it
    follows from the others; where all are there but disagree, the one farthest
    from its column's median does. keep_fills=False puts the original text back
    into cells that were no numbers. Documents without a winner stay as they are."""
    cells = valued(cells)
    quant = cells.join(types.where("q IS NOT NULL").select("doc_id", "col_id"), ["doc_id", "col_id"]).join(winner, "doc_id")
    role = F.when(F.col("col_id") == F.col("c"), "c").when(F.col("col_id") == F.col("pu"), "pu").when(F.col("col_id") == F.col("mtl"), "mtl")
    placed = quant.withColumn("role", role)
    wide = placed.groupBy("doc_id", "row_id").agg(*[F.max(F.when(F.col("role") == r, F.col("v"))).alias(f"v_{r}") for r in ROLES])
    medians = placed.groupBy("doc_id").agg(*[F.percentile(F.when(F.col("role") == r, F.col("v")), F.lit(0.5)).alias(f"m_{r}") for r in ROLES])
    c, pu, mtl = (F.col(f"v_{r}") for r in ROLES)
    off = {r: F.abs(F.col(f"v_{r}") - F.col(f"m_{r}")) for r in ROLES}
    most = F.greatest(*off.values())
    broken = c.isNotNull() & pu.isNotNull() & mtl.isNotNull() & ~close(c * pu, mtl, TOLERANCE)
    moves_c = broken & (most == off["c"]) & (pu != 0)
    moves_pu = broken & ~moves_c & (most == off["pu"]) & (c != 0)
    fixed = wide.join(medians, "doc_id").select(
        "doc_id", "row_id",
        F.when(moves_c | c.isNull(), F.coalesce(F.try_divide(mtl, pu), c)).otherwise(c).alias("c"),
        F.when(moves_pu | pu.isNull(), F.coalesce(F.try_divide(mtl, c), pu)).otherwise(pu).alias("pu"),
        F.when((broken & ~moves_c & ~moves_pu) | mtl.isNull(), F.coalesce(c * pu, mtl)).otherwise(mtl).alias("mtl"),
    )
    long = fixed.select("doc_id", "row_id", F.expr("stack(3, 'c', c, 'pu', pu, 'mtl', mtl) AS (role, fixed)"))
    done = placed.join(long, ["doc_id", "row_id", "role"], "left").select("doc_id", "row_id", "col_id", F.coalesce("fixed", F.when(F.col("role").isNull(), F.col("v"))).alias("value"))
    out = cells.join(done, ["doc_id", "row_id", "col_id"], "left")
    stays = F.col("value").isNull() if keep_fills else F.col("value").isNull() | ~F.col("numeric")
    return out.select("doc_id", "row_id", "col_id", F.when(stays, F.col("text")).otherwise(money(F.col("value"))).alias("text"))


def semantic_types(types: DataFrame, winner: DataFrame) -> DataFrame:
    """doc_id, col_id, semantic_type, with the roles."""
    named = types.join(winner, "doc_id", "left")
    role = F.when(F.col("col_id") == F.col("c"), ", c").when(F.col("col_id") == F.col("pu"), ", pu").when(F.col("col_id") == F.col("mtl"), ", mtl").otherwise("")
    return named.select("doc_id", "col_id", F.concat("semantic_type", role).alias("semantic_type"))


def reconcile(cells: DataFrame, axioms: str = "coded", keep_fills: bool = False) -> DataFrame:
    """All of the above. The parsed cells, the types and the roles are read more
    than once, so they are written where they are made."""
    cells = written(valued(cells), "valued")
    types = written(column_types(cells), "types")
    winner = written(role_winner(role_votes(cells, types, axioms), types), "roles")
    return corrected(cells, types, winner, keep_fills)


def page_tables(rows: DataFrame) -> DataFrame:
    """doc_id, rows(row_id, cells(col_id, text, v, numeric)): a row a document.
    rows(doc_id, row_id, texts): the texts of a row's cells, by column."""
    cells = F.transform("texts", lambda t, j: F.struct(j.alias("col_id"), t.alias("text"), number(t).alias("v"), is_number(t).alias("numeric")))
    return rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("row_id", cells.alias("cells")))).alias("rows"))


def reconcile_pages(tables: DataFrame, axioms: str = "coded", keep_fills: bool = False) -> DataFrame:
    """`reconcile` of tables as `page_tables` makes them: types, votes, roles and
    corrections of a document are found inside its row, so cells are not dealt out
    once a step and nothing is written."""
    flat = tables.select("doc_id", "rows", F.flatten(F.transform("rows", lambda r: r.cells)).alias("flat"))

    def share(j):
        column = F.filter("flat", lambda x: x.col_id == j)
        return F.size(F.filter(column, lambda x: x.numeric)) / F.size(column)

    columns = F.sort_array(F.array_distinct(F.transform("flat", lambda x: x.col_id)))
    quant = flat.select("doc_id", "rows", "flat", F.filter(columns, lambda j: share(j) >= NUMERIC_RATIO).alias("quant"))

    def votes(r):
        values = lambda: F.filter(r.cells, lambda x: x.v.isNotNull() & F.array_contains("quant", x.col_id))
        fits = lambda c, pu, m: (c.col_id != pu.col_id) & ~m.col_id.isin(c.col_id, pu.col_id) & valid(c.v, pu.v, m.v, axioms)
        triple = lambda c, pu, m: F.struct(c.col_id.alias("c"), pu.col_id.alias("pu"), m.col_id.alias("mtl"))
        return F.flatten(F.transform(values(), lambda c: F.flatten(F.transform(values(), lambda pu: F.transform(F.filter(values(), lambda m: fits(c, pu, m)), lambda m: triple(c, pu, m))))))

    voted = quant.select("*", F.when(F.size("quant") >= 3, F.transform("rows", votes)).alias("fits"))
    # rows with more than two assignments have no vote; a vote is counted in halves
    halves = F.flatten(F.transform(F.filter("fits", lambda x: F.size(x) <= 2), lambda x: F.when(F.size(x) == 1, F.concat(x, x)).otherwise(x)))
    voted = voted.select("doc_id", "rows", "flat", "quant", halves.alias("halves"))
    best = F.transform(F.array_distinct("halves"), lambda t: F.struct((-F.size(F.filter("halves", lambda x: x == t))).alias("score"), t.c.alias("c"), t.pu.alias("pu"), t.mtl.alias("mtl")))
    won = voted.select("doc_id", "rows", "flat", "quant", F.array_min(best).alias("w"))

    def median(role):
        v = lambda: F.sort_array(F.transform(F.filter("flat", lambda x: (x.col_id == F.col("w")[role]) & x.v.isNotNull()), lambda x: x.v))
        middle = lambda vs: F.slice(vs, F.floor((F.size(vs) + 1) / 2).cast("int"), 2 - F.size(vs) % 2)
        return F.transform(F.array(middle(v())), lambda m: F.when(F.element_at(m, 1) == F.element_at(m, -1), F.element_at(m, 1)).otherwise(0.5 * F.element_at(m, 1) + 0.5 * F.element_at(m, -1)))

    medians = F.struct(*[F.get(median(r), F.lit(0)).alias(r) for r in ROLES])
    won = won.select("doc_id", "rows", "quant", "w", F.when(F.col("w").isNotNull(), medians).alias("m"))

    def value(r, role):
        return F.array_max(F.transform(F.filter(r.cells, lambda x: x.col_id == F.col("w")[role]), lambda x: x.v)).alias(role)

    def fixed(x):
        c, pu, mtl = x.c, x.pu, x.mtl
        off = {k: F.abs(x[k] - F.col("m")[k]) for k in ROLES}
        most = F.greatest(*off.values())
        broken = c.isNotNull() & pu.isNotNull() & mtl.isNotNull() & ~close(c * pu, mtl, TOLERANCE)
        moves_c = broken & (most == off["c"]) & (pu != 0)
        moves_pu = broken & ~moves_c & (most == off["pu"]) & (c != 0)
        return F.struct(
            x.row_id.alias("row_id"), x.cells.alias("cells"),
            F.when(moves_c | c.isNull(), F.coalesce(F.try_divide(mtl, pu), c)).otherwise(c).alias("c"),
            F.when(moves_pu | pu.isNull(), F.coalesce(F.try_divide(mtl, c), pu)).otherwise(pu).alias("pu"),
            F.when((broken & ~moves_c & ~moves_pu) | mtl.isNull(), F.coalesce(c * pu, mtl)).otherwise(mtl).alias("mtl"),
        )

    wide = F.transform("rows", lambda r: F.struct(r.row_id.alias("row_id"), r.cells.alias("cells"), *[value(r, k) for k in ROLES]))
    done = won.select("doc_id", "quant", "w", F.transform(wide, fixed).alias("rows"))

    def cell(r, x):
        role = F.when(x.col_id == F.col("w.c"), r.c).when(x.col_id == F.col("w.pu"), r.pu).when(x.col_id == F.col("w.mtl"), r.mtl).otherwise(x.v)
        new = F.when(F.col("w").isNotNull() & F.array_contains("quant", x.col_id) & (F.lit(keep_fills) | x.numeric), role)
        return F.struct(r.row_id.alias("row_id"), x.col_id.alias("col_id"), F.when(new.isNull(), x.text).otherwise(money(new)).alias("text"))

    out = F.flatten(F.transform("rows", lambda r: F.transform(r.cells, lambda x: cell(r, x))))
    # outer: of a plain inline Spark infers filters that repeat all of the above
    return done.select("doc_id", F.inline_outer(out))


def totals(details: DataFrame, stated: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, total, stated, matches: an extension; compares the sum of amounts
    with stated(doc_id, stated)."""
    sums = details.groupBy("doc_id").agg(F.sum("mtl").alias("total"))
    return sums.join(stated, "doc_id").select("doc_id", "total", "stated", close(F.col("total"), F.col("stated"), tolerance).alias("matches"))
