"""Pages stay in their rows: what large tables must not deal out or write."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyline.operators import lines, reconcile, structure
from tallyline.sources import shared

BOX = "doc_id long, poly_no int, ocr_text string, xmin double, ymin double, xmax double, ymax double"


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in x for x in plan.splitlines())


def test_cells_deal_out_items_only(spark, small, monkeypatch):
    """parts and items are dealt by part, items by order, and no word ever."""
    monkeypatch.setattr(shared, "new_folder", lambda *_: 1 / 0)
    assert exchanges(entry.queries()["structured_cells"](spark, small)) <= 4


def test_words_without_place(spark):
    """Boxes of one number stay what they are; those without x stand last in a row."""
    boxes = [(1, 0, "a", 0.0, 0.0, 5.0, 9.0), (1, 0, "b", 50.0, 0.0, 55.0, 9.0), (1, 2, "c", None, 20.0, None, 29.0), (1, 3, "d", 7.0, 20.0, 9.0, 29.0), (1, 4, "e", 1.0, 20.0, 2.0, 29.0)]
    found = lines.assign(spark.createDataFrame(boxes, BOX))
    assert sorted((r.poly_no, r.ocr_text, r.line_no, r.place) for r in found.collect()) == [(0, "a", 1, 0), (0, "b", 1, 1), (2, "c", 2, 0), (3, "d", 2, 1), (4, "e", 2, 2)]
    cells = structure.cells(found, found.groupBy("doc_id").agg(F.min("line_no").alias("header_line")))
    assert sorted((r.row_id, r.col_id, r.text) for r in cells.collect()) == [(1, 0, "e"), (1, 1, "d c")]


def test_tables_are_dealt_once(spark, small, monkeypatch):
    """cells are reconciled where they are cut; nothing is written between."""
    monkeypatch.setattr(shared, "new_folder", lambda *_: 1 / 0)
    assert exchanges(entry.queries()["invoice_tables"](spark, small)) <= 4


def test_pages_reconcile_as_cells_do(spark):
    good = [["a", "2", "10", "20"], ["b", "3", "5", "15"], ["c", "4", "6", "24"], ["d", "2", "7", ""], ["e", "2", "900", "18"], ["f", "x", "2", "8"], ["g", "0", "0", "9"]]
    ties = [["1", "5", "5", "5"], ["0.5", "8", "4", "inf"], ["nan", "1,000", "-3", "$ 2"]]
    tables = [good, ties, good[:1], [["x", "1"], ["y", "2"]], [[None, "1", "2", "2"], ["", "2", "2", "4"]]]
    rows = spark.createDataFrame([(d, i, r) for d, t in enumerate(tables) for i, r in enumerate(t)], "doc_id long, row_id int, texts array<string>")
    cells = rows.select("doc_id", "row_id", F.posexplode("texts").alias("col_id", "text"))
    for axioms in ("coded", "documented"):
        for keep in (True, False):
            got = reconcile.reconcile_pages(reconcile.page_tables(rows), axioms, keep)
            want = reconcile.reconcile(cells, axioms, keep)
            key = lambda r: tuple(map(str, r))
            assert got.columns == want.columns and sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
