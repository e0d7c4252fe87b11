"""Operators against hand-made goldens and plain versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyline.functions import geometry, text
from tallyline.operators import updates, correct, density, keywords, lines, pixels, reconcile, sinks, structure
from tallyline.plans import registry
from tallyline.sources import readers
from tallyline.streaming import pages

BOX = "doc_id long, poly_no int, ocr_text string, confidence double, xmin double, ymin double, xmax double, ymax double"


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def test_codes(spark):
    assert len(text.DENSITY) == 114 and text.DENSITY[113] == "e" and text.DENSITY[50] == "Ó" and text.DENSITY[30] == "\\" and text.DENSITY[81] == "w"
    df = one(spark, t="A 0e 中.")
    assert df.select(text.encode(df.t)).first()[0] == [80, 0, 113, 0, 10]


@pytest.mark.parametrize(
    ("raw", "numeric", "value"),
    [("1,234.50", True, 1234.5), ("1_000", True, 1000.0), ("1d", False, None), ("nan", True, None), ("-inf", True, float("-inf")), ("$ 5 %", True, 5.0), ("", False, None), (None, False, None), ("1.2.3", False, None), ("5.", True, 5.0), (".5e2", True, 50.0), ("1__0", False, None)],
)
def test_numbers(spark, raw, numeric, value):
    df = spark.createDataFrame([(raw,)], "t string")
    assert tuple(df.select(text.is_number(df.t), text.number(df.t)).first()) == (numeric, value)


def test_money_halves(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (3.0,), (-1.5,)], "v double")
    assert [r[0] for r in df.select(text.money(df.v)).collect()] == ["0.12", "2.67", "3", "-1.50"]


@pytest.mark.parametrize(
    ("word", "confidence", "junk"),
    [(None, 99.0, True), ("  ", 99.0, True), ("abc", 70.0, False), ("abc", 69.9, True), ("a1", 1.0, False), ("$", 1.0, False), (".-_", 99.0, True), ("abc", None, True)],
)
def test_junk(spark, word, confidence, junk):
    df = spark.createDataFrame([(word, confidence)], "t string, c double")
    assert df.select(text.is_junk(df.t, df.c)).first()[0] is junk


def test_clean_and_normal(spark):
    df = one(spark, t="¡Año 1,2,3 50%!")
    assert df.select(text.clean_token(df.t), text.normal(df.t)).first() == ("Año 1.2.3 50", "ano12350")
    df = spark.createDataFrame([("a",), ("abab",)], "w string")
    assert [r[0] for r in df.select(text.grams(df.w, 2)).collect()] == [[], ["ab", "ba"]]


@pytest.mark.parametrize(("t", "score"), [("1/2/2023", 0.95), ("31/02/2023", 0.0), ("2023-1-5", 0.95), ("5.6.2020", 0.95), ("x", 0.0), ("1/2/70", 0.95)])
def test_dates(spark, t, score):
    df = one(spark, t=t)
    assert df.select(text.date_score(df.t)).first()[0] == score


def test_noisy_dates_and_tax_ids(spark):
    dates = {"31.12.23": 0.95, "2023.12.31": 0.95, "2023/1/5": 0.95, "31122023": 0.95, "311223": 0.95, "1122": 0.95, "112023": 0.95, "Fecha: 31/12/2023": 0.95, "29/02/2023": 0.0, "29/2/24": 0.95, "29/2/00": 0.95, "1/1/0000": 0.0,
             "31/12/2023.": 0.0, "fecha": 0.85, "f.e.c.h.a": 0.85, "Fecha": 0.75, "f..echa": 0.75, "fecha de pago": 0.75, "hora": 0.85, "HORA": 0.75, "fexcxa": 0.7, "total": 0.0, "": 0.0, None: 0.0}
    df = spark.createDataFrame([(k,) for k in dates], "t string")
    assert {r[0]: r[1] for r in df.select("t", text.date_score(df.t)).collect()} == dates
    ids = {"abcd901231xy1": 0.95, "abc901231xy1": 0.85, "abcde12345xy": 0.85, "rfc: abc901231xy1": 0.75, "ab1": 0.0, "rfc": 0.8, "r.f.c": 0.8, "r..fc": 0.7, "RFC": 0.7, "rfcabc": 0.0, "abcdefghijkl": 0.0, None: 0.0}
    df = spark.createDataFrame([(k,) for k in ids], "t string")
    assert {r[0]: r[1] for r in df.select("t", text.tax_id_score(df.t)).collect()} == ids


def test_geometry(spark):
    df = one(spark, x=1.0)
    z, o = F.lit(0.0), F.lit(1.0)
    assert tuple(df.select(geometry.cosine(z, z, o, o), geometry.cosine(o, z, o, z)).first()) == (0.0, 1.0)
    low, high = geometry.padded(F.lit(3.9), F.lit(99.5), F.lit(100))
    assert tuple(df.select(low, high).first()) == (0, 100)


def plain_lines(boxes):
    """doc to lists of poly_nos."""
    out = {}
    for doc in {b[0] for b in boxes}:
        done, now = [], []
        for b in sorted((b for b in boxes if b[0] == doc and b[5] is not None), key=lambda b: ((b[5] + b[7]) / 2, b[1])):
            top, bottom = (sum(x[5] for x in now) / len(now), sum(x[7] for x in now) / len(now)) if now else (0, 0)
            low = min(bottom - top, b[7] - b[5])
            if now and low > 1e-5 and max(0.0, min(bottom, b[7]) - max(top, b[5])) > 0.3 * low:
                now.append(b)
            else:
                done, now = [*done, now] if now else done, [b]
        out[doc] = [[x[1] for x in g] for g in [*done, now] if g]
    return out


def test_lines_fold(spark):
    rng = random.Random(1)
    boxes = [(d, i, f"w{i}", 90.0, rng.uniform(0, 90), y, 95.0, y + rng.choice([0.0, 5.0, 12.0])) for d in range(4) for i, y in enumerate(rng.uniform(0, 80) for _ in range(rng.choice([1, 2, 30])))]
    boxes += [(9, 0, "a", 90.0, 0.0, 0.0, 1.0, 10.0), (9, 1, "b", 90.0, 2.0, 7.0, 3.0, 17.0), (9, 2, "c", 90.0, 2.0, None, 3.0, None)]  # an overlap of exactly 0.3
    got = {}
    for r in lines.lines(lines.assign(spark.createDataFrame(boxes, BOX))).collect():
        got.setdefault(r.doc_id, {})[r.line_no] = r.poly_nos
    assert {d: [v[k] for k in sorted(v)] for d, v in got.items()} == plain_lines(boxes)
    assert len(got[9]) == 2


def plain_clusters(points, eps):
    n, root = len(points), list(range(len(points)))
    for a in range(n):
        for b in range(a):
            if sum((x - y) ** 2 for x, y in zip(points[a], points[b], strict=True)) <= eps * eps:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    groups = sorted({r for r in root if root.count(r) > 1})
    return [groups.index(r) if r in groups else -1 for r in root]


def test_clusters(spark):
    rng = random.Random(4)
    points = {d: [(rng.gauss(3 * (i % 3), 0.7), rng.gauss(0, 0.7)) for i in range(25)] for d in range(3)} | {7: [(0.0, 0.0)]}
    df = spark.createDataFrame([(d, i, *p) for d, ps in points.items() for i, p in enumerate(ps)], "doc_id long, line_no int, x double, y double")
    got = {(r.doc_id, r.line_no): r.label for r in density.clusters(df, 0.5, ("x", "y")).collect()}
    assert got == {(d, i): k for d, ps in points.items() for i, k in enumerate(plain_clusters(ps, 0.5))}


def test_constant_features_scale_to_zero(spark):
    df = spark.createDataFrame([(1, i, 5.0, float(i)) for i in range(3)], "doc_id long, line_no int, a double, b double")
    rows = density.scaled(df, ("a", "b")).orderBy("line_no").collect()
    assert [r.a for r in rows] == [0, 0, 0] and rows[1].b == 0 and rows[2].b == pytest.approx(1.2247449)


def test_keywords(spark):
    words = spark.createDataFrame([("Cantidad:",), ("DESCRIPCIÓN",), ("cantldad",), ("iva",), ("",), (None,), ("zzzz",)], "word string")
    got = {r.query: (r.word_found, r.header_category, round(r.similarity, 6)) for r in keywords.match(words, keywords.lexicon(spark)).collect()}
    assert got == {"cantidad": ("cantidad", "quantity", 0.7), "descripcion": ("descripcion", "description", 0.7)}
    stats = one(spark, w="ab").select(keywords.statistics(F.col("w"), 0.0, 10.0, 1.0, 1.0)).first()[0]
    assert stats == pytest.approx([0.1, 106 / 113, 3.6, 1.0])
    assert one(spark, w=1).select(keywords.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] == 0.0


def table_words():
    head = [(1, 0, i, t, x, 0.0, x + 10, 10.0) for i, (t, x) in enumerate([("Qty", 0.0), ("Item", 100.0), ("Sum", 300.0)])]
    rows = [
        [("2", 0.0, 5.0), ("red", 100.0, 120.0), ("bolt", 122.0, 140.0), ("9.00", 300.0, 320.0)],  # more words than columns
        [("lone", 290.0, 310.0)],
        [("x", 50.0, 60.0), ("y", 90.0, 95.0)],
        [("a", 0.0, 50.0), ("b", 40.0, 60.0), ("c", 60.0, 70.0)],  # an overlap is wider than no gap
    ]
    out = [(1, line, poly, t, x0, y, x1, y1) for d, line, poly, t, x0, y, x1, y1 in head]
    return out + [(1, k, 10 * k + j, t, x0, 20.0 * k, x1, 20.0 * k + 10) for k, row in enumerate(rows, 1) for j, (t, x0, x1) in enumerate(row)]


def test_cells(spark):
    words = spark.createDataFrame(table_words(), "doc_id long, line_no int, poly_no int, ocr_text string, xmin double, ymin double, xmax double, ymax double")
    got = {}
    for r in structure.cells(words, spark.createDataFrame([(1, 0)], "doc_id long, header_line int")).collect():
        got.setdefault(r.row_id, {})[r.col_id] = r.text
    assert got == {1: {0: "2", 1: "red bolt", 2: "9.00"}, 2: {0: "", 1: "lone", 2: ""}, 3: {0: "x", 1: "y", 2: ""}, 4: {0: "a", 1: "b", 2: "c"}}


CELLS = "doc_id long, row_id int, col_id int, text string"


def cells_of(spark, *tables):
    return spark.createDataFrame([(d, i, j, t) for d, rows in enumerate(tables) for i, row in enumerate(rows) for j, t in enumerate(row)], CELLS)


def table(df, doc):
    out = {}
    for r in df.where(F.col("doc_id") == doc).collect():
        out.setdefault(r.row_id, {})[r.col_id] = r.text
    return [[row[k] for k in sorted(row)] for _, row in sorted(out.items())]


def test_reconcile(spark):
    good = [["a", "2", "10", "20"], ["b", "3", "5", "15"], ["c", "4", "6", "24"], ["d", "2", "7", ""], ["e", "2", "900", "18"]]
    two = [["x", "1"], ["y", "2"]]
    cells = cells_of(spark, good, two)
    documented = reconcile.reconcile(cells, "documented", keep_fills=True)
    assert table(documented, 0) == [*good[:3], ["d", "2", "7", "14"], ["e", "2", "9", "18"]]
    assert table(documented, 1) == two
    assert table(reconcile.reconcile(cells, "documented"), 0)[3] == ["d", "2", "7", ""]
    assert table(reconcile.reconcile(cells, "coded"), 0) == good  # no quantity is at most 1: nothing fits


def test_votes_split(spark):
    cells = cells_of(spark, [["1", "5", "5"], ["0.5", "8", "4"]])
    types = reconcile.column_types(cells)
    votes = {(r.c, r.pu, r.mtl): r.score for r in reconcile.role_votes(cells, types, "coded").collect()}
    assert votes == {(0, 1, 2): 1.5, (0, 2, 1): 0.5}
    assert reconcile.semantic_types(types, reconcile.role_winner(reconcile.role_votes(cells, types), types)).orderBy("col_id").first().semantic_type == "cuantitativo, c"


def test_numeric_share_at_the_limit(spark):
    cells = cells_of(spark, [["1"], ["2"], ["3"], ["x"], [None]])
    assert reconcile.column_types(cells).first().semantic_type == "cuantitativo"


def test_pixels(spark):
    df = spark.createDataFrame([(1, y, x, 255.0 if (y, x) == (1, 1) else 10.0) for y in range(3) for x in range(3)], "img_id long, y int, x int, v double")
    s = pixels.stencils(df).collect()
    assert [(r.y, r.x, r.laplacian, r.gx, r.gy) for r in s] == [(1, 1, -980.0, 0.0, 0.0)]
    assert pixels.otsu(df).first().threshold == 10.0
    wide = spark.createDataFrame([(1, y, x, 255.0 if (y, x) in ((5, 5), (0, 3)) else 90.0 + x) for y in range(20) for x in range(20)], "img_id long, y int, x int, v double")
    assert pixels.salt_pepper(wide).first().isolated == 1
    angles = spark.createDataFrame([(1, -20.0), (1, 3.0), (1, 5.0), (1, 90.0), (2, 40.0)], "img_id long, angle double")
    assert {r.img_id: (r.angle, r["rotate"]) for r in pixels.median_angle(angles).collect()} == {1: (4.0, True), 2: (0.0, False)}


def test_correction(spark):
    assert correct.weighted_distance("b0lt", "bolt") == pytest.approx(0.3) and correct.weighted_distance("", "ab") == 2
    words = spark.createDataFrame([("boit",), ("gear",), ("kg",), ("zzzzaa",)], "word string")
    names = spark.createDataFrame([("bolt",), ("gear",), ("belt",)], "word string")
    got = {r.word: (r.corrected, r.changed) for r in correct.correct(words, names).collect()}
    assert got == {"boit": ("bolt", True), "gear": ("gear", False), "kg": ("kg", False), "zzzzaa": ("zzzzaa", False)}
    assert one(spark, w="b1").select(correct.variations(F.col("w"))).first()[0] == ["81", "h1", "bi", "bl"]
    assert correct.weighted_distance("6ear", "gear") == pytest.approx(0.3) and correct.weighted_distance("boit", "bolt") == 1 and correct.weighted_distance("nora", "mora") == pytest.approx(0.4)
    kinds = spark.createDataFrame([(w,) for w in ("kg", "caja", "PAL0", "25x25", "C/10", "A.B.C", "brt", "Rojo", "rojo", "tuerca")], "w string")
    assert [r[0] for r in kinds.select(correct.is_abbreviation(F.col("w"))).collect()] == [True, True, True, True, True, True, True, True, False, False]


def test_lemmas_and_texts(spark):
    names = spark.createDataFrame([("cantar",), ("comer",), ("tornillo",), ("vivir",)], "word string")
    words = spark.createDataFrame([(w,) for w in ("cantando", "comido", "vivir", "xando", "pez", "COMERÁ")], "word string")
    assert {r.word: r.lemma for r in correct.lemmas(words, names).collect()} == {"cantando": "cantar", "comido": "comer", "vivir": "vivir", "xando": "xando", "pez": "pez", "COMERÁ": "comer"}
    rows = [(1, "torn1llo  cantando kg", 50.0), (2, "torn1llo", 90.0), (3, None, 10.0), (4, "", 10.0), (5, "ana tornilo", 10.0), (6, "x torni1lo", None)]
    own = spark.createDataFrame([("ana",)], "word string")
    got = {r.key: (r.corrected, r.original_length, r.corrected_length, r.text_changed) for r in correct.correct_texts(spark.createDataFrame(rows, "key long, text string, confidence double"), names, own).collect()}
    # a word with a digit inside has the form of a code and stays
    assert got == {1: ("torn1llo cantando kg", 21, 20, True), 2: ("torn1llo", 8, 8, False), 3: ("", 0, 0, False), 4: ("", 0, 0, False), 5: ("ana tornillo", 11, 12, True), 6: ("x torni1lo", 10, 10, False)}


def test_search_by_patterns(spark):
    wanted = {"rfc": ("RFCProveedor", "rfc", 0.8, "regex_rfc"), "abcd010203xy1": ("RFCProveedor", "registrofederaldecontribuyentes", 0.95, "regex_rfc"), "31/12/2023": ("FechaDocumento", "fecha", 0.95, "regex_fecha"),
              "fecha": ("FechaDocumento", "fecha", 0.85, "regex_fecha"), "hxxora": ("FechaDocumento", "hora", 0.75, "regex_fecha"), "x": None, "importe": None, "hoxxxra": ("FechaDocumento", "hora", 0.7, "regex_fecha")}
    df = spark.createDataFrame([(q,) for q in wanted], "q string")
    got = {r.q: r.s and (r.s.field, r.s.word_found, r.s.similarity, r.s.method) for r in df.select("q", text.search(F.col("q")).alias("s")).collect()}
    assert got == wanted


def test_clusters_of_more_samples(spark):
    rng = random.Random(9)
    points = [(rng.gauss(4 * (i % 3), 0.6), rng.gauss(0, 0.6)) for i in range(90)]
    near = [[j for j in range(90) if sum((a - b) ** 2 for a, b in zip(points[i], points[j], strict=True)) <= 0.25] for i in range(90)]
    core = [len(x) >= 5 for x in near]
    want, n = [-1] * 90, 0
    for i in range(90):
        if core[i] and want[i] < 0:
            todo = [i]
            while todo:
                k = todo.pop()
                if want[k] < 0:
                    want[k] = n
                    todo += near[k] if core[k] else []
            n += 1
    df = spark.createDataFrame([(1, i, *p) for i, p in enumerate(points)], "doc_id long, line_no int, x double, y double")
    got = {r.line_no: r.label for r in density.clusters(df, 0.5, ("x", "y"), 5).collect()}
    assert [got[i] for i in range(90)] == want and -1 in want and n > 2


def test_payload_and_orphans(spark):
    cells = cells_of(spark, [["2", "10", None]])
    winner = spark.createDataFrame([(0, 0, 1, 2)], "doc_id long, c int, pu int, mtl int")
    detail = sinks.details(cells, winner)
    row = sinks.payload(cells, detail).first()
    assert row.n_rows == 1 and json.loads(row.payload)["raw_table"] == [["2", "10", ""]]
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert [r.k for r in sinks.orphans(a, spark.createDataFrame([(1,)], "p int"), "k", "p").collect()] == [2]


def test_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name in ("a.PNG", "sub/b.jpg", "c.txt"):
        (tmp_path / "in" / name).write_bytes(b"x")
    manifest = readers.image_manifest(spark, str(tmp_path / "in"))
    assert sorted((r.name, r.extension) for r in manifest.collect()) == [("a", "png"), ("b", "jpg")]
    assert tuple(readers.plan(manifest).first()) == ("success", 2, "interactive")
    assert tuple(readers.plan(manifest.limit(0)).first()) == ("no_images", 0, "interactive")
    (tmp_path / "words.txt").write_text(" Uno\nuno\n\nDos\n")
    assert sorted(r.word for r in readers.word_list(spark, str(tmp_path / "words.txt")).collect()) == ["dos", "uno"]
    (tmp_path / "c.json").write_text('{"eps": 1.5, "unknown": 3}')
    assert readers.Config.load(str(tmp_path / "c.json")).eps == 1.5
    cells = cells_of(spark, [["a", "b"]], [["c"]])
    sinks.save_tables(cells, str(tmp_path / "out"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "out")).count() == 2


def test_registry_and_stream(spark, tmp_path):
    with pytest.raises(KeyError):
        registry.run(["lines", "binarization"], {})
    assert set(registry.TABLES) <= set(registry.names())
    rows = [(1, i, t, 99.0, x, 20.0 * k, x + 8 * len(t), 20.0 * k + 12) for k in range(6) for i, (t, x) in enumerate([("Qty", 0.0), ("Price", 100.0), ("Sum", 200.0)] if k == 0 else [(str(k), 0.0), ("5", 100.0), (str(5 * k), 200.0)])]
    rows = [(d, 10 * n + i, *r) for n, (d, i, *r) in enumerate(rows)]
    spark.createDataFrame(rows, BOX).write.json(str(tmp_path / "in"))
    pages.tables(pages.pages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).where("text = '25'").count() >= 1


def test_updates(spark):
    boxes = spark.createDataFrame([(1, i, f"t{i}", 10.0 * i) for i in range(4)], "doc_id long, poly_no int, ocr_text string, confidence double")
    results = spark.createDataFrame([(1, [2, 0, 2], [("new", 99.0), None, (None, 1.5), ("beyond", 1.0)])], "doc_id long, ids array<int>, results array<struct<text:string,confidence:double>>")
    got = {r.poly_no: (r.ocr_text, r.confidence) for r in updates.recognised(boxes, results, ["doc_id"], "poly_no").collect()}
    assert got == {0: ("t0", 0.0), 1: ("t1", 10.0), 2: ("", 1.5), 3: ("t3", 30.0)}
    lines = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "doc_id long, line_no int")
    marked = updates.mark_header(lines, spark.createDataFrame([(1, 2)], "doc_id long, header_line int"))
    assert sorted((r.doc_id, r.line_no, r.header_line) for r in marked.collect()) == [(1, 1, False), (1, 2, True), (2, 1, False)]
    assert updates.staged(boxes, "moire").first().stage == "moire"
    images = spark.createDataFrame([("a", None, "png", 5, 6, 30, None, "L"), ("b", "n", None, None, 6, 1, None, None)], "doc_id string, image_name string, format string, width int, height int, size long, date_creation string, color string")
    assert [(r.doc_id, r.image_name, r.format, r.width) for r in updates.metadata(images).collect()] == [("a", "", "png", 5)]


def test_plug_ins(spark):
    def reader():
        return lambda crops: [(f" {h}x{w} ", 0.98765) for h, w, _ in crops] if len(crops) != 3 else []

    crops = spark.createDataFrame([(1, i, 2, i, bytearray(b"x")) for i in range(5)], "doc_id long, poly_no int, height int, width int, gray binary").coalesce(1)
    got = {r.poly_no: (r.ocr_text, r.confidence) for r in updates.recognise(crops, "sizes", reader, batch=2).collect()}
    assert got == {i: (f"2x{i}", 98.77) for i in range(5)}
    assert {r.ocr_text for r in updates.recognise(crops.where("poly_no < 3"), "sizes", reader, batch=3).collect()} == {None}

    def finder():
        return lambda h, w, gray: [[(0, 0), (w, 0), (w, h), (0, h)]] * (w % 3)

    found = updates.detect(crops.drop("poly_no").withColumn("doc_id", F.monotonically_increasing_id()), "boxes", finder).groupBy("doc_id").count().collect()
    assert sorted(r["count"] for r in found) == [1, 1, 2]


def test_records(spark, tmp_path):
    rows = spark.createDataFrame([("b", None, 5.0), ("a", "nota", 7.5)], "FolioDocumento string, TipoDocumento string, MontoTotalDocumento double")
    made = sinks.records(rows)
    assert {(r.FolioDocumento, r.TipoDocumento) for r in made.collect()} == {("b", "ticket"), ("a", "nota")} and made.select("IDRegistro").distinct().count() == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks_test LOCATION '%s'" % (tmp_path / "db"))
    try:
        sinks.create_tables(spark, "sinks_test")
        assert {r.tableName for r in spark.sql("SHOW TABLES IN sinks_test").collect()} == {t.lower() for t in sinks.TABLES}
        one = made.withColumn("IDRegistro", F.col("FolioDocumento")).withColumn("IDProveedor", F.lit("nobody"))
        sinks.insert(one, "sinks_test.RegistrosCompra")
        sinks.insert(one, "sinks_test.RegistrosCompra")  # known keys are not inserted again
        assert spark.table("sinks_test.RegistrosCompra").count() == 2
        assert [(r.child, r.value, r.n) for r in sinks.broken_references(spark, "sinks_test").collect()] == [("RegistrosCompra", "nobody", 2)]
    finally:
        spark.sql("DROP DATABASE sinks_test CASCADE")
    cells = cells_of(spark, [["a,b", 'say "x"'], ["c", None]])
    header = spark.createDataFrame([(0, ["Qty", "Item"])], "doc_id long, header array<string>")
    for head, want in ((header, "Qty,Item"), (header.limit(0), "col_0,col_1")):
        sinks.save_corrected(cells, head, str(tmp_path / "csv"))
        assert [r.line for r in spark.read.parquet(str(tmp_path / "csv")).orderBy("row_id").collect()] == [want, '"a,b","say ""x"""', "c,"]
    sinks.save_tables(cells, str(tmp_path / "wide"), "parquet", names=["qty"], buckets=2)
    assert set(spark.read.parquet(str(tmp_path / "wide")).columns) == {"doc_id", "row_id", "qty", "col_1", "bucket"}
    sinks.save_text(spark.createDataFrame([("one",), (None,)], "text string"), str(tmp_path / "text"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "text")).collect()) == ["", "one"]
    assert tuple(sinks.totals(spark.createDataFrame([(2.0,), (4.0,)], "seconds double")).first()) == (2, 6.0, 3.0)


def test_lexicon_statistics(spark):
    entries = keywords.with_statistics(keywords.lexicon(spark, (("total", "total"), ("montototal", "total"), ("iva", "tax")), (("cantidad", "quantity"),)))
    words = spark.createDataFrame([("iva",), ("total",), ("totl",)], "word string")
    plain = {r.query: r.similarity for r in keywords.match(words, entries.drop("stats")).collect()}
    with_stats = {r.query: (r.word_found, round(r.similarity, 6)) for r in keywords.match(words, entries).collect()}
    assert "iva" not in plain and "total" in plain and with_stats["total"] == ("total", 1.0)
    row = keywords.info(entries).first()
    assert (row.total_words, row.field_words, row.header_words, row.words_with_statistics, row.n_min, row.n_max) == (4, 3, 1, 3, 2, 5)
