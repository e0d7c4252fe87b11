"""The registered queries in DuckDB SQL, for comparison."""

from __future__ import annotations

# Fixed values, written out here so that they don't come from the code under test.
_DENSITY = "0123456789.,$¢/#°()%—<>+-=*^\";\\|[]{}@&_¿?¡!~`':©®™ÓÁÚÜÑWXZYQUKHOGFLJEVTIRMNSBDPCAwküúyxñóqjévfzhígápbudmltcnoisrae"
_WEIGHTS = {2: 0.5, 3: 0.7, 4: 0.85, 5: 1.0}
_FIELDS = (("subtotal", "subtotal"), ("proveedor", "supplier"), ("fechaemision", "date"), ("foliofiscal", "folio"), ("montototal", "total"))
_HEADINGS = (("cantidad", "quantity"), ("descripcion", "description"), ("producto", "description"), ("preciounitario", "unit_price"), ("precio", "unit_price"), ("importe", "amount"))
_SHARES = {
    "e": 0.1368, "a": 0.1253, "o": 0.0868, "i": 0.0625, "s": 0.0798, "n": 0.0671, "r": 0.0687, "u": 0.0393, "l": 0.0497,
    "t": 0.0463, "d": 0.0586, "c": 0.0468, "p": 0.0251, "m": 0.0315, "b": 0.0142, "g": 0.0101, "y": 0.0109, "f": 0.0070,
    "v": 0.0090, "k": 0.0002, "h": 0.0070, "q": 0.0088, "j": 0.0044, "x": 0.0022, "z": 0.0052, "w": 0.0001,
}
_MISREAD = {"0o": 0.3, "1l": 0.3, "1i": 0.3, "5s": 0.3, "6g": 0.3, "8b": 0.3, "9g": 0.3, "ce": 0.4, "nm": 0.4, "uv": 0.4}
_HEADERS = (("Cantidad", "Descripcion", "Precio", "Importe"), ("Cantldad", "Descripción", "Preclo", "lmporte"), ("Cant.", "Producto", "P.Unitario", "Total"))

_ENC = "'" + _DENSITY.replace("'", "''") + "'"
_NUMBER = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
_PARSED = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"

_ROWS = """r AS (SELECT l_orderkey AS doc_id, l_partkey, l_quantity, l_extendedprice, l_discount,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount)::INT AS row_id FROM lineitem)"""


_PARSES = f"""parsed AS (SELECT *, trim(regexp_replace(text, '[$,% ]', '', 'g')) AS s FROM cells),
num AS (SELECT doc_id, row_id, col_id, text, regexp_matches(s, '{_NUMBER}') AS numeric, CASE WHEN regexp_matches(s, '{_NUMBER}') THEN replace(s, '_', '')::DOUBLE END AS v FROM parsed)"""


def _triples(kind: str) -> str:
    src = (
        "SELECT doc_id, row_id, l_partkey, l_discount AS c, l_extendedprice AS pu, l_extendedprice * l_discount AS mtl FROM r WHERE l_discount > 0"
        if kind == "coded"
        else "SELECT doc_id, row_id, l_partkey, l_quantity AS c, l_extendedprice / l_quantity AS pu, l_extendedprice AS mtl FROM r"
    )
    return f"""{_ROWS}, t AS ({src}),
tp AS (SELECT *, CASE WHEN row_id % 7 = 0 THEN pu * 10 ELSE pu END AS price FROM t),
cells AS (
  SELECT doc_id, row_id, 0 AS col_id, 'part ' || l_partkey AS text FROM tp
  UNION ALL SELECT doc_id, row_id, 1, printf('%.2f', c) FROM tp
  UNION ALL SELECT doc_id, row_id, 2, '$' || format('{{:,.2f}}', price) FROM tp
  UNION ALL SELECT doc_id, row_id, 3, CASE WHEN row_id % 5 = 0 THEN '' ELSE printf('%.2f', mtl) END FROM tp),
{_PARSES}"""


_TYPES = """typed AS (SELECT doc_id, col_id, CASE WHEN avg(numeric::INT) >= 0.6 THEN 'cuantitativo' ELSE 'texto' END AS semantic_type FROM num GROUP BY ALL),
types AS (SELECT *, CASE WHEN semantic_type = 'cuantitativo' THEN row_number() OVER (PARTITION BY doc_id, semantic_type ORDER BY col_id) END::INT AS q FROM typed)"""


def _votes(axioms: str) -> str:
    ordered = "b.v >= m.v" if axioms == "coded" else "m.v >= b.v"
    return f"""qv AS (SELECT n.* FROM num n JOIN types t USING (doc_id, col_id) WHERE t.q IS NOT NULL AND n.v IS NOT NULL),
fits AS (SELECT a.doc_id, a.row_id, a.col_id AS c, b.col_id AS pu, m.col_id AS mtl FROM qv a JOIN qv b USING (doc_id, row_id) JOIN qv m USING (doc_id, row_id)
  WHERE a.col_id <> b.col_id AND m.col_id NOT IN (a.col_id, b.col_id) AND a.v > 0 AND b.v > 0 AND m.v > 0 AND m.v >= a.v * b.v AND {ordered}
  AND abs(a.v * b.v - m.v) <= 0.05 * greatest(abs(a.v * b.v), abs(m.v))),
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, row_id) AS n FROM fits),
votes AS (SELECT doc_id, c, pu, mtl, sum(CASE n WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score FROM counted GROUP BY ALL),
winner AS (SELECT doc_id, c, pu, mtl, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c, pu, mtl) AS k FROM votes
  WHERE score > 0 AND doc_id IN (SELECT doc_id FROM types GROUP BY doc_id HAVING max(q) >= 3)) WHERE k = 1)"""


def _reconcile(kind: str, keep: bool, cells: str | None = None) -> str:
    restore = "f.value IS NULL" if keep else "f.value IS NULL OR NOT n.numeric"
    return f"""WITH {cells or _triples(kind)}, {_TYPES}, {_votes(kind)},
role AS (SELECT n.*, CASE n.col_id WHEN w.c THEN 'c' WHEN w.pu THEN 'pu' WHEN w.mtl THEN 'mtl' END AS role FROM num n JOIN types t USING (doc_id, col_id) JOIN winner w USING (doc_id) WHERE t.q IS NOT NULL),
wide AS (SELECT doc_id, row_id, max(v) FILTER (role = 'c') AS c, max(v) FILTER (role = 'pu') AS pu, max(v) FILTER (role = 'mtl') AS mtl FROM role GROUP BY ALL),
med AS (SELECT doc_id, median(v) FILTER (role = 'c') AS mc, median(v) FILTER (role = 'pu') AS mp, median(v) FILTER (role = 'mtl') AS mm FROM role GROUP BY ALL),
dev AS (SELECT *, abs(c - mc) AS dc, abs(pu - mp) AS dp, abs(mtl - mm) AS dm,
  c IS NOT NULL AND pu IS NOT NULL AND mtl IS NOT NULL AND abs(c * pu - mtl) > 0.05 * greatest(abs(c * pu), abs(mtl)) AS broken FROM wide JOIN med USING (doc_id)),
move AS (SELECT *, CASE WHEN NOT broken THEN '' WHEN greatest(dc, dp, dm) = dc AND pu <> 0 THEN 'c' WHEN greatest(dc, dp, dm) = dp AND c <> 0 THEN 'pu' ELSE 'mtl' END AS moves FROM dev),
fixed AS (SELECT doc_id, row_id,
  CASE WHEN moves = 'c' OR c IS NULL THEN coalesce(mtl / nullif(pu, 0), c) ELSE c END AS c,
  CASE WHEN moves = 'pu' OR pu IS NULL THEN coalesce(mtl / nullif(c, 0), pu) ELSE pu END AS pu,
  CASE WHEN moves = 'mtl' OR mtl IS NULL THEN coalesce(c * pu, mtl) ELSE mtl END AS mtl FROM move),
f AS (SELECT r.doc_id, r.row_id, r.col_id, CASE r.role WHEN 'c' THEN x.c WHEN 'pu' THEN x.pu WHEN 'mtl' THEN x.mtl ELSE r.v END AS value FROM role r JOIN fixed x USING (doc_id, row_id))
SELECT n.doc_id, n.row_id, n.col_id, CASE WHEN {restore} THEN n.text WHEN f.value = floor(f.value) THEN printf('%.0f', f.value) ELSE printf('%.2f', f.value) END AS text
FROM num n LEFT JOIN f USING (doc_id, row_id, col_id)"""


_LAYOUT = """li AS (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
wd AS (SELECT doc_id, line_no, unnest(range(len(w))) AS word_no, unnest(w) AS text FROM (SELECT doc_id, line_no, string_split(line, ' ') AS w FROM li)),
wx AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 10.0::DOUBLE AS x FROM wd),
words AS (SELECT doc_id, line_no, word_no, text, ((doc_id * 31 + word_no * 17) % 100)::DOUBLE AS confidence, x::DOUBLE AS xmin, line_no * 20.0::DOUBLE AS ymin, (x + length(text) * 10)::DOUBLE AS xmax, (line_no * 20.0 + 16)::DOUBLE AS ymax FROM wx WHERE text <> '')"""

_HEADS = ", ".join("[" + ", ".join(f"'{w}'" for w in h) + "]" for h in _HEADERS)
_INVOICES = f"""{_ROWS},
bw AS (SELECT doc_id, row_id, list_concat(list_concat([printf('%.0f', l_quantity)], string_split(p_name, ' ')), [printf('%.2f', l_extendedprice / l_quantity), printf('%.2f', l_extendedprice)]) AS w FROM r JOIN part ON p_partkey = l_partkey),
bs AS (SELECT doc_id, row_id, CASE WHEN doc_id % 7 = 0 AND row_id % 3 = 0 THEN w[1 : 1 + row_id % 2] ELSE w END AS w FROM bw),
hw AS (SELECT DISTINCT doc_id, 0 AS row_id, ([{_HEADS}])[1 + doc_id % 3] AS w FROM r),
iw AS (SELECT doc_id, row_id, len(w) AS n, unnest(range(len(w))) AS k, unnest(w) AS ocr_text FROM (SELECT * FROM hw UNION ALL SELECT * FROM bs)),
ip AS (SELECT doc_id, row_id, k, ocr_text, (CASE WHEN row_id = 0 THEN k * 150.0 WHEN k = 0 THEN 0.0 WHEN k >= n - 2 THEN 450.0 - 150 * (n - 1 - k) ELSE 110.0 + 38 * k END)::DOUBLE AS xmin, (100.0 + 20 * row_id + (k * 3) % 5)::DOUBLE AS ymin FROM iw),
polygons AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY row_id, k) - 1 AS poly_no, ocr_text, xmin, ymin, xmin + length(ocr_text) * 6 AS xmax, ymin + 14 AS ymax FROM ip)"""
#: The fold over the words of a page, one word of every page a step.
_LINES = f"""RECURSIVE {_INVOICES},
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (ymin + ymax) / 2, poly_no) AS i FROM polygons),
fold AS (
  SELECT doc_id, poly_no, i, 1 AS line_no, 1 AS n, ymin AS y0, ymax AS y1 FROM o WHERE i = 1
  UNION ALL
  SELECT doc_id, poly_no, i, CASE WHEN joins THEN line_no ELSE line_no + 1 END, CASE WHEN joins THEN n + 1 ELSE 1 END, CASE WHEN joins THEN y0 + ymin ELSE ymin END, CASE WHEN joins THEN y1 + ymax ELSE ymax END
  FROM (SELECT o.doc_id, o.poly_no, o.i, f.line_no, f.n, f.y0, f.y1, o.ymin, o.ymax,
    least(f.y1 / f.n - f.y0 / f.n, o.ymax - o.ymin) > 1e-5 AND greatest(0.0, least(f.y1 / f.n, o.ymax) - greatest(f.y0 / f.n, o.ymin)) > 0.3 * least(f.y1 / f.n - f.y0 / f.n, o.ymax - o.ymin) AS joins
    FROM fold f JOIN o ON o.doc_id = f.doc_id AND o.i = f.i + 1)),
assigned AS (SELECT o.doc_id, o.poly_no, o.ocr_text, o.xmin, o.ymin, o.xmax, o.ymax, fold.i AS place, line_no FROM o JOIN fold USING (doc_id, poly_no)),
lines AS (SELECT doc_id, line_no, trim(string_agg(ocr_text, ' ' ORDER BY place)) AS text, count(*) AS n_words, min(xmin) AS xmin, avg(ymin) AS ymin, max(xmax) AS xmax, avg(ymax) AS ymax,
  (min(xmin) + max(xmax)) / 2 AS cx, (avg(ymin) + avg(ymax)) / 2 AS cy FROM assigned GROUP BY ALL)"""


def _stats(source: str, keys: str) -> str:
    """CTE st: statistics of the codes of source's text."""
    on = " AND ".join(f"c.{k.strip()} = m.{k.strip()}" for k in keys.split(","))
    return f"""ch AS (SELECT {keys}, unnest(string_split(regexp_replace(text, '\\s+', '', 'g'), '')) AS c FROM {source} WHERE regexp_replace(text, '\\s+', '', 'g') <> ''),
cd AS (SELECT {keys}, greatest(instr({_ENC}, c) - 1, 0)::DOUBLE AS code FROM ch),
mo AS (SELECT {keys}, count(*) AS n, avg(code) AS mean, coalesce(stddev_samp(code), 0) AS std_dev, quantile_cont(code, 0.25) AS p25, quantile_cont(code, 0.5) AS p50, quantile_cont(code, 0.75) AS p75 FROM cd GROUP BY ALL HAVING count(*) > 1),
st AS (SELECT {", ".join(f"m.{k.strip()}" for k in keys.split(","))}, any_value(n) AS n, any_value(mean) AS mean, any_value(std_dev) AS std_dev, any_value(p25) AS p25, any_value(p50) AS p50, any_value(p75) AS p75, any_value(p75 - p25) AS iqr,
  CASE WHEN any_value(std_dev) = 0 THEN 0 ELSE avg(((code - mean) / nullif(std_dev, 0)) ** 3) END AS skewness FROM mo m JOIN cd c ON {on} GROUP BY {", ".join(f"m.{k.strip()}" for k in keys.split(","))})"""


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


_GEOMETRY = """ge AS (SELECT doc_id, line_no, xmax - xmin AS bbox_width,
  CASE WHEN dx IS NULL THEN 0 WHEN sqrt(dx * dx + dy * dy) = 0 THEN 1 ELSE dx / sqrt(dx * dx + dy * dy) END AS align_prev,
  100.0 / 480000 * (xmax - xmin) * (ymax - ymin) AS ratio_area, (xmax - xmin) / (ymax - ymin) AS aspect_ratio
  FROM (SELECT *, lag(cx) OVER w - cx AS dx, lag(cy) OVER w - cy AS dy FROM lines WHERE doc_id NOT IN (SELECT doc_id FROM lines WHERE ymax = ymin) WINDOW w AS (PARTITION BY doc_id ORDER BY cy, line_no)))"""
_FEATURES = ("n", "mean", "std_dev", "iqr", "p50", "skewness", "bbox_width", "align_prev", "ratio_area", "aspect_ratio")
_SCALED = f"""{_LINES}, {_stats("lines", "doc_id, line_no")}, {_GEOMETRY}, fe AS (SELECT * FROM st JOIN ge USING (doc_id, line_no)),
z AS (SELECT doc_id, line_no, [{", ".join(f"(({c} - avg({c}) OVER d) / CASE WHEN stddev_pop({c}) OVER d < 1e-9 THEN 1 ELSE stddev_pop({c}) OVER d END)::DOUBLE" for c in _FEATURES)}] AS p FROM fe WINDOW d AS (PARTITION BY doc_id))"""


def _clusters(eps: float, least: int) -> str:
    """CTE labels: density clusters of z(doc_id, line_no, p)."""
    return f"""nb AS (SELECT a.doc_id, a.line_no AS a, b.line_no AS b FROM z a JOIN z b ON a.doc_id = b.doc_id AND list_sum(list_transform(range(1, len(a.p) + 1), lambda i: (a.p[i] - b.p[i]) ** 2)) <= {eps} ** 2),
core AS (SELECT doc_id, a FROM nb GROUP BY ALL HAVING count(*) >= {least}),
ce AS (SELECT nb.* FROM nb SEMI JOIN core c ON c.doc_id = nb.doc_id AND c.a = nb.a SEMI JOIN core d ON d.doc_id = nb.doc_id AND d.a = nb.b),
reach AS (SELECT doc_id, a, a AS b FROM core UNION SELECT reach.doc_id, reach.a, ce.b FROM reach JOIN ce ON ce.doc_id = reach.doc_id AND ce.a = reach.b),
ro AS (SELECT doc_id, a, min(b) AS root FROM reach GROUP BY ALL),
cl AS (SELECT doc_id, a, dense_rank() OVER (PARTITION BY doc_id ORDER BY root) - 1 AS label FROM ro),
labels AS (SELECT z.doc_id, z.line_no, coalesce(any_value(own.label), min(near.label), -1)::INT AS label FROM z LEFT JOIN cl own ON own.doc_id = z.doc_id AND own.a = z.line_no
  LEFT JOIN nb ON nb.doc_id = z.doc_id AND nb.a = z.line_no LEFT JOIN cl near ON near.doc_id = nb.doc_id AND near.a = nb.b GROUP BY z.doc_id, z.line_no)"""


_LABELS = f"WITH {_SCALED}, {_clusters(2.0, 2)}"
_MAIN = """sz AS (SELECT doc_id, label, count(*) AS size, min(line_no) AS first_line, max(line_no) AS last_line FROM labels WHERE label >= 0 GROUP BY ALL),
main AS (SELECT doc_id, label, size, first_line, last_line FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, label) AS k FROM sz) WHERE k = 1)"""

_LEXICON = list(dict.fromkeys([w for w, _ in _FIELDS] + [w for w, _ in _HEADINGS]))
_LEX = "lex AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{w}', {repr(dict(_FIELDS).get(w)) if w in dict(_FIELDS) else 'NULL'}, {repr(dict(_HEADINGS).get(w)) if w in dict(_HEADINGS) else 'NULL'})" for i, w in enumerate(_LEXICON)
) + ") t(cand_id, word, key_field, header_category))"
_GRAMS = lambda w, n: f"list_distinct(list_transform(range(1, length({w}) - {n} + 2), lambda i: substring({w}, i, {n})))"
_NORMAL = "regexp_replace(strip_accents(lower(trim(ocr_text))), '[^a-z0-9]', '', 'g')"
_COSINES = " + ".join(
    f"CASE WHEN length(q) >= {n} AND length(word) >= {n} THEN round({w} * len(list_intersect({_GRAMS('q', n)}, {_GRAMS('word', n)})) / sqrt(len({_GRAMS('q', n)}) * len({_GRAMS('word', n)})), 12) ELSE 0 END" for n, w in _WEIGHTS.items()
)
#: Every word against every entry.
_MATCH = f"""{_LEX}, qs AS (SELECT DISTINCT {_NORMAL} AS q FROM polygons WHERE {_NORMAL} <> ''),
sc AS (SELECT q, lex.*, ({_COSINES}) * 0.7 / {sum(_WEIGHTS.values())} AS similarity FROM qs CROSS JOIN lex),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(similarity, 9) DESC, cand_id) AS k FROM sc) WHERE k = 1),
found AS (SELECT q AS query, word AS word_found, key_field, header_category, similarity FROM top WHERE round(similarity, 9) >= CASE WHEN length(word) <= 6 THEN 0.7 WHEN length(word) <= 10 THEN 0.65 ELSE 0.6 END)"""

_CODES = """co AS (SELECT o_orderkey,
  CASE o_orderkey % 12 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%-d.%-m.%Y') WHEN 3 THEN '31/02/' || strftime(o_orderdate, '%Y')
    WHEN 4 THEN 'Fecha: ' || strftime(o_orderdate, '%d/%m/%Y') WHEN 5 THEN strftime(o_orderdate, '%d%m%Y') WHEN 6 THEN strftime(o_orderdate, '%d-%m-%y') WHEN 7 THEN 'fecha' WHEN 8 THEN 'fxecxxha' WHEN 9 THEN 'hora de' WHEN 10 THEN 'hoxxxra' ELSE 'total' END AS day,
  CASE o_orderkey % 10 WHEN 0 THEN 'abcd' || strftime(o_orderdate, '%y%m%d') || 'xy1' WHEN 1 THEN 'abc' || strftime(o_orderdate, '%y%m%d') || 'x1' WHEN 2 THEN 'abc ' || strftime(o_orderdate, '%y%m%d') || ' a' WHEN 3 THEN 'rfc' WHEN 4 THEN 'r.f.c'
    WHEN 5 THEN 'r..fc' WHEN 6 THEN 'rfc: abc' || strftime(o_orderdate, '%y%m%d') || 'xy1' WHEN 7 THEN 'abc' WHEN 8 THEN 'ABCDE-9' ELSE 'R.F.C.' END AS code FROM orders)"""
# the searches in a text, as rules on a column named by {q}
_TAX = """CASE WHEN length({q}) >= 10 THEN CASE WHEN regexp_matches({q}, '(?i)[a-z]{{3,5}}\\d{{5,7}}[a-z0-9]{{2,4}}') OR regexp_matches({q}, '(?i)[a-z]{{3,4}}.*\\d{{4,6}}.*[a-z0-9]{{1,3}}')
    THEN CASE WHEN regexp_matches({q}, '^[a-z]{{4}}\\d{{6}}[a-z0-9]{{3}}') THEN 0.95 WHEN length({q}) <= 15 THEN 0.85 ELSE 0.75 END ELSE 0.0 END
  WHEN length({q}) BETWEEN 2 AND 5 AND regexp_matches({q}, '(?i)r.{{0,2}}f.{{0,2}}c') THEN CASE WHEN regexp_full_match({q}, 'r.?f.?c') THEN 0.80 ELSE 0.70 END ELSE 0.0 END"""
_FORMATS = "['%d/%m/%Y', '%d-%m-%Y', '%d.%m.%Y', '%d/%m/%y', '%d-%m-%y', '%d.%m.%y', '%Y/%m/%d', '%Y-%m-%d', '%Y.%m.%d', '%d%m%Y', '%d%m%y']"
_DAY = f"""CASE WHEN try_strptime(regexp_replace({{q}}, '[^0-9/\\-.]', '', 'g'), {_FORMATS}) IS NOT NULL THEN 0.95
  WHEN regexp_matches({{q}}, '(?i)f.{{{{0,2}}}}e.{{{{0,2}}}}c.{{{{0,2}}}}h.{{{{0,2}}}}a') THEN CASE WHEN regexp_full_match({{q}}, 'f.?e.?c.?h.?a') THEN 0.85 ELSE 0.75 END
  WHEN regexp_matches({{q}}, '(?i)h.{{{{0,2}}}}o.{{{{0,2}}}}r.{{{{0,2}}}}a') THEN CASE WHEN regexp_full_match({{q}}, 'h.?o.?r.?a') THEN 0.85 ELSE 0.75 END
  WHEN regexp_matches({{q}}, '(?i)[fh].{{{{0,3}}}}[eo].{{{{0,3}}}}[cr].{{{{0,3}}}}[ha]') THEN 0.7 ELSE 0.0 END"""
_SEARCH = f"""WITH {_CODES}, q AS (SELECT o_orderkey, 0 AS which, day AS query FROM co UNION ALL SELECT o_orderkey, 1, code FROM co),
sc AS (SELECT *, ({_TAX.format(q="query")})::DOUBLE AS tax, ({_DAY.format(q="query")})::DOUBLE AS date FROM q WHERE length(query) >= 2)
SELECT o_orderkey, which, query, CASE WHEN tax > 0 THEN 'RFCProveedor' ELSE 'FechaDocumento' END AS field, CASE WHEN tax > 0 THEN tax ELSE date END AS similarity, CASE WHEN tax > 0 THEN 'regex_rfc' ELSE 'regex_fecha' END AS method,
  CASE WHEN tax > 0 THEN CASE WHEN length(query) <= 5 THEN 'rfc' ELSE 'registrofederaldecontribuyentes' END
    WHEN date = 0.95 OR regexp_matches(query, '(?i)f.{{0,2}}e.{{0,2}}c.{{0,2}}h.{{0,2}}a') THEN 'fecha'
    WHEN regexp_matches(query, '(?i)h.{{0,2}}o.{{0,2}}r.{{0,2}}a') OR regexp_matches(query, 'h.*o.*r') THEN 'hora' ELSE 'fecha' END AS word_found
FROM sc WHERE tax > 0 OR date > 0"""

#: Words of the lexicon whose statistics count, and what is asked: each of them whole and without one of its letters.
_FIELD_WORDS = (("subtotal", "subtotal"), ("total", "total"), ("montototal", "total"), ("importetotal", "total"), ("fecha", "date"), ("fechaemision", "date"), ("iva", "tax"), ("folio", "folio"), ("foliofiscal", "folio"))
_WITH_STATS = f"""WITH lx AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{w}', '{f}')" for i, (w, f) in enumerate(_FIELD_WORDS))}) t(cand_id, word, key_field)),
asked AS (SELECT DISTINCT q FROM (SELECT word AS q FROM lx UNION ALL SELECT substring(word, 1, i - 1) || substring(word, i + 1) FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM lx)) WHERE q <> ''),
own AS (SELECT w, len(c) AS n, list_avg(c) AS mean, list_avg(list_transform(c, lambda x: (x - list_avg(c)) ** 2)) AS var FROM (SELECT w, list_transform(string_split(w, ''), lambda x: greatest(instr({_ENC}, x) - 1, 0)::DOUBLE) AS c FROM (SELECT q AS w FROM asked UNION SELECT word FROM lx))),
bounds AS (SELECT key_field, min(var) AS v0, max(var) AS v1, min(sqrt(var)) AS s0, max(sqrt(var)) AS s1 FROM lx JOIN own ON w = word GROUP BY ALL),
sv AS (SELECT w, b.key_field, [least(n / 20.0, 1.0), mean / 113.0, CASE WHEN v1 <> v0 THEN (var - v0) / (v1 - v0) ELSE 1.0 END, CASE WHEN s1 <> s0 THEN (sqrt(var) - s0) / (s1 - s0) ELSE 1.0 END]::DOUBLE[] AS s FROM own, bounds b),
pair AS (SELECT q, lx.*, list_dot_product(a.s, e.s) AS ae, sqrt(list_dot_product(a.s, a.s)) * sqrt(list_dot_product(e.s, e.s)) AS size FROM asked CROSS JOIN lx JOIN sv a ON a.w = q AND a.key_field = lx.key_field JOIN sv e ON e.w = lx.word AND e.key_field = lx.key_field),
sc AS (SELECT *, 0.7 * ({_COSINES}) / {sum(_WEIGHTS.values())} + 0.3 * CASE WHEN size = 0 THEN 0 ELSE ae / size END AS similarity FROM pair),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(similarity, 9) DESC, cand_id) AS k FROM sc) WHERE k = 1)
SELECT q AS query, word AS word_found, key_field, round(similarity, 6) AS similarity FROM top WHERE round(similarity, 9) >= CASE WHEN length(word) <= 6 THEN 0.7 WHEN length(word) <= 10 THEN 0.65 ELSE 0.6 END"""

#: The weighted distance, one character of the word a step; a row holds the distances to all beginnings of the entry.
_DISTANCES = f"""WITH RECURSIVE {_INVOICES}, {_LEX},
wds AS (SELECT DISTINCT lower(ocr_text) AS word FROM polygons WHERE regexp_matches(lower(ocr_text), '^[a-z]{{3,}}$')),
dict AS (SELECT unnest(string_split(p_name, ' ')) AS entry FROM part UNION SELECT word FROM lex),
pr AS (SELECT word, entry, string_split(word, '') AS a, string_split(entry, '') AS b, MAP {{{", ".join(f"'{x}': {c}, '{x[::-1]}': {c}" for x, c in _MISREAD.items())}}} AS costs FROM wds JOIN dict ON abs(length(word) - length(entry)) <= 2),
dp AS (SELECT word, entry, 0 AS i, list_transform(range(0, len(b) + 1), lambda x: x::DOUBLE) AS r FROM pr
  UNION ALL SELECT word, entry, i + 1, list_transform(range(0, len(b) + 1), lambda j: j + list_min(list_transform(range(0, j + 1), lambda k: m[k + 1] - k)))
  FROM (SELECT dp.word, dp.entry, i, b, list_transform(range(0, len(b) + 1), lambda k: CASE WHEN k = 0 THEN r[1] + 1 ELSE least(r[k + 1] + 1, r[k] + CASE WHEN a[i + 1] = b[k] THEN 0.0 ELSE coalesce(costs[a[i + 1] || b[k]], 1.0) END) END)::DOUBLE[] AS m
    FROM dp JOIN pr ON pr.word = dp.word AND pr.entry = dp.entry WHERE i < len(a))),
sh AS (SELECT entry, product(coalesce(MAP {{{", ".join(f"'{c}': {v}" for c, v in _SHARES.items())}}}[c], 0.001)) AS share FROM (SELECT DISTINCT entry, unnest(range(length(entry))) AS i, unnest(string_split(entry, '')) AS c FROM dict) GROUP BY ALL),
ds AS (SELECT word, entry, r[len(r)] AS distance, r[len(r)] - 0.1 * share AS score FROM dp JOIN sh USING (entry) WHERE i = length(word) AND round(r[len(r)], 9) <= 2)
SELECT word, entry, round(distance, 6) AS distance, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY round(score, 9), entry)::INT AS rank FROM ds) WHERE rank <= 5"""

_CELLS = f"""WITH {_LINES},
hl AS (SELECT doc_id, min(line_no) AS hline FROM assigned GROUP BY ALL),
sw AS (SELECT a.*, hline, (a.xmin + a.xmax) / 2 AS cx, (a.ymin + a.ymax) / 2 AS cy, row_number() OVER x - 1 AS i, count(*) OVER (PARTITION BY a.doc_id, line_no) AS lk, lead(a.xmin) OVER x - a.xmax AS g
  FROM assigned a JOIN hl ON hl.doc_id = a.doc_id WINDOW x AS (PARTITION BY a.doc_id, line_no ORDER BY a.xmin, poly_no)),
hd AS (SELECT doc_id, i AS j, cx AS hx, cy AS hy, lk AS h FROM sw WHERE line_no = hline),
bd AS (SELECT sw.*, h, CASE WHEN g < 0 THEN 0.001 ELSE g END AS gap FROM sw JOIN (SELECT DISTINCT doc_id, h FROM hd) USING (doc_id) WHERE line_no > hline),
ct AS (SELECT *, (gap IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, line_no ORDER BY gap DESC NULLS LAST, i) < h)::INT AS cut FROM bd),
cc AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, line_no ORDER BY xmin, poly_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cuts FROM ct),
one AS (SELECT doc_id, line_no, j FROM (SELECT b.doc_id, b.line_no, hd.j, row_number() OVER (PARTITION BY b.doc_id, b.line_no ORDER BY round((cx * hx + cy * hy) / (sqrt(cx * cx + cy * cy) * sqrt(hx * hx + hy * hy)), 12) DESC, j) AS k FROM bd b JOIN hd ON hd.doc_id = b.doc_id WHERE b.lk = 1) WHERE k = 1),
pl AS (SELECT cc.*, CASE WHEN lk >= h THEN cuts WHEN lk = 1 THEN one.j ELSE i END AS col_id FROM cc LEFT JOIN one USING (doc_id, line_no)),
tx AS (SELECT doc_id, line_no, col_id, trim(string_agg(ocr_text, ' ' ORDER BY i)) AS text FROM pl GROUP BY ALL),
rw AS (SELECT doc_id, line_no, h, row_number() OVER (PARTITION BY doc_id ORDER BY line_no)::INT AS row_id FROM (SELECT DISTINCT doc_id, line_no, h FROM bd)),
gr AS (SELECT doc_id, line_no, row_id, unnest(range(h)) AS col_id FROM rw)
SELECT doc_id, row_id, col_id::INT AS col_id, coalesce(text, '') AS text FROM gr LEFT JOIN tx USING (doc_id, line_no, col_id)"""

_PIXELS = "px AS (SELECT img_id, (i // 8)::INT AS y, (i % 8)::INT AS x, least(255.0, greatest(0.0, floor((e::DOUBLE + 0.5) * 255)))::DOUBLE AS v FROM (SELECT vec_id AS img_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS e FROM embeddings))"
_PSTATS = f"""WITH {_PIXELS}, sh AS (SELECT img_id, v, count(*) AS k FROM px GROUP BY ALL), pe AS (SELECT img_id, -sum(p * log2(p + 1e-8)) AS entropy FROM (SELECT img_id, k / sum(k) OVER (PARTITION BY img_id) AS p FROM sh) GROUP BY ALL),
ps AS (SELECT img_id, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, var_pop(v) AS var, max(v) - min(v) AS dyn_range, avg((v <= 0 OR v >= 255)::INT) AS extremes, quantile_cont(v, 0.01) AS p1, quantile_cont(v, 0.99) AS p99 FROM px GROUP BY ALL)"""

_LETTERS_SQL = "CASE c {} ELSE ln(0.001) END"


def _likelihood() -> str:
    return _LETTERS_SQL.format(" ".join(f"WHEN '{c}' THEN ln({p})" for c, p in _SHARES.items()))


SQL = {
    "reconcile_documented": _reconcile("documented", True),
    "reconcile_coded": _reconcile("coded", False),
    "column_types": f"WITH {_triples('documented')}, {_TYPES} SELECT * FROM types",
    "role_votes": f"WITH {_triples('documented')}, {_TYPES}, {_votes('documented')} SELECT * FROM votes",
    "role_winner": f"WITH {_triples('coded')}, {_TYPES}, {_votes('coded')} SELECT * FROM winner",
    "detail_payload": f"""WITH {_triples('documented')}, {_TYPES}, {_votes('documented')}, pz AS (SELECT *, regexp_replace(trim(text), ',', '', 'g') AS z FROM cells),
d AS (SELECT doc_id, row_id, max(CASE WHEN regexp_matches(z, '{_PARSED}') THEN z::DOUBLE END) FILTER (col_id = w.c) AS cantidad, max(CASE WHEN regexp_matches(z, '{_PARSED}') THEN z::DOUBLE END) FILTER (col_id = w.pu) AS precio_unitario,
  max(CASE WHEN regexp_matches(z, '{_PARSED}') THEN z::DOUBLE END) FILTER (col_id = w.mtl) AS importe_raw FROM pz JOIN winner w USING (doc_id) GROUP BY ALL)
SELECT doc_id, row_id, {_r('cantidad', 'precio_unitario', 'importe_raw')}, round(cantidad * precio_unitario, 6) AS importe_calculado FROM d""",
    "numeric_parse": f"WITH {_triples('documented')} SELECT doc_id, row_id, col_id, numeric, round(v, 6) AS value, CASE WHEN regexp_matches(regexp_replace(trim(text), ',', '', 'g'), '{_PARSED}') THEN round(regexp_replace(trim(text), ',', '', 'g')::DOUBLE, 6) END AS parsed FROM num",
    "polygon_bbox_centroid": f"WITH {_LAYOUT} SELECT doc_id, line_no, word_no, xmin, ymin, xmax, ymax, (xmin + xmax + xmax + xmin) / 4 AS cx, (ymin + ymin + ymax + ymax) / 4 AS cy FROM words",
    "crop_padding": f"""WITH {_LAYOUT}, b AS (SELECT doc_id, line_no, word_no, greatest(0, xmin::INT - 5) AS px1, least(1000, xmax::INT + 5) AS px2, greatest(0, ymin::INT - 5) AS py1, least(1000, ymax::INT + 5) AS py2 FROM words)
SELECT *, (px1 + px2) / 2 AS pcx, (py1 + py2) / 2 AS pcy FROM b WHERE px2 > px1 AND py2 > py1""",
    "density_encode_stats": f"WITH {_LAYOUT}, tl AS (SELECT doc_id, line_no, line AS text FROM li), {_stats('tl', 'doc_id, line_no')} SELECT doc_id, line_no, n, {_r('mean', 'std_dev', 'p25', 'p50', 'p75', 'iqr', 'skewness')} FROM st",
    "morphological_profile": f"""WITH {_LAYOUT}, ch AS (SELECT doc_id, line_no, word_no, string_split(text, '') AS cs FROM words), k AS (SELECT *, list_transform(cs, lambda c: greatest(instr({_ENC}, c) - 1, 0)) AS codes FROM ch),
p AS (SELECT *, list_transform(codes, lambda c: CASE WHEN c <= 9 THEN 'n' WHEN c <= 55 THEN 'e' ELSE 'a' END) AS kinds FROM k),
q AS (SELECT doc_id, line_no, word_no, len(codes) AS n_chars, len(list_filter(kinds, lambda x: x = 'a')) AS n_letters, len(list_filter(kinds, lambda x: x = 'n')) AS n_digits, len(list_filter(kinds, lambda x: x = 'e')) AS n_marks, list_avg(codes) AS mean_code, array_to_string(kinds, '') AS profile FROM p)
SELECT doc_id, line_no, word_no, n_chars, n_letters, n_digits, n_marks, round(n_letters / n_chars, 6) AS letters, round(n_digits / n_chars, 6) AS digits, round(n_marks / n_chars, 6) AS marks, round(mean_code, 6) AS mean_code, profile FROM q""",
    "atomic_vectors": f"""WITH {_LAYOUT}, ch AS (SELECT doc_id, unnest(range(1, length(text) + 1)) AS place, unnest(string_split(text, '')) AS c FROM words)
SELECT doc_id, place, count(*) AS n, sum(greatest(instr({_ENC}, c) - 1, 0)) AS codes FROM ch GROUP BY ALL""",
    "junk_filter": rf"WITH {_LAYOUT} SELECT doc_id, line_no, word_no, text FROM words WHERE NOT (trim(text) = '' OR (confidence < 70 AND NOT (regexp_matches(text, '[0-9]') OR text IN ('$', '€', '£'))) OR regexp_matches(text, '^[\s.\-_,;:]+$'))",
    "clean_tokens": rf"""WITH {_LAYOUT} SELECT doc_id, line_no, word_no, regexp_replace(regexp_replace(regexp_replace(text, '([0-9])[`''´,]([0-9])', '\1.\2', 'g'), '([0-9])[`''´,]([0-9])', '\1.\2', 'g'), '[^\pL\pM\pN_\s.,]', '', 'g') AS cleaned FROM words""",
    "line_reconstruct": f"WITH {_LINES} SELECT doc_id, line_no, text, n_words, {_r('xmin', 'ymin', 'xmax', 'ymax', 'cx', 'cy')} FROM lines",
    "line_geometry_features": f"WITH {_LINES}, {_GEOMETRY} SELECT doc_id, line_no, {_r('bbox_width', 'align_prev', 'ratio_area', 'aspect_ratio')} FROM ge",
    "standard_scale": f"""WITH {_LINES}, {_stats('lines', 'doc_id, line_no')}, {_GEOMETRY}, fe AS (SELECT * FROM st JOIN ge USING (doc_id, line_no)),
z AS (SELECT doc_id, line_no, {", ".join(f"({c} - avg({c}) OVER d) / CASE WHEN stddev_pop({c}) OVER d < 1e-9 THEN 1 ELSE stddev_pop({c}) OVER d END AS {c}" for c in _FEATURES)} FROM fe WINDOW d AS (PARTITION BY doc_id))
SELECT doc_id, line_no, {_r(*_FEATURES)} FROM z""",
    "dbscan_labels": f"{_LABELS} SELECT * FROM labels",
    "main_cluster_interval": f"{_LABELS}, {_MAIN} SELECT * FROM main",
    "keyword_match": f"WITH {_INVOICES}, {_MATCH} SELECT query, word_found, key_field, header_category, round(similarity, 6) AS similarity FROM found",
    "header_line": f"WITH {_LINES}, {_MATCH} SELECT doc_id, min(line_no) AS header_line FROM assigned WHERE {_NORMAL} IN (SELECT query FROM found) GROUP BY ALL",
    "rfc_score": f"WITH {_CODES} SELECT o_orderkey, code, ({_TAX.format(q='code')})::DOUBLE AS score FROM co",
    "date_score": f"WITH {_CODES} SELECT o_orderkey, day, ({_DAY.format(q='day')})::DOUBLE AS score FROM co",
    "structured_cells": _CELLS,
    "recent_records": "SELECT event_id, user_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 100",
    "orphan_orders": "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) GROUP BY ALL",
    "pixel_stats": f"{_PSTATS} SELECT img_id, n, {_r('mean', 'std', 'var', 'dyn_range', 'extremes', 'p1', 'p99', 'entropy')} FROM ps JOIN pe USING (img_id)",
    "contrast_decision": f"{_PSTATS} SELECT img_id, std < CASE WHEN dyn_range > 50 THEN greatest(30.0, 0.6 * var) ELSE 20.0 END AS equalise, round(least(3.0, greatest(1.0, 0.01 * dyn_range)), 6)::DOUBLE AS clip FROM ps",
    "sharpness_decision": f"""WITH {_PIXELS}, n9 AS (SELECT a.img_id, a.y, a.x, a.v, sum(CASE WHEN abs(b.x - a.x) + abs(b.y - a.y) = 1 THEN b.v ELSE 0 END) - 4 * a.v AS lap,
  sum((b.x - a.x) * (2 - abs(b.y - a.y)) * b.v) AS gx, sum((b.y - a.y) * (2 - abs(b.x - a.x)) * b.v) AS gy FROM px a JOIN px b ON a.img_id = b.img_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 WHERE a.x BETWEEN 1 AND 6 AND a.y BETWEEN 1 AND 6 GROUP BY a.img_id, a.y, a.x, a.v),
eg AS (SELECT img_id, var_pop(lap) AS focus, avg(sqrt(gx * gx + gy * gy)) AS gradient FROM n9 GROUP BY ALL), vr AS (SELECT img_id, var_pop(v) AS var FROM px GROUP BY ALL)
SELECT img_id, {_r('focus', 'gradient')}, focus < 80 AS smooth, gradient < greatest(30.0, 0.5 * var) AS sharpen FROM eg JOIN vr USING (img_id)""",
    "salt_pepper": f"""WITH {_PIXELS}, en AS (SELECT img_id, floor(greatest(0, quantile_cont(v, 0.01))) AS lo, floor(least(255, quantile_cont(v, 0.99))) AS hi FROM px GROUP BY ALL),
ex AS (SELECT px.*, (v <= lo OR v >= hi)::INT AS e FROM px JOIN en USING (img_id)),
nb AS (SELECT a.img_id, a.y, a.x, a.e, sum(b.e) AS k, count(*) AS c FROM ex a JOIN ex b ON a.img_id = b.img_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY ALL),
ag AS (SELECT img_id, avg(e) AS share, sum((e = 1 AND c = 9 AND k <= 1)::INT) AS isolated FROM nb GROUP BY ALL)
SELECT img_id, isolated, round(share, 6) AS share, (CASE WHEN share > 0.06 AND isolated >= 10 THEN 3 ELSE 0 END)::INT AS kernel FROM ag""",
    "otsu_binarized": f"""WITH {_PIXELS}, hs AS (SELECT img_id, v, count(*) AS k FROM px GROUP BY ALL), cm AS (SELECT img_id, v, sum(k) OVER b AS n0, sum(k * v) OVER b AS s0, sum(k) OVER w AS n, sum(k * v) OVER w AS s FROM hs WINDOW b AS (PARTITION BY img_id ORDER BY v), w AS (PARTITION BY img_id)),
bt AS (SELECT img_id, v, round(n0 * (n - n0) * (s0 / n0 - (s - s0) / nullif(n - n0, 0)) ** 2 / (n * n), 6) AS b FROM cm), th AS (SELECT img_id, v AS t FROM (SELECT *, row_number() OVER (PARTITION BY img_id ORDER BY b DESC NULLS LAST, v) AS r FROM bt) WHERE r = 1)
SELECT img_id, sum((v > t)::INT) AS light FROM px JOIN th USING (img_id) GROUP BY ALL""",
    "line_differentials": f"""WITH {_LINES}, d AS (SELECT doc_id, line_no, ymin AS top, ymax AS bottom, xmin AS left_, xmax AS right_, coalesce(lead(ymin) OVER (PARTITION BY doc_id ORDER BY line_no) - ymax, 0) AS to_next FROM lines)
SELECT doc_id, line_no, {_r('top', 'bottom')}, round(left_, 6) AS "left", round(right_, 6) AS "right", round(to_next, 6) AS to_next FROM d""",
    "polygon_gaps": f"""WITH {_LINES} SELECT doc_id, line_no, poly_no, round(coalesce(lead(xmin) OVER (PARTITION BY doc_id, line_no ORDER BY xmin, poly_no) - xmax, 0), 6) AS gap,
round(atan2((ymin + ymax) / 2, (xmin + xmax) / 2), 6) AS angle_x, round(atan2((xmin + xmax) / 2, (ymin + ymax) / 2), 6) AS angle_y FROM assigned""",
    "correction_band": f"""WITH {_INVOICES}, {_LEX}, ws AS (SELECT DISTINCT lower(ocr_text) AS word FROM polygons WHERE regexp_matches(lower(ocr_text), '^[a-z]{{3,}}$')),
lk AS (SELECT word AS entry, sum({_likelihood()}) AS l FROM (SELECT word, unnest(string_split(word, '')) AS c FROM lex) GROUP BY ALL)
SELECT ws.word, entry, round(l, 6) AS likelihood FROM ws JOIN lk ON abs(length(ws.word) - length(entry)) <= 2""",
    "tabular_lines": f"""{_LABELS}, {_MAIN} SELECT l.doc_id, l.line_no, coalesce(l.line_no BETWEEN first_line AND last_line, false) AS tabular_line FROM lines l LEFT JOIN main USING (doc_id)""",
    "dbscan_points": f"""WITH RECURSIVE v AS (SELECT label AS doc_id, vec_id::INT AS line_no, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings WHERE label IS NOT NULL),
z AS (SELECT doc_id, line_no, [(x - avg(x) OVER d) / CASE WHEN stddev_pop(x) OVER d < 1e-9 THEN 1 ELSE stddev_pop(x) OVER d END, (y - avg(y) OVER d) / CASE WHEN stddev_pop(y) OVER d < 1e-9 THEN 1 ELSE stddev_pop(y) OVER d END] AS p FROM v WINDOW d AS (PARTITION BY doc_id)),
{_clusters(0.3, 4)} SELECT * FROM labels""",
    "regex_search": _SEARCH,
    "keyword_match_statistics": _WITH_STATS,
    "correction_candidates": _DISTANCES,
    "invoice_tables": _reconcile("documented", False, f"{_CELLS[5:].replace('SELECT doc_id, row_id, col_id::INT AS col_id, coalesce', 'cells AS (SELECT doc_id, row_id, col_id::INT AS col_id, coalesce').replace('gr AS (SELECT doc_id, line_no, row_id, unnest(range(h)) AS col_id FROM rw)', 'gr AS (SELECT doc_id, line_no, row_id, unnest(range(h)) AS col_id FROM rw),')}), {_PARSES}"),
    "line_vectors": f"""WITH {_LAYOUT}, ch AS (SELECT doc_id, line_no, word_no, unnest(range(length(text))) AS i, unnest(string_split(text, '')) AS c FROM words),
pl AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY word_no, i) AS place, CASE WHEN instr({_ENC}, c) > 0 THEN instr({_ENC}, c) - 1 ELSE 116 END AS code FROM ch)
SELECT doc_id, line_no, count(*) AS n, sum(place * code)::BIGINT AS weighted FROM pl GROUP BY ALL""",
    "abbreviations": f"""WITH {_LAYOUT} SELECT DISTINCT text AS word, lower(text) IN ('kg', 'cm', 'mm', 'm', 'l', 'ml', 'g', 'mg', 'oz', 'lb', 'pz', 'pcs', 'tl', 'tlf', 'tel', 'fax', 'cel', 'mob', 'sk', 'sku', 'upc', 'pal', 'red', 'delg', 'punt', 'clav', 'torn', 'tuerc', 'arand', 'caja', 'bols', 'paq', 'unid', 'doc', 'docena', 'caj')
  OR NOT regexp_matches(lower(text), '[aeiouáéíóúü]') OR regexp_matches(text, '[a-z][A-Z]|[A-Z][a-z]') OR regexp_matches(lower(text), '^([a-z]+\\d+|\\d+[a-z]+|[a-z]+/[a-z0-9]+|[a-z]+\\.[a-z.]*|\\d+x\\d+|[a-z]{{1,2}}\\d{{1,2}}|[a-z]+[0-9]+[a-z]*|[0-9]+[a-z]+[0-9]*|[a-z]+[0-9]+[a-z]+)$') AS abbreviation FROM words""",
    "header_texts": f"""WITH {_LINES}, hl AS (SELECT doc_id, min(line_no) AS line_no FROM assigned GROUP BY ALL) SELECT doc_id, string_agg(ocr_text, '|' ORDER BY place) AS header FROM assigned JOIN hl USING (doc_id, line_no) WHERE ocr_text <> '' GROUP BY ALL""",
    "recognised_update": f"""WITH {_LAYOUT} SELECT doc_id, line_no, word_no, CASE WHEN word_no % 3 = 0 THEN text ELSE text || '~' END AS ocr_text, CASE WHEN word_no % 3 = 0 THEN confidence ELSE word_no % 100 + 0.5 END AS confidence FROM words""",
    "image_metadata": """SELECT 'page_' || page_id AS doc_id, 'page_' || page_id || '.png' AS image_name, 'png' AS format, (page_id % 5 * 100)::INT AS width, length(coalesce(url, ''))::INT AS height, strlen(coalesce(html, ''))::BIGINT AS size, CASE WHEN page_id % 2 = 0 THEN 'L' END AS color FROM pages WHERE page_id % 5 > 0""",
    "orphan_events": "SELECT event_type, count(*) AS n FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY ALL",
    "record_inserts": """SELECT o_orderstatus AS "TipoDocumento", count(*) AS n, round(sum(o_totalprice), 2)::DOUBLE AS total FROM (SELECT coalesce(CASE o_orderstatus WHEN 'F' THEN 'factura' WHEN 'O' THEN 'nota' END, 'ticket') AS o_orderstatus, o_totalprice FROM orders) GROUP BY ALL""",
}
