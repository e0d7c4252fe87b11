"""Sinks: payloads, detail rows, tables and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import parsed

# The relational schema of the results.
TABLES = {
    "RegistrosCompra": "IDRegistro STRING, IDClienteConsultoria STRING, FolioDocumento STRING, FechaDocumento DATE, IDProveedor STRING, ProveedorEstandarizado STRING, RFCProveedor STRING, MontoTotalDocumento DECIMAL(12,2), TipoDocumento STRING, UUID STRING, RequiereRevisionManual BOOLEAN, NotasRegistro STRING, FechaDigitalizacion TIMESTAMP, TasaIVAGeneral DECIMAL(4,2), MontoIVAGeneral DECIMAL(12,2), MontoSubtotalGeneral DECIMAL(12,2)",
    "DetallesCompra": "IDDetalle INT, IDRegistro STRING, Cantidad DECIMAL(10,3), SKU INT, ProductoEstandarizado STRING, PrecioUnitario DECIMAL(12,4), ImporteRaw DECIMAL(12,2), ImporteCalculado DECIMAL(12,2)",
    "TransaccionesCompra": "IDTransaccion INT, IDRegistro STRING, FechaTransaccion DATE, TipoTransaccion BOOLEAN, MontoTransaccion DECIMAL(12,2), SaldoPendiente DECIMAL(12,2), ReferenciaTransaccion STRING",
    "Productos": "SKU INT, Presentacion STRING, ProductoEstandarizado STRING, ProductoRAW STRING, Marca STRING, Contenido STRING, UMC STRING, Unidades STRING, UME STRING, CategoriaProducto STRING",
    "Proveedores": "IDProveedor STRING, ProveedorEstandarizado STRING, RFCProveedor STRING, EsInformal BOOLEAN, PActivo BOOLEAN, NotasProveedor STRING",
    "Clientes": "IDCliente STRING, NombreCliente STRING, TelefonoCliente STRING, DireccionCliente STRING, Giro STRING, RFCCliente STRING, Cactivo BOOLEAN, NotasCliente STRING",
}
#: Keys of the tables, and whose keys they refer to.
KEYS = {"RegistrosCompra": "IDRegistro", "DetallesCompra": "IDDetalle", "TransaccionesCompra": "IDTransaccion", "Productos": "SKU", "Proveedores": "IDProveedor", "Clientes": "IDCliente"}
REFERENCES = (("DetallesCompra", "IDRegistro", "RegistrosCompra"), ("TransaccionesCompra", "IDRegistro", "RegistrosCompra"), ("RegistrosCompra", "IDProveedor", "Proveedores"), ("DetallesCompra", "SKU", "Productos"))
DEFAULT_TYPE = "ticket"


def create_tables(spark: SparkSession, database: str = "default") -> None:
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def records(rows: DataFrame, first: int = 1) -> DataFrame:
    """Rows as RegistrosCompra has them: its columns by name, null where rows has
    none, DEFAULT_TYPE where the type is null, and numbers from `first` on, in the
    order of folio, where the key is null."""
    kinds = dict(c.split(" ") for c in TABLES["RegistrosCompra"].split(", "))
    own = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
    typed = rows.select(*own).withColumn("TipoDocumento", F.coalesce("TipoDocumento", F.lit(DEFAULT_TYPE)))
    keyed, bare = typed.where("IDRegistro IS NOT NULL"), typed.where("IDRegistro IS NULL")
    number = F.monotonically_increasing_id() + first
    return keyed.unionByName(bare.orderBy("FolioDocumento").withColumn("IDRegistro", number.cast("string")))


def insert(rows: DataFrame, table: str) -> None:
    """Appends the rows whose key the table doesn't have yet; of rows with one key,
    one. Null keys are refused."""
    spark, key = rows.sparkSession, KEYS[table.split(".")[-1]]
    new = rows.where(F.col(key).isNotNull()).dropDuplicates([key]).join(spark.table(table).select(key), key, "left_anti")
    new.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def broken_references(spark: SparkSession, database: str = "default") -> DataFrame:
    """child, key, value, n: keys that the tables refer to and that don't exist."""
    out = None
    for child, key, parent in REFERENCES:
        lost = orphans(spark.table(f"{database}.{child}"), spark.table(f"{database}.{parent}"), key, KEYS[parent])
        one = lost.groupBy(F.col(key).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(child).alias("child"), F.lit(key).alias("key"), "value", "n")
        out = one if out is None else out.unionByName(one)
    return out


def details(cells: DataFrame, winner: DataFrame) -> DataFrame:
    """doc_id, row_id, cantidad, precio_unitario, importe_raw, importe_calculado
    from the cells of the columns in those roles."""
    role = cells.join(winner, "doc_id")
    of = lambda r: F.max(F.when(F.col("col_id") == F.col(r), parsed(F.col("text"))))
    return role.groupBy("doc_id", "row_id").agg(of("c").alias("cantidad"), of("pu").alias("precio_unitario"), of("mtl").alias("importe_raw")).withColumn("importe_calculado", F.col("cantidad") * F.col("precio_unitario"))


def payload(cells: DataFrame, detail: DataFrame) -> DataFrame:
    """doc_id, n_rows, payload: a JSON document with the detail rows and the raw
    table, missing cells as empty texts."""
    rows = cells.groupBy("doc_id", "row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_id", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x.t).alias("cells"))
    raw = rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "cells"))), lambda x: x.cells).alias("raw_table"))
    each = detail.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("row_id", "cantidad", "precio_unitario", "importe_raw", "importe_calculado"))).alias("detalles"))
    both = raw.join(each, "doc_id", "left")
    return both.select("doc_id", F.size("raw_table").alias("n_rows"), F.to_json(F.struct("doc_id", "detalles", "raw_table")).alias("payload"))


def recent(rows: DataFrame, at: str, key: str, n: int = 100) -> DataFrame:
    """The latest n rows."""
    return rows.orderBy(F.desc(at), key).limit(n)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key no row of parent has; null keys are no orphans."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def save_tables(cells: DataFrame, folder: str, fmt: str = "csv", mode: str = "overwrite", names: list[str] | None = None, buckets: int | None = None) -> None:
    """Wide tables, col_0 on (or by names), under folder/doc_id=...; with buckets,
    under that many folders bucket=..., doc_id being a column: a folder a document is
    for few documents."""
    most = cells.agg(F.max("col_id")).first()[0]
    name = lambda i: names[i] if names and i < len(names) else f"col_{i}"
    wide = cells.groupBy("doc_id", "row_id").agg(*[F.max(F.when(F.col("col_id") == i, F.col("text"))).alias(name(i)) for i in range((most if most is not None else -1) + 1)])
    if buckets:
        wide = wide.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")).repartition(buckets, "bucket").sortWithinPartitions("bucket", "doc_id", "row_id")
        out = wide.write.mode(mode).partitionBy("bucket")
    else:
        out = wide.sortWithinPartitions("doc_id", "row_id").drop("row_id").write.mode(mode).partitionBy("doc_id")
    (out.option("header", "true").csv if fmt == "csv" else out.json if fmt == "json" else out.parquet)(folder)


def save_corrected(cells: DataFrame, header: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """A line of text a row of each table, under its header: the texts of
    header(doc_id, header), else the columns' names. Cells are quoted as in CSV."""
    quoted = lambda c: F.when(c.rlike('[",\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = lambda a: F.array_join(F.transform(a, quoted), ",")
    rows = cells.groupBy("doc_id", "row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_id", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x.t).alias("cells"))
    width = cells.groupBy("doc_id").agg(F.max("col_id").alias("last"))
    own = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.concat(F.lit("col_"), i.cast("string")))
    head = width.join(header, "doc_id", "left").select("doc_id", F.lit(-1).alias("row_id"), F.when(F.size("header") > 0, F.col("header")).otherwise(own).alias("cells"))
    every = rows.select("doc_id", F.col("row_id").cast("int").alias("row_id"), "cells").unionByName(head)
    every.select("doc_id", "row_id", line(F.col("cells")).alias("line")).repartition("doc_id").sortWithinPartitions("doc_id", "row_id").write.mode(mode).parquet(folder)


def save_text(rows: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """The column text as lines."""
    rows.select(F.coalesce("text", F.lit("")).alias("value")).write.mode(mode).text(folder)


def export_payload(payloads: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """The JSON documents of `payload`, one a line."""
    payloads.select(F.col("payload").alias("value")).write.mode(mode).text(folder)


def totals(runs: DataFrame) -> DataFrame:
    """images, seconds and the mean, of runs(seconds), in one row; no images, no mean."""
    return runs.agg(F.count("*").alias("images"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"), F.avg("seconds").alias("mean"))


def append_master(cells: DataFrame, title: str, table: str) -> None:
    """Adds the cells to a table of all sections."""
    cells.withColumn("section_title", F.lit(title)).write.mode("append").saveAsTable(table)


def save_ocr(polygons: DataFrame, folder: str) -> None:
    """A JSON document a page: its words with text and confidence."""
    polygons.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("poly_no", "ocr_text", "confidence"))).alias("polygons")).write.mode("overwrite").json(folder)
