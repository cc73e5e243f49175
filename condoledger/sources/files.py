"""File readers A1–A8: every cell read as text, typed later.

All readers take an explicit all-string schema (no inference), so a bad cell
never fails the read; the cleaning rules decide what is valid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Column layouts of the reference's input files.
BUILDINGS_COLS = ["Nombre del consorcio", "Domicilio", "m2 totales"]
SUPPLIERS_COLS = ["tipo", "descripcion", "proveedor", "consorcio"]
UNITS_COLS = ["CVU/CBU", "Nombre del consorcio", "nroUnidadFuncional", "piso", "departamento"]
AREAS_COLS = ["Nombre del consorcio", "nroUnidadFuncional", "Piso", "departamento", "coeficiente",
              "m2_unidad_funcional", "bauleras", "cochera", "m2_baulera", "m2_cochera"]
PEOPLE_COLS = ["Nombre", "apellido", "DNI", "email personal", "telefono de contacto", "CVU/CBU", "Inquilino"]
EXPENSES_JSON_COLS = ["Nombre del consorcio", "Mes", "BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS",
                      "GASTOS GENERALES", "SERVICIOS PUBLICOS-Agua", "SERVICIOS PUBLICOS-Luz"]
PAYMENTS_COLS = ["c1", "c2", "c3", "c4"]


def _csv(spark: SparkSession, path: str, cols: list[str], sep: str, header: bool,
         encoding: str = "UTF-8", quote: str | None = None) -> DataFrame:
    r = (spark.read.schema(string_schema(cols)).option("header", header).option("sep", sep)
         .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if quote is not None:
        r = r.option("quote", quote)
    return r.csv(path)


def read_buildings_sheet(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A1: buildings sheet exported as CSV (Nombre, Domicilio, m2 totales)."""
    return _csv(spark, path, BUILDINGS_COLS, ",", header, quote='"')


def read_suppliers_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A2: headerless supplier sheet; positional F1..F4 -> tipo, descripcion, proveedor, consorcio."""
    return _csv(spark, path, SUPPLIERS_COLS, ",", False, quote='"')


def read_units_pipe(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A4: pipe-separated UTF-8 unit file."""
    return _csv(spark, path, UNITS_COLS, "|", header)


# Code pages that the load procedures name.
CODE_PAGES = {"65001": "UTF-8", "ACP": "ISO-8859-1", "1252": "ISO-8859-1", "28591": "ISO-8859-1", "1200": "UTF-16LE"}


def code_page(name: str) -> str:
    """Charset of a code page number or name; a charset name stays as it is."""
    return CODE_PAGES.get(name.upper(), name)


def row_terminator(text: str) -> str:
    """A row terminator given as text, escaped ('\\n') or as hex bytes ('0x0d0a')."""
    if text.lower().startswith("0x"):
        return bytes.fromhex(text[2:]).decode("latin-1")
    return text.replace("\\r", "\r").replace("\\n", "\n").replace("\\t", "\t")


def read_areas_tab(spark: SparkSession, path: str, header: bool = True, row_term: str = "0x0d0a",
                   encoding: str = "65001") -> DataFrame:
    """A5: tab-separated unit areas with a row terminator and a code page.

    CR, LF and CRLF all end a row by default. Any other terminator makes the
    file a text source split at it (still read in splits), whose rows are then
    taken apart at the tabs.
    """
    term, charset = row_terminator(row_term), code_page(encoding)
    if term in ("\n", "\r", "\r\n"):
        return _csv(spark, path, AREAS_COLS, "\t", header, charset)
    lines = spark.read.option("lineSep", term).option("encoding", charset).text(path).filter("trim(value) <> ''")
    rows = lines.select(F.from_csv("value", ", ".join(f"`{c}` string" for c in AREAS_COLS), {"sep": "\t"}).alias("r")).select("r.*")
    if not header:
        return rows
    first = [F.coalesce(F.col(f"`{c}`") == c, F.lit(False)) for c in AREAS_COLS]      # the line of column names
    return rows.filter(~reduce(lambda a, b: a & b, first))


def read_people_semicolon(spark: SparkSession, path: str, header: bool = True,
                          encoding: str = "ACP") -> DataFrame:
    """Semicolon-separated people file in an ANSI code page. Spark 4 only
    accepts standard charsets for CSV unless ``spark.sql.legacy.javaCharsets``
    is set, so the default is ISO-8859-1 (the same letters as Windows-1252
    for Spanish text; 0x80-0x9F differ)."""
    return _csv(spark, path, PEOPLE_COLS, ";", header, code_page(encoding))


def read_expenses_json(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """A3: JSON array of flat objects (keys with spaces), read in splits.

    The text is split after each closing brace, so a large array is read by
    many tasks. A brace inside a text value would break an object apart; such
    pieces are counted, and where there are any the files are read again by
    the multi-line reader (one task a file).
    """
    schema = string_schema(cols or EXPENSES_JSON_COLS)
    read = spark.read.option("recursiveFileLookup", True)
    piece = F.regexp_replace("value", r"^[\s,\[\ufeff]+", "")
    pieces = read.option("lineSep", "}").text(path).select(piece.alias("piece")).filter(~F.col("piece").rlike(r"^[\s\]]*$"))
    checked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    rows = pieces.select(F.from_json(F.concat("piece", F.lit("}")), checked, {"columnNameOfCorruptRecord": "_broken"}).alias("r")).select("r.*")
    if rows.filter(F.col("_broken").isNotNull()).isEmpty():
        return rows.drop("_broken")
    return read.schema(schema).option("multiLine", True).json(path)


def source_file() -> Column:
    """Name of the file that a row was read from: of a folder of part files the
    folder's, else the file's own."""
    path = F.col("_metadata.file_path")
    own = F.substring_index(path, "/", -1)
    return F.when(own.startswith("part-"), F.substring_index(F.substring_index(path, "/", -2), "/", 1)).otherwise(own)


def payment_cell(name: str) -> Column:
    """A cell of the bank file without CR, LF and BOM."""
    return F.translate(name, "\r\n\ufeff", "").alias(name)


def read_payments_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",",
                      encoding: str = "UTF-8", with_file: bool = False) -> DataFrame:
    """Comma CSV with '"' quotes; CR, LF and BOM stripped from every cell.
    ``with_file`` adds the row's file name as ``file``."""
    df = _csv(spark, path, PAYMENTS_COLS, sep, header, encoding, quote='"')
    return df.select(*[payment_cell(c) for c in PAYMENTS_COLS],
                     *([source_file().alias("file")] if with_file else []))


def legacy_payment_layout(df: DataFrame) -> DataFrame:
    """Older loader layout switch: blank 4th cell -> 3-column rows
    (fecha, cbu, valor), else (id, fecha, cbu, valor)."""
    blank4 = F.coalesce(F.trim("c4"), F.lit("")) == ""
    return df.select(F.when(blank4, F.lit(None)).otherwise(F.col("c1")).alias("c1"),
                     F.when(blank4, F.col("c1")).otherwise(F.col("c2")).alias("c2"),
                     F.when(blank4, F.col("c2")).otherwise(F.col("c3")).alias("c3"),
                     F.when(blank4, F.col("c3")).otherwise(F.col("c4")).alias("c4"))


def read_fx_quotes_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed quote documents {compra, venta} (one JSON object per line)."""
    return spark.read.schema(string_schema(["tipo", "fecha", "compra", "venta"])).json(path)


def land_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Write a text DataFrame as a CSV folder (quotes where needed), packed: the
    text of a large file would be the largest thing on the disk."""
    (df.write.mode("overwrite").option("header", header).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("compression", "lz4").csv(path))
    return path
