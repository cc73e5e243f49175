"""Landed files: the raw frames of ``rawtext`` written once per ledger in the
format of their reader (SURVEY A1-A6) in the shared checkpoint folder, and
read back by that reader, so that every loader's rows come through files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files as S
from . import rawtext as RT
from .ledger import Ledger


def _csv(df: DataFrame, path: str, sep: str, header: bool = True, encoding: str = "UTF-8") -> None:
    (df.write.mode("overwrite").option("header", header).option("sep", sep).option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _json_arrays(df: DataFrame, path: str, by: str) -> None:
    """One file per value of ``by``, holding one JSON array of its rows (a
    building has at most a row a month)."""
    rows = df.groupBy(F.col(by).alias("_of")).agg(F.sort_array(F.collect_list(F.to_json(F.struct(*df.columns)))).alias("r"))
    text = rows.select("_of", F.concat(F.lit("[\n"), F.array_join("r", ",\n"), F.lit("\n]")).alias("value"))
    text.write.mode("overwrite").partitionBy("_of").text(path)


def _land(lg: Ledger, name: str, write) -> str:
    """Path of a landed file; written on first use in this ledger's folder."""
    paths = lg.__dict__.setdefault("_landed", {})
    if name not in paths:
        paths[name] = f"{lg.root}/landed/{name}"
        write(paths[name])
    return paths[name]


def _from_file(read: DataFrame, raw: DataFrame) -> DataFrame:
    """The reader's columns under the raw frame's names (both in file order)."""
    return read.toDF(*raw.columns)


def buildings(lg: Ledger) -> DataFrame:
    raw = RT.raw_buildings(lg)
    path = _land(lg, "buildings.csv", lambda p: _csv(raw, p, ","))
    return _from_file(S.read_buildings_sheet(lg.spark, path), raw)


def suppliers(lg: Ledger, raw: DataFrame) -> DataFrame:
    path = _land(lg, "suppliers.csv", lambda p: _csv(raw, p, ",", header=False))
    return _from_file(S.read_suppliers_sheet(lg.spark, path), raw)


def units(lg: Ledger) -> DataFrame:
    raw = RT.raw_units(lg)
    path = _land(lg, "units.txt", lambda p: _csv(raw, p, "|"))
    return _from_file(S.read_units_pipe(lg.spark, path), raw)


def areas(lg: Ledger) -> DataFrame:
    raw = RT.raw_areas(lg)
    path = _land(lg, "areas.txt", lambda p: _csv(raw, p, "\t"))
    return _from_file(S.read_areas_tab(lg.spark, path), raw)


def people(lg: Ledger) -> DataFrame:
    raw = RT.raw_people(lg)
    path = _land(lg, "people.csv", lambda p: _csv(raw, p, ";", encoding="ISO-8859-1"))
    return _from_file(S.read_people_semicolon(lg.spark, path), raw)


def expenses(lg: Ledger) -> DataFrame:
    raw = RT.raw_expenses(lg)
    path = _land(lg, "expenses.json", lambda p: _json_arrays(raw, p, "Nombre del consorcio"))
    return S.read_expenses_json(lg.spark, path, [*S.EXPENSES_JSON_COLS, "anio"]).select(
        *[F.col(f"`{c}`").cast(raw.schema[c].dataType).alias(c) for c in raw.columns])


def payments(lg: Ledger) -> DataFrame:
    """The bank file with the name of the file that each row came from."""
    path = _land(lg, "payments.csv", lambda p: S.land_csv(RT.raw_payments(lg), p))
    return S.read_payments_csv(lg.spark, path, with_file=True)
