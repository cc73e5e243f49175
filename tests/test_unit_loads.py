"""L4 / L5 on hand-made files, and the readers A3-A6 on files with content."""

import json
from types import SimpleNamespace

import pytest

from condoledger.plans import unit_loads as UL
from condoledger.sources import files as S

B22 = {d: d * 22 for d in "123456789"}
UNITS = "id_unit long, id_building long, floor int, dept string, cbu string"
FILE = "cbu string, building string, unit string, piso string, departamento string"


@pytest.fixture
def lg(tmp_path):
    return SimpleNamespace(root=str(tmp_path))


def run(spark, lg, rows, units, buildings=((1, "Árbol"), (2, "Beta"))):
    b = spark.createDataFrame(list(buildings), "id_building long, name string")
    load = UL.load_units(lg, spark.createDataFrame(rows, FILE), spark.createDataFrame(units, UNITS), b)
    after = {r["id_unit"]: (r["id_building"], r["floor"], r["dept"], r["cbu"], r["action"]) for r in load.units.collect()}
    rejects = sorted((r["reason"], r["unit"], r["cbu"]) for r in load.rejects.collect())
    return after, rejects, {r["name"]: r["id_building"] for r in load.buildings.collect()}, load.summary.first().asDict()


def test_known_unit_by_id_in_its_own_building_only(spark, lg):
    units = [(1, 1, None, "A", None), (2, 2, 1, "B", B22["2"])]
    rows = [(B22["1"], " arbol ", "1", "PB", "z"), (B22["3"], "Árbol", "2", "5", "C")]
    after, rejects, buildings, counts = run(spark, lg, rows, units)
    assert after == {1: (1, 0, "z", B22["1"], "UPDATE"), 2: (2, 1, "B", B22["2"], "KEEP")}
    assert rejects == [(UL.OTHER_BUILDING, 2, B22["3"])]
    assert buildings == {"Árbol": 1, "Beta": 2}                 # the file's spelling made no new one
    assert counts == {"rows_read": 2, "rows_staged": 2, "inserted": 0, "updated": 1, "new_buildings": 0, "rejected": 1}


def test_blank_cells_keep_old_values_and_one_whole_row_is_taken(spark, lg):
    units = [(1, 1, 3, "A", B22["1"])]
    after, rejects, _, _ = run(spark, lg, [("", "Arbol", "1", "", ""), (B22["4"], "Arbol", "1", "7", "")], units)
    assert after == {1: (1, 7, "A", B22["4"], "UPDATE")}
    after, rejects, _, _ = run(spark, lg, [(B22["5"], "Arbol", "1", "8", "B"), (B22["4"], "Arbol", "1", "7", "C")], units)
    assert after == {1: (1, 7, "C", B22["4"], "UPDATE")}        # not floor 7 with department B
    assert rejects == [(UL.REPEATED, 1, B22["5"])]


def test_blank_id_matches_by_place_with_blanks(spark, lg):
    units = [(4, 1, None, None, None), (3, 1, None, None, None), (5, 1, 2, None, None)]
    rows = [(B22["6"], "ARBOL", "", "", ""), (B22["7"], "ARBOL", "", "", ""), (B22["8"], "ARBOL", " ", "2", "")]
    after, rejects, _, _ = run(spark, lg, rows, units)
    assert after == {3: (1, None, None, B22["6"], "UPDATE"), 4: (1, None, None, None, "KEEP"), 5: (1, 2, None, B22["8"], "UPDATE")}
    assert rejects == [(UL.REPEATED, None, B22["7"])]


def test_place_pass_sees_what_the_id_pass_left(spark, lg):
    """Unit 1 moves to floor 9 by its id; the blank row for floor 9 then means it,
    and its bank id claim comes after the id pass's."""
    units = [(1, 1, 3, "A", None), (2, 1, 4, "A", None)]
    rows = [("", "Arbol", "1", "9", "A"), (B22["1"], "Arbol", "", "9", "A"), (B22["1"], "Arbol", "2", "4", "A")]
    after, rejects, _, _ = run(spark, lg, rows, units)
    assert after == {1: (1, 9, "A", None, "UPDATE"), 2: (1, 4, "A", B22["1"], "UPDATE")}
    assert rejects == [(UL.BANK_ID_TAKEN, None, B22["1"])]


def test_new_units_and_buildings_and_double_claims(spark, lg):
    units = [(10, 1, 1, "A", B22["1"])]
    rows = [(B22["2"], "Gamma", "77", "1", "A"), (B22["3"], "gámma ", "78", "2", "A"),      # one new building
            (B22["1"], "Beta", "79", "3", "A"),                                            # held by unit 10
            (B22["4"], "Beta", "80", "4", "A"), (B22["4"], "Beta", "81", "5", "A"),          # claimed twice
            ("", "Beta", "82", "6", "A"), (B22["5"], "Arbol", "83", "1", "A"),               # place of unit 10
            (B22["6"], "  ", "84", "1", "A"), ("12-34", "Beta", "", "6", "B")]
    after, rejects, buildings, counts = run(spark, lg, rows, units)
    assert buildings == {"Árbol": 1, "Beta": 2, "Gamma": 3}
    new = sorted(v for k, v in after.items() if k > 10)
    assert new == sorted([(2, 4, "A", B22["4"], "INSERT"), (2, 6, "A", None, "INSERT"), (2, 6, "B", None, "INSERT"),
                          (3, 1, "A", B22["2"], "INSERT"), (3, 2, "A", B22["3"], "INSERT")], key=str)
    assert sorted(after) == [10, 11, 12, 13, 14, 15] and after[10][-1] == "KEEP"
    assert rejects == sorted([(UL.BANK_ID_TAKEN, 79, B22["1"]), (UL.BANK_ID_TAKEN, 81, B22["4"]), (UL.KNOWN_PLACE, 83, B22["5"]),
                              (UL.NO_BUILDING, 84, B22["6"])])
    assert counts["inserted"] == 5 and counts["new_buildings"] == 1 and counts["rejected"] == 4


def test_second_load_of_the_same_file_changes_nothing(spark, lg):
    units = [(1, 1, None, "A", None)]
    rows = [(B22["1"], "Arbol", "1", "2", "A"), (B22["2"], "Arbol", "", "3", "B")]
    b = spark.createDataFrame([(1, "Arbol")], "id_building long, name string")
    raw = spark.createDataFrame(rows, FILE)
    first = UL.load_units(lg, raw, spark.createDataFrame(units, UNITS), b)
    again = UL.load_units(lg, raw, first.units.drop("action"), first.buildings.drop("action"))
    assert {r["action"] for r in again.units.collect()} == {"KEEP"}
    assert sorted(again.units.drop("action").collect()) == sorted(first.units.drop("action").collect())
    assert again.rejects.count() == 0


def test_empty_file(spark, lg):
    after, rejects, _, counts = run(spark, lg, spark.createDataFrame([], FILE).collect(), [(1, 1, 2, "A", None)])
    assert after == {1: (1, 2, "A", None, "KEEP")} and rejects == [] and counts["rows_read"] == 0


def test_areas_by_place(spark, lg):
    units = spark.createDataFrame([(1, 1, None, None, None, "40.00", None, None), (2, 1, 2, "A", "5.00", None, "1.00", None)],
                                  "id_unit long, id_building long, floor int, dept string, share string, area string, storage_m2 string, garage_m2 string")
    units = units.selectExpr("id_unit", "id_building", "floor", "dept", "cast(share as decimal(5,2)) share", "cast(area as decimal(7,2)) area",
                             "cast(storage_m2 as decimal(5,2)) storage_m2", "cast(garage_m2 as decimal(5,2)) garage_m2")
    rows = [("Arból", "", "", "", "3,5", "", "", ""), ("arbol", "", "", "", "2,0", "50", "", ""), ("ARBOL", "9", "2", "A", "", "", "", "7"),
            ("Nuevo", "", "1", "B", "1", "2", "3", "4"), ("", "", "1", "B", "1", "2", "3", "4")]
    raw = spark.createDataFrame(rows, "building string, unit string, piso string, departamento string, coeficiente string, m2_unidad string, "
                                      "m2_baulera string, m2_cochera string")
    load = UL.load_areas(lg, raw, units, spark.createDataFrame([(1, "Árbol")], "id_building long, name string"))
    got = {r["id_unit"]: tuple(None if v is None else str(v) for v in r[1:]) for r in load.units.collect()}
    assert got == {1: ("1", None, None, "3.50", "50.00", None, None, "UPDATE"), 2: ("1", "2", "A", "5.00", None, "1.00", "7.00", "UPDATE"),
                   3: ("2", "1", "B", "1.00", "2.00", "3.00", "4.00", "INSERT")}
    assert load.rejects.count() == 1


# ------------------------------------------------------------------ readers
OBJECTS = [{"Nombre del consorcio": "Árbol", "Mes": "enero", "BANCARIOS": "1.234,50", "SERVICIOS PUBLICOS-Agua": None},
           {"Nombre del consorcio": "Beta", "Mes": "Ma yo", "LIMPIEZA": "a \"quoted\" text, [x]\n"}]


@pytest.mark.parametrize("text", [json.dumps(OBJECTS), json.dumps(OBJECTS, indent=2, ensure_ascii=False), "﻿" + json.dumps(OBJECTS),
                                  json.dumps([OBJECTS[0], {**OBJECTS[1], "LIMPIEZA": "braces {in} a value}"}])])
def test_json_array_in_splits(spark, tmp_path, text):
    (tmp_path / "e.json").write_text(text, encoding="utf-8")
    rows = S.read_expenses_json(spark, str(tmp_path / "e.json")).collect()
    want = json.loads(text.lstrip("﻿"))
    assert [{k: r[k] for k in S.EXPENSES_JSON_COLS} for r in rows] == [{k: o.get(k) for k in S.EXPENSES_JSON_COLS} for o in want]


def test_json_array_is_read_by_many_tasks(spark, tmp_path):
    objects = [{"Nombre del consorcio": f"C{i}", "Mes": "enero", "BANCARIOS": "1" * 500} for i in range(4000)]
    (tmp_path / "e.json").write_text(json.dumps(objects))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        df = S.read_expenses_json(spark, str(tmp_path / "e.json"))
        assert df.rdd.getNumPartitions() > 4
        assert {r[0] for r in df.collect()} == {o["Nombre del consorcio"] for o in objects} and df.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("term,page,charset", [("0x0d0a", "65001", "utf-8"), ("0x0a", "ACP", "latin-1"), ("\\n", "1252", "latin-1"),
                                               ("0x3b", "65001", "utf-8"), ("||", "65001", "utf-8")])
def test_areas_row_terminator_and_code_page(spark, tmp_path, term, page, charset):
    rows = [["Ñandú", "1", "PB", "A", "1,5", "40,5", "SI", "NO", "3,5", "0"], ["Beta", "2", "", "", "", "", "", "", "", ""]]
    body = S.row_terminator(term).join("\t".join(r) for r in [S.AREAS_COLS, *rows]) + S.row_terminator(term)
    (tmp_path / "a.txt").write_bytes(body.encode(charset))
    got = [[x or "" for x in r] for r in S.read_areas_tab(spark, str(tmp_path / "a.txt"), True, term, page).collect()]
    assert got == rows


def test_units_and_people_files(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes("a|b|c|d|e\r\n0001| Ñu |7|PB| A\r\n|x||||\r\n".encode())
    assert [tuple(r) for r in S.read_units_pipe(spark, str(tmp_path / "u.txt")).collect()] == [
        ("0001", " Ñu ", "7", "PB", " A"), (None, "x", None, None, None)]
    (tmp_path / "p.csv").write_bytes("a;b;c;d;e;f;g\r\nJosé;Peña;1;x@y.z;011;22;Sí\r\n".encode("latin-1"))
    assert tuple(S.read_people_semicolon(spark, str(tmp_path / "p.csv")).first()) == ("José", "Peña", "1", "x@y.z", "011", "22", "Sí")
