"""Golden rows of the document transform (hand traces of the original behaviour).

``compat`` reproduces the original lookup order and lone-'$' handling; the default
(fixed) mode differs only where noted."""

from decimal import Decimal as D

import pytest

from paysheaf.functions.clubs import CLUB_FIRST_WORDS_COMPAT, ClubLookup, reference_club_dim
from paysheaf.operators.headers import header_table
from paysheaf.operators.salary_etl import salary_records
from paysheaf.schemas import RAW_ROWS

H1 = "Club Last Name First Name Pos Base Salary Compensation".split()
H_NAMES_FIRST = "First Name Last Name Club Position Base Salary Guaranteed Compensation".split()
H_CELLS = ["Club", "Last Name", "First Name", "Base Salary", "Guaranteed Compensation", "Position"]
TITLE = "2018 MLS Player Salaries - Alphabetical List".split()


def run(spark, header, rows, fmt="pdf", compat=False):
    data = [("s1", 2018, fmt, 0, TITLE), ("s1", 2018, fmt, 1, header)]
    data += [("s1", 2018, fmt, i + 2, r) for i, r in enumerate(rows)]
    raw = spark.createDataFrame(data, RAW_ROWS)
    fw = CLUB_FIRST_WORDS_COMPAT if compat else None
    lookup = ClubLookup.from_dim(reference_club_dim(spark), first_words=fw)
    out = salary_records(raw, lookup, compat).orderBy("row_no").collect()
    return [(r.club, r.last_name, r.first_name, r.position, r.base_salary, r.guaranteed_comp) for r in out]


@pytest.mark.parametrize("compat", [True, False])
def test_g1_normal(spark, compat):
    got = run(spark, H1, ["ATL Doe Jane M $1,912,500.00 $2,297,000.00".split()], compat=compat)
    assert got == [("Atlanta United", "Doe", "Jane", "M", D("1912500.00"), D("2297000.00"))]


def test_g2_code_prefix(spark):
    row = ["LA Galaxy Doe Jane F $100.00 $200.00".split()]
    assert run(spark, H1, row, compat=True) == [("LA Galaxy", "Galaxy", "Doe Jane", "F", D("100.00"), D("200.00"))]
    assert run(spark, H1, row) == [("LA Galaxy", "Doe", "Jane", "F", D("100.00"), D("200.00"))]


@pytest.mark.parametrize("compat", [True, False])
def test_g3_g4_g6_g7(spark, compat):
    rows = ["New York City FC Doe Jane D 1000 2,000.50".split(), "SEA Kim $5 $6".split(),
            "Total $1".split(), "Rovers Doe Jane M-F $1 $2".split()]
    assert run(spark, H1, rows, compat=compat) == [
        ("New York City FC", "Doe", "Jane", "D", D("1000.00"), D("2000.50")),
        ("Seattle Sounders FC", "", "", "KIM", D("5.00"), D("6.00")),
        ("Rovers", "Doe", "Jane", "M-F", D("1.00"), D("2.00")),
    ]


def test_g5_lone_dollar(spark):
    row = ["SEA Doe Jane M $ 1,000 $ 2,000".split()]
    assert run(spark, H1, row, compat=True) == []
    assert run(spark, H1, row) == [("Seattle Sounders FC", "Doe", "Jane", "M", D("1000.00"), D("2000.00"))]


@pytest.mark.parametrize("compat", [True, False])
def test_g8_to_g10_names_first(spark, compat):
    rows = ["Jane Doe Inter Miami M $1 $2".split(), "Jae La Cruz Inter Miami M $1 $2".split(),
            "Jane Doe Chivas USA M $1 $2".split()]
    assert run(spark, H_NAMES_FIRST, rows, compat=compat) == [
        ("Inter Miami CF", "Doe", "Jane", "M", D("1.00"), D("2.00")),
        ("LA Galaxy", "Jae", "", "M", D("1.00"), D("2.00")),
        ("Chivas USA", "Doe", "Jane", "M", D("1.00"), D("2.00")),
    ]


def test_g11_trailing_position(spark):
    got = run(spark, H_CELLS, ["SEA Doe Jane $1 $2 M".split()])
    assert got == [("Seattle Sounders FC", "Doe", "Jane", "M", D("1.00"), D("2.00"))]


def test_g12_g13_index_route(spark):
    rows = [["SEA", '"Doe"', "Jane", "$1", "2$", "m"], ["SEA", "Doe", "Jane", "$1"]]
    assert run(spark, H_CELLS, rows, fmt="csv") == [("SEA", "Doe", "Jane", "M", D("1.00"), D("2.00"))]


def test_g14_g15_no_header(spark):
    raw = spark.createDataFrame([("s1", 2018, "pdf", 0, TITLE), ("s1", 2018, "pdf", 1, ["ATL", "$1", "$2"])],
                                RAW_ROWS)
    assert header_table(raw).count() == 0
    lookup = ClubLookup.from_dim(reference_club_dim(spark))
    assert salary_records(raw, lookup).count() == 0


def test_header_column_map(spark):
    raw = spark.createDataFrame([("a", 2018, "pdf", 0, H1), ("b", 2018, "pdf", 0, H_NAMES_FIRST),
                                 ("c", 2018, "csv", 0, H_CELLS)], RAW_ROWS)
    h = {r.source_id: r for r in header_table(raw).collect()}
    assert tuple(h["a"].cmap) == (0, 1, 3, 5, 6, 8) and h["a"].club_first and h["a"].last_first
    assert tuple(h["b"].cmap) == (4, 2, 0, 5, 6, 8) and not h["b"].club_first and not h["b"].last_first
    assert tuple(h["c"].cmap) == (0, 1, 2, 5, 3, 4)


def test_weak_comp_does_not_overwrite(spark):
    header = ["Club", "Last", "First", "Base", "Guaranteed Comp", "Comp."]
    raw = spark.createDataFrame([("a", 2018, "csv", 0, header)], RAW_ROWS)
    assert header_table(raw).collect()[0].cmap.guaranteed_comp == 4
    header2 = ["Club", "Last", "First", "Base", "Comp", "Compensation"]
    raw2 = spark.createDataFrame([("a", 2018, "csv", 0, header2)], RAW_ROWS)
    assert header_table(raw2).collect()[0].cmap.guaranteed_comp == 4
