"""Bad records are kept apart, from one pass over the files."""

import pytest
from edge_data import full_width

from punctuality.schema import FLIGHT_SCHEMA
from punctuality.sources.rejects import land_checked, read_good, read_marked, read_rejects, reject_values

SCHEMA = "a INT, b STRING, c FLOAT"
TEXT = r"""a,b,c
1,one,1.5
x,two,2.5
3,"thr,ee",3.5
4,four
5,five,5.5,more
6,six,n/a
7,,
"8",'"seven"',7.0
"""


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "in.csv").write_text(TEXT)
    land_checked(read_marked(spark, str(tmp_path / "in.csv"), SCHEMA), str(tmp_path / "out"))
    return str(tmp_path / "out")


def test_good_and_bad_records(spark, landed):
    good = read_good(spark, landed)
    assert good.columns == ["a", "b", "c"]
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(
        [(1, "one", 1.5), (3, "thr,ee", 3.5), (7, None, None), (8, "'\"seven\"'", 7.0)], key=repr
    )
    bad = read_rejects(spark, landed)
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("in.csv", "4,four"), ("in.csv", "5,five,5.5,more"), ("in.csv", "6,six,n/a"), ("in.csv", "x,two,2.5"),
    ]
    values = reject_values(bad, SCHEMA).orderBy("a")
    assert [tuple(r) for r in values.select("n_values", "a", "b", "c").collect()] == [
        (2, "4", "four", None), (4, "5", "five", "5.5"), (3, "6", "six", "n/a"), (3, "x", "two", "2.5"),
    ]


def test_all_bad_none_bad_and_no_rows(spark, tmp_path):
    for name, rows in {"bad": "x,b,1.0\n", "good": "1,b,1.0\n", "none": ""}.items():
        (tmp_path / f"{name}.csv").write_text("a,b,c\n" + rows)
        land_checked(read_marked(spark, str(tmp_path / f"{name}.csv"), SCHEMA), str(tmp_path / name))
    assert read_good(spark, str(tmp_path / "bad")).count() == 0 and read_rejects(spark, str(tmp_path / "bad")).count() == 1
    assert read_good(spark, str(tmp_path / "good")).count() == 1 and read_rejects(spark, str(tmp_path / "good")).count() == 0


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,c,b\n1,one,1.5\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_marked(spark, str(tmp_path / "in.csv"), SCHEMA).collect()


def test_whole_width(spark, tmp_path):
    (tmp_path / "in.csv").write_text(full_width())
    marked = read_marked(spark, str(tmp_path / "in.csv"))
    plain = spark.read.csv(str(tmp_path / "in.csv"), header=True, schema=FLIGHT_SCHEMA)
    assert marked.filter("_corrupt_record IS NULL").drop("_corrupt_record", "file").columns == plain.columns
    assert marked.count() == plain.count()
