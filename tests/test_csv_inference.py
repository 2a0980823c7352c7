"""Types of CSV columns from all rows."""

import datetime

import pytest

from tidemark.sources import csv

CELLS = {
    "flag": (["true", "FALSE", None, " true "], "boolean"),
    "small": (["1", "-7", "+3", "2147483647"], "int"),
    "large": (["1", "2", "3", "2147483648"], "bigint"),
    "huge": (["1", "2", "3", "9223372036854775808"], "double"),
    "real": (["1", "2.5", "-1e3", ".5"], "double"),
    "odd": (["1", "NaN", "-Infinity", ""], "double"),
    "when": (["2024-01-02 03:04:05", None, " ", "2024-12-31 23:59:59"], "timestamp"),
    "day": (["2024-01-02", None, None, None], "string"),
    "mixed": (["1", "true", "2", "3"], "string"),
    "times": (["2024-01-02 03:04:05", "5", None, None], "string"),
    "suffix": (["1d", "2f", "3", "4"], "string"),
    "blank": ([None, "", " ", None], "string"),
    "words": (["a", " b ", "1", None], "string"),
}
NAMES = list(CELLS)


def text_rows(spark, order):
    schema = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([tuple(CELLS[n][0][i] for n in NAMES) for i in order], schema)


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0]])
def test_kinds_do_not_depend_on_the_order(spark, order):
    assert csv.infer_kinds(text_rows(spark, order).repartition(3)) == [CELLS[n][1] for n in NAMES]


def test_values(spark):
    row = csv.with_kinds(text_rows(spark, [3]), [CELLS[n][1] for n in NAMES]).first()
    assert (row["flag"], row["small"], row["large"], row["real"], row["odd"]) == (True, 2147483647, 2147483648, 0.5, None)
    assert row["when"] == datetime.datetime(2024, 12, 31, 23, 59, 59)
    assert csv.with_kinds(text_rows(spark, [1]), [CELLS[n][1] for n in NAMES]).first()["words"] == " b "


def test_files_with_late_odd_values_and_joined_headers(spark, tmp_path):
    for part, lines in enumerate((["a,b.c,d"] + ["1,2,x"] * 500, ["a,b.c,d", "2,3,y", "a,b.c,d", "3,4.5,"])):
        (tmp_path / f"{part}.csv").write_text("\n".join(lines) + "\n")
    df = csv.read_csv_inferred(spark, str(tmp_path))
    assert df.dtypes == [("a", "int"), ("b.c", "double"), ("d", "string")]
    assert df.count() == 502 and df.where("`b.c` = 4.5 and d is null").count() == 1


def test_a_file_of_headers_is_text(spark, tmp_path):
    (tmp_path / "only.csv").write_text("a,b\n")
    df = csv.read_csv_inferred(spark, str(tmp_path))
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 0


def test_kinds_ruled_out_at_first_are_not_asked_of_all_rows(spark, monkeypatch):
    asked = []
    fitting = csv._fitting
    monkeypatch.setattr(csv, "_fitting", lambda text, kinds, form: asked.append(kinds) or fitting(text, kinds, form))
    monkeypatch.setattr(csv, "FIRST_ROWS", 2)
    rows = [("1", "x", None, "2024-01-02 03:04:05")] * 2 + [("2.5", "1", "7", "2024-01-02 03:04:05"), ("2", "2", "8", "z")]
    text = spark.createDataFrame(rows, "a string, b string, c string, d string").coalesce(1)
    assert csv.infer_kinds(text) == ["double", "string", "int", "string"]
    assert asked[1] == [["int", "bigint", "double"], [], list(csv.KINDS), ["timestamp"]]
