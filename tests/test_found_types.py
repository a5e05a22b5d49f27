"""Types found from text, and counts taken while a table is written."""

import math

import pytest

from basketry.operators.profile import null_counts
from basketry.sources import sinks
from basketry.sources.found_types import found_types, read_found


def types(spark, path):
    return {r["column"]: (r["type"], r["n_missing"]) for r in found_types(spark, str(path)).collect()}


def write(folder, *parts):
    folder.mkdir()
    for i, lines in enumerate(parts):
        (folder / f"part-{i}.csv").write_text("\n".join(lines) + "\n")
    return folder


CASES = [
    (["1", "-2", "+3", ""], "int"), (["007", "NA"], "int"), (["2147483647", "-2147483648"], "int"),
    (["1", "2147483648"], "bigint"), (["1", "9223372036854775808"], "double"), (["1", "2.5"], "double"),
    ([".5", "1.", "1e3", "Inf", "NaN"], "double"), (["2147483648", "0.1"], "double"), (["TRUE", "false"], "boolean"),
    (["", "NA"], "boolean"), (["TRUE", "1"], "string"), (["1", "1x"], "string"), (["1.2.3"], "string"), (["e5"], "string"),
    (["2020-01-02"], "string"), (["ünï"], "string"),
]


@pytest.mark.parametrize("cells, want", CASES)
def test_narrowest_type(spark, tmp_path, cells, want):
    path = write(tmp_path / "t", ["key,value", *[f"{i},{c}" for i, c in enumerate(cells)]])
    got = types(spark, path)
    assert got["key"] == ("int", 0) and got["value"] == (want, sum(c in ("", "NA") for c in cells))


def test_last_row_of_another_file_promotes(spark, tmp_path):
    many = ["a,b,c", *[f"{i},{i},{i}" for i in range(5000)]]
    path = write(tmp_path / "t", many, ["a,b,c", *[f"{i},{i},{i}" for i in range(2000)], "1,0.5,no"])
    assert types(spark, path) == {"a": ("int", 0), "b": ("double", 0), "c": ("string", 0)}
    back = read_found(spark, str(path))
    assert dict(back.dtypes) == {"a": "int", "b": "double", "c": "string"} and back.count() == 7001
    assert back.where("c = 'no'").first().b == 0.5


def test_values_missing_cells_and_empty_files(spark, tmp_path):
    path = write(tmp_path / "t", ["x y,v,w", '"5",Inf,TRUE', "NA,-Inf,", '"6",,NA'])
    back = read_found(spark, str(path))
    assert back.dtypes == [("x y", "int"), ("v", "double"), ("w", "boolean")]
    assert sorted(back.collect(), key=str) == sorted([(5, math.inf, True), (None, -math.inf, None), (6, None, None)], key=str)
    assert types(spark, write(tmp_path / "e", ["a,b"])) == {"a": ("boolean", 0), "b": ("boolean", 0)}


def test_counts_on_the_way_equal_a_second_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.0), (None, "x", float("nan")), (3, None, None)], "a long, b string, c double")
    seen = sinks.write_observed(df.repartition(3), str(tmp_path / "w"))
    back = spark.read.parquet(str(tmp_path / "w"))
    assert {(r["column"], r.na_count) for r in seen.collect()} == {(r["column"], r.na_count) for r in null_counts(back).collect()}
    assert {r.n_rows for r in seen.collect()} == {3}
    assert "FileScan" not in seen._jdf.queryExecution().toString()
    empty = sinks.write_observed(df.limit(0), str(tmp_path / "z")).collect()
    assert {(r["column"], r.na_count, r.n_rows) for r in empty} == {("a", 0, 0), ("b", 0, 0), ("c", 0, 0)}
