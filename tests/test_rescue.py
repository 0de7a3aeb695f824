"""Files that differ from the declared columns lose nothing; the kept schema is compared."""

import json

import pytest
from pyspark.sql import types as T

from strata.functions.params import Params
from strata.sources.files import SchemaStore, headers, read_files_rescued

SCHEMA = T.StructType().add("id", T.IntegerType()).add("n", T.DecimalType(10, 2)).add("day", T.DateType()).add("name", T.StringType())


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def rows(df):
    return sorted(((r.id, r.n and str(r.n), r.day and str(r.day), r.name, json.loads(r._rescued_data) if r._rescued_data else None) for r in df.collect()), key=str)


def test_csv_is_bound_by_name_and_the_rest_is_kept(spark, tmp_path):
    d = tmp_path / "in"
    write(d, "a.csv", "id,n,day,name\n1,1.5,2024-01-05,one\n2,,,\n")
    write(d, "b.csv", 'name,extra,"id",n\n"a, ""b""",x,3,4\nlong,y,5,6,7\nshort,z\n')
    write(d, "c.csv", "id,name,id\nx1,t,9\n")
    write(d, "empty.csv", "")
    write(d, "only_header.csv", "id,n\n")
    got = rows(read_files_rescued(spark, str(d), SCHEMA, escape='"'))
    assert (1, "1.50", "2024-01-05", "one", None) in got and (2, None, None, None, None) in got
    assert (3, "4.00", None, 'a, "b"', {"extra": "x"}) in got
    assert (5, "6.00", None, "long", {"extra": "y", "_corrupt_record": "long,y,5,6,7"}) in got
    assert (None, None, None, "short", {"extra": "z", "_corrupt_record": "short,z"}) in got
    assert (None, None, None, "t", {"id": "x1", "id_2": "9"}) in got
    assert len(got) == 6
    assert [n for p, _, n in headers(spark, str(d)) if p.endswith("c.csv")] == [("id", "name", "id")]


def test_line_breaks_in_fields_and_other_separators(spark, tmp_path):
    d = tmp_path / "in"
    write(d, "a.csv", 'name|id\n"two\nlines"|1\n')
    write(d, "b.csv", "id|name|day\n2|x|05.01.2024\n3|y|soon\n")
    got = rows(read_files_rescued(spark, str(d), SCHEMA, sep="|", multi_line=True, dateFormat="dd.MM.yyyy"))
    assert got == [(1, None, None, "two\nlines", None), (2, None, "2024-01-05", "x", None), (3, None, None, "y", {"day": "soon"})]


def test_json_fields_and_broken_lines_are_kept(spark, tmp_path):
    d = tmp_path / "in"
    write(d, "a.json", '{"id": 1, "n": 2.5, "more": {"a": [1]}}\n{"name": "x", "id": "y"}\nno json\n\n{"id": null}\n')
    got = rows(read_files_rescued(spark, str(d), SCHEMA, "json"))
    assert got == sorted([(1, "2.50", None, None, {"more": '{"a":[1]}'}), (None, None, None, "x", {"id": "y"}),
                          (None, None, None, None, {"_corrupt_record": "no json"}), (None, None, None, None, None)], key=str)


def test_later_files_are_compared_with_the_kept_schema(spark, tmp_path):
    d = tmp_path / "in"
    write(d, "a.csv", "id,n\n1,x\n")
    store = SchemaStore(spark, str(tmp_path / "schema"))
    first = store.resolve(str(d), "csv", header=True)
    assert first.fieldNames() == ["id", "n"] and store.resolve(str(d), "csv", header=True) == first
    write(d, "b.csv", "n,id,x\nz,2,3\n")
    with pytest.raises(ValueError, match="lacks.*x"):
        store.resolve(str(d), "csv", header=True)
    with pytest.raises(ValueError, match="another order"):
        store.resolve(str(d), "csv", header=True, allow_new_columns=True)
    write(d, "b.csv", "id,n,x\n2,z,3.5\n")
    assert store.resolve(str(d), "csv", header=True, allow_new_columns=True).simpleString() == "struct<id:int,n:string,x:double>"
    assert SchemaStore(spark, str(tmp_path / "schema")).load().fieldNames() == ["id", "n", "x"]


def test_parameters_that_differ_in_punctuation_alone(spark):
    p = Params({"a.b": 1, "a_b": 2, "a b": 3})
    assert tuple(p.sql(spark, "SELECT ${a.b} AS x, ${a_b} AS y, ${a b} AS z, ${a.b} AS w").first()) == (1, 2, 3, 1)
