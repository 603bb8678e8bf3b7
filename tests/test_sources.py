"""Readers, writers and the converter."""

import pytest
from pyspark.sql.utils import AnalysisException

from blotter.sources import csv_to_parquet, read_csv, read_delimited, union_files, write_parquet


def test_write_parquet_refuses_existing_path_by_default(spark, tmp_path):
    df = spark.range(3)
    out = str(tmp_path / "t.parquet")
    write_parquet(df, out)
    with pytest.raises(AnalysisException):
        write_parquet(df, out)
    write_parquet(spark.range(5), out, mode="overwrite")
    assert spark.read.parquet(out).count() == 5


def test_csv_to_parquet_explicit_and_inferred(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    (src / "a.csv").mkdir(parents=True)
    (src / "a.csv" / "part-0.csv").write_text("id,name\n1,x\n2,y\n")
    (src / "b.csv").mkdir()
    (src / "b.csv" / "part-0.csv").write_text("code,amount\n7,1.5\n")
    out = csv_to_parquet(spark, str(src), str(dst), {"a": "id int, name string", "b": None})
    assert sorted(map(tuple, out.collect())) == [("a", 2), ("b", 1)]
    assert dict(spark.read.parquet(str(dst / "b.parquet")).dtypes) == {"code": "int", "amount": "double"}
    with pytest.raises(AnalysisException):
        csv_to_parquet(spark, str(src), str(dst), ["a"])


def test_read_delimited_header_modes(spark, tmp_path):
    f = tmp_path / "lines.txt"
    f.write_text("a|b\n1|x\na|b\n2|y\n")
    typed = read_delimited(spark, str(f), {"n": (0, "int"), "s": 1}, sep="|")
    assert sorted(map(tuple, typed.collect())) == [(1, "x"), (2, "y")]
    kept = read_delimited(spark, str(f), {"s": 1}, sep="|", header=False)
    assert kept.count() == 4
    given = read_delimited(spark, str(f), {"s": 1}, sep="|", header="a|b")
    assert given.count() == 2


def test_read_delimited_types_from_ddl_names(spark, tmp_path):
    from pyspark.sql.types import IntegerType

    f = tmp_path / "l.txt"
    f.write_text("h\n5\nx\n")
    out = read_delimited(spark, str(f), {"v": (0, IntegerType())})
    assert sorted((r.v is None, r.v or 0) for r in out.collect()) == [(False, 5), (True, 0)]


def test_union_files_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2)], "name string, id int")
    assert sorted(map(tuple, union_files([a, b]).collect())) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "id int")
    with pytest.raises(Exception):
        union_files([a, c]).collect()
    assert union_files([a, c], allow_missing=True).count() == 2


def test_read_csv_malformed_fields_become_null(spark, tmp_path):
    f = tmp_path / "m.csv"
    f.write_text("id,amount\n1,2.5\nx,3\n")
    rows = sorted(map(tuple, read_csv(spark, str(f), schema="id int, amount double").collect()), key=repr)
    assert rows == [(1, 2.5), (None, 3.0)]
    dropped = read_csv(spark, str(f), schema="id int, amount double", mode="DROPMALFORMED")
    assert len(dropped.collect()) == 1
    # a bare count parses no field (CSV column pruning), so nothing is dropped
    assert dropped.count() == 2


def test_list_tables_and_convert_whole_folder(spark, tmp_path):
    from blotter.sources import list_tables

    src, dst = tmp_path / "in", tmp_path / "out"
    (src / "a.csv").mkdir(parents=True)
    (src / "a.csv" / "part-0.csv").write_text("id,name\n1,x\n2,y\n")
    (src / "a.csv" / "part-1.csv").write_text("id,name\n3,z\n")
    (src / "b.csv").write_text("code,amount\n7,1.5\n")
    (src / "notes.txt").write_text("skip me\n")
    assert list_tables(spark, str(src)) == ["a", "b"]
    out = csv_to_parquet(spark, str(src), str(dst))
    assert sorted(map(tuple, out.collect())) == [("a", 3), ("b", 1)]


def test_local_core_count_from_master():
    from blotter.session import _local_cores

    assert _local_cores("local[8]") == 8 and _local_cores("local[4,3]") == 4
    assert _local_cores("yarn") is None and _local_cores("spark://host:7077") is None
    assert _local_cores("local[*]") >= 1 and _local_cores("local") == 1


def test_read_parquet_with_declared_schema(spark):
    from blotter.sources import read_parquet
    from tests.conftest import SF01

    df = read_parquet(spark, f"{SF01}/nation.parquet", ["n_nationkey", "n_name"],
                      schema="n_nationkey INT, n_name STRING, n_regionkey INT")
    assert df.dtypes == [("n_nationkey", "int"), ("n_name", "string")]
    assert df.count() == 25


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,area,weapon\n1,10,100\n2,20,200\n")
    (tmp_path / "b.csv").write_text("id,weapon,extra,area\n3,100,x,10\n")
    schema = "id int, area int, weapon int"
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    got = read_csv(spark, paths, schema=schema)
    assert got.columns == ["id", "area", "weapon"]
    assert sorted(map(tuple, got.collect())) == [(1, 10, 100), (2, 20, 200), (3, 10, 100)]
    (tmp_path / "c.csv").write_text("id,area\n4,40\n")
    with pytest.raises(ValueError, match="weapon"):
        read_csv(spark, [*paths, str(tmp_path / "c.csv")], schema=schema)


def test_csv_folder_with_mixed_headers_is_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,area,weapon\n1,10,100\n")
    (tmp_path / "b.csv").write_text("id,weapon,area\n3,100,10\n")
    got = read_csv(spark, str(tmp_path), schema="id int, area int, weapon int")
    assert sorted(map(tuple, got.collect())) == [(1, 10, 100), (3, 10, 100)]


def test_folder_of_many_files_with_three_header_orders(spark, tmp_path):
    """Names with blanks and per cents, empty files, a file of several splits;
    one job at build."""
    orders = [("id", "area", "weapon"), ("weapon", "id", "area"), ("area", "extra", "weapon", "id")]
    folder = tmp_path / "a folder 100%"
    folder.mkdir()
    value = {"extra": lambda k: "x", "id": lambda k: k, "area": lambda k: 2 * k, "weapon": lambda k: 3 * k}
    for k in range(500):
        names = orders[k % 3]
        (folder / f"part {k}.csv").write_text(",".join(names) + "\n" + ",".join(str(value[n](k)) for n in names) + "\n")
    (folder / "empty.csv").write_text("")
    (folder / "notes.txt").write_text("no table\n")
    names = orders[1]
    (folder / "long.csv").write_text(",".join(names) + "\n" + "".join(
        ",".join(str(value[n](k)) for n in names) + "\n" for k in range(1000, 61_000)))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        spark.sparkContext.setJobGroup("census", "census")
        got = read_csv(spark, str(folder), schema="id int, area int, weapon int", glob="*.csv")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("census")) == 1
        spark.sparkContext.setJobGroup("other", "other")
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert sorted(map(tuple, rows)) == [(k, 2 * k, 3 * k) for k in [*range(500), *range(1000, 61_000)]]


def test_list_tables_takes_direct_children_of_any_layout(spark, tmp_path):
    import gzip

    from blotter.sources import list_tables

    for folder in ("sub", "gz.csv", "plain.csv", "part.csv/k=1"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "top.csv").write_text("a\n1\n")
    (tmp_path / "sub" / "nested.csv").write_text("a\n1\n")
    (tmp_path / "gz.csv" / "part-0.csv.gz").write_bytes(gzip.compress(b"a\n1\n2\n"))
    (tmp_path / "plain.csv" / "part-0001").write_text("a\n1\n2\n3\n")
    (tmp_path / "part.csv" / "k=1" / "part-0001.csv").write_text("a\n1\n")
    assert list_tables(spark, str(tmp_path)) == ["gz", "part", "plain", "top"]
    out = csv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"))
    assert sorted(map(tuple, out.collect())) == [("gz", 2), ("part", 1), ("plain", 3), ("top", 1)]


def test_many_tables_are_converted_side_by_side(spark, tmp_path):
    names = [f"t{k}" for k in range(9)]
    for k, name in enumerate(names):
        (tmp_path / f"{name}.csv").write_text("a,b\n" + "1,x\n" * (k + 1))
    out = csv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"), {n: "a int, b string" for n in names}, at_once=3)
    assert sorted(map(tuple, out.collect())) == [(n, k + 1) for k, n in enumerate(names)]
    with pytest.raises(AnalysisException):  # one of them exists
        csv_to_parquet(spark, str(tmp_path), str(tmp_path / "out"), {"t3": "a int, b string"})
