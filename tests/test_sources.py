import uuid

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossmill.session import scratch_path
from lossmill.sources import tables
from lossmill.sources.csv import detect_dialect, infer_csv_schema, read_csv_auto, read_csv_tolerant, rejected_rows
from lossmill.sources.records import states

SCHEMA = T.StructType(
    [
        T.StructField("IDpol", T.LongType()),
        T.StructField("Exposure", T.DoubleType()),
        T.StructField("Area", T.StringType()),
    ]
)


def write(tmp_path, lines, name="data.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def read(spark, path, **options):
    return [tuple(r) for r in read_csv_tolerant(spark, path, SCHEMA, **options).collect()]


def test_short_rows_are_padded_and_bad_rows_dropped(spark, tmp_path):
    lines = ["1,0.5,A", "2,abc,B", "3,0.7", "4,0.9,D,EXTRA", "5,,E", "6,0.2,F", "x7,0.3,G"]
    path = write(tmp_path, ["IDpol,Exposure,Area", *lines])
    assert read(spark, path) == [(1, 0.5, "A"), (3, 0.7, None), (5, None, "E"), (6, 0.2, "F")]


def test_wide_rows_are_dropped_even_with_empty_cells(spark, tmp_path):
    path = write(tmp_path, ["1,0.5,,", "2,0.5,,X", '3,0.5,"a,b"', '4,"0.5","a,b",c', '5,"0,5"'])
    assert read(spark, path, header=False) == [(3, 0.5, "a,b")]


def test_other_separator_and_quote(spark, tmp_path):
    path = write(tmp_path, ["1;0.5;'x;y'", "2;0.5;'x';y"])
    assert read(spark, path, header=False, sep=";", quote="'") == [(1, 0.5, "x;y")]


def test_a_column_subset_keeps_the_same_rows(spark, tmp_path):
    path = write(tmp_path, ["1,0.5,A", "2,abc,B", "3,0.7", "4,0.9,D,EXTRA"])
    frame = read_csv_tolerant(spark, path, SCHEMA, header=False)
    assert [r[0] for r in frame.select("IDpol").collect()] == [1, 3]
    assert frame.count() == 2


CELL = st.sampled_from(["", "1", "22", "0.5", "-3.25", "abc", "7x"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(CELL, min_size=2, max_size=5), min_size=1, max_size=30))
def test_tolerance_matches_the_reading_rule(spark, tmp_path_factory, rows):
    rows = [[str(i), *row[1:]] for i, row in enumerate(rows)]
    path = write(tmp_path_factory.mktemp("csv"), [",".join(row) for row in rows])

    def usable(row):
        if len(row) > 3:
            return None
        padded = [*row, None, None][:3]
        try:
            number = float(padded[1]) if padded[1] else None
        except ValueError:
            return None
        return int(row[0]), number, padded[2] or None

    expected = [kept for kept in map(usable, rows) if kept]
    assert sorted(read(spark, path, header=False)) == sorted(expected)


def test_agrees_with_duckdb_on_a_damaged_file(spark, tmp_path):
    lines = [f"{i},{i / 4},A{i % 5}" for i in range(3000)]
    lines[2500], lines[2600], lines[2700] = "2500,abc,A", "2600,1.5", "2700,,B"
    path = write(tmp_path, ["IDpol,Exposure,Area", *lines])
    duck = duckdb.sql(
        f"SELECT * FROM read_csv('{path}', header=true, ignore_errors=true, null_padding=true, "
        "columns={'IDpol': 'BIGINT', 'Exposure': 'DOUBLE', 'Area': 'VARCHAR'})"
    ).fetchall()
    assert sorted(read(spark, path)) == sorted(duck)


def test_inferred_schema_feeds_the_reader(spark, tmp_path):
    path = write(tmp_path, ["IDpol,Exposure,Area", "1,0.5,A", "2,0.7,B"])
    schema = infer_csv_schema(spark, path)
    assert schema == SCHEMA
    assert read_csv_tolerant(spark, path, schema).count() == 2


def test_columns_are_bound_by_name(spark, tmp_path):
    path = write(tmp_path, ["Exposure,Extra,IDpol,Area", "0.5,x,1,A", "0.6,y,2", "0.7,z,3,B,W"])
    assert read(spark, path) == [(1, 0.5, "A"), (2, 0.6, None)]
    assert [r[0] for r in rejected_rows(spark, path, SCHEMA).collect()] == ["0.7,z,3,B,W"]
    with pytest.raises(ValueError, match="Area"):
        read(spark, write(tmp_path, ["IDpol,Exposure", "1,2"], "short.csv"))


def test_whole_numbers_may_be_decimals(spark, tmp_path):
    path = write(tmp_path, ["1.0,0.5,A", "1e2,0.5,B", "1.5,0.5,C", "7,1,D"])
    assert read(spark, path, header=False) == [(1, 0.5, "A"), (100, 0.5, "B"), (7, 1.0, "D")]


def test_quoted_line_breaks(spark, tmp_path):
    lines = ["IDpol,Exposure,Area", '1,0.5,"A', "", 'B"', "2,0.5,C", '3,"0.5","x ""y"" z"', '4,0.5,5" pipe', '5,0.5,"a"']
    path = write(tmp_path, lines)
    assert read(spark, path) == [(1, 0.5, "A\n\nB"), (2, 0.5, "C"), (3, 0.5, 'x "y" z'), (5, 0.5, "a")]
    assert [r[0] for r in rejected_rows(spark, path, SCHEMA).collect()] == ['4,0.5,5" pipe']


def test_a_quote_that_is_never_closed_spoils_its_line_only(spark, tmp_path):
    path = write(tmp_path, ["IDpol,Exposure,Area", "1,0.5,A", '2,0.5,"B', "3,0.5,C"])
    assert read(spark, path) == [(1, 0.5, "A"), (3, 0.5, "C")]
    assert [r[0] for r in rejected_rows(spark, path, SCHEMA).collect()] == ['2,0.5,"B']


@pytest.mark.parametrize("size", [64, 150, 1000])
def test_records_do_not_depend_on_the_splits(spark, tmp_path, size):
    """Small splits, so that many begin inside quotes, against DuckDB."""
    lines = ["IDpol,Exposure,Area"]
    for i in range(400):
        text = {0: f"a{i}", 1: f'"a{i}\nb,c"', 2: f'"x ""{i}"" y"', 3: '"' + f"long {i},\n" * (i % 23 + 1) + '"'}[i % 4]
        lines.append(f"{i},{i / 4},{text}")
    path = write(tmp_path, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        frame = read_csv_tolerant(spark, path, SCHEMA)
        assert frame.rdd.getNumPartitions() > 10 or size > 500
        found = [tuple(r) for r in frame.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    duck = duckdb.sql(f"SELECT * FROM read_csv('{path}', header=true, quote='\"', columns={{'IDpol': 'BIGINT', 'Exposure': 'DOUBLE', 'Area': 'VARCHAR'}})").fetchall()
    assert len(duck) == 400 and sorted(found) == sorted(duck)


def test_states_equal_a_walk_over_the_lines():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 40):
        outside, inside = rng.random((2, n)) < 0.4
        for begin in (False, True):
            walk = [begin]
            for o, i in zip(outside, inside):
                walk.append(bool(i if walk[-1] else o))
            assert states(outside, inside, begin).tolist() == walk


def test_every_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder, ["IDpol,Exposure,Area", "1,0.5,A", "IDpol,Exposure,Area"], "a.csv")
    write(folder, ["Area,IDpol,Exposure", "B,2,0.25", "IDpol,7,0.5"], "b.csv")
    write(folder, ["IDpol,Exposure,Area", "3,1,C"], "c.csv")
    assert sorted(read(spark, str(folder))) == [(1, 0.5, "A"), (2, 0.25, "B"), (3, 1.0, "C"), (7, 0.5, "IDpol")]
    write(folder, ["IDpol,Exposure", "4,1"], "d.csv")
    with pytest.raises(ValueError, match="Area"):
        read(spark, str(folder))


def test_unknown_files(spark, tmp_path):
    path = write(tmp_path, ["IDpol;Exposure;Area", "1;0.5;a,b", "2;;c"])
    frame = read_csv_auto(spark, path)
    assert frame.schema == SCHEMA
    assert [tuple(r) for r in frame.collect()] == [(1, 0.5, "a,b"), (2, None, "c")]


def test_one_damaged_cell_leaves_the_type(spark, tmp_path):
    lines = [f"{i}|{i / 8}|2024-01-{i % 28 + 1:02d}|'x|{i}'" for i in range(300)]
    lines[250] = "x|0.5|2024-01-01|'y'"
    path = write(tmp_path, lines)
    found = detect_dialect(spark, path)
    assert (found.sep, found.quote, found.header) == ("|", "'", False)
    assert found.schema.simpleString() == "struct<column0:bigint,column1:double,column2:date,column3:string>"
    assert read_csv_auto(spark, path).count() == 299
    text = detect_dialect(spark, path, exceptions=0.0).schema
    assert text["column0"].dataType == T.StringType()


def test_an_empty_file(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    assert read(spark, str(path)) == []
    assert detect_dialect(spark, str(path)).schema == T.StructType([])


def test_export_is_zstd_and_replaces_an_older_one(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.export_parquet(spark.range(10), path)
    tables.export_parquet(spark.range(5), path)
    part = next((tmp_path / "out").glob("*.parquet"))
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"
    assert tables.read_parquet(spark, path).count() == 5


def test_bucketed_tables_are_replaced_and_join_without_a_shuffle(spark):
    folder = scratch_path(spark, "tables")
    left = spark.range(100).withColumnRenamed("id", "k")
    for _ in range(2):
        tables.write_table(left, "t_left", folder + "/l", bucket_by="k", buckets=4)
    tables.write_table(left, "t_right", folder + "/r", bucket_by="k", buckets=4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")  # several splits per bucket
    try:
        copy = tables.write_table(
            spark.table("t_left"), "t_copy", folder + "/c", bucket_by="k", buckets=4, aligned=True
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert copy.count() == 100
    assert len(set(copy.inputFiles())) == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_left").join(spark.table("t_right"), "k").join(copy, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def parts_of(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


@pytest.mark.parametrize("placed", [True, False])
def test_a_failed_write_leaves_the_table_as_it_was(spark, placed):
    path = scratch_path(spark, "failing") if placed else None
    name = f"t_failing_{uuid.uuid4().hex}_"
    tables.write_table(spark.range(5).withColumnRenamed("id", "k"), name, path, bucket_by="k", buckets=2)
    broken = spark.range(20).select(F.when(F.col("id") == 13, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="half way"):
        tables.write_table(broken, name, path, bucket_by="k", buckets=2)
    assert parts_of(spark, name) == [0, 1, 2, 3, 4]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    # The new rows may come from the old ones; columns may change.
    tables.write_table(spark.table(name).select((F.col("k") + 1).alias("k")), name, path, bucket_by="k", buckets=2)
    assert parts_of(spark, name) == [1, 2, 3, 4, 5]
    tables.write_table(spark.table(name).select(F.col("k").cast("string").alias("s")), name, path)
    assert parts_of(spark, name) == ["1", "2", "3", "4", "5"]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    if placed:
        from pathlib import Path

        assert len([p for p in Path(path).iterdir() if p.is_dir()]) == 1
    spark.sql(f"DROP TABLE {name}")


def test_view_is_replaced(spark):
    tables.register_view(spark.range(3), "v_test")
    assert tables.register_view(spark.range(4), "v_test").count() == 4
