import os
import uuid

import pytest
from pyspark.sql import functions as F

from nestflow.operators.tables import (
    align,
    append_rows,
    count_deleted,
    dedupe,
    delete_where,
    replace_by_key,
    update_by_key,
)
from nestflow.sources.collections import infer_json_schema, parse_json_column, read_collection, with_views, write_collection
from nestflow.sources.sinks import load_partition, refresh_table, scratch_path, shared_dir


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0)], "k int, s string, v double")


def test_delete_null_predicate_keeps(base):
    assert sorted(r.k for r in delete_where(base, F.col("v") > 2).collect()) == [1, 2]
    assert count_deleted(base, F.col("v") > 2).first().deleted == 1


def test_update_sets_null_and_keeps_others(spark, base):
    ch = spark.createDataFrame([(1, None), (9, "z")], "k int, s string")
    got = {r.k: (r.s, r.v) for r in update_by_key(base, ch, ["k"]).collect()}
    assert got == {1: (None, 1.0), 2: ("b", None), 3: (None, 3.0)}


def test_replace_inserts_without_match(spark, base):
    new = spark.createDataFrame([(1, "x", 0.0), (7, "y", 7.0)], "k int, s string, v double")
    got = sorted((r.k, r.s) for r in replace_by_key(base, new, ["k"]).collect())
    assert got == [(1, "x"), (2, "b"), (3, None), (7, "y")]


def test_append_and_dedupe(spark, base):
    more = spark.createDataFrame([(1, "a")], "k int, s string")
    out = append_rows(base, more)
    assert out.count() == 4 and dedupe(out, ["k", "s"]).count() == 3


def test_align_by_name(base):
    assert align(base, ["v", "k"]).columns == ["v", "k"]
    with pytest.raises(ValueError):
        align(base, ["nope"])


def test_partition_loads(spark, base):
    path = scratch_path(spark, "t")
    load_partition(base, path, "20240101", mode="append")
    load_partition(base, path, "20240101", mode="append")
    load_partition(base, path, "20240102", mode="overwrite")
    back = spark.read.parquet(path)
    counts = {str(r.partition_time): r["count"] for r in back.groupBy("partition_time").count().collect()}
    assert counts == {"20240101": 6, "20240102": 3}
    load_partition(base.filter("k = 1"), path, "20240101", mode="overwrite")
    counts = {str(r.partition_time): r["count"] for r in spark.read.parquet(path).groupBy("partition_time").count().collect()}
    assert counts == {"20240101": 1, "20240102": 3}  # other partition untouched


def test_catalog_table_insert_by_name(spark, base):
    name = f"nf_calls_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (s string, k int, v double, partition_time string) USING parquet "
              f"PARTITIONED BY (partition_time) LOCATION '{shared_dir(spark, 'nestflow', name)}'")
    try:
        load_partition(base, name, "20240101")
        load_partition(base, name, "20240102")
        load_partition(base, name, "20240101", mode="overwrite")
        rows = spark.table(name).filter("partition_time = '20240101'").collect()
        assert len(rows) == 3 and {(r.k, r.s) for r in rows} == {(1, "a"), (2, "b"), (3, None)}
        # the overwrite replaced its own partition only
        assert spark.table(name).filter("partition_time = '20240102'").count() == 3
        refresh_name = f"nf_names_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {refresh_name} (v double, k int) USING parquet "
                  f"LOCATION '{shared_dir(spark, 'nestflow', refresh_name)}'")
        refresh_table(base, refresh_name)
        refresh_table(base.filter("k = 1"), refresh_name)
        assert [(r.v, r.k) for r in spark.table(refresh_name).collect()] == [(1.0, 1)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_collection_roundtrip_and_sampled_schema(spark, base):
    path = scratch_path(spark, "coll")
    write_collection(base, path, fmt="json", mode="overwrite")
    back = read_collection(spark, path, sample_size=2)
    assert sorted(back.columns) == ["k", "s", "v"] and back.count() == 3
    ev = spark.createDataFrame([('{"k": 1}',), ('{"k": 2, "z": "x"}',), ("junk",)], "p string")
    assert [f.name for f in infer_json_schema(ev, "p", sample_size=1).fields] == ["k"]
    parsed = parse_json_column(ev, "p")
    assert sorted(parsed.columns) == ["_corrupt_record", "k", "z"] or "k" in parsed.columns


def test_with_views(spark, base):
    with with_views(spark, {"nf_view": base}):
        assert spark.sql("SELECT count(*) c FROM nf_view").first().c == 3
    assert not spark.catalog.tableExists("nf_view")


def test_shared_dir_from_session(spark):
    conf = spark.conf.get("spark.checkpoint.dir", None)
    expected = conf or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == expected.rstrip("/")
    assert os.path.basename(scratch_path(spark, "x")).startswith("x-")


def test_use_database_and_show(spark, base, capsys):
    from nestflow.operators.nested import field
    from nestflow.sources.sinks import show_result, use_database

    spark.sql("CREATE DATABASE IF NOT EXISTS nf_db")
    try:
        use_database(spark, "nf_db")
        assert spark.catalog.currentDatabase() == "nf_db"
    finally:
        use_database(spark, "default")
    show_result(base.select(field("s", "text")))
    assert "text" in capsys.readouterr().out


def test_max_records_per_file(spark):
    import glob

    df = spark.range(100).selectExpr("id", "cast(id as string) s").coalesce(1)
    path = scratch_path(spark, "files")
    load_partition(df, path, "20240101", max_records_per_file=30)
    files = glob.glob(path.replace("file:", "") + "/partition_time=20240101/*.parquet")
    assert len(files) == 4 and spark.read.parquet(path).count() == 100


def test_write_collection_save_modes(spark, base):
    import pytest as _pytest
    from pyspark.errors import AnalysisException

    path = scratch_path(spark, "modes")
    write_collection(base, path, fmt="json", mode="append")
    write_collection(base, path, fmt="json", mode="append")
    assert spark.read.json(path).count() == 6
    write_collection(base.limit(1), path, fmt="json", mode="ignore")   # exists: nothing happens
    assert spark.read.json(path).count() == 6
    with _pytest.raises(AnalysisException):
        write_collection(base, path, fmt="json", mode="error")
    write_collection(base.limit(1), path, fmt="json", mode="overwrite")
    assert spark.read.json(path).count() == 1


def test_update_check_unique(spark, base):
    ch = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    with pytest.raises(ValueError):
        update_by_key(base, ch, ["k"], check_unique=True)
    ok = spark.createDataFrame([(1, "x")], "k int, s string")
    assert update_by_key(base, ok, ["k"], check_unique=True).count() == 3
