"""Stored times, day partitions, kept-up snapshots, touched partitions, catalog loads, narrow schemas, rescued values, load counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.clock import RunClock, yesterday
from nestflow.operators.filters import in_day, select_run, since, with_stored_time
from nestflow.plans import datasets as P
from nestflow.plans import documents as D
from nestflow.plans import queries as Q
from nestflow.plans.jobs import provider_m_job, provider_t_job
from nestflow.sources.collections import read_collection, write_by_day
from nestflow.sources.mutations import delete_touched, read_partitioned, replace_touched, update_touched
from nestflow.sources.rescue import RESCUED_COL, parse_json_rescued, split_rescued
from nestflow.sources.schemas import narrow_schema, split_path
from nestflow.sources.sinks import in_database, load_partition, scratch_path
from nestflow.sources.snapshots import Snapshot

SF = "/root/testdata/sf0.001"
CLOCK = RunClock.of("2024-01-15")
TEXTS = ["2024-01-14 08:00:00", "2024-1-14 08:00:00", "2024-01-14 00:00:00", "2024-01-14 00:00:00.9", "2024-01-14", "2024-01-15 00:00:00",
         "2024-01-13 23:59:59.999", "2024-1-2 1:2:3", "no time", "", None]


def _plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan"):]


def _scan(df, part):
    return [line.split(f"{part}: ")[1] for line in _plan(df).split("\n") if "FileScan" in line and f"{part}: " in line]


def test_text_times_are_selected_by_the_stored_time(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "id int, t string")
    path = scratch_path(spark, "texts")
    with_stored_time(df, "t").write.parquet(path)
    stored = spark.read.parquet(path)
    for selection in ("increment", "snapshot"):
        for bounds in ("open", "left_closed"):
            want = sorted(r.id for r in select_run(df, "t", CLOCK, selection, bounds).collect())
            chosen = select_run(stored, "t", CLOCK, selection, bounds)
            assert sorted(r.id for r in chosen.collect()) == want
            assert "nf_time_of_t" in _scan(chosen, "PushedFilters")[0]
    assert {TEXTS[r.id] for r in in_day(stored, "t", CLOCK).collect()} == {"2024-01-14 08:00:00", "2024-1-14 08:00:00"}
    assert {r.t for r in stored.collect()} == set(TEXTS)  # the text stays as it was


def test_day_partitions_prune_and_change_nothing(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS * 3)], "id int, t string")
    path = scratch_path(spark, "by-day")
    write_by_day(df, path, "t")
    stored = read_collection(spark, path, fmt="parquet")
    assert sorted(x for x in os.listdir(path) if "=" in x) == [
        "nf_day_of_t=2024-01-02", "nf_day_of_t=2024-01-13", "nf_day_of_t=2024-01-14", "nf_day_of_t=2024-01-15", "nf_day_of_t=__HIVE_DEFAULT_PARTITION__"]
    for selection in ("increment", "snapshot"):
        chosen = select_run(stored, "t", CLOCK, selection)
        assert sorted(r.id for r in chosen.collect()) == sorted(r.id for r in select_run(df, "t", CLOCK, selection).collect())
        assert "nf_day_of_t" in _scan(chosen, "PartitionFilters")[0]
    counts = Observation()
    counted = select_run(stored, "t", CLOCK, counts=counts)
    assert "nf_day_of_t" in _scan(counted, "PartitionFilters")[0] and _plan(counted).count("FileScan") == 1
    assert counted.count() == 6 and counts.get == {"selected": 6, "bad_time": 9}
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_instants_are_stored_by_the_clock_zones_day(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-13 16:00:01Z'), (2, TIMESTAMP '2024-01-14 15:59:59Z'), (3, TIMESTAMP '2024-01-14 16:00:00Z') AS v(id, t)")
    path = scratch_path(spark, "instants")
    write_by_day(df, path, "t", tz="Asia/Shanghai")
    assert {r.id for r in in_day(spark.read.parquet(path), "t", CLOCK).collect()} == {1, 2}


def test_provider_m_calls_reads_one_days_files(spark):
    for query in (Q.q_provider_m_calls, Q.q_provider_m_bills):
        assert "nf_day_of_create_time" in _scan(query(spark, SF), "PartitionFilters")[0]
    whole = Q._mx(spark, SF, kind="mx_by_day")
    assert len(select_run(whole, "create_time", Q.M_CLOCK).select(F.input_file_name()).distinct().collect()) <= 2 < len(whole.inputFiles())
    assert "nf_time_of_create_time" in _scan(Q.q_provider_t_calls(spark, SF), "PushedFilters")[0]


ROWS = "create_time string, who string, n int"


def _rows(docs):
    return docs.select("create_time", F.explode("who").alias("who"), "n")


def test_snapshot_equals_full_reload(spark):
    days = ["2024-01-02", "2024-01-03", "2024-1-03", "2024-01-05", "2024-01-06", "2024-01-08"]
    data = [(f"{d} 0{k}:00:00", ["a", "b", "b", None], k if k % 2 else None) for d in days for k in range(4)]
    data += [("2024-01-06 00:00:00", ["m"], 1), ("never", ["x"], 1), (None, ["x"], 1)]
    docs = spark.createDataFrame(data, "create_time string, who array<string>, n int")
    path = scratch_path(spark, "docs")
    write_by_day(docs, path, "create_time")
    stored = spark.read.parquet(path)
    snapshot = Snapshot(spark, scratch_path(spark, "snapshot"), ROWS)
    clocks = [RunClock.of(d) for d in ("2024-01-04", "2024-01-06", "2024-01-07", "2024-01-09")]
    for clock in clocks:
        new = snapshot.new_rows(stored, _rows, clock)
        if snapshot.runs():  # reads the new days and the hashes stored for them
            assert "nf_day_of_create_time" in _scan(new, "PartitionFilters")[0]
            hashes = [line for line in _plan(new).split("\n") if "FileScan" in line and "nf_h1" in line]
            assert len(hashes) == 1 and "who" not in hashes[0] and "created" in hashes[0].split("PartitionFilters: ")[1]
        snapshot.advance(stored, _rows, clock)
    snapshot.advance(stored, _rows, clocks[-1])  # a repeated run changes nothing
    assert snapshot.runs() == [c.today for c in clocks]
    for clock in clocks:
        want = _rows(select_run(docs, "create_time", clock, "snapshot")).distinct().select("*", F.lit(clock.partition_value).alias("partition_time"))
        got = snapshot.read(clock)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_snapshot_late_and_repeated_documents(spark):
    first = spark.createDataFrame([("2024-01-02 01:00:00", ["a"], None)], "create_time string, who array<string>, n int")
    late = spark.createDataFrame([("2024-01-01 01:00:00", ["late"], 1), ("2024-01-02 01:00:00", ["a", None], None)], first.schema)
    snapshot = Snapshot(spark, scratch_path(spark, "late"), ROWS)
    assert snapshot.read(CLOCK).count() == 0
    snapshot.advance(first, _rows, RunClock.of("2024-01-03"))
    snapshot.advance(late.limit(0), _rows, RunClock.of("2024-01-04"), late=True)
    snapshot.advance(late, _rows, RunClock.of("2024-01-05"), late=True)
    got = sorted((r.create_time, r.who or "", r.n or 0) for r in snapshot.read(RunClock.of("2024-01-05")).collect())
    assert got == [("2024-01-01 01:00:00", "late", 1), ("2024-01-02 01:00:00", "", 0), ("2024-01-02 01:00:00", "a", 0)]


def _files(path):
    return {os.path.join(top, n): os.stat(os.path.join(top, n)).st_mtime_ns for top, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def _table(spark):
    path = scratch_path(spark, "parts")
    rows = [(k, f"v{k}", p) for k, p in enumerate(["01", "01", "02", "02", "03", None])]
    spark.createDataFrame(rows, "k int, v string, part string").write.partitionBy("part").parquet(path)
    return path


def _changed(path, before):
    after = _files(path)
    return {x.split("part=")[1].split("/")[0] for x in set(before) ^ set(after) | {f for f in set(before) & set(after) if before[f] != after[f]}}


def _content(spark, path):
    return sorted(((r.k, r.v, r.part) for r in read_partitioned(spark, path, "part").collect()))


def test_only_touched_partitions_are_rewritten(spark):
    path = _table(spark)
    before = _files(path)
    changes = spark.createDataFrame([(0, "new"), (5, None), (99, "nobody")], "k int, v string")
    assert set(update_touched(spark, path, changes, ["k"], part_col="part")) == {"01", None}
    assert _changed(path, before) == {"01", "__HIVE_DEFAULT_PARTITION__"}
    assert _content(spark, path) == [(0, "new", "01"), (1, "v1", "01"), (2, "v2", "02"), (3, "v3", "02"), (4, "v4", "03"), (5, None, None)]
    before = _files(path)
    assert set(delete_touched(spark, path, F.expr("k = 2 OR k = 4"), "part")) == {"02", "03"}
    assert _changed(path, before) == {"02", "03"}
    assert [x[0] for x in _content(spark, path)] == [0, 1, 3, 5]
    before = _files(path)
    new = spark.createDataFrame([(1, "moved", "04"), (7, "added", "02")], "k int, v string, part string")
    assert replace_touched(spark, path, new, ["k"], "part") == ["01", "02", "04"]
    assert _changed(path, before) == {"01", "02", "04"}
    assert _content(spark, path) == [(0, "new", "01"), (1, "moved", "04"), (3, "v3", "02"), (5, None, None), (7, "added", "02")]
    again = _content(spark, path)
    replace_touched(spark, path, new, ["k"], "part")  # repeated after a failure: the same table
    assert _content(spark, path) == again
    before = _files(path)
    assert update_touched(spark, path, changes.limit(0), ["k"], part_col="part") == [] and not _changed(path, before)
    with pytest.raises(ValueError):
        update_touched(spark, path, new, ["k"], part_col="part")
    with pytest.raises(ValueError):
        read_partitioned(spark, path, "k")


def test_catalog_loads_in_a_chosen_database(spark):
    name = Q._database(spark)
    earlier = spark.catalog.currentDatabase()
    with in_database(spark, name):
        spark.sql("CREATE TABLE t (b INT, a STRING, partition_time STRING) USING parquet PARTITIONED BY (partition_time)")
        rows = spark.createDataFrame([("x", 1), (None, 2)], "a string, b int")
        for mode, value in (("append", "20240101"), ("append", "20240101"), ("append", "20240102"), ("overwrite", "20240102")):
            load_partition(rows, "t", value, mode=mode)
        load_partition(rows.limit(0), "t", "20240101", mode="overwrite")
        assert sorted((r.a or "", r.b, r.partition_time) for r in spark.table("t").collect()) == [("", 2, "20240102"), ("x", 1, "20240102")]
        with pytest.raises(RuntimeError), in_database(spark, "default"):
            raise RuntimeError
        assert spark.catalog.currentDatabase() == name
    assert spark.catalog.currentDatabase() == earlier


def test_narrow_schema_of_the_pipelines(spark):
    items = "struct<call_time: string, receive_phone: string, call_type: string, trade_time: string>"
    want = {
        ("mx", tuple(D.M_BILLS_PATHS)): "mobile string, create_time timestamp_ntz, bills array<struct<total_fee: int, bill_month: string>>",
        ("mx", tuple(D.M_COUNT_PATHS)): "calls array<struct<items: array<struct<details_id: string>>, continued: boolean>>",
        ("tj", tuple(D.T_CALLS_PATHS)): f"user_id string, create_time string, {D.TJ_ROOT} struct<data: struct<data_list: array<struct<"
                                        f"userdata: struct<phone: string>, teldata: array<struct<items: array<{items}>>>>>>>",
    }
    for (kind, paths), text in want.items():
        full = spark.read.parquet(D.stage_collection(spark, SF, kind)).schema
        assert narrow_schema(full, paths).simpleString() == T.StructType.fromDDL(text).simpleString()


def test_narrow_schema_any_depth(spark):
    full = T.StructType.fromDDL("a struct<b: array<array<struct<c: map<string, struct<d: int, e: int>>, f: int>>>, g: int>, h int, `x.y` struct<z: int, w: int>")
    assert narrow_schema(full, ["a.b.c.d", "`x.y`.z"]).simpleString() == \
        "struct<a:struct<b:array<array<struct<c:map<string,struct<d:int>>>>>>,x.y:struct<z:int>>"
    assert narrow_schema(full, ["h", "a.b.f", "a"]).simpleString() == T.StructType(full.fields[:2]).simpleString()
    assert narrow_schema(full, []) == T.StructType([])
    for bad in ("nope", "a.nope", "h.i", "a..b", ""):
        with pytest.raises(ValueError):
            narrow_schema(full, [bad])
    assert split_path("a.`b.c`.`d``e`") == ["a", "b.c", "d`e"]


def test_rescued_values(spark):
    schema = T.StructType.fromDDL("n int, s string, o struct<x: int, l: array<struct<y: int>>>, t timestamp_ntz")
    lines = {
        '{"n": 1, "s": "a", "o": {"x": 2, "l": [{"y": 1}, {"y": 2}]}, "t": "2024-01-01T00:00:00"}': [],
        '{"n": null, "o": null}': [], '{}': [],
        '{"n": 5000000000, "s": 7, "late": {"k": 1}}': ["+late", "n"],
        '{"n": "1x", "o": {"x": 1.5, "l": [{"y": "q"}, {"y": 3, "z": 1}]}}': ["+o.l[].z", "n", "o.l[].y", "o.x"],
        '{"n": 2, "o": {"x": 1, "l": [{"y": 3}, 4]}}': ["o.l"],
        '{"o": {"x": 3, "l": {"y": 1}}, "t": "soon"}': ["o.l", "t"],
        '{"o": [1, 2]}': ["o"],
        '{"n": 1': ["$"], 'nothing': ["$"], '[1]': ["$"], '"text"': ["$"], '': ["$"],
    }
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)] + [(99, None)], "id int, line string")
    parsed = parse_json_rescued(df, "line", schema)
    got = {r.id: r[RESCUED_COL] for r in parsed.collect()}
    assert got == {**dict(enumerate(lines.values())), 99: []}
    documents, side = split_rescued(parsed, "line")
    assert documents.columns == ["id", "n", "s", "o", "t"] and documents.count() == len(lines) + 1 - 5
    kept = {r.id: r for r in documents.collect()}
    assert (kept[0].n, kept[0].o.x, [e.y for e in kept[0].o.l]) == (1, 2, [1, 2])
    assert (kept[3].n, kept[3].s) == (None, "7") and [e and e.y for e in kept[4].o.l][1] == 3
    assert {r.line for r in side.collect()} == {line for line, paths in lines.items() if paths}
    assert parse_json_rescued(df.limit(0), "line", schema).count() == 0


def test_jobs_return_counts(spark):
    days = D.stored_collection(spark, SF, "mx_by_day")
    broken = days.limit(3).withColumns({"create_time": F.lit(None).cast("timestamp_ntz"), "nf_day_of_create_time": F.lit(None).cast("date")})
    names = ["contacts", "real_names", "bills", "calls"]
    counts = provider_m_job(days.unionByName(broken), D.contacts(spark, SF), D.real_names(spark, SF), Q.M_CLOCK,
                            {n: scratch_path(spark, f"counted-{n}") for n in names})
    chosen = select_run(days, "create_time", Q.M_CLOCK).count()
    assert counts["bills"] == {"selected": chosen, "bad_time": 3, "written": P.provider_m_bills(days, Q.M_CLOCK).count()}
    assert counts["calls"] == {"selected": chosen, "bad_time": 3, "written": P.provider_m_calls(days, Q.M_CLOCK).count()}
    assert counts["real_names"] == {"written": D.real_names(spark, SF).count()} and counts["contacts"]["written"] == 0
    tj = D.stored_collection(spark, SF, "tj")
    counts = provider_t_job(tj, Q.T_CLOCK, {n: scratch_path(spark, f"counted-t-{n}") for n in ("bills", "calls")})
    assert counts["calls"] == {"selected": select_run(tj, "create_time", Q.T_CLOCK, "snapshot").count(), "bad_time": 0,
                               "written": P.provider_t_calls(tj, Q.T_CLOCK).count()}
    empty = provider_t_job(tj.limit(0), Q.T_CLOCK, {n: scratch_path(spark, f"counted-e-{n}") for n in ("bills", "calls")})
    assert empty["calls"] == {"selected": 0, "bad_time": 0, "written": 0}


def test_shared_documents_hold_several_phones_and_split_pieces_count_once(spark):
    phones = F.col(f"{D.TJ_DATA_LIST}.userdata.phone")
    shared = D.tj_shared_documents(spark, SF)
    assert shared.select(F.max(F.size(phones))).first()[0] == D.PHONES
    assert shared.count() < D.tj_documents(spark, SF).count()
    split = D.tj_shared_documents(spark, SF, max_elements=2, max_doc_items=30)
    assert split.count() > shared.count()
    a, b = P.t_calls_flat(shared), P.t_calls_flat(split)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.count()


def test_since_and_yesterday(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert {r.t for r in since(df, "t", dt.date(2024, 1, 14), CLOCK).collect()} == {t for t in TEXTS[:5]}
    assert spark.range(1).select(yesterday(CLOCK).alias("y")).first().y == dt.date(2024, 1, 14)
