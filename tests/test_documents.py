"""Document assembly: bounded arrays give the same rows as unbounded ones."""

from pyspark.sql import functions as F

from nestflow.plans import documents as D
from nestflow.plans import datasets as P
from nestflow.plans.assemble import find_hot_keys

SF = "/root/testdata/sf0.001"


def test_hot_key_detection(spark):
    li = D.table(spark, SF, "lineitem").select("l_orderkey")
    assert not find_hot_keys(li, ["l_orderkey"], 1024).any
    hot = find_hot_keys(li, ["l_orderkey"], 2)
    assert hot.any and hot.table.count() > 0


def test_chunked_documents_same_rows(spark):
    whole = D.mx_documents(spark, SF)
    split = D.mx_documents(spark, SF, max_elements=2)
    # Arrays are bounded (hash spreading: close to the target for large keys,
    # within a small factor of it for this toy target of 2) ...
    assert split.select(F.max(F.size("calls"))).first()[0] <= 8
    assert split.select(F.explode("calls.items").alias("g")).select(F.max(F.size("g"))).first()[0] <= 8
    assert split.count() > whole.count()
    # ... and unnesting gives back exactly the same calls.
    a = P.m_calls_flat(whole)
    b = P.m_calls_flat(split)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == D.table(spark, SF, "lineitem").count()


def test_t_documents_shape(spark):
    docs = D.tj_documents(spark, SF)
    assert docs.columns == ["user_id", "create_time", "wd_api_mobilephone_getdatav2_response"]
    r = docs.select(F.col(D.TJ_DATA_LIST).getItem(0).alias("e")).first()
    assert r.e.userdata.phone is not None


def test_hot_keys_too_large_to_broadcast_use_shuffle_join(spark):
    a = P.m_calls_flat(D.mx_documents(spark, SF))
    earlier = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = P.m_calls_flat(D.mx_documents(spark, SF, max_elements=2))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", earlier)


def test_skewed_documents_are_split(spark):
    from nestflow.plans.queries import q_unnest_calls_skewed

    out = q_unnest_calls_skewed(spark, "/root/testdata/sf0.01")
    assert out.count() == D.table(spark, "/root/testdata/sf0.01", "lineitem").count()
    # the hot customer "0" is spread over several documents of bounded size
    li = D.table(spark, "/root/testdata/sf0.01", "lineitem").withColumn(
        "l_orderkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey")))
    o = D.table(spark, "/root/testdata/sf0.01", "orders").withColumn(
        "o_custkey", F.when(F.pmod("o_orderkey", F.lit(3)) == 1, F.lit(0).cast("bigint")).otherwise(F.col("o_custkey")))
    docs = D.mx_documents(spark, "/root/testdata/sf0.01", lineitem=li, orders=o)
    assert docs.filter("mobile = '0'").count() >= 5
    assert docs.select(F.max(F.size("calls"))).first()[0] <= 1300
    assert docs.select(F.explode("calls.items").alias("g")).select(F.max(F.size("g"))).first()[0] <= 1300


def test_null_key_can_be_hot(spark):
    from nestflow.plans import assemble

    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    hot = assemble.find_hot_keys(df.select("k"), ["k"], 100)
    assert hot.any
    chunked = assemble.with_chunk(assemble.with_position(df), hot, ["k", assemble.POSITION_COL])
    sizes = chunked.filter("k IS NULL").groupBy("__chunk").count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) <= 200


def test_copies_of_an_order_row_are_salted(spark):
    orders = D.table(spark, SF, "orders")
    copies = orders.filter("o_orderkey = 0").select("*", F.explode(F.sequence(F.lit(1), F.lit(300))).alias("__n")).drop("__n")
    dup = orders.unionByName(copies)
    docs = D.mx_documents(spark, SF, max_elements=64, orders=dup)
    li = D.table(spark, SF, "lineitem")
    n0 = li.filter("l_orderkey = 0").count()
    assert n0 > 0
    assert P.m_calls_flat(docs).count() == li.count() + 300 * n0
    # every copy is its own call group, and no document holds more than ~2x the target
    assert docs.select(F.max(F.size("calls"))).first()[0] <= 128


def test_documents_bounded_in_items(spark):
    docs = D.mx_documents(spark, SF, max_doc_items=32)
    items = docs.select(F.aggregate(F.col("calls"), F.lit(0),
                                    lambda acc, g: acc + F.coalesce(F.size(g["items"]), F.lit(0))).alias("n"))
    assert items.select(F.max("n")).first()[0] <= 96
    assert P.m_calls_flat(docs).count() == D.table(spark, SF, "lineitem").count()


def test_limits_change_no_answer(spark):
    """Every dataset, all columns, is the same whatever the documents are split into."""
    from nestflow.functions.clock import RunClock

    clock = RunClock.of("2001-08-03")

    def datasets(limit):
        m, t = D.mx_documents(spark, SF, limit), D.tj_documents(spark, SF, limit)
        return {"m_flat": P.m_calls_flat(m), "t_flat": P.t_calls_flat(t), "count": P.nested_count(m),
                "m_calls": P.provider_m_calls(m, clock, selection="snapshot"),
                "m_bills": P.provider_m_bills(m, clock, selection="snapshot"),
                "t_calls": P.provider_t_calls(t, clock), "t_bills": P.provider_t_bills(t, clock)}

    def content(found):
        return {name: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
                for name, df in found.items()}

    whole = content(datasets(1024))
    assert whole == content(datasets(2)) == content(datasets(8))


def test_gathering_tasks_are_bounded(spark, monkeypatch):
    """Tasks that gather documents get a bounded number of rows, however few the shuffle partitions are."""
    from nestflow.plans import assemble

    sf = "/root/testdata/sf0.01"
    flat = [P.m_calls_flat(D.mx_documents(spark, sf)), P.t_calls_flat(D.tj_shared_documents(spark, sf))]
    monkeypatch.setattr(assemble, "ROWS_PER_TASK", 1000, raising=False)
    bounded = [P.m_calls_flat(D.mx_documents(spark, sf)), P.t_calls_flat(D.tj_shared_documents(spark, sf))]
    for a, b in zip(flat, bounded):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        most = b.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 2500


def test_shared_documents_move_rows_no_more_than_others(spark):
    """Shared documents are gathered where their customers' pieces are: no shuffle and no stored pieces between."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    shared, single = plan(D.tj_shared_documents(spark, SF)), plan(D.tj_documents(spark, SF))
    assert "phone-pieces" not in shared and shared.count("FileScan") == single.count("FileScan")
    assert shared.count("Exchange hashpartitioning") == single.count("Exchange hashpartitioning")


def test_split_shared_documents_keep_their_time(spark):
    """Keys beyond a document's bounds (own rows; an order of many items, a customer of many orders, null keys) are split into
    documents that all have the whole key's time, and lose no call."""
    times = [f"1998-01-{d:02d} 00:00:00" for d in range(1, 29)]
    orders = spark.createDataFrame(
        [(k, None if k % 41 == 0 else (3 if k < 60 else k % 23), "F", 400000.0, times[k % 28], "1-URGENT") for k in range(200)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    items = spark.createDataFrame(
        [(k, n, 7, "R", "F", 1.0, times[n % 28]) for k in range(200) for n in range(90 if k == 5 else k % 4)],
        "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_linestatus string, l_quantity double, l_shipdate string"
    ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    size = F.aggregate(F.flatten(F.transform(F.col(D.TJ_DATA_LIST), lambda e: F.transform(e["teldata"], lambda c: F.greatest(F.size(c["items"]), F.lit(0))))),
                       F.lit(0), lambda n, x: n + x)
    found = {}
    for limit, bound in ((1024, 65_536), (4, 16), (1024, 60)):
        docs = D.tj_shared_documents(spark, SF, max_elements=limit, max_doc_items=bound, lineitem=items, orders=orders).persist()
        times_of = docs.groupBy("user_id").agg(F.count_distinct("create_time").alias("n")).agg(F.max("n")).first()[0]
        assert times_of == 1
        assert docs.count() > docs.select("user_id").distinct().count() or bound == 65_536
        assert docs.select(F.max(size)).first()[0] <= 4 * bound
        found[limit, bound] = sorted(map(str, P.t_calls_flat(docs).collect())), sorted(map(str, docs.select("user_id", "create_time").distinct().collect()))
        docs.unpersist()
    assert len(set(map(str, found.values()))) == 1 and len(found[1024, 65_536][0]) == items.count()
