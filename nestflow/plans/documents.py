"""Nested carrier documents derived from the given flat tables.

The reference reads phone-carrier documents from a document store; the test
data here is flat.  These builders derive documents with Spark so that every
query's work grows with the given tables:

* **M documents** (one per customer): ``mobile``, ``user_id``,
  ``create_time`` (timestamp), ``calls`` = one group per order whose
  ``items`` are its line items (NULL when the order has none), ``bills`` =
  the customer's finished orders above 300,000 (NULL when there are none),
  ``bill_count``.
* **T documents** (one per customer): the same calls and bills three levels
  deep under ``wd_api_mobilephone_getdatav2_response.data.data_list`` with
  the phone beside them, times and fees as *text*.
* **Shared T documents**: the T documents of ``PHONES`` consecutive customer keys
  in one, each customer an element of ``data_list`` with its own phone; the
  document's creation time is its latest customer's.
* **contacts** from ``events``, **real names** from ``customer``.

A document's creation time is its customer's last order date plus
``(custkey mod 86399) + 1`` seconds, so it is never at midnight (all order
dates are) and daily selections find documents.

Arrays are gathered with :mod:`nestflow.plans.assemble`, so an order or a
customer holding a huge share of the rows is split into several groups or
documents instead of one unbounded row; below ``MAX_ELEMENTS`` per key each
order is one call group and each customer one document.  A split changes no
answer: every piece carries the creation time and the bill count of its whole
customer (``bill_count``), and a call group that continues another one of the
same order says so (``continued``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.operators.filters import DAY_PREFIX, TIME_PREFIX, stored_time, with_stored_time
from nestflow.plans.assemble import (
    MAX_DOC_ITEMS,
    MAX_ELEMENTS,
    HotKeys,
    chunks_per_key,
    dealt,
    gather_tasks,
    with_chunk_copies,
    find_hot_keys,
    find_hot_keys_many,
    with_chunk,
    with_key_totals,
    with_position,
)
from nestflow.sources.collections import write_by_day
from nestflow.sources.schemas import narrow_schema

# Fixed values of the derived fixtures (ours, mirrored by the oracle SQL):
#   a bill is a finished order ('F') with total price above 300000
#   creation time = last order date + ((custkey mod 86399) + 1) seconds
#   T fee text is 'unknown' for orders of priority '5-LOW'
BILL_STATUS = "F"
BILL_MIN_PRICE = 300000
CREATE_OFFSET_MOD = 86399
#   a shared T document holds customers of one (custkey div 4)
UNKNOWN_FEE_PRIORITY = "5-LOW"
PHONES = 4
# Phones (pieces of customers) that one shared document holds at most, about.
MAX_PHONES = 64

TJ_ROOT = "wd_api_mobilephone_getdatav2_response"
TJ_DATA_LIST = f"{TJ_ROOT}.data.data_list"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: str) -> Column:
    """Wall-clock text ``yyyy-MM-dd HH:mm:ss`` of a ``TIMESTAMP_NTZ`` (zone-free)."""
    return F.col(c).cast("string")


def _month_text(c: str) -> Column:
    return F.substring(_text(c), 1, 7)


def _mx_item() -> Column:
    return F.struct(
        F.col("l_suppkey").cast("string").alias("peer_number"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("details_id"),
        F.col("l_returnflag").alias("dial_type"),
        F.col("l_quantity").try_cast("int").alias("duration"),
        F.col("l_shipdate").alias("time"),
    )


def _mx_bill() -> Column:
    return F.struct(
        F.col("o_totalprice").try_cast("int").alias("total_fee"),
        _month_text("o_orderdate").alias("bill_month"),
    )


def _tj_item() -> Column:
    return F.struct(
        _text("l_shipdate").alias("call_time"),
        F.col("l_suppkey").cast("string").alias("receive_phone"),
        F.col("l_linestatus").alias("call_type"),
        F.col("l_quantity").cast("string").alias("trade_time"),
    )


def _tj_bill() -> Column:
    fee = (F.when(F.col("o_orderpriority") == F.lit(UNKNOWN_FEE_PRIORITY), F.lit("unknown"))
           .otherwise(F.col("o_totalprice").cast("string")))
    return F.struct(fee.alias("pay_fee"), _month_text("o_orderdate").alias("month"))


def _phones_key(phones: int) -> Column:
    return F.floor(F.col("o_custkey") / phones)


def _create_offset() -> Column:
    return F.make_dt_interval(secs=(F.pmod(F.col("o_custkey"), F.lit(CREATE_OFFSET_MOD)) + 1).cast("decimal(18,6)"))


def _hot_phones(weights: DataFrame, hot_customers: HotKeys, phones: int, max_doc_items: int) -> HotKeys:
    """Keys of shared documents whose customers' pieces or items are too many for one.
    ``weights``: (o_custkey, __items) of every order."""
    customers = weights.groupBy("o_custkey").agg(F.sum("__items").alias("__items"))
    customers = chunks_per_key(customers, hot_customers, "o_custkey", "__n").select(_phones_key(phones).alias("__key"), "__items", "__n")
    return find_hot_keys(customers, ["__key"], limits={"__items": max_doc_items, "__n": max(phones, MAX_PHONES)})


def _customer_documents(spark: SparkSession, sf_dir: str, item: Callable[[], Column],
                        bill: Callable[[], Column], max_elements: int,
                        lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                        max_doc_items: int = MAX_DOC_ITEMS) -> DataFrame:
    """(o_custkey, create_time, calls, bills, bill_count) with bounded arrays.

    ``lineitem`` / ``orders`` replace the tables read from ``sf_dir`` (they
    must be narrow projections of a scan, so row positions stay stable)."""
    return _customer_pieces(spark, sf_dir, item, bill, max_elements, lineitem, orders, max_doc_items)[0]


def _customer_pieces(spark: SparkSession, sf_dir: str, item: Callable[[], Column],
                     bill: Callable[[], Column], max_elements: int,
                     lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                     max_doc_items: int = MAX_DOC_ITEMS, phones: int | None = None) -> tuple[DataFrame, HotKeys, DataFrame]:
    """``_customer_documents``, the hot keys of shared documents and the orders.

    With ``phones`` the pieces are dealt by the shared document they go to,
    ``__key`` and its chunk ``__kc``, so that gathering those moves nothing again."""
    li = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_quantity", "l_shipdate")
    orders = (orders if orders is not None else table(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")

    # The hot-key searches run as one action: items per order, orders per
    # customer (one call group each -- redone below with chunk weights in
    # the rare case of split orders) and copies per order row.
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("__items"))
    order_keys = orders.select("o_orderkey", "o_custkey")
    hot_orders, hot_customers, hot_order_rows = find_hot_keys_many([
        (per_order, ["l_orderkey"], {"__items": max_elements}),
        (order_keys, ["o_custkey"], {"": max_elements}),
        (order_keys, ["o_orderkey"], {"": max_elements}),
    ])
    n_items, n_orders, n_largest = hot_orders.total, hot_customers.total, hot_orders.largest

    def with_items(weights: DataFrame) -> DataFrame:
        return (weights.join(per_order, weights.o_orderkey == per_order.l_orderkey, "left")
                .select("o_custkey", "__w", F.coalesce("__items", F.lit(0)).alias("__items")))

    # Level 1: line items -> one call group per (order, chunk).  Items are
    # joined to their order on the salted key (order, chunk) -- a hot order's
    # row is repeated once per chunk, at most rows / max_elements copies
    # overall -- and gathered right after the join, which is already
    # partitioned on that key: the items cross the network once.
    if hot_orders.any:
        li = with_position(li, "__lpos")
    li = with_chunk(li, hot_orders, ["l_orderkey", "__lpos"] if hot_orders.any else [], "__lic")

    # Level 2: a customer's elements are its call groups (one per order, or
    # one per chunk of a split order).  A document is bounded both in call groups (``max_elements``) and in
    # items (``max_doc_items``), so the two nesting levels cannot multiply.
    # The item totals need a key-only join; it runs only when the largest
    # order times the most groups of any customer could pass the item bound.
    weights = chunks_per_key(order_keys, hot_orders, "o_orderkey")
    if hot_orders.any:
        hot_customers = find_hot_keys(weights, ["o_custkey"], max_elements, weight="__w")
    if min(hot_orders.largest, max_elements) * hot_customers.largest > max_doc_items:
        weights = with_items(weights)
        hot_customers = find_hot_keys(weights, ["o_custkey"],
                                      limits={"__w": max_elements, "__items": max_doc_items})
    # Level 3: a shared document's elements are its customers' pieces, counted
    # here as the customers' items are, before anything is gathered.  Customers
    # in one piece each with so few items cannot be too many for a document.
    hot_phones = HotKeys(["__key"], None)
    if phones and (hot_customers.any or n_largest * hot_customers.largest * phones > max_doc_items):
        hot_phones = _hot_phones(weights if "__items" in weights.columns else with_items(weights), hot_customers, phones, max_doc_items)
    # Copies of one order row are salted the same way from the other side:
    # their items are repeated once per chunk of copies.
    positioned = hot_customers.any or hot_order_rows.any
    if positioned:
        orders = with_position(orders, "__opos")
    base = ["o_orderkey", "o_custkey", "o_orderdate"] + (["__opos"] if positioned else [])
    keyed = with_chunk_copies(orders.select(*base), hot_orders, "o_orderkey", "__ic", split="__split")
    keyed = with_chunk(keyed, hot_order_rows, ["o_orderkey", "__opos"] if hot_order_rows.any else [], "__oc")
    li = with_chunk_copies(li, hot_order_rows, "l_orderkey", "__loc")
    # A merge join keeps the same plan at every scale: line items are never
    # the broadcast side (they are the bulk of the data, and the gathering
    # runs in the join tasks).
    # (Columns are named, not taken from a parent frame: in the shuffle-join
    # fallback both sides share the line-item lineage.)
    # Both sides are dealt to as many tasks as the rows need, by the join's
    # columns (the chunk numbers are constants unless a key is hot).
    tasks = gather_tasks(spark, n_items + n_orders)
    salted = [(c, lc) for c, lc, hot in (("__ic", "__lic", hot_orders), ("__oc", "__loc", hot_order_rows)) if hot.any]
    on = F.col("o_orderkey") == F.col("l_orderkey")
    for c, lc in salted:
        on = on & (F.col(c) == F.col(lc))
    keyed = dealt(keyed, tasks, "o_orderkey", *(c for c, _ in salted))
    li = dealt(li, tasks, "l_orderkey", *(lc for _, lc in salted))
    joined = (keyed.join(li.hint("merge"), on, "left")
              .filter(F.col("l_orderkey").isNotNull() | (F.col("__ic") == 0)))
    # ``__oc`` follows from the row's position: it changes no group and spares a shuffle.
    copies = ["__oc"] if hot_order_rows.any else []
    groups = joined.groupBy(*base, "__ic", "__split", *copies).agg(
        F.collect_list(F.when(F.col("l_orderkey").isNotNull(), item())).alias("items"))
    # A split order has items, so its first group is never NULL: it is the one that counts.
    items = F.when((F.size("items") > 0) | F.col("__split"), F.col("items"))
    calls = groups.select(*base, "__ic",
                          F.struct(items.alias("items"), (F.col("__ic") > 0).alias("continued")).alias("call"),
                          F.lit(None).alias("bill"))
    is_bill = (F.col("o_orderstatus") == F.lit(BILL_STATUS)) & (F.col("o_totalprice") > F.lit(BILL_MIN_PRICE))
    bills = orders.filter(is_bill).select(*base, F.lit(0).alias("__ic"),
                                          F.lit(None).alias("call"), bill().alias("bill"))
    rows = calls.unionByName(bills, allowMissingColumns=True)
    spread = ["o_orderkey", "__ic", "__opos"] if positioned else []
    rows = with_chunk(rows, hot_customers, spread, "__dc")
    pieces, shared = ["o_custkey", *(["__dc"] if hot_customers.any else [])], []
    if phones:
        rows = with_chunk(rows.withColumn("__key", _phones_key(phones)), hot_phones, ["o_custkey", "__dc"], "__kc")
        pieces, shared = ["__key", *(["__kc"] if hot_phones.any else [])], ["__key", "__kc"]
    rows = rows.repartition(tasks, *pieces) if tasks else rows.repartition(*pieces)
    docs = rows.groupBy(*shared, "o_custkey", "__dc").agg(
        F.max("o_orderdate").alias("__last"),
        F.collect_list("call").alias("calls"),
        F.collect_list("bill").alias("bills"),
    )
    last, bill_count = F.col("__last"), F.size("bills").cast("long")
    if hot_customers.any:
        totals = {"__all_last": F.max("o_orderdate"), "__all_bills": F.count_if(is_bill)}
        docs = with_key_totals(docs, hot_customers, orders, totals)
        last, bill_count = F.coalesce("__all_last", last), F.coalesce("__all_bills", bill_count)
    docs = docs.select(
        *shared,
        "o_custkey",
        (last + _create_offset()).alias("create_time"),
        "calls",
        F.when(F.size("bills") > 0, F.col("bills")).alias("bills"),
        bill_count.alias("bill_count"),
    )
    return docs, hot_phones, orders


def mx_documents(spark: SparkSession, sf_dir: str, max_elements: int = MAX_ELEMENTS,
                 lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                 max_doc_items: int = MAX_DOC_ITEMS) -> DataFrame:
    docs = _customer_documents(spark, sf_dir, _mx_item, _mx_bill, max_elements, lineitem, orders,
                               max_doc_items)
    return docs.select(
        F.col("o_custkey").cast("string").alias("mobile"),
        F.concat(F.lit("U"), F.col("o_custkey")).alias("user_id"),
        "create_time", "calls", "bills", "bill_count",
    )


def tj_documents(spark: SparkSession, sf_dir: str, max_elements: int = MAX_ELEMENTS,
                 lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                 max_doc_items: int = MAX_DOC_ITEMS) -> DataFrame:
    docs = _customer_documents(spark, sf_dir, _tj_item, _tj_bill, max_elements, lineitem, orders,
                               max_doc_items)
    return docs.select(
        F.concat(F.lit("U"), F.col("o_custkey")).alias("user_id"),
        _text("create_time").alias("create_time"),
        _tj_response(F.array(_tj_element())),
    )


def _tj_element() -> Column:
    """One phone of a T document, from the columns of ``_customer_documents``."""
    return F.struct(
        F.struct(F.col("o_custkey").cast("string").alias("phone")).alias("userdata"),
        F.col("calls").alias("teldata"),
        F.col("bills").alias("billdata"),
    )


def _tj_response(data_list: Column) -> Column:
    return F.struct(F.struct(data_list.alias("data_list")).alias("data")).alias(TJ_ROOT)


def tj_shared_documents(spark: SparkSession, sf_dir: str, max_elements: int = MAX_ELEMENTS,
                        lineitem: DataFrame | None = None, orders: DataFrame | None = None,
                        max_doc_items: int = MAX_DOC_ITEMS, phones: int = PHONES) -> DataFrame:
    """T documents of several phones each: a third bounded nesting level.

    The elements are the customers' pieces.  A document is bounded in elements
    and in call items; a key beyond that is split into several documents, which
    all have the creation time of the whole key.  A customer's rows are dealt by
    that document already, so both levels are gathered where the rows are.
    """
    pieces, hot, orders = _customer_pieces(spark, sf_dir, _tj_item, _tj_bill, max_elements, lineitem, orders, max_doc_items, phones)
    docs = pieces.groupBy("__key", "__kc").agg(F.max("create_time").alias("__last"), F.collect_list(_tj_element()).alias("elements"))
    last = F.col("__last")
    if hot.any:
        totals = {"__all_last": F.max(F.col("o_orderdate") + _create_offset())}
        docs = with_key_totals(docs, hot, orders.withColumn("__key", _phones_key(phones)), totals)
        last = F.coalesce("__all_last", last)
    return docs.select(
        F.concat(F.lit("H"), F.col("__key")).alias("user_id"),
        last.cast("string").alias("create_time"),
        _tj_response(F.col("elements")),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        F.col("event_id").cast("string").alias("phone"),
        F.col("ts").alias("gmtCreate"),
    )


def real_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("phone"),
        F.col("c_name").alias("userId"),
    )


# --------------------------------------------------------------------------
# Stored collections
# --------------------------------------------------------------------------
#
# The reference reads its documents from a store; building them from the
# flat tables in every query would repeat two shuffles of all line items per
# query.  So the derived collection is written once, as Parquet, under the
# cluster's shared folder (``spark.checkpoint.dir``), keyed by the source
# files' sizes and times, and each pipeline scans it with a narrow nested
# read schema made from the paths it uses.  Text creation times get the parsed
# time beside them, so selections reach the scan.  Files are sorted by
# creation time so row-group statistics let a run skip most of a large
# collection; the ``_by_day`` collections are partitioned by the creation day,
# so a daily run opens the folder of its day only.

COLLECTION_VERSION = "4"
_LI = ["lineitem", "orders"]
SOURCES = {"mx": _LI, "tj": _LI, "mx_json": _LI, "tj_json": _LI, "mx_by_day": _LI, "tj_by_day": _LI, "tj_shared": _LI,
           "contacts": ["events"], "real_names": ["customer"]}
# Collections written as JSON lines (a document store's export format):
# wall-clock times as 'yyyy-MM-dd HH:mm:ss' text.
JSON_KINDS = {"mx_json": "mx", "tj_json": "tj"}
DAY_KINDS = {"mx_by_day": "mx", "tj_by_day": "tj"}
JSON_WRITE_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
DOCS_PER_FILE = 200_000
BUILDERS: dict[str, Callable[..., DataFrame]] = {}


def _fs_signature(spark: SparkSession, paths: list[str]) -> str:
    import hashlib

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        st = fs.getFileStatus(path)
        parts.append(f"{fs.makeQualified(path).toString()}:{fs.getContentSummary(path).getLength()}:"
                     f"{st.getModificationTime()}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, p: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(p)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _publish(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename ``src`` to ``dst`` only if ``dst`` does not exist (never into
    it, as a plain HDFS rename onto an existing folder would)."""
    sc = spark.sparkContext
    jvm = sc._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    conf = sc._jsc.hadoopConfiguration()
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(s.toUri(), conf)
    opts = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    opts[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        fc.rename(s, d, opts)
        return True
    except Exception:  # the target appeared meanwhile (another publisher won)
        return False


def _code_signature() -> str:
    """Hash of the builder code, so a changed builder never reuses an old
    collection."""
    import hashlib
    import inspect

    from nestflow.plans import assemble

    src = inspect.getsource(inspect.getmodule(_customer_documents)) + inspect.getsource(assemble)
    return hashlib.sha1(src.encode()).hexdigest()[:8]


def collection_path(spark: SparkSession, sf_dir: str, kind: str,
                    max_elements: int = MAX_ELEMENTS) -> str:
    from nestflow.sources.sinks import shared_dir

    srcs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCES[kind]]
    sig = f"{_code_signature()}-{_fs_signature(spark, srcs)}"
    return shared_dir(spark, "nestflow", "collections", f"{kind}-v{COLLECTION_VERSION}-m{max_elements}-{sig}")


def stage_collection(spark: SparkSession, sf_dir: str, kind: str, max_elements: int = MAX_ELEMENTS,
                     path: str | None = None) -> str:
    """Build the ``kind`` collection and write it (atomically: a fully
    committed folder is renamed into place, failing rather than nesting if
    another writer published first) unless it is already there."""
    import uuid

    path = path or collection_path(spark, sf_dir, kind, max_elements)
    if _exists(spark, path):  # only ever created by publishing a complete write
        return path
    base_kind = {**JSON_KINDS, **DAY_KINDS}.get(kind, kind)
    builder = BUILDERS[base_kind]
    df = builder(spark, sf_dir, max_elements) if SOURCES[kind] is _LI else builder(spark, sf_dir)
    order = {"contacts": "gmtCreate", "real_names": "phone"}.get(base_kind, "create_time")
    tmp = f"{path}-tmp-{uuid.uuid4().hex[:12]}"
    # Bounded files whatever the shuffle partition count: documents are
    # bounded in size, so a record cap bounds the file size too.
    if kind in DAY_KINDS:
        rows = sum(table(spark, sf_dir, t).count() for t in SOURCES[kind])
        write_by_day(df, tmp, order, max_records_per_file=DOCS_PER_FILE, tasks=gather_tasks(spark, rows))
    elif kind in JSON_KINDS:
        df.sortWithinPartitions(order).write.option("maxRecordsPerFile", str(DOCS_PER_FILE)).options(**JSON_WRITE_OPTIONS).json(tmp)
    else:
        if order != "phone":
            df = with_stored_time(df, order).drop(DAY_PREFIX + order)
        df.sortWithinPartitions(stored_time(df, order)).write.option("maxRecordsPerFile", str(DOCS_PER_FILE)).parquet(tmp)
    if not _publish(spark, tmp, path) and not _exists(spark, path):
        raise RuntimeError(f"could not publish collection {path}")
    return path


_schemas: dict[str, T.StructType] = {}


def stored_collection(spark: SparkSession, sf_dir: str, kind: str, paths: Sequence[str] | None = None,
                      max_elements: int = MAX_ELEMENTS) -> DataFrame:
    """The stored ``kind`` collection (staged on first use), read with the part
    of its schema that ``paths`` use: nested leaves in no path are not read."""
    path = stage_collection(spark, sf_dir, kind, max_elements)
    if paths is None:
        return spark.read.parquet(path)
    if path not in _schemas:  # a published collection never changes
        _schemas[path] = spark.read.parquet(path).schema
    full = _schemas[path]
    staged = [n for n in full.fieldNames() if n.startswith((TIME_PREFIX, DAY_PREFIX))]
    return spark.read.schema(narrow_schema(full, [*paths, *staged])).parquet(path)


BUILDERS.update({"mx": mx_documents, "tj": tj_documents, "tj_shared": tj_shared_documents, "contacts": contacts,
                 "real_names": real_names})

# The paths that the pipelines use.
M_CALLS_PATHS = ["mobile", "user_id", "create_time", "calls.items", "bills.bill_month", "bill_count"]
M_BILLS_PATHS = ["mobile", "create_time", "bills.total_fee", "bills.bill_month"]
M_COUNT_PATHS = ["calls.items.details_id", "calls.continued"]
T_CALLS_PATHS = ["user_id", "create_time", f"{TJ_DATA_LIST}.userdata.phone",
                 *(f"{TJ_DATA_LIST}.teldata.items.{f}" for f in ("call_time", "receive_phone", "call_type", "trade_time"))]
T_BILLS_PATHS = ["create_time", *(f"{TJ_DATA_LIST}.{f}" for f in ("userdata.phone", "billdata.pay_fee", "billdata.month"))]
