"""Every operator as a query over the sample tables.

Results hold only plain types (bigint, double, string), so that they compare with any
other engine: dates as text, instants as epoch seconds, money as double after exact
decimal arithmetic.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions import wire
from cdcmart.functions.money import exact_ratio_round
from cdcmart.functions.text import slug
from cdcmart.functions.time import millis_to_second
from cdcmart.operators import orders as order_ops
from cdcmart.operators import quality, state
from cdcmart.operators.asof import unit_cost_asof
from cdcmart.operators.bronze import typed_bronze
from cdcmart.operators.distinct import count_sets, distinct_sets
from cdcmart.operators.quarantine import quarantine, quarantine_summary
from cdcmart.plans.maintained import MaintainedFacts
from cdcmart.plans.warehouse import Warehouse
from cdcmart.session import checkpoint_dir, configure, released
from cdcmart.sources.base import Store
from cdcmart.sources.changes import capture_raw, drop_sensitive, protect, snapshot_as_changes, unwrap_envelope
from cdcmart.sources.chunks import ChunkedSnapshot
from cdcmart.sources.indexed import IndexedLog
from cdcmart.sources.log import expire
from cdcmart.sources.sample import Sample, text_id
from cdcmart.sources.specs import (
    BY_ORDER,
    FOREIGN_KEYS,
    QUARANTINE_DAYS,
    RAW_DAYS,
    REQUIRED_COLUMNS,
    TABLES,
    TRANSACTION_TYPES,
    UNIQUE_COLUMNS,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
SOME_DAYS = (dt.date(1996, 1, 1), dt.date(1997, 6, 30))


def plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        value = F.col(field.name)
        match field.dataType:
            case T.DecimalType():
                value = value.cast("double")
            case T.DateType():
                value = value.cast("string")
            case T.TimestampType():
                value = F.unix_seconds(value)
            case T.BooleanType() | T.ByteType() | T.ShortType() | T.IntegerType():
                value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def query(run: Callable[[Sample], DataFrame], name: str | None = None) -> Callable[[Sample], DataFrame]:
    """Register ``run`` under its own name or the given one."""

    def on_folder(spark: SparkSession, folder: str) -> DataFrame:
        return plain(run(Sample(configure(spark), folder)))

    QUERIES[name or run.__name__] = on_folder
    return run


def warehouse(sample: Sample, **options) -> Warehouse:
    """Over change tables with several versions per key, re-deliveries and deletes. Line ids repeat in other orders."""
    return Warehouse(sample.spark, sample.histories(), keys=BY_ORDER, **options)


def _scratch(sample: Sample, name: str) -> str:
    return f"{checkpoint_dir(sample.spark, scratch=True)}/{name}-{uuid.uuid4().hex}"


# --- sources --------------------------------------------------------------------------


@query
def raw_event_counts(sample: Sample) -> DataFrame:
    raw = capture_raw(sample.event_log(), F.lit(NOW))
    return raw.groupBy("topic", "kafka_partition").agg(
        F.count("*").alias("event_count"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
        F.max("ingested_at").alias("ingested_at"),
    )


def _customers(sample: Sample) -> DataFrame:
    """Customers as source rows, sensitive columns included."""
    return sample.read("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        F.lit("secret").alias("password"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_custkey").cast("string").alias("mobile"),
        (F.col("c_custkey") * 1000).alias("created_at"),
    )


def _user_envelopes(sample: Sample) -> DataFrame:
    """Events as before/after messages of the users table; views are empty messages.

    By residue of the event: 1 repeats a column, 2 has a column named like an added one, 3
    does not name its table, 4 has text behind the envelope and so is none.
    """
    residue = F.pmod(F.col("event_id"), F.lit(10))
    row = F.concat(
        F.lit('{"id":'), F.col("user_id").cast("string"),
        F.when(residue == 1, ',"username":"old"').when(residue == 2, ',"__op":"x","__table":"y"').otherwise(""),
        F.lit(',"username":"name '),
        F.col("event_id").cast("string"), F.lit('","password":"x","created_at":'),
        (F.col("event_id") * 1000).cast("string"), F.lit("}"),
    )
    gone = F.col("event_type") == "error"
    text = F.concat(
        F.lit('{"before":'), F.when(gone, row).otherwise("null"), F.lit(',"after":'),
        F.when(gone, "null").otherwise(row), F.lit(',"op":"'), F.when(gone, "d").otherwise("u"),
        F.lit('","source":{'), F.when(residue == 3, "").otherwise('"table":"users",'), F.lit('"ts_ms":'),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit("}}"),
        F.when(residue == 4, " tail").otherwise(""),
    )
    return sample.read("events").select(
        F.lit(TABLES["users"].topic).alias("topic"),
        F.lit(0).alias("partition"),
        # Behind the snapshot, whose offsets are customer numbers.
        (F.col("event_id") + (1 << 40)).alias("offset"),
        F.when(F.col("event_type") != "view", text).alias("payload"),
    )


@query
def snapshot_union(sample: Sample) -> DataFrame:
    snapshot = snapshot_as_changes(_customers(sample), "users", F.lit(0), F.col("id"))
    log = snapshot.unionByName(unwrap_envelope(_user_envelopes(sample)))
    return state.current_state(typed_bronze(log, TABLES["users"]))


@query
def chunked_snapshot(sample: Sample) -> DataFrame:
    """Customers taken in four chunks while events rename and delete them: each chunk's rows are read a while
    after its first position in the log and a while before its second one."""
    events = sample.read("events").select(
        F.col("user_id").alias("id"), F.concat(F.lit("name "), F.col("event_id").cast("string")).alias("username"),
        F.col("event_id").alias("_version"), (F.col("event_type") == "error").cast("int").alias("_deleted"),
    )
    customers = sample.read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"))
    last = events.agg(F.max("_version")).first()[0] or 0
    positions = iter([last * i // 16 for i in range(1, 17)])

    def read(chunk) -> DataFrame:
        happened = events.where(F.col("_version") <= next(positions))
        start = customers.withColumns({"_version": F.lit(-1).cast("bigint"), "_deleted": F.lit(0)})
        return state.current_state(start.unionByName(happened)).where(chunk.holds(F.col("id"))).select("id", "username")

    def log(low: int, high: int) -> DataFrame:
        return events.where((F.col("_version") > low) & (F.col("_version") <= high))

    snapshot = ChunkedSnapshot(sample.spark, _scratch(sample, "snapshot"), read, log, lambda: next(positions))
    snapshot.plan(customers, sample.read("customer").count() // 4 + 1)
    snapshot.run()
    return state.current_state(snapshot.changes().unionByName(events)).select("id", "username")


@partial(query, name="unwrap_envelope")
def unwrap_envelopes(sample: Sample) -> DataFrame:
    names = ("id", "username", "password", "__op", "__table", "__source_ts_ms", "__deleted")
    flat = wire.open_fields(unwrap_envelope(_user_envelopes(sample)), names)
    texts = {name.strip("_"): F.col("_json")[name] for name in names}
    texts["password"] = texts["password"].isNotNull()
    return flat.select("offset", *[text.alias(name) for name, text in texts.items()])


@query
def pii_excluded(sample: Sample) -> DataFrame:
    """Keys that are stored of snapshot rows, and of flat rows whose source kept the columns."""
    rows = snapshot_as_changes(_customers(sample), "users", F.lit(0), F.col("id"))
    kept = drop_sensitive(_customers(sample), "users")
    whole = F.to_json(F.struct(*[F.col(c) for c in _customers(sample).columns], F.lit("c").alias("__op")))
    flat = _customers(sample).select(
        F.lit(TABLES["users"].topic).alias("topic"), F.lit(0).alias("partition"), (-F.col("id")).alias("offset"), whole.alias("payload")
    )
    rows = rows.unionByName(protect(flat))
    listed = rows.select("offset", F.array_join(F.json_object_keys("payload"), ",").alias("payload_keys"))
    return listed.join(kept.select("id", "username"), F.abs("offset") == F.col("id")).drop("id")


@query
def retention_kept(sample: Sample) -> DataFrame:
    log = sample.event_log().select("topic", "ts")
    parts = [
        expire(log, "ts", days, F.lit(NOW)).groupBy("topic").agg(F.count("*").alias("event_count"))
        .withColumn("days", F.lit(days))
        for days in (RAW_DAYS, QUARANTINE_DAYS)
    ]
    return parts[0].unionByName(parts[1])


def _indexed(sample: Sample) -> IndexedLog:
    """The raw log by event time, in three batches."""
    store = IndexedLog(sample.spark, _scratch(sample, "raw"))
    raw = sample.event_log().withColumnsRenamed({"partition": "kafka_partition", "offset": "kafka_offset", "ts": "ingested_at"})
    for batch in range(3):
        store.append(raw.where(F.pmod(F.hash("kafka_offset"), F.lit(3)) == batch), batch)
    return store


@query
def raw_log_retained(sample: Sample) -> DataFrame:
    """The raw log after its expiry, the boundary's files written anew."""
    store = _indexed(sample)
    store.expire(RAW_DAYS, NOW)
    found = store.read().select("topic", "kafka_partition", "kafka_offset", "ingested_at").checkpoint()
    store.discard()
    return found


@query
def raw_log_replayed(sample: Sample) -> DataFrame:
    """Every topic read again from the offset in the middle of the log on, by the index."""
    store = _indexed(sample)
    index = store.index()
    middle = index.agg(F.floor(F.max("last_offset") / 2)).first()[0] or 0
    parts = [store.replay(row.topic, row.kafka_partition, middle) for row in index.select("topic", "kafka_partition").distinct().collect()]
    found = reduce(DataFrame.unionByName, parts) if parts else store.read()
    found = found.select("topic", "kafka_partition", "kafka_offset", "ingested_at", F.char_length("payload").alias("n_chars")).checkpoint()
    store.discard()
    return found


# --- typed change tables --------------------------------------------------------------


@partial(query, name="typed_bronze")
def typed_lines(sample: Sample) -> DataFrame:
    return typed_bronze(sample.event_log(), TABLES["orderdetails"])


def _typed(name: str, sample: Sample) -> DataFrame:
    """A table's rows written to the log as its source would, and read back typed."""
    rows = sample._table(name).drop("_version", "_deleted")
    columns = []
    for field in rows.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = F.unix_millis(value)
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    log = snapshot_as_changes(rows.select(*columns), name, F.lit(0), F.col("id"))
    return typed_bronze(log, TABLES[name])


for _name in TABLES:
    if _name not in ("users", "orderdetails"):  # read by snapshot_union and typed_bronze
        query(partial(_typed, _name), f"typed_{_name}")


def _opened(sample: Sample) -> DataFrame:
    return wire.open_fields(sample.event_log(), ["product_price", "created_at"])


@query
def coerce_numeric(sample: Sample) -> DataFrame:
    text = F.col("_json.product_price")
    return _opened(sample).select(
        "offset",
        wire.decimal_or_zero(text).alias("money_or_zero"),
        wire.decimal_or_null(text).alias("money_or_null"),
        wire.float_or_null(text).alias("float_or_null"),
    )


@query
def coerce_millis(sample: Sample) -> DataFrame:
    millis = F.col("_json.created_at").try_cast("bigint")
    return _opened(sample).select(
        "offset",
        millis_to_second(F.coalesce(millis, F.lit(0).cast("bigint"))).alias("time_or_epoch"),
        millis_to_second(millis).alias("time_or_null"),
    )


@query
def json_valid(sample: Sample) -> DataFrame:
    return sample.event_log().select("offset", wire.json_valid(F.col("payload")).alias("valid"))


# --- current state and quarantine -----------------------------------------------------


@query
def current_state(sample: Sample) -> DataFrame:
    return state.current_state(sample.event_changes())


@query
def current_state_audit(sample: Sample) -> DataFrame:
    return state.current_state(sample.event_changes(), include_deleted=True)


@query
def compacted_changes(sample: Sample) -> DataFrame:
    """Compacting and then adding the same log again gives the audit state."""
    log = sample.event_changes()
    return state.compact(state.compact(log).unionByName(log))


@query
def incremental_compaction(sample: Sample) -> DataFrame:
    """Users' changes merged in four batches into a bucketed base. Later batches hold older changes as well, and the
    last one comes a second time."""
    store = Store(sample.spark, _scratch(sample, "compaction"), buckets=16)
    log = sample.event_changes()
    part = F.pmod(F.xxhash64("_version"), F.lit(4))
    for batch in (0, 1, 2, 3, 4):
        store.merge_changes(log.where(part == min(batch, 3)), batch)
    found = store.read().checkpoint()
    store.discard()
    return found


def _maintained(name: str, sample: Sample) -> DataFrame:
    """A fact after a first load and two batches of changes. A third of all rows is corrected late, half of
    these with the first batch; rows that are deleted later count until then; the second batch
    also repeats the first one's changes and corrects what orders refer to."""
    buckets = max(8, int(sample.spark.conf.get("spark.sql.shuffle.partitions")))  # from so many on stored rows stay in place
    facts = MaintainedFacts(sample.spark, _scratch(sample, name), [name], buckets=buckets)
    late, soon = F.pmod(F.xxhash64("id"), F.lit(3)) == 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0
    version = F.col("_version")
    first = {table: sample.history(table).where((version == 0) | (late & (version == 1)) | (~late & (version == 2))) for table in facts.tables}
    corrected = {table: sample.history(table).where(((version == 2) & late) | (version == 3)) for table in facts.tables}
    own = ("orders", "orderdetails", "users")
    soon_corrected = {table: rows.where(soon) for table, rows in corrected.items() if table in own}
    for number, changes in enumerate((first, soon_corrected, corrected)):
        facts.apply(changes, number)
        facts.drop_unreferenced(1, dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=1))  # nobody else reads or writes
    with released(sample.spark):
        found = getattr(facts, name)().checkpoint()
    facts.discard()
    return found


for _name in ("fact_sales_product", "fact_order_overview", "fact_user_registration"):
    query(partial(_maintained, _name), f"maintained_{_name}")


@query
def replay_idempotent(sample: Sample) -> DataFrame:
    log = sample.order_log()
    tables = {**sample.tables(), "orders": log.unionByName(log)}
    replayed = Warehouse(sample.spark, tables, compacted=set(tables) - {"orders"})
    return replayed.fact_order_overview()


@query
def schema_evolution(sample: Sample) -> DataFrame:
    """Lines shipped before 1998 come from a table without the cost column."""
    lines, spec = sample._table("orderdetails"), TABLES["orderdetails"]
    border = F.lit("1998-01-01").cast("timestamp")
    old = lines.where(F.col("created_at") < border).drop("unit_cost_at_order")
    new = lines.where(F.col("created_at") >= border)
    both = state.align_schema(old, spec).unionByName(state.align_schema(new, spec))
    return both.groupBy("product_id").agg(
        F.count("*").alias("line_count"),
        F.count("unit_cost_at_order").alias("known_cost_count"),
        F.sum("unit_cost_at_order").alias("known_cost"),
    )


@query
def quarantine_reasons(sample: Sample) -> DataFrame:
    return quarantine(capture_raw(sample.event_log(), F.lit(NOW)), F.lit(NOW)).drop("payload")


@partial(query, name="quarantine_summary")
def quarantine_counts(sample: Sample) -> DataFrame:
    return quarantine_summary(quarantine(capture_raw(sample.event_log(), F.lit(NOW)), F.lit(NOW)))


# --- cleaned entities -----------------------------------------------------------------


@query
def silver_users(sample: Sample) -> DataFrame:
    return warehouse(sample).users()


@query
def silver_locations(sample: Sample) -> DataFrame:
    return warehouse(sample).locations()


@query
def silver_campaigns(sample: Sample) -> DataFrame:
    return warehouse(sample).campaigns().drop("updated_at")


@query
def silver_order_status(sample: Sample) -> DataFrame:
    return warehouse(sample).order_status()


@query
def silver_orders(sample: Sample) -> DataFrame:
    return warehouse(sample).orders()


@query
def silver_products(sample: Sample) -> DataFrame:
    return warehouse(sample).products()


@query
def silver_order_items(sample: Sample) -> DataFrame:
    return warehouse(sample).order_items()


# --- dimensions and facts -------------------------------------------------------------


@query
def dim_date(sample: Sample) -> DataFrame:
    """The calendar, with the number of orders placed on each day."""
    placed = sample.read("orders").groupBy(F.to_date("o_orderdate").alias("date_key")).agg(F.count("*").alias("n"))
    days = warehouse(sample).dim_date().join(placed, "date_key", "left")
    return days.withColumn("order_count", F.coalesce("n", F.lit(0))).drop("n")


@query
def dim_products(sample: Sample) -> DataFrame:
    return warehouse(sample).dim_products()


@query
def dim_locations(sample: Sample) -> DataFrame:
    return warehouse(sample).dim_locations()


@query
def dim_campaigns(sample: Sample) -> DataFrame:
    return warehouse(sample).dim_campaigns().drop("updated_at")


@query
def dim_order_status(sample: Sample) -> DataFrame:
    return warehouse(sample).dim_order_status()


@query
def fact_user_registration(sample: Sample) -> DataFrame:
    return warehouse(sample).fact_user_registration()


@query
def fact_order_overview(sample: Sample) -> DataFrame:
    return warehouse(sample).fact_order_overview()


@query
def sales_line_base(sample: Sample) -> DataFrame:
    return warehouse(sample).sales_line_base()


@partial(query, name="exact_ratio_round")
def ratio_round(sample: Sample) -> DataFrame:
    """Exact rounding on every line, with both signs: (price - 50000) * price / subtotal."""
    part = F.col("product_price")
    return sample.lines().select(
        "order_id",
        "id",
        exact_ratio_round((part - 50000).cast("decimal(15,2)"), part, F.col("subtotal_amount")).alias("share"),
    )


@query
def sales_line_preliminary(sample: Sample) -> DataFrame:
    return warehouse(sample).sales_line_preliminary()


@query
def sales_line_allocated(sample: Sample) -> DataFrame:
    return warehouse(sample).sales_line_allocated()


@query
def sales_line_measured(sample: Sample) -> DataFrame:
    return warehouse(sample).sales_line_measured()


@query
def fact_sales_product(sample: Sample) -> DataFrame:
    return warehouse(sample).fact_sales_product()


@query
def discount_conservation(sample: Sample) -> DataFrame:
    return warehouse(sample).discount_conservation()


@query
def distinct_orders(sample: Sample) -> DataFrame:
    """Delivered orders by category and by month, each order once, from one set of stored sets by day and product."""
    shop = warehouse(sample)
    checkpoint_dir(sample.spark, scratch=True)
    sets = distinct_sets(shop.sales_line_base(), ["date_key", "product_id"], "order_id").checkpoint()
    named = sets.join(shop.dim_products().select("product_id", "category_name"), "product_id", "left")
    by_category = count_sets(named, ["category_name"], "order_count").select(F.lit("category").alias("scope"), F.col("category_name").alias("name"), "order_count")
    dated = sets.withColumn("month", F.date_format("date_key", "yyyy-MM"))
    by_month = count_sets(dated, ["month"], "order_count").select(F.lit("month").alias("scope"), F.col("month").alias("name"), "order_count")
    return by_category.unionByName(by_month)


# --- reports --------------------------------------------------------------------------


@query
def report_marketing_dashboard(sample: Sample) -> DataFrame:
    return warehouse(sample).report_marketing_dashboard()


@query
def report_overview_sales(sample: Sample) -> DataFrame:
    return warehouse(sample).report_overview_sales()


@query
def report_overview_sales_days(sample: Sample) -> DataFrame:
    """The sales report of a range of business days."""
    return warehouse(sample, days=SOME_DAYS).report_overview_sales()


@query
def report_overview_sales_compacted(sample: Sample) -> DataFrame:
    """The sales report over tables that hold one row per key."""
    tables = sample.tables()
    return Warehouse(sample.spark, tables, compacted=tables).report_overview_sales()


@query
def report_overview_sales_base(sample: Sample) -> DataFrame:
    """The sales report of a range of days over compacted tables and the changes since: every
    seventh row is corrected late, and changes that came too late lose."""
    tables = sample.tables()

    def base(name: str) -> DataFrame:
        return sample._table(name).withColumn("_version", F.lit(2).cast("bigint"))

    def since(name: str) -> DataFrame:
        return sample.history(name).where(F.pmod(F.xxhash64("id"), F.lit(7)) == 0)

    made = {name: partial(base, name) for name in tables}
    changes = {name: partial(since, name) for name in tables}
    return Warehouse(sample.spark, changes, base=made, keys=BY_ORDER, days=SOME_DAYS).report_overview_sales()


@query
def report_overview_orders(sample: Sample) -> DataFrame:
    return warehouse(sample).report_overview_orders()


@query
def report_overview_users(sample: Sample) -> DataFrame:
    return warehouse(sample).report_overview_users()


@query
def report_delivered_order_aov(sample: Sample) -> DataFrame:
    return warehouse(sample).report_delivered_order_aov()


@query
def fact_validation(sample: Sample) -> DataFrame:
    return warehouse(sample).fact_validation()


# --- order economics and lifecycle ----------------------------------------------------


def _unpriced(sample: Sample) -> DataFrame:
    return sample.lines().select("id", "order_id", "product_id", "quantity", "product_price")


def _priced_orders(sample: Sample) -> DataFrame:
    headers = sample.read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        Sample._campaign().alias("discount_id"),
        Sample._priority().alias("payment_method_id"),
    )
    return order_ops.price_orders(headers, order_ops.price_lines(_unpriced(sample)), sample.discounts())


@query
def price_lines(sample: Sample) -> DataFrame:
    return order_ops.price_lines(_unpriced(sample))


@query
def price_orders(sample: Sample) -> DataFrame:
    return _priced_orders(sample)


@partial(query, name="unit_cost_asof")
def unit_cost_at_line(sample: Sample) -> DataFrame:
    """Each event as a line one hour later, costed by the events before it."""
    lines = sample.read("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("product_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp") + F.expr("interval 1 hour")).alias("created_at"),
    )
    return unit_cost_asof(lines, sample.product_versions())


def _bundle(sample: Sample) -> dict[str, DataFrame]:
    return order_ops.order_bundle(
        _priced_orders(sample),
        order_ops.price_lines(_unpriced(sample)),
        sample.payment_methods(),
        sample.payment_status(),
        sample.lifecycle_status(),
        sample.shipping_status(),
    )


@query
def order_headers(sample: Sample) -> DataFrame:
    return _bundle(sample)["orders"]


@query
def orders_rejected(sample: Sample) -> DataFrame:
    """Headers without a line."""
    return _bundle(sample)["rejected_orders"].select("order_id", "user_id", "line_count")


@query
def order_transactions(sample: Sample) -> DataFrame:
    return _bundle(sample)["transactions"]


@query
def order_history(sample: Sample) -> DataFrame:
    return _bundle(sample)["order_status_history"]


def _advanced(sample: Sample) -> dict[str, DataFrame]:
    return order_ops.advance_orders(
        sample.orders(),
        sample.lifecycle_status(),
        sample.payment_methods(),
        sample.payment_status(),
        sample.shipping_status(),
        sample.transactions(),
        F.lit(NOW),
    )


@query
def advance_orders(sample: Sample) -> DataFrame:
    # The sample has no staff, and no order that enters shipping: both columns are NULL.
    return _advanced(sample)["orders"].drop("staff_id", "shipped_at")


@query
def advance_history(sample: Sample) -> DataFrame:
    return _advanced(sample)["order_status_history"]


@query
def advance_transactions(sample: Sample) -> DataFrame:
    return _advanced(sample)["transactions"]


# --- keys, references, constraints ----------------------------------------------------


@query
def insert_if_absent(sample: Sample) -> DataFrame:
    """New tags: event types exist already; part names and event types come in."""
    events = sample.read("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("tag_name"))
    parts = sample.read("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("tag_name"))
    return quality.insert_if_absent(events.select("tag_name"), parts.unionByName(events), "tag_name", "id")


def _user_ids(sample: Sample) -> DataFrame:
    return sample.read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"))


@query
def users_without_role(sample: Sample) -> DataFrame:
    """A sign-up gives a user a role."""
    roles = sample.read("events").where("event_type = 'signup'")
    return quality.without_related(_user_ids(sample), roles, "user_id")


@query
def users_without_address(sample: Sample) -> DataFrame:
    """A purchase gives a user an address."""
    addresses = sample.read("events").where("event_type = 'purchase'")
    return quality.without_related(_user_ids(sample), addresses, "user_id")


@query
def products_without_tag(sample: Sample) -> DataFrame:
    """A line of 50 pieces tags a product as bulk ware."""
    tagged = sample.read("lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("product_id"))
    products = sample.read("part").select(F.col("p_partkey").alias("id"), "p_name")
    return quality.without_related(products, tagged, "product_id")


@query
def resolve_parent_key(sample: Sample) -> DataFrame:
    parts = sample.read("part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("parent_name"))
    parents = quality.root_categories(sample.categories())
    return quality.resolve_parent(parts, parents, "parent_name", "category_name", "category_id", "id")


def _made(sample: Sample) -> dict[str, DataFrame]:
    return {name: make() for name, make in sample.tables().items()}


@query
def dq_foreign_keys(sample: Sample) -> DataFrame:
    return quality.foreign_key_report(_made(sample), FOREIGN_KEYS)


@query
def dq_unique(sample: Sample) -> DataFrame:
    """Users also have the columns that are not captured, as their source table has."""
    users = _customers(sample).select("id", "username", "email", "mobile")
    return quality.unique_report(_made(sample) | {"users": users}, UNIQUE_COLUMNS)


@query
def dq_not_null(sample: Sample) -> DataFrame:
    """Required columns of all tables; columns that the sample has no values for are NULL."""
    tables = {name: state.align_schema(rows, TABLES[name]) for name, rows in _made(sample).items()}
    return quality.null_report(tables, REQUIRED_COLUMNS)


@query
def dq_domain(sample: Sample) -> DataFrame:
    """Events as transactions: purchases pay, errors refund; the other kinds are not allowed."""
    kind = F.when(F.col("event_type") == "purchase", "payment").when(F.col("event_type") == "error", "refund")
    rows = sample.read("events").select(F.coalesce(kind, "event_type").alias("transaction_type"))
    return quality.outside_domain(rows, "transaction_type", TRANSACTION_TYPES)


@query
def dq_orders_without_lines(sample: Sample) -> DataFrame:
    orders = sample.read("orders").select(F.col("o_orderkey").alias("id"))
    return quality.without_related(orders, sample.read("lineitem"), "l_orderkey")


@query
def latest_campaigns(sample: Sample) -> DataFrame:
    return quality.newest(sample.ads_campaigns(), 3)


@query
def users_with_addresses(sample: Sample) -> DataFrame:
    return quality.users_with_addresses(sample.users(), sample.addresses())


@query
def leaf_categories(sample: Sample) -> DataFrame:
    return quality.leaf_categories(sample.categories())


@query
def category_tree(sample: Sample) -> DataFrame:
    """Three levels: the type's first word, the type, and the type with the size."""
    types = sample.read("part").select("p_type").distinct()
    tops = types.select(F.substring_index("p_type", " ", 1).alias("category_name")).distinct()
    top_id = text_id(F.concat(F.lit("top "), F.substring_index("category_name", " ", 1)))
    below = sample.categories().withColumn("category_id", F.coalesce("category_id", top_id))
    tops = tops.select(top_id.alias("id"), "category_name", F.lit(None).cast("bigint").alias("category_id"))
    return quality.category_tree(tops.unionByName(below.select(*tops.columns)))


@query
def category_slug(sample: Sample) -> DataFrame:
    return sample.categories().select("id", "category_name", slug(F.col("category_name")).alias("slug"))
