"""The registered queries as SQL over the same tables.

Money is kept in whole cents here, so nothing but integers is ever divided. ``//`` is
integer division; signs are split off before it.
"""

from __future__ import annotations

from cdcmart.sources.specs import REQUIRED_COLUMNS, TABLES

# Line and order level building blocks.
LINES = """
raw_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_linenumber AS BIGINT) AS n,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c,
         CAST(round(l_tax * 100) AS BIGINT) AS t, CAST(round(l_discount * 100) AS BIGINT) AS d, l_shipdate
  FROM lineitem
),
ln AS (
  SELECT *, (price_c + tax_c) * quantity AS sub_c, quantity * price_c AS gmv_c,
         CASE WHEN n <> 7 THEN (price_c * 60 + 50) // 100 END AS cost_c,
         (n * 68719476736 + product_id) * 16777216 + price_c AS id
  FROM (SELECT *, (price_c * t + 50) // 100 AS tax_c FROM raw_lines)
),
sums AS (
  SELECT order_id, CAST(sum(sub_c) AS BIGINT) AS a_c, CAST((sum(sub_c * d) + 50) // 100 AS BIGINT) AS d_c
  FROM ln GROUP BY order_id
),
od AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus, o_orderdate,
         CAST(coalesce(a_c, 0) AS BIGINT) AS a_c, CAST(coalesce(d_c, 0) AS BIGINT) AS d_c,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS prio, o_orderkey % 3 + 1 AS ship,
         CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 3 WHEN 'P' THEN 1 END AS status_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipping' WHEN 'P' THEN 'pending' END AS status
  FROM orders LEFT JOIN sums ON order_id = o_orderkey
),
so AS (
  SELECT od.*, CAST(c_nationkey AS BIGINT) AS city_id, CASE WHEN prio < 5 THEN prio ELSE 0 END AS campaign_key,
         CASE prio WHEN 1 THEN 'COD' WHEN 2 THEN 'Credit Card' WHEN 3 THEN 'Momo' WHEN 4 THEN 'ZaloPay'
                   WHEN 5 THEN 'Bank Transfer' END AS payment_method,
         CASE ship WHEN 1 THEN 'Standard' WHEN 2 THEN 'Express' WHEN 3 THEN 'Same Day' END AS shipping_method,
         CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS day
  FROM od JOIN customer ON c_custkey = user_id
),
base AS (
  SELECT so.order_id, o_orderdate, day, city_id, campaign_key, a_c, d_c, ln.id AS order_item_id, product_id,
         quantity, gmv_c, sub_c, cost_c
  FROM so JOIN ln ON ln.order_id = so.order_id WHERE status = 'delivered'
),
pre AS (
  SELECT *, CAST(sum(p_c) OVER (PARTITION BY order_id) AS BIGINT) AS total_c,
         row_number() OVER (PARTITION BY order_id ORDER BY order_item_id DESC) AS rn
  FROM (SELECT *, CASE WHEN a_c > 0 THEN CAST((2 * CAST(d_c AS HUGEINT) * sub_c + a_c) // (2 * a_c) AS BIGINT)
                       ELSE 0 END AS p_c FROM base)
),
alloc AS (SELECT *, CASE WHEN rn = 1 THEN p_c + d_c - total_c ELSE p_c END AS g_c FROM pre),
meas AS (
  SELECT *, CASE WHEN sub_c > 0
                 THEN sign(g_c) * CAST((2 * CAST(abs(g_c) AS HUGEINT) * gmv_c + sub_c) // (2 * sub_c) AS BIGINT)
                 ELSE 0 END AS x_c
  FROM alloc
),
fact AS (
  SELECT day, city_id, product_id, campaign_key, CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(sum(gmv_c) AS BIGINT) AS gmv_c,
         CASE WHEN count(*) = count(cost_c) THEN CAST(sum(quantity * cost_c) AS BIGINT) END AS cost_c,
         count(*) - count(cost_c) AS unknown, CAST(sum(g_c) AS BIGINT) AS g_c, CAST(sum(x_c) AS BIGINT) AS x_c,
         count(DISTINCT order_id) AS n
  FROM meas GROUP BY ALL
)"""

PRODUCTS = """
cat AS (SELECT DISTINCT p_type, p_size, p_type || ' & Co, size ' || p_size AS sub_name FROM part),
sp AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS brand_id, p_brand AS brand_name,
         CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category_id, p_type AS category_name,
         CAST('0x' || substr(md5(sub_name), 1, 15) AS BIGINT) AS subcategory_id, sub_name AS subcategory_name,
         ((CAST(round(p_retailprice * 100) AS BIGINT) * 60 + 50) // 100) / 100.0::DOUBLE AS unit_cost,
         CAST(round(p_retailprice * 100) AS BIGINT) / 100.0::DOUBLE AS current_price, CAST(0 AS BIGINT) AS updated_at
  FROM part JOIN cat USING (p_type, p_size)
)"""

# Dates before 2000 are outside the calendar and have no month or year.
LOCATIONS = """
cal AS (
  SELECT CAST(x AS DATE) AS d, month(x) AS month, quarter(x) AS quarter, year(x) AS year
  FROM generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2099-12-31', INTERVAL 1 DAY) t(x)
),
loc AS (
  SELECT CAST(n_nationkey AS BIGINT) AS province_id, n_name AS province_name,
         CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name, CAST(0 AS BIGINT) AS updated_at
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

USERS = """
su AS (
  SELECT c_custkey AS user_id, c_name AS username, coalesce(first_order, TIMESTAMP '1970-01-01') AS created
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1)
    ON o_custkey = c_custkey
)"""

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, 'shop.public.' || event_type AS topic, event_id % 14 AS k,
         CAST(round(value * 100) AS BIGINT) AS cents, epoch_us(ts) // 1000000 AS second
  FROM events
)"""

CATEGORIES = """
cats AS (
  SELECT DISTINCT CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS id, p_type AS category_name,
         CAST(NULL AS BIGINT) AS category_id FROM part
  UNION ALL
  SELECT CAST('0x' || substr(md5(name), 1, 15) AS BIGINT), name, CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT)
  FROM (SELECT DISTINCT p_type, p_type || ' & Co, size ' || p_size AS name FROM part)
),
cs AS (
  SELECT *, replace(replace(replace(lower(category_name), ' ', '-'), '&', 'and'), ',', '') AS slug FROM cats
)"""

PRICED = """
pl AS (
  SELECT *, (price_c + vat_c) * quantity AS s_c FROM (SELECT *, (price_c * 10 + 50) // 100 AS vat_c FROM ln)
),
po AS (
  SELECT od.order_id, user_id, prio, CASE WHEN prio < 5 THEN prio END AS discount_id,
         CAST(coalesce(s.order_c, 0) AS BIGINT) AS order_c, coalesce(s.line_count, 0) AS line_count
  FROM od LEFT JOIN (SELECT order_id, CAST(sum(s_c) AS BIGINT) AS order_c, count(*) AS line_count FROM pl GROUP BY 1) s
    ON s.order_id = od.order_id
),
pd AS (
  SELECT *, CASE WHEN discount_id IS NULL THEN 0
                 WHEN discount_id % 2 = 1 THEN (order_c * discount_id * 5 + 50) // 100
                 ELSE least(discount_id * 50000000, order_c) END AS dis_c
  FROM po
)"""


def _with(*blocks: str, select: str) -> str:
    return "WITH " + ",".join(blocks) + "\n" + select


def _money(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) / 100.0 AS {name}"


# Order and line columns shared by the sale line queries.
BASE_OUT = f"""order_id, epoch_us(o_orderdate) // 1000000 AS created_at, CAST(day AS VARCHAR) AS date_key, city_id,
  campaign_key, {_money("a_c", "order_amount")}, {_money("d_c", "discount_amount")}, order_item_id, product_id,
  quantity, {_money("gmv_c", "gmv")}, {_money("sub_c", "subtotal_amount")}, {_money("cost_c", "unit_cost_at_order")}"""
PRE_OUT = f"""{BASE_OUT}, {_money("p_c", "preliminary_discount")}, rn AS reverse_line_number,
  {_money("total_c", "preliminary_total")}"""
ALLOC_OUT = f"{PRE_OUT}, {_money('g_c', 'discount_gross')}"

# Truncation toward zero of cents / count, to 8 or 4 digits.
AOV = "CAST(sign({0}) * ((CAST(abs({0}) AS HUGEINT) * 1000000) // {1}) AS DOUBLE) / 100000000.0"
AVG = "CAST(sign({0}) * ((CAST(abs({0}) AS HUGEINT) * 100) // {1}) AS DOUBLE) / 10000.0"

SALES_REPORT = f"""SELECT CAST(f.day AS VARCHAR) AS date, month, year,
  f.city_id AS province_id, province_name AS province, f.product_id, product_name AS product, category_name AS category,
  {_money("sum(f.gmv_c)", "total_gmv")}, {_money("sum(f.gmv_c - f.x_c)", "total_net_revenue")},
  CAST(sum(f.quantity) AS BIGINT) AS total_quantity_sold, CAST(sum(f.n) AS BIGINT) AS product_order_count
  FROM fact f LEFT JOIN cal ON d = f.day LEFT JOIN loc ON f.city_id = province_id LEFT JOIN sp ON f.product_id = sp.product_id {{where}}
  GROUP BY ALL"""

CHANGES = """
latest AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev
),
state AS (
  SELECT user_id AS id, event_type, CAST(cents AS DOUBLE) / 100.0 AS value, second AS created_at,
         event_id AS _version, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS _deleted
  FROM latest WHERE rn = 1
)"""

OVERVIEW = f"""SELECT CAST(day AS VARCHAR) AS date_key, city_id, CAST(status_id AS BIGINT) AS order_status_id,
  payment_method, shipping_method, count(*) AS order_count, {_money("sum(a_c - d_c)", "total_gmv")}
  FROM so GROUP BY ALL"""

# Open orders of the lifecycle step and what becomes of them.
STEP = """
step AS (
  SELECT *, CASE WHEN status = 'pending' THEN 2 ELSE 4 END AS next_id,
         CASE WHEN status = 'pending' THEN 'confirmed' ELSE 'delivered' END AS next,
         CASE WHEN status = 'pending' THEN 1 ELSE 4 END AS shipping_id, status = 'shipping' AND prio = 1 AS cash
  FROM so WHERE status IN ('pending', 'shipping')  )"""
NOW_SECONDS = "CAST(1706659200 AS BIGINT)"

# The log's texts, written once more, and what DuckDB's own JSON functions read in them.
PAYLOADS = """
texts AS (
  SELECT *, '"id":' || event_id || ',"order_id":' || user_id || ',"product_id":7,"quantity":' || (event_id % 5 + 1)
      || ',"created_at":' || millis AS body,
    ',"product_price":"' || price || '","unit_cost_at_order":"' || price || '"' AS money,
    ',"__op":"' || CASE WHEN event_type = 'error' THEN 'd' ELSE 'c' END
      || '","__table":"orderdetails","__source_ts_ms":' || millis AS envelope
  FROM (SELECT *, epoch_us(ts) // 1000 AS millis,
          (cents - cents % 100) // 100 || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS price FROM ev)
),
payloads AS (
  SELECT *, CASE k
    WHEN 1 THEN '{bad ' || event_id
    WHEN 2 THEN '{' || body || '}'
    WHEN 3 THEN '{' || body || ',"__op":"x","__table":"orderdetails","__source_ts_ms":1}'
    WHEN 4 THEN '{' || body || ',"__op":null}'
    WHEN 5 THEN '{' || body || ',"__op":"u"}'
    WHEN 6 THEN '{' || body || ',"__op":"u","__table":"orderdetails"}'
    WHEN 7 THEN '{' || body || money || envelope || '} tail'
    WHEN 8 THEN CAST(event_id AS VARCHAR)
    WHEN 9 THEN '{' || body || ',"product_price":"abc","unit_cost_at_order":"abc"' || envelope || '}'
    WHEN 10 THEN '{' || body || ',"product_price":null,"unit_cost_at_order":null' || envelope || '}'
    WHEN 11 THEN '{"id":"n/a",' || '"quantity":1' || money || envelope || '}'
    ELSE '{' || body || money || envelope || '}' END AS payload
  FROM texts
),
read AS (
  SELECT *, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN CAST(payload AS JSON) END AS doc FROM payloads
),
fields AS (
  SELECT *, doc ->> '$.id' AS id_text, doc ->> '$.product_price' AS price_text, doc ->> '$.unit_cost_at_order' AS cost_text,
    try_cast(doc ->> '$.created_at' AS BIGINT) // 1000 AS created, doc ->> '$.__op' AS op,
    CASE WHEN NOT json_valid(payload) THEN 'invalid_json' WHEN doc IS NULL OR NOT json_exists(doc, '$.__op') THEN 'missing_op'
      WHEN coalesce(doc ->> '$.__op', '') NOT IN ('c', 'u', 'd', 'r') THEN 'invalid_op'
      WHEN NOT json_exists(doc, '$.__table') THEN 'missing_table'
      WHEN NOT json_exists(doc, '$.__source_ts_ms') THEN 'missing_source_ts' END AS reason
  FROM read
)"""


def _reference(name: str, target: str, rows: str, value: str, ids: str) -> str:
    return f"""SELECT '{name}' AS reference, '{target}' AS target, count(*) AS row_count,
      count(*) - count(v) AS null_count, count(*) FILTER (v IS NOT NULL AND v NOT IN ({ids})) AS orphan_count
      FROM (SELECT {value} AS v FROM {rows})"""


_CATEGORY_IDS = "SELECT id FROM cs"
_PRIORITIES = "SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) FROM orders"
_CAMPAIGNS = f"SELECT * FROM ({_PRIORITIES}) t(p) WHERE p < 5"
_CAMPAIGN_ROWS = f"(SELECT DISTINCT p FROM ({_PRIORITIES}) t(p) WHERE p < 5)"
_REFERENCES = [
    _reference("provinces.region_id", "regions", "nation", "n_regionkey", "SELECT r_regionkey FROM region"),
    _reference("addresses.user_id", "users", "customer", "c_custkey", "SELECT c_custkey FROM customer"),
    _reference("addresses.province_id", "provinces", "customer", "c_nationkey", "SELECT n_nationkey FROM nation"),
    _reference("addresses.region_id", "regions", "customer JOIN nation ON n_nationkey = c_nationkey", "n_regionkey",
               "SELECT r_regionkey FROM region"),
    _reference("categories.category_id", "categories", "cs", "category_id", _CATEGORY_IDS),
    _reference("products.category_id", "categories", "sp", "subcategory_id", _CATEGORY_IDS),
    _reference("products.brand_id", "brands", "sp", "brand_id", "SELECT brand_id FROM sp"),
    _reference("discounts.adscampaign_id", "ads_campaigns", _CAMPAIGN_ROWS, "p", _CAMPAIGNS),
    _reference("orders.user_id", "users", "od", "user_id", "SELECT c_custkey FROM customer"),
    _reference("orders.staff_id", "users", "od", "CAST(NULL AS BIGINT)", "SELECT c_custkey FROM customer"),
    _reference("orders.address_id", "addresses", "od", "user_id", "SELECT c_custkey FROM customer"),
    _reference("orders.discount_id", "discounts", "od", "CASE WHEN prio < 5 THEN prio END", _CAMPAIGNS),
    _reference("orders.payment_method_id", "payment_methods", "od", "prio", _PRIORITIES),
    _reference("orders.payment_status_id", "payment_status", "od", "1", "SELECT unnest([1, 2, 3, 4])"),
    _reference("orders.order_status_id", "order_status", "od", "status_id", "SELECT status_id FROM od"),
    _reference("orders.shipping_method_id", "shipping_methods", "od", "ship", "SELECT ship FROM od"),
    _reference("orders.shipping_status_id", "shipping_status", "od", "1", "SELECT unnest([1, 2, 3, 4, 5])"),
    _reference("orderdetails.order_id", "orders", "ln", "order_id", "SELECT o_orderkey FROM orders"),
    _reference("orderdetails.product_id", "products", "ln", "product_id", "SELECT p_partkey FROM part"),
    _reference("transactions.order_id", "orders", "orders", "o_orderkey", "SELECT o_orderkey FROM orders"),
    _reference("role_user.user_id", "users", "customer", "c_custkey", "SELECT c_custkey FROM customer"),
    _reference("role_user.role_id", "roles", "customer", "c_mktsegment", "SELECT c_mktsegment FROM customer"),
    _reference("product_tag.product_id", "products", "part", "p_partkey", "SELECT p_partkey FROM part"),
    _reference("product_tag.tag_id", "tags", "part", "p_size", "SELECT p_size FROM part"),
    _reference("order_status_history.order_id", "orders", "orders", "o_orderkey", "SELECT o_orderkey FROM orders"),
    _reference("order_status_history.order_status_id", "order_status", "orders", "1", "SELECT status_id FROM od"),
    _reference("order_status_history.staff_id", "users", "orders", "CAST(NULL AS BIGINT)", "SELECT c_custkey FROM customer"),
]


def _unique(name: str, rows: str, value: str) -> str:
    return f"""SELECT '{name}' AS column_name, count(*) AS value_count,
      count(*) FILTER (n > 1) AS repeated_value_count, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess_row_count
      FROM (SELECT {value} AS v, count(*) AS n FROM {rows} WHERE {value} IS NOT NULL GROUP BY 1)"""


_UNIQUE = [
    _unique("users.username", "customer", "c_name"),
    _unique("users.email", "customer", "c_name || '@example.com'"),
    _unique("users.mobile", "customer", "CAST(c_custkey AS VARCHAR)"),
    _unique("roles.role_name", "(SELECT DISTINCT c_mktsegment FROM customer)", "c_mktsegment"),
    _unique("tags.tag_name", "(SELECT DISTINCT p_size FROM part)", "p_size"),
    _unique("provinces.province_name", "nation", "n_name"),
    _unique("categories.slug", "cs", "slug"),
    _unique("brands.brand_name", "(SELECT DISTINCT p_brand FROM part)", "p_brand"),
    _unique("order_status.order_status_name", "(SELECT DISTINCT o_orderstatus FROM orders)", "o_orderstatus"),
    _unique("payment_status.payment_status_name", "(SELECT unnest(['a', 'b', 'c', 'd']) AS x)", "x"),
    _unique("shipping_status.shipping_status_name", "(SELECT unnest(['a', 'b', 'c', 'd', 'e']) AS x)", "x"),
    _unique("payment_methods.payment_method_name", "(SELECT DISTINCT o_orderpriority FROM orders)", "o_orderpriority"),
    _unique("shipping_methods.shipping_method_name", "(SELECT DISTINCT o_orderkey % 3 AS x FROM orders)", "x"),
]

def _id(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _seconds(time: str) -> str:
    return f"epoch_us({time}) // 1000000"


def _cents(amount: str) -> str:
    return f"CAST({amount} AS DOUBLE) / 100.0"


_SUB_NAME = "p_type || ' & Co, size ' || p_size"
_PRICE = "CAST(round(p_retailprice * 100) AS BIGINT)"
_BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT)"


def _listed(*names: str) -> str:
    return f"(SELECT * FROM (VALUES {', '.join(f'({n}, {name!r})' for n, name in enumerate(names, 1))}) t(id, name))"


# Table -> (its rows in the sample, column -> value); columns that are not here have none.
_SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "users": ("customer", {"id": "c_custkey", "username": "c_name", "created_at": "0"}),
    "roles": ("(SELECT DISTINCT c_mktsegment AS s FROM customer)", {"id": _id("s"), "role_name": "s", "role_title": "lower(s)"}),
    "role_user": ("customer", {"id": "c_custkey", "user_id": "c_custkey", "role_id": _id("c_mktsegment")}),
    "regions": ("region", {"id": "r_regionkey", "region_name": "r_name"}),
    "provinces": ("nation", {"id": "n_nationkey", "province_name": "n_name || ' '", "region_id": "n_regionkey", "created_at": "0"}),
    "addresses": ("customer JOIN nation ON n_nationkey = c_nationkey",
                  {"id": "c_custkey", "user_id": "c_custkey", "province_id": "c_nationkey", "region_id": "n_regionkey"}),
    "categories": ("cs", {"id": "id", "category_name": "category_name", "category_id": "category_id", "slug": "slug"}),
    "brands": ("(SELECT DISTINCT p_brand FROM part)", {"id": _BRAND, "brand_name": "p_brand"}),
    "tags": ("(SELECT DISTINCT p_size FROM part)", {"id": "p_size", "tag_name": "'size ' || p_size"}),
    "products": ("part", {"id": "p_partkey", "product_name": "p_name", "category_id": _id(_SUB_NAME), "brand_id": _BRAND,
                          "product_price": _cents(_PRICE), "unit_cost": _cents(f"({_PRICE} * 60 + 50) // 100"), "created_at": "0"}),
    "product_tag": ("part", {"id": "p_partkey", "product_id": "p_partkey", "tag_id": "p_size"}),
    "order_status": ("(SELECT status_id, status, min(o_orderdate) AS o FROM od GROUP BY ALL)",
                     {"id": "status_id", "order_status_name": "status || ' '", "created_at": _seconds("o")}),
    "payment_status": (_listed("pending", "completed", "failed", "refunded"), {"id": "id", "payment_status_name": "name"}),
    "shipping_status": (_listed("pending", "picked_up", "in_transit", "delivered", "returned"), {"id": "id", "shipping_status_name": "name"}),
    "payment_methods": ("(SELECT DISTINCT prio, payment_method FROM so)", {"id": "prio", "payment_method_name": "payment_method"}),
    "shipping_methods": ("(SELECT DISTINCT ship, shipping_method FROM so)", {"id": "ship", "shipping_method_name": "shipping_method"}),
    "ads_campaigns": (_CAMPAIGN_ROWS, {"id": "p", "campaign_title": "'Campaign ' || p"}),
    "discounts": (_CAMPAIGN_ROWS, {"id": "p", "adscampaign_id": "p", "type": "CASE p % 2 WHEN 1 THEN 'percent' ELSE 'amount' END",
                                   "value": _cents("CASE p % 2 WHEN 1 THEN p * 500 ELSE p * 50000000 END")}),
    "orders": ("od", {"id": "order_id", "user_id": "user_id", "address_id": "user_id", "order_amount": _cents("a_c"),
                      "discount_amount": _cents("d_c"), "total_amount": _cents("a_c - d_c"), "discount_id": "CASE WHEN prio < 5 THEN prio END",
                      "payment_method_id": "prio", "payment_status_id": "1", "order_status_id": "status_id",
                      "shipping_method_id": "ship", "shipping_status_id": "1", "created_at": _seconds("o_orderdate"),
                      "updated_at": _seconds("o_orderdate")}),
    "orderdetails": ("ln", {"id": "id", "order_id": "order_id", "product_id": "product_id", "quantity": "quantity", "product_price": "price_c",
                            "product_tax": "tax_c", "subtotal_amount": "sub_c", "created_at": "l_shipdate"}),
    "order_status_history": ("orders", {"id": "o_orderkey", "order_id": "o_orderkey", "order_status_id": "1",
                                        "comments": "'Order #' || o_orderkey || ' created'", "created_at": _seconds("o_orderdate")}),
    "transactions": ("od", {"id": "order_id", "order_id": "order_id", "transaction_type": "'payment'",
                            "status": "CASE prio WHEN 1 THEN 0 ELSE 1 END", "created_at": _seconds("o_orderdate"),
                            "description": "'Payment for order #' || order_id"}),
}

# Kind -> what a missing value becomes, and the type of the result.
_MISSING = {
    "id": ("0", "BIGINT"), "id?": ("NULL", "BIGINT"), "int": ("0", "BIGINT"), "str": ("''", "VARCHAR"), "str?": ("NULL", "VARCHAR"),
    "money": ("0", "DOUBLE"), "money?": ("NULL", "DOUBLE"), "float?": ("NULL", "DOUBLE"), "time": ("0", "BIGINT"),
    "time?": ("NULL", "BIGINT"), "flag+": ("1", "BIGINT"),
}


def _typed(name: str) -> str:
    rows, values = _SOURCES[name]
    columns = [
        f"CAST(coalesce({values.get(column, 'NULL')}, {_MISSING[kind][0]}) AS {_MISSING[kind][1]}) AS {column}"
        for column, kind in TABLES[name].fields
    ]
    listed = ", ".join(columns)
    return _with(LINES, CATEGORIES, select=f"""SELECT {listed}, CAST({values['id']} AS BIGINT) AS _version,
      CAST(0 AS BIGINT) AS _deleted FROM {rows}""")


ORACLE: dict[str, str] = {
    # sources
    "raw_event_counts": _with(EVENTS, select=f"""SELECT topic, CAST(0 AS BIGINT) AS kafka_partition,
      count(*) AS event_count, min(event_id) AS first_offset, max(event_id) AS last_offset,
      {NOW_SECONDS} AS ingested_at FROM ev GROUP BY topic"""),
    "snapshot_union": """WITH l AS (
        SELECT user_id, arg_max(event_type, event_id) AS kind, max(event_id) AS e
        FROM events WHERE event_type <> 'view' AND event_id % 10 <> 4 GROUP BY 1)
      SELECT c_custkey AS id, CASE WHEN e IS NULL THEN c_name ELSE 'name ' || e END AS username,
        CASE WHEN e IS NULL THEN c_custkey ELSE e END AS created_at,
        CASE WHEN e IS NULL THEN c_custkey ELSE e + 1099511627776 END AS _version, CAST(0 AS BIGINT) AS _deleted
      FROM customer LEFT JOIN l ON user_id = c_custkey WHERE kind IS NULL OR kind <> 'error'
      UNION ALL SELECT user_id, 'name ' || e, e, e + 1099511627776, 0 FROM l
      WHERE kind <> 'error' AND user_id NOT IN (SELECT c_custkey FROM customer)""",
    "unwrap_envelope": """SELECT event_id + 1099511627776 AS "offset", IF(whole, CAST(user_id AS VARCHAR), NULL) AS id,
        IF(whole, 'name ' || event_id, NULL) AS username, CAST(0 AS BIGINT) AS password,
        IF(whole, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END, NULL) AS op, IF(whole, 'users', NULL) AS "table",
        IF(whole, CAST(epoch_us(ts) // 1000 AS VARCHAR), NULL) AS source_ts_ms,
        IF(whole, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END, NULL) AS deleted
      FROM (SELECT *, event_id % 10 <> 4 AS whole FROM events) WHERE event_type <> 'view'""",
    "pii_excluded": """SELECT c_custkey AS "offset", 'id,username,created_at,__op,__table,__source_ts_ms' AS payload_keys,
      c_name AS username FROM customer UNION ALL SELECT -c_custkey, 'id,username,created_at,__op', c_name FROM customer""",
    "retention_kept": _with(EVENTS, select="""
      SELECT topic, count(*) AS event_count, CAST(7 AS BIGINT) AS days FROM ev
      WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY 1
      UNION ALL SELECT topic, count(*), 30 FROM ev WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY 1"""),
    "raw_log_retained": _with(EVENTS, select="""
      SELECT topic, CAST(0 AS BIGINT) AS kafka_partition, event_id AS kafka_offset, second AS ingested_at
      FROM ev WHERE ts >= TIMESTAMP '2024-01-24'"""),
    "raw_log_replayed": _with(EVENTS, PAYLOADS, select="""
      SELECT ev.topic, CAST(0 AS BIGINT) AS kafka_partition, ev.event_id AS kafka_offset, ev.second AS ingested_at, length(payload) AS n_chars
      FROM ev JOIN fields USING (event_id) WHERE event_id >= (SELECT max(event_id) // 2 FROM ev)"""),
    # typed change tables
    "typed_bronze": _with(EVENTS, PAYLOADS, select="""SELECT CAST(id_text AS BIGINT) AS id,
        CAST(coalesce(doc ->> '$.order_id', '0') AS BIGINT) AS order_id, CAST(doc ->> '$.product_id' AS BIGINT) AS product_id,
        CAST(doc ->> '$.quantity' AS BIGINT) AS quantity,
        CAST(coalesce(try_cast(price_text AS DECIMAL(15, 2)), 0) AS DOUBLE) AS product_price, 0.0::DOUBLE AS product_tax,
        0.0::DOUBLE AS subtotal_amount, CAST(try_cast(cost_text AS DECIMAL(15, 2)) AS DOUBLE) AS unit_cost_at_order,
        created AS created_at, event_id AS _version, CAST(coalesce(op, '') = 'd' AS BIGINT) AS _deleted
      FROM fields WHERE doc IS NOT NULL AND try_cast(id_text AS BIGINT) IS NOT NULL"""),
    "coerce_numeric": _with(EVENTS, PAYLOADS, select="""SELECT event_id AS "offset",
        CAST(coalesce(try_cast(price_text AS DECIMAL(15, 2)), 0) AS DOUBLE) AS money_or_zero,
        CAST(try_cast(price_text AS DECIMAL(15, 2)) AS DOUBLE) AS money_or_null,
        try_cast(price_text AS DOUBLE) AS float_or_null FROM fields"""),
    "coerce_millis": _with(EVENTS, PAYLOADS, select="""SELECT event_id AS "offset",
        coalesce(created, 0) AS time_or_epoch, created AS time_or_null FROM fields"""),
    "json_valid": _with(EVENTS, PAYLOADS, select="""SELECT event_id AS "offset",
        CAST(json_valid(payload) AS BIGINT) AS valid FROM fields"""),
    # current state and quarantine
    "current_state": _with(EVENTS, CHANGES, select="SELECT * FROM state WHERE _deleted = 0"),
    "current_state_audit": _with(EVENTS, CHANGES, select="SELECT * FROM state"),
    "compacted_changes": _with(EVENTS, CHANGES, select="SELECT * FROM state"),
    "replay_idempotent": _with(LINES, select=OVERVIEW),
    "schema_evolution": _with(LINES, select="""SELECT product_id, count(*) AS line_count,
        count(cost_c) FILTER (l_shipdate >= TIMESTAMP '1998-01-01') AS known_cost_count,
        CAST(sum(cost_c) FILTER (l_shipdate >= TIMESTAMP '1998-01-01') AS DOUBLE) / 100.0 AS known_cost
      FROM ln GROUP BY 1"""),
    "quarantine_reasons": _with(EVENTS, PAYLOADS, select=f"""SELECT topic, CAST(0 AS BIGINT) AS kafka_partition,
        event_id AS kafka_offset, reason, {NOW_SECONDS} AS detected_at FROM fields WHERE reason IS NOT NULL"""),
    "quarantine_summary": _with(EVENTS, PAYLOADS, select="""SELECT topic, reason, count(*) AS event_count
      FROM fields WHERE reason IS NOT NULL GROUP BY ALL"""),
    # cleaned entities
    "silver_users": _with(USERS, select="""SELECT user_id, username,
        CAST(CAST(created + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS registration_date,
        epoch_us(created) // 1000000 AS created_at, epoch_us(created) // 1000000 AS updated_at FROM su"""),
    "silver_locations": _with(LOCATIONS, select="SELECT * FROM loc"),
    "silver_campaigns": f"SELECT p AS campaign_id, 'Campaign ' || p AS campaign_title FROM {_CAMPAIGN_ROWS}",
    "silver_order_status": _with(LINES, select="""SELECT CAST(status_id AS BIGINT) AS id, status AS name,
        epoch_us(min(o_orderdate)) // 1000000 AS updated_at FROM od GROUP BY ALL"""),
    "silver_orders": _with(LINES, select=f"""SELECT order_id, user_id, city_id, campaign_key,
        CAST(status_id AS BIGINT) AS order_status_id, payment_method, shipping_method,
        {_money("a_c - d_c", "total_amount")}, {_money("a_c", "order_amount")}, {_money("d_c", "discount_amount")},
        epoch_us(o_orderdate) // 1000000 AS created_at, epoch_us(o_orderdate) // 1000000 AS updated_at FROM so"""),
    "silver_products": _with(PRODUCTS, select="SELECT * FROM sp"),
    "silver_order_items": _with(LINES, select=f"""SELECT id AS order_item_id, order_id, product_id, quantity,
        {_money("price_c", "current_price")}, {_money("tax_c", "product_tax")}, {_money("sub_c", "subtotal_amount")},
        {_money("cost_c", "unit_cost_at_order")}, {_money("gmv_c", "gmv")},
        epoch_us(l_shipdate) // 1000000 AS updated_at FROM ln"""),
    # dimensions and facts
    "dim_date": """SELECT CAST(d AS VARCHAR) AS date_key, day(d) AS day, month(d) AS month, quarter(d) AS quarter,
        year(d) AS year, isodow(d) AS day_of_week, CAST(CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT)
          AS is_weekend, coalesce(n, 0) AS order_count
      FROM (SELECT CAST(x AS DATE) AS d FROM generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2099-12-31',
        INTERVAL 1 DAY) t(x))
      LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = d""",
    "dim_products": _with(PRODUCTS, select="""SELECT product_id, product_name, brand_name, category_name,
        subcategory_name, unit_cost, current_price, updated_at FROM sp"""),
    "dim_locations": _with(LOCATIONS, select="SELECT * FROM loc"),
    "dim_campaigns": f"SELECT p AS campaign_id, 'Campaign ' || p AS campaign_title FROM {_CAMPAIGN_ROWS}",
    "dim_order_status": _with(LINES, select="""SELECT CAST(status_id AS BIGINT) AS id, status AS name,
        epoch_us(min(o_orderdate)) // 1000000 AS updated_at FROM od GROUP BY ALL"""),
    "fact_user_registration": _with(USERS, select="""SELECT
        CAST(CAST(created + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS registration_date, count(*) AS user_amount
      FROM su GROUP BY 1"""),
    "fact_order_overview": _with(LINES, select=OVERVIEW),
    "sales_line_base": _with(LINES, select=f"SELECT {BASE_OUT} FROM base"),
    "exact_ratio_round": _with(LINES, select="""SELECT order_id, id, CAST(sign(price_c - 5000000)
        * ((2 * CAST(abs(price_c - 5000000) AS HUGEINT) * price_c + sub_c) // (2 * sub_c)) AS DOUBLE) / 100.0 AS share
      FROM ln"""),
    "sales_line_preliminary": _with(LINES, select=f"SELECT {PRE_OUT} FROM pre"),
    "sales_line_allocated": _with(LINES, select=f"SELECT {ALLOC_OUT} FROM alloc"),
    "sales_line_measured": _with(LINES, select=f"SELECT {ALLOC_OUT}, {_money('x_c', 'discount_ex_vat')} FROM meas"),
    "fact_sales_product": _with(LINES, select=f"""SELECT CAST(day AS VARCHAR) AS date_key, city_id, product_id,
        campaign_key, quantity, {_money("gmv_c", "gmv")}, {_money("cost_c", "total_cost")},
        unknown AS unknown_cost_line_count, {_money("g_c", "discount_gross")}, {_money("x_c", "discount_val")},
        {_money("gmv_c - x_c", "net_revenue")}, n AS order_count FROM fact"""),
    "discount_conservation": _with(LINES, select="""SELECT count(*) AS order_count,
        count(*) FILTER (g <> d) AS violation_count, CAST(sum(g) AS DOUBLE) / 100.0 AS discount_total
      FROM (SELECT order_id, sum(g_c) AS g, max(d_c) AS d FROM alloc GROUP BY 1)"""),
    "distinct_orders": _with(LINES, PRODUCTS, select="""
      SELECT 'category' AS scope, category_name AS name, count(DISTINCT order_id) AS order_count
      FROM base LEFT JOIN sp USING (product_id) GROUP BY ALL
      UNION ALL SELECT 'month', strftime(day, '%Y-%m'), count(DISTINCT order_id) FROM base GROUP BY ALL"""),
    "chunked_snapshot": """WITH last AS (
        SELECT user_id AS id, max(event_id) AS v, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1
      )
      SELECT id, 'name ' || v AS username FROM last WHERE kind <> 'error'
      UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT id FROM last)""",
    # reports
    "report_marketing_dashboard": _with(LINES, PRODUCTS, LOCATIONS, select=f"""
      SELECT CAST(day AS VARCHAR) AS date, month, quarter, year,
        city_id AS province_id, province_name AS province, region_name AS region, fact.product_id,
        category_name AS parent_category, subcategory_name AS subcategory, product_name, campaign_key AS campaign_id,
        CASE WHEN campaign_key > 0 THEN 'Campaign ' || campaign_key END AS campaign_title,
        {_money("sum(gmv_c)", "total_gmv")}, {_money("sum(gmv_c - x_c)", "total_net_revenue")},
        CAST(sum(quantity) AS BIGINT) AS quantity_sold, CAST(sum(n) AS BIGINT) AS product_order_count,
        {AOV.format("sum(gmv_c - x_c)", "sum(n)")} AS product_aov_ex_vat,
        {AVG.format("sum(gmv_c)", "sum(quantity)")} AS avg_product_price
      FROM fact LEFT JOIN cal ON d = day LEFT JOIN loc ON city_id = province_id LEFT JOIN sp ON fact.product_id = sp.product_id GROUP BY ALL"""),
    "report_overview_sales": _with(LINES, PRODUCTS, LOCATIONS, select=SALES_REPORT.format(where="")),
    "report_overview_sales_days": _with(LINES, PRODUCTS, LOCATIONS, select=SALES_REPORT.format(
        where="WHERE f.day BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'")),
    "report_overview_orders": _with(LINES, LOCATIONS, select=f"""SELECT CAST(day AS VARCHAR) AS date,
        month, city_id AS province_id, province_name AS province,
        CAST(status_id AS BIGINT) AS order_status_id, status AS order_status, payment_method, shipping_method,
        count(*) AS order_count, {_money("sum(a_c - d_c)", "order_revenue")}
      FROM so LEFT JOIN cal ON d = day LEFT JOIN loc ON city_id = province_id GROUP BY ALL"""),
    "report_overview_users": _with(USERS, select="""SELECT CAST(d AS VARCHAR) AS registration_date, month(d) AS month,
        count(*) AS new_user_count FROM (SELECT CAST(created + INTERVAL 7 HOUR AS DATE) AS d FROM su) GROUP BY d"""),
    "report_delivered_order_aov": _with(LINES, select=f"""SELECT CAST(day AS VARCHAR) AS date, city_id,
        count(DISTINCT order_id) AS delivered_order_count, {_money("sum(gmv_c)", "gmv_ex_vat")},
        {_money("sum(gmv_c - x_c)", "net_sales_ex_vat")},
        {AOV.format("sum(gmv_c - x_c)", "count(DISTINCT order_id)")} AS aov_ex_vat
      FROM meas GROUP BY day, city_id"""),
    "fact_validation": _with(LINES, select=f'SELECT count(*) AS product_rows, {_money("sum(gmv_c)", "gmv")} FROM fact'),
    # order economics and lifecycle
    "price_lines": _with(LINES, PRICED, select=f"""SELECT id, order_id, product_id, quantity,
        {_money("price_c", "product_price")}, {_money("vat_c", "product_tax")}, {_money("s_c", "subtotal_amount")}
      FROM pl"""),
    "price_orders": _with(LINES, PRICED, select=f"""SELECT order_id, user_id, discount_id, prio AS payment_method_id,
        {_money("order_c", "order_amount")}, line_count, {_money("dis_c", "discount_amount")},
        {_money("order_c - dis_c", "total_amount")} FROM pd"""),
    "unit_cost_asof": _with(EVENTS, select="""SELECT l.event_id AS id, l.user_id AS product_id,
        l.second + 3600 AS created_at, CASE WHEN arg_max(v.event_type, v.event_id) <> 'error'
          THEN CAST(arg_max(v.cents, v.event_id) AS DOUBLE) / 100.0 END AS unit_cost_at_order
      FROM ev l LEFT JOIN ev v ON v.user_id = l.user_id AND v.second <= l.second + 3600 GROUP BY 1, 2, 3"""),
    "order_headers": _with(LINES, PRICED, select=f"""SELECT order_id, user_id, discount_id, prio AS payment_method_id,
        {_money("order_c", "order_amount")}, line_count, {_money("dis_c", "discount_amount")},
        {_money("order_c - dis_c", "total_amount")}, CAST(1 AS BIGINT) AS order_status_id,
        CAST(1 AS BIGINT) AS shipping_status_id, CAST(CASE WHEN prio = 1 THEN 1 ELSE 2 END AS BIGINT)
          AS payment_status_id FROM pd WHERE line_count > 0"""),
    "orders_rejected": _with(LINES, PRICED, select="""SELECT order_id, user_id, CAST(line_count AS BIGINT) AS line_count
      FROM pd WHERE line_count = 0"""),
    "order_transactions": _with(LINES, PRICED, select="""SELECT order_id, 'payment' AS transaction_type,
        CAST(CASE WHEN prio = 1 THEN 0 ELSE 1 END AS BIGINT) AS status,
        CASE WHEN prio = 1 THEN 'Payment pending for order #' ELSE 'Payment for order #' END || order_id AS description
      FROM pd WHERE line_count > 0"""),
    "order_history": _with(LINES, PRICED, select="""SELECT order_id, CAST(1 AS BIGINT) AS order_status_id,
        'Order #' || order_id || ' created' AS comments FROM pd WHERE line_count > 0"""),
    "advance_orders": _with(LINES, STEP, select=f"""SELECT order_id AS id, user_id,
        user_id AS address_id, {_money("a_c", "order_amount")}, {_money("d_c", "discount_amount")},
        {_money("a_c - d_c", "total_amount")}, CASE WHEN prio < 5 THEN prio END AS discount_id,
        prio AS payment_method_id, CAST(CASE WHEN cash THEN 2 ELSE 1 END AS BIGINT) AS payment_status_id,
        CAST(next_id AS BIGINT) AS order_status_id, ship AS shipping_method_id,
        CAST(shipping_id AS BIGINT) AS shipping_status_id,
        epoch_us(o_orderdate) // 1000000 AS created_at, {NOW_SECONDS} AS updated_at FROM step"""),
    "advance_history": _with(LINES, STEP, select="""SELECT order_id, CAST(next_id AS BIGINT) AS order_status_id,
        'Order #' || order_id || ' moved to ' || next AS comments FROM step"""),
    "advance_transactions": _with(LINES, STEP, select="""SELECT order_id AS id, order_id, 'payment' AS transaction_type,
        CAST(1 AS BIGINT) AS status, epoch_us(o_orderdate) // 1000000 AS created_at,
        'COD payment received for order #' || order_id AS description FROM step WHERE cash"""),
    # keys, references, constraints
    "insert_if_absent": """SELECT min(p_partkey) AS id, p_name AS tag_name FROM part
      WHERE p_name NOT IN (SELECT event_type FROM events) GROUP BY p_name""",
    "users_without_role": """SELECT c_custkey AS id, c_name AS username FROM customer WHERE c_custkey NOT IN
      (SELECT user_id FROM events WHERE event_type = 'signup')""",
    "users_without_address": """SELECT c_custkey AS id, c_name AS username FROM customer WHERE c_custkey NOT IN
      (SELECT user_id FROM events WHERE event_type = 'purchase')""",
    "products_without_tag": """SELECT p_partkey AS id, p_name FROM part WHERE p_partkey NOT IN
      (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""",
    "resolve_parent_key": """SELECT p_partkey AS id, p_type AS parent_name,
      CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category_id FROM part""",
    "dq_foreign_keys": _with(LINES, PRODUCTS, CATEGORIES, select=" UNION ALL ".join(_REFERENCES)),
    "dq_unique": _with(CATEGORIES, select=" UNION ALL ".join(_UNIQUE)),
    "dq_not_null": _with(LINES, CATEGORIES, select=" UNION ALL ".join(
        f"SELECT '{table}.{column}' AS column_name, count(*) - count({_SOURCES[table][1].get(column, 'NULL')}) AS null_count"
        f" FROM {_SOURCES[table][0]}" for table, column in REQUIRED_COLUMNS)),
    **{f"typed_{name}": _typed(name) for name in TABLES if name not in ("users", "orderdetails")},
    "dq_domain": """SELECT event_type AS value, count(*) AS row_count FROM events
      WHERE event_type NOT IN ('purchase', 'error') GROUP BY 1""",
    "dq_orders_without_lines": "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "latest_campaigns": f"""SELECT p AS id, 'Campaign ' || p AS campaign_title FROM {_CAMPAIGN_ROWS}
      ORDER BY p DESC LIMIT 3""",
    "users_with_addresses": "SELECT c_custkey AS user_id, c_custkey AS address_id FROM customer",
    "leaf_categories": _with(CATEGORIES, select="SELECT id, category_name, category_id, slug FROM cs WHERE category_id IS NOT NULL"),
    "category_tree": _with(CATEGORIES, select="""SELECT * FROM (
      WITH RECURSIVE tops AS (
        SELECT DISTINCT split_part(category_name, ' ', 1) AS name FROM cats WHERE category_id IS NULL
      ), rows AS (
        SELECT CAST('0x' || substr(md5('top ' || name), 1, 15) AS BIGINT) AS id, name AS category_name, CAST(NULL AS BIGINT) AS parent FROM tops
        UNION ALL SELECT id, category_name, coalesce(category_id,
          CAST('0x' || substr(md5('top ' || split_part(category_name, ' ', 1)), 1, 15) AS BIGINT)) FROM cats
      ), tree AS (
        SELECT id, category_name, id AS root_id, 0 AS depth, category_name AS path FROM rows WHERE parent IS NULL
        UNION ALL SELECT r.id, r.category_name, t.root_id, t.depth + 1, t.path || ' > ' || r.category_name FROM tree t JOIN rows r ON r.parent = t.id
      )
      SELECT id, category_name, root_id, CAST(depth AS BIGINT) AS depth, path,
        CAST(id NOT IN (SELECT parent FROM rows WHERE parent IS NOT NULL) AS BIGINT) AS is_leaf,
        CASE WHEN depth = 0 THEN 'root' ELSE 'child' END AS state FROM tree)"""),
    "category_slug": _with(CATEGORIES, select="SELECT id, category_name, slug FROM cs"),
}

# Other ways to the same rows.
ORACLE["report_overview_sales_compacted"] = ORACLE["report_overview_sales"]
ORACLE["report_overview_sales_base"] = ORACLE["report_overview_sales_days"]
ORACLE["incremental_compaction"] = ORACLE["compacted_changes"]
for _name in ("fact_sales_product", "fact_order_overview", "fact_user_registration"):
    ORACLE[f"maintained_{_name}"] = ORACLE[_name]
