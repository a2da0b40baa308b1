"""The source tables: columns, keys and references. Data only.

Column kinds (what a value becomes when it is missing or unusable):

========  ==============  =========================================================
kind      stored as       rule
========  ==============  =========================================================
id        bigint          missing or null becomes 0; not a whole number: broken row
id?       bigint          missing or null stays NULL; not a whole number: broken row
int       int             as ``id``
str       string          missing or null becomes the empty string
str?      string          missing or null stays NULL
money     decimal(15,2)   missing, null or not a number becomes 0.00
money?    decimal(15,2)   missing, null or not a number becomes NULL
float?    double          missing, null or not a number becomes NULL
time      timestamp       epoch milliseconds; missing or null becomes the epoch
time?     timestamp       epoch milliseconds; missing or null stays NULL
flag+     int             0 or 1; missing or null becomes 1
========  ==============  =========================================================

Ids are 64 bit although the sources count in 32: a change log of this size outgrows
32-bit line ids.
"""

from __future__ import annotations

from dataclasses import dataclass

TOPIC_PREFIX = "shop.public"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]  # (column, kind) in stored order, without id

    @property
    def topic(self) -> str:
        return f"{TOPIC_PREFIX}.{self.name}"

    @property
    def fields(self) -> tuple[tuple[str, str], ...]:
        return (("id", "id"), *self.columns)


def _table(name: str, *columns: str, dated: bool = True) -> TableSpec:
    pairs = [tuple(column.split(":")) for column in columns]
    if dated:
        pairs.append(("created_at", "time"))
    return TableSpec(name, tuple(pairs))


# The captured tables and their columns.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _table("users", "username:str"),
        _table("roles", "role_name:str", "role_title:str"),
        _table("role_user", "user_id:id", "role_id:id"),
        _table("regions", "region_name:str"),
        _table("provinces", "province_name:str", "region_id:id", "latitude:float?", "longitude:float?"),
        _table("addresses", "title:str?", "user_id:id", "province_id:id", "region_id:id"),
        _table("categories", "category_name:str", "category_id:id?", "slug:str?"),
        _table("brands", "brand_name:str"),
        _table("tags", "tag_name:str"),
        _table(
            "products",
            "product_name:str",
            "category_id:id?",
            "brand_id:id?",
            "product_price:money",
            "unit_cost:money",
            "product_quantity:int",
        ),
        _table("product_tag", "product_id:id", "tag_id:id"),
        _table("order_status", "order_status_name:str"),
        _table("payment_status", "payment_status_name:str"),
        _table("shipping_status", "shipping_status_name:str"),
        _table("payment_methods", "payment_method_name:str"),
        _table("shipping_methods", "shipping_method_name:str"),
        _table("ads_campaigns", "campaign_title:str", "started_at:time?", "expired_at:time?", dated=False),
        _table(
            "discounts",
            "adscampaign_id:id?",
            "type:str",
            "value:money",
            "code:str?",
            "started_at:time?",
            "expired_at:time?",
            dated=False,
        ),
        _table(
            "orders",
            "user_id:id",
            "staff_id:id?",
            "address_id:id?",
            "order_amount:money",
            "discount_amount:money",
            "total_amount:money",
            "discount_id:id?",
            "payment_method_id:id?",
            "payment_status_id:id?",
            "order_status_id:id?",
            "shipping_method_id:id?",
            "shipping_status_id:id?",
            "shipped_at:time?",
            "created_at:time",
            "updated_at:time",
            dated=False,
        ),
        _table(
            "orderdetails",
            "order_id:id",
            "product_id:id",
            "quantity:int",
            "product_price:money",
            "product_tax:money",
            "subtotal_amount:money",
            "unit_cost_at_order:money?",
        ),
        _table("order_status_history", "order_id:id", "order_status_id:id", "staff_id:id?", "comments:str?"),
        _table(
            "transactions",
            "order_id:id",
            "transaction_type:str",
            "status:flag+",
            "created_at:time",
            "description:str?",
            dated=False,
        ),
    )
}

#: Key columns of lines where each order numbers its own: the same id in another order is another line.
BY_ORDER: dict[str, tuple[str, ...]] = {"orderdetails": ("order_id", "id")}

# Columns that must never leave the source.
SENSITIVE: dict[str, tuple[str, ...]] = {
    "users": ("password", "email", "mobile"),
    "addresses": ("full_address",),
}

# Fixed values: (table, column, referenced table); every reference is to ``id``.
FOREIGN_KEYS: tuple[tuple[str, str, str], ...] = (
    ("role_user", "user_id", "users"),
    ("role_user", "role_id", "roles"),
    ("provinces", "region_id", "regions"),
    ("addresses", "user_id", "users"),
    ("addresses", "province_id", "provinces"),
    ("addresses", "region_id", "regions"),
    ("categories", "category_id", "categories"),
    ("products", "category_id", "categories"),
    ("products", "brand_id", "brands"),
    ("product_tag", "product_id", "products"),
    ("product_tag", "tag_id", "tags"),
    ("discounts", "adscampaign_id", "ads_campaigns"),
    ("orders", "user_id", "users"),
    ("orders", "staff_id", "users"),
    ("orders", "address_id", "addresses"),
    ("orders", "discount_id", "discounts"),
    ("orders", "payment_method_id", "payment_methods"),
    ("orders", "payment_status_id", "payment_status"),
    ("orders", "order_status_id", "order_status"),
    ("orders", "shipping_method_id", "shipping_methods"),
    ("orders", "shipping_status_id", "shipping_status"),
    ("orderdetails", "order_id", "orders"),
    ("orderdetails", "product_id", "products"),
    ("order_status_history", "order_id", "orders"),
    ("order_status_history", "order_status_id", "order_status"),
    ("order_status_history", "staff_id", "users"),
    ("transactions", "order_id", "orders"),
)

# Fixed values: (table, column) pairs that must hold no value twice (NULLs aside).
UNIQUE_COLUMNS: tuple[tuple[str, str], ...] = (
    ("users", "username"),
    ("users", "email"),
    ("users", "mobile"),
    ("roles", "role_name"),
    ("provinces", "province_name"),
    ("categories", "slug"),
    ("brands", "brand_name"),
    ("tags", "tag_name"),
    ("order_status", "order_status_name"),
    ("payment_status", "payment_status_name"),
    ("shipping_status", "shipping_status_name"),
    ("payment_methods", "payment_method_name"),
    ("shipping_methods", "shipping_method_name"),
)

# Fixed values: (table, column) pairs that must hold a value, without sensitive columns.
REQUIRED_COLUMNS: tuple[tuple[str, str], ...] = (
    ("users", "id"),
    ("users", "username"),
    ("users", "created_at"),
    ("roles", "id"),
    ("roles", "role_name"),
    ("roles", "role_title"),
    ("roles", "created_at"),
    ("role_user", "id"),
    ("role_user", "user_id"),
    ("role_user", "role_id"),
    ("role_user", "created_at"),
    ("regions", "id"),
    ("regions", "region_name"),
    ("regions", "created_at"),
    ("provinces", "id"),
    ("provinces", "province_name"),
    ("provinces", "region_id"),
    ("provinces", "created_at"),
    ("addresses", "id"),
    ("addresses", "user_id"),
    ("addresses", "province_id"),
    ("addresses", "region_id"),
    ("addresses", "created_at"),
    ("categories", "id"),
    ("categories", "category_name"),
    ("categories", "created_at"),
    ("brands", "id"),
    ("brands", "brand_name"),
    ("brands", "created_at"),
    ("tags", "id"),
    ("tags", "tag_name"),
    ("tags", "created_at"),
    ("products", "id"),
    ("products", "product_name"),
    ("products", "product_price"),
    ("products", "unit_cost"),
    ("products", "product_quantity"),
    ("products", "created_at"),
    ("product_tag", "id"),
    ("product_tag", "product_id"),
    ("product_tag", "tag_id"),
    ("product_tag", "created_at"),
    ("order_status", "id"),
    ("order_status", "order_status_name"),
    ("order_status", "created_at"),
    ("payment_status", "id"),
    ("payment_status", "payment_status_name"),
    ("payment_status", "created_at"),
    ("shipping_status", "id"),
    ("shipping_status", "shipping_status_name"),
    ("shipping_status", "created_at"),
    ("payment_methods", "id"),
    ("payment_methods", "payment_method_name"),
    ("payment_methods", "created_at"),
    ("shipping_methods", "id"),
    ("shipping_methods", "shipping_method_name"),
    ("shipping_methods", "created_at"),
    ("ads_campaigns", "id"),
    ("ads_campaigns", "campaign_title"),
    ("discounts", "id"),
    ("discounts", "type"),
    ("discounts", "value"),
    ("orders", "id"),
    ("orders", "user_id"),
    ("orders", "order_amount"),
    ("orders", "discount_amount"),
    ("orders", "total_amount"),
    ("orders", "created_at"),
    ("orders", "updated_at"),
    ("orderdetails", "id"),
    ("orderdetails", "order_id"),
    ("orderdetails", "product_id"),
    ("orderdetails", "quantity"),
    ("orderdetails", "product_price"),
    ("orderdetails", "product_tax"),
    ("orderdetails", "subtotal_amount"),
    ("orderdetails", "created_at"),
    ("order_status_history", "id"),
    ("order_status_history", "order_id"),
    ("order_status_history", "order_status_id"),
    ("order_status_history", "created_at"),
    ("transactions", "id"),
    ("transactions", "order_id"),
    ("transactions", "transaction_type"),
    ("transactions", "status"),
    ("transactions", "created_at"),
)

# The operations a change may carry (create, update, delete, snapshot read).
OPERATIONS = ("c", "u", "d", "r")

# The only transaction types.
TRANSACTION_TYPES = ("payment", "refund", "adjustment", "other")

# Days a raw event and a quarantined event are kept.
RAW_DAYS = 7
QUARANTINE_DAYS = 30
