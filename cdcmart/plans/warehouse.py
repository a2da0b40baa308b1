"""The layers wired together over a set of change tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.operators.state import base_and_changes, current_state
from cdcmart.plans import gold, report, silver
from cdcmart.session import checkpoint_dir
from cdcmart.sources.log import publish

Source = DataFrame | Callable[[], DataFrame]


class Warehouse:
    """Lazy entities, facts and reports. Nothing is stored: each method returns a plan
    over the newest change rows, so corrections, cancellations, deletes and replays show
    up in every number and none is counted twice.

    ``bronze`` maps table names to change tables (or functions returning them).
    Tables in ``compacted`` hold one row per key already and skip the newest-version
    step. ``base`` maps tables to such compacted copies; ``bronze`` then holds only the
    changes since. A base row counts unless its key has changed, so a range of days reaches the base's
    scan and only the changes go through the newest-version step. ``version`` are the
    columns that order the changes of a key; see ``state.SEVERAL_PARTITIONS``. ``keys`` names the
    key columns of tables whose ids are not unique by themselves, as ``sources.specs.BY_ORDER`` for lines
    numbered within their order. ``days`` limits the order-based facts to business days.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: Mapping[str, Source],
        *,
        compacted: Iterable[str] = (),
        base: Mapping[str, Source] | None = None,
        version: str | Sequence[str] = "_version",
        keys: Mapping[str, Sequence[str]] | None = None,
        days: tuple[dt.date | None, dt.date | None] = (None, None),
    ):
        self.spark = spark
        self.bronze = bronze
        self.compacted = frozenset(compacted)
        self.base = dict(base or {})
        self.version = version
        self.keys = dict(keys or {})
        self.days = days
        self._measured: DataFrame | None = None

    def changes(self, table: str) -> DataFrame:
        source = self.bronze[table]
        return source() if callable(source) else source

    def current(self, table: str, having: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """The newest rows; ``having`` picks rows by columns of the key, so before their versions are compared."""
        rows, keys = having(self.changes(table)), self.keys.get(table, "id")
        if table in self.compacted:
            return rows.where(F.col("_deleted") == 0)
        if table in self.base:
            return base_and_changes(having(self._base(table)), rows, keys, self.version)
        return current_state(rows, keys, self.version)

    def _base(self, table: str) -> DataFrame | None:
        """The compacted copy of a table, where hot keys are looked for: a key that is hot there is hot.
        The few changes since cannot make one that a task could not take."""
        source = self.base.get(table)
        return source() if callable(source) else source

    # cleaned entities

    def users(self) -> DataFrame:
        return silver.users(self.current("users"))

    def locations(self) -> DataFrame:
        return silver.locations(self.current("provinces"), self.current("regions"))

    def campaigns(self) -> DataFrame:
        return silver.campaigns(self.current("ads_campaigns"))

    def order_status(self) -> DataFrame:
        return silver.order_status(self.current("order_status"))

    def _live_orders(self) -> DataFrame:
        return gold.between_days(self.current("orders"), *self.days)

    def orders(self) -> DataFrame:
        return silver.orders(
            self._live_orders(),
            self.current("addresses"),
            self.current("discounts"),
            self.current("payment_methods"),
            self.current("shipping_methods"),
            self._base("orders"),
        )

    def products(self) -> DataFrame:
        return silver.products(self.current("products"), self.current("brands"), self.current("categories"))

    def order_items(self) -> DataFrame:
        return silver.order_items(self.current("orderdetails"))

    # dimensions

    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark)

    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.products())

    def dim_locations(self) -> DataFrame:
        return gold.dim_locations(self.locations())

    def dim_campaigns(self) -> DataFrame:
        return gold.dim_campaigns(self.campaigns())

    def dim_order_status(self) -> DataFrame:
        return gold.dim_order_status(self.order_status())

    # facts

    def fact_user_registration(self) -> DataFrame:
        return gold.fact_user_registration(self.users())

    def fact_order_overview(self) -> DataFrame:
        return gold.fact_order_overview(self.orders())

    def sale_heads(self, having: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """Delivered orders only, filtered before their places are looked up."""
        live = gold.between_days(self.current("orders", having), *self.days)
        sold = gold.only_delivered(live, self.order_status())
        placed = silver.placed_orders(sold, self.current("addresses"), self.current("discounts"), self._base("orders"))
        return gold.sale_heads(placed)

    def _base_items(self) -> DataFrame | None:
        base = self._base("orderdetails")
        return None if base is None else silver.order_items(base)

    def _split(self) -> gold.Split | None:
        """Hot orders' lines told from the others by their key, where it names the order: what is not hot is
        then not moved for them, and nothing is if there are no hot orders."""
        if "order_id" not in self.keys.get("orderdetails", ()):
            return None

        def by(key: str, hot: DataFrame, how: str) -> Callable[[DataFrame], DataFrame]:
            orders = F.broadcast(hot.withColumnRenamed("order_id", key))
            return lambda rows: rows.join(orders, key, how).select(*rows.columns)

        def split(hot: DataFrame, how: str) -> tuple[DataFrame, DataFrame]:
            heads = self.sale_heads(by("id", hot, how)) if how == "left_semi" else self.sale_heads()
            return heads, silver.order_items(self.current("orderdetails", by("order_id", hot, how)))

        return split

    def sales_line_base(self) -> DataFrame:
        return gold.sales_line_base(self.sale_heads(), self.order_items(), self._base_items())

    def sales_line_preliminary(self) -> DataFrame:
        return gold.sales_line_preliminary(self.sale_heads(), self.order_items(), self._base_items(), self._split())

    def sales_line_allocated(self, *, ranked: bool = True) -> DataFrame:
        return gold.sales_line_allocated(
            self.sale_heads(), self.order_items(), ranked=ranked, keys_from=self._base_items(), split=self._split()
        )

    def sales_line_measured(self, *, ranked: bool = True) -> DataFrame:
        if self._measured is not None and not ranked:
            return self._measured
        return gold.sales_line_measured(
            self.sale_heads(), self.order_items(), ranked=ranked, keys_from=self._base_items(), split=self._split()
        )

    def fact_sales_product(self) -> DataFrame:
        return gold.fact_sales_product(self.sales_line_measured(ranked=False))

    def discount_conservation(self) -> DataFrame:
        return gold.discount_conservation(self.sales_line_allocated(ranked=False))

    # reports

    def report_marketing_dashboard(self) -> DataFrame:
        return report.marketing_dashboard(
            self.fact_sales_product(),
            self.dim_date(),
            self.dim_locations(),
            self.dim_products(),
            self.dim_campaigns(),
        )

    def report_overview_sales(self) -> DataFrame:
        return report.overview_sales(
            self.fact_sales_product(), self.dim_date(), self.dim_locations(), self.dim_products()
        )

    def report_overview_orders(self) -> DataFrame:
        return report.overview_orders(
            self.fact_order_overview(), self.dim_date(), self.dim_locations(), self.dim_order_status()
        )

    def report_overview_users(self) -> DataFrame:
        return report.overview_users(self.fact_user_registration())

    def report_delivered_order_aov(self) -> DataFrame:
        return report.delivered_order_aov(self.sales_line_measured(ranked=False))

    def fact_validation(self) -> DataFrame:
        return report.fact_validation(self.fact_sales_product())

    REPORTS = (
        "report_marketing_dashboard",
        "report_overview_sales",
        "report_overview_orders",
        "report_overview_users",
        "report_delivered_order_aov",
    )

    # serving

    def register_views(self) -> list[str]:
        """Make the reports readable by name in SQL."""
        for name in self.REPORTS:
            getattr(self, name)().createOrReplaceTempView(name)
        return list(self.REPORTS)

    def share_sale_lines(self) -> None:
        """Compute the allocated sale lines once for several reports of one run.

        The rows go to the cluster's checkpoint folder, so a lost executor costs a
        re-read and not the whole chain.
        """
        checkpoint_dir(self.spark, scratch=True)
        self._measured = self.sales_line_measured(ranked=False).checkpoint()

    def publish_reports(self, path: str, batch_id: int) -> bool:
        """Write all reports as one unit; the sale lines that they share are computed once."""
        if self._measured is None:
            self.share_sale_lines()
        return publish({name: getattr(self, name)() for name in self.REPORTS}, path, batch_id)
