"""The shared test tables (orders, lineitem, events, ...) reshaped as the raw tables.

Every derivation is a plain expression, so the size of each raw table follows the size of
its base table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The base tables of each raw table.
BASES = {
    "raw_customers": ("orders", "customer", "nation"),
    "raw_orders": ("orders", "lineitem"),
    "raw_order_items": ("lineitem",),
    "raw_order_payments": ("lineitem",),
    "raw_order_reviews": ("events", "orders"),
    "raw_products": ("part",),
    "raw_sellers": ("supplier", "nation"),
    "raw_category_translation": ("part",),
}


def _shift(base: Column | str, days: Column, hours: Column) -> Column:
    base = F.col(base) if isinstance(base, str) else base
    return base + F.make_dt_interval(days.cast("int"), hours.cast("int"))


class StandinRaw:
    """Lazy raw tables over a folder of base Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def base(self, name: str) -> DataFrame:
        path = f"{self._folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self._spark.read.parquet(path).schema  # one footer job
        return self._spark.read.schema(self._schemas[name]).parquet(path)

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, table)

    def __contains__(self, table: str) -> bool:
        """Whether every base table that this raw table comes from is there."""
        return table in BASES and all(map(self._is_there, BASES[table]))

    def _is_there(self, name: str) -> bool:
        try:
            self.base(name)
        except AnalysisException as reason:
            if reason.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    @cached_property
    def raw_orders(self) -> DataFrame:
        last_ship = self.base("lineitem").groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("last_ship")
        )
        orders = self.base("orders")
        joined = orders.join(last_ship, orders.o_orderkey == last_ship.l_orderkey, "left")
        key = F.col("o_orderkey")
        zero = F.lit(0)
        transit = F.pmod(F.datediff("last_ship", "o_orderdate"), F.lit(75))
        delivered = _shift("o_orderdate", transit, key % 24)
        priority = F.substring("o_orderpriority", 1, 1).cast("int")
        return joined.select(
            key.alias("order_id"),
            key.alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .when(F.col("o_orderstatus") == "P", "canceled")
            .alias("order_status"),
            _shift("o_orderdate", zero, key * 7 % 24).alias("order_purchase_timestamp"),
            _shift("o_orderdate", F.lit(1), key % 24).alias("order_approved_at"),
            _shift(delivered, F.lit(-2), zero).alias("order_delivered_carrier_date"),
            delivered.alias("order_delivered_customer_date"),
            _shift("o_orderdate", 10 + 5 * priority, zero).alias(
                "order_estimated_delivery_date"
            ),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        # Laid out by customer_id, as the raw table's own grain. Otherwise the rows would stay
        # where the join on o_custkey put them, and a person with a third of all orders would
        # keep one task busy in every later step.
        customer = self.base("customer")
        nation = self.base("nation").select("n_nationkey", "n_name")
        orders = self.base("orders")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_orderkey").alias("customer_id"),
                F.col("o_custkey").alias("customer_unique_id"),
                F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias(
                    "customer_zip_code_prefix"
                ),
                F.concat_ws("-", "c_mktsegment", F.substring("o_orderpriority", 1, 1)).alias(
                    "customer_city"
                ),
                F.col("n_name").alias("customer_state"),
            )
            .repartition("customer_id")
        )

    @cached_property
    def raw_order_items(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_quantity") * 0.5).alias("freight_value"),
        )

    @cached_property
    def raw_order_payments(self) -> DataFrame:
        kind = F.col("l_linenumber") % 4
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.when(kind == 0, "boleto")
            .when(kind == 1, "credit_card")
            .when(kind == 2, "debit_card")
            .otherwise("voucher")
            .alias("payment_type"),
            F.col("l_extendedprice").alias("payment_value"),
        )

    @cached_property
    def raw_order_reviews(self) -> DataFrame:
        events = self.base("events")
        orders = self.base("orders").select("o_orderkey", "o_orderdate")
        joined = events.join(orders, F.expr("event_id div 2") == F.col("o_orderkey"))
        return joined.select(
            # The join key again, in other words: named by the key itself, later steps would
            # build on the join's partitioning, and adaptive execution could not split an
            # order that holds a third of the reviews.
            F.shiftright("event_id", 1).alias("order_id"),
            (1 + F.floor("value") % 5).cast("int").alias("review_score"),
            _shift("o_orderdate", F.col("event_id") % 60, F.lit(0)).alias(
                "review_creation_date"
            ),
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        size = F.col("p_size").cast("double")
        nothing = F.lit(None).cast("int")
        return self.base("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            nothing.alias("product_name_lenght"),
            nothing.alias("product_description_lenght"),
            nothing.alias("product_photos_qty"),
            size.alias("product_weight_g"),
            size.alias("product_length_cm"),
            size.alias("product_height_cm"),
            size.alias("product_width_cm"),
        )

    @cached_property
    def raw_category_translation(self) -> DataFrame:
        return (
            self.base("part")
            .where(F.col("p_type") != "PROMO")
            .select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .withColumn(
                "product_category_name_english",
                F.concat(F.lower("product_category_name"), F.lit("_en")),
            )
        )

    @cached_property
    def raw_sellers(self) -> DataFrame:
        supplier = self.base("supplier")
        nation = self.base("nation").select("n_nationkey", "n_name")
        return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("seller_id"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.lit(None).cast("string").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
