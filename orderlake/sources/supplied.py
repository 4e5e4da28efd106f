"""Adapters from the supplied Parquet tables to the engine's raw inputs.

Every row of a table is carried over. The raw inputs are made as untidy as real
feeds are - five date formats, spelling variants, missing and impossible values -
by a rule on the row's own columns (order priority, market segment, nation, part
size and so on), so the expected clean value of each row is known exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas


Reader = Callable[[SparkSession, str, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _conform(df: DataFrame, schema: str) -> DataFrame:
    """Columns and types of a declared schema."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def raw_orders(spark: SparkSession, sf_dir: str, read: Reader = table) -> DataFrame:
    """Orders: date format by priority; bad dates on day 31; odd ids and amounts by price band."""
    df = read(spark, sf_dir, "orders").selectExpr(
        """CASE WHEN o_totalprice >= 12000 AND o_totalprice < 13000 THEN NULL
                ELSE o_orderkey END AS order_id""",
        "CASE WHEN o_totalprice >= 6000 THEN o_custkey END AS customer_id",
        """CASE WHEN day(o_orderdate) = 31 THEN '2024-13-45'
                WHEN o_totalprice >= 6000 AND o_totalprice < 8000 THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'yyyy-MM-dd')
                WHEN o_orderpriority = '2-HIGH' THEN date_format(o_orderdate, 'MM/dd/yyyy')
                WHEN o_orderpriority = '3-MEDIUM' THEN date_format(o_orderdate, 'dd-MM-yyyy')
                WHEN o_orderpriority = '4-NOT SPECIFIED' THEN date_format(o_orderdate, 'yyyyMMdd')
                ELSE date_format(o_orderdate, 'MMMM dd, yyyy') END AS order_date""",
        """CASE WHEN o_totalprice >= 8000 AND o_totalprice < 9000 THEN ''
                WHEN o_orderstatus = 'F' THEN CASE o_orderpriority
                     WHEN '1-URGENT' THEN 'completed' WHEN '2-HIGH' THEN 'Completed'
                     WHEN '3-MEDIUM' THEN 'COMPLETED' WHEN '4-NOT SPECIFIED' THEN 'complete'
                     ELSE '  Complete ' END
                WHEN o_orderstatus = 'P' THEN CASE o_orderpriority
                     WHEN '1-URGENT' THEN 'cancelled' WHEN '2-HIGH' THEN 'Canceled'
                     WHEN '3-MEDIUM' THEN 'CANCELLED' WHEN '4-NOT SPECIFIED' THEN 'canceled'
                     ELSE 'unknwon' END
                ELSE CASE o_orderpriority
                     WHEN '1-URGENT' THEN 'Processing' WHEN '2-HIGH' THEN 'Delivered'
                     WHEN '3-MEDIUM' THEN 'returned' WHEN '4-NOT SPECIFIED' THEN 'ERROR'
                     ELSE ' On Hold' END END AS status""",
        # A fiftieth of the price spreads orders over all amount tiers.
        """CASE WHEN o_totalprice >= 497500 THEN cents * 10
                WHEN o_totalprice >= 9000 AND o_totalprice < 11000 THEN -cents
                WHEN o_totalprice >= 11000 AND o_totalprice < 12000 THEN 0
                ELSE cents END AS total_amount""".replace(
            "cents",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.02BD AS DECIMAL(18,2))",
        ),
        "lower(o_orderpriority) AS source_system",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS last_updated",
    )
    return _conform(df, schemas.ORDERS)


def raw_customers(spark: SparkSession, sf_dir: str, read: Reader = table) -> DataFrame:
    """Customers: titles and date format by segment, bad values by nation, copies of nation 5."""
    base = read(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_nationkey <> 11 THEN c_custkey END AS customer_id",
        """CASE WHEN c_nationkey = 0 THEN 'Test User' WHEN c_nationkey = 1 THEN ' '
                WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('Mr. ', c_name)
                WHEN c_mktsegment = 'BUILDING' THEN concat('  Ann   ', c_name, ' ')
                WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('Dr.', c_name)
                ELSE c_name END AS name""",
        """CASE WHEN c_nationkey = 2 THEN 'notanemail' WHEN c_nationkey = 3 THEN 'user@domain'
                WHEN c_nationkey = 4 THEN concat(' User', c_custkey, '@Shop.COM ')
                WHEN c_nationkey = 6 THEN NULL
                ELSE concat('user', c_custkey, '@shop.com') END AS email""",
        """CASE WHEN c_nationkey = 7 THEN '' WHEN c_nationkey = 8 THEN '1/5/2024'
                WHEN c_mktsegment = 'AUTOMOBILE' THEN date_format(joined, 'yyyy-MM-dd')
                WHEN c_mktsegment = 'BUILDING' THEN date_format(joined, 'MM/dd/yyyy')
                WHEN c_mktsegment = 'FURNITURE' THEN date_format(joined, 'dd-MM-yyyy')
                WHEN c_mktsegment = 'HOUSEHOLD' THEN date_format(joined, 'yyyyMMdd')
                ELSE date_format(joined, 'MMMM dd, yyyy') END AS join_date""".replace(
            "joined", "date_add(DATE'1990-01-01', CAST(floor(c_acctbal) AS INT))"
        ),
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VIP' WHEN 'BUILDING' THEN 'standard'
                WHEN 'FURNITURE' THEN ' New ' WHEN 'HOUSEHOLD' THEN 'Churned '
                ELSE 'TBD' END AS segment""",
        """CASE WHEN c_nationkey = 9 THEN '123-456-7890' WHEN c_nationkey = 10 THEN '12345'
                WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('+1-555-', mid, '-', tail)
                WHEN c_mktsegment = 'BUILDING' THEN concat('555.', mid, '.', tail)
                WHEN c_mktsegment = 'FURNITURE' THEN concat('(555) ', mid, '-', tail)
                WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('555', mid, tail)
                ELSE 'N/A' END AS phone""".replace(
            "mid", "lpad(CAST(c_nationkey AS STRING), 3, '2')"
        ).replace("tail", "right(c_name, 4)"),
        "CAST(NULL AS STRING) AS address",
        "CAST(floor(c_acctbal / 80) AS INT) AS age",
        """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Yes' WHEN 'BUILDING' THEN 'n'
                WHEN 'FURNITURE' THEN '1' WHEN 'HOUSEHOLD' THEN 'Inactive'
                ELSE 'maybe' END AS marketing_opt_in""",
        "CAST(NULL AS STRING) AS last_login",
        "c_nationkey",
    )
    copies = base.filter("c_nationkey = 5").withColumn("name", F.concat("name", F.lit(" copy")))
    return _conform(base.unionByName(copies), schemas.CUSTOMERS)


def raw_order_items(spark: SparkSession, sf_dir: str, read: Reader = table) -> DataFrame:
    """Order items: line items, some with unusable quantity, price, discount, product or total."""
    df = (
        read(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS item_id",
            "l_orderkey AS order_id",
            "CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN NULL ELSE l_partkey END AS product_id",
            """CASE WHEN day(l_shipdate) = 31 THEN NULL WHEN day(l_shipdate) = 30 THEN 0
                    ELSE CAST(l_quantity AS INT) END AS quantity""",
            "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.02BD AS DECIMAL(18,2)) AS unit",
            "CAST(l_discount AS DECIMAL(4,2)) AS rate",
            "CAST(l_tax AS DECIMAL(4,2)) AS tax",
            "l_quantity",
            "l_linenumber",
            "l_returnflag",
            "day(l_shipdate) AS ship_day",
        )
        .selectExpr(
            "item_id",
            "order_id",
            "product_id",
            "quantity",
            "CASE WHEN ship_day = 29 THEN -unit ELSE unit END AS price",
            "CASE WHEN ship_day = 28 THEN 150 ELSE rate * 100 END AS discount_percent",
            "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(unit * tax AS DECIMAL(18,2)) END AS tax_amount",
            # Totals that add up, but for line number 7.
            """CAST(CAST(l_quantity AS INT) * unit * (1 - rate)
                    + CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(unit * tax AS DECIMAL(18,2)) END
                    + CASE WHEN l_linenumber = 7 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS line_total""",
        )
    )
    return _conform(df, schemas.ORDER_ITEMS)


def raw_products(spark: SparkSession, sf_dir: str, read: Reader = table) -> DataFrame:
    """Products: category spellings by part type, bad names, prices and costs by size."""
    df = read(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size <> 11 THEN p_partkey END AS product_id",
        """CASE p_size WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN concat('  ', p_name, ' ')
                ELSE p_name END AS product_name""",
        """CASE WHEN p_size = 50 THEN ' Toys '
                WHEN p_type = 'STANDARD' THEN 'ELECTRONICS' WHEN p_type = 'MEDIUM' THEN 'Electronic'
                WHEN p_type = 'ECONOMY' THEN 'HOME_KITCHEN' WHEN p_type = 'PROMO' THEN 'sports'
                WHEN p_type = 'SMALL' THEN 'Book & Media' ELSE 'TBD' END AS category""",
        "p_brand AS subcategory",
        """CASE p_size WHEN 4 THEN NULL WHEN 5 THEN -p_retailprice WHEN 6 THEN p_retailprice * 1000
                WHEN 8 THEN 0 ELSE p_retailprice END AS unit_price""",
        """CASE p_size WHEN 7 THEN CAST(p_retailprice AS DECIMAL(18,2)) + 100
                WHEN 9 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) - 300 END AS cost""",
        "CAST(NULL AS BIGINT) AS supplier_id",
        """CASE p_type WHEN 'STANDARD' THEN 'True' WHEN 'MEDIUM' THEN 'no' WHEN 'ECONOMY' THEN 'Y'
                WHEN 'PROMO' THEN '0' WHEN 'SMALL' THEN 'active' ELSE '' END AS is_active""",
        """CASE WHEN p_size = 10 THEN '2024-01-15 10:00:00'
                ELSE date_format(date_add(DATE'2020-01-01', p_size), 'dd-MM-yyyy') END AS created_date""",
        "CASE WHEN p_size = 50 THEN 1500 ELSE p_size * 1.5D END AS weight_kg",
    )
    return _conform(df, schemas.PRODUCTS)


# ---- fixed values: how event types of the supplied events table are read ------
EVENT_STATUS = {
    "purchase": "completed",
    "error": "cancelled",
    "view": "pending",
    "click": "shipped",
    "signup": "refunded",
}
# Event values are small; this factor spreads them over the fraud tiers.
EVENT_AMOUNT_FACTOR = 20
# ------------------------------------------------------------------------------


def _event_status() -> Column:
    case = F
    for event_type, status in EVENT_STATUS.items():
        case = case.when(F.col("event_type") == event_type, status)
    return case.otherwise(None)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as they arrive on a stream, one per row of the events table."""
    events = table(spark, sf_dir, "events")
    amount = (F.col("value").cast("decimal(18,2)") * EVENT_AMOUNT_FACTOR).cast("double")
    return events.select(
        F.lit("order").alias("event_type"),
        # The smallest sales come without a readable time.
        F.when(F.col("value") < 1, "n/a")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("event_timestamp"),
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        # Views carry no date of their own, clicks an unreadable one.
        F.when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy/MM/dd"))
        .when(F.col("event_type") == "click", "soon")
        .when(F.col("event_type") != "view", F.date_format("ts", "MM/dd/yyyy"))
        .alias("order_date"),
        _event_status().alias("status"),
        amount.alias("total_amount"),
        F.lit("events").alias("source_system"),
    )


def live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with a parsed event time, as the live views read them."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        _event_status().alias("status"),
        (F.col("value").cast("decimal(18,2)") * EVENT_AMOUNT_FACTOR)
        .cast("decimal(18,2)")
        .alias("total_amount"),
    )


def customer_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer events without the customer's segment, which needs a join."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "signup", "customer_create")
        .otherwise("customer_update")
        .alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("user_id").alias("customer_id"),
    )


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer events: sign-ups create a customer, anything else updates one."""
    events = customer_event_rows(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return events.join(customers, events.customer_id == customers.c_custkey, "left").select(
        *events.columns, F.col("c_mktsegment").alias("customer_segment")
    )


def item_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item events, one per line item, without what the product's own table says."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_price"),
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product with its part type as category."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_type").alias("category")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message log: event type as topic, user as key, event id as offset, fields as JSON."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.col("event_id").alias("order_id"),
                F.col("user_id").alias("customer_id"),
                F.col("value").alias("total_amount"),
                F.from_json("props", "k INT").getField("k").alias("quantity"),
            )
        ).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log with some values cut off, missing or no object, by offset."""
    spoilt = (
        F.when(F.col("offset") % 97 == 0, F.expr("substring(value, 1, cast(length(value) / 2 as int))"))
        .when(F.col("offset") % 97 == 1, F.lit(None))
        .when(F.col("offset") % 97 == 2, F.lit(" "))
        .when(F.col("offset") % 97 == 3, F.lit('{"order_id":"none"}'))
        .otherwise(F.col("value"))
    )
    return messages(spark, sf_dir).withColumn("value", spoilt)


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as columns of CSV text: quantities of line 6 unreadable, line 7 has a field
    too many (the writer must not quote)."""
    items = raw_order_items(spark, sf_dir)
    text = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    line = F.col("item_id").cast("long") % 10
    return text.withColumns(
        {
            "quantity": F.when(line == 6, F.concat(F.coalesce("quantity", F.lit("?")), F.lit("x"))).otherwise(
                F.col("quantity")
            ),
            "line_total": F.when(line == 7, F.concat("line_total", F.lit(",extra"))).otherwise(F.col("line_total")),
        }
    )


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON text (``value``): those of nation 13 cut off, of nation 14 with a text
    for an age."""
    customers = table(spark, sf_dir, "customer")
    text = F.to_json(
        F.struct(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_nationkey") == 14, "old").otherwise("41").alias("age"),
        )
    )
    # Ages are numbers but for the text.
    text = F.regexp_replace(text, '"41"', "41")
    cut = text.substr(F.lit(1), F.length(text) - 3)
    return customers.select(F.when(F.col("c_nationkey") == 13, cut).otherwise(text).alias("value"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics seen in the log (3 partitions, 2 weeks retention), with one partition to spare.

    The spare partition is declared and empty.
    """
    seen = table(spark, sf_dir, "events").select(F.col("event_type").alias("topic")).distinct()
    return seen.select(
        "topic", F.lit(4).alias("partitions"), F.lit(336).alias("retention_hours")
    )


def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of a consumer that has read the month's first half of all topics but one."""
    read = (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & (
        F.col("event_type") != "signup"
    )
    return (
        table(spark, sf_dir, "events")
        .filter(read)
        .groupBy(
            F.lit("billing").alias("group_id"),
            F.col("event_type").alias("topic"),
            (F.col("user_id") % 3).cast("int").alias("partition"),
        )
        .agg((F.max("event_id") + 1).alias("committed_offset"))
    )
