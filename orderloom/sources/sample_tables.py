"""The given order tables in the landing shape, clean or with known dirt.

The tables are typed and tidy; the landing shape is text with stray blanks and mixed case, as
a source system would send it. All money is worked out in whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.config import CANCELLED, DELIVERED, PENDING, RETURNED, SHIPPED
from orderloom.operators.dedupe import first_by_key
from orderloom.operators.numbering import number_rows
from orderloom.sources.landing import string_schema, to_bronze

# Base ingest time; timestamp format; registration date of customers and parts.
INGEST_BASE = "2001-08-02 00:00:00"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
REGISTERED = "1995-01-01 00:00:00"
# Bad rows get ids far above the good ones: kind times this.
ID_STEP = 10**15


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _ingested(seconds: int = 0) -> Column:
    base = F.lit(INGEST_BASE).cast("timestamp")
    return base + F.make_dt_interval(secs=F.lit(seconds))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    return to_bronze(
        c.select(
            _text(F.col("c_custkey")).alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit("  "), "c_name", F.lit("@Mail.Example ")).alias("email"),
            F.lit(REGISTERED).alias("created_at"),
            _ingested().alias("_ingest_ts"),
        ),
        "bronze_customers",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    padded = F.lpad(_text(F.col("p_partkey")), 8, "0")
    return to_bronze(
        p.select(
            _text(F.col("p_partkey")).alias("product_id"),
            F.concat(F.lit(" sku-"), padded, F.lit(" ")).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            _text(_price(_cents("p_retailprice"))).alias("unit_price"),
            F.lit(REGISTERED).alias("created_at"),
            _ingested().alias("_ingest_ts"),
        ),
        "bronze_products",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return to_bronze(
        o.select(
            _text(F.col("o_orderkey")).alias("order_id"),
            _text(F.col("o_custkey")).alias("customer_id"),
            F.date_format("o_orderdate", TS_FORMAT).alias("order_date"),
            F.col("o_orderpriority").alias("shipping_address"),
            _ingested().alias("_ingest_ts"),
        ),
        "bronze_orders",
    )


def _price(cents: Column) -> Column:
    return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)")


def _line_status() -> Column:
    flag, shipped = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((flag == "R") & (shipped == "F"), RETURNED)
        .when((flag == "R") & (shipped == "O"), CANCELLED)
        .when(shipped == "F", DELIVERED)
        .when(flag == "A", SHIPPED)
        .otherwise(PENDING)
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a number of their own (the table has no key), still typed."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    lines = _table(spark, sf_dir, "lineitem").select(
        *order, "l_quantity", "l_returnflag", "l_linestatus"
    )
    quantity = F.col("l_quantity").cast("int")
    # Floor of whole cents per unit: exact in any engine, unlike a quotient of doubles.
    unit_cents = F.call_function("div", _cents("l_extendedprice"), quantity.cast("bigint"))
    return number_rows(lines, order, "line_id").select(
        "line_id",
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        quantity.alias("units"),
        _price(unit_cents).alias("price"),
        _line_status().alias("status"),
        F.date_format("l_shipdate", TS_FORMAT).alias("changed_at"),
    )


def _items(
    lines: DataFrame,
    item_id: Column | None = None,
    order_id: Column | None = None,
    product_id: Column | None = None,
    quantity: Column | None = None,
    status: Column | None = None,
    ingested: int = 0,
) -> DataFrame:
    """Lines in the landing shape, with some of the values replaced."""

    def given(value: Column | None, default: str) -> Column:
        return F.col(default) if value is None else value

    return to_bronze(
        lines.select(
            _text(given(item_id, "line_id")).alias("order_item_id"),
            _text(given(order_id, "order_key")).alias("order_id"),
            _text(given(product_id, "part_key")).alias("product_id"),
            _text(given(quantity, "units")).alias("quantity"),
            _text(F.col("price")).alias("unit_price"),
            given(status, "status").alias("line_status"),
            F.col("changed_at").alias("status_updated_at"),
            _ingested(ingested).alias("_ingest_ts"),
        ),
        "bronze_order_items",
    )


def _as_sent() -> Column:
    """Every fifth order sends its statuses in lower case with blanks around."""
    untidy = F.concat(F.lit(" "), F.lower("status"), F.lit(" "))
    return F.when(F.col("order_key") % 5 == 0, untidy).otherwise(F.col("status"))


def items(lines: DataFrame) -> DataFrame:
    """All lines, clean but for untidy statuses."""
    return _items(lines, status=_as_sent())


def resent_items(lines: DataFrame) -> DataFrame:
    return _items(_orders_by(lines, 7), status=_as_sent(), ingested=1)


def fixed_items(lines: DataFrame) -> DataFrame:
    return _items(_orders_by(lines, 11), status=F.lit(RETURNED), ingested=2)


def new_items(lines: DataFrame) -> DataFrame:
    """Lines that were not there before: copies of every 101st order's lines with new ids."""
    return _items(_orders_by(lines, 101), item_id=F.col("line_id") + 5 * ID_STEP, ingested=3)


def broken_items(lines: DataFrame) -> DataFrame:
    """Rows that break one rule each: the first line of some orders with one bad value."""
    first = first_by_key(lines, ["order_key"], [F.col("line_id")])

    def as_kind(kind: int) -> Column:
        return F.col("line_id") + kind * ID_STEP

    minus_one = F.lit(-1)
    return (
        _items(_orders_by(first, 13), item_id=as_kind(1), status=F.lit("LOST"))
        .unionByName(_items(_orders_by(first, 17), item_id=as_kind(2), order_id=minus_one))
        .unionByName(_items(_orders_by(first, 19), item_id=as_kind(3), product_id=minus_one))
        .unionByName(_items(_orders_by(first, 23), item_id=as_kind(4), quantity=F.lit("n/a")))
        .unionByName(_items(_orders_by(first, 29), item_id=F.lit(None).cast("bigint")))
    )


def _dirty(rows: DataFrame, key: str, changed: dict[str, Column]) -> DataFrame:
    """A parent table with newer versions, rows without a key and rows with an unreadable one."""
    number = F.col(key).cast("bigint")
    newer = rows.where(number % 11 == 0).withColumns({**changed, "_ingest_ts": _ingested(2)})
    keyless = rows.where(number % 29 == 0).withColumn(key, F.lit(None).cast("string"))
    unreadable = rows.where(number % 23 == 0).withColumn(key, F.concat(F.lit("x"), key))
    return rows.unionByName(newer).unionByName(keyless).unionByName(unreadable).select(*rows.columns)


def _taken_over(key: str, every: int, digits: int) -> Column:
    """The padded number of the row, or of the row before for some: a key that two rows share."""
    number = F.col(key).cast("bigint")
    shift = ((number % every == 0) & (number > 0)).cast("int")
    return F.lpad((number - shift).cast("string"), digits, "0")


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of which some have the email of the one before; newer ones got a phone."""
    email = F.concat(F.lit(" Customer#"), _taken_over("customer_id", 31, 9), F.lit("@Mail.Example "))
    rows = customers(spark, sf_dir).withColumn("email", email)
    return _dirty(rows, "customer_id", {"phone": F.concat(F.lit("555-"), "customer_id")})


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of which some have the SKU of the one before; newer ones got another category."""
    sku = F.concat(F.lit(" sku-"), _taken_over("product_id", 37, 8), F.lit(" "))
    rows = products(spark, sf_dir).withColumn("sku", sku)
    return _dirty(rows, "product_id", {"category": F.lit("RENEWED")})


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with newer addresses, and copies with new ids of customers that do not exist."""
    rows = orders(spark, sf_dir)
    number = F.col("order_id").cast("bigint")
    lost = rows.where(number % 17 == 0).withColumns(
        {"order_id": _text(number + ID_STEP), "customer_id": F.lit("-1")}
    )
    changed = {"shipping_address": F.concat(F.lit("moved "), "shipping_address")}
    return _dirty(rows, "order_id", changed).unionByName(lost)


def moved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth order again, dated forty days later."""
    rows = orders(spark, sf_dir).where(F.col("order_id").cast("bigint") % 9 == 0)
    later = F.to_timestamp("order_date", TS_FORMAT) + F.make_dt_interval(days=F.lit(40))
    return rows.withColumns({"order_date": F.date_format(later, TS_FORMAT), "_ingest_ts": _ingested(2)})


def quoted_items(lines: DataFrame) -> DataFrame:
    """The dirty lines; some with quotes, commas and a line break in their status."""
    rows = dirty_items(lines)
    text = F.concat("line_status", F.lit(' "q", x\ny'))
    odd = F.coalesce(F.col("order_id").cast("bigint") % 31 == 0, F.lit(False))
    return rows.withColumn("line_status", F.when(odd, text).otherwise(F.col("line_status")))


def misfit_lines(lines: DataFrame) -> DataFrame:
    """CSV text of rows with a value too many or some too few, in one column named as the header."""
    first = first_by_key(_orders_by(lines, 37), ["order_key"], [F.col("line_id")])
    columns = string_schema("bronze_order_items").names
    rows = _items(first).drop("_ingest_ts")
    number = F.col("order_item_id").cast("bigint")
    long = rows.select(F.concat_ws(",", _text(number + 6 * ID_STEP), *columns[1:], F.lit("more")))
    short = rows.select(F.concat_ws(",", _text(number + 7 * ID_STEP), *columns[1:3]))
    return long.union(short).toDF(",".join(columns))


def dirty_items(lines: DataFrame) -> DataFrame:
    """All lines, with resent copies, corrected versions and broken rows among them."""
    return (
        items(lines)
        .unionByName(resent_items(lines))
        .unionByName(fixed_items(lines))
        .unionByName(broken_items(lines))
    )


def _orders_by(lines: DataFrame, n: int) -> DataFrame:
    return lines.where(F.col("order_key") % n == 0)
