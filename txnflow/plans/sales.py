"""The raw sales table, and what follows from it, built over the order tables.

Raw sales text with deliberate dirt: cancelled invoices, missing customers, unreadable
and missing numbers and dates, zero prices, fractional quantities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.clean import clean

# The line keys order and split rows; with them every row is unique.
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# The columns used, typed: reading needs no inference job.
TABLES = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table as a stream.

    A pattern, since a streaming source takes a folder or a pattern but not a single file.
    """
    return spark.readStream.schema(TABLES["lineitem"]).parquet(f"{sf_dir}/lineitem.parque[t]")


def _whole(value: Column) -> Column:
    return value.cast("bigint").cast("string")


def raw_from(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales text for ``lines`` (batch or stream) with the line keys carried along."""
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    # The dimensions meet the orders first, so the far larger line table is moved once less.
    # Neither side of that join is small at scale, and the file size of the lines says little
    # about their number, so a sorted join is asked for rather than a guess at broadcasting.
    buyers = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    joined = lines.join(buyers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    order, number, part_key, cust = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "o_custkey"))
    returned = (F.col("l_returnflag") == "R") & (number % 2 == 0)
    quantity = _whole(F.col("l_quantity"))
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return joined.select(
        F.when(returned, F.concat(F.lit("C"), order.cast("string"))).otherwise(order.cast("string")).alias("invoice"),
        part_key.cast("string").alias("stockcode"),
        F.col("p_name").alias("description"),
        F.when(order % 97 == 0, "n/a").when(order % 89 == 0, F.lit(None))
        .when(number == 7, "0.5")
        .when(returned & (order % 3 != 0), F.concat(F.lit("-"), quantity))
        .otherwise(quantity).alias("quantity"),
        F.when(order % 101 == 0, "bad").when(order % 103 == 0, F.lit(None))
        .otherwise(F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
            F.lpad((order % 24).cast("string"), 2, "0"), F.lit(":00:00"),
        )).alias("invoicedate"),
        F.when(part_key % 50 == 0, "0.00").otherwise(F.concat(
            _whole(F.floor(unit / F.lit(100.0))), F.lit("."),
            F.lpad((F.floor(unit).cast("bigint") % 100).cast("string"), 2, "0"),
        )).alias("price"),
        F.when(cust % 11 != 0, cust.cast("string")).alias("customer_id"),
        F.col("n_name").alias("country"),
        *LINE_KEYS,
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(table(spark, sf_dir, "lineitem"), spark, sf_dir)


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sale lines with the line keys."""
    return clean(sales_raw(spark, sf_dir), keep=LINE_KEYS)
