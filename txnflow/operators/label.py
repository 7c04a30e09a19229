"""High-value customers: spend per customer, threshold, and the label on every line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS
from txnflow.operators.quantiles import quantile_cont
from txnflow.session import stage

# Customers with more than one line in this many are labelled by broadcast. Fewer than this
# many can be so frequent, whatever the size of the data.
HOT_SHARE = 10_000


def customer_spend(lines: DataFrame) -> DataFrame:
    """Spend and lines of each customer; lines without a customer belong to none.

    Amounts are added as decimals, so a sum never depends on the order of the lines.
    """
    return lines.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(exact_sum("total_amount").alias("spend"), F.count(F.lit(1)).alias("lines"))


def exact_sum(amount: str) -> Column:
    """Sum of a double column by its decimal values, to six digits."""
    return F.sum(F.col(amount).cast("decimal(28,6)")).cast("double")


def high_value_customers(lines: DataFrame, threshold: float | None = None,
                         quantile: float = DEFAULTS.high_value_quantile) -> DataFrame:
    """One row per customer; label 1 for spend above the threshold or the given quantile."""
    return label_customers(customer_spend(lines), threshold, quantile)


def label_customers(spend: DataFrame, threshold: float | None = None, quantile: float = DEFAULTS.high_value_quantile) -> DataFrame:
    """Customers with ``spend`` and their label: the table is staged, since the threshold is found in several passes."""
    spend = stage(spend, "spend")
    limit = quantile_cont(spend, "spend", quantile) if threshold is None else float(threshold)
    label = F.lit(0) if limit is None else (F.col("spend") > F.lit(limit)).cast("int")
    return spend.withColumn("high_value_customer", label)


def label_lines(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Put the customer label on every line; customers unknown to the table get 0.

    One plan at every size, with one scan of the lines. Customers with more than one line in ``HOT_SHARE``, of whom there
    are fewer than that many, are labelled by a broadcast first. The other customers are joined by key; lines
    that are labelled already, or have no customer, get a key of their own there that matches nothing, so
    that neither a frequent customer nor the missing one gathers in a task.
    """
    columns = lines.columns
    body = lines.drop("high_value_customer")
    label = customers.where(F.col("customer_id").isNotNull()).select("customer_id", "high_value_customer", "lines")
    total = label.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    is_hot = F.col("lines") * F.lit(HOT_SHARE) > F.lit(total)
    hot = label.where(is_hot).select(F.col("customer_id"), F.col("high_value_customer").alias("_hot"))
    rest = label.where(~is_hot).select(F.col("customer_id").cast("string").alias("_key"), F.col("high_value_customer").alias("_rest"))
    own_key = F.concat(F.lit("\x00"), F.xxhash64(*body.columns).cast("string"))
    keyed = body.join(F.broadcast(hot), "customer_id", "left").withColumn(
        "_key", F.when(F.col("_hot").isNull() & F.col("customer_id").isNotNull(), F.col("customer_id").cast("string")).otherwise(own_key))
    joined = keyed.join(rest, "_key", "left").withColumn("high_value_customer", F.coalesce("_hot", "_rest", F.lit(0)))
    return joined.select(*(columns if "high_value_customer" in columns else [*columns, "high_value_customer"]))
