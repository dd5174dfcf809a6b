"""Deterministic demo data: customers, orders, tickets. Nulls and spelling variants included on request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What seed rows are combined from.
NAMES = ("Anna", "Boris", "Clara", "Denis", "Elena", "Fedor")
STREETS = ("Lime", "Oak", "Pine", "Elm")


def customers(spark: SparkSession, count: int, nulls: bool = False) -> DataFrame:
    n = F.col("id")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (n % len(xs) + 1).cast("int"))
    keep = lambda c, at: F.when(n == at, None).otherwise(c) if nulls else c
    return spark.range(1, count + 1).select(
        "id",
        keep(F.concat(pick(NAMES), F.lit(" No"), F.lpad(n.cast("string"), 4, "0")), 53).alias("full_name"),
        keep(F.format_string("user%d@source.test", n), 54).alias("email"),
        keep(F.concat(F.lit("+7 999 "), F.lpad(n.cast("string"), 7, "0")), 55).alias("phone"),
        keep(F.concat(pick(STREETS), F.lit(" street "), n.cast("string")), 56).alias("address"),
    )


def orders(spark: SparkSession, each: int, of: DataFrame) -> DataFrame:
    """`each` orders of every customer: a cross join with a series."""
    series = spark.range(each).withColumnRenamed("id", "k")
    return of.crossJoin(series).select((F.col("id") * each - F.col("k")).alias("id"), F.col("id").alias("customer_id"), F.col("full_name").alias("billing_name"), F.col("email").alias("contact_email"), (F.col("id") * 10 + F.col("k")).cast("decimal(12,2)").alias("amount"))


def cycled_orders(spark: SparkSession, count: int, of: DataFrame, distinct: int) -> DataFrame:
    """`count` orders that go round the customers 1 to `distinct`: an equi-join on an expression."""
    o = spark.range(1, count + 1).withColumnRenamed("id", "order_id")
    return o.join(of, (F.col("order_id") - 1) % distinct + 1 == F.col("id")).select(F.col("order_id").alias("id"), F.col("id").alias("customer_id"), F.col("full_name").alias("billing_name"), F.col("email").alias("contact_email"))
