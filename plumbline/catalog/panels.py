"""Feature panels derived from the test tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import materialize

FEATURES = ["revenue", "discount", "tax", "quantity", "n_lines"]
EVENT_FEATURES = ["value_sum", "value_max", "value_mean", "value_min"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier by ship quarter, five features, aggregated and written once.

    Operators pass over their input more than once, so the aggregate is not left to be repeated.
    Inputs have two decimals, so sums rounded to four are the same number in any order of summation.
    """
    lines = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1)).cast("double")
    return materialize(lines.groupBy(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("report_date"),
    ).agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
        (F.round(F.sum("l_discount"), 2) / n).alias("discount"),
        (F.round(F.sum("l_tax"), 2) / n).alias("tax"),
        (F.round(F.sum("l_quantity"), 2) / n).alias("quantity"),
        n.alias("n_lines"),
    ), "supplier-panel")


def sparse_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier panel with features missing by a rule on key and quarter."""
    place = F.col("ticker").cast("bigint") + F.quarter("report_date") + F.year("report_date")
    holes = {"revenue": 7, "discount": 5, "tax": 3}
    panel = supplier_panel(spark, sf_dir)
    return panel.select("ticker", "report_date", *[
        F.when(place % holes[f] != 0, F.col(f)).alias(f) if f in holes else F.col(f)
        for f in FEATURES])


def planted_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier panel with the last quarter of its periods moved far away, to either side.

    21 of the 28 quarters stay, so the rows that stay are just those a robust fit with support 0.75
    should rest on.
    """
    supplier = F.col("ticker").cast("bigint")
    place = (F.year("report_date") - 1995) * 4 + F.quarter("report_date") - 1
    side = F.when((supplier + place) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    scales = {"revenue": 200000.0, "discount": 0.05, "tax": 0.04, "quantity": 25.0, "n_lines": 10.0}
    return supplier_panel(spark, sf_dir).select("ticker", "report_date", *[
        F.when(place >= 21, F.col(f) + side * (40 + (supplier * (i + 3) + place * (7 - i)) % 17)
               .cast("double") * F.lit(scale)).otherwise(F.col(f)).alias(f)
        for i, (f, scale) in enumerate(scales.items())])


def filing_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier panel with filing metadata, shaped like a flat filing table."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_name").alias("company_name"))
    day = F.date_format("report_date", "yyyy-MM-dd")
    return supplier_panel(spark, sf_dir).join(suppliers, "ticker", "left").select(
        "ticker", "company_name", F.lpad("ticker", 10, "0").alias("cik"),
        F.lit("10-Q").alias("form_type"), day.alias("report_date"),
        F.date_format(F.date_add("report_date", 40), "yyyy-MM-dd").alias("filing_date"),
        F.concat(F.lit("urn:filing:"), "ticker", F.lit(":"), day).alias("filing_url"),
        *FEATURES)


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User by week, four features of the event values."""
    return materialize(table(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("string").alias("ticker"),
        F.to_date(F.date_trunc("week", "ts")).alias("report_date"),
    ).agg(
        F.round(F.sum("value"), 2).alias("value_sum"), F.max("value").alias("value_max"),
        (F.round(F.sum("value"), 2) / F.count(F.lit(1)).cast("double")).alias("value_mean"),
        F.min("value").alias("value_min"),
    ), "event-panel")


def event_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User by week with filing metadata, in the columns of `filing_panel` that bundles need."""
    day = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    n = F.count(F.lit(1)).cast("double")
    grouped = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").cast("string").alias("ticker"), day.alias("report_date"),
    ).agg(
        F.round(F.sum("value"), 2).alias("revenue"),
        (F.round(F.sum("value"), 2) / n).alias("tax"),
        F.max("value").alias("quantity"), n.alias("n_lines"))
    return grouped.select(
        "ticker", F.concat(F.lit("User "), "ticker").alias("company_name"),
        F.lpad("ticker", 10, "0").alias("cik"), "report_date",
        F.date_format(F.date_add(F.to_date("report_date"), 40), "yyyy-MM-dd").alias("filing_date"),
        F.concat(F.lit("urn:filing:"), "ticker", F.lit(":"), "report_date").alias("filing_url"),
        "revenue", "tax", "quantity", "n_lines")


def account_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts for the earnings-quality score, as fixed combinations of the supplier measures."""
    p = supplier_panel(spark, sf_dir)
    r, d, t, q, n = (F.col(f) for f in FEATURES)
    return p.select(
        "ticker", "report_date",
        (r * t).alias("receivables"), r.alias("sales"), (r * (F.lit(0.5) + d)).alias("cogs"),
        (r * F.lit(0.8)).alias("current_assets"), (q * F.lit(1000.0)).alias("ppe"),
        (n * F.lit(100.0)).alias("securities"),
        (r * F.lit(2.0) + q * F.lit(1500.0) + n * F.lit(300.0)).alias("total_assets"),
        (q * F.lit(50.0) + n).alias("depreciation"), (r * d + n * F.lit(10.0)).alias("sga"),
        (r * F.lit(0.1)).alias("income"), (r * (F.lit(0.05) + t)).alias("cash_from_ops"),
        (r * F.lit(0.3) + n).alias("current_liabilities"),
        (q * F.lit(700.0)).alias("long_term_debt"))
