"""Retail tables as lazy views over the star schema (lineitem, orders, part, ...).

The panel is `lineitem` rolled up to one row per day, store and family. The roll
up is a partial aggregate before its shuffle, so a hot part or supplier costs
CPU, not one overloaded task; the joins below it carry no broadcast hint: the
planner broadcasts a dimension only when its size is under the threshold, and
adaptive skew handling splits a hot key otherwise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Retail:
    """Retail tables derived from one folder of star-schema parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def shipments(self) -> DataFrame:
        """lineitem with its store, one row per line."""
        lines = self.table("lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_nbr")
        )
        return lines.join(suppliers, "l_suppkey")

    @cached_property
    def panel(self) -> DataFrame:
        parts = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family")
        )
        promo = F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)
        line_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return (
            self.shipments.join(parts, "l_partkey")
            .groupBy("date", "store_nbr", "family")
            .agg(
                F.min(line_id).alias("id"),
                F.sum("l_quantity").alias("sales"),
                F.sum(promo).cast("double").alias("onpromotion"),
            )
            .select("id", "date", "store_nbr", "family", "sales", "onpromotion")
        )

    @cached_property
    def transactions(self) -> DataFrame:
        # distinct orders first: two partial aggregates instead of one wide set per day
        return (
            self.shipments.select("date", "store_nbr", "l_orderkey")
            .distinct()
            .groupBy("date", "store_nbr")
            .agg(F.count(F.lit(1)).cast("double").alias("transactions"))
        )

    @cached_property
    def stores(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        key = F.col("n_nationkey")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            key.alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.substring(F.lit("ABCDE"), (key % 5 + 1).cast("int"), F.lit(1)).alias("type"),
            (key % 17 + 1).cast("int").alias("cluster"),
        )

    @cached_property
    def oil(self) -> DataFrame:
        """Weekday price series; weekends are absent."""
        return (
            self.table("orders")
            .select(F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
            .filter(F.weekday("date") < 5)
            .groupBy("date")
            .agg(F.max("o_totalprice").alias("dcoilwtico"))
        )

    @cached_property
    def prices(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(F.col("p_type").alias("family"))
            .agg(F.round(F.avg("p_retailprice") / 100, 4).alias("price"))
            .withColumn("margin_rate", F.lit(0.25))
            .withColumn("holding_cost", F.lit(0.05))
        )

    @cached_property
    def holiday_rules(self) -> DataFrame:
        """Month and day of every holiday by place; national rules occur twice."""
        # Month and day of the national holidays.
        national = self.spark.createDataFrame(
            [(m, d) for m, d in [(1, 1), (5, 1), (12, 1), (12, 25)]] * 2, "m int, d int"
        )
        region, nation = self.table("region"), self.table("nation")

        def rules(df: DataFrame, kind: str, locale: str, place, text: str, m, d) -> DataFrame:
            return df.select(
                F.lit(kind).alias("type"),
                F.lit(locale).alias("locale"),
                place.alias("locale_name"),
                F.lit(text).alias("description"),
                m.cast("int").alias("m"),
                d.cast("int").alias("d"),
            )

        key = F.col("n_nationkey")
        return (
            rules(national, "Holiday", "National", F.lit("ALL"), "n", F.col("m"), F.col("d"))
            .unionByName(
                rules(
                    region,
                    "Holiday",
                    "Regional",
                    F.col("r_name"),
                    "r",
                    F.col("r_regionkey") + 2,
                    F.lit(10),
                )
            )
            .unionByName(
                rules(nation, "Event", "Local", F.col("n_name"), "l", key % 12 + 1, key % 28 + 1)
            )
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """Holiday rules on the shipping dates: one pass over the dates, joined by day."""
        days = (
            self.table("lineitem")
            .select(F.col("l_shipdate").cast("date").alias("date"))
            .distinct()
            .select("date", F.month("date").alias("m"), F.dayofmonth("date").alias("d"))
        )
        moved = (F.col("locale") == "National") & (F.col("m") == 5) & (F.year("date") % 4 == 0)
        return days.join(self.holiday_rules, ["m", "d"]).select(
            "date", "type", "locale", "locale_name", "description", moved.alias("transferred")
        )

    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "train": self.panel,
            "transactions": self.transactions,
            "oil": self.oil,
            "holidays_events": self.holidays,
            "stores": self.stores,
        }
