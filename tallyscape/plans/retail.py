"""The given order tables seen as counts by place, category and period.

entity = customer, category = part type, period = year of the order, measure = quantity.
"""

from __future__ import annotations

from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.text import snake_name
from tallyscape.operators import cluster, features, reshape, warehouse
from tallyscape.session import checkpoint_dir, materialise
from tallyscape.sources.files import read_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Retail:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.stored = False
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once."""
        if name not in self._tables:
            self._tables[name] = read_parquet(self.spark, f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # ---- dimensions ------------------------------------------------------------

    @cached_property
    def entities(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity"))

    @cached_property
    def categories(self) -> DataFrame:
        names = self.table("part").select(F.col("p_type").alias("category"))
        return warehouse.dimension(names, "category", key="category_id")

    @cached_property
    def category_names(self) -> list[str]:
        return reshape.category_values(self.table("part"), "p_type")

    @cached_property
    def measures(self) -> list[str]:
        """Column names of the wide table."""
        return [snake_name(c) for c in self.category_names]

    # ---- facts -----------------------------------------------------------------

    def _sales(self, parts: DataFrame) -> DataFrame:
        """Order lines with customer, year and what ``parts`` brings.

        Which side of each join is broadcast is left to the sizes Spark sees; a part or
        customer with very many lines is split by the adaptive skew handling, as the
        aggregation that follows shuffles on other keys anyway.
        """
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("entity_id"),
            F.year("o_orderdate").alias("period"),
        )
        return (
            lines.join(parts.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
            .join(orders, "l_orderkey")
            .withColumn("quantity", F.col("l_quantity").cast("long"))
        )

    @cached_property
    def lines(self) -> DataFrame:
        """(entity_id, category, period, quantity) of every order line."""
        parts = self.table("part").select("p_partkey", F.col("p_type").alias("category"))
        return self._sales(parts).select("entity_id", "category", "period", "quantity")

    @cached_property
    def long(self) -> DataFrame:
        """(entity_id, category, period, measure), one row per combination."""
        return self.lines.groupBy("entity_id", "category", "period").agg(F.sum("quantity").alias("measure"))

    @cached_property
    def facts(self) -> DataFrame:
        """The fact table of the star: ids instead of names, and its own key."""
        parts = (
            self.table("part")
            .select("p_partkey", F.col("p_type").alias("category"))
            .join(self.categories, "category")
            .select("p_partkey", "category_id")
        )
        return (
            self._sales(parts)
            .groupBy("entity_id", "category_id", "period")
            .agg(F.sum("quantity").alias("measure"))
            .withColumn("fact_id", F.xxhash64("entity_id", "category_id", "period"))
        )

    def with_stored_facts(self) -> Retail:
        """Load the fact table first, for reports that read it more than once.

        The wide table is then pivoted from it, so the order lines are joined once.
        """
        loaded = Retail(self.spark, self.folder)
        loaded.categories = self.categories
        loaded.facts = materialise(self.facts, "facts")
        loaded.long = loaded.facts.join(self.categories, "category_id").select(
            "entity_id", "category", "period", "measure"
        )
        loaded.stored, loaded._tables = True, self._tables
        return loaded

    @cached_property
    def stored_star(self) -> DataFrame:
        """The fact table in buckets by customer and a folder for each period."""
        name = f"facts_{uuid4().hex}"
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/{self.spark.sparkContext.applicationId}/{name}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return warehouse.store_facts(self.facts, name, path, buckets=buckets)

    # ---- wide table and clusters -------------------------------------------------

    def _widen(self, rows: DataFrame, measure: str) -> DataFrame:
        wide = reshape.to_wide(rows, "entity_id", "category", measure, values=self.category_names)
        return reshape.rename(wide, dict(zip(self.category_names, self.measures)))

    def wide_plan(self) -> DataFrame:
        if self.stored:
            return self._widen(self.long, "measure")
        return self._widen(self.lines, "quantity")

    @cached_property
    def wide(self) -> DataFrame:
        """One row per customer, written once because scaling and clustering read it often."""
        return materialise(self.wide_plan(), "wide")

    @property
    def scaled_measures(self) -> list[str]:
        return [f"{c}_z" for c in self.measures]

    @cached_property
    def scaled(self) -> DataFrame:
        """Wide table with the standardised measures beside the plain ones."""
        return features.standardise(self.wide, self.measures, suffix="_z")

    @cached_property
    def centres(self) -> DataFrame:
        """The mean scaled profile of each market segment, numbered from 0 in name order."""
        segments = self.table("customer").select(F.col("c_custkey").alias("entity_id"), "c_mktsegment")
        means = cluster.moments(self.scaled.join(segments, "entity_id"), self.scaled_measures, "c_mktsegment")
        # one row per segment is left
        number = F.row_number().over(Window.orderBy("cluster_id")) - 1
        return means.select(number.alias("cluster_id"), "centre")

    @cached_property
    def nearest(self) -> DataFrame:
        """Scaled wide table with the nearest segment profile of every customer."""
        return cluster.nearest_centre(self.scaled, features.as_array(self.scaled_measures), self.centres)

    @cached_property
    def named_wide(self) -> DataFrame:
        """Wide table by customer name."""
        return self.wide.join(self.entities, "entity_id").select("entity", *self.measures)

    @cached_property
    def clustered(self) -> DataFrame:
        """Wide table by customer name with the assigned cluster."""
        return self.nearest.join(self.entities, "entity_id").select("entity", *self.measures, "cluster_id")

    @property
    def assignment(self) -> DataFrame:
        """(entity, cluster_id), by customer name."""
        return self.clustered.select("entity", "cluster_id")
