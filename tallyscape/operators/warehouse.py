"""Star schema: typed targets with defaults, dimensions, fact loading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.functions.columns import column
from tallyscape.operators.keys import dense_keys, registered_keys
from tallyscape.operators.reshape import to_long

NOW = object()  # default that stands for the time of the load

# Defaults of the target tables.
DEFAULT_MEASURE = 0
DEFAULT_PERIOD = 2024
NAME_LENGTH = 100


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type: T.DataType
    default: object = None
    required: bool = False
    max_length: int | None = None
    unique: bool = False


def entity_target(key: str = "entity_id", name: str = "entity") -> list[TargetColumn]:
    return [
        TargetColumn(key, T.LongType(), required=True),
        TargetColumn(name, T.StringType(), required=True, max_length=NAME_LENGTH, unique=True),
    ]


def fact_target(
    key: str = "fact_id",
    entity_id: str = "entity_id",
    category_id: str = "category_id",
    measure: str = "measure",
    period: str = "period",
) -> list[TargetColumn]:
    return [
        TargetColumn(key, T.LongType(), required=True),
        TargetColumn(entity_id, T.LongType()),
        TargetColumn(category_id, T.LongType()),
        TargetColumn(measure, T.LongType(), default=DEFAULT_MEASURE, required=True),
        TargetColumn(period, T.IntegerType(), default=DEFAULT_PERIOD),
        TargetColumn("created_at", T.TimestampType(), default=NOW),
    ]


def assignment_target(key: str = "id", entity: str = "entity", cluster: str = "cluster_id") -> list[TargetColumn]:
    return [
        TargetColumn(key, T.LongType(), required=True),
        TargetColumn(entity, T.StringType(), required=True, max_length=NAME_LENGTH),
        TargetColumn(cluster, T.IntegerType(), required=True),
        TargetColumn("created_at", T.TimestampType(), default=NOW),
    ]


def wide_target(columns: Sequence[str], key: str = "id", entity: str = "entity") -> list[TargetColumn]:
    return [
        TargetColumn(key, T.LongType(), required=True),
        TargetColumn(entity, T.StringType(), required=True, max_length=NAME_LENGTH),
        *[TargetColumn(c, T.LongType(), default=DEFAULT_MEASURE) for c in columns],
        TargetColumn("created_at", T.TimestampType(), default=NOW),
    ]


def conform(df: DataFrame, target: Sequence[TargetColumn]) -> DataFrame:
    """Columns of the target in its order: cast, with defaults, absent ones added.

    A required column that is still null, or a name that is too long, makes the load
    raise when it runs.
    """
    out = []
    for t in target:
        value = column(t.name).cast(t.type) if t.name in df.columns else F.lit(None).cast(t.type)
        if t.default is not None:
            default = F.current_timestamp() if t.default is NOW else F.lit(t.default)
            value = F.coalesce(value, default.cast(t.type))
        if t.required:
            value = F.coalesce(value, F.raise_error(F.lit(f"{t.name} must not be null")))
        if t.max_length is not None:
            value = F.when(F.length(value) > t.max_length, F.raise_error(F.lit(f"{t.name} is too long"))).otherwise(
                value
            )
        out.append(value.alias(t.name))
    return df.select(*out)


def dimension(df: DataFrame, name: str, *, key: str = "id", registry: str | None = None) -> DataFrame:
    """The distinct non-null names, numbered from 1 in name order.

    With a ``registry`` folder a name has the key it got when it first came, and new ones are numbered after
    all others, so keys stay when rows are added; only names of ``df`` are returned.
    """
    if registry is not None:
        names = df.select(column(name)).filter(column(name).isNotNull()).distinct()
        return registered_keys(names, registry, name=name, key=key).join(names, name, "left_semi")
    return dense_keys(df.select(column(name)).filter(column(name).isNotNull()).distinct(), [name], key)


def add_missing_names(existing: DataFrame, incoming: DataFrame, *, name: str = "name", key: str = "id") -> DataFrame:
    """Dimension with the incoming names it lacked added after its last key.

    Loading the same names twice adds nothing, and existing keys never change.
    """
    new = (
        incoming.select(column(name))
        .filter(column(name).isNotNull())
        .distinct()
        .join(existing.select(column(name)), name, "left_anti")
    )
    last = existing.agg(F.coalesce(F.max(column(key)), F.lit(0)).cast("long").alias("last"))
    numbered = dense_keys(new, [name], key).withColumn(key, column(key) + last.scalar())
    kept = existing.select(column(key).cast("long").alias(key), column(name))
    return kept.unionByName(numbered.select(column(key), column(name)))


def repeated_values(df: DataFrame, target: Sequence[TargetColumn]) -> DataFrame:
    """column_name, value, rows: values that stand more than once in a unique column of the target."""
    found = [
        df.filter(column(t.name).isNotNull())
        .groupBy(column(t.name).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(F.lit(t.name).alias("column_name"), "value", "rows")
        for t in target
        if t.unique
    ]
    if not found:
        return df.sparkSession.createDataFrame([], "column_name string, value string, rows long")
    return reduce(DataFrame.unionByName, found)


def require_unique(df: DataFrame, target: Sequence[TargetColumn]) -> DataFrame:
    """``df``, once the unique columns of the target are known to hold no value twice; else it raises."""
    first = repeated_values(df, target).first()
    if first is not None:
        raise ValueError(f"{first.column_name} {first.value!r} stands {first.rows} times")
    return df


def unfit(target: Sequence[TargetColumn]) -> Column:
    """Whether ``conform`` would raise for a row: a required value missing, or a name too long."""
    bad = F.lit(False)
    for t in target:
        if t.required and t.default is None:
            bad = bad | column(t.name).isNull()
        if t.max_length is not None:
            bad = bad | F.coalesce(F.length(column(t.name)) > t.max_length, F.lit(False))
    return bad


def name_rejects(df: DataFrame, target: Sequence[TargetColumn]) -> DataFrame:
    """Rows that ``conform`` would raise for: a required value missing, or a name too long."""
    return df.filter(unfit(target))


def _keyed(
    wide: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    columns: Sequence[str],
    entity: str,
    period: str | int | None,
    category_column: str,
) -> DataFrame:
    """The unpivoted table with the ids found for it; an id that is not found is null."""
    year = column(period) if isinstance(period, str) else F.lit(period)
    ids = entities.select(F.col("entity_id").alias("_id"), column(entity).alias("_name"))
    keyed = wide.join(ids, column(entity) == F.col("_name"), "left").select(
        column(entity).alias("_entity"),
        F.col("_id").alias("entity_id"),
        F.coalesce(year.cast("int"), F.lit(DEFAULT_PERIOD)).alias("period"),
        *[column(c) for c in columns],
    )
    long = to_long(keyed, ["_entity", "entity_id", "period"], columns, category=category_column, measure="measure")
    return long.join(categories.select("category_id", category_column), category_column, "left")


def load_facts(
    wide: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    columns: Sequence[str],
    *,
    entity: str = "entity",
    period: str | int | None = None,
    category_column: str = "column_name",
    skip_rejects: bool = False,
) -> DataFrame:
    """Fill the fact table from a wide table.

    ``entities`` has ``entity_id`` and the name column.  ``categories`` has
    ``category_id`` and, in ``category_column``, the wide column each category stands
    for, so display names and column names may differ.  ``period`` is a column of the
    wide table, a year, or None for the default.  Ids are joined while there is still
    one row per entity; unpivoting first would shuffle a row per category as well.

    A row whose entity or category is unknown raises, unless ``skip_rejects`` leaves such rows to
    ``fact_rejects``.  Facts are numbered in the order of entity, category and period; one that
    comes twice raises.
    """
    found = _keyed(wide, entities, categories, columns, entity, period, category_column)
    known = F.col("entity_id").isNotNull() & F.col("category_id").isNotNull()
    if skip_rejects:
        found = found.filter(known)
    else:
        unknown = F.raise_error(F.concat(F.lit("no id for "), F.coalesce("_entity", F.lit("null")), F.lit(" or "), category_column))
        found = found.withColumn("entity_id", F.when(known, F.col("entity_id")).otherwise(unknown.cast("long")))
    parts = ["entity_id", "category_id", "period"]
    numbered = dense_keys(found.select(*parts, "measure"), parts, "fact_id")
    twice = numbered.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"more than one fact for {twice.asDict()}")
    return conform(numbered, fact_target())


def fact_rejects(
    wide: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    columns: Sequence[str],
    *,
    entity: str = "entity",
    period: str | int | None = None,
    category_column: str = "column_name",
) -> DataFrame:
    """What ``load_facts`` has no place for: entity, column, period, measure, and which id is missing."""
    found = _keyed(wide, entities, categories, columns, entity, period, category_column)
    missing = F.when(F.col("entity_id").isNull(), "entity").when(F.col("category_id").isNull(), "category")
    return found.select(
        F.col("_entity").alias("entity"), column(category_column), "period", "measure", missing.alias("missing")
    ).filter(F.col("missing").isNotNull())


def key_violations(facts: DataFrame, dimension_table: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension; a null key is no violation."""
    return facts.filter(column(key).isNotNull()).join(dimension_table.select(column(key)), key, "left_anti")


def valid_facts(facts: DataFrame, dimension_table: DataFrame, key: str) -> DataFrame:
    """All other rows: those with a key of the dimension, and those with none."""
    matched = facts.join(dimension_table.select(column(key)), key, "left_semi")
    return matched.unionByName(facts.filter(column(key).isNull()))


def store_facts(
    facts: DataFrame,
    table: str,
    path: str,
    *,
    buckets: int,
    entity_id: str = "entity_id",
    period: str = "period",
) -> DataFrame:
    """Write the facts as a table of the catalogue, a folder for each period, in buckets sorted by entity.

    Reports per entity and joins by entity then need no shuffle of the facts, and those of one period read its
    folder only.  Rows are placed by bucket before, so a period has one file for each bucket.  ``buckets`` should
    leave some 256 MB to a bucket of all periods.  An entity has at most a fact for each category and period,
    so none outgrows its bucket.  A table of that name is replaced.
    """
    placed = facts.repartition(buckets, column(entity_id))
    writer = placed.write.format("parquet").mode("overwrite").option("path", path)
    writer.partitionBy(period).bucketBy(buckets, entity_id).sortBy(entity_id).saveAsTable(table)
    return facts.sparkSession.table(table)
