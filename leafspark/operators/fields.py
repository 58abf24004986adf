"""Statistics of free-form records, and rules over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NUMBERS = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT", "SMALLINT", "TINYINT")


def unpivoted(df: DataFrame, record: str, by: list[str] | None = None) -> DataFrame:
    """A row for each field of JSON object texts: key, kind (string, bool, number, other) and value.

    Texts that are no JSON, or no object, are skipped.
    """
    by = by or []
    rows = df.select(*by, F.try_parse_json(F.col(record)).alias("v")).filter(F.schema_of_variant("v").startswith("OBJECT"))
    flat = rows.lateralJoin(_exploded())
    kind = F.schema_of_variant("value")
    number = F.lit(False)
    for name in _NUMBERS:
        number = number | kind.startswith(name)
    named = F.when(kind == "BOOLEAN", "bool").when(kind == "STRING", "string").when(number, "number").otherwise("other")
    return flat.select(*by, "key", named.alias("kind"), "value")


def _exploded() -> DataFrame:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark.tvf.variant_explode(F.col("v").outer())


def field_stats(df: DataFrame, record: str) -> DataFrame:
    """Per key: counts by kind, distinct values, and the numbers' least, greatest and mean."""
    flat = unpivoted(df, record)
    number = F.when(F.col("kind") == "number", F.try_variant_get("value", "$", "double"))
    return flat.withColumn("number", number).groupBy("key").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("string", "bool", "number")],
        F.round(F.min("number"), 6).alias("least"),
        F.round(F.max("number"), 6).alias("greatest"),
        F.round(F.avg("number"), 6).alias("mean"),
    )


def dominant_kind(df: DataFrame, record: str) -> DataFrame:
    """Commonest kind of each key's values; ties go to bool, number, string in this order."""
    flat = unpivoted(df, record).groupBy("key", "kind").agg(F.count("*").alias("n"))
    rank = F.when(F.col("kind") == "bool", 3).when(F.col("kind") == "number", 2).when(F.col("kind") == "string", 1).otherwise(0)
    return flat.groupBy("key").agg(F.max_by("kind", F.struct("n", rank)).alias("kind"), F.max("n").alias("n"))


def value_distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts of values in each group, the commonest first, then by value."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), value)
    return counts.withColumn("place", F.row_number().over(w))


def warnings(df: DataFrame, by: list[str], rules: dict[str, Column]) -> DataFrame:
    """A row for each group and rule whose aggregate condition holds. One aggregation serves all rules."""
    found = df.groupBy(*by).agg(*[c.alias(name) for name, c in rules.items()])
    named = F.array(*[F.when(F.col(name), F.lit(name)) for name in rules])
    return found.select(*by, F.explode(F.array_compact(named)).alias("warning"))


def outcome_counts(df: DataFrame, by: list[str], status: str, statuses: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in statuses])


def settings_hash(columns: dict[str, Column]) -> Column:
    """First 16 hex digits of SHA-256 over sorted name=value pairs."""
    pairs = [F.concat(F.lit(f"{k}="), F.coalesce(c.cast("string"), F.lit("None"))) for k, c in sorted(columns.items())]
    return F.substring(F.sha2(F.concat_ws("|", *pairs), 256), 1, 16)
