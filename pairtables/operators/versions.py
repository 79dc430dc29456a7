"""Versioned outputs: latest version, retention, and the endpoint that serves a version.

Versions are text and are compared as numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairtables import fixed_values as fixed
from pairtables.operators.lookup import lookup_join, null_key


def version_number(col: Column) -> Column:
    """A version as a number; -1 if it is none."""
    return F.coalesce(col.try_cast("bigint"), F.lit(-1).cast("bigint"))


def latest_version(df: DataFrame) -> DataFrame:
    """The highest version per name; null if no version of the name is a number."""
    return df.groupBy("name").agg(F.max(F.col("version").try_cast("bigint")).alias("latest"))


def retain_versions(df: DataFrame, keep: int = fixed.KEEP_VERSIONS, key: str = "version") -> DataFrame:
    """Mark every version past the ``keep`` highest of its name as ``Archived``.

    Versions are ordered by number, then by text, then by ``key``, which tells the rows of a
    name apart, so exactly ``keep`` rows of a name stay; rows without a name are one name.
    Only the lowest kept row per name is looked for, and each map task passes on at most
    ``keep`` rows of a name.
    """
    place = F.struct(version_number(F.col("version")).alias("number"), F.col("version"), F.col(key).alias("key"))
    keyed = df.withColumn("_name", null_key("name")).withColumn("_place", place)
    ranked = Window.partitionBy("_name").orderBy(F.desc("_place"))
    cut = (
        keyed.select("_name", "_place")
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= keep)
        .groupBy("_name")
        .agg(F.min("_place").alias("_lowest"))
    )
    kept = F.coalesce(F.col("_place") >= F.col("_lowest"), F.lit(False))
    return lookup_join(keyed, cut, ["_name"], "version").select(
        *[c for c in df.columns if c != "stage"],
        F.when(kept, F.col("stage")).otherwise(F.lit("Archived")).alias("stage"),
    )


def resolve_endpoint(requests: DataFrame, served: DataFrame, spread: str = "request_id") -> DataFrame:
    """The endpoint that serves ``(name, version)``: that very version, else the newest.

    ``served`` holds ``(endpoint, entity_name, entity_version)``. It is brought to one row
    per name and version, and to one per name, before it is looked up, so requests and
    served entities of a name are never paired. Among equals the endpoint that sorts first
    is taken. A name that nothing serves gets an ``error``.
    """
    exact = served.groupBy(
        F.col("entity_name").alias("name"),
        version_number(F.col("entity_version")).alias("version"),
    ).agg(F.min("endpoint").alias("_exact"))
    newest = exact.groupBy("name").agg(F.max_by("_exact", "version").alias("_newest"))
    found = lookup_join(requests, exact, ["name", "version"], spread)
    found = lookup_join(found, newest, ["name"], spread)
    endpoint = F.coalesce("_exact", "_newest")
    return found.select(
        *requests.columns,
        endpoint.alias("endpoint"),
        F.when(endpoint.isNull(), F.concat(F.lit("no endpoint serves "), F.col("name"))).alias("error"),
    )
