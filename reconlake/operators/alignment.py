"""Two schemas aligned column by column, as one was made from the other by inserting, dropping, moving and renaming.

Where a comparison by position calls every column behind an inserted one different, the alignment names the one
that was inserted. Any number of tables is aligned in one plan; a table's columns are the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.operators.discovery import TABLE

SAME, RETYPED, MOVED, RENAMED, DROPPED, INSERTED = "same", "retyped", "moved", "renamed", "dropped", "inserted"
_SIDES = ("source", "target")


def _chain(pairs: Column) -> Column:
    """Source positions of the longest run of pairs whose target positions rise, too; the first of several.

    ``pairs`` are structs of source and target position, sorted. Each learns from those behind it how long the
    longest run is that starts with it; one more pass then takes the first that still leads to the longest.
    """
    lengths = F.aggregate(
        F.reverse(pairs),
        F.expr("CAST(array() AS array<struct<s: int, t: int, n: int>>)"),
        lambda seen, p: F.array_append(
            seen,
            F.struct(
                p["s"].alias("s"),
                p["t"].alias("t"),
                (
                    F.coalesce(
                        F.array_max(F.transform(F.filter(seen, lambda q: q["t"] > p["t"]), lambda q: q["n"])), F.lit(0)
                    )
                    + 1
                ).alias("n"),
            ),
        ),
    )
    longest = F.coalesce(F.array_max(F.transform(lengths, lambda q: q["n"])), F.lit(0))
    start = F.struct(F.expr("CAST(array() AS array<int>)").alias("kept"), F.expr("CAST(NULL AS int)").alias("t"), longest.alias("n"))
    taken = F.aggregate(
        F.reverse(lengths),
        start,
        lambda so_far, q: F.when(
            (q["n"] == so_far["n"]) & (so_far["t"].isNull() | (q["t"] > so_far["t"])),
            F.struct(
                F.array_append(so_far["kept"], q["s"]).alias("kept"), q["t"].alias("t"), (so_far["n"] - 1).alias("n")
            ),
        ).otherwise(so_far),
    )
    return taken["kept"]


def _by_name(source_sheet: DataFrame, target_sheet: DataFrame) -> DataFrame:
    """One row per table and name: its position and type on either side. A repeated name is counted through."""

    def side(sheet: DataFrame, is_source: bool) -> DataFrame:
        name = F.lower("column_name")
        nth = F.row_number().over(Window.partitionBy(*TABLE, name).orderBy("ordinal_position", "data_type"))
        return sheet.select(
            *TABLE,
            name.alias("name"),
            nth.alias("nth"),
            F.lit(is_source).alias("is_source"),
            F.col("ordinal_position").cast("int").alias("position"),
            F.lower("data_type").alias("type"),
        )

    s = F.col("is_source")
    return (
        side(source_sheet, True)
        .unionByName(side(target_sheet, False))
        .groupBy(*TABLE, "name", "nth")
        .agg(
            F.max(F.when(s, F.col("position"))).alias("source_position"),
            F.max(F.when(s, F.col("type"))).alias("source_type"),
            F.max(F.when(~s, F.col("position"))).alias("target_position"),
            F.max(F.when(~s, F.col("type"))).alias("target_type"),
        )
    )


def align_schemas(source_sheet: DataFrame, target_sheet: DataFrame) -> DataFrame:
    """One row per column or pair of columns, with what happened to it.

    Columns of one name (in any letter case) are a pair. As many pairs as possible keep their order: these are
    ``same`` or ``retyped``, the others ``moved``, whatever their type. A column whose name the other side lacks
    is ``renamed`` if the other side has such a column of the same type between the same two columns that kept
    their order; several of a type are paired in their order. What is left was ``dropped`` or ``inserted``.
    Values are not looked at. A table that one side lacks has all its columns dropped or inserted.
    """
    entry = F.struct(
        "name", "nth", "source_position", "source_type", "target_position", "target_type"
    )
    both = F.col("source_position").isNotNull() & F.col("target_position").isNotNull()
    pair = F.struct(F.col("source_position").alias("s"), F.col("target_position").alias("t"))
    tables = _by_name(source_sheet, target_sheet).groupBy(*TABLE).agg(
        F.collect_list(entry).alias("columns"), F.sort_array(F.collect_list(F.when(both, pair))).alias("pairs")
    )
    columns = tables.select(*TABLE, "columns", _chain(F.col("pairs")).alias("kept")).select(
        *TABLE, "kept", F.inline("columns")
    )
    in_order = both & F.array_contains("kept", F.col("source_position"))
    columns = columns.select(*TABLE, "name", *[f"{s}_{c}" for s in _SIDES for c in ("position", "type")], in_order.alias("in_order"))
    change = (
        F.when(~F.col("in_order"), MOVED)
        .when(F.col("source_type").eqNullSafe(F.col("target_type")), SAME)
        .otherwise(RETYPED)
    )
    named = columns.filter(both).select(
        *TABLE, "source_position", F.col("name").alias("source_column"), "source_type",
        "target_position", F.col("name").alias("target_column"), "target_type", change.alias("change"),
    )

    def alone(side: str, other: str) -> DataFrame:
        place = Window.partitionBy(*TABLE).orderBy(f"{side}_position", "name")
        gaps = columns.filter(F.col(f"{side}_position").isNotNull()).select(
            *TABLE, "name", f"{side}_position", f"{side}_type", F.col(f"{other}_position").isNull().alias("alone"),
            F.sum(F.col("in_order").cast("int")).over(place).alias("gap"),
        )
        order = Window.partitionBy(*TABLE, "gap", f"{side}_type").orderBy(f"{side}_position", "name")
        return gaps.filter("alone").select(
            *TABLE, "gap", F.col(f"{side}_type").alias("type"), F.row_number().over(order).alias("k"),
            F.col(f"{side}_position").alias(f"{side}_position"), F.col("name").alias(f"{side}_column"),
        )

    unnamed = (
        alone("source", "target")
        .unionByName(alone("target", "source"), allowMissingColumns=True)
        .groupBy(*TABLE, "gap", "type", "k")
        .agg(*[F.max(f"{s}_{c}").alias(f"{s}_{c}") for s in _SIDES for c in ("position", "column")])
    )
    has_source, has_target = F.col("source_position").isNotNull(), F.col("target_position").isNotNull()
    unnamed = unnamed.select(
        *TABLE, "source_position", "source_column", F.when(has_source, F.col("type")).alias("source_type"),
        "target_position", "target_column", F.when(has_target, F.col("type")).alias("target_type"),
        F.when(has_source & has_target, RENAMED).when(has_source, DROPPED).otherwise(INSERTED).alias("change"),
    )
    return named.unionByName(unnamed)
