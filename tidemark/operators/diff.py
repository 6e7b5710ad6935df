"""Differences between two copies of a dataset, field by field.

Both sides are tagged, united and grouped once by key; one struct per side is collected and the fields of the two
structs are compared by a generated expression over an array of (name, equal) pairs.  One shuffle, no join, and the
partial aggregation brings rows written twice down to one before the shuffle, also for a hot key.

Defined results: null equals null and nothing else; arrays are equal with equal elements in equal order; a column that
only one copy has counts as null in the other; if a copy holds different rows under one key, which is told by the least
and greatest of their 64-bit digests, the key is reported as ``ambiguous_left`` or ``ambiguous_right`` (names can be
given) beside the differences of its greatest row (by the columns in order; any one, if a column cannot be ordered); a
null key is a key like others; empty copies give rows of the other side only.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, T.StructType) or all(_orderable(f.dataType) for f in kind)


def comparable(column: Column, kind: T.DataType) -> Column:
    """Maps have no equality of their own: they are compared as sorted entries; variants as canonical text."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if isinstance(kind, T.VariantType) else column


def compare_copies(
    left: DataFrame, right: DataFrame, key: str, names: tuple[str, str] = ("only_primary", "only_replica"), ignore: Collection[str] = (),
    ambiguous: tuple[str, str] = ("ambiguous_left", "ambiguous_right"),
) -> DataFrame:
    """(key, finding, field_name): rows missing from either copy, one row for each field that differs, ambiguous keys."""
    kinds = {f.name: f.dataType for side in (right, left) for f in side.schema}
    fields = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c != key and c not in ignore]
    whole = all(_orderable(kinds[c]) or isinstance(kinds[c], (T.MapType, T.VariantType)) for c in fields)

    def side(df: DataFrame, tag: int) -> DataFrame:
        own = set(df.columns)
        values = [
            (comparable(df[c], kinds[c]) if c in own else F.lit(None).cast(kinds[c])).alias(f"f{i}") for i, c in enumerate(fields)
        ]
        rows = df.select(df[key].alias("_key"), F.lit(tag).alias("_side"), F.struct(F.lit(1).alias("_there"), *values).alias("_row"))
        parts = [x for i in range(len(fields)) for x in (F.col("_row")[f"f{i}"], F.col("_row")[f"f{i}"].isNull())]
        return rows.withColumn("_hash", F.xxhash64(*parts) if parts else F.lit(0).cast("bigint"))

    pick = F.max if whole else F.any_value

    def one(tag: int) -> Column:
        value = F.when(F.col("_side") == tag, F.col("_row"))
        return (pick(value) if whole else F.any_value(value, F.lit(True))).alias(f"_{tag}")

    several = []
    for tag in (0, 1):
        digest = F.when(F.col("_side") == tag, F.col("_hash"))
        several.append((F.min(digest) != F.max(digest)).alias(f"_several_{tag}"))
    grouped = side(left, 0).unionByName(side(right, 1)).groupBy("_key").agg(one(0), one(1), *several)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col("_0")[f"f{i}"].eqNullSafe(F.col("_1")[f"f{i}"]).alias("equal")) for i, c in enumerate(fields)]
    )
    differing = F.transform(F.filter(pairs, lambda p: ~p["equal"]), lambda p: F.struct(F.lit("differs").alias("finding"), p["name"].alias("field_name")))
    missing = lambda name: F.array(F.struct(F.lit(name).alias("finding"), F.lit("").alias("field_name")))
    findings = F.when(F.col("_1").isNull(), missing(names[0])).when(F.col("_0").isNull(), missing(names[1])).otherwise(differing if fields else F.slice(missing(""), 1, 0))
    for tag, name in enumerate(ambiguous):
        findings = F.concat(findings, F.when(F.col(f"_several_{tag}"), missing(name)).otherwise(F.slice(missing(""), 1, 0)))
    return grouped.select(F.col("_key").alias(key), F.explode(findings).alias("_f")).select(key, "_f.finding", "_f.field_name")
