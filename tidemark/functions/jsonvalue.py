"""JSON text compared by value, inside the JVM.

``parse_json`` stops reading at the end of the first value, so text behind it would pass unseen; the value is
therefore parsed inside ``[...]``, where anything but one value is an error or a second element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _only(listed: Column) -> Column:
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def one_value(text: Column) -> Column:
    """The JSON text as a variant; null where it is null, blank or no single JSON value."""
    return _only(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))


def with_values(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """``df`` with a variant column for each JSON text, each text parsed once.

    The parsed list has a projection of its own: Catalyst does not merge projections whose expensive results are used
    more than once.
    """
    df = df.withColumns({f"{n}_list": F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))) for n, t in texts.items()})
    return df.withColumns({n: _only(F.col(f"{n}_list")) for n in texts}).drop(*[f"{n}_list" for n in texts])


def canonical_of(value: Column, text: Column) -> Column:
    """``canonical_json`` where the text's value is known."""
    return F.coalesce(F.to_json(value), F.concat(F.lit("\u0001"), text))


def object_of(value: Column, text: Column) -> Column:
    """``is_json_object`` where the text's value is known."""
    kind = F.schema_of_variant(value).startswith("OBJECT")
    repeated = F.size(F.array_distinct(F.json_object_keys(text))) < F.size(F.json_object_keys(text))
    return F.when(value.isNotNull(), kind).otherwise(F.coalesce(repeated, F.lit(False)))


def canonical_json(text: Column) -> Column:
    """One spelling for each JSON value: no spaces, sorted members, plain characters for escapes, 1.0 as 1.

    Text that is no JSON value stays as it is, behind a mark no JSON text begins with; null stays null.
    """
    return canonical_of(one_value(text), text)


def is_json_object(text: Column) -> Column:
    """True where the text is one JSON object (false for null). An object with a repeated member counts as one."""
    return object_of(one_value(text), text)


def is_json_null(text: Column) -> Column:
    """True where the text is absent or the JSON text ``null``."""
    return text.isNull() | (F.trim(F.regexp_replace(text, r"[\t\r\n]", " ")) == F.lit("null"))
