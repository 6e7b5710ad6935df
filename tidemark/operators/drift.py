"""Schemas that drift between files: tagged-union inference over JSON payloads.

Every task infers the union of the shapes it reads - per path the alternative types with their counts - and the partial
unions are fused by one aggregation.  Conflicting types are never coerced away: ``unified`` gives each value its typed
branch beside one canonical conversion, and ``report`` names each alternative that appears, goes, or changes.

Payloads are parsed in Arrow batches because the report needs what a JVM parser drops: whether a number was written
with a point, and members that repeat.  What leaves the batches is small (partial unions; digests of the values of
fields that may have been renamed), so the shuffles do not carry payloads.

Defined results: text that is not one JSON object is ignored; of members that repeat within an object the last counts;
an empty object is no field; numbers are equal by value (1 and 1.0), a boolean equals no number; a field without any
non-null value has no type and is never retyped; types that are equally common rank as listed in ``TYPES``; where
several pairs of fields could be a renaming, the pair with the largest share of equal values is taken first.
"""

from __future__ import annotations

import hashlib
import json
import json.scanner
import math
import re
import sys
from collections.abc import Iterable, Iterator
from decimal import MAX_EMAX, MAX_PREC, MIN_EMIN, Context, Decimal, InvalidOperation

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.shipping import ship

#: The tags of the union.
TYPES = ("string", "integer", "decimal", "boolean", "array")
SHAPE = ["resource_ref", "schema_version", "schema_fingerprint"]
#: A task hands its partial union on when it has so many entries, so members with ever new names do not fill memory.
PARTIAL_ENTRIES = 100_000
#: Shapes that may have renamed fields are broadcast up to this number; beyond, they are joined by a shuffle.
BROADCAST_SHAPES = 10_000


class Point(str):
    """A number written with a point or an exponent, kept as text."""


class Whole(str):
    """A whole number with more digits than Python turns into a number, kept as text."""


def _reject(text: str):
    raise ValueError(text)


_decode_plain = json.JSONDecoder(parse_float=Point, parse_constant=_reject, strict=True).decode
_MANY_DIGITS = re.compile(r"[0-9]{4300}")


class _Deep(json.JSONDecoder):
    """The same without bounds: every number stays text, and nesting takes memory but no stack of the interpreter."""

    def __init__(self) -> None:
        super().__init__(parse_float=Point, parse_int=Whole, parse_constant=_reject, strict=True)
        self.scan_once = json.scanner.py_make_scanner(self)


def _deeply(call, *args):
    """Call a function that recurses as deep as its argument is nested (Python frames lie on the heap)."""
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(1 << 30)
    try:
        return call(*args)
    finally:
        sys.setrecursionlimit(before)


def _decode(text: str):
    try:
        return _decode_plain(text)
    except RecursionError:
        return _deeply(_Deep().decode, text)
    except ValueError:
        if _MANY_DIGITS.search(text):
            return _deeply(_Deep().decode, text)
        raise


def parse_object(text: str | None) -> dict | None:
    """The object of a payload, or None. Numbers of any length and values nested to any depth are read."""
    if not text:
        return None
    try:
        value = _decode(text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def fields(value: dict) -> Iterator[tuple[str, object]]:
    """(JSON pointer, value) of each member that is not an object, also below nested objects."""
    open_ = [("", value)]
    while open_:
        above, members = open_.pop()
        for name, x in members.items():
            path = f"{above}/{name.replace('~', '~0').replace('/', '~1')}"
            if isinstance(x, dict):
                open_.append((path, x))
            else:
                yield path, x


def tag(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, Point):
        return "decimal"
    if isinstance(value, int | Whole):
        return "integer"
    return "string" if isinstance(value, str) else "array"


def _number(text: str) -> str:
    """One spelling of a number, whatever its length: digits without zeros at the ends, and an exponent if it is far off."""
    if text[-1] != "0" and text.isascii() and text.isdigit():
        return text.lstrip("0")
    try:
        sign, digits, exponent = Decimal(text).as_tuple()
    except InvalidOperation:
        return text
    figures = "".join(map(str, digits)).lstrip("0")
    kept = figures.rstrip("0")
    if not kept:
        return "0"
    exponent += len(figures) - len(kept)
    if 0 <= exponent <= 20:
        kept += "0" * exponent
    elif -20 <= exponent < 0:
        kept = kept.zfill(1 - exponent)
        kept = f"{kept[:exponent]}.{kept[exponent:]}"
    else:
        kept += f"E{exponent}"
    return "-" + kept if sign else kept


def canonical(value: object) -> str:
    """One text for each JSON value."""
    try:
        return _canonical(value)
    except RecursionError:
        return _deeply(_canonical, value)


def _canonical(value: object) -> str:
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    if isinstance(value, Point | Whole | int):
        return _number(str(value))
    if isinstance(value, str):
        return json.dumps(value)
    if isinstance(value, list):
        return "[" + ",".join([_canonical(v) for v in value]) + "]"
    return "{" + ",".join([f"{json.dumps(k)}:{_canonical(v)}" for k, v in sorted(value.items())]) + "}"


def canonical_text(text: str | None) -> str | None:
    """The canonical spelling of a JSON text; what is no JSON stays apart, as it is."""
    if text is None:
        return None
    if len(text) > 2 and text[0] == text[-1] == '"' and text.isascii() and text[1:-1].replace("-", "").replace("/", "").isalnum():
        return text  # the common case needs no parser
    try:
        return canonical(_decode(text))
    except ValueError:
        return "\u0001" + text


def _columns(batch: pa.RecordBatch) -> list[list]:
    return [c.to_pylist() for c in batch.columns]


_UNION = pa.schema([(c, pa.string()) for c in (*SHAPE, "field", "type")] + [("n", pa.int64()), ("first", pa.int64())])


def _partial_unions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shape: the number of payloads, the smallest sequence, and per field and type the number of values."""
    counts: dict[tuple, int] = {}
    first: dict[tuple, int] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(*shape, None, None, 0, s) for shape, s in first.items()] + [(*shape, f, t, n, None) for (shape, f, t), n in counts.items()]
        counts.clear()
        first.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), _UNION)], schema=_UNION)

    for batch in batches:
        resource, version, fingerprint, sequence, payload = _columns(batch)
        for shape, s, text in zip(zip(resource, version, fingerprint), sequence, payload):
            if s is not None and s < first.get(shape, s + 1):
                first[shape] = s
            value = parse_object(text)
            if value is None:
                continue
            key = (shape, "", None)
            counts[key] = counts.get(key, 0) + 1
            for path, x in fields(value):
                key = (shape, path, tag(x))
                counts[key] = counts.get(key, 0) + 1
        if len(counts) > PARTIAL_ENTRIES:
            yield from flush()
    yield from flush()


def fused_schema(rows: DataFrame) -> DataFrame:
    """(shape, field, type, n, first): the tagged union of all payloads; the empty field counts payloads.

    ``rows`` has the columns of the shape, ``source_sequence`` and ``payload``.
    """
    ship(rows.sparkSession)
    kept = rows.select(*SHAPE, F.col("source_sequence").cast("bigint"), "payload").filter("resource_ref is not null and schema_version is not null and schema_fingerprint is not null")
    parts = kept.mapInArrow(_partial_unions, "resource_ref string, schema_version string, schema_fingerprint string, field string, type string, n bigint, first bigint")
    return parts.groupBy(*SHAPE, "field", "type").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def shape_fields(fused: DataFrame, share: float = 0.1) -> DataFrame:
    """(shape, place, field, type): the fields each shape has, the shapes of a resource numbered in their order."""
    shapes = fused.groupBy(*SHAPE).agg(F.min("first").alias("first"), F.sum(F.when(F.col("field") == "", F.col("n"))).alias("payloads")).filter("payloads > 0")
    place = F.row_number().over(W.partitionBy("resource_ref").orderBy("first", "schema_version", "schema_fingerprint"))
    order = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("type"))
    per_field = fused.filter("field <> ''").groupBy(*SHAPE, "field").agg(
        F.sum("n").alias("carried"), F.max_by("type", F.when(F.col("type").isNotNull(), F.struct("n", -order))).alias("type")
    )
    numbered = shapes.select(*SHAPE, "payloads", place.alias("place"))
    return numbered.join(per_field, SHAPE, "left").filter(F.col("field").isNull() | (F.col("carried") >= F.col("payloads") * F.lit(share))).select(*SHAPE, "place", "field", "type")


_VALUES = pa.schema([("pair", pa.int64()), ("record", pa.binary()), ("old", pa.bool_()), ("sequence", pa.int64()), ("delivery", pa.int64()), ("vals", pa.list_(pa.int64()))])


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _candidate_values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each payload of a shape that may have lost or gained a renamed field: digests of those fields' values."""
    for batch in batches:
        out = []
        for resource, scope, record, sequence, delivery, payload, as_old, old_fields, as_new, new_fields in zip(*_columns(batch)):
            value = parse_object(payload)
            if value is None:
                continue
            found = dict(fields(value))
            key = hashlib.blake2b(f"{resource}\0{scope}\0{canonical_text(record)}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            for pair, names, old in ((as_old, old_fields, True), (as_new, new_fields, False)):
                if pair is not None:
                    values = [None if (x := found.get(n)) is None else _digest(canonical(x)) for n in names]
                    out.append((pair, key, old, sequence, delivery, values))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*out), _VALUES)], schema=_VALUES)


def _one_to_one(pdf):
    """The best pair first; each field takes part in one renaming at most."""
    import pandas as pd

    taken_old, taken_new, kept = set(), set(), []
    ranked = pdf.assign(share=pdf.equal / pdf.both).sort_values(["share", "equal", "old_field", "new_field"], ascending=[False, False, True, True])
    for row in ranked.itertuples():
        if row.old_field not in taken_old and row.new_field not in taken_new:
            taken_old.add(row.old_field)
            taken_new.add(row.new_field)
            kept.append((row.pair, row.old_field, row.new_field))
    return pd.DataFrame(kept, columns=["pair", "old_field", "new_field"])


def _likely(sides: DataFrame) -> DataFrame:
    """(pair, cells): the (i, j) that could be renamings, from the fields with equal digests in a record.

    Only equal fields are paired.  How many records have both fields is bounded from below by the numbers that have each,
    which leaves few pairs to be counted out.
    """
    equal = sides.select("pair", "first", F.posexplode("last").alias("i", "a")).filter("a is not null")
    equal = equal.select("pair", "i", F.explode(F.expr("filter(transform(first, (b, j) -> if(b = a, j, null)), j -> j is not null)")).alias("j"))
    equal = equal.groupBy("pair", "i", "j").agg(F.count(F.lit(1)).alias("equal"))
    having = lambda side, name: sides.select("pair", F.posexplode(side).alias(name, "x")).filter("x is not null").groupBy("pair", name).agg(F.count(F.lit(1)).alias(f"n_{name}"))
    known = equal.join(having("last", "i"), ["pair", "i"]).join(having("first", "j"), ["pair", "j"]).join(sides.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair")
    return known.filter(F.col("equal") * 2 > F.col("n_i") + F.col("n_j") - F.col("n")).groupBy("pair").agg(F.collect_list(F.struct("i", "j")).alias("cells"))


def renamings(rows: DataFrame, gone: DataFrame, checkpoint) -> DataFrame:
    """(pair, old_field, new_field).

    ``gone`` has one row per pair of neighbouring shapes with fields that went and fields that came: ``pair``,
    ``resource_ref``, ``old_version``, ``old_fingerprint``, ``new_version``, ``new_fingerprint``, ``old_fields``, ``new_fields``.
    """
    roles = gone.select("resource_ref", F.col("old_version").alias("schema_version"), F.col("old_fingerprint").alias("schema_fingerprint"),
                        F.col("pair").alias("as_old"), "old_fields", F.lit(None).cast("bigint").alias("as_new"), F.lit(None).cast("array<string>").alias("new_fields"))
    roles = roles.unionByName(gone.select("resource_ref", F.col("new_version").alias("schema_version"), F.col("new_fingerprint").alias("schema_fingerprint"),
                        F.lit(None).cast("bigint").alias("as_old"), F.lit(None).cast("array<string>").alias("old_fields"), F.col("pair").alias("as_new"), "new_fields"))
    roles = roles.groupBy(*SHAPE).agg(*[F.max(c).alias(c) for c in ("as_old", "old_fields", "as_new", "new_fields")])
    if gone.limit(BROADCAST_SHAPES + 1).count() <= BROADCAST_SHAPES:
        roles, gone = F.broadcast(roles), F.broadcast(gone)
    wanted = rows.select(*SHAPE, "scope_fingerprint", "record_id", F.col("source_sequence").cast("bigint"), F.col("delivery_id").cast("bigint"), "payload").join(roles, SHAPE)
    wanted = wanted.select("resource_ref", "scope_fingerprint", "record_id", "source_sequence", "delivery_id", "payload", "as_old", "old_fields", "as_new", "new_fields")
    values = wanted.mapInArrow(_candidate_values, "pair bigint, record binary, old boolean, sequence bigint, delivery bigint, vals array<bigint>")
    at = F.struct("sequence", "delivery")
    sides = values.groupBy("pair", "record").agg(
        F.max_by("vals", F.when(F.col("old"), at)).alias("last"), F.min_by("vals", F.when(~F.col("old"), at)).alias("first")
    ).filter("last is not null and first is not null")
    sides = checkpoint(sides, "sides")
    cells = checkpoint(_likely(sides), "cells")
    cells = F.broadcast(cells) if cells.limit(BROADCAST_SHAPES + 1).count() <= BROADCAST_SHAPES else cells
    both = sides.join(cells, "pair").select("pair", "last", "first", F.explode("cells").alias("c"))
    both = both.select("pair", "c.*", F.col("last")[F.col("c.i")].alias("a"), F.col("first")[F.col("c.j")].alias("b")).filter("a is not null and b is not null")
    counted = both.groupBy("pair", "i", "j").agg(F.count(F.lit(1)).alias("both"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("equal")).filter("equal * 2 > both")
    named = counted.join(gone, "pair").select("pair", F.col("old_fields")[F.col("i")].alias("old_field"), F.col("new_fields")[F.col("j")].alias("new_field"), "both", "equal")
    return named.groupBy("pair").applyInPandas(_one_to_one, "pair bigint, old_field string, new_field string")


def report(rows: DataFrame, checkpoint, share: float = 0.1) -> DataFrame:
    """(resource_ref, schema_version, schema_fingerprint, change, field, new_field): each change, under its shape.

    ``checkpoint`` maps a DataFrame and a name to the same DataFrame without its lineage.
    """
    known = checkpoint(shape_fields(checkpoint(fused_schema(rows), "union"), share), "shapes")
    shapes = known.select(*SHAPE, "place").distinct()
    older = shapes.select("resource_ref", (F.col("place") + 1).alias("place"), F.col("schema_version").alias("old_version"), F.col("schema_fingerprint").alias("old_fingerprint"))
    neighbours = shapes.join(older, ["resource_ref", "place"]).withColumn("pair", F.xxhash64(*SHAPE))
    new = known.filter("field is not null").select("resource_ref", "place", "field", F.col("type").alias("new_type"), F.lit(True).alias("is_new"))
    old = known.filter("field is not null").select("resource_ref", (F.col("place") + 1).alias("place"), "field", F.col("type").alias("old_type"), F.lit(True).alias("is_old"))
    facts = new.join(old, ["resource_ref", "place", "field"], "full_outer").join(neighbours, ["resource_ref", "place"])
    change = F.when(F.col("is_new").isNull(), "removed").when(F.col("is_old").isNull(), "added").when(F.col("new_type") != F.col("old_type"), "retyped")
    facts = checkpoint(facts.withColumn("change", change).filter("change is not null").select("pair", *SHAPE, "old_version", "old_fingerprint", "change", "field"), "facts")
    gone = facts.groupBy("pair", "resource_ref", "old_version", "old_fingerprint", F.col("schema_version").alias("new_version"), F.col("schema_fingerprint").alias("new_fingerprint")).agg(
        F.array_sort(F.collect_list(F.when(F.col("change") == "removed", F.col("field")))).alias("old_fields"),
        F.array_sort(F.collect_list(F.when(F.col("change") == "added", F.col("field")))).alias("new_fields"),
    ).filter("size(old_fields) > 0 and size(new_fields) > 0")
    renamed = checkpoint(renamings(rows, gone, checkpoint), "renamed")
    ends = renamed.select("pair", F.explode(F.array(
        F.struct(F.lit("removed").alias("change"), F.col("old_field").alias("field")), F.struct(F.lit("added").alias("change"), F.col("new_field").alias("field")),
    )).alias("x")).select("pair", "x.*")
    plain = facts.join(ends, ["pair", "change", "field"], "left_anti").select(*SHAPE, "change", "field", F.lit("").alias("new_field"))
    moved = renamed.join(facts.select("pair", *SHAPE).distinct(), "pair").select(*SHAPE, F.lit("renamed").alias("change"), F.col("old_field").alias("field"), "new_field")
    return plain.unionByName(moved)


_ROW = "delivery_id bigint, resource_ref string, schema_version string, schema_fingerprint string, field string, type string, as_string string, as_integer decimal(38,0), as_decimal decimal(38,18), as_double double, as_boolean boolean, as_array string, canonical string"
_UNIFIED = pa.schema([
    ("delivery_id", pa.int64()), *[(c, pa.string()) for c in (*SHAPE, "field", "type", "as_string")], ("as_integer", pa.decimal128(38, 0)),
    ("as_decimal", pa.decimal128(38, 18)), ("as_double", pa.float64()), ("as_boolean", pa.bool_()), ("as_array", pa.string()), ("canonical", pa.string()),
])


_FIXED = Context(prec=MAX_PREC, Emax=MAX_EMAX, Emin=MIN_EMIN)


def _branches_of_number(x: object) -> tuple[Decimal | None, Decimal | None, float | None]:
    """(whole, exact with up to 20 digits before the point and 18 behind it, nearest double), null where they do not fit."""
    try:
        value = Decimal(str(x))
    except InvalidOperation:
        return None, None, None
    near = float(value)
    if value.is_zero():
        return Decimal(0), Decimal(0), near
    top, (_, digits, exponent) = value.adjusted(), value.as_tuple()
    trailing = len(digits) - len("".join(map(str, digits)).rstrip("0"))
    exact = value.quantize(Decimal(1).scaleb(-18), context=_FIXED) if top < 20 and exponent + trailing >= -18 else None
    whole = value.quantize(Decimal(1), context=_FIXED) if top < 38 and exponent + trailing >= 0 else None
    return whole, exact, None if math.isinf(near) else near


def _branches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for delivery, resource, version, fingerprint, payload in zip(*_columns(batch)):
            for path, x in fields(parse_object(payload) or {}):
                t = tag(x)
                text = None if t is None else x if t == "string" else canonical(x)
                whole, exact, near = _branches_of_number(x) if t in ("decimal", "integer") else (None, None, None)
                out.append((
                    delivery, resource, version, fingerprint, path, t, x if t == "string" else None, whole if t == "integer" else None, exact, near,
                    x if t == "boolean" else None, text if t == "array" else None, text,
                ))
        if out:
            columns = [[str.encode(v, "utf-8", "replace").decode() if isinstance(v, str) else v for v in c] for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, _UNIFIED)], schema=_UNIFIED)


def _names_in_time(group: pd.DataFrame) -> pd.DataFrame:
    """(resource_ref, field, low, high, current) of one resource: what a name stands for in the shapes low to high - 1.

    A renaming is followed by the next one of its new name in the order of shapes, so chains of any length end, and names
    that come back or are used again are told apart.  Before its first renaming and behind each one, until it is added
    again, a name means the renamed field.
    """
    events: dict[str, list[tuple[int, str | None]]] = {}
    for place, change, field, new in zip(group["place"], group["change"], group["field"], group["new_field"]):
        if change == "renamed":
            events.setdefault(field, []).append((int(place), new))
        events.setdefault(new if change == "renamed" else field, []).append((int(place), None))
    for own in events.values():
        own.sort(key=lambda e: (e[0], e[1] or ""))
    ends: dict[tuple[str, int], str] = {}
    for place, name, new in sorted(((p, n, t) for n, own in events.items() for p, t in own if t is not None), reverse=True):
        then = next((p for p, t in events[new] if p > place and t is not None), None)
        ends[name, place] = new if then is None else ends[new, then]
    out = []
    for name, own in events.items():
        cuts = [-(1 << 31), *[p for p, _ in own], 1 << 31]
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            away = own[k - 1][0] if k and own[k - 1][1] is not None else next((p for p, t in own[k:] if t is not None), None)
            if away is not None and low < high:
                out.append((group["resource_ref"].iloc[0], name, low, high, ends[name, away]))
    return pd.DataFrame(out, columns=["resource_ref", "field", "low", "high", "current"])


def unified(rows: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """One consistent table of all payloads: a row per payload and field, with a typed branch and a canonical text.

    ``as_integer`` holds whole numbers of up to 38 digits, ``as_decimal`` numbers of up to 20 digits before the point and 18
    behind it, both exactly; ``as_double`` is the nearest double of any number in its range.  What does not fit a branch
    is null there and stays whole in ``canonical``.  With ``changes`` (a report), fields that were renamed stand under their newest name beside the one they had.  Rows
    without a shape count as of before the first shape.
    """
    ship(rows.sparkSession)
    values = rows.select("delivery_id", *SHAPE, "payload").mapInArrow(_branches, _ROW)
    if changes is None:
        return values.withColumn("current_field", F.col("field"))
    shapes = rows.groupBy(*SHAPE).agg(F.min(F.col("source_sequence").cast("bigint")).alias("first")).dropna(subset=list(SHAPE))
    place = F.row_number().over(W.partitionBy("resource_ref").orderBy("first", "schema_version", "schema_fingerprint"))
    shapes = shapes.select(*SHAPE, place.alias("place"))
    dated = changes.filter("change in ('renamed', 'added')").join(shapes, list(SHAPE)).select("resource_ref", "place", "change", "field", "new_field")
    names = dated.groupBy("resource_ref").applyInPandas(_names_in_time, "resource_ref string, field string, low bigint, high bigint, current string")
    shapes, names = (F.broadcast(t) if t.limit(BROADCAST_SHAPES + 1).count() <= BROADCAST_SHAPES else t for t in (shapes, names))
    placed = values.join(shapes, list(SHAPE), "left").withColumn("place", F.coalesce("place", F.lit(0))).alias("v")
    at = (F.col("v.resource_ref") == F.col("n.resource_ref")) & (F.col("v.field") == F.col("n.field")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))
    found = placed.join(names.alias("n"), at, "left")
    return found.select(*[F.col(f"v.{c}") for c in values.columns], F.coalesce("n.current", "v.field").alias("current_field"))
