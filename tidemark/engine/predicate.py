"""Logical predicates and their compilation to pushable filters.

Predicates are two-valued: the complement of a comparison holds for missing fields.  Negations are therefore pushed
down to the leaves and each leaf has an explicit complement; conjunctions and disjunctions are plain.  Every scalar leaf
stays in a form the Parquet reader can use; ``NOT coalesce(...)`` forms, which push nothing, are avoided.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.engine.errors import InvalidRequest
from tidemark.engine.layout import FieldLayout
from tidemark.engine.limits import KEYWORD_CHARS

#: Longer membership lists are joined instead of being compiled into the filter.
INLINE_MEMBERS = 1_000


@dataclass(frozen=True)
class Compare:
    """eq, ne, lt, lte, gt, gte, prefix."""

    field: FieldLayout
    op: str
    value: object


@dataclass(frozen=True)
class Member:
    field: FieldLayout
    values: tuple
    negated: bool = False


@dataclass(frozen=True)
class Missing:
    field: FieldLayout
    missing: bool = True


@dataclass(frozen=True)
class Between:
    """A range of which one element must meet both ends."""

    field: FieldLayout
    start: object = None
    end: object = None
    include_start: bool = True
    include_end: bool = False


@dataclass(frozen=True)
class Text:
    """Full text over fields: per field the groups of alternative terms, all or any of which must be there."""

    fields: tuple[FieldLayout, ...]
    text: str
    fuzziness: int = 0
    every: bool = False
    ranking: str = "bm25"


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any_:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


Node = Compare | Member | Missing | Between | Text | All | Any_ | Not


def clauses(node: Node | None) -> int:
    match node:
        case None:
            return 0
        case All(parts) | Any_(parts):
            return sum(map(clauses, parts))
        case Not(part):
            return clauses(part)
    return 1


def texts(node: Node | None) -> list[Text]:
    """All full-text nodes, scoring or not."""
    match node:
        case Text():
            return [node]
        case All(parts) | Any_(parts):
            return [t for p in parts for t in texts(p)]
        case Not(part):
            return texts(part)
    return []


def scoring(node: Node | None) -> list[Text]:
    """The full-text nodes that score: a bare one, or those beneath disjunctions. Under and/not they only filter."""
    match node:
        case Text():
            return [node]
        case Any_(parts):
            return [t for p in parts for t in scoring(p)]
    return []


def literal(value: object, kind: T.DataType) -> Column:
    """A constant of the field's type, or a refusal."""
    try:
        if isinstance(kind, T.BooleanType):
            if isinstance(value, bool):
                return F.lit(value)
        elif isinstance(value, bool):
            pass
        elif isinstance(kind, T.LongType):
            if isinstance(value, int) and -(2**63) <= value < 2**63:
                return F.lit(value).cast("bigint")
        elif isinstance(kind, T.DoubleType):
            if isinstance(value, int | float | Decimal):
                return F.lit(float(value))
        elif isinstance(kind, T.DecimalType):
            if isinstance(value, int | float | str | Decimal):
                return F.lit(Decimal(str(value)))
        elif isinstance(kind, T.TimestampType):
            moment = datetime.fromisoformat(value.replace("Z", "+00:00")) if isinstance(value, str) else value
            if isinstance(moment, datetime) and moment.utcoffset() is not None:
                return F.lit(moment.astimezone(UTC))
        elif isinstance(kind, T.DateType):
            day = date.fromisoformat(value) if isinstance(value, str) else value
            if isinstance(day, date) and not isinstance(day, datetime):
                return F.lit(day)
        elif isinstance(value, str):
            return F.lit(value)
    except (ValueError, InvalidOperation):
        pass
    raise InvalidRequest("a value does not fit the field's type")


def exact(f: FieldLayout) -> Column:
    """The exact form of a field. Of text fields, texts beyond the keyword length are not searchable exactly; other texts are
    names and codes, whose filters reach the scan as they are (a length test would keep them from it)."""
    column = F.col(f.column)
    return F.when(F.length(column) <= KEYWORD_CHARS, column) if "full-text" in f.modes else column


def _any(column: Column, test) -> Column:
    return F.coalesce(F.exists(column, test), F.lit(False))


def _compare(c: Column, op: str, v: Column, yes: bool) -> Column:
    if op == "ne":
        op, yes = "eq", not yes
    if op == "eq":
        return c.eqNullSafe(v) if yes else ~c.eqNullSafe(v)
    if op == "prefix":
        return c.startswith(v) if yes else c.isNull() | ~c.startswith(v)
    test = {"lt": c < v, "lte": c <= v, "gt": c > v, "gte": c >= v}
    opposite = {"lt": "gte", "lte": "gt", "gt": "lte", "gte": "lt"}
    return test[op] if yes else c.isNull() | test[opposite[op]]


def _within(c: Column, node: Between, kind: T.DataType) -> Column:
    tests = []
    if node.start is not None:
        v = literal(node.start, kind)
        tests.append(c >= v if node.include_start else c > v)
    if node.end is not None:
        v = literal(node.end, kind)
        tests.append(c <= v if node.include_end else c < v)
    return reduce(Column.__and__, tests)


def compiled(node: Node, yes: bool = True, matches=None) -> Column:
    """The filter of a predicate (or, with ``yes=False``, of its complement).

    ``matches`` gives the condition of a full-text node (it needs the analysed terms).
    """
    match node:
        case Not(part):
            return compiled(part, not yes, matches)
        case All(parts) | Any_(parts):
            both = isinstance(node, All) == yes
            columns = [compiled(p, yes, matches) for p in parts]
            return reduce(Column.__and__ if both else Column.__or__, columns) if columns else F.lit(both)
        case Text():
            found = matches(node)
            return found if yes else ~F.coalesce(found, F.lit(False))
        case Missing(f, missing):
            empty = F.col(f.column).isNull()
            if f.many:
                empty = empty | (F.size(f.column) == 0)
            return empty if missing == yes else ~empty
        case Compare(f, op, value):
            v = literal(value, f.element)
            if f.many:
                if op == "ne":
                    op, yes = "eq", not yes
                found = _any(F.col(f.column), lambda x: _compare(x, op, v, True))
                return found if yes else ~found
            return _compare(exact(f), op, v, yes)
        case Member(f, values, negated):
            yes = yes != negated
            listed = [literal(v, f.element) for v in values]
            if f.many:
                found = F.coalesce(F.arrays_overlap(F.col(f.column), F.array(*listed)), F.lit(False)) if listed else F.lit(False)
                return found if yes else ~found
            c = exact(f)
            if not listed:
                return F.lit(not yes)
            return c.isin(*listed) if yes else c.isNull() | ~c.isin(*listed)
        case Between(f):
            if f.many:
                found = _any(F.col(f.column), lambda x: _within(x, node, f.element))
                return found if yes else ~found
            inside = _within(F.col(f.column), node, f.element)
            return inside if yes else F.col(f.column).isNull() | ~inside
    raise InvalidRequest("unknown predicate")


def split_members(node: Node | None) -> tuple[Node | None, list[Member]]:
    """Long membership lists in the top conjunction, taken out to be joined; the rest stays a filter."""
    parts = node.parts if isinstance(node, All) else (node,) if node is not None else ()
    large = [p for p in parts if isinstance(p, Member) and len(p.values) > INLINE_MEMBERS and not p.field.many]
    rest = tuple(p for p in parts if p not in large)
    return (None if not rest else rest[0] if len(rest) == 1 else All(rest)), large


def join_members(df: DataFrame, members: Sequence[Member]) -> DataFrame:
    """Semi and anti joins against the lists (at most 10,000 values each, so they are broadcast)."""
    for m in members:
        kind = m.field.element.simpleString()
        values = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(m.values)], T.StructType([T.StructField("_v", T.StringType() if kind == "string" else m.field.element)]))
        df = df.join(F.broadcast(values), exact(m.field) == F.col("_v"), "left_anti" if m.negated else "left_semi")
    return df
