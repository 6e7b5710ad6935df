"""Search: one pipeline of filter, score, order and limit, declared and left to Catalyst.

Mandatory filters (scope, resource, not deleted) are added here and cannot be supplied by callers.  Texts are answered from
the index of the snapshot, if there is one: matches and scores come from the postings of the query's terms and no tokens
are read; tables without an index are scanned.  Total and facets
cover all matches, whatever the cursor; both come from one aggregation.  A page of n fetches n + 1 rows; ``pages`` has
all pages from one sort.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from functools import cached_property
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.engine.analysis import CHAINS, chain_of, words
from tidemark.engine.cursor import Signer, after
from tidemark.engine.errors import CursorRejected, ScopeViolation
from tidemark.engine.index import BROADCAST_ROWS, Index
from tidemark.engine.limits import FRAGMENT_BYTES, FRAGMENT_CHARS, Limits
from tidemark.engine.predicate import compiled, exact, join_members, literal, scoring, split_members, texts
from tidemark.engine.request import Plan
from tidemark.engine.scoring import Groups, Statistics, analysed, matches, score, statistics, vocabulary
from tidemark.shipping import ship
from tidemark.storage import write_once

#: Of a number from ``monotonically_increasing_id``, the bits of the place in its range; the others are the range's.
RANGE_BITS = 33
ITEM = ["m_record_id", "m_source_version", "m_source_sequence", "m_resource"]


@dataclass
class Search:
    """A plan over the documents of a generation, within one scope. All members are lazy DataFrames."""

    plan: Plan
    docs: DataFrame
    scope: str
    limits: Limits = Limits()
    stats: Statistics | None = None
    index: Index | None = None

    def __post_init__(self) -> None:
        if not isinstance(self.scope, str) or not self.scope:
            raise ScopeViolation("a search needs its scope")
        self._nodes = [*texts(self.plan.text), *texts(self.plan.where)]
        self._groups: dict[int, list[Groups]] = {}
        for node in self._nodes:
            own = (lambda f: vocabulary(self.docs, f)) if self.index is None else self.index.vocabulary
            self._groups[id(node)] = analysed(self.plan.layout, node, own)

    # -- the match set -----------------------------------------------------------------------------------------
    def _matches(self, node) -> Column:
        if self.index is not None:
            return F.coalesce(F.col(f"_t{self._place(node)}"), F.lit(False))
        return matches(self._groups[id(node)], node.every)

    def _place(self, node) -> int:
        return next(i for i, n in enumerate(self._nodes) if n is node)

    @cached_property
    def _statistics(self) -> Statistics:
        own = [g for n in scoring(self.plan.text) for g in self._groups[id(n)]]
        return self.stats or (statistics(self.docs, own) if self.index is None else self.index.statistics(own))

    def _with_hits(self, df: DataFrame) -> DataFrame:
        """Documents with the hits of each text: whether it matches and its score. A text that decides alone is an inner join."""
        scored = {id(n) for n in scoring(self.plan.text)}
        for i, node in enumerate(self._nodes):
            groups = self._groups[id(node)]
            stats = self._statistics if id(node) in scored else None
            hits = self.index.hits(groups, node.every, stats).select("m_document_id", F.col("score").alias(f"_s{i}"), F.lit(True).alias(f"_t{i}"))
            if stats and sum(stats.frequency[g.field.name, t] for g in groups for t in g.terms) <= BROADCAST_ROWS:
                hits = F.broadcast(hits)  # not more rows than its terms have postings
            df = df.join(hits, "m_document_id", "inner" if node is self.plan.text else "left")
        return df

    @cached_property
    def matched(self) -> DataFrame:
        """All matching documents, unscored."""
        df = self.docs
        df = df.filter((F.col("m_scope") == self.scope) & (F.col("m_resource") == self.plan.layout.resource) & ~F.col("m_deleted"))
        where, large = split_members(self.plan.where)
        if self.index is not None:
            df = self._with_hits(df)
        if where is not None:
            df = df.filter(compiled(where, True, self._matches))
        if self.plan.text is not None:
            df = df.filter(compiled(self.plan.text, True, self._matches))
        return join_members(df, large)

    @cached_property
    def _score(self) -> Column:
        nodes = scoring(self.plan.text)
        if not nodes:
            return F.lit(0.0)
        total = F.lit(0.0)
        for n in nodes:
            if self.index is None:
                total = total + score(self._groups[id(n)], self._statistics, self._matches(n))
            else:
                total = total + F.coalesce(F.col(f"_s{self._place(n)}"), F.lit(0.0))
        return total

    # -- order and pages ---------------------------------------------------------------------------------------
    @cached_property
    def keys(self) -> list[tuple[str, Column, bool, bool, object]]:
        """(name, column, descending, nulls first, type): the order, which ends in the document's id."""
        out = []
        for i, s in enumerate(self.plan.order):
            column = F.col(s.field.column)
            if s.field.many:
                column = F.array_max(column) if s.descending else F.array_min(column)
            out.append((f"sort_{i}", exact(s.field) if not s.field.many else column, s.descending, s.nulls_first, s.field.element))
        if not out:
            out.append(("score", self._score, True, False, None))
        return [*out, ("m_document_id", F.col("m_document_id"), False, False, None)]

    def _behind(self, position: Sequence | None, extra: Sequence[str] = ()) -> tuple[DataFrame, list[Column]]:
        """All rows behind a position with their sort values, and their order."""
        shown = F.lit(None).cast("double") if self.plan.order else self._score
        named = [(n, c, d, f) for n, c, d, f, _ in self.keys]
        df = self.matched.select(
            *[c for c in ITEM if c in self.docs.columns], "m_document_id", shown.alias("score"),
            *[c.alias(n) for n, c, _, _ in named if n not in ("score", "m_document_id")], *[F.col(c) for c in extra],
        )
        if position is not None:
            if len(position) != len(self.keys):
                raise CursorRejected("the cursor does not continue this search")
            values = [None if v is None else F.lit(v) if kind is None else literal(v, kind) for v, (_, _, _, _, kind) in zip(position, self.keys)]
            df = df.filter(after([(F.col(n), d, f) for n, _, d, f in named], values))
        return df, [getattr(F.col(n), f"{'desc' if d else 'asc'}_nulls_{'first' if f else 'last'}")() for n, _, d, f in named]

    def rows(self, position: Sequence | None = None, extra: Sequence[str] = ()) -> DataFrame:
        """The first n + 1 rows behind a position, in order, with their sort values."""
        df, order = self._behind(position, extra)
        return df.orderBy(*order).limit(self.plan.size + 1)

    def pages(self, path: str, signer: Signer | None = None, registry: str = "", snapshot: str | None = None, read: int = 0) -> DataFrame:
        """(page, items with their sort values) of every page behind the plan's cursor, numbered on from the ``read`` ones.

        A page is a pass over the matches, so all pages one at a time are a pass for each.  Here the matches are sorted
        once, in ranges, into the folder ``path``; a row's place is its place in its range behind the ranges before.
        """
        df, order = self._behind(self._position(signer, registry, snapshot))
        placed = write_once(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), path)
        ranges, within = F.shiftright("_place", RANGE_BITS), F.col("_place").bitwiseAND((1 << RANGE_BITS) - 1)
        sizes = sorted(tuple(r) for r in placed.groupBy(ranges.alias("_range")).agg(F.count(F.lit(1))).collect())  # a row for each range
        before = [(r, b) for (r, _), b in zip(sizes, accumulate((n for _, n in sizes), initial=0))]
        numbered = placed.withColumn("_range", ranges).join(F.broadcast(placed.sparkSession.createDataFrame(before, "_range bigint, _before bigint")), "_range")
        place = F.col("_before") + within
        page = ((place - F.pmod(place, F.lit(self.plan.size))) / self.plan.size + read + 1).cast("int")
        return numbered.select(page.alias("page"), *[c for c in placed.columns if c != "_place"])

    def scored(self) -> DataFrame:
        """(m_document_id, m_record_id, score) of every match."""
        return self.matched.select("m_document_id", "m_record_id", self._score.alias("score"))

    # -- total and facets --------------------------------------------------------------------------------------
    def counts(self) -> DataFrame:
        """(facet, value, count): the total under facet null, and the most frequent values of each facet.

        One pass: each match gives one row for the total and one for each distinct value of each facet.
        """
        parts = [F.array(F.struct(F.lit(-1).alias("k"), F.lit(None).cast("string").alias("v")))]
        for k, f in enumerate(self.plan.facets):
            values = F.array_distinct(F.col(f.column)) if f.many else F.array(exact(f))
            kept = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull())
            parts.append(F.transform(kept, _tagged(k)))
        rows = self.matched.select(F.explode(F.concat(*parts)).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("count"))
        rank = F.row_number().over(W.partitionBy("k").orderBy(F.desc("count"), "v"))
        names = F.create_map(*[x for k, f in enumerate(self.plan.facets) for x in (F.lit(k), F.lit(f.name))]) if self.plan.facets else None
        name = F.lit(None).cast("string") if names is None else F.try_element_at(names, F.col("k"))
        return rows.withColumn("r", rank).filter(F.col("r") <= self.limits.facet_buckets).select(name.alias("facet"), F.col("v").alias("value"), "count")

    def total(self) -> DataFrame:
        return self.matched.agg(F.count(F.lit(1)).alias("total"))

    # -- the contract ------------------------------------------------------------------------------------------
    def bound(self, registry: str) -> dict:
        p = self.plan
        return {"plan": p.fingerprint, "registry": registry, "schema": p.layout.schema_fingerprint, "scope": self.scope, "size": p.size}

    def _position(self, signer: Signer | None, registry: str, snapshot: str | None) -> list | None:
        """Where the plan's cursor continues."""
        if self.plan.cursor is None:
            return None
        if signer is None:
            raise CursorRejected("no cursors here")
        position, pinned = signer.open(self.plan.cursor, self.bound(registry))
        if (pinned is None) == self.plan.point_in_time or pinned != snapshot:
            raise CursorRejected("the cursor does not continue this search")
        return position

    def page(self, signer: Signer | None = None, registry: str = "", snapshot: str | None = None) -> dict:
        """Items, facets, total and the cursor of the next page, as the result contract has them."""
        plan, position = self.plan, self._position(signer, registry, snapshot)
        found = self._highlighted(self.rows(position, [f.column for f in plan.highlights])).collect()
        counts = self.counts().collect()
        shown = found[: plan.size]
        items = []
        for r in shown:
            if r.m_resource != plan.layout.resource:
                raise ScopeViolation("a foreign document")
            namespace, _, name = plan.layout.resource.partition(":")[2].partition(".")
            items.append({
                "recordRef": {"collectionRef": {"catalog": "structured", "namespace": namespace, "name": name}, "recordId": r.m_record_id},
                "sourceVersion": r.m_source_version, "sourceSequence": r.m_source_sequence, "score": r.score,
                "sort": [_json(r[n]) for n, *_ in self.keys],
                "highlights": {f.name: x for f in plan.highlights if (x := r[f"_h_{f.column}"])},
            })
        facets: dict[str, list] = {f.name: [] for f in plan.facets}
        for c in sorted(counts, key=lambda c: (-c["count"], c.value or "")):
            if c.facet is not None:
                facets[c.facet].append({"value": c.value, "count": c["count"]})
        total = next((c["count"] for c in counts if c.facet is None), 0)
        more = len(found) > plan.size and signer is not None
        cursor = signer.issue(self.bound(registry), [_json(shown[-1][n]) for n, *_ in self.keys], snapshot) if more else None
        return {"items": items, "facets": facets, "total": {"value": total, "relation": "eq"}, "consistency": "eventual", "cursor": cursor}

    def _highlighted(self, rows: DataFrame) -> DataFrame:
        """The rows of a page with their fragments instead of their texts, which stay on the executors."""
        if not self.plan.highlights:
            return rows
        ship(rows.sparkSession)
        for f in self.plan.highlights:
            wanted = {t for gs in self._groups.values() for g in gs if g.field == f for t in g.terms}
            chain, most = chain_of(f.language, self.plan.layout.analysis), self.limits.highlight_fragments

            rows = rows.withColumn(f"_h_{f.column}", _marked(F.col(f.column), frozenset(wanted), chain, most))
        return rows.drop(*[f.column for f in self.plan.highlights])


def _marked(text: Column, wanted: Collection[str], chain: str, most: int) -> Column:
    @F.pandas_udf("array<string>")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series([fragments(t, wanted, chain, most) for t in texts], dtype=object)

    return marked(text)


def fragments(text: str | None, wanted: Collection[str], chain: str, most: int) -> list[str]:
    """Highlighted pieces of one text: the wanted terms marked, a few hundred characters each."""
    if not text or not wanted:
        return []
    step = CHAINS.get(chain, lambda w: w.lower())
    hits = [(a, b) for w, a, b in words(text) if step(w) in wanted]
    out = []
    i = 0
    while i < len(hits) and len(out) < most:
        start = max(0, hits[i][0] - FRAGMENT_CHARS // 4)
        end = min(len(text), start + FRAGMENT_CHARS)
        piece, at = "", start
        while i < len(hits) and hits[i][1] <= end:
            a, b = max(hits[i][0], at), hits[i][1]
            if a < b:
                piece += text[at:a] + "<em>" + text[a:b] + "</em>"
                at = b
            i += 1
        if at == start:  # a term longer than the fragment
            i += 1
            continue
        out.append((piece + text[at:end]).encode()[:FRAGMENT_BYTES].decode("utf-8", "ignore"))
    return out


def _tagged(k: int):
    return lambda v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))


def _json(value: object) -> object:
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds") + ("Z" if value.tzinfo is None else "")
    if isinstance(value, date):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else value
