"""BM25 as one Column per query: a sum over terms in a fixed order, without aggregating floats.

Scores are therefore the same in every run and page, which the cursors rely on.  This module scores from tokens, for tables
that have no index; ``index`` has the same scores from postings.  Statistics are those of the whole
generation before any filter; tombstones have no tokens and do not count.  The best field decides for a document.

A fuzzy text may have any number of terms.  Up to ``LITERAL_TERMS`` they are literals of the plan; a longer list goes to
the executors once and is looked up in Arrow batches, its contributions summed in the order of the list.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.engine.analysis import analyse, chain_of, fuzzy_terms
from tidemark.engine.layout import FieldLayout, Layout
from tidemark.engine.predicate import Text

K1, B = 1.2, 0.75
LITERAL_TERMS = 50


@dataclass(frozen=True)
class Term:
    field: FieldLayout
    text: str


@dataclass(frozen=True)
class Groups:
    """The terms of a text in one field: a document matches a group by any of its alternatives."""

    field: FieldLayout
    groups: tuple[tuple[str, ...], ...]

    @property
    def terms(self) -> list[str]:
        return list(dict.fromkeys(t for g in self.groups for t in g))


@dataclass(frozen=True)
class Statistics:
    documents: Mapping[str, int]
    average: Mapping[str, float]
    frequency: Mapping[tuple[str, str], int]


def vocabulary(docs: DataFrame, f: FieldLayout) -> DataFrame:
    """(term, df) of a field."""
    return docs.select(F.explode(F.array_distinct(f.tokens)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def analysed(layout: Layout, text: Text, vocabulary_of: Callable[[FieldLayout], DataFrame]) -> list[Groups]:
    """The query's terms by field, expanded against the field's vocabulary if the text is fuzzy."""
    out = []
    for f in text.fields:
        terms = list(dict.fromkeys(analyse(text.text, chain_of(f.language, layout.analysis))))
        near = fuzzy_terms(vocabulary_of(f), terms, text.fuzziness) if text.fuzziness else {t: [t] for t in terms}
        out.append(Groups(f, tuple(tuple(near[t]) for t in terms)))
    return out


def _places(tokens: pa.Array, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the list) of each token that is in the list."""
    at = pc.index_in(tokens.flatten(), value_set=pa.array(terms, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False))
    return rows[at >= 0], at[at >= 0].astype(np.int64)


def _any_of(tokens: Column, terms: Iterable[str]) -> Column:
    terms = list(terms)
    if len(terms) <= LITERAL_TERMS:
        return F.arrays_overlap(tokens, F.array(*map(F.lit, terms)))

    @F.arrow_udf("boolean")
    def found(tokens: pa.Array) -> pa.Array:
        out = np.zeros(len(tokens), dtype=bool)
        out[_places(tokens, terms)[0]] = True
        return pa.array(out)

    return found(tokens)


def matches(groups: Iterable[Groups], every: bool) -> Column:
    """The filter: any term in any field, or all of them within one field."""
    any_field = F.lit(False)
    for g in groups:
        if not g.groups or (every and not all(g.groups)):
            continue
        tokens = F.col(g.field.tokens)
        if every:
            found = F.lit(True)
            for alternatives in g.groups:
                found = found & _any_of(tokens, alternatives)
        elif not g.terms:
            continue
        else:
            found = _any_of(tokens, g.terms)
        any_field = any_field | F.coalesce(found, F.lit(False))
    return any_field


def statistics(docs: DataFrame, groups: Iterable[Groups]) -> Statistics:
    """Counts of the whole generation, in one pass over the token columns; fields with a long list take a pass of their own."""
    groups = list({(g.field.name, g.groups): g for g in groups}.values())
    fields = {g.field.name: g.field for g in groups}
    if not fields:
        return Statistics({}, {}, {})
    wanted = {n: list(dict.fromkeys(t for g in groups if g.field.name == n for t in g.terms)) for n in fields}
    frequency: dict[tuple[str, str], int] = {}
    for n in [n for n in fields if len(wanted[n]) > LITERAL_TERMS]:
        listed = docs.sparkSession.createDataFrame([(t,) for t in wanted[n]], "term string")
        found = vocabulary(docs, fields[n]).join(F.broadcast(listed), "term", "left_semi").collect()
        frequency |= dict.fromkeys(((n, t) for t in wanted.pop(n)), 0) | {(n, r.term): r.df for r in found}
    terms = [(n, t) for n, ts in wanted.items() for t in ts]
    aggregates = []
    for i, f in enumerate(fields.values()):
        aggregates += [F.count(f.tokens).alias(f"n{i}"), F.sum(f.length).alias(f"l{i}")]
    aggregates += [F.count(F.when(F.array_contains(fields[n].tokens, t), 1)).alias(f"d{i}") for i, (n, t) in enumerate(terms)]
    row = docs.agg(*aggregates).first()
    counts = {n: row[f"n{i}"] for i, n in enumerate(fields)}
    average = {n: (row[f"l{i}"] or 0) / max(1, counts[n]) for i, n in enumerate(fields)}
    return Statistics(counts, average, frequency | {t: row[f"d{i}"] for i, t in enumerate(terms)})


def idf(documents: int, frequency: int) -> float:
    return math.log(1 + (documents - frequency + 0.5) / (frequency + 0.5))


def contribution(tf: Column, length: Column, weight: float | Column, average: float | Column) -> Column:
    tf = tf.cast("double")
    average = average if isinstance(average, Column) else F.lit(average or 1.0)
    return F.lit(weight) * tf / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / average))


def _listed(tokens: Column, length: Column, weights: Mapping[str, float], average: float) -> Column:
    """The sum of the contributions of a long list of terms."""
    terms, values, average = list(weights), np.array(list(weights.values())), average or 1.0

    @F.arrow_udf("double")
    def total(tokens: pa.Array, length: pa.Array) -> pa.Array:
        rows, at = _places(tokens, terms)
        pairs, tf = np.unique(rows * len(terms) + at, return_counts=True)
        rows, at = np.divmod(pairs, len(terms))
        sizes = length.fill_null(0).to_numpy(zero_copy_only=False)[rows]
        parts = values[at] * tf / (tf + K1 * ((1 - B) + B * sizes / average))
        return pa.array(np.bincount(rows, weights=parts, minlength=len(tokens)).astype(float))

    return total(tokens, length)


def score(groups: Iterable[Groups], stats: Statistics, matched: Column) -> Column:
    """The score of one text: of its best field, 0 where the text does not match."""
    fields = []
    for g in groups:
        total = F.lit(0.0)
        tokens, length = F.col(g.field.tokens), F.col(g.field.length)
        weights = {t: idf(stats.documents[g.field.name], stats.frequency[g.field.name, t]) for t in g.terms}
        if len(weights) > LITERAL_TERMS:
            total, weights = _listed(tokens, length, weights, stats.average[g.field.name]), {}
        for t, weight in weights.items():
            # array positions beat a filter lambda: removal of the term leaves the length to compare with
            tf = F.size(tokens) - F.size(F.array_remove(tokens, t))
            total = total + F.when(tf > 0, contribution(tf, length, weight, stats.average[g.field.name])).otherwise(0.0)
        fields.append(F.coalesce(total, F.lit(0.0)))
    best = fields[0] if len(fields) == 1 else F.greatest(*fields) if fields else F.lit(0.0)
    return F.when(matched, best).otherwise(F.lit(0.0))
