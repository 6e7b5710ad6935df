"""The inverted index of a generation: postings, vocabulary and lengths of each of its segments.

A segment is what one write made (the base, or a bulk behind it) and has its index beside its documents, made once.
Postings lie in buckets of the term, whose number follows the number of postings, and are sorted by field and term, so a
query reads the row groups of its few terms and never the tokens of the corpus.  Postings of documents that a later
segment has superseded are left out, and so are their lengths: matches, frequencies and scores are those of the live
documents, exactly.

Scores are a sum over the terms in a fixed order, so all pages of a search agree.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.engine.layout import FieldLayout, Layout
from tidemark.engine.scoring import Groups, Statistics, contribution, idf
from tidemark.storage import Folder, read_paths

#: A bucket has about so many postings; the number of buckets is the next power of two.
BUCKET_POSTINGS = 1 << 22
#: Sides that are broadcast after they were counted: superseded documents, matches of a query.
BROADCAST_ROWS = 250_000
_POSTING = "m_document_id string, dl int, term string, tf int, field string"
_VOCABULARY = "field string, term string, df bigint"
_LENGTHS = "field string, n bigint, total bigint"


def broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(docs: DataFrame, layout: Layout, path: str) -> dict | None:
    """Write the index of a segment's documents (with their tokens); its entry for the manifest, or None without text."""
    if not layout.text_fields:
        return None
    parts = []
    for f in layout.text_fields:
        terms = docs.filter(F.col(f.tokens).isNotNull()).select("m_document_id", F.col(f.length).alias("dl"), F.explode(f.tokens).alias("term"))
        parts.append(terms.groupBy("m_document_id", "dl", "term").agg(F.count(F.lit(1)).cast("int").alias("tf")).withColumn("field", F.lit(f.name)))
    size = docs.agg(*[F.coalesce(F.sum(f.length), F.lit(0)).cast("bigint").alias(f"l{i}") for i, f in enumerate(layout.text_fields)], *[F.count(f.tokens).alias(f"n{i}") for i, f in enumerate(layout.text_fields)]).first()
    buckets = 1
    while buckets * BUCKET_POSTINGS < sum(size[f"l{i}"] for i in range(len(layout.text_fields))):
        buckets *= 2
    rows = reduce(DataFrame.unionByName, parts).withColumn("bucket", _bucket(F.col("term"), buckets))
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
    written = docs.sparkSession.read.schema(_POSTING).parquet(f"{path}/postings")
    written.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{path}/vocabulary")
    lengths = [(f.name, size[f"n{i}"], size[f"l{i}"]) for i, f in enumerate(layout.text_fields)]
    docs.sparkSession.createDataFrame(lengths, _LENGTHS).coalesce(1).write.parquet(f"{path}/lengths")
    return {"path": path, "buckets": buckets}


@dataclass(frozen=True)
class Segment:
    """A segment's documents and the entry of its index."""

    docs: DataFrame
    index: dict


@dataclass
class Index:
    """The index of a snapshot. ``newest`` has (m_document_id, newest): the last segment of documents behind the base."""

    spark: SparkSession
    layout: Layout
    segments: Sequence[Segment]
    newest: DataFrame | None = None

    def vocabulary(self, f: FieldLayout) -> DataFrame:
        """(term, df) of a field; terms and counts of superseded documents are in it until the segments are united."""
        found = read_paths(self.spark, [f"{s.index['path']}/vocabulary" for s in self.segments], _VOCABULARY)
        return found.filter(F.col("field") == f.name).groupBy("term").agg(F.sum("df").alias("df"))

    def _live(self, rows: DataFrame, segment: int) -> DataFrame:
        if self.newest is None:
            return rows
        return rows.join(self.newest, "m_document_id", "left").filter(F.coalesce(F.col("newest"), F.lit(segment)) == segment).drop("newest")

    def postings(self, wanted: Iterable[tuple[str, str]]) -> DataFrame:
        """(m_document_id, dl, term, tf, field) of (field, term) pairs in live documents."""
        pairs = list(dict.fromkeys(wanted))
        table = F.broadcast(self.spark.createDataFrame(pairs, "field string, term string"))  # as long as the query's terms
        terms = [t for _, t in pairs]
        most = max((s.index["buckets"] for s in self.segments), default=1)
        wanted_buckets = {0} if terms else set()
        if terms and most > 1:
            wanted_buckets = {r[0] for r in table.select(_bucket(F.col("term"), most).alias("b")).distinct().collect()}
        parts = []
        for k, s in enumerate(self.segments):
            there = set(Folder(self.spark, f"{s.index['path']}/postings").names())
            folders = [n for n in sorted({f"bucket={b % s.index['buckets']}" for b in wanted_buckets}) if n in there]
            rows = read_paths(self.spark, [f"{s.index['path']}/postings/{n}" for n in folders], _POSTING)
            if len(terms) <= 1_000:
                rows = rows.filter(F.col("term").isin(terms))  # for the scan; the join decides
            parts.append(self._live(rows.join(table, ["field", "term"], "left_semi"), k).select("m_document_id", "dl", "term", "tf", "field"))
        return reduce(DataFrame.unionByName, parts)

    def statistics(self, groups: Iterable[Groups]) -> Statistics:
        """Documents and average lengths of the fields, and how many live documents have each term."""
        groups = list(groups)
        names = sorted({g.field.name for g in groups})
        counts, totals = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
        for r in read_paths(self.spark, [f"{s.index['path']}/lengths" for s in self.segments], _LENGTHS).collect():  # a row per field and segment
            if r.field in counts:
                counts[r.field] += r.n
                totals[r.field] += r.total
        if self.newest is not None and names:
            fields = {g.field.name: g.field for g in groups}
            parts = []
            for k, s in enumerate(self.segments):
                dead = s.docs.join(self.newest, "m_document_id").filter(F.col("newest") > k)
                parts.append(dead.select(*[F.col(fields[n].length).alias(f"l{i}") for i, n in enumerate(names)]))
            row = reduce(DataFrame.unionByName, parts).agg(*[x for i in range(len(names)) for x in (F.count(f"l{i}").alias(f"n{i}"), F.coalesce(F.sum(f"l{i}"), F.lit(0)).alias(f"t{i}"))]).first()
            for i, n in enumerate(names):
                counts[n] -= row[f"n{i}"]
                totals[n] -= row[f"t{i}"]
        wanted = [(g.field.name, t) for g in groups for t in g.terms]
        frequency = dict.fromkeys(wanted, 0)
        if wanted:
            for r in self.postings(wanted).groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).collect():
                frequency[r.field, r.term] = r.df
        return Statistics(counts, {n: totals[n] / max(1, counts[n]) for n in names}, frequency)

    def hits(self, groups: Sequence[Groups], every: bool, stats: Statistics | None) -> DataFrame:
        """(m_document_id, score) of the documents that match a text: of its best field, terms summed in their order.

        Without ``stats`` the text only filters and the score is null.
        """
        facts = []
        for f, g in enumerate(groups):
            for place, t in enumerate(g.terms):
                weight = idf(stats.documents[g.field.name], stats.frequency[g.field.name, t]) if stats else 0.0
                average = (stats.average[g.field.name] if stats else 1.0) or 1.0
                members = [i for i, alternatives in enumerate(g.groups) if t in alternatives]
                facts.append((g.field.name, t, f, place, weight, average, members))
        if not facts:
            return self.spark.createDataFrame([], "m_document_id string, score double")
        table = self.spark.createDataFrame(facts, "field string, term string, f int, place int, weight double, average double, members array<int>")
        found = self.postings((x[0], x[1]) for x in facts).join(F.broadcast(table), ["field", "term"])
        part = contribution(F.col("tf"), F.col("dl"), F.col("weight"), F.col("average"))
        per = found.groupBy("m_document_id", "f").agg(F.array_sort(F.collect_list(F.struct("place", part.alias("c")))).alias("parts"), F.size(F.array_distinct(F.flatten(F.collect_list("members")))).alias("met"))
        per = per.select("m_document_id", "f", F.aggregate("parts", F.lit(0.0), lambda a, x: a + x["c"]).alias("score"), "met")
        needed = F.create_map(*[x for f, g in enumerate(groups) for x in (F.lit(f), F.lit(len(g.groups)))])
        full = F.max(F.col("met") == F.element_at(needed, F.col("f"))) if every else F.lit(True)
        best = per.groupBy("m_document_id").agg(F.max("score").alias("score"), full.alias("full")).filter("full")
        return best.select("m_document_id", F.col("score") if stats else F.lit(None).cast("double").alias("score"))
