"""Queries p6 to p8, over the whole table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import count_tokens, encode_texts
from tidemark.llm.mixing import Sources, verify
from tidemark.llm.sentences import split_texts
from tidemark.sources.tables import table
from tidemark.storage import scratch


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"))


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    """The tokens of each document."""
    return count_tokens(table(spark, d, "documents"), ["doc_id"])


def _sources(spark: SparkSession, d: str) -> Sources:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"), "source", "text")
    return Sources.of(docs, table(spark, d, "mix_targets"), scratch(spark, "mix"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a usable source count towards no total here, so the labelled ones are fitted alone."""
    return spark.createDataFrame([(s,) for s in _sources(spark, d).fit(False).unreachable()], "source string")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per source: its target share, its own tokens, and the tokens and share reached by labelled documents alone, and
    with documents without a usable source as soft members."""
    sources = _sources(spark, d)
    alone, soft = sources.fit(False), sources.fit(True)
    sums = [float(sum(m.reached)) or 1.0 for m in (alone, soft)]
    rows = [
        (s, float(t), own, float(a), float(a) / sums[0], float(b), float(b) / sums[1])
        for s, t, own, a, b in zip(sources.targets.names, sources.targets.shares(), sources.own, alone.reached, soft.reached)
    ]
    return spark.createDataFrame(rows, "source string, target_share double, own_tokens bigint, reached_tokens double, reached_share double, soft_tokens double, soft_share double")


def p7_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used, documents without a usable source as soft members."""
    return _sources(spark, d).fit(True).rates().withColumnRenamed("key", "doc_id")


def p7_verified(spark: SparkSession, d: str) -> DataFrame:
    """The rates of both mixtures against what a solution must meet; anything but true is a fault."""
    sources = _sources(spark, d)
    checks = [verify(sources.fit(soft)).withColumn("soft", F.lit(soft)) for soft in (False, True)]
    return checks[0].unionByName(checks[1])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p6_ids, p6_counts, p7_found, p7_shares, p7_rates, p7_verified, p8_found)}
SQL: dict[str, str] = {
    "p7_verified": "select source, true within_cap, true sums_agree, true optimal, soft from mix_targets, (values (false), (true)) t(soft)",
}
