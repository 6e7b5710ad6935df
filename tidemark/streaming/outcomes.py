"""Outcomes of a stream of mutations, as they arrive, without keeping documents: one highest sequence per document.

A micro-batch is acknowledged by the two-step running maximum of ``acknowledge``, so a document with a third of all
mutations is no single task's work, and joined once with the highest sequences known of its own documents.  Those lie in
segments: each batch adds one with what it raised, many are united into one.  Acknowledgements and state are published by
one manifest with the batch's number; a batch that is replayed keeps the acknowledgements it had.

The state has no time-out and needs no watermark: an older sequence is stale however late it comes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.engine.index import broadcast_if_small
from tidemark.engine.layout import Layout
from tidemark.engine.projection import acknowledge, encode
from tidemark.storage import Folder, Manifest, read_paths, write_once

#: So many segments of the state are united into one.
SEGMENTS = 16
_ACK = "arrival bigint, event_id string, record_id string, source_sequence bigint, outcome string, code string"
_STATE = "m_document_id string, m_source_sequence bigint"


class Outcomes:
    """The acknowledgements of a stream and the state behind them, below a shared folder."""

    def __init__(self, spark: SparkSession, root: str, layout: Layout):
        self.spark, self.root, self.layout = spark, root, layout
        self.manifest = Manifest(Folder(spark, root))

    def acknowledged(self) -> DataFrame:
        """Every acknowledgement published so far."""
        return read_paths(self.spark, list(self.manifest.latest()[1].get("acks", {}).values()), _ACK)

    def apply(self, batch: DataFrame, number: int) -> DataFrame:
        """Acknowledge a micro-batch, once for its number."""
        version, state = self.manifest.latest()
        acks = state.get("acks", {})
        if str(number) in acks:
            return read_paths(self.spark, [acks[str(number)]], _ACK)
        run = f"{self.root}/run={version + 1:08d}-{uuid.uuid4().hex[:8]}"
        narrow = ["arrival", "m_document_id", "m_event_id", "m_record_id", "m_source_sequence", "code"]
        encoded = write_once(encode(batch, self.layout).select(*narrow), f"{run}/encoded")
        valid = encoded.filter("code is null").groupBy("m_document_id").agg(F.max("m_source_sequence").alias("m_source_sequence"))
        segments = state.get("segments", [])
        stored = read_paths(self.spark, segments, _STATE)
        if segments:
            stored = stored.join(broadcast_if_small(valid.select("m_document_id")), "m_document_id", "left_semi").groupBy("m_document_id").agg(F.max("m_source_sequence").alias("m_source_sequence"))
            stored = write_once(stored, f"{run}/stored")
        out = write_once(acknowledge(encoded, stored), f"{run}/acks")
        known = stored.withColumnRenamed("m_source_sequence", "_known")
        raised = valid.join(known, "m_document_id", "left").filter(F.col("_known").isNull() | (F.col("m_source_sequence") > F.col("_known"))).drop("_known")
        raised.write.parquet(f"{run}/state")
        segments = [*segments, f"{run}/state"]
        if len(segments) > SEGMENTS:
            whole = read_paths(self.spark, segments, _STATE).groupBy("m_document_id").agg(F.max("m_source_sequence").alias("m_source_sequence"))
            whole.write.parquet(f"{run}/united")
            segments = [f"{run}/united"]
        self.manifest.publish(version + 1, {"segments": segments, "acks": {**acks, str(number): f"{run}/acks"}})
        for name in ("encoded", "stored"):
            Folder(self.spark, run).remove(name)
        return out


def outcomes(mutations: DataFrame, layout: Layout, root: str, checkpoint: str, available_now: bool = True) -> tuple[StreamingQuery, Outcomes]:
    """Start a query that acknowledges every micro-batch of ``mutations``; the acknowledgements lie below ``root``."""
    store = Outcomes(mutations.sparkSession, root, layout)

    def one(batch: DataFrame, number: int) -> None:
        store.apply(batch, number)

    writer = mutations.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start(), store
