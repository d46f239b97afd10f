"""Streaming: new files become extractions, changed ones only; and clusters kept per bucket across batches."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.clusters import EVENTS, Decider, _frame, rule_decider, step
from ..operators.extract import extract
from ..sources.markdown import NAME_GLOB, changed, decode, manifest

BINARY = "path string, modificationTime timestamp, length long, content binary"


def stream_extractions(spark: SparkSession, source: str, sink: str, known: str, checkpoint: str, rejects: str | None = None) -> StreamingQuery:
    """Files of a folder as they arrive; a batch's files whose latest entry in the manifest has the same hash are left out.

    Files that can't be read as text go to ``rejects`` (by default beside the manifest) and not into the manifest, so that
    they are tried again when they come again.

    The sink and the manifest are written per batch id, so that a batch that is run again replaces its own files.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", True).option("pathGlobFilter", NAME_GLOB).load(source)

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.select("path", "content", F.col("modificationTime").alias("modified"))
        seen = spark.read.schema("path string, hash string, modified timestamp, batch long").parquet(known).filter(F.col("batch") < number)
        new = changed(manifest(rows), seen, "batch")
        docs, bad = decode(rows.join(new.select("path"), "path", "left_semi"))
        extract(docs.select("path", "content")).drop("path", "content").write.mode("overwrite").parquet(f"{sink}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{refused}/batch={number}")
        new.join(bad.select("path"), "path", "left_anti").write.mode("overwrite").parquet(f"{known}/batch={number}")

    refused = rejects or f"{known.rstrip('/')}-rejects"
    spark.createDataFrame([], "path string, hash string, modified timestamp").write.mode("ignore").parquet(f"{known}/batch=-1")
    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ClusterState(StatefulProcessor):
    """The fold of incremental clustering with a bucket's clusters as state. A bucket's size isn't known beforehand:
    a cluster's ``singleton`` means that it is the only document so far."""

    decider: Decider = staticmethod(rule_decider)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("clusters", "body string, seen long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        clusters, seen = (json.loads(held[0]), held[1]) if held else ([], 0)
        out, touched = [], set()
        for r in pd.concat(list(rows)).sort_values("position").itertuples(index=False):
            card = {"doc_id": r.doc_id, "bucket_key": r.bucket_key, "tags": json.loads(r.tags), "keywords": _listed(r.keywords), "artifacts": _listed(r.artifacts)}
            at, decision, confidence = step(card, clusters, self.decider(card, clusters), 1 if not seen else 2)
            out.append({"bucket_key": r.bucket_key, "event": "member", "ord": r.position, "cluster_ord": at, "doc_id": r.doc_id, "decision": decision, "cluster_name": clusters[at]["cluster_name"], "confidence": confidence})
            seen += 1
            touched.add(at)
        out += [{"bucket_key": key[0], "event": "cluster", "ord": i, "cluster_ord": i} | clusters[i] | {"tags": json.dumps(clusters[i]["tags"])} for i in sorted(touched)]
        self.state.update((json.dumps(clusters), seen))
        yield _frame(out, [c.split()[0] for c in EVENTS.split(", ")])

    def close(self) -> None:
        pass


def _listed(items: Any) -> list:
    return [] if items is None else list(items)


def latest(events: DataFrame) -> DataFrame:
    """Of a streamed log, all member rows and the last state of each cluster: the form that the batch fold's log has."""
    cluster = events.filter("event = 'cluster'")
    last = cluster.groupBy("bucket_key", "cluster_ord").agg(F.max_by(F.struct(*events.columns), "member_count").alias("r")).select("r.*")
    return events.filter("event = 'member'").union(last)


def stream_clusters(members: DataFrame) -> DataFrame:
    """Streaming members (bucket_key, position, doc_id, tags as JSON, keywords, artifacts) to member events, and after each
    batch a cluster row with the state of every cluster that the batch touched (see ``latest``)."""
    return members.groupBy("bucket_key").transformWithStateInPandas(statefulProcessor=ClusterState(), outputStructType=EVENTS, outputMode="Append", timeMode="None")
