"""Incremental ingestion: new raw documents end up in the fact table once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions.bands import level_code, local_level
from skyledger.operators.ranking import latest_wins
from skyledger.operators.rules import BROKEN
from skyledger.plans.ingest import clean_batches, transform
from skyledger.plans.quality import grade
from skyledger.schema import LOGICAL_KEY, RAW_SCHEMA
from skyledger.sinks.facts import upsert_facts
from skyledger.sinks.files import beside, exists


def labelled(rows: DataFrame) -> DataFrame:
    index = F.col("us_aqi")
    return rows.withColumns({"aqi_level": local_level(index), "aqi_severity": level_code(index)})


def ingest_available(
    spark: SparkSession,
    raw_path: str,
    fact_path: str,
    checkpoint: str,
    source: str,
    points: DataFrame,
    locations: DataFrame,
    bad_path: str,
    hours: int = 24,
) -> StreamingQuery:
    """Process the documents that arrived since the last run, then stop.

    Every row is graded: only valid ones reach the facts, the others a folder of
    their micro-batch below ``bad_path``. The checkpoint remembers the files already
    taken; the ledger beside the facts remembers the micro-batches that are done,
    written after both tables. A micro-batch that is replayed after a crash in
    between does all its steps again, each of which leaves the same rows; one that
    the ledger has is passed over. The entry has the counts of the micro-batch.
    """
    documents = spark.readStream.schema(RAW_SCHEMA).option("multiLine", True).json(raw_path)

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = stream_id(session, checkpoint)
        if number in committed(session, fact_path, stream):
            return
        rows = clean_batches(transform(batch, source)).withColumn("load_id", F.col("batch_id"))
        graded = grade(rows, points, locations, source, F.current_timestamp(), hours=hours)
        with beside(session, f"{fact_path.rstrip('/')}.judged") as staging:
            stored = graded.stored(staging)
            stored.bad.write.mode("overwrite").parquet(f"{bad_path}/micro_batch={number}")
            upsert_facts(session, fact_path, labelled(latest_wins(stored.valid.drop("load_id"), LOGICAL_KEY)))
            size = F.size(BROKEN) == 0
            done = stored.judged.agg(F.count_if(size).alias("valid_rows"), F.count_if(~size).alias("bad_rows"))
            done = done.select(F.lit(stream).alias("stream"), F.lit(number).cast("bigint").alias("micro_batch"), "*")
            done.write.mode("append").parquet(ledger_path(fact_path))

    return (
        documents.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )


def ledger_path(fact_path: str) -> str:
    return f"{fact_path.rstrip('/')}.micro_batches"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark gives a stream with its checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def committed(spark: SparkSession, fact_path: str, stream: str) -> set[int]:
    """The newest micro-batches of a stream that are done; only one of these can be replayed."""
    path = ledger_path(fact_path)
    if not exists(spark, path):
        return set()
    own = spark.read.parquet(path).where(F.col("stream") == stream)
    return {row.micro_batch for row in own.orderBy(F.desc("micro_batch")).limit(2).collect()}
