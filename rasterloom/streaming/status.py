"""Current state of requests, followed as a stream of status events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rasterloom.operators.requests import latest_status
from rasterloom.session import scratch_path
from rasterloom.streaming.state import status_machine, use_rocksdb


def status_stream(events: DataFrame, extras: list[str]) -> DataFrame:
    """Running state per request: newest status, and extra fields merged over earlier ones."""
    return latest_status(events, extras)


def write_states(states: DataFrame, path: str, checkpoint: str, **trigger):
    """Write each micro-batch's changed states to a folder of its own; a repeated batch replaces itself."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        states.writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_states(spark: SparkSession, path: str) -> DataFrame:
    """Newest written state of each request."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in ("request_id", "batch_id")]
    return (
        rows.groupBy("request_id")
        .agg(F.max_by(F.struct(*fields), "batch_id").alias("state"))
        .select("request_id", "state.*")
    )


def follow_status(spark: SparkSession, source: str, view: str, extras: list[str], machine: bool = False) -> DataFrame:
    """Read all of ``source`` as a stream of events, and return the states it ends in.

    With ``machine`` they come from a state machine that forgets requests which
    have ended, else from an aggregate that holds all of them.

    ``view`` is the SQL that turns the source's rows, named ``events``, into
    ``(request_id, event_id, ts, status, extras…)``.
    """
    schema = spark.read.parquet(source).schema
    folder, name = source.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    events = spark.sql(view.replace("FROM events", "FROM {events}"), events=stream)
    use_rocksdb(spark)
    target = scratch_path(spark, "states")
    states = status_machine(events, extras) if machine else status_stream(events, extras)
    query = write_states(states, target, f"{target}-checkpoint")
    query.awaitTermination()
    return current_states(spark, target)
