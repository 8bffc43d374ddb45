"""State kept per request between micro-batches: which ids were taken up, and what state each is in."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rasterloom.operators.requests import PENDING, PROCESSING

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: Spark's own on-disk state store, so state may outgrow executor memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Without new rows no batch runs: timers and forgotten ids are dealt with when the next rows come.
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

DAY_MS = 24 * 3600 * 1000


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on local disk backed by the checkpoint, not on the heap.

    State with timers would otherwise run empty batches without end, also when
    a query is to take what there is and stop.
    """
    spark.conf.set(STATE_STORE, ROCKSDB)
    spark.conf.set(EMPTY_BATCHES, "false")


class FirstSubmissions(StatefulProcessor):
    """Lets the earliest record of an id pass, once; the id is remembered for a time, then forgotten."""

    def __init__(self, remember_ms: int):
        self.remember_ms = remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", "at long", self.remember_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # a record without a time comes after those with one
        first = min(rows, key=lambda row: (row["created_at"] is None, row["created_at"] or 0, str(row)))
        if not self.taken.exists():
            self.taken.update((timerValues.getCurrentProcessingTimeInMs(),))
            yield first

    def close(self) -> None:
        pass


def first_submissions(requests: DataFrame, remember_ms: int) -> DataFrame:
    """The requests of a stream whose id has not been taken up in the last ``remember_ms``.

    A batch that is repeated after a failure starts from the state before it,
    so it lets the same records pass.
    """
    use_rocksdb(requests.sparkSession)
    return requests.groupBy("request_id").transformWithState(FirstSubmissions(remember_ms), requests.schema, "append", "ProcessingTime")


def plain(value):
    """Times of rows and of the state alike, without the zone that only one of them carries."""
    return value.astimezone(timezone.utc).replace(tzinfo=None) if isinstance(value, datetime) and value.tzinfo else value


class StatusMachine(StatefulProcessor):
    """Folds a request's events into its state; a request that ended leaves the state when a timer runs out.

    The newest event, by time and number, gives the status; each extra field
    keeps the value of the newest event that has one. Order of arrival does not
    matter while the state is held.
    """

    def __init__(self, extras: list[str], state: T.StructType, linger_ms: int):
        self.extras, self.state, self.linger_ms = extras, state, linger_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        status, at, number, *rest = map(plain, self.held.get()) if self.held.exists() else (None,) * len(self.state)
        newest = (at, number)
        fields = [tuple(rest[i : i + 3]) for i in range(0, len(rest), 3)]
        for row in rows:
            order = (plain(row["ts"]), row["event_id"])
            if newest[0] is None or order >= newest:
                newest, status = order, row["status"]
            for i, name in enumerate(self.extras):
                if row[name] is not None and (fields[i][1] is None or order >= fields[i][1:]):
                    fields[i] = (row[name], *order)
        self.held.update((status, *newest, *[part for field in fields for part in field]))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if status not in PENDING and status not in PROCESSING:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.linger_ms)
        yield Row(request_id=key[0], status=status, updated_at=newest[0], **{name: field[0] for name, field in zip(self.extras, fields)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def status_machine(events: DataFrame, extras: list[str], linger_ms: int = DAY_MS) -> DataFrame:
    """State per request of a stream of events, a row whenever it changes.

    A request that is done or failed is forgotten after ``linger_ms``; an event
    that comes later begins a state of its own.
    """
    use_rocksdb(events.sparkSession)
    kinds = {field.name: field.dataType for field in events.schema.fields}
    order = [("ts", kinds["ts"]), ("event_id", kinds["event_id"])]
    held = [("status", kinds["status"]), *order, *[(f"{name}_{part}", kind) for name in extras for part, kind in (("value", kinds[name]), *order)]]
    shown = [("request_id", kinds["request_id"]), ("status", kinds["status"]), ("updated_at", kinds["ts"]), *[(name, kinds[name]) for name in extras]]
    state, output = (T.StructType([T.StructField(*field) for field in fields]) for fields in (held, shown))
    rows = events.select("request_id", "ts", "event_id", "status", *extras)
    return rows.groupBy("request_id").transformWithState(StatusMachine(extras, state, linger_ms), output, "update", "ProcessingTime")
