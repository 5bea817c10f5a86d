"""The authentication state machine over a live event stream.

``groupBy(session).transformWithState`` (rows: a frame for each session takes several times as
long) on a RocksDB store keeps, per session, a value
(current state, counters, history) and a list of events that wait. Every event yields one
output row (the transition taken, or an illegal event). The events of a session are applied in
the order of (ts, event_id), across micro-batches too: an event is appended to the list, and a
timer wakes the session when the watermark has passed the earliest one; all events passed by
then are applied in order, however late they arrived within the watermark. A micro-batch only
appends: the list is read and rewritten when a timer fires. An event that arrives after the
watermark has passed it comes out at once, marked ``late`` and not applied, so none goes
unseen (``late_events`` counts them). A session that reached a terminal state keeps refusing
events until a timer one day past its last event, then its state is cleared, so the result
equals the batch replay on the same events while state stays bounded.

A bounded replay (``run_events_stream``) reads its whole table in one micro-batch, in which
nothing is late, and applies every event at once. Its sessions are dealt to buckets
(``BucketMachine``), which keep the state of their sessions together: a session has few events,
and calls to the store for each took most of the time. A session's events of one micro-batch
meet in one task (three columns of them), as the state of a session does.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import fsm
from ..session import checkpoint_dir, register_cleanup

OUTPUT_SCHEMA = ("user_id long, day date, ts timestamp_ntz, event_id long, event string, "
                 "from_state string, to_state string, legal boolean, n_events long, late boolean")
OUT = Row(*[c.split()[0] for c in OUTPUT_SCHEMA.split(", ")])
MACHINE_SCHEMA = "state string, n_events long, n_illegal long, history string, last long"
BUCKET_SCHEMA = "user_id long, day date, " + MACHINE_SCHEMA
BUCKET_EVENTS = 2000   # events of a bucket of a bounded replay, on average
WAITING_SCHEMA = "us long, event_id long, event string"
WATERMARK = "10 minutes"
SESSION_TIMEOUT_MS = 24 * 3600 * 1000   # keep a session one day past its last event
STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SessionMachine(StatefulProcessor):
    """The state machine of one session; times are microseconds, timers milliseconds."""

    def __init__(self, bounded: bool, transitions=fsm.TRANSITIONS, initial: str = fsm.IDLE,
                 terminal=fsm.TERMINAL_STATES):
        self.bounded = bounded
        self.table = {(s, e): t for s, e, t in transitions if s not in terminal}
        self.initial = initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", MACHINE_SCHEMA)
        self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def handleInputRows(self, key, rows, timerValues):
        fresh = [(_micros(r.ts), r.event_id, r.event) for r in rows]
        if self.bounded:
            yield from self._applied(key, sorted(fresh))
            return
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        late = sorted(x for x in fresh if x[0] < passed)
        held = [x for x in fresh if x[0] >= passed]
        if held:
            self.waiting.appendList(held)
            self.handle.registerTimer(min(held)[0] // 1000 + 1)
        if late:
            state, n, *_ = self._at()
            for us, event_id, event in late:
                yield OUT(*key, _time(us), event_id, event, state, state, False, n, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [tuple(x) for x in held if x[0] < passed]
        left = [tuple(x) for x in held if x[0] >= passed]
        if ready:
            yield from self._applied(key, ready)
            if left:
                self.waiting.put(left)
            else:
                self.waiting.clear()
        if left:
            self.handle.registerTimer(left[0][0] // 1000 + 1)
            return
        over = self._at()[4] // 1000 + SESSION_TIMEOUT_MS
        if over * 1000 > passed:
            self.handle.registerTimer(over)
        else:
            self.machine.clear()

    def _at(self) -> tuple:
        return self.machine.get() if self.machine.exists() else (self.initial, 0, 0, self.initial, 0)

    def _applied(self, key, events) -> list[Row]:
        """The rows of events in order, with the session moved on."""
        out, machine = self._moved(key, events, self._at())
        self.machine.update(machine)
        return out

    def _moved(self, key, events, machine: tuple) -> tuple[list[Row], tuple]:
        """The rows of events in order and the machine after them."""
        state, n, bad, history, last = machine
        out = []
        for us, event_id, event in events:
            to = self.table.get((state, event))
            n += 1
            out.append(OUT(*key, _time(us), event_id, event, state, to or state, to is not None, n, False))
            if to is None:
                bad += 1
            else:
                state, history = to, history + ">" + to
            last = max(last, us)
        return out, (state, int(n), int(bad), history, int(last))

    def close(self) -> None:
        pass


class BucketMachine(SessionMachine):
    """The state machines of a bucket's sessions, for a bounded replay: the machines are read and
    written as one list, since each call to the store costs as much as many events."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machines = handle.getListState("machines", BUCKET_SCHEMA)

    def handleInputRows(self, key, rows, timerValues):
        machines = {tuple(x[:2]): tuple(x[2:]) for x in self.machines.get()}
        fresh = defaultdict(list)
        for r in rows:
            fresh[(r.user_id, r.day)].append((_micros(r.ts), r.event_id, r.event))
        for session, events in fresh.items():
            out, machines[session] = self._moved(
                session, sorted(events), machines.get(session, (self.initial, 0, 0, self.initial, 0)))
            yield from out
        self.machines.put([(*session, *machine) for session, machine in machines.items()])


EPOCH = dt.datetime(1970, 1, 1)


def _time(us: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=us)


def _micros(ts: dt.datetime) -> int:
    return (ts - EPOCH) // dt.timedelta(microseconds=1)


def transitions_stream(events: DataFrame, lateness: str = WATERMARK, bounded: bool = False,
                       buckets: int | None = None) -> DataFrame:
    """Streaming (or batch) events ``(user_id, day, ts, event_id, event)`` -> one row per
    event with the transition it caused. ``bounded``: all events come in one micro-batch;
    the sessions may then be dealt to ``buckets``, each of which keeps the state of its sessions.

    The state API needs a RocksDB store, which is set for the session. Input rows carry no
    watermarked column: Spark would drop late rows before the session could report them."""
    events.sparkSession.conf.set(STORE_KEY, ROCKSDB)
    # the watermark needs an instant type; the session time zone is UTC, so the
    # NTZ wall-clock value maps to the same instant
    marked = (events.withColumn("event_time", F.col("ts").cast("timestamp"))
              .withWatermark("event_time", lateness)
              .select("user_id", "day", "ts", "event_id", "event"))
    if bounded and buckets:
        return (marked.withColumn("bucket", F.pmod(F.xxhash64("user_id", "day"), F.lit(buckets)))
                .groupBy("bucket").transformWithState(BucketMachine(True), OUTPUT_SCHEMA, "append", "EventTime"))
    return marked.groupBy("user_id", "day").transformWithState(
        SessionMachine(bounded), OUTPUT_SCHEMA, "append", "EventTime")


def late_events(out: DataFrame) -> DataFrame:
    """``event, n``: the events that came after the watermark had passed them."""
    return out.where("late").groupBy("event").agg(F.count("*").alias("n"))


def run_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drive the stream over the ``events`` table (one file or a folder of them) to completion
    in one micro-batch, sinking to Parquet under the shared checkpoint folder; return the
    sink table."""
    from ..plans.roles import FSM_EVENT_OF
    base = os.path.join(checkpoint_dir(spark), f"fsm-stream-{uuid.uuid4().hex[:12]}")
    path = os.path.join(sf_dir, "events.parquet")
    m = F.create_map(*[x for k, v in FSM_EVENT_OF.items() for x in (F.lit(k), F.lit(v))])
    # as a pattern, a path may name one file as well as a folder of files
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema).parquet(path[:-1] + "[t]")
    ev = stream.select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id",
        F.coalesce(F.element_at(m, F.col("event_type")), F.upper("event_type")).alias("event"))
    # by the number of events (from the footers), so that a bucket does not grow with the table
    buckets = max(table.count() // BUCKET_EVENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    q = (transitions_stream(ev, bounded=True, buckets=buckets).writeStream.format("parquet")
         .option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "state"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    register_cleanup(spark, base)
    return spark.read.schema(OUTPUT_SCHEMA).parquet(os.path.join(base, "out"))
