"""State machines over whole event tables: V9, V10 (trace), V11.

What a run of events does is a function from the state before it to the state after it, and
such functions compose: the function of two runs in a row is that of the second after that of
the first. So a session needs no task of its own. Its events are cut into runs by ranges of
their order, each run is folded apart into its function (an array with one entry per state:
where it ends, after how many transitions, by which path), and the functions of a session are
composed in order, ``SPAN`` at a time. Any transition table will do, with cycles or without.

Sessions of up to ``MAX_RUN`` legal events are one run, a sorted array folded from the initial
state; their events are not written. Where each session ends is written, a row per session. Events that do not move the machine are the illegal ones (the
reference raises on them; the state stays unchanged). Ties in the order go by the event; a NULL
session key is a session of its own, and an event in no transition only counts.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import join_by_keys

# States, events and the transition table of the workflow.
IDLE = "IDLE"
FACE_VERIFICATION = "FACE_VERIFICATION"
VOICE_VERIFICATION = "VOICE_VERIFICATION"
RECOMMENDATION = "RECOMMENDATION"
ACCESS_DENIED = "ACCESS_DENIED"
COMPLETED = "COMPLETED"
START = "START"
VERIFICATION_PASSED = "VERIFICATION_PASSED"
VERIFICATION_FAILED = "VERIFICATION_FAILED"
RECOMMENDATION_READY = "RECOMMENDATION_READY"

TRANSITIONS = [
    (IDLE, START, FACE_VERIFICATION),
    (FACE_VERIFICATION, VERIFICATION_PASSED, VOICE_VERIFICATION),
    (FACE_VERIFICATION, VERIFICATION_FAILED, ACCESS_DENIED),
    (VOICE_VERIFICATION, VERIFICATION_PASSED, RECOMMENDATION),
    (VOICE_VERIFICATION, VERIFICATION_FAILED, ACCESS_DENIED),
    (RECOMMENDATION, RECOMMENDATION_READY, COMPLETED),
]
TERMINAL_STATES = (ACCESS_DENIED, COMPLETED)
#: A cyclic variant: a finished session may start again (no terminal states).
RETRY_TRANSITIONS = TRANSITIONS + [(ACCESS_DENIED, START, FACE_VERIFICATION),
                                   (COMPLETED, START, FACE_VERIFICATION)]
FAIL_STAGE = {FACE_VERIFICATION: "face", VOICE_VERIFICATION: "voice",
              RECOMMENDATION: "recommendation"}
DEFAULT_FAIL_STAGE = "face"
COMPLETE_STAGE = "complete"


def transition_table(spark: SparkSession, transitions=TRANSITIONS) -> DataFrame:
    return spark.createDataFrame(transitions, "state string, event string, next_state string")


#: Legal events of a run: those of one array that is sorted and folded in a row.
MAX_RUN = 50_000
#: Functions composed in one row; events of a run's chunk whose moves are listed in one row.
SPAN, CHUNK = 1_000, 256
#: Sessions of several runs up to which their list is broadcast (counted).
MAX_LONG_SESSIONS = 100_000

REACHED = "struct<s: int, n: bigint, prev: int, path: string>"


def longest_path(transitions=TRANSITIONS, initial: str = IDLE) -> int | None:
    """Most transitions a session can make; None where the table has a cycle."""
    nxt: dict[str, set[str]] = {}
    for s, _, t in transitions:
        nxt.setdefault(s, set()).add(t)

    def depth(s, seen):
        if s in seen:
            return None
        steps = [depth(t, seen | {s}) for t in nxt.get(s, ())]
        return None if None in steps else 1 + max(steps, default=0)
    longest = depth(initial, frozenset())
    return None if longest is None else longest - 1


class Machine:
    """A transition table as column expressions over state and event numbers."""

    def __init__(self, transitions, initial: str, terminal=(), path: bool | None = None):
        self.states = list(dict.fromkeys([initial, *chain.from_iterable((s, t) for s, _, t in transitions)]))
        self.events = sorted({e for _, e, _ in transitions})
        table = {(s, e): t for s, e, t in transitions if s not in terminal}
        to = [self.states.index(table[s, e]) if (s, e) in table else -1 for s in self.states for e in self.events]
        self.next = F.array(*[F.lit(x) for x in to])
        self.names = F.array(*[F.lit(x) for x in self.states])
        # the path of a cyclic table may be as long as the session: ``moves`` lists it by rows
        self.path = longest_path(transitions, initial) is not None if path is None else path

    def code(self, event: Column) -> Column:
        """The event's number; NULL if it is in no transition."""
        if not self.events:
            return F.lit(None).cast("int")
        return F.element_at(F.create_map(*chain.from_iterable(
            (F.lit(e), F.lit(i)) for i, e in enumerate(self.events))), event)

    def name(self, state: Column) -> Column:
        return F.get(self.names, state)

    def to(self, state: Column, event: Column) -> Column:
        """The next state's number; -1 if the event is illegal."""
        return F.get(self.next, state * len(self.events) + event)

    def at(self, state) -> Column:
        """Being in a state, with no transitions made."""
        state = F.lit(state) if isinstance(state, int) else state
        return F.struct(state.cast("int").alias("s"), F.lit(0).cast("bigint").alias("n"),
                        F.lit(-1).alias("prev"), F.lit("").alias("path")).cast(REACHED)

    def step(self, x: Column, event: Column) -> Column:
        to = self.to(x["s"], event)
        path = F.concat(x["path"], F.lit(">"), self.name(to)) if self.path else F.lit("")
        moved = F.struct(to.alias("s"), (x["n"] + 1).alias("n"), x["s"].alias("prev"), path.alias("path"))
        return F.when(to < 0, x).otherwise(moved.cast(REACHED))

    def after(self, x: Column, run: Column) -> Column:
        """Being at ``x`` and then going through a run, given by its function."""
        y = F.get(run, x["s"])
        return F.struct(y["s"].alias("s"), (x["n"] + y["n"]).alias("n"),
                        F.when(y["n"] > 0, y["prev"]).otherwise(x["prev"]).alias("prev"),
                        F.concat(x["path"], y["path"]).alias("path")).cast(REACHED)

    def identity(self) -> Column:
        return F.array(*[self.at(i) for i in range(len(self.states))])

    def function(self, events: Column) -> Column:
        """The function of a run of event numbers in order."""
        return F.aggregate(events, self.identity(), lambda f, e: F.transform(f, lambda x: self.step(x, e)))

    def composed(self, runs: Column) -> Column:
        """The function of consecutive runs."""
        return F.aggregate(runs, self.identity(), lambda f, g: F.transform(f, lambda x: self.after(x, g)))


def _coded(events: DataFrame, session: list[str], order: list[str], event_col: str, m: Machine) -> DataFrame:
    """``*session, _e`` with the event's order and number; ``_e`` is NULL for other events."""
    code = m.code(F.col(event_col))
    return events.select(*session, F.when(code.isNotNull(), F.struct(*order, code.alias("_code"))).alias("_e"))


def _cut(ev: DataFrame, session: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The events of sessions that are one run, and those of the others with their ``_run``."""
    long = materialize(ev.where("_e IS NOT NULL").groupBy(*session).agg(F.count("*").alias("_n")).where(
        F.col("_n") > MAX_RUN), "fsm-long")
    size = long.agg(F.count("*").alias("sessions"), F.sum("_n").alias("n")).first()
    if not size.sessions:
        return ev, None
    told = join_by_keys(ev, long.select(*session, F.lit(True).alias("_long")), session, "left",
                        small=size.sessions <= MAX_LONG_SESSIONS)
    # ranges of the order itself, so that equal orders stay together; written, so that they hold
    runs = told.where("_long AND _e IS NOT NULL").drop("_long").repartitionByRange(
        max(2, 2 * -(-size.n // MAX_RUN)), *session, "_e").withColumn("_run", F.spark_partition_id())
    return told.where("_long IS NULL").drop("_long"), materialize(runs, "fsm-runs")


def _folded(runs: DataFrame, session: list[str], m: Machine) -> DataFrame:
    """``*session, _run, _f``: the function of every run."""
    return runs.groupBy(*session, "_run").agg(F.array_sort(F.collect_list("_e")).alias("_es")).select(
        *session, "_run", m.function(F.transform("_es", lambda e: e["_code"])).alias("_f"))


def _in_order(functions: DataFrame, session: list[str]) -> DataFrame:
    """``*session, _fs``: the runs and functions of a session in order."""
    return functions.groupBy(*session).agg(F.array_sort(F.collect_list(F.struct("_run", "_f"))).alias("_fs"))


def _most_runs(functions: DataFrame, session: list[str]) -> int:
    return functions.groupBy(*session).count().agg(F.max("count")).first()[0] or 0


def _spans(functions: DataFrame, session: list[str], m: Machine) -> DataFrame:
    """The functions of ``SPAN`` consecutive runs each."""
    spans = functions.select(*session, F.expr(f"_run div {SPAN}").alias("_span"), "_run", "_f")
    return _in_order(spans, [*session, "_span"]).select(
        *session, F.col("_span").alias("_run"), m.composed(F.transform("_fs", lambda r: r["_f"])).alias("_f"))


def _ends(functions: DataFrame, session: list[str], m: Machine, initial: Column) -> DataFrame:
    """``*session, _x``: where each session ends, by composing its functions in order."""
    functions = materialize(functions, "fsm-functions")
    while _most_runs(functions, session) > SPAN:
        functions = materialize(_spans(functions, session, m), "fsm-functions")
    return _in_order(functions, session).select(
        *session, F.aggregate("_fs", initial, lambda x, r: m.after(x, r["_f"])).alias("_x"))


def _starts(functions: DataFrame, session: list[str], m: Machine, initial: int) -> DataFrame:
    """``*session, _run, _start``: the state before each run, by a scan over spans of runs."""
    functions = materialize(functions, "fsm-functions")

    def scan(fs: Column, start: Column) -> Column:
        """The state before each of at most ``SPAN`` runs."""
        first = F.struct(start.cast("int").alias("s"), F.expr("array()").cast("array<int>").alias("all"))
        return F.aggregate(fs, first, lambda x, r: F.struct(
            F.get(r["_f"], x["s"])["s"].alias("s"), F.concat(x["all"], F.array(x["s"])).alias("all")),
            lambda x: x["all"])

    def listed(rows: DataFrame, starts: Column) -> DataFrame:
        return rows.select(*session, F.inline(F.arrays_zip(
            F.transform("_fs", lambda r: r["_run"]).alias("_run"), starts.alias("_start"))))
    if _most_runs(functions, session) <= SPAN:
        return listed(_in_order(functions, session), scan(F.col("_fs"), F.lit(initial)))
    before = _starts(_spans(functions, session, m), session, m, initial).withColumnsRenamed(
        {"_run": "_span", "_start": "_from"})
    spans = _in_order(functions.withColumn("_span", F.expr(f"_run div {SPAN}")), [*session, "_span"])
    return listed(join_by_keys(spans, before, [*session, "_span"]), scan(F.col("_fs"), F.col("_from")))


def replay(events: DataFrame, session: list[str], order: list[str], event_col: str = "event",
           transitions=TRANSITIONS, initial: str = IDLE, terminal=TERMINAL_STATES) -> DataFrame:
    """V9: one row per session with final state, history, counts and outcome.

    ``history`` is NULL for a cyclic table, where it may be as long as the session; ``moves``
    has it by rows.
    """
    m = Machine(transitions, initial, terminal)
    short, runs = _cut(_coded(events, session, order, event_col, m), session)
    # no moves lead out of a terminal state: its entries in the table are left out
    done = short.groupBy(*session).agg(F.count("*").alias("n_events"),
                                       F.array_sort(F.collect_list("_e")).alias("_es")).select(
        *session, "n_events", F.aggregate(F.transform("_es", lambda e: e["_code"]), m.at(0), m.step).alias("_x"))
    if runs is not None:
        counts = events.groupBy(*session).agg(F.count("*").alias("n_events")).where(F.col("n_events") > MAX_RUN)
        ends = _ends(_folded(runs, session, m), session, m, m.at(0))
        done = done.unionByName(join_by_keys(counts, ends, session).select(*done.columns))
    done = materialize(done, "fsm-ends")      # a row per session, read by every report on them
    x = F.col("_x")
    stage_map = F.create_map(*[x for k, v in FAIL_STAGE.items() for x in (F.lit(k), F.lit(v))])
    state, before_last = m.name(x["s"]), F.when(x["prev"] >= 0, m.name(x["prev"]))
    history = F.concat(F.lit(initial), x["path"]) if m.path else F.lit(None).cast("string")
    return done.select(
        *session, state.alias("final_state"), "n_events",
        x["n"].alias("n_transitions"), (F.col("n_events") - x["n"]).alias("n_illegal"),
        state.isin(*terminal).alias("is_terminal"), (state == F.lit(COMPLETED)).alias("granted"),
        F.when(state == F.lit(COMPLETED), F.lit(COMPLETE_STAGE))
        .when(state == F.lit(ACCESS_DENIED),
              F.coalesce(F.element_at(stage_map, before_last), F.lit(DEFAULT_FAIL_STAGE)))
        .alias("stage"), history.alias("history"))


def moves(events: DataFrame, session: list[str], order: list[str], event_col: str = "event",
          transitions=TRANSITIONS, initial: str = IDLE, terminal=TERMINAL_STATES) -> DataFrame:
    """``*session, *order, from_state, event, to_state``: every transition made, a row each."""
    m = Machine(transitions, initial, terminal, path=False)
    short, runs = _cut(_coded(events, session, order, event_col, m), session)
    short = short.where("_e IS NOT NULL").groupBy(*session).agg(F.array_sort(F.collect_list("_e")).alias("_es")).withColumn(
        "_start", F.lit(0))
    if runs is not None:
        starts = _starts(_folded(runs, session, m), session, m, 0)
        of_run = runs.groupBy(*session, "_run").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
        short = short.unionByName(join_by_keys(of_run, starts, [*session, "_run"]).drop("_run"))
    # chunks of a run: their functions give their starts, and each lists its own moves
    codes = lambda c: F.transform(c, lambda e: e["_code"])
    chunks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(_es) - 1) div {CHUNK}")),
                         lambda i: F.slice("_es", i * CHUNK + 1, CHUNK))
    cut = short.withColumn("_chunks", chunks)
    first = F.struct(F.col("_start").cast("int").alias("s"), F.expr("array()").cast("array<int>").alias("all"))
    begins = F.aggregate("_chunks", first, lambda x, c: F.struct(
        F.aggregate(codes(c), m.at(x["s"]), m.step)["s"].alias("s"),
        F.concat(x["all"], F.array(x["s"])).alias("all")), lambda x: x["all"])
    rows = cut.select(*session, F.inline(F.arrays_zip(F.col("_chunks").alias("_es"), begins.alias("_start"))))
    move = "array<struct<e: int, s: int, t: int>>"

    def listed(x: Column, e: Column) -> Column:
        to = m.to(x["s"], e["_code"])
        made = F.struct((x["i"]).alias("e"), x["s"].alias("s"), to.alias("t"))
        return F.struct((x["i"] + 1).alias("i"), F.when(to < 0, x["s"]).otherwise(to).alias("s"), F.when(
            to < 0, x["all"]).otherwise(F.concat(x["all"], F.array(made).cast(move))).alias("all"))
    start = F.struct(F.lit(0).alias("i"), F.col("_start").alias("s"), F.expr("array()").cast(move).alias("all"))
    out = rows.select(*session, "_es", F.inline(F.aggregate("_es", start, listed, lambda x: x["all"])))
    made = F.get("_es", F.col("e"))
    return out.select(*session, *[made[c].alias(c) for c in order], m.name(F.col("s")).alias("from_state"),
                      F.get(F.array(*[F.lit(e) for e in m.events]), made["_code"]).alias("event"),
                      m.name(F.col("t")).alias("to_state"))


def allowed_events(current: DataFrame, state_col: str = "final_state",
                   transitions=TRANSITIONS) -> DataFrame:
    """Legal next events of each current state (none for terminal states)."""
    t = F.broadcast(transition_table(current.sparkSession, transitions)
                    .select(F.col("state").alias(state_col),
                            F.col("event").alias("allowed_event")))
    return current.join(t, state_col, "left").withColumn(
        "is_terminal", F.col(state_col).isin(*TERMINAL_STATES))
