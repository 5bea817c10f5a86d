"""State-machine replay (V9/V11) on literal event sequences."""

import datetime as dt

from sparkgate.operators import fsm

SCHEMA = "sid string, ord long, ts timestamp_ntz, event string"


def _events(spark, seqs):
    rows = []
    base = dt.datetime(2025, 1, 1)
    for sid, evs in seqs.items():
        for i, e in enumerate(evs):
            rows.append((sid, i, base + dt.timedelta(seconds=i), e))
    return spark.createDataFrame(rows, SCHEMA)


def _replay(spark, seqs):
    out = fsm.replay(_events(spark, seqs), ["sid"], ["ts", "ord"])
    return {r["sid"]: r for r in out.collect()}


def test_transition_table_has_six_rows(spark):
    assert fsm.transition_table(spark).count() == 6
    assert fsm.longest_path() == 4


def test_happy_path_completes(spark):
    r = _replay(spark, {"a": ["START", "VERIFICATION_PASSED", "VERIFICATION_PASSED",
                              "RECOMMENDATION_READY"]})["a"]
    assert r["final_state"] == "COMPLETED"
    assert r["history"] == "IDLE>FACE_VERIFICATION>VOICE_VERIFICATION>RECOMMENDATION>COMPLETED"
    assert r["granted"] and r["is_terminal"] and r["stage"] == "complete"
    assert r["n_illegal"] == 0


def test_face_failure_denies_without_voice_state(spark):
    r = _replay(spark, {"b": ["START", "VERIFICATION_FAILED"]})["b"]
    assert r["final_state"] == "ACCESS_DENIED"
    assert "VOICE_VERIFICATION" not in r["history"]
    assert r["stage"] == "face" and not r["granted"]


def test_voice_failure_denies_without_recommendation(spark):
    r = _replay(spark, {"c": ["START", "VERIFICATION_PASSED", "VERIFICATION_FAILED"]})["c"]
    assert r["final_state"] == "ACCESS_DENIED"
    assert "RECOMMENDATION" not in r["history"].split(">")
    assert r["stage"] == "voice"


def test_illegal_event_leaves_state_unchanged_and_is_counted(spark):
    r = _replay(spark, {"d": ["VERIFICATION_PASSED"]})["d"]
    assert r["final_state"] == "IDLE" and r["n_illegal"] == 1 and r["history"] == "IDLE"


def test_terminal_state_refuses_further_events(spark):
    r = _replay(spark, {"e": ["START", "VERIFICATION_FAILED", "START", "VERIFICATION_PASSED"]})["e"]
    assert r["final_state"] == "ACCESS_DENIED" and r["n_illegal"] == 2


def test_skipped_illegal_events_between_legal_ones(spark):
    r = _replay(spark, {"f": ["CLICK", "START", "CLICK", "RECOMMENDATION_READY",
                              "VERIFICATION_PASSED"]})["f"]
    assert r["final_state"] == "VOICE_VERIFICATION"
    assert r["n_transitions"] == 2 and r["n_illegal"] == 3


def test_allowed_events(spark):
    cur = spark.createDataFrame([("x", "FACE_VERIFICATION"), ("y", "COMPLETED")],
                                "sid string, final_state string")
    got = {}
    for r in fsm.allowed_events(cur).collect():
        got.setdefault(r["sid"], set()).add(r["allowed_event"])
    assert got["x"] == {"VERIFICATION_PASSED", "VERIFICATION_FAILED"}
    assert got["y"] == {None}


def test_replay_matches_sequential_fold(spark):
    """Brute force: fold each session in Python and compare."""
    import random
    rnd = random.Random(7)
    evs = ["START", "VERIFICATION_PASSED", "VERIFICATION_FAILED", "RECOMMENDATION_READY", "CLICK"]
    seqs = {f"s{i}": [rnd.choice(evs) for _ in range(rnd.randint(1, 9))] for i in range(60)}
    table = {(s, e): t for s, e, t in fsm.TRANSITIONS}
    got = _replay(spark, seqs)
    for sid, seq in seqs.items():
        state, hist, bad = "IDLE", ["IDLE"], 0
        for e in seq:
            nxt = table.get((state, e))
            if nxt is None:
                bad += 1
            else:
                state = nxt
                hist.append(nxt)
        assert got[sid]["final_state"] == state, sid
        assert got[sid]["history"] == ">".join(hist), sid
        assert got[sid]["n_illegal"] == bad, sid


def test_stream_equals_batch_replay(spark):
    """The stateful stream ends every session in the same state as the replay."""
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    s = E.queries()["fsm_stream"](spark, SF_SMALL)
    b = E.queries()["fsm_replay"](spark, SF_SMALL)
    j = s.alias("s").join(b.alias("b"), ["user_id", "day"], "full")
    bad = j.where("s.final_state IS NULL OR b.final_state IS NULL OR "
                  "s.final_state != b.final_state OR s.n_illegal != b.n_illegal OR "
                  "s.n_events != b.n_events")
    assert bad.count() == 0 and b.count() > 0


def _live_events(spark):
    import __spark_entry__  # noqa: F401
    from sparkgate.plans.roles import fsm_events
    from tests.conftest import SF_SMALL
    return fsm_events(spark, SF_SMALL), SF_SMALL


def _stored(spark, tmp_path, parts, newest_first=False):
    """The events table as one file or as a folder of several, with chosen file times."""
    import os
    import shutil
    _, sf = _live_events(spark)
    folder = tmp_path / f"t{parts}{newest_first}"
    folder.mkdir()
    src = f"{sf}/events.parquet"
    if parts == 1:
        shutil.copy(src, folder / "events.parquet")
        return str(folder)
    spark.read.parquet(src).repartitionByRange(parts, "ts").write.parquet(str(folder / "events.parquet"))
    files = sorted(f for f in os.listdir(folder / "events.parquet") if f.endswith(".parquet"))
    for i, f in enumerate(files):
        t = 1_700_000_000 + (-i if newest_first else i) * 1000
        os.utime(folder / "events.parquet" / f, (t, t))
    return str(folder)


def test_stream_reads_every_file_in_any_order(spark, tmp_path):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    cols = ["user_id", "day", "final_state", "n_events", "n_illegal"]
    want = sorted(map(str, E.queries()["fsm_replay"](spark, SF_SMALL).select(cols).collect()))
    for parts, newest in ((1, False), (4, False), (4, True)):
        got = E.queries()["fsm_stream"](spark, _stored(spark, tmp_path, parts, newest)).select(cols)
        assert sorted(map(str, got.collect())) == want, (parts, newest)


def test_live_stream_orders_events_across_micro_batches(spark, tmp_path):
    """Files come newest first, one in a micro-batch: events wait for the watermark."""
    import datetime as dt

    from sparkgate.streaming.fsm_stream import OUTPUT_SCHEMA, transitions_stream
    day, base = dt.date(2025, 1, 1), dt.datetime(2025, 1, 1)
    seq = ["START", "CLICK", "VERIFICATION_PASSED", "VERIFICATION_PASSED", "START", "RECOMMENDATION_READY", "CLICK"]
    batches = [[(1, day, base + dt.timedelta(minutes=i), i, e)] for i, e in reversed(list(enumerate(seq)))]
    batches.append([(2, day, base + dt.timedelta(days=9), 99, "START")])   # moves the watermark on
    import os
    schema = "user_id long, day date, ts timestamp_ntz, event_id long, event string"
    for k, rows in enumerate(batches):
        path = tmp_path / f"b{k}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        (tmp_path / "in").mkdir(exist_ok=True)
        os.rename(path / part, tmp_path / "in" / f"{k}.parquet")
        os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k * 1000,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (transitions_stream(stream, lateness="1 day").writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.schema(OUTPUT_SCHEMA).parquet(str(tmp_path / "out")).where("user_id = 1").orderBy("n_events").collect()
    assert [r.event for r in got] == seq
    assert got[-1].to_state == "COMPLETED" and [r.legal for r in got].count(False) == 3


def _put_file(spark, tmp_path, k, rows):
    """One more input file for a stream that reads one file in a micro-batch."""
    import os
    schema = "user_id long, day date, ts timestamp_ntz, event_id long, event string"
    path = tmp_path / f"b{k}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))
    part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    (tmp_path / "in").mkdir(exist_ok=True)
    os.rename(path / part, tmp_path / "in" / f"{k}.parquet")
    os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k * 1000,) * 2)
    return schema


def _run_live(spark, tmp_path, schema, out, state, lateness="10 minutes"):
    from sparkgate.streaming.fsm_stream import OUTPUT_SCHEMA, transitions_stream
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    (transitions_stream(stream, lateness=lateness).writeStream.format("parquet").option("path", str(tmp_path / out))
     .option("checkpointLocation", str(tmp_path / state)).outputMode("append")
     .trigger(availableNow=True).start()).awaitTermination()
    return spark.read.schema(OUTPUT_SCHEMA).parquet(str(tmp_path / out))


def test_late_events_come_out_marked_and_counted(spark, tmp_path):
    import datetime as dt

    from sparkgate.streaming.fsm_stream import late_events
    day, base = dt.date(2025, 1, 1), dt.datetime(2025, 1, 1)
    at = lambda m: base + dt.timedelta(minutes=m)
    schema = _put_file(spark, tmp_path, 0, [(1, day, at(0), 0, "START"), (1, day, at(30), 3, "VERIFICATION_PASSED")])
    _put_file(spark, tmp_path, 1, [(2, day, at(200), 9, "START")])                    # the watermark passes 30
    _put_file(spark, tmp_path, 2, [(1, day, at(5), 1, "CLICK"), (1, day, at(195), 4, "VERIFICATION_FAILED")])
    _put_file(spark, tmp_path, 3, [(2, day, at(9_000), 10, "CLICK")])
    out = _run_live(spark, tmp_path, schema, "out", "state")
    rows = {r.event_id: r for r in out.where("user_id = 1").collect()}
    assert {r.event: r.n for r in late_events(out).collect()} == {"CLICK": 1}
    assert rows[1].late and rows[1].from_state == rows[1].to_state and not rows[1].legal
    assert [rows[i].to_state for i in (0, 3, 4)] == ["FACE_VERIFICATION", "VOICE_VERIFICATION", "ACCESS_DENIED"]
    assert not any(rows[i].late for i in (0, 3, 4)) and rows[4].n_events == 3


def test_restart_from_the_checkpoint_gives_the_same_rows(spark, tmp_path):
    """The stream stops after each file and starts again from its checkpoint."""
    import datetime as dt
    import random
    rnd = random.Random(2)
    day, base = dt.date(2025, 1, 1), dt.datetime(2025, 1, 1)
    evs = ["START", "VERIFICATION_PASSED", "VERIFICATION_FAILED", "RECOMMENDATION_READY", "CLICK"]
    rows = [(u, day, base + dt.timedelta(seconds=rnd.randrange(4_000)), u * 100 + i, rnd.choice(evs))
            for u in range(6) for i in range(12)]
    rnd.shuffle(rows)
    files = [rows[:30], rows[30:60], rows[60:], [(99, day, base + dt.timedelta(days=2), 9_999, "START")]]
    got = []
    for k, part in enumerate(files):
        schema = _put_file(spark, tmp_path, k, part)
        got = _run_live(spark, tmp_path, schema, "out", "state", "3 hours")
    stopped = sorted(map(str, got.collect()))
    whole = sorted(map(str, _run_live(spark, tmp_path, schema, "out2", "state2", "3 hours").collect()))
    assert stopped == whole and len(whole) == 72
    by_user = {u: [r for r in sorted(rows, key=lambda r: (r[2], r[3])) if r[0] == u] for u in range(6)}
    for u, seq in by_user.items():
        state, _, bad = _fold([r[4] for r in seq], fsm.TRANSITIONS, fsm.IDLE, fsm.TERMINAL_STATES)
        mine = [r for r in got.where(f"user_id = {u}").orderBy("n_events").collect()]
        assert [r.event_id for r in mine] == [r[3] for r in seq] and mine[-1].to_state == state
        assert sum(not r.legal for r in mine) == bad


def test_replay_plan_does_not_grow_with_rounds(spark):
    out = fsm.replay(_events(spark, {"a": ["START"]}), ["sid"], ["ts", "ord"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 2


def _fold(seq, transitions, initial, terminal=()):
    """State, moves and illegal events of one session, event by event."""
    table = {(s, e): t for s, e, t in transitions if s not in terminal}
    state, made, bad = initial, [], 0
    for i, e in enumerate(seq):
        to = table.get((state, e))
        if to is None:
            bad += 1
        else:
            made.append((i, state, e, to))
            state = to
    return state, made, bad


def _random_table(rnd, states=5, events=4):
    """A random table with cycles: about half of the (state, event) pairs are legal."""
    out = [(f"S{s}", f"E{e}", f"S{rnd.randrange(states)}") for s in range(states) for e in range(events)
           if rnd.random() < 0.5]
    return [("S0", "E0", "S1"), ("S1", "E0", "S0")] + [t for t in out if t[:2] not in (("S0", "E0"), ("S1", "E0"))]


def test_cyclic_tables_and_hot_sessions_equal_the_fold(spark, monkeypatch):
    """Runs, spans and chunks of a few events each; one session has 90 % of the rows."""
    import random
    monkeypatch.setattr(fsm, "MAX_RUN", 40)
    monkeypatch.setattr(fsm, "SPAN", 3)
    monkeypatch.setattr(fsm, "CHUNK", 7)
    rnd = random.Random(3)
    t = _random_table(rnd)
    seqs = {f"s{i}": [f"E{rnd.randrange(6)}" for _ in range(rnd.randrange(1, 20))] for i in range(12)}
    seqs["hot"] = [f"E{rnd.randrange(5)}" for _ in range(1_100)]
    seqs["idle"] = ["E9"] * 100
    seqs[None] = ["E0"] * 45
    ev = _events(spark, seqs)
    got = {r.sid: r for r in fsm.replay(ev, ["sid"], ["ts", "ord"], transitions=t, initial="S0", terminal=()).collect()}
    made = {}
    for r in fsm.moves(ev, ["sid"], ["ts", "ord"], transitions=t, initial="S0", terminal=()).collect():
        made.setdefault(r.sid, []).append((r.ord, r.from_state, r.event, r.to_state))
    assert got.keys() == seqs.keys()
    for sid, seq in seqs.items():
        state, want, bad = _fold(seq, t, "S0")
        r = got[sid]
        assert (r.final_state, r.n_events, r.n_transitions, r.n_illegal) == (state, len(seq), len(want), bad), sid
        assert r.history is None and sorted(made.get(sid, [])) == want, sid


def test_hot_session_of_the_workflow_keeps_its_history(spark, monkeypatch):
    import random
    monkeypatch.setattr(fsm, "MAX_RUN", 10)
    rnd = random.Random(11)
    evs = ["VERIFICATION_PASSED", "RECOMMENDATION_READY", "VERIFICATION_PASSED", "CLICK"]
    seqs = {"hot": [rnd.choice(evs) for _ in range(200)] + ["START"] + [rnd.choice(evs) for _ in range(100)],
            "cold": ["START", "VERIFICATION_FAILED", "START"]}
    got = _replay(spark, seqs)
    for sid, seq in seqs.items():
        state, made, bad = _fold(seq, fsm.TRANSITIONS, fsm.IDLE, fsm.TERMINAL_STATES)
        assert got[sid].history == ">".join([fsm.IDLE, *(m[3] for m in made)])
        assert (got[sid].final_state, got[sid].n_illegal) == (state, bad)
    assert got["hot"].stage == "complete" and got["cold"].stage == "face"


def test_no_row_holds_a_hot_session(spark, monkeypatch):
    """The events folded in a row stay near MAX_RUN when a session grows."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(fsm, "MAX_RUN", 100)
    ev = spark.range(20_000).select(F.lit("hot").alias("sid"), F.col("id").alias("ord"), F.lit("START").alias("event"))
    m = fsm.Machine(fsm.TRANSITIONS, fsm.IDLE)
    short, runs = fsm._cut(fsm._coded(ev, ["sid"], ["ord"], "event", m), ["sid"])
    assert short.count() == 0 and runs.count() == 20_000
    assert runs.groupBy("_run").count().agg(F.max("count")).first()[0] <= 300


def test_cycles_are_told_from_long_paths():
    assert fsm.longest_path([("a", "x", "b"), ("b", "x", "c"), ("a", "y", "c")], "a") == 2
    assert fsm.longest_path([("a", "x", "b"), ("b", "x", "a")], "a") is None


def test_buckets_keep_the_state_of_their_sessions(spark, tmp_path):
    """Sessions in buckets give the rows of sessions by themselves; a later micro-batch goes on from the list."""
    import datetime as dt

    from sparkgate.streaming.fsm_stream import OUTPUT_SCHEMA, transitions_stream
    day, base = dt.date(2025, 1, 1), dt.datetime(2025, 1, 1)
    seq = ["START", "CLICK", "VERIFICATION_PASSED", "VERIFICATION_PASSED", "RECOMMENDATION_READY"]
    rows = [(u, day, base + dt.timedelta(minutes=i), 100 * u + i, e)
            for u in range(1, 8) for i, e in enumerate(seq[:u])]
    schema = _put_file(spark, tmp_path, 0, [r for r in rows if r[3] % 100 < 2])
    _put_file(spark, tmp_path, 1, [r for r in rows if r[3] % 100 >= 2])
    got = {}
    for buckets in (None, 2):
        out = str(tmp_path / f"out{buckets}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        (transitions_stream(stream, bounded=True, buckets=buckets).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-state").outputMode("append").trigger(availableNow=True)
         .start()).awaitTermination()
        got[buckets] = sorted(map(str, spark.read.schema(OUTPUT_SCHEMA).parquet(out).collect()))
    assert got[2] == got[None] and len(got[2]) == len(rows)
