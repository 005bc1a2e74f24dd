"""The escalation ladder: groups of incidents share their state, and the actions stay those of each incident."""

import datetime as dt
import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd

from caselight.streaming import jobs, ladder
from tests.helpers import rows

MINUTE = 60_000


class Store:
    """State and timers of one group; counts the calls, each of which is a message to the JVM in a stream."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def _called(self):
        self.calls += 1

    def get(self):
        self._called()
        return self.value

    def update(self, value):
        self._called()
        self.value = value

    def clear(self):
        self._called()
        self.value = None

    def registerTimer(self, at):
        self._called()
        assert at not in self.timers
        self.timers.add(at)

    def deleteTimer(self, at):
        self._called()
        self.timers.remove(at)


def batch(ladder_, store, arrived, now):
    """One micro-batch of a group: its rows, then its timers up to the watermark."""
    if arrived:
        frame = pd.DataFrame(arrived, columns=ladder.ROW)
        frame["bucket"] = 7
        parts = [frame[:2], frame[2:]]
        assert list(ladder_.handleInputRows((7,), iter(parts), None)) == []
    found = []
    for due in sorted(store.timers):
        if due <= now:
            times = SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
            for actions in ladder_.handleExpiredTimer((7,), times, SimpleNamespace(getExpiryTimeInMs=lambda: due)):
                found += [(r.incident_id, r.severity, r.proposed_sql, r.action, r.due_ms) for r in actions.itertuples()]
            store.timers.discard(due)
    return found


class Single:
    """What one incident does, with a timer for each thing that may fall due."""

    def __init__(self, step, keep):
        self.step, self.keep, self.open, self.resolved, self.timers = step, keep, None, None, set()

    def row(self, at, resolves, severity, mailed, paused, sql):
        if resolves:
            self.resolved = at if self.resolved is None else max(at, self.resolved)
            if self.open and self.open["start"] <= self.resolved:
                self.open, self.timers = None, set()
            self.timers.add(self.resolved + self.keep)
        elif self.open is None and severity in ("P0", "P1") and (self.resolved is None or at > self.resolved):
            self.open = {"severity": severity, "start": at, "mailed": mailed, "paused": paused, "sql": sql}
            self.timers |= {at + self.step, at + 2 * self.step} if severity == "P0" else {at + self.step}

    def until(self, now):
        for due in sorted(t for t in self.timers if t <= now):
            self.timers.discard(due)
            if self.resolved is not None and due >= self.resolved + self.keep:
                self.resolved = None
            if self.open is None:
                continue
            turn, is_p0 = (due - self.open["start"]) / self.step, self.open["severity"] == "P0"
            kind, done = (None, False), self.open
            if not is_p0 and turn == 1:
                kind = ("auto_apply", True)
            elif is_p0 and turn == 1:
                kind = (None if self.open["mailed"] else "send_mail", False)
            elif is_p0 and turn == 2:
                kind = (None if self.open["paused"] else "pause_dag", True)
            if kind[1]:
                self.open = None
            if kind[0]:
                yield done["severity"], done["sql"], kind[0], due


def test_a_group_acts_as_its_incidents_do_one_by_one():
    draw = random.Random(5)
    fired = Counter()
    for _ in range(150):
        step, keep = 30, draw.choice([40, 200])
        store = Store()
        grouped = ladder.EscalationLadder(step, keep)
        grouped.init(store)
        single = {}
        now = 0
        for _ in range(12):
            # Times differ inside a batch: which of two requests of one moment counts is open.
            times = draw.sample(range(max(0, now // MINUTE - 70), now // MINUTE + 60), draw.randint(0, 9))
            arrived = []
            for minute in times:
                incident = draw.choice(["a", "b", "c", "d", 'q"\né', None])
                arrived.append((incident, minute * MINUTE, draw.random() < 0.3, draw.choice(["P0", "P1", None]),
                                draw.random() < 0.3, draw.random() < 0.3, draw.choice(["DROP x", " '", None])))
            now = max([now, *(row[1] for row in arrived)])
            expected = []
            for row in sorted(arrived, key=lambda r: (r[1], r[2])):
                if row[0] is not None:
                    single.setdefault(row[0], Single(step * MINUTE, keep * MINUTE)).row(*row[1:])
            for incident, one in single.items():
                expected += [(incident, *action) for action in one.until(now)]
            assert Counter(batch(grouped, store, arrived, now)) == Counter(expected)
            fired.update(action[3] for action in expected)
            assert len(store.timers) <= 1
            busy = [one for one in single.values() if one.open or one.resolved is not None]
            assert (store.value is not None) == bool(busy)
    assert min(fired[kind] for kind in ("auto_apply", "send_mail", "pause_dag")) > 100


def test_calls_to_the_state_do_not_grow_with_the_incidents_of_a_group():
    store = Store()
    grouped = ladder.EscalationLadder(30, 10_000)
    grouped.init(store)
    asked = [(str(n), n % 50 * MINUTE, False, "P1" if n % 2 else "P0", False, False, "x") for n in range(5_000)]
    found = batch(grouped, store, asked, 200 * MINUTE)
    assert Counter(action for _, _, _, action, _ in found) == {"auto_apply": 2_500, "send_mail": 2_500, "pause_dag": 2_500}
    assert store.calls < 10


def test_what_falls_due_in_a_group_leaves_as_one_frame():
    store = Store()
    grouped = ladder.EscalationLadder(30, 10_000)
    grouped.init(store)
    asked = pd.DataFrame([(str(n), n * MINUTE, False, "P1", False, False, None) for n in range(100)], columns=ladder.ROW)
    assert list(grouped.handleInputRows((7,), iter([asked]), None)) == []
    first, = store.timers
    now = 79 * MINUTE
    times, info = SimpleNamespace(getCurrentWatermarkInMs=lambda: now), SimpleNamespace(getExpiryTimeInMs=lambda: first)
    frames = list(grouped.handleExpiredTimer((7,), times, info))
    assert [len(frame) for frame in frames] == [50]
    assert sorted(frames[0].due_ms) == [(n + 30) * MINUTE for n in range(50)]
    assert store.timers - {first} == {80 * MINUTE}


def test_the_stream_keeps_one_state_for_a_group(spark, tmp_path):
    ddl = ("incident_id string, severity string, status string, created_at timestamp_ntz, "
           "escalation_email_sent_at timestamp_ntz, dag_paused_at timestamp_ntz, proposed_sql string")
    start = dt.datetime(2024, 3, 1)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.STATE_PROVIDER)

    def feed(*data):
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = ladder.escalations(spark.readStream.schema(ddl).parquet(source), buckets=4)
        query = jobs.start_table(stream, out, checkpoint)
        query.awaitTermination()
        kept = sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])
        return kept, rows(spark.read.schema(stream.schema).parquet(out), "incident_id", "action", "step")

    try:
        asked = [(f"i{n}", f"P{n % 3}", "pending", start, None, start if n % 2 else None, None) for n in range(600)]
        kept, found = feed(*asked)
        assert found == []
        assert 0 < kept <= 4 * 3  # a value, a timer by group and a timer by time; 400 incidents wait
        kept, found = feed((None, None, "heartbeat", start + dt.timedelta(minutes=60), None, None, None))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    expected = [(f"i{n}", "send_mail", None) for n in range(0, 600, 3)]
    expected += [(f"i{n}", "pause_dag", None) for n in range(0, 600, 6)]
    expected += [(f"i{n}", "auto_apply", "retry") for n in range(1, 600, 3)]
    assert kept == 0 and found == sorted(expected, key=repr)
