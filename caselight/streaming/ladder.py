"""The escalation ladder with event-time timers."""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from caselight.functions.statements import ALLOWED_TABLES
from caselight.operators.approvals import timeout_step
from caselight.operators.incidents import TIMEOUT_MINUTES
from caselight.session import ship_package

MINUTE_MS = 60_000
#: Groups of incidents that share their state. A checkpoint belongs to this number.
BUCKETS = 16_384
OUTPUT_DDL = "incident_id string, severity string, proposed_sql string, action string, due_ms bigint"
#: What the processor reads of a row, besides the group.
ROW = ["incident_id", "requested_ms", "resolves", "severity", "mailed", "paused", "proposed_sql"]
STATE_DDL = "next_ms bigint, incidents string"
#: Places in what is known of an incident: its open request (no severity without one), with the number of its next timer,
#: and when the incident was last resolved.
SEVERITY, START, TURN, MAILED, PAUSED, SQL, RESOLVED = range(7)


class EscalationLadder(StatefulProcessor):
    """State per incident: the open request and when the incident was last resolved. Timers at one and two timeouts.

    The rows of an incident count in the order of their times, however they arrive. A request starts the timers its
    severity needs unless the incident was resolved at the same time or later; a later row with another status than
    pending clears it. What is known when a timer fires decides, so a resolution that came in before wins. An expiring
    timer emits the action that is still due. P2 and P3 never time out. A resolution is remembered for ``keep_minutes``.

    Every call to the state store is a message to the JVM and back, and so is each group of rows. So incidents are
    grouped by a hash: a group keeps all its incidents as one JSON text and has one timer, for what is due first there.
    """

    def __init__(self, timeout_minutes: int, keep_minutes: int):
        self.step, self.keep = timeout_minutes * MINUTE_MS, keep_minutes * MINUTE_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("incidents", STATE_DDL)

    def _load(self) -> tuple[int | None, dict[str, list]]:
        """The registered timer of the group and what is known of its incidents."""
        found = self.state.get()
        return (found[0], json.loads(found[1])) if found else (None, {})

    def _save(self, timer: int | None, incidents: dict[str, list]) -> None:
        """``timer`` is the one still registered."""
        due = min(map(self._next, incidents.values()))
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.state.update((due, json.dumps(incidents, ensure_ascii=False, separators=(",", ":"))))

    def _next(self, known: list) -> int:
        """When something is to be done for an incident."""
        severity, start, turn, *_, resolved = known
        if severity is None:
            return resolved + self.keep
        due = start + turn * self.step
        return due if resolved is None else min(due, resolved + self.keep)

    def _after(self, known: list | None, at: int, pending: bool, severity, mailed, paused, sql) -> list | None:
        """What is known of an incident after one more row."""
        resolved = known[RESOLVED] if known else None
        if pending:
            if severity not in ("P0", "P1") or known and known[SEVERITY] is not None or resolved is not None and at <= resolved:
                return known
            return [severity, at, 1, mailed, paused, sql if isinstance(sql, str) else None, resolved]
        last = at if resolved is None else max(at, resolved)
        if known and known[SEVERITY] is not None and known[START] > last:
            return [*known[:RESOLVED], last]
        return [None, None, None, None, None, None, last]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived: dict[str, list[tuple]] = {}
        for some in rows:
            for incident, at, resolves, *request in zip(*(some[name].tolist() for name in ROW)):
                if isinstance(incident, str):  # not a heartbeat
                    arrived.setdefault(incident, []).append((int(at), resolves, request))
        if arrived:
            timer, incidents = self._load()
            for incident, turns in arrived.items():
                known = incidents.get(incident)
                turns.sort(key=itemgetter(0, 1))
                for at, resolves, request in turns:
                    known = self._after(known, at, not resolves, *request)
                if known:
                    incidents[incident] = known
            if incidents:
                self._save(timer, incidents)
        return iter([])

    def _fire(self, known: list, now: int) -> tuple[list | None, list[tuple[str, int]]]:
        """What is known of an incident after its timers up to ``now``, and its actions with their times."""
        severity, start, turn, mailed, paused, sql, resolved = known
        if resolved is not None and now >= resolved + self.keep:
            resolved = None
        actions = []
        while severity is not None and (due := start + turn * self.step) <= now:
            if severity == "P0" and turn == 1:
                if not mailed:
                    actions.append(("send_mail", due))
                mailed, turn = True, 2
                continue
            if severity == "P1":
                actions.append(("auto_apply", due))
            elif not paused:
                actions.append(("pause_dag", due))
            severity = start = turn = mailed = paused = sql = None
        left = None if severity is None and resolved is None else [severity, start, turn, mailed, paused, sql, resolved]
        return left, actions

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        _, incidents = self._load()
        fired = []
        for incident, known in list(incidents.items()):
            if self._next(known) > now:
                continue
            left, actions = self._fire(known, now)
            fired += [(incident, known[SEVERITY], known[SQL], *action) for action in actions]
            if left:
                incidents[incident] = left
            else:
                del incidents[incident]
        if incidents:
            self._save(None, incidents)
        else:
            self.state.clear()
        if fired:
            yield pd.DataFrame(fired, columns=["incident_id", "severity", "proposed_sql", "action", "due_ms"])


def escalations(
    approvals: DataFrame, late: str = "0 seconds", timeout_minutes: int = TIMEOUT_MINUTES, keep_minutes: int = 7 * 24 * 60,
    allowed: list[str] = ALLOWED_TABLES, buckets: int = BUCKETS,
) -> DataFrame:
    """Actions that fall due on a stream of approval rows (requests and resolutions with ``created_at``).

    Timers follow the watermark, so a quiet stream needs rows from time to time to move on; rows without an incident
    serve as such a heartbeat. ``late`` only delays the clock: the time column ends before the stateful step, so no row
    is dropped for being late, and a late request fires as soon as it comes in. The statement of an ``auto_apply`` is
    audited again; ``step`` says what to do with it. The state of an incident is its open request; incidents are spread
    by a hash of their id over ``buckets`` groups, see ``EscalationLadder``. A micro-batch reads and writes the groups that
    its incidents and timers fall into, so more groups suit small batches on very many open requests.
    """
    pending = F.coalesce(F.col("status") == "pending", F.lit(False))
    rows = approvals.withColumn("__at", F.col("created_at").cast("timestamp")).withWatermark("__at", late).select(
        F.pmod(F.xxhash64("incident_id"), F.lit(buckets)).alias("bucket"), "incident_id",
        F.unix_millis("__at").alias("requested_ms"), (~pending).alias("resolves"), "severity",
        F.col("escalation_email_sent_at").isNotNull().alias("mailed"), F.col("dag_paused_at").isNotNull().alias("paused"),
        F.when(pending & (F.col("severity") == "P1"), F.col("proposed_sql")).alias("proposed_sql"),
    ).where(F.col("severity").isNull() | F.col("severity").isin("P0", "P1"))
    ship_package()
    actions = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=EscalationLadder(timeout_minutes, keep_minutes),
        outputStructType=OUTPUT_DDL,
        outputMode="append", timeMode="EventTime",
    )
    return actions.select("incident_id", "severity", "action", F.timestamp_millis("due_ms").alias("due_at"),
                          timeout_step(F.col("action"), F.col("proposed_sql"), allowed).alias("step"))
