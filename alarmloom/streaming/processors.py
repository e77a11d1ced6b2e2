"""Keyed state and timers: the streaming forms of the alarm operators.

Each processor holds one small record per key.  By event time, rows wait in state until
the watermark has passed them; then they are taken in (ts, tie) order, and what is due
before a row happens before it, also when several due times lie between two rows.  So the
result depends neither on the order in which rows arrive within the watermark delay nor on
how they are spread over micro-batches, and equals the batch form.

Rows wait in buckets of time, each under its end and with a timer there.  A timer reads,
sorts and drops the buckets that have ended and looks at no row of the others, so its work
does not grow with what else waits.  Times are in microseconds; timers of Spark count
milliseconds.

With ``event_time`` off, rows are taken as they come and timers go by the wall clock.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from alarmloom.functions.scalars import ALARM, RECOVERED, STATUS_OFF, STATUS_ON

SECOND_US = 1_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Codes in rule change messages.
ADD, DELETE = "0", "2"


def plain(value):
    """Rows within a value as tuples, the form that state takes back."""
    if isinstance(value, tuple):
        return tuple(map(plain, value))
    return [plain(v) for v in value] if isinstance(value, list) else value


class TimedProcessor(StatefulProcessor):
    """Base: loads the record, lets due things happen in order, keeps the timers.

    Subclasses name the fields of their record in ``fields`` (a DDL string or a schema)
    and give ``due`` (next due time or None), ``fire`` (what happens at that time),
    ``take`` (what a row does) and, where it does anything, ``take_untimed`` (a row
    without a time).  ``waiting`` is the schema of the columns of a row that they need,
    the time and the tie among them.  ``bucket_us`` is the width of a bucket, whole
    milliseconds; a row is taken when its bucket has ended.
    """

    fields: str | StructType = ""

    def __init__(
        self,
        waiting: StructType,
        ts: str = "ts_us",
        tie: str = "event_id",
        event_time: bool = True,
        bucket_us: int = SECOND_US,
    ):
        self.waiting, self.ts, self.tie, self.event_time = waiting, ts, tie, event_time
        self.bucket_us = bucket_us

    def init(self, handle) -> None:
        self.handle = handle
        if isinstance(self.fields, str):
            self.names = [f.strip().split()[0] for f in self.fields.split(",")]
        else:
            self.names = self.fields.names
        self.record = handle.getValueState("record", self.fields)
        # the timer that is set for what is due
        self.clock = handle.getValueState("clock", "timer bigint")
        if self.event_time:
            bucket = StructType([StructField("rows", ArrayType(self.waiting))])
            self.buckets = handle.getMapState("buckets", "until bigint", bucket)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """The record of a key as a batch has left it (see streaming.handover)."""
        self._store({n: plain(initialState[n]) for n in self.names})

    def due(self, s: dict) -> int | None:
        return None

    def fire(self, key, s: dict) -> Iterator[Row]:
        return iter(())

    def take(self, key, s: dict, row, now: int) -> Iterator[Row]:
        raise NotImplementedError

    def take_untimed(self, key, row) -> Iterator[Row]:
        return iter(())

    def _load(self) -> dict:
        value = plain(self.record.get()) if self.record.exists() else None
        return dict(zip(self.names, value or [None] * len(self.names)))

    def _store(self, s: dict, expired: int | None = None, passed: int | None = None) -> None:
        """Keep the record, and a timer for what is due; ``expired`` is gone already.

        What is due although time (``passed``, in milliseconds) has gone beyond it waits
        for the rows of its bucket.
        """
        if all(v is None for v in s.values()):
            self.record.clear()
        else:
            self.record.update(tuple(s[n] for n in self.names))
        timer = self.clock.get()[0] if self.clock.exists() else None
        due = self.due(s)
        wanted = None if due is None else -(-due // 1000)
        if wanted is not None and passed is not None and wanted <= passed:
            wanted = self._end(due)
        if wanted == timer and timer != expired:
            return
        if timer is not None and timer != expired and not self._holds_rows(timer):
            self.handle.deleteTimer(timer)
        if wanted is None:
            self.clock.clear()
        else:
            self.handle.registerTimer(wanted)
            self.clock.update((wanted,))

    def _end(self, us: int) -> int:
        """The end of a time's bucket, in milliseconds."""
        return (us // self.bucket_us + 1) * self.bucket_us // 1000

    def _holds_rows(self, timer: int) -> bool:
        return self.event_time and self.buckets.containsKey((timer,))

    def _fire_until(self, key, s: dict, end: int) -> Iterator[Row]:
        """Everything due before ``end``, in order."""
        while (due := self.due(s)) is not None and due < end:
            yield from self.fire(key, s)

    def _in_order(self, rows) -> list:
        return sorted(rows, key=lambda r: (r[self.ts], r[self.tie]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.event_time:
            yield from self._keep(key, rows)
            return
        s = self._load()
        wall = timerValues.getCurrentProcessingTimeInMs() * 1000
        for row in self._in_order(rows):
            yield from self._fire_until(key, s, wall)
            yield from self.take(key, s, row, wall)
        self._store(s)

    def _keep(self, key, rows) -> Iterator[Row]:
        """Rows into the buckets of their times."""
        columns = self.waiting.names
        new: dict[int, list[tuple]] = {}
        for row in rows:
            if row[self.ts] is None:
                yield from self.take_untimed(key, row)
                continue
            kept = plain(tuple(row[c] for c in columns))
            new.setdefault(self._end(row[self.ts]), []).append(kept)
        for timer, some in new.items():
            if self.buckets.containsKey((timer,)):
                some = plain(self.buckets.getValue((timer,))[0]) + some
            else:
                self.handle.registerTimer(timer)
            self.buckets.updateValue((timer,), (some,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        expired = expiredTimerInfo.getExpiryTimeInMs()
        if not self.event_time:
            s = self._load()
            now = timerValues.getCurrentProcessingTimeInMs()
            yield from self._fire_until(key, s, now * 1000 + 1)
            self._store(s, expired)
            return
        due_now = self.clock.exists() and self.clock.get()[0] == expired
        if not due_now and not self.buckets.containsKey((expired,)):
            return  # an earlier timer of this batch has taken the bucket
        s = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        ends = sorted(end for (end,) in self.buckets.keys())
        for end in [end for end in ends if end <= now]:
            columns = self.waiting.names
            rows = [dict(zip(columns, r)) for r in self.buckets.getValue((end,))[0]]
            self.buckets.removeKey((end,))
            for row in self._in_order(rows):
                yield from self._fire_until(key, s, row[self.ts])
                yield from self.take(key, s, row, row[self.ts])
        later = [end * 1000 - self.bucket_us for end in ends if end > now]
        yield from self._fire_until(key, s, min([now * 1000 + 1, *later]))
        self._store(s, expired, now)

    def close(self) -> None:
        pass


class HoldProcessor(TimedProcessor):
    """Delayed alarm with recovery, and its notifications or reminders.

    Input: ``holds``, ``delay`` (s), ``push_interval`` (s or null),
    ``push_once`` (bool), and ``about``, a text that stands for the row.  Output:
    key columns, ``kind`` ("alarm", "recover" or "push"), ``emit_us``, and the
    ``about`` of the row it is about.

    Notifications: with an interval, one per interval from the first alarm of an
    episode until it recovers, about the latest alarm; with ``push_once`` one per
    key.  Alarm and notification share their key, so they share state and shuffle.
    """

    fields = (
        "due bigint, kept string, alarmed boolean, push_due bigint, "
        "push_kept string, push_every bigint, pushed boolean, "
        "every bigint, once boolean"
    )

    def __init__(
        self, waiting: StructType, keys: list[str],
        recover_on_every_clear: bool = False, **kw,
    ):
        super().__init__(waiting, **kw)
        self.keys = keys
        self.recover_on_every_clear = recover_on_every_clear

    def due(self, s):
        times = [t for t in (s["due"], s["push_due"]) if t is not None]
        return min(times) if times else None

    def _row(self, key, kind, at, about):
        return Row(**dict(zip(self.keys, key)), kind=kind, emit_us=at, about=about)

    def fire(self, key, s):
        # An alarm due at the time of a notification comes first.
        if s["due"] is not None and (s["push_due"] is None or s["due"] <= s["push_due"]):
            at, about = s["due"], s["kept"]
            s.update(due=None, kept=None, alarmed=True)
            yield self._row(key, "alarm", at, about)
            if s["every"]:
                s["push_kept"] = about
                if s["push_due"] is None:
                    s["push_every"] = s["every"]
                    s["push_due"] = at + s["push_every"]
            elif s["once"] and not s["pushed"]:
                s["pushed"] = True
                yield self._row(key, "push", at, about)
        else:
            yield self._row(key, "push", s["push_due"], s["push_kept"])
            s["push_due"] += s["push_every"]

    def take(self, key, s, row, now):
        if row["holds"]:
            if s["due"] is None:
                s["due"] = now + row["delay"] * SECOND_US
            s["kept"] = row["about"]
            interval = row["push_interval"] or 0
            s["every"] = interval * SECOND_US if interval > 0 else None
            s["once"] = bool(row["push_once"]) or None
            return
        s.update(due=None, kept=None)
        if s["alarmed"] or self.recover_on_every_clear:
            yield self._row(key, "recover", now, row["about"])
            s.update(alarmed=None, push_due=None, push_kept=None, push_every=None)


class OffCountProcessor(TimedProcessor):
    """Off too often within a window anchored at the first "off".

    Input: key, ``status``, ``width`` (s), ``limit``.  Output: sn, ``status``,
    ``emit_us`` and the tie column.
    """

    fields = "due bigint, n bigint"

    def due(self, s):
        return s["due"]

    def fire(self, key, s):
        s.update(due=None, n=None)
        return iter(())

    def take(self, key, s, row, now):
        if row["status"] == STATUS_OFF:
            if s["due"] is None:
                s.update(due=now + row["width"] * SECOND_US, n=1)
            else:
                s["n"] += 1
                if s["n"] == max(2, row["limit"]):
                    yield Row(sn=key[0], status=ALARM, emit_us=now,
                              **{self.tie: row[self.tie]})
        elif s["due"] is None:
            yield Row(sn=key[0], status=RECOVERED, emit_us=now,
                      **{self.tie: row[self.tie]})


class DisconnectProcessor(TimedProcessor):
    """Disconnects ("on" directly followed by "off") and their frequency.

    Input: key, ``status``, ``width`` (s), ``limit``.  Output: sn, ``kind``
    ("disconnect", "alarm" or "recover"), ``online_us``, ``emit_us`` and the tie
    column.  The window starts at the online time of its first disconnect.
    """

    fields = "status string, at bigint, due bigint, n bigint, last bigint"

    def due(self, s):
        return s["due"]

    def _row(self, key, kind, online, at, about):
        return Row(sn=key[0], kind=kind, online_us=online, emit_us=at,
                   **{self.tie: about})

    def fire(self, key, s):
        yield self._row(key, "recover", None, s["due"], s["last"])
        s.update(due=None, n=None, last=None)

    def take(self, key, s, row, now):
        if row["status"] == STATUS_OFF and s["status"] == STATUS_ON:
            online, about = s["at"], row[self.tie]
            yield self._row(key, "disconnect", online, now, about)
            if s["due"] is None:
                s.update(due=online + row["width"] * SECOND_US, n=0)
            s["n"] += 1
            s["last"] = about
            if s["n"] > row["limit"]:
                yield self._row(key, "alarm", online, now, about)
        s.update(status=row["status"], at=now)


class PairProcessor(TimedProcessor):
    """Disconnects alone: "on" directly followed by "off".

    Input: key, ``status``.  Output: sn, ``online_us``, ``offline_us``, the tie column and
    ``told``, the end of the row's bucket.  A row is taken once the watermark has reached
    that end, which the watermark of the micro-batch before had not, so ``told`` is never
    behind the time of a step that follows, as ``offline_us`` would be.
    """

    fields = "status string, at bigint"

    def take(self, key, s, row, now):
        if row["status"] == STATUS_OFF and s["status"] == STATUS_ON:
            told = EPOCH + timedelta(milliseconds=self._end(now))
            yield Row(sn=key[0], online_us=s["at"], offline_us=now,
                      **{self.tie: row[self.tie]}, told=told)
        s.update(status=row["status"], at=now)


class FrequencyProcessor(TimedProcessor):
    """Disconnects more often than allowed, from the disconnects alone.

    Input: rows of PairProcessor with ``width`` (s) and ``limit``.  Output: sn, ``kind``
    ("alarm" or "recover"), ``online_us``, ``emit_us`` and the tie column.
    """

    fields = "due bigint, n bigint, last bigint"

    def due(self, s):
        return s["due"]

    def _row(self, key, kind, online, at, about):
        return Row(sn=key[0], kind=kind, online_us=online, emit_us=at,
                   **{self.tie: about})

    def fire(self, key, s):
        yield self._row(key, "recover", None, s["due"], s["last"])
        s.update(due=None, n=None, last=None)

    def take(self, key, s, row, now):
        if s["due"] is None:
            s.update(due=row["online_us"] + row["width"] * SECOND_US, n=0)
        s.update(n=s["n"] + 1, last=row[self.tie])
        if s["n"] > row["limit"]:
            yield self._row(key, "alarm", row["online_us"], now, s["last"])


class LateProcessor(StatefulProcessor):
    """Each row with a mark: had the watermark reached ``until_us`` when it came?

    It holds no state.  The rows must come without a watermarked column, or Spark drops
    the late ones before they get here.
    """

    def __init__(self, told: StructType):
        self.told = told

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for row in rows:
            # before the first watermark nothing is late, and nothing without a time
            late = passed > 0 and row["until_us"] is not None and row["until_us"] <= passed
            yield Row(**{c: row[c] for c in self.told.names}, late=late)

    def close(self) -> None:
        pass


CHANGE, DATA = 0, 1


class BesideProcessor(TimedProcessor):
    """Data rows beside changes of their key, both in one state and one order of time.

    Input: key, ``side`` (CHANGE or DATA) and the columns of both.  A change at the time
    of a data row comes first.
    """

    def __init__(self, waiting: StructType, told: StructType, **kw):
        super().__init__(waiting, **kw)
        self.told = told

    def _in_order(self, rows) -> list:
        return sorted(rows, key=lambda r: (r[self.ts], r["side"], r[self.tie]))

    def _row(self, row, **more) -> Row:
        return Row(**{c: row[c] for c in self.told.names}, **more)


class AsOfProcessor(BesideProcessor):
    """Each data row with the latest change of its key at or before its time.

    Changes carry ``change``, a struct, whose schema is ``change``.  Output: the columns
    ``told`` and ``version`` (null where there was no change yet).
    """

    def __init__(self, waiting: StructType, told: StructType, change: StructType, **kw):
        super().__init__(waiting, told, **kw)
        self.fields = StructType([StructField("version", change)])

    def take(self, key, s, row, now):
        if row["side"] == CHANGE:
            s["version"] = plain(row["change"])
        else:
            yield self._row(row, version=s["version"])

    def take_untimed(self, key, row):
        if row["side"] == DATA:
            yield self._row(row, version=None)


class RuleMappingProcessor(BesideProcessor):
    """Data points with the rules that their point has at their time.

    Changes carry ``action`` and ``change``, the list of rule ids: an add appends them,
    a delete drops all.  Output: the columns ``told`` and ``rule_id``, a row per rule.
    """

    fields = StructType([StructField("rules", ArrayType(LongType()))])

    def take(self, key, s, row, now):
        if row["side"] == DATA:
            for rule_id in s["rules"] or ():
                yield self._row(row, rule_id=rule_id)
        elif row["action"] == ADD:
            s["rules"] = [*(s["rules"] or ()), *(row["change"] or ())]
        elif row["action"] == DELETE:
            s["rules"] = None


class ArrivalWindowProcessor(StatefulProcessor):
    """Rows in the window of the wall clock they arrive in, told when it has passed."""

    def __init__(self, told: StructType, size_ms: int):
        self.told, self.size_ms = told, size_ms

    def init(self, handle) -> None:
        self.handle = handle
        window = StructType([StructField("rows", ArrayType(self.told))])
        self.windows = handle.getMapState("windows", "until bigint", window)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        end = (now // self.size_ms + 1) * self.size_ms
        held = [plain(tuple(row[c] for c in self.told.names)) for row in rows]
        if self.windows.containsKey((end,)):
            held = plain(self.windows.getValue((end,))[0]) + held
        else:
            self.handle.registerTimer(end)
        self.windows.updateValue((end,), (held,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        rows = self.windows.getValue((end,))[0]
        self.windows.removeKey((end,))
        for row in rows:
            told = dict(zip(self.told.names, row))
            yield Row(**told, start_ms=end - self.size_ms, end_ms=end)

    def close(self) -> None:
        pass


class LatestProcessor(StatefulProcessor):
    """The latest row of a key, emitted whenever it changes.

    ``columns`` is the schema of what is told of a row beside its keys, the time and the
    tie that order rows among it.  ``ttl_ms`` forgets a key that long after its last row
    (wall clock).
    """

    def __init__(
        self, keys: list[str], columns: StructType, ts: str = "ts_us",
        tie: str = "event_id", ttl_ms: int | None = None,
    ):
        self.keys, self.columns, self.ttl_ms = keys, columns, ttl_ms
        self.order = [columns.names.index(ts), columns.names.index(tie)]

    def init(self, handle) -> None:
        self.latest = handle.getValueState("latest", self.columns, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.latest.update(tuple(initialState[c] for c in self.columns.names))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.columns.names

        def place(row: tuple):
            return tuple(row[i] for i in self.order)

        row = max((tuple(r[c] for c in names) for r in rows), key=place)
        if not self.latest.exists() or place(self.latest.get()) < place(row):
            self.latest.update(row)
            yield Row(**dict(zip(self.keys, key)), **dict(zip(names, row)))

    def close(self) -> None:
        pass


class LatestByNameProcessor(StatefulProcessor):
    """The latest time per name within a key, in one map per key."""

    def __init__(self, keys: list[str], name: str, ts: str = "ts_us"):
        self.keys, self.name, self.ts = keys, name, ts

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "name string", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best: dict[str, int] = {}
        for row in rows:
            name = row[self.name]
            best[name] = max(row[self.ts], best.get(name, row[self.ts]))
        for name, at in best.items():
            sub = (name,)
            if not self.seen.containsKey(sub) or self.seen.getValue(sub)[0] < at:
                self.seen.updateValue(sub, (at,))
                yield Row(**dict(zip(self.keys, key)), name=name, latest_us=at)

    def close(self) -> None:
        pass
