"""State machines that no window frame expresses, for batch and for streams.

A machine is a small object that takes one key's events in order of time. In batch the events
are sorted within partitions and streamed through it, so a task holds a batch and one
machine's state however many events a key has. In a stream, :func:`in_event_time` holds events
back until the watermark has passed them, takes them in order, and gives late ones out
marked; its state is in the state store, so a stopped query goes on where it was.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEVER = float("-inf")


class Recent:
    """Times of which those older than the window are forgotten: from an age of ``window`` on, or, if ``beyond``, above it."""

    def __init__(self, window: float, beyond: bool, held: Iterable[float] = ()):
        self.window, self.beyond, self.times = window, beyond, deque(held)

    def count(self, now: float) -> int:
        while self.times and (now - self.times[0] > self.window or (not self.beyond and now - self.times[0] == self.window)):
            self.times.popleft()
        return len(self.times)

    def add(self, now: float) -> int:
        self.times.append(now)
        return self.count(now)


class Limiter:
    """Sliding-window limiter: an event is granted if fewer than ``limit`` grants are younger than ``window``. Only grants count."""

    def __init__(self, limit: int, window: float, held: Iterable[float] = (), until: float = NEVER):
        self.limit, self.recent, self.until = limit, Recent(window, False, held), until

    def take(self, t: float, _: bool = False) -> bool:
        ok = self.recent.count(t) < self.limit
        if ok:
            self.recent.add(t)
        return ok


class Breaker:
    """Circuit breaker over (time, blocked): ``open`` while cooling down, ``trip`` on the block that opens it, else ``pass``.

    A success clears the history, and so does a trip.
    """

    def __init__(self, threshold: int, window: float, cooldown: float, held: Iterable[float] = (), until: float = NEVER):
        self.threshold, self.cooldown, self.recent, self.until = threshold, cooldown, Recent(window, True, held), until

    def blocked(self, t: float) -> bool:
        """One more block; whether it opens the breaker."""
        if self.recent.add(t) < self.threshold:
            return False
        self.until = t + self.cooldown
        self.recent.times.clear()
        return True

    def take(self, t: float, blocked: bool) -> str:
        if t < self.until:
            return "open"
        if not blocked:
            self.recent.times.clear()
            return "pass"
        return "trip" if self.blocked(t) else "pass"


class Escalation(Breaker):
    """Outcomes of (time, blocked, next transport answers) requests of one host.

    A request that is not blocked is ``ok``. A blocked one fails at once while the breaker is
    open (``open``) or opens it (``trip``); else it goes to the next transport and is
    ``escalated`` if that answers, which clears the blocks, or ``failed``.
    """

    def take(self, t: float, blocked: bool, answers: bool) -> str:
        if not blocked:
            return "ok"
        if t < self.until:
            return "open"
        if self.blocked(t):
            return "trip"
        if answers:
            self.recent.times.clear()
        return "escalated" if answers else "failed"


class Rotation:
    """Token of each (time, cooldown after it) call: round robin past cooling tokens; the first to be ready if all cool.

    A positive cooldown lasts a second at least and starts at the call.
    """

    def __init__(self, tokens: int):
        self.until, self.at = [NEVER] * tokens, 0

    def take(self, t: float, cool: float) -> int:
        n = len(self.until)
        ready = next((k for k in ((self.at + i) % n for i in range(n)) if self.until[k] <= t), None)
        if ready is None:
            ready = min(range(n), key=self.until.__getitem__)
        else:
            self.at = (ready + 1) % n
        if cool > 0:
            self.until[ready] = t + max(cool, 1.0)
        return ready


class Backoff:
    """Look-ups of (time, has a token): ``paused`` while backing off, ``spent`` where an anonymous one finds the budget used and starts a pause, else ``go``.

    The budget counts anonymous look-ups over the whole run and is not refilled by a pause.
    """

    def __init__(self, budget: int = 50, pause: float = 3600.0):
        self.left, self.pause, self.until = budget, pause, NEVER

    def take(self, t: float, token: bool) -> str:
        if t < self.until:
            return "paused"
        if token or self.left > 0:
            self.left -= not token
            return "go"
        self.until = t + self.pause
        return "spent"


class KeyWalk:
    """The key that each (time, name) request gets, walking from ``crc32(name) % keys``; None if all are busy."""

    def __init__(self, keys: int, limit: int, window: float):
        self.keys = [Limiter(limit, window) for _ in range(keys)]

    def take(self, t: float, name: str) -> int | None:
        n, start = len(self.keys), zlib.crc32(name.encode())
        return next((k for k in ((start + i) % n for i in range(n)) if self.keys[k].take(t)), None)


def taken(machine, events: Iterable[tuple]) -> list:
    """What a machine says to each event."""
    return [machine.take(*e) for e in events]


def by_key(events: DataFrame, key: str, args: list[str], make: Callable[[], object], name: str, kind: T.DataType) -> DataFrame:
    """(seq, key, name): what a machine of each key says to its ``events(key, seq, t, args)``, in order of t and seq.

    A key's events stay in order, so they pass through one task, as a stream of batches. A null key is a key.
    """
    d = events.select(*dict.fromkeys(["seq", key, "t", *args])).withColumn("_same", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")))
    d = d.repartition("_same").sortWithinPartitions("_same", "t", "seq")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = machine = None
        for b in batches:
            said = []
            for same, *event in zip(b.column("_same").to_pylist(), *(b.column(c).to_pylist() for c in args), strict=True):
                if same != last:
                    last, machine = same, make()
                said.append(machine.take(*event))
            out = pa.array(said, {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_()}[kind])
            yield pa.RecordBatch.from_arrays([b.column("seq"), b.column(key), out], ["seq", key, name])

    return d.mapInArrow(work, T.StructType([d.schema["seq"], d.schema[key], T.StructField(name, kind)]))


def _timed(events: DataFrame, key: str, ts: str, seq: str, *more) -> DataFrame:
    return events.select(F.col(seq).alias("seq"), F.col(key).alias("key"), (F.unix_micros(ts) / 1e6).alias("t"), *more)


def limited(events: DataFrame, key: str, ts: str, seq: str, limit: int, window_seconds: float) -> DataFrame:
    """(seq, key, granted) for each event."""
    return by_key(_timed(events, key, ts, seq), "key", ["t"], lambda: Limiter(limit, window_seconds), "granted", T.BooleanType())


def broken(events: DataFrame, key: str, ts: str, seq: str, blocked: str, threshold: int, window_seconds: float, cooldown_seconds: float) -> DataFrame:
    """(seq, key, state) for each event."""
    d = _timed(events, key, ts, seq, F.col(blocked).alias("b"))
    return by_key(d, "key", ["t", "b"], lambda: Breaker(threshold, window_seconds, cooldown_seconds), "state", T.StringType())


def rotated(calls: DataFrame, tokens: int) -> DataFrame:
    """``calls(pool, seq, t, cooldown)``: (seq, pool, token) of each call."""
    return by_key(calls, "pool", ["t", "cooldown"], lambda: Rotation(tokens), "token", T.LongType())


def first_free_key(requests: DataFrame, keys: int, limit: int, window_seconds: float) -> DataFrame:
    """``requests(provider, seq, t, name)``: (seq, provider, key) of each (:class:`KeyWalk`)."""
    return by_key(requests, "provider", ["t", "name"], lambda: KeyWalk(keys, limit, window_seconds), "key", T.LongType())


def backed_off(calls: DataFrame, budget: int = 50, pause: float = 3600.0) -> DataFrame:
    """``calls(pool, seq, t, token)``: (seq, pool, state) of each look-up."""
    return by_key(calls, "pool", ["t", "token"], lambda: Backoff(budget, pause), "state", T.StringType())


def escalated(requests: DataFrame, threshold: int = 3, window: float = 600.0, cooldown: float = 1800.0) -> DataFrame:
    """``requests(host, seq, t, blocked, answers)``: (seq, host, outcome) of each (:class:`Escalation`)."""
    return by_key(requests, "host", ["t", "blocked", "answers"], lambda: Escalation(threshold, window, cooldown), "outcome", T.StringType())


def in_event_time(events: DataFrame, make: Callable[[Iterable[float], float], Limiter | Breaker], delay: str) -> DataFrame:
    """(key, seq, said, late) over a stream of ``events(key, seq, ts, flag)``: what a machine of each key says, as text, in order of time.

    ``make(held, until)`` makes a machine from its state. An event waits until the watermark, ``delay`` behind the newest
    event, has passed it; then it is taken in order of time and seq, as in batch. One that comes
    behind the watermark is given out at once, marked ``late``, and is not taken. Timers let
    waiting events go, and drop the state of a key once it says nothing any more.
    """
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Ordered(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.waiting = handle.getListState("waiting", "seq long, t double, flag boolean")
            self.state = handle.getValueState("machine", "held array<double>, until double")

        def handleInputRows(self, key, rows, timerValues):
            passed = timerValues.getCurrentWatermarkInMs() / 1000
            pdf = pd.concat(list(rows), ignore_index=True)
            late = pdf[pdf.t < passed]
            on_time = pdf[pdf.t >= passed]
            if len(on_time):
                self.waiting.appendList([(int(s), float(t), bool(f)) for s, t, f in zip(on_time.seq, on_time.t, on_time.flag, strict=True)])
                self.handle.registerTimer(int(on_time.t.min() * 1000) + 1)
            yield pd.DataFrame({"key": [key[0]] * len(late), "seq": late.seq.tolist(), "said": pd.Series([None] * len(late), dtype=object), "late": [True] * len(late)})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs() / 1000
            waiting = sorted((r[1], r[0], r[2]) for r in self.waiting.get()) if self.waiting.exists() else []
            due, rest = [w for w in waiting if w[0] < passed], [w for w in waiting if w[0] >= passed]
            held, until = self.state.get() if self.state.exists() else ([], NEVER)
            machine = make(list(held), until)
            said = [str(machine.take(t, f)) for t, _, f in due]
            machine.recent.count(passed)
            if machine.recent.times or machine.until > passed:
                self.state.update((list(machine.recent.times), machine.until))
                end = max([machine.until, *(t + machine.recent.window for t in machine.recent.times)])
                self.handle.registerTimer(int(end * 1000) + 1)
            elif self.state.exists():
                self.state.clear()
            if rest:
                self.waiting.put([(s, t, f) for t, s, f in rest])
                self.handle.registerTimer(int(rest[0][0] * 1000) + 1)
            elif waiting:
                self.waiting.clear()
            yield pd.DataFrame({"key": [key[0]] * len(due), "seq": [s for _, s, _ in due], "said": pd.Series(said, dtype=object), "late": [False] * len(due)})

        def close(self):
            pass

    # the time goes on as a number: as a column with a watermark its late rows would be dropped before they are seen
    timed = events.withWatermark("ts", delay).select("key", "seq", (F.unix_micros("ts") / 1e6).alias("t"), "flag")
    return timed.groupBy("key").transformWithStateInPandas(Ordered(), "key long, seq long, said string, late boolean", "Append", "EventTime")


def broken_stream(events: DataFrame, threshold: int, window_seconds: float, cooldown_seconds: float, delay: str) -> DataFrame:
    """The breaker over a stream of ``events(key, seq, ts, flag)``; ``said`` is its state."""
    return in_event_time(events, lambda held, until: Breaker(threshold, window_seconds, cooldown_seconds, held, until), delay)


def granted_stream(events: DataFrame, limit: int, window_seconds: float, delay: str) -> DataFrame:
    """The limiter over a stream of ``events(key, seq, ts, flag)``; ``said`` is True or False."""
    return in_event_time(events, lambda held, until: Limiter(limit, window_seconds, held, until), delay)


def limited_stream(events: DataFrame, key: str, limit: int, window_seconds: float) -> DataFrame:
    """The limiter over a stream of (key, seq, t) that comes in order: events are answered in the batch that they come in."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Arriving(StatefulProcessor):
        def init(self, handle):
            self.held = handle.getValueState("held", "times array<double>")

        def handleInputRows(self, key, rows, timerValues):
            pdf = pd.concat(list(rows)).sort_values(["t", "seq"])
            machine = Limiter(limit, window_seconds, self.held.get()[0] if self.held.exists() else [])
            granted = taken(machine, zip(pdf.t))
            self.held.update((list(machine.recent.times),))
            yield pd.DataFrame({"key": [key[0]] * len(pdf), "seq": pdf.seq.tolist(), "granted": granted})

        def close(self):
            pass

    return events.groupBy(key).transformWithStateInPandas(Arriving(), "key long, seq long, granted boolean", "Append", "none")


def novel_stream(events: DataFrame, key: str, ts: str, horizon: str = "24 hours") -> DataFrame:
    """First occurrence of each key; late rows beyond the horizon are dropped by the watermark."""
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])
