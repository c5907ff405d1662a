"""Keyed processors on named state: rows of a key applied strictly in event time.

:class:`InOrder` is the common part.  Rows of a key reach a stream in any
order; a row waits in a map state under its slot of time and a timer hands it on
once the watermark has passed it, so no earlier row can still come.  What a
processor decides therefore does not depend on how rows were spread over
micro-batches, only on the watermark's lateness, and it equals the batch
operator's result.  Keys share ``KEY_BUCKETS`` state keys and their rows wait by slots of
time (a day, an hour for products), so that the state is read and written once a slot and not
once a row.  Nothing of a micro-batch is gathered beyond ``HELD_ROWS`` rows, and the
memory is a bucket's rows of one slot.

* :class:`Reservation` -- orders against a stock that changes: map states
  ``reserved`` and ``stock`` by product.
* :class:`VerdictSessions` -- verdicts of an order in sessions: map state
  ``session`` by order; in event order an order has one open session at most.
  Emits either every update (as the reference does) or the closed sessions.
* :class:`SessionChangelog` -- not in event order: session totals after every row as it
  arrives, with deletions of the sessions that a row merges.
* :class:`OrderRequests` -- lookups that wait: map states ``version`` (the
  order's newest) and ``pending``; a request is answered at once, late, or not before
  its deadline.

The states can be read from a checkpoint by their names, see :func:`state_table`.
"""

from __future__ import annotations

import pickle
from collections import defaultdict, namedtuple
from collections.abc import Iterable, Iterator
from decimal import Context, Decimal
from itertools import islice
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderflow import schemas as S
from orderflow.functions.expressions import amount_text, interval_micros, micros, odd_amounts, order_value
from orderflow.streaming.stateful import OpenSessions

# Sums of money: wide enough to stay exact, NaN and infinities as in double arithmetic.
MONEY = Context(prec=60, traps=[])

HELD_ROWS = 100_000   # rows of a bucket gathered before they go to the state
KEY_BUCKETS = 256     # groups of keys that share a state key; part of a checkpoint's layout
PART_ROWS = 4096      # rows of a slot beyond which they make a part that is not rewritten
OUT_ROWS = 50_000     # rows of a data frame handed back


class Entries:
    """A map state's entries by key: read when they are asked for, or all at once, and written back once."""

    def __init__(self, state: Any, whole: bool = False):
        self.state, self.whole = state, whole
        self.was = {tuple(k): tuple(v) for k, v in state.iterator()} if whole else {}
        self.now = dict(self.was)

    def get(self, key: tuple) -> tuple | None:
        if key not in self.now and not self.whole:
            value = self.state.getValue(key)
            self.was[key] = self.now[key] = tuple(value) if value else None
        return self.now.get(key)

    def put(self, key: tuple, value: tuple | None) -> None:
        self.now[key] = value

    def items(self) -> list[tuple]:
        return [(k, v) for k, v in self.now.items() if v is not None]

    def store(self) -> None:
        for key, value in self.now.items():
            if value is None:
                if self.was.get(key) is not None:
                    self.state.removeKey(key)
            elif value != self.was.get(key):
                self.state.updateValue(key, value)


class InOrder(StatefulProcessor):
    """Buffers rows until the watermark has passed them, then applies them by (time, kind, seq).

    The state's key is a bucket of keys: a state call, and the record batch that Spark makes of
    each group, cost far more than a row.  Rows wait by slot of ``slot_us``: map ``waiting`` holds a
    slot's newest rows, its earliest millisecond and the number of its full parts, map ``parts`` those.
    """

    #: column of the key that the rows of a bucket are told apart by, as DDL
    key: str = ""
    #: columns of an input row behind ``at`` (microseconds), ``kind`` and ``seq``, as DDL
    fields: str = ""
    #: width of a slot; the memory is a bucket's rows of one
    slot_us: int = 86_400_000_000

    @property
    def names(self) -> list[str]:
        """Columns of an input row."""
        return ["at", "kind", "seq", self.key.split()[0], *[x.split()[0] for x in self.fields.split(", ")]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.Input = namedtuple("Input", self.names)
        self.waiting = handle.getMapState("waiting", "slot bigint", "first bigint, parts int, rows binary")
        self.parts = handle.getMapState("parts", "slot bigint, part int", "rows binary")

    def wake(self, at_us: int) -> None:
        """Have the key looked at once no row up to ``at_us`` can come any more."""
        self.handle.registerTimer(at_us // 1000 + 1)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        def values() -> Iterator[tuple]:
            columns, names = None, self.names
            for row in rows:
                if columns is None:
                    columns = [row.__fields__.index(c) for c in names]
                yield tuple([row[i] for i in columns])

        self.hold(values())
        return iter(())

    def hold(self, rows: Iterable[tuple]) -> None:
        """Put rows (their values in the order of ``names``) where they wait."""
        rows, slot_us = iter(rows), self.slot_us
        while some := list(islice(rows, HELD_ROWS)):
            slots = defaultdict(list)
            for row in some:
                slots[row[0] // slot_us].append(row)
            self._hold(slots)

    def _hold(self, slots: dict[int, list[tuple]]) -> None:
        for slot, rows in slots.items():
            first = min(r[0] for r in rows) // 1000
            held = self.waiting.getValue((slot,))
            before, parts = (held[0], held[1]) if held else (None, 0)
            if before is None or first < before:
                self.handle.registerTimer(first + 1)
            else:
                first = before
            if held and held[2]:
                rows = pickle.loads(held[2]) + rows
            packed = pickle.dumps(rows)
            if len(rows) > PART_ROWS:
                self.parts.updateValue((slot, parts), (packed,))
                packed, parts = b"", parts + 1
            self.waiting.updateValue((slot,), (first, parts, packed))

    def _take(self, slot: int, before_ms: int) -> list[tuple]:
        """The slot's rows of milliseconds before ``before_ms``, in event order; the others wait on."""
        held = self.waiting.getValue((slot,))
        if not held or held[0] >= before_ms:
            return []
        rows = []
        for part in range(held[1]):
            rows += pickle.loads(self.parts.getValue((slot, part))[0])
            self.parts.removeKey((slot, part))
        rows += pickle.loads(held[2]) if held[2] else []
        self.waiting.removeKey((slot,))
        later = [r for r in rows if r[0] // 1000 >= before_ms]
        if later:
            rows = [r for r in rows if r[0] // 1000 < before_ms]
            self._hold({slot: later})
        # a null seq goes first
        rows.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))
        return rows

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        ms = expiredTimerInfo.getExpiryTimeInMs() - 1
        now = max(timerValues.getCurrentWatermarkInMs(), ms + 1)
        slot = ms * 1000 // self.slot_us
        rows = self._take(slot, now)
        self.load()
        for row in rows:
            yield from self.apply(row[3], self.Input._make(row))
        # the next slot's rows have a timer of their own, which comes later
        yield from self.passed(min(now * 1000, (slot + 1) * self.slot_us) - 1)
        self.store()

    def load(self) -> None:
        """Read the bucket's state, once for all the rows that are due."""

    def store(self) -> None:
        """Write what has changed of it."""

    def apply(self, key: Any, row: Any) -> Iterator[Row]:
        """The next row in event order."""
        raise NotImplementedError

    def passed(self, at_us: int) -> Iterator[Row]:
        """No row up to ``at_us`` can come any more."""
        return iter(())

    def close(self) -> None:
        pass


class Framed(StatefulProcessor):
    """Hands the rows of data frames to a processor and its rows back in data frames.

    Spark builds a ``Row`` cell by cell, which costs several times what a processor does with it.  A data
    frame has no nulls among its numbers: a row's nulls are the bits of its last column.
    """

    def __init__(self, processor: InOrder, out: str):
        self.processor, self.out = processor, [x.split()[0] for x in out.split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.processor.init(handle)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n = len(self.processor.names)
        self.processor.hold(row for frame in rows for row in _tuples(frame, n))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        rows = self.processor.handleExpiredTimer(key, timerValues, expiredTimerInfo)
        while some := list(islice(rows, OUT_ROWS)):
            yield pd.DataFrame(dict(zip(self.out, map(_objects, zip(*some)))))

    def close(self) -> None:
        self.processor.close()


_NO_NULL = {"string": "", "boolean": False, "int": 0, "bigint": 0}   # what stands for a null in a data frame


def _null_free(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns without nulls, and which of them were null."""
    kinds = dict(df.dtypes)
    bits = [F.when(F.col(c).isNull(), 1 << i).otherwise(0).cast("int") for i, c in enumerate(names)]
    nulls = bits[0]
    for b in bits[1:]:
        nulls = nulls.bitwiseOR(b)
    return [*[F.coalesce(c, F.lit(_NO_NULL[kinds[c]]).cast(kinds[c])).alias(c) for c in names], nulls.alias("nulls")]


def _tuples(frame: pd.DataFrame, n: int) -> Iterator[tuple]:
    """The values of its last ``n`` columns before that of the nulls, with them; by place, as Spark may rename columns."""
    columns = [frame.iloc[:, i].tolist() for i in range(-n - 1, -1)]
    nulls = frame.iloc[:, -1].to_numpy()
    for i, column in enumerate(columns):
        for at in (nulls >> i & 1).nonzero()[0].tolist():
            column[at] = None
    return zip(*columns)


def _objects(values: tuple) -> pd.Series:
    """A column as it is: numbers beside a null would become floats."""
    return pd.Series(values, dtype=object)


def _in_order(df: DataFrame, key: str, processor: InOrder, out: str) -> DataFrame:
    """The rows by bucket of ``key``, which the processor then tells apart."""
    kinds = dict(df.dtypes)
    processor.key = f"{key} {kinds[key]}"
    bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")
    names = processor.names
    if any(kinds[c] not in _NO_NULL for c in names):   # a key of another type
        return df.select(bucket, "*").groupBy("bucket").transformWithState(processor, out, "append", "eventTime")
    rows = df.select(bucket, "ts", *_null_free(df, names))
    return rows.groupBy("bucket").transformWithStateInPandas(Framed(processor, out), out, "append", "eventTime")


# ---- reservation ------------------------------------------------------------------------

ORDER, CHANGE = 1, 0   # at equal times a stock row comes before the orders that may use it


class Reservation(InOrder):
    fields = "id string, quantity int, stock int"
    slot_us = 3_600_000_000   # few products, each with many orders
    Output = Row("id", "product", "quantity", "stock", "at", "seq", "validationResult", "reserved")

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.reserved_map = handle.getMapState("reserved", self.key, "units bigint")
        self.stock_map = handle.getMapState("stock", self.key, "units int")

    def load(self) -> None:
        self.reserved, self.stock = Entries(self.reserved_map), Entries(self.stock_map)

    def store(self) -> None:
        self.reserved.store()
        self.stock.store()

    def apply(self, key: Any, row: Any) -> Iterator[Row]:
        if row.kind == CHANGE:
            self.stock.put((key,), (row.stock,))
            return
        stock = self.stock.get((key,))
        if stock is None:
            return                            # no stock known yet: no verdict
        held = self.reserved.get((key,))
        reserved, asked = held[0] if held else 0, row.quantity or 0
        ok = stock[0] is not None and stock[0] - reserved - asked >= 0
        if ok and asked or not held:
            reserved += asked if ok else 0
            self.reserved.put((key,), (reserved,))
        yield self.Output(row.id, key, row.quantity, stock[0], row.at, row.seq, "PASS" if ok else "FAIL", reserved)


def reserve_in_order(orders: DataFrame, changes: DataFrame, key: str = "product") -> DataFrame:
    """Orders against stock changes (both with a watermark on ``ts``): id, product, quantity, stock, ts, seq,
    validationResult, reserved -- the rows of the batch as-of join and fold."""
    o = orders.select(key, "ts", micros("ts").alias("at"), F.lit(ORDER).alias("kind"), "seq", "id", "quantity",
                      F.lit(None).cast("int").alias("stock"))
    c = changes.select(key, "ts", micros("ts").alias("at"), F.lit(CHANGE).alias("kind"), "seq",
                       F.lit(None).cast("string").alias("id"), F.lit(None).cast("int").alias("quantity"), "stock")
    kind = dict(orders.dtypes)[key]
    out = _in_order(o.unionByName(c), key, Reservation(), f"id string, product {kind}, quantity int, stock int, "
                    "at bigint, seq bigint, validationResult string, reserved bigint")
    return out.select("id", "product", "quantity", "stock", F.timestamp_micros("at").alias("ts"), "seq",
                      "validationResult", "reserved")


# ---- verdict sessions -------------------------------------------------------------------

class VerdictSessions(InOrder):
    fields = "passed boolean"
    Output = Row("orderId", "start", "stop", "verdicts", "passes", "reach")

    def __init__(self, gap_us: int, n_rules: int, updates: bool):
        self.gap_us, self.n_rules, self.updates = gap_us, n_rules, updates

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        # start, end, verdicts, passes, time of the n-th PASS
        self.session_map = handle.getMapState(
            "session", self.key, "start bigint, stop bigint, verdicts bigint, passes bigint, reach bigint")

    def load(self) -> None:
        self.sessions = Entries(self.session_map, whole=True)

    def store(self) -> None:
        self.sessions.store()
        if self.sessions.now != self.sessions.was and (open_ := self.sessions.items()):
            self.wake(min(s[1] for _, s in open_) + self.gap_us)

    def apply(self, key: Any, row: Any) -> Iterator[Row]:
        s = self.sessions.get((key,))
        if s is not None and row.at - s[1] > self.gap_us:
            if not self.updates:
                yield self.Output(key, *s)
            s = None
        start, _, verdicts, passes, reach = s or (row.at, row.at, 0, 0, None)
        passes += bool(row.passed)
        if reach is None and row.passed and passes >= self.n_rules:
            reach = row.at
        s = (start, row.at, verdicts + 1, passes, reach)
        self.sessions.put((key,), s)
        if self.updates:
            yield self.Output(key, *s)

    def passed(self, at_us: int) -> Iterator[Row]:
        for (key,), s in self.sessions.items():
            if s[1] + self.gap_us <= at_us:
                if not self.updates:
                    yield self.Output(key, *s)
                self.sessions.put((key,), None)


def verdict_sessions(validations: DataFrame, gap: str = S.VALIDATION_SESSION_GAP, n_rules: int = S.NUMBER_OF_RULES,
                     updates: bool = False) -> DataFrame:
    """orderId, session_start, session_end, verdicts, passes, reach_ts of every closed session; with
    ``updates`` a row after every verdict instead (its time is then ``session_end``).

    ``validations`` has a watermark on ``ts``.
    """
    v = validations.select("orderId", "ts", micros("ts").alias("at"), F.lit(0).alias("kind"), "seq",
                           (F.col("validationResult") == "PASS").alias("passed"))
    out = _in_order(v, "orderId", VerdictSessions(interval_micros(gap), n_rules, updates),
                    "orderId string, start bigint, stop bigint, verdicts bigint, passes bigint, reach bigint")
    return out.select("orderId", F.timestamp_micros("start").alias("session_start"),
                      F.timestamp_micros("stop").alias("session_end"), "verdicts", "passes",
                      F.timestamp_micros("reach").alias("reach_ts"))


# ---- session totals as a changelog ------------------------------------------------------

class SessionChangelog(StatefulProcessor):
    """Session totals of a key after every row, in the order of arrival, with retractions.

    A row extends the open sessions within the gap of it, or bridges several.
    What they were is deleted -- a session is known by its start and end -- and
    the session that takes their place is written; ``version`` counts the key's
    changes.  State: map ``sessions`` of the open ones and the counter ``changes``.
    """

    Output = Row("start", "stop", "orders", "total", "version", "customerId")

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "start bigint", "stop bigint, orders bigint, total string")
        self.changes = handle.getValueState("changes", "n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.changes.get()
        version = held[0] if held else 0
        before = {k[0]: (v[0], v[1], Decimal(v[2])) for k, v in self.sessions.iterator()}
        sessions = OpenSessions((a, b, (n, t)) for a, (b, n, t) in before.items())
        for row in rows:
            near = sessions.near(row.at, self.gap_us)
            start, stop, orders, total = row.at, row.at, 1, Decimal(row.value)
            for a, b, (n, t) in near:
                start, stop, orders, total = min(start, a), max(stop, b), orders + n, MONEY.add(total, t)
            sessions.put(near, start, stop, (orders, total))
            for a, b, _ in near:
                if (a, b) != (start, stop):   # else the new value replaces it under the same name
                    version += 1
                    yield self.Output(a, b, None, None, version, key[0])
            version += 1
            yield self.Output(start, stop, orders, str(total), version, key[0])
        after = {a: (b, n, t) for a, b, (n, t) in sessions}
        for start in before.keys() - after.keys():
            self.sessions.removeKey((start,))
        for start, (stop, orders, total) in after.items():
            if before.get(start) != (stop, orders, total):
                self.sessions.updateValue((start,), (stop, orders, str(total)))
        self.changes.update((version,))
        self._wake(after, before)

    def _wake(self, after: dict[int, tuple], before: dict[int, tuple]) -> None:
        """One timer a key, at the end of the session that ends first."""
        first, known = (min((v[0] for v in x.values()), default=None) for x in (after, before))
        if first is not None and first != known:
            self.handle.registerTimer((first + self.gap_us) // 1000 + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """Sessions that no row can reach any more leave the state."""
        ms = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = {k[0]: (v[0],) for k, v in self.sessions.iterator()}
        gone = {start for start, v in held.items() if (v[0] + self.gap_us) // 1000 + 1 <= ms}
        if len(gone) == len(held):
            self.sessions.clear()
        else:
            for start in gone:
                self.sessions.removeKey((start,))
        self._wake({start: v for start, v in held.items() if start not in gone}, held if not gone else {})
        return iter(())

    def close(self) -> None:
        pass


def session_changelog(orders: DataFrame, gap: str = S.FRAUD_SESSION_GAP) -> DataFrame:
    """customerId, session_start, session_end, orders, total (null: deleted), version; ``orders`` has a watermark.

    Folding it -- the newest version of each (customer, start, end), without the deleted -- gives the
    table of sessions, whatever the order in which the rows came.
    """
    odd = odd_amounts()
    o = orders.where(F.col("state") == "CREATED").select(
        "customerId", "ts", micros("ts").alias("at"), amount_text(order_value(), *odd.values()).alias("value"))
    out = o.groupBy("customerId").transformWithState(
        SessionChangelog(interval_micros(gap)), "start bigint, stop bigint, orders bigint, total string, version bigint, "
        "customerId bigint", "append", "eventTime")
    return out.select("customerId", F.timestamp_micros("start").alias("session_start"),
                      F.timestamp_micros("stop").alias("session_end"), "orders",
                      F.col("total").cast("double").alias("total"), "version")


# ---- waiting lookups --------------------------------------------------------------------

VERSION, REQUEST = 0, 1
TERMINAL = ("VALIDATED", "FAILED")


class OrderRequests(InOrder):
    fields = "state string, customerId bigint, request string, terminal boolean, wait_us bigint"
    Output = Row("request", "id", "asked", "outcome", "at", "state", "customerId")

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.version_map = handle.getMapState("version", self.key, "state string, customerId bigint")
        self.pending_map = handle.getMapState(
            "pending", f"{self.key}, request string, asked bigint", "terminal boolean, until bigint")

    def load(self) -> None:
        self.versions, self.pending = Entries(self.version_map), Entries(self.pending_map, whole=True)
        self.asked = defaultdict(list)    # the waiting requests by order
        for wait in self.pending.now:
            self.asked[wait[0]].append(wait)

    def store(self) -> None:
        self.versions.store()
        self.pending.store()
        if self.pending.now != self.pending.was and (waits := self.pending.items()):
            self.wake(min(until for _, (_, until) in waits))

    @classmethod
    def _answer(cls, key: Any, request: str, asked: int, outcome: str, at: int, version: Any = None) -> Row:
        return cls.Output(request, key, asked, outcome, at, *(tuple(version) if version else (None, None)))

    def _timed_out(self, waits: list[tuple], before_us: int) -> Iterator[Row]:
        """Those of the requests whose deadline lies before ``before_us``."""
        for wait in waits:
            held = self.pending.get(wait)
            if held and held[1] < before_us:
                self.pending.put(wait, None)
                yield self._answer(*wait, "TIMEOUT", held[1])

    def apply(self, key: Any, row: Any) -> Iterator[Row]:
        if row.kind == REQUEST:
            version = self.versions.get((key,))
            if version and (not row.terminal or version[0] in TERMINAL):
                yield self._answer(key, row.request, row.at, "ANSWERED", row.at, version)
            else:
                wait = (key, row.request, row.at)
                self.pending.put(wait, (row.terminal, row.at + row.wait_us))
                self.asked[key].append(wait)
            return
        waits = self.asked.pop(key, [])
        yield from self._timed_out(waits, row.at)
        version = (row.state, row.customerId)
        self.versions.put((key,), version)
        for wait in dict.fromkeys(waits):
            held = self.pending.get(wait)
            if held and (not held[0] or row.state in TERMINAL):
                self.pending.put(wait, None)
                yield self._answer(*wait, "LATE", row.at, version)
            elif held:
                self.asked[key].append(wait)

    def passed(self, at_us: int) -> Iterator[Row]:
        yield from self._timed_out([wait for wait, _ in self.pending.items()], at_us + 1)


def order_requests(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Lookups of orders that wait: request, id, asked_ts, outcome, answered_ts, state, customerId.

    ``requests``: request, id, terminal_only, wait_us, ts; ``versions``: id,
    state, customerId, ts, seq; both with a watermark on ``ts``.  A request whose order
    stands in a wanted state is ANSWERED at once; else it waits and is
    answered LATE by the first version in a wanted state up to its deadline, or
    it ends as TIMEOUT at the deadline.
    """
    r = requests.select("id", "ts", micros("ts").alias("at"), F.lit(REQUEST).alias("kind"), F.lit(0).cast("bigint").alias("seq"),
                        F.lit(None).cast("string").alias("state"), F.lit(None).cast("bigint").alias("customerId"),
                        "request", F.col("terminal_only").alias("terminal"), "wait_us")
    v = versions.select("id", "ts", micros("ts").alias("at"), F.lit(VERSION).alias("kind"), "seq", "state", "customerId",
                        F.lit(None).cast("string").alias("request"), F.lit(None).cast("boolean").alias("terminal"),
                        F.lit(None).cast("bigint").alias("wait_us"))
    out = _in_order(r.unionByName(v), "id", OrderRequests(), "request string, id string, asked bigint, outcome string, "
                    "at bigint, state string, customerId bigint")
    return out.select("request", "id", F.timestamp_micros("asked").alias("asked_ts"), "outcome",
                      F.timestamp_micros("at").alias("answered_ts"), "state", "customerId")


# ---- reading state ----------------------------------------------------------------------

def state_table(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """A named state of a stopped query: key and value columns of every key (a map state's entries as rows)."""
    st = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    if "value" in st.columns:
        return st.select("key.*", "value.*")
    return st.select("key.*", "user_map_key.*", "user_map_value.*")
