"""What the stateful processors cost: state calls by slot and bucket, not by row; sessions found by bisection."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import Row

from orderflow.sources import fixtures as fx
from orderflow.streaming import processors, stateful, twins
from orderflow.streaming.processors import OrderRequests, Reservation, SessionChangelog, VerdictSessions

GAP = 3_600_000_000


class FakeState:
    """Map state, value state and timers of one key in memory; counts the calls."""

    def __init__(self):
        self.calls, self.maps, self.timers = 0, {}, set()

    def getMapState(self, name, *_):
        return FakeMap(self, self.maps.setdefault(name, {}))

    getValueState = getMapState

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def getExpiryTimeInMs(self):
        return self.expiry

    def feed(self, processor, rows):
        return list(processor.handleInputRows((0,), iter(rows), self))

    def advance(self, processor, watermark):
        """The timers behind the watermark in their order, also those that they set."""
        self.watermark, out = watermark, []
        while due := [t for t in self.timers if t <= watermark]:
            self.expiry = min(due)
            self.timers.discard(self.expiry)
            out += processor.handleExpiredTimer((0,), self, self)
        return out


class FakeMap:
    def __init__(self, handle, data):
        self.handle, self.data = handle, data

    def _call(self):
        self.handle.calls += 1
        return self.data

    def getValue(self, key):
        return self._call().get(key)

    def updateValue(self, key, value):
        self._call()[key] = value

    def removeKey(self, key):
        self._call().pop(key, None)

    def iterator(self):
        return iter(list(self._call().items()))

    def clear(self):
        self._call().clear()

    def get(self):
        return self._call().get(())

    def update(self, value):
        self._call()[()] = value


def _processor(p, key):
    p.key = f"{key} string"
    handle = FakeState()
    p.init(handle)
    return p, handle


def _verdicts(n):
    rnd = random.Random(1)
    rows = [Row(bucket=0, orderId=f"o{i // 3}", at=i * 20_000_000 + rnd.randrange(1000), kind=0, seq=i, passed=i % 5 > 0)
            for i in range(n)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("updates", [True, False])
def test_verdict_sessions_cost_calls_by_slot_and_do_not_depend_on_the_batches(updates):
    rows = _verdicts(30_000)          # seven days, 10,000 orders
    p, handle = _processor(VerdictSessions(300_000_000, 3, updates), "orderId")
    handle.feed(p, rows)
    one = handle.advance(p, 10 ** 12)
    assert len(one) == (30_000 if updates else 10_000)
    assert handle.calls < 1000
    assert not handle.maps["waiting"] and not handle.maps["session"]
    # the same rows in time order over twenty batches, the watermark close behind
    p, handle = _processor(VerdictSessions(300_000_000, 3, updates), "orderId")
    rows, many = sorted(rows, key=lambda r: r.at), []
    for i in range(0, 30_000, 1500):
        handle.feed(p, rows[i:i + 1500])
        many += handle.advance(p, rows[i + 1499].at // 1000 - 1000)
    many += handle.advance(p, 10 ** 12)
    assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_rows_of_a_slot_in_many_parts_stay_in_order(monkeypatch):
    monkeypatch.setattr(processors, "PART_ROWS", 10)
    monkeypatch.setattr(processors, "HELD_ROWS", 7)
    p, handle = _processor(Reservation(), "product")
    rows = [Row(bucket=0, product="P", at=i, kind=1, seq=i, id=f"o{i}", quantity=1, stock=None) for i in range(1, 200)]
    rows.append(Row(bucket=0, product="P", at=0, kind=0, seq=0, id=None, quantity=None, stock=150))
    random.Random(2).shuffle(rows)
    handle.feed(p, rows)
    assert handle.maps["parts"]
    out = handle.advance(p, 10 ** 9)
    assert [(r.id, r.reserved) for r in out] == [(f"o{i}", min(i, 150)) for i in range(1, 200)]
    assert handle.maps["reserved"] == {("P",): (150,)} and not handle.maps["parts"] and not handle.maps["waiting"]


def test_waiting_requests_are_answered_across_slots():
    p, handle = _processor(OrderRequests(), "id")
    day = p.slot_us

    def request(name, id_, at, wait):
        return Row(bucket=0, id=id_, at=at, kind=1, seq=0, state=None, customerId=None, request=name, terminal=True, wait_us=wait)

    def version(id_, at, state):
        return Row(bucket=0, id=id_, at=at, kind=0, seq=1, state=state, customerId=5, request=None, terminal=None, wait_us=None)

    handle.feed(p, [request("late", "a", day - 10, 20), request("gone", "b", day - 10, 20), version("a", day - 15, "CREATED"),
                    version("a", day + 5, "FAILED"), version("b", day + 15, "FAILED"), request("now", "b", day + 15, 1)])
    out = {r.request: (r.outcome, r.at, r.state) for r in handle.advance(p, 10 ** 9)}
    assert out == {"late": ("LATE", day + 5, "FAILED"), "gone": ("TIMEOUT", day + 10, None), "now": ("ANSWERED", day + 15, "FAILED")}
    assert not handle.maps["pending"] and handle.maps["version"][("a",)] == ("FAILED", 5)


def test_changelog_of_a_customer_with_many_sessions_takes_linear_time_and_calls():
    n = 20_000
    p, handle = _processor(SessionChangelog(GAP), "customerId")
    rows = [Row(at=i * 3 * GAP, value="1.5") for i in range(n)] + [Row(at=0, value="2")]
    t = time.time()
    out = handle.feed(p, rows)
    assert time.time() - t < 10 and len(out) == n + 1 and (out[-1].orders, out[-1].total) == (2, "3.5")
    assert handle.calls < n + 10                       # a write for each session; one timer
    handle.advance(p, 3 * GAP * n)
    assert not handle.maps["sessions"]


def test_fraud_sessions_of_a_customer_take_linear_time():
    class State:
        exists, get = False, None

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, value):
            self.get = value

        def setTimeoutTimestamp(self, ms):
            self.timeout = ms

    n, state = 40_000, State()
    pdf = pd.DataFrame({"id": "x", "customerId": 1, "ts": pd.Timestamp(0), "seq": range(n), "order_value": "1",
                        "__t": [(i // 2) * 3 * GAP for i in range(n)]})
    t = time.time()
    out = pd.concat(stateful._fraud_fn(GAP)((1,), iter([pdf]), state))
    assert time.time() - t < 15
    assert out["total"].tolist() == ["1", "2"] * (n // 2) and len(state.get[0]) == n // 2
    assert state.timeout == GAP // 1000 + 1


def test_open_sessions_merge_what_a_row_bridges():
    s = stateful.OpenSessions([(100, 110, "b"), (0, 10, "a"), (300, 300, "c")])
    assert s.near(55, 45) == [(0, 10, "a"), (100, 110, "b")] and s.near(200, 45) == []
    s.put(s.near(55, 45), 0, 110, "ab")
    s.put([], 200, 200, "d")
    assert list(s) == [(0, 110, "ab"), (200, 200, "d"), (300, 300, "c")]


def test_a_stock_that_is_not_known_takes_whatever_is_asked():
    p, handle = stateful._Reserve("product", "bigint", ["product", "quantity", "seq", "stock", "at_us"], ["id"]), FakeState()
    p.init(handle)
    pdf = pd.DataFrame({"id": list("abcd"), "product": [1.0, 1, 2, None], "quantity": [4, 0, None, 3], "seq": range(4),
                        "stock": [None, None, None, 2], "at_us": range(4)})
    out = pd.concat(p.handleInputRows((0,), iter([pdf]), handle))
    assert dict(zip(out["id"], zip(out["validationResult"], out["reserved"]))) == {
        "a": ("PASS", 4), "b": ("PASS", 4), "c": ("FAIL", 0), "d": ("FAIL", 0)}
    assert handle.maps["reserved"] == {(1,): (4,), (2,): (0,), (None,): (0,)}


def test_state_partitions_grow_with_the_table(spark, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        cores = spark.sparkContext.defaultParallelism
        for rows, n in ((10, 4), (600_000, min(cores, 6)), (36_000_000, 2 * cores)):
            monkeypatch.setattr(fx, "table", lambda *_: type("T", (), {"count": lambda self: rows})())
            assert twins.state_partitions(spark, "d", "events") == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
