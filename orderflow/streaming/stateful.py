"""Custom keyed state for the two operators built-in windows cannot express.

* :func:`fraud_sessions` -- per customer, session windows (gap) whose
  running total is emitted after **every** order (Spark's ``session_window``
  emits only the final session in append mode and rejects update mode).
  State: the customer's open sessions ``(start, end, total)``; an event
  merges every open session within the gap; sessions older than the
  watermark by more than the gap are evicted (event-time timeout).
* :func:`reserve_stock` -- per product, the greedy reservation fold;
  state: the reserved quantity (never released).
* :func:`reserve_evolving_stock` -- the same against a stock table that
  changes; state: the reserved quantity and the product's newest stock.

* :func:`pass_sessions` -- per order, verdict sessions with bounded state
  (counts and the few smallest PASS times), emitted once closed.

Rows of one key inside a micro-batch arrive in no particular order, so they
are sorted by ``(ts, seq)`` before being applied; that buffer is bounded by
the micro-batch size (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from decimal import Context, Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderflow import schemas as S
from orderflow.functions.expressions import (
    amount_text, interval_micros, limit_branch, micros, odd_amounts, order_value)

FRAUD_STATE = T.StructType([
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("totals", T.ArrayType(T.StringType())),  # exact decimals
])

FRAUD_OUT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("customerId", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("session_start_us", T.LongType()),
    T.StructField("order_value", T.StringType()),
    T.StructField("total", T.StringType()),
])


RESERVE_BUCKETS = 1024   # groups of keys that share a state key; part of a checkpoint's layout

# Sums of money: wide enough to stay exact, NaN and infinities as in double arithmetic.
_MONEY = Context(prec=60, traps=[])


class OpenSessions:
    """The open sessions of a key, (start, stop, value) by start; apart by more than the gap, so by stop as well."""

    def __init__(self, sessions=()):
        rows = sorted(sessions, key=lambda s: s[0])
        self.starts, self.stops, self.values = ([r[i] for r in rows] for i in range(3))

    def __iter__(self):
        return zip(self.starts, self.stops, self.values)

    def near(self, at: int, gap: int) -> list[tuple]:
        """The sessions within ``gap`` of ``at``, found by bisection."""
        i, j = bisect_left(self.stops, at - gap), bisect_right(self.starts, at + gap)
        return [(self.starts[k], self.stops[k], self.values[k]) for k in range(i, j)]

    def put(self, near: list[tuple], start: int, stop: int, value) -> None:
        """A session in the place of those of ``near``, which it covers."""
        i = bisect_left(self.starts, near[0][0] if near else start)
        j = i + len(near)
        self.starts[i:j], self.stops[i:j], self.values[i:j] = [start], [stop], [value]


def _fraud_fn(gap_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        open_ = OpenSessions()
        if state.exists:
            starts, ends, totals = state.get
            open_ = OpenSessions(zip(starts, ends, map(Decimal, totals)))
        frames = [p for p in pdfs if len(p)]
        if frames:
            pdf = frames[0] if len(frames) == 1 else pd.concat(frames)
            pdf = pdf.sort_values(["__t", "seq"], kind="stable")
            out_start, out_total = [], []
            for t, v in zip(pdf["__t"].tolist(), pdf["order_value"].tolist()):
                near = open_.near(t, gap_us)
                s, e, tot = t, t, Decimal(v)
                for a, b, x in near:
                    s, e, tot = min(s, a), max(e, b), _MONEY.add(tot, x)
                open_.put(near, s, e, tot)
                out_start.append(s)
                out_total.append(str(tot))
            yield pd.DataFrame({
                "id": pdf["id"].to_numpy(), "customerId": pdf["customerId"].to_numpy(),
                "ts": pdf["ts"].to_numpy(), "seq": pdf["seq"].to_numpy(),
                "session_start_us": np.asarray(out_start, dtype=np.int64),
                "order_value": pdf["order_value"].to_numpy(), "total": out_total})
        wm = state.getCurrentWatermarkMs() * 1000
        keep = [x for x in open_ if x[1] + gap_us >= wm]
        if keep:
            state.update(([x[0] for x in keep], [x[1] for x in keep], [str(x[2]) for x in keep]))
            state.setTimeoutTimestamp(max((keep[0][1] + gap_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
    return fn


def fraud_sessions(orders: DataFrame, gap: str = S.FRAUD_SESSION_GAP,
                   lateness: str | None = None) -> DataFrame:
    """Streaming per-order session totals (same rows as the batch ``fraud_session_totals``).

    ``lateness``: how far behind the newest event a row may come and still
    count; by default the gap, for so long its session is open.
    """
    odd = odd_amounts()
    o = (orders.where(F.col("state") == "CREATED")
         .withWatermark("ts", lateness or gap)
         .select("id", "customerId", "ts", "seq",
                 amount_text(order_value(), *odd.values()).alias("order_value"),
                 micros("ts").alias("__t")))
    out = o.groupBy("customerId").applyInPandasWithState(
        _fraud_fn(interval_micros(gap)), FRAUD_OUT, FRAUD_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select("id", "customerId", "ts", "seq", F.timestamp_micros("session_start_us").alias("session_start"),
                      F.col("order_value").cast("double").alias("order_value"),
                      F.col("total").cast("double").alias("total"))


def fraud_verdicts(totals: DataFrame, limit: float = S.FRAUD_LIMIT) -> DataFrame:
    """Verdict rows of the session totals; a NaN total gets none."""
    v = totals.select("id", "ts", "seq", limit_branch("total", float(limit)).alias("r")).where("r IS NOT NULL")
    return v.select(F.col("id").alias("orderId"), F.lit("FRAUD_CHECK").alias("checkType"),
                    F.col("r").alias("validationResult"),
                    (F.col("ts") + F.expr("INTERVAL '2' SECOND")).alias("ts"), (F.col("seq") * 3 + 1).alias("seq"))


class _Reserve(StatefulProcessor):
    """Orders with their stock, by bucket of keys; map state ``reserved`` by key, read and written once a micro-batch."""

    def __init__(self, key: str, kind: str, ints: list[str], columns: list[str]):
        self.key, self.kind, self.ints, self.columns = key, kind, ints, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reserved = handle.getMapState("reserved", f"{self.key} {self.kind}", "reserved bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([p.astype({c: "Int64" for c in self.ints}) for p in rows], ignore_index=True)
        of, keys = pd.factorize(pdf[self.key], use_na_sentinel=False)
        pdf = pdf.assign(__k=of).sort_values(["__k", "at_us", "seq"], kind="stable")   # nulls go last
        verdict, held, last, reserved = [], [], None, 0
        stock = pdf["stock"].astype(object).where(pdf["stock"].notna(), None).tolist()
        for k, q, s in zip(pdf["__k"].tolist(), pdf["quantity"].fillna(0).tolist(), stock):
            if k != last:
                if last is not None:
                    self.reserved.updateValue(names, (reserved,))
                last, names = k, (None if pd.isna(keys[k]) else keys[k],)
                before = self.reserved.getValue(names)
                reserved = before[0] if before else 0
            # a stock that is not known takes whatever is asked
            ok = s - reserved - q >= 0 if s is not None else reserved + q > 0
            reserved += q if ok else 0
            verdict.append("PASS" if ok else "FAIL")
            held.append(reserved)
        self.reserved.updateValue(names, (reserved,))
        yield pdf[self.columns].assign(validationResult=verdict, reserved=np.asarray(held, dtype=np.int64))

    def close(self) -> None:
        pass


def reserve_stock(rows: DataFrame, key: str = "product") -> DataFrame:
    """Streaming greedy reservation over orders already joined with their stock.

    Keys share ``RESERVE_BUCKETS`` state keys: what Spark does for a group costs far more than the few
    rows of a key.
    """
    cols, kinds = list(rows.columns), dict(rows.dtypes)
    r = rows.withColumn("at_us", micros("ts")).withColumn(
        "state_bucket", F.pmod(F.xxhash64(key), F.lit(RESERVE_BUCKETS)).cast("int"))
    ints = [c for c, t in r.dtypes if t in ("int", "bigint") and c != "state_bucket"]
    out_schema = T.StructType([rows.schema[c] for c in cols] + [
        T.StructField("validationResult", T.StringType()), T.StructField("reserved", T.LongType())])
    return r.groupBy("state_bucket").transformWithStateInPandas(
        _Reserve(key, kinds[key], ints, cols), out_schema, "append", "none")


EVOLVING_STATE = T.StructType([T.StructField("reserved", T.LongType()), T.StructField("stock", T.LongType())])


def _evolving_fn(out_cols: list[str]):
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        reserved, stock = state.get if state.exists else (0, None)
        frames = [p for p in pdfs if len(p)]
        if not frames:
            return
        # at equal times a stock row comes before the orders that may use it
        pdf = pd.concat(frames).sort_values(["__t", "__kind", "seq"], kind="stable").reset_index(drop=True)
        at, verdict, res, held = [], [], [], []
        q = pdf["quantity"].fillna(0).astype("int64").tolist()
        new = pdf["stock"].tolist()
        for i, kind in enumerate(pdf["__kind"].tolist()):
            if kind == 0:
                stock = int(new[i])
            elif stock is not None:
                ok = stock - reserved - q[i] >= 0
                reserved += q[i] if ok else 0
                at.append(i)
                verdict.append("PASS" if ok else "FAIL")
                res.append(reserved)
                held.append(stock)
        state.update((reserved, stock))
        if at:
            out = pdf.loc[at, out_cols].copy()
            out["stock"] = np.asarray(held, dtype=np.int32)
            out["validationResult"] = verdict
            out["reserved"] = np.asarray(res, dtype=np.int64)
            yield out
    return fn


def reserve_evolving_stock(orders: DataFrame, changes: DataFrame, key: str = "product") -> DataFrame:
    """Streaming reservation against a stock table that is itself a stream of changes.

    Both streams meet in the product's state: a change replaces its stock, an
    order is judged by the stock known at its time; without any, it gets no
    verdict.
    """
    cols = [c for c in orders.columns]
    o = orders.select(*cols, F.lit(None).cast("int").alias("stock"), micros("ts").alias("__t"), F.lit(1).alias("__kind"))
    c = changes.select(key, "ts", "seq", "stock", micros("ts").alias("__t"), F.lit(0).alias("__kind"))
    u = o.unionByName(c, allowMissingColumns=True)
    schema = T.StructType([orders.schema[x] for x in cols] + [
        T.StructField("stock", T.IntegerType()), T.StructField("validationResult", T.StringType()),
        T.StructField("reserved", T.LongType())])
    return u.groupBy(key).applyInPandasWithState(
        _evolving_fn(cols), schema, EVOLVING_STATE, "append", GroupStateTimeout.NoTimeout)


# ---- PASS-count sessions (bounded state) ---------------------------------------------

PASS_STATE = T.StructType([
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("verdicts", T.ArrayType(T.LongType())),
    T.StructField("passes", T.ArrayType(T.LongType())),
    # the n smallest PASS times of each session, n slots per session (-1 = empty)
    T.StructField("first_passes", T.ArrayType(T.LongType())),
])

PASS_OUT = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("session_start_us", T.LongType()),
    T.StructField("session_end_us", T.LongType()),
    T.StructField("verdicts", T.LongType()),
    T.StructField("passes", T.LongType()),
    T.StructField("reach_us", T.LongType()),
])


def _pass_fn(gap_us: int, n: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.exists:
            st, en, ve, pa_, fp = (list(x) for x in state.get)
            firsts = [[v for v in fp[i * n:(i + 1) * n] if v >= 0] for i in range(len(st))]
        else:
            st, en, ve, pa_, firsts = [], [], [], [], []
        ts, seqs, oks = [], [], []
        for p in pdfs:
            if len(p):
                ts.append(p["__t"].to_numpy()); seqs.append(p["seq"].to_numpy())
                oks.append(p["__pass"].to_numpy())
        if ts:
            t_all, s_all, ok_all = np.concatenate(ts), np.concatenate(seqs), np.concatenate(oks)
            order = np.lexsort((s_all, t_all))
            for t, ok in zip(t_all[order].tolist(), ok_all[order].tolist()):
                hit = [i for i in range(len(st)) if st[i] - gap_us <= t <= en[i] + gap_us]
                s, e, v, p, f = t, t, 1, int(ok), ([t] if ok else [])
                for i in hit:
                    s, e = min(s, st[i]), max(e, en[i])
                    v, p, f = v + ve[i], p + pa_[i], f + firsts[i]
                for i in reversed(hit):
                    del st[i], en[i], ve[i], pa_[i], firsts[i]
                st.append(s); en.append(e); ve.append(v); pa_.append(p); firsts.append(sorted(f)[:n])
        wm = state.getCurrentWatermarkMs() * 1000
        done = [i for i in range(len(st)) if en[i] + gap_us < wm]
        if done:
            yield pd.DataFrame({
                "orderId": [key[0]] * len(done),
                "session_start_us": [st[i] for i in done], "session_end_us": [en[i] for i in done],
                "verdicts": [ve[i] for i in done], "passes": [pa_[i] for i in done],
                "reach_us": pd.array([firsts[i][n - 1] if len(firsts[i]) >= n else None for i in done],
                                     dtype="Int64")})
        keep = [i for i in range(len(st)) if i not in set(done)]
        if keep:
            flat = []
            for i in keep:
                flat += firsts[i] + [-1] * (n - len(firsts[i]))
            state.update(([st[i] for i in keep], [en[i] for i in keep], [ve[i] for i in keep],
                          [pa_[i] for i in keep], flat))
            state.setTimeoutTimestamp(max((min(en[i] for i in keep) + gap_us) // 1000 + 1,
                                          state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
    return fn


def pass_sessions(validations: DataFrame, gap: str = S.VALIDATION_SESSION_GAP,
                  n_rules: int = S.NUMBER_OF_RULES) -> DataFrame:
    """Streaming per-order verdict sessions: verdicts, PASS count, time of the n-th PASS.

    State per open session is five numbers plus the ``n_rules`` smallest PASS
    times (enough to merge sessions exactly); a session is emitted once the
    watermark passes its end plus the gap.  Input must carry a watermark.
    """
    v = validations.select(
        "orderId", "ts", "seq", micros("ts").alias("__t"),
        (F.col("validationResult") == "PASS").alias("__pass"))
    out = v.groupBy("orderId").applyInPandasWithState(
        _pass_fn(interval_micros(gap), n_rules), PASS_OUT, PASS_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(
        "orderId", F.timestamp_micros("session_start_us").alias("session_start"),
        F.timestamp_micros("session_end_us").alias("session_end"), "verdicts", "passes",
        F.timestamp_micros("reach_us").alias("reach_ts"))
