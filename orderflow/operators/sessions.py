"""Session windows with per-event running aggregates, safe for hot keys.

A session of a key is a maximal run of its events in which consecutive
events are at most ``gap`` apart (events exactly one gap apart share a
session; ``gap=None``: all events of a key are one session).  The reference
re-emits the session aggregate after every event, so the batch form returns
every input row with the session start and the running sums up to and
including that row.

Ordinary keys take one Exchange and one sort: in the key's order, a running
sum minus the running sum before the session's first row is the session's
running sum, and the time of the last break is the session's start.

Hot keys (see :mod:`orderflow.operators.hotkeys`) never meet in one task:

1. Rows are partitioned by ``(key, bucket)``.  Inside a bucket, ``lag`` finds
   breaks and the running sums accumulate per local session.
2. A summary row per ``(key, bucket)`` (first/last time, number of local
   sessions, start and total of the last local session) is computed on the
   same partitioning.
3. The summary -- one row per bucket, independent of the row count -- is
   scanned per key in bucket order: a bucket is *connected* when its first
   event is within ``gap`` of the previous bucket's last event.  Consecutive
   connected single-session buckets form chains; a running sum over each
   chain gives the total and start of the session still open at the end of
   every bucket.
4. The carried total/start is joined back on ``(key, bucket)`` and added to
   the first local session of each bucket.

All arithmetic on time is on epoch microseconds (exact).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expressions import interval_micros, micros
from orderflow.operators.hotkeys import TARGET_ROWS, split_hot

_T, _B, _LSID, _NEW = "__t", "__b", "__lsid", "__new"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def sessionize(df: DataFrame, key: str | Sequence[str], ts: str, order: Sequence[str],
               gap: str | None, measures: Mapping[str, Column] | None = None,
               split: str | None = None, prefix: str = "session_",
               target_rows: int = TARGET_ROWS) -> DataFrame:
    """Add ``session_start`` (timestamp) and running sums of ``measures``.

    ``order`` are tie-breaking columns after ``ts`` (e.g. ``["seq"]``).
    ``measures`` maps output name -> numeric column (summed per session).
    ``split``: a fixed time-bucket width for every key; ``None`` (default)
    splits only hot keys.  Any split gives the same answer, it only changes
    the parallelism.
    """
    keys = _keys(key)
    measures = dict(measures or {})
    base = df.select("*", micros(ts).alias(_T), *[c.alias(f"__m_{n}") for n, c in measures.items()])
    names = list(measures)
    if split is not None:
        hot = base.withColumn(_B, F.floor(F.col(_T) / F.lit(interval_micros(split))).cast("bigint"))
        return _bucketed(hot, keys, order, gap, names, prefix)
    cold, hot = split_hot(base, keys, [_T, *order], target_rows)
    out = _plain(cold, keys, order, gap, names, prefix)
    if hot is None:
        return out
    return out.unionByName(_bucketed(hot, keys, order, gap, names, prefix))


def _break(w: str, gap: str | None) -> str:
    """SQL: the row begins a session in its window."""
    if gap is None:
        return f"lag({_T}) OVER ({w}) IS NULL"
    return f"lag({_T}) OVER ({w}) IS NULL OR {_T} - lag({_T}) OVER ({w}) > {interval_micros(gap)}"


def _plain(base: DataFrame, keys: list[str], order: Sequence[str], gap: str | None,
           measures: list[str], prefix: str) -> DataFrame:
    """Whole keys: every window below has the same partitioning and order."""
    w = (f"PARTITION BY {', '.join(f'`{c}`' for c in keys)} "
         f"ORDER BY {', '.join([_T] + [f'`{c}`' for c in order])}")
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    keep = [f"`{c}`" for c in base.columns if not c.startswith("__")]
    rows = base.selectExpr("*", f"{_break(w, gap)} AS {_NEW}",
                           *[f"SUM(__m_{n}) OVER ({w} {running}) AS __cum_{n}" for n in measures])
    return rows.selectExpr(
        *keep, f"timestamp_micros(last(CASE WHEN {_NEW} THEN {_T} END, true) OVER ({w} {running})) AS `{prefix}start`",
        *[f"__cum_{n} - last(CASE WHEN {_NEW} THEN __cum_{n} - __m_{n} END, true) OVER ({w} {running}) AS `{n}`"
          for n in measures])


def _bucketed(base: DataFrame, keys: list[str], order: Sequence[str], gap: str | None,
              measures: list[str], prefix: str) -> DataFrame:
    """Keys in ordered buckets ``__b``."""
    k = ", ".join(f"`{c}`" for c in keys)
    o = ", ".join([_T] + [f"`{c}`" for c in order])
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    # 1. local sessions inside each (key, bucket)
    wb = f"PARTITION BY {k}, {_B} ORDER BY {o}"
    base = base.selectExpr(
        "*",
        f"CASE WHEN {_break(wb, gap)} THEN 1 ELSE 0 END AS {_NEW}",
        f"lead({_T}) OVER ({wb}) IS NULL AS __is_last")
    base = base.selectExpr("*", f"SUM({_NEW}) OVER ({wb} {running}) AS {_LSID}")
    ws = f"PARTITION BY {k}, {_B}, {_LSID} ORDER BY {o} {running}"
    base = base.selectExpr("*", f"MIN({_T}) OVER ({ws}) AS __lstart",
                           *[f"SUM(__m_{n}) OVER ({ws}) AS __lrun_{n}" for n in measures])

    # 2. one summary row per (key, bucket); the bucket's last row (marked by
    # ``lead`` in the same window) carries the open session's start and sums,
    # so the summary is a plain hash aggregate
    summary = base.groupBy(*keys, _B).agg(
        F.expr(f"min({_T}) AS __first_t"), F.expr(f"max({_T}) AS __last_t"),
        F.expr(f"max({_LSID}) AS __nsess"),
        F.expr("max(CASE WHEN __is_last THEN __lstart END) AS __last_start"),
        *[F.expr(f"max(CASE WHEN __is_last THEN __lrun_{n} END) AS __last_{n}") for n in measures])

    # 3. chains of connected single-session buckets
    wk = f"PARTITION BY {k} ORDER BY {_B}"
    near = "true" if gap is None else f"__first_t - lag(__last_t) OVER ({wk}) <= {interval_micros(gap)}"
    summary = summary.selectExpr("*", f"lag(__last_t) OVER ({wk}) IS NOT NULL AND {near} AS __connected")
    summary = summary.selectExpr("*", "__connected AND __nsess = 1 AS __through")
    summary = summary.selectExpr(
        "*", f"SUM(CASE WHEN __through THEN 0 ELSE 1 END) OVER ({wk} {running}) AS __grp")
    wg = f"PARTITION BY {k}, __grp ORDER BY {_B} {running}"
    summary = summary.selectExpr(
        "*", f"first(__last_start) OVER ({wg}) AS __open_start",
        *[f"first(__last_{n}) OVER ({wg}) "
          f"+ SUM(CASE WHEN __through THEN __last_{n} ELSE 0 END) OVER ({wg}) AS __open_{n}"
          for n in measures])
    # what flows into each bucket from its predecessor
    carry = summary.selectExpr(
        *[f"`{c}`" for c in keys], _B,
        f"CASE WHEN __connected THEN lag(__open_start) OVER ({wk}) END AS __in_start",
        *[f"CASE WHEN __connected THEN lag(__open_{n}) OVER ({wk}) ELSE 0 END AS __in_{n}"
          for n in measures])

    # 4. join the carry back on (key, bucket) and finish the first local session
    out = base.join(carry, on=[*keys, _B], how="inner")
    keep = [f"`{c}`" for c in out.columns if not c.startswith("__")]
    return out.selectExpr(
        *keep,
        f"timestamp_micros(CASE WHEN {_LSID} = 1 AND __in_start IS NOT NULL THEN __in_start "
        f"ELSE __lstart END) AS `{prefix}start`",
        *[f"__lrun_{n} + CASE WHEN {_LSID} = 1 THEN __in_{n} ELSE 0 END AS `{n}`" for n in measures])
