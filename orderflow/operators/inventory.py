"""Inventory check: order ⋈ stock, then the greedy reservation fold.

Fold semantics (per product, in arrival order): an order passes and
reserves its quantity when ``stock - reserved - quantity >= 0``; otherwise
it fails and reserves nothing.  Reservations are never released.  It is
not a running sum: a rejected order leaves room for a later smaller one.

Execution plan (exact for every key):

* per-key statistics (one small aggregate) find the keys with more than
  ``hot_rows`` rows; all others are one segment each, folded from zero;
* a hot key whose demand fits its smallest stock passes everywhere:
  ``reserved`` is a running sum, computed with the bucketed scan of
  :mod:`orderflow.operators.sessions`;
* any other hot key is cut into segments of about ``hot_rows`` rows at
  quantiles of (time, seq).  What a segment does to the reservation it starts
  with is a function with slope one between breakpoints.  Its pieces are found
  where they are needed, never as a table over the values a reservation can
  take: two come from one pass (low starts, from which every row passes; high
  starts, from which none does), and folding a segment from one start gives
  the whole piece around it, bounded by the narrowest margin by which a row
  passed or failed.  A chain per key evaluates the pieces in segment order;
  a segment that is entered between its pieces is folded from there (all such
  segments at once, with an estimate for what lies behind the first), and the
  chain is evaluated again, until every start lies on a piece.  Each round
  settles at least the first open segment of every key; as contended starts
  soon meet in a few values, it takes two or three;
* the folds stream over rows sorted within partitions (``mapInPandas``): O(1)
  state, nothing buffered per key, whatever the size of stock or quantities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions.expressions import interval_micros, micros
from orderflow.functions.joins import replicated
from orderflow.operators.reports import keyed_table
from orderflow.operators.hotkeys import TARGET_ROWS, split_hot
from orderflow.operators.sessions import sessionize
from orderflow.session import materialize


def join_stock(orders: DataFrame, inventory: DataFrame, key: str = "product") -> DataFrame:
    """Created orders ⋈ (static) warehouse stock on product (inner).

    Orders of products without a stock row get no verdict at all; of several
    rows of a product the newest (by ``seq``) holds.
    """
    inv = keyed_table(inventory, key).select(key, "stock")
    return orders.where(F.col("state") == "CREATED").join(inv, on=key, how="inner") \
        if "state" in orders.columns else orders.join(inv, on=key, how="inner")


def asof_join(left: DataFrame, right: DataFrame, by: str, ts: str = "ts", seq: str = "seq",
              values: tuple[str, ...] = ("stock",), split: str | None = None,
              how: str = "inner", target_rows: int = TARGET_ROWS) -> DataFrame:
    """For each left row, the latest right row of the same ``by`` with ``right.ts <= left.ts``.

    Ties on time resolve to the right row with the highest ``seq``; a right
    row at exactly the left row's time is visible to it.  Both sides are put
    in one order per key (one Exchange, one sort) and the last right value is
    carried forward.  Hot keys are cut into ordered buckets (see
    :mod:`orderflow.operators.hotkeys`; ``split`` forces time buckets of one
    width on every key), and the last value of earlier buckets comes in
    through a summary of one row per bucket.
    ``how='inner'`` drops left rows with no earlier right row, ``'left'``
    keeps them with nulls.
    """
    lcols = list(left.columns)
    l = left.select(F.col(by).alias("__by"), micros(ts).alias("__t"), F.lit(1).alias("__kind"),
                    F.col(seq).alias("__s"), *lcols)
    r = right.select(F.col(by).alias("__by"), micros(ts).alias("__t"), F.lit(0).alias("__kind"),
                     F.col(seq).alias("__s"), *[F.col(v).alias(f"__v_{v}") for v in values])
    u = l.unionByName(r, allowMissingColumns=True)
    run = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    order = "ORDER BY __t, __kind, __s"

    def last(v: str, part: str, name: str) -> str:
        # wrapped, so that a null value of the latest right row is taken as it is
        return (f"last(CASE WHEN __kind = 0 THEN struct(__v_{v} AS x) END, true) "
                f"OVER (PARTITION BY {part} {order} {run}) AS {name}_{v}")

    def finish(df: DataFrame) -> DataFrame:
        if how == "inner":
            df = df.where(f"__l_{values[0]} IS NOT NULL")
        return df.select(*lcols, *[F.col(f"__l_{v}")["x"].alias(v) for v in values])

    def bucketed(df: DataFrame) -> DataFrame:
        df = df.selectExpr("*", *[last(v, "__by, __b", "__own") for v in values])
        picked = ", ".join(f"CASE WHEN __kind = 0 THEN __v_{v} END AS {v}" for v in values)
        summ = df.groupBy("__by", "__b").agg(F.expr(
            f"max_by(CASE WHEN __kind = 0 THEN struct({picked}) END, "
            "CASE WHEN __kind = 0 THEN struct(__t, __s) END) AS __bucket_last"))
        summ = summ.selectExpr("__by", "__b", "last(__bucket_last, true) OVER (PARTITION BY __by ORDER BY __b "
                                              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS __in")
        df = df.where("__kind = 1").join(summ, on=["__by", "__b"], how="inner")
        return finish(df.selectExpr("*", *[
            f"coalesce(__own_{v}, CASE WHEN __in IS NOT NULL THEN struct(__in.{v} AS x) END) AS __l_{v}"
            for v in values]))

    if split is not None:
        return bucketed(u.withColumn("__b", F.floor(F.col("__t") / F.lit(interval_micros(split))).cast("bigint")))
    cold, hot = split_hot(u, ["__by"], ["__t", "__kind", "__s"], target_rows)
    out = finish(cold.selectExpr("*", *[last(v, "__by", "__l") for v in values]).where("__kind = 1"))
    return out if hot is None else out.unionByName(bucketed(hot))


# ---------------------------------------------------------------- the fold

# Beyond any reservation: pieces without a bound end here.
FAR = 1 << 62

FOLD_FIELDS = [T.StructField("validationResult", T.StringType()),
               T.StructField("reserved", T.LongType())]


def _segment_starts(keys: np.ndarray, segs: np.ndarray) -> np.ndarray:
    """True where a row starts a new (key, segment) run (rows are sorted by both)."""
    start = np.ones(len(keys), dtype=bool)
    if len(keys) > 1:
        start[1:] = (keys[1:] != keys[:-1]) | (segs[1:] != segs[:-1])
    return start


def _fold_partition(key: str, qty: str, stock: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # (key, segment) of the previous batch's last row
        reserved = 0
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            keys = pdf[key].to_numpy()
            segs = pdf["__seg"].to_numpy()
            starts = _segment_starts(keys, segs)
            if last is not None and (keys[0], segs[0]) == last:
                starts[0] = False  # the run continues across Arrow batches
            last = (keys[-1], segs[-1])
            new = starts.tolist()
            rin = pdf["__rin"].to_numpy(dtype=np.int64).tolist()
            q = pdf[qty].fillna(0).to_numpy(dtype=np.int64).tolist()
            st = pdf[stock].astype("float64").to_numpy()
            ok_stock = (~np.isnan(st)).tolist()
            s = np.nan_to_num(st).astype(np.int64).tolist()
            passed = [False] * n
            res = [0] * n
            for i in range(n):
                if new[i]:
                    reserved = rin[i]
                qi = q[i]
                if ok_stock[i] and s[i] - reserved - qi >= 0:
                    reserved += qi
                    passed[i] = True
                res[i] = reserved
            out = pdf.drop(columns=["__seg", "__rin", "__t"])
            out["validationResult"] = np.where(np.asarray(passed), "PASS", "FAIL")
            out["reserved"] = np.asarray(res, dtype=np.int64)
            yield out
    return run


def _segment_runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows as stretches of one (key, segment); a segment may come in several."""
    for pdf in batches:
        if not len(pdf):
            continue
        keys, segs = pdf[key].to_numpy(), pdf["__seg"].to_numpy()
        cuts = [*np.flatnonzero(_segment_starts(keys, segs)).tolist(), len(pdf)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield (keys[a], segs[a]), pdf.iloc[a:b]


def _outer_pieces(key: str, qty: str, stock: str):
    """Per (key, segment) the piece of low starts, from which all rows pass, and that of high ones, from which none does."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur, total, low, high, last = None, 0, FAR, -FAR, 0

        def done() -> pd.DataFrame:
            return pd.DataFrame({key: [cur[0]] * 2, "__seg": [cur[1]] * 2, "__lo": [-FAR, high], "__hi": [low, FAR],
                                 "__shift": [total, 0], "__last": [last] * 2})

        for seg, rows in _segment_runs(batches, key):
            if seg != cur:
                if cur is not None:
                    yield done()
                cur, total, low, high, last = seg, 0, FAR, -FAR, 0
            q = rows[qty].fillna(0).to_numpy(dtype=np.int64)
            st = rows[stock].astype("float64").to_numpy()
            known = ~np.isnan(st)
            s = st[known].astype(np.int64)
            after = total + np.cumsum(q)
            low = min(low, int((s - after[known]).min(initial=FAR)) if known.all() else -FAR)
            high = max(high, int((s - q[known]).max(initial=-FAR)) + 1)
            total, last = int(after[-1]), int(s[-1]) if len(s) else last
        if cur is not None:
            yield done()
    return run


def _piece_around(key: str, qty: str, stock: str):
    """Per (key, segment), folded from ``__rin``: the piece of starts with the same verdicts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur, start, r, up, down = None, 0, 0, FAR, FAR

        def done() -> pd.DataFrame:
            return pd.DataFrame({key: [cur[0]], "__seg": [cur[1]], "__lo": [start - down + 1], "__hi": [start + up],
                                 "__shift": [r - start], "__last": [0]})

        for seg, rows in _segment_runs(batches, key):
            if seg != cur:
                if cur is not None:
                    yield done()
                start = int(rows["__rin"].iloc[0])
                cur, r, up, down = seg, start, FAR, FAR
            st = rows[stock].astype("float64").to_numpy()
            known = ~np.isnan(st)
            q = rows[qty].fillna(0).to_numpy(dtype=np.int64)[known].tolist()
            for qi, si in zip(q, st[known].astype(np.int64).tolist()):
                left = si - r - qi
                if left >= 0:
                    r += qi
                    if left < up:
                        up = left
                elif -left < down:
                    down = -left
        if cur is not None:
            yield done()
    return run


def _chain(key: str):
    """Start of every segment, in order, from the pieces found so far; ``__open`` where the start lies on none.

    Behind an open segment the start is an estimate: the nearest piece's end.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, r = None, 0
        seg, pieces = None, []

        def entered() -> tuple[bool, int]:
            """Is ``r`` on a piece of the segment, and the reservation behind it."""
            for lo, hi, shift, _ in pieces:
                if lo <= r <= hi:
                    return False, r + shift
            inner = [p for p in pieces if p[0] > -FAR and p[1] < FAR]
            if inner:
                lo, hi, shift, _ = min(inner, key=lambda p: max(p[0] - r, r - p[1]))
                return True, min(max(r, lo), hi) + shift
            total, last = next((p[2], p[3]) for p in pieces if p[0] == -FAR)
            return True, r + total if total < 0 else max(r, min(r + total, last))

        for pdf in batches:
            out = []
            for x in zip(pdf[key].tolist(), *(pdf[c].tolist() for c in ("__seg", "__lo", "__hi", "__shift", "__last"))):
                if (x[0], x[1]) != seg:
                    if seg is not None:
                        is_open, after = entered()
                        out.append((*seg, r, is_open))
                        r = after if x[0] == k else 0
                    k, seg, pieces = x[0], (x[0], x[1]), []
                pieces.append(x[2:])
            yield pd.DataFrame(out, columns=[key, "__seg", "__rin", "__open"])
        if seg is not None:
            yield pd.DataFrame([(*seg, r, entered()[0])], columns=[key, "__seg", "__rin", "__open"])
    return run


def _segment_inputs(hard: DataFrame, key: str, qty: str, stock: str, seq: str) -> DataFrame:
    """key, ``__seg`` and the exact start ``__rin`` of every segment of the hot contended keys."""
    kind, order = hard.schema[key], [key, "__seg", "__t", seq]
    narrow = hard.select(key, "__seg", "__t", seq, qty, stock)
    longs = [T.StructField(c, T.LongType()) for c in ("__seg", "__lo", "__hi", "__shift", "__last")]
    piece = T.StructType([kind, *longs])
    start = T.StructType([kind, longs[0], T.StructField("__rin", T.LongType()), T.StructField("__open", T.BooleanType())])
    pieces = materialize(narrow.repartition(key, "__seg").sortWithinPartitions(*order)
                         .mapInPandas(_outer_pieces(key, qty, stock), piece), "fold-pieces")
    while True:
        starts = materialize(pieces.repartition(key).sortWithinPartitions(key, "__seg", "__lo")
                             .mapInPandas(_chain(key), start), "fold-starts")
        todo = starts.where("__open").drop("__open")
        if todo.isEmpty():
            return starts.drop("__open")
        again = narrow.join(replicated(todo), on=[key, "__seg"]).repartition(key, "__seg").sortWithinPartitions(*order)
        pieces = pieces.unionByName(materialize(again.mapInPandas(_piece_around(key, qty, stock), piece), "fold-pieces"))


def reserve_stock(rows: DataFrame, key: str = "product", ts: str = "ts", seq: str = "seq",
                  qty: str = "quantity", stock: str = "stock", hot_rows: int = 2_000_000,
                  split: str | None = None, materialize_input: bool = False) -> DataFrame:
    """Greedy reservation fold over ``rows`` (orders already joined with their stock).

    Returns ``rows`` plus ``validationResult`` (PASS/FAIL) and ``reserved``
    (the product's reservation after this order).  The input is read by the
    key statistics and by the fold; ``materialize_input`` writes it once to
    the shared folder first, for an input that needs shuffles to compute.
    The statistics of the hot keys (few) are written there, too; the paths
    for hot keys are planned only when there are any.
    """
    if materialize_input:
        rows = materialize(rows, "fold-input")
    st = F.col(stock)
    stats = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(qty).alias("__demand"), F.min(qty).alias("__qmin"),
        F.min(stock).alias("__smin"), F.count(st).alias("__known"))
    easy = hard = None
    if (stats.agg(F.max("__n")).first()[0] or 0) > hot_rows:
        hot = materialize(stats.where(F.col("__n") > hot_rows).select(
            key, ((F.col("__qmin") >= 0) & (F.col("__demand") <= F.col("__smin"))
                  & (F.col("__known") == F.col("__n"))).alias("__easy")), "fold-hot-keys")
        kinds = {r[0] for r in hot.select(F.coalesce("__easy", F.lit(False))).distinct().collect()}
        easy = hot.where("__easy").select(key) if True in kinds else None
        hard = hot.where("NOT coalesce(__easy, false)").select(key) if False in kinds else None
    timed = rows.withColumn("__t", micros(ts))
    folded, out = timed, []
    if easy is not None or hard is not None:
        folded = timed.join(replicated(hot.select(key)), on=key, how="left_anti")
    if easy is not None:
        running = sessionize(rows.join(replicated(easy), on=key, how="left_semi"), key, ts, [seq], None,
                             {"reserved": F.col(qty).cast("bigint")}, split=split, prefix="__sess_",
                             target_rows=hot_rows)
        out.append(running.drop("__sess_start").withColumn("validationResult", F.lit("PASS")))
    sort_cols = [key, "__seg", "__t", seq]
    folded = folded.withColumn("__seg", F.lit(0).cast("bigint")).withColumn("__rin", F.lit(0).cast("bigint"))
    if hard is not None:
        rest = timed.join(replicated(hard), on=key, how="left_semi")
        if split is not None:
            rest = rest.withColumn("__seg", F.floor(F.col("__t") / F.lit(interval_micros(split))).cast("bigint"))
        else:
            whole, cut = split_hot(rest, [key], ["__t", seq], hot_rows)
            whole = whole.withColumn("__seg", F.lit(0).cast("bigint"))
            rest = whole if cut is None else whole.unionByName(cut.withColumnRenamed("__b", "__seg"))
        rest = materialize(rest, "fold-segments")  # read by every round
        starts = _segment_inputs(rest, key, qty, stock, seq)
        folded = folded.unionByName(rest.join(starts, on=[key, "__seg"]))
    cols = [c for c in rows.columns]
    out_schema = T.StructType([rows.schema[c] for c in cols] + FOLD_FIELDS)
    folded = (folded.select(*cols, "__seg", "__rin", "__t").repartition(key, "__seg")
              .sortWithinPartitions(*sort_cols).mapInPandas(_fold_partition(key, qty, stock), out_schema))
    for part in out:
        folded = folded.unionByName(part.select(*folded.columns))
    return folded


def inventory_check(orders_with_stock: DataFrame, **kw) -> DataFrame:
    """Verdict rows of the inventory validator (+3 s, slot 2)."""
    f = reserve_stock(orders_with_stock, **kw)
    return f.select(
        F.col("id").alias("orderId"), F.lit("INVENTORY_CHECK").alias("checkType"),
        "validationResult", (F.col("ts") + F.expr("INTERVAL '3' SECOND")).alias("ts"),
        (F.col("seq") * 3 + 2).alias("seq"))
