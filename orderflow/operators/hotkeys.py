"""Splitting of hot keys into ordered buckets.

A key is *hot* when it holds more than ``target_rows`` rows -- more than one
task should sort.  Whether there can be one is decided from the row count; hot
keys are then found in a Bernoulli sample that expects ``HITS`` rows of such a
key, and cut at sample quantiles of their full sort order (time and the
tie-breaking columns).  So a burst in one hour, or rows that all bear one
date, split as well as evenly spread ones.  The sample only sizes the
parallelism: every cut gives the same answer and no row is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET_ROWS = 4_000_000
HITS, SEED = 64, 17
# Hot keys sent to every task; there are at most 2 * rows / target_rows of them.
BROADCAST_KEYS = 100_000


def hot_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             target_rows: int = TARGET_ROWS) -> DataFrame | None:
    """keys and ``__cuts`` (ascending sort positions) of the hot keys; None when no key can be hot."""
    if df.count() <= target_rows:
        return None
    target_rows = max(1, target_rows)
    frac = min(1.0, HITS / float(target_rows))
    cols = df.select(*keys, F.struct(*order).alias("__pos"))
    sample = cols if frac >= 1.0 else cols.sample(withReplacement=False, fraction=frac, seed=SEED)
    hits = max(1, int(target_rows * frac))
    k = ", ".join(f"`{c}`" for c in keys)
    # every ``hits``-th sampled row of a key is a cut
    ranked = sample.selectExpr("*", f"row_number() OVER (PARTITION BY {k} ORDER BY __pos) AS __i",
                               f"count(*) OVER (PARTITION BY {k}) AS __n")
    cuts = ranked.where(f"__n > {hits // 2} AND __i % {hits} = 0")
    return cuts.groupBy(*keys).agg(F.array_sort(F.collect_list("__pos")).alias("__cuts"))


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              target_rows: int = TARGET_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with their bucket ``__b``)."""
    cuts = hot_cuts(df, keys, order, target_rows)
    if cuts is None:
        return df, None
    from orderflow.session import materialize
    cuts = materialize(cuts, "hot-keys")
    n = cuts.count()
    if n == 0:
        return df, None
    if n <= BROADCAST_KEYS:
        cuts = F.broadcast(cuts)
    cold = df.join(cuts, on=list(keys), how="left_anti")
    at = F.struct(*order)
    hot = df.join(cuts, on=list(keys), how="inner")
    hot = hot.withColumn("__b", F.size(F.filter("__cuts", lambda c: c <= at)).cast("bigint")).drop("__cuts")
    return cold, hot
