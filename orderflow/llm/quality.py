"""Quality rules whose thresholds adapt to each language and source.

Per document the text is counted once (words, code points in words, symbols,
repeated lines, words in repeated three-word windows).  Four whole-number
metrics are taken from the counts:

    symbols       1000 * symbols / words
    repetition    1000 * words in repeated windows / words
    lines         1000 * repeated lines / words
    word_length    100 * code points in words / words

Instead of fixed cutoffs, every (lang, source) group sets its own.  The
distribution of a metric in a group is kept as a quantile sketch: counts of
values rounded down to six significant bits, so a quantile is right within
1/32 of its value.  Such sketches merge by adding counts, which is how the
sketch of a language (all its sources) and of the whole table come from the
groups' sketches without reading the documents again.  A group with fewer
than ``min_rows`` documents uses its language's sketch, a language with
fewer uses the whole table's.

A document is rejected when a metric lies beyond its group's fence:
``q75 + reach * max(q75 - q25, spread)`` above, for word_length also
``q25 - reach * max(q75 - q25, spread)`` below.  ``spread`` keeps groups in
which a metric hardly varies from rejecting harmless differences.  The fence
follows the quartiles, so a group that is uniform and clean loses nothing.
Documents that fail the base rule (fewer than 50 words, or over half of the
words in repeated windows) are rejected and do not enter the sketches.

Defined cases: null text counts as empty; null lang or source is a group of
its own; repeated rows are judged each; a text of any length is counted whole;
an empty table gives no rows; columns of the input that bear the name of an
output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm import words as wd
from orderflow.session import materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
MIN_ROWS, REACH = 200, 6
# metric -> (numerator column, factor, least spread, also a lower fence)
METRICS = {
    "symbols": ("n_symbols", 1000, 10, False),
    "repetition": ("n_repeat_words", 1000, 75, False),
    "lines": ("n_dup_lines", 1000, 8, False),
    "word_length": ("word_chars", 100, 40, True),
}
# Groups whose fences are sent to every task; more groups are joined by a shuffle.
BROADCAST_GROUPS = 50_000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _ids(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].reshape(-1)


def block_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every row of a block."""
    n = len(offs) - 1
    row, starts, ends, space = wd.words(data, offs)
    lens = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=lens[1:])
    codes, distinct = wd.encode(wd.as_binary(data[~space], lens))
    out = {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": wd.per_row(~space & ((data & 0xC0) != 0x80), offs),
        "n_symbols": wd.per_row(_SYMBOL[data], offs),
    }
    # lines: bytes between newlines (and row ends); those with a word count
    newline = data == 10
    cuts = np.union1d(offs, np.flatnonzero(newline) + 1)
    line_row = np.searchsorted(offs[1:], cuts[:-1], side="right")
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~newline, out=total[1:])
    line, distinct_lines = wd.encode(wd.as_binary(data[~newline], total[cuts]))
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    marks[starts + 1] = 1
    np.cumsum(marks, out=marks)
    has = marks[cuts[1:]] > marks[cuts[:-1]]
    key = line_row[has] * (len(distinct_lines) + 1) + line[has]
    first = np.unique(key) // (len(distinct_lines) + 1)
    out["n_dup_lines"] = np.bincount(line_row[has], minlength=n) - np.bincount(first, minlength=n)
    # three-word windows: exact ids by ranking pairs, then triples, then (row, triple)
    repeated = np.zeros(len(codes), dtype=bool)
    if len(codes) > 2:
        v = len(distinct) + 1
        at = np.flatnonzero(row[:-2] == row[2:])
        pair = _ids(codes[:-1] * v + codes[1:])
        triple = _ids(pair[at] * v + codes[at + 2])
        _, inv, cnt = np.unique(triple * n + row[at], return_inverse=True, return_counts=True)
        hit = at[cnt[inv.reshape(-1)] > 1]
        for k in range(3):
            repeated[hit + k] = True
    out["n_repeat_words"] = np.bincount(row[repeated], minlength=n)
    return out


def counted(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) of every row and its counts."""
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in COUNTS]
    src = docs.select(*[F.col(f"`{c}`") for c in names],
                      F.col(f"`{text_col}`").cast("string").alias(wd.fresh(names, "text")))
    text = src.columns[-1]
    schema = T.StructType([*src.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, text):
            counts = block_counts(data, offs)
            yield pa.RecordBatch.from_arrays(
                [*rb.columns[:-1], *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]],
                names=[*names, *COUNTS])

    return src.mapInArrow(run, schema)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def metric(name: str) -> Column:
    """The metric's whole number (0 for a document without words)."""
    num, factor, _, _ = METRICS[name]
    return F.expr(f"CASE WHEN n_words > 0 THEN {num} * {factor} DIV n_words ELSE 0 END")


def rounded(v: Column) -> Column:
    """Down to six significant bits."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, metric, bin, n over the documents that pass the base rule."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), metric(m).alias("v")) for m in METRICS])
    return (counts.where(~base_failed()).select("lang", "source", F.explode(values).alias("m"))
            .groupBy("lang", "source", F.col("m.metric").alias("metric"), rounded(F.col("m.v")).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, metric, total, q25, q75 of sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    by = ", ".join([*keys, "metric"])
    ranked = merged.selectExpr("*", f"SUM(n) OVER (PARTITION BY {by} ORDER BY bin) AS below",
                               f"SUM(n) OVER (PARTITION BY {by}) AS total")
    return ranked.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"),
        F.expr("min(CASE WHEN 4 * below >= total THEN bin END) AS q25"),
        F.expr("min(CASE WHEN 4 * below >= 3 * total THEN bin END) AS q75"))


def fences(sketch: DataFrame, groups: DataFrame, min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """One row per (lang, source) of ``groups`` with the fences of every metric."""
    names = F.array(*[F.lit(m) for m in METRICS])
    own = quartiles(sketch, ["lang", "source"])
    lang = quartiles(sketch, ["lang"])
    every = quartiles(sketch, [])
    g, o, p, q = (groups.select("lang", "source", F.explode(names).alias("metric")).alias("g"),
                  own.alias("o"), lang.alias("p"), every.alias("q"))
    out = (g.join(o, F.expr("g.lang <=> o.lang AND g.source <=> o.source AND g.metric = o.metric"), "left")
           .join(p, F.expr("g.lang <=> p.lang AND g.metric = p.metric"), "left")
           .join(q, F.expr("g.metric = q.metric"), "left"))
    low, high = [F.expr(f"CASE WHEN o.total >= {min_rows} THEN o.{x} WHEN p.total >= {min_rows} THEN p.{x} "
                        f"ELSE q.{x} END") for x in ("q25", "q75")]
    spread = F.create_map(*[F.lit(x) for m, (_, _, s, _) in METRICS.items() for x in (m, s)])
    width = F.greatest(high - low, spread[F.col("g.metric")]) * reach
    out = out.select("g.lang", "g.source", "g.metric", (low - width).alias("low"), (high + width).alias("high"))
    return out.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("high"))).alias(f"high_{m}") for m in METRICS],
        *[F.max(F.when(F.col("metric") == m, F.col("low"))).alias(f"low_{m}")
          for m, x in METRICS.items() if x[3]])


def judged(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text",
           min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """``keep`` columns, the counts, base_failed and kept.

    The counted rows are written once to the shared folder: the sketches read
    three columns of that table, the verdict joins the fences to it.  The
    fences are one row per (lang, source); they are broadcast when their
    counted number is below ``BROADCAST_GROUPS``.
    """
    names = docs.columns if keep is None else keep
    lang, source = wd.fresh(names, "lang_"), wd.fresh(names, "source_")
    given = {c.lower() for c in docs.columns}
    src = docs.withColumn(lang, F.col("lang").cast("string") if "lang" in given else F.lit(None).cast("string"))
    src = src.withColumn(source, F.col("source").cast("string") if "source" in given else F.lit(None).cast("string"))
    counts = materialize(counted(src, text_col, [*names, lang, source]), "quality-counts")
    stats = counts.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *COUNTS)
    sketch = materialize(sketches(stats), "quality-sketches")
    limits = materialize(fences(sketch, stats.select("lang", "source").distinct(), min_rows, reach), "quality-fences")
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    c, f = counts.alias("c"), limits.alias("f")
    # without any document that passes the base rule there is no fence: only the base rule speaks
    within = [f"coalesce({m_sql(m)} <= f.high_{m}, true)" for m in METRICS]
    within += [f"coalesce({m_sql(m)} >= f.low_{m}, true)" for m, x in METRICS.items() if x[3]]
    out = c.join(f, F.expr(f"c.`{lang}` <=> f.lang AND c.`{source}` <=> f.source"), "left")
    failed = "(c.n_words < 50 OR 100 * c.n_repeat_words > 50 * c.n_words)"
    kept = [x for x in counts.columns if x not in (lang, source) and x.lower() not in ("base_failed", "kept")]
    return out.select(*[F.col(f"c.`{x}`") for x in kept],
                      F.expr(failed).alias("base_failed"),
                      F.expr(f"NOT {failed} AND {' AND '.join(within)}").alias("kept"))


def m_sql(name: str) -> str:
    num, factor, _, _ = METRICS[name]
    return f"(CASE WHEN c.n_words > 0 THEN c.{num} * {factor} DIV c.n_words ELSE 0 END)"


def quality_filter(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    inner = {f"c{i}": c for i, c in enumerate(docs.columns)}
    src = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in inner.items()],
                      *[F.col(f"`{c}`").cast("string").alias(x) for x in ("lang", "source")
                        for c in docs.columns if c.lower() == x])
    text = next(k for k, c in inner.items() if c.lower() == text_col.lower())
    out = judged(src, list(inner), text, **options).where("kept")
    return out.select(*[F.col(k).alias(c) for k, c in inner.items()])
