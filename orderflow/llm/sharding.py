"""Sharding by sampled splitters.

Records are ordered by a key and cut into shards of nearly equal bytes.  A
sample is drawn in which a record's chance is proportional to its size, so
quantiles of the sampled keys are splitters between ranges of about equal
bytes.  A key that is several quantiles at once fills several ranges by itself: it
is cut at quantiles of the tie (the hash of the text) in as many, so splitters
are pairs of key and tie.  Records find their range by the splitters; ranges
that turn out over ``OVERFULL`` times the mean are subdivided by splitters of a
finer sample of their own.  With the byte total of every range known, each range knows the
byte at which it begins, and a running sum inside the range gives the exact
byte at which each record begins; shard = that byte's share of the total.  So
shard sizes differ by at most about one record, whatever the sample said --
the sample only spreads the work.

Law: ``bytes``.  The order is (key, hash of the text), so equal keys are ranked
by their text and identical rows may be ranked either way.  Which records are
sampled is decided by a hash of the record: reruns agree.

Everything is DataFrame operations; the splitters are one row of at most
``MOST_RANGES`` numbers, a range is some hundred records.

Defined cases: null text has size 1 (no bytes plus one); null keys come first
(with the smallest number, ranked by their text); repeated rows are records of
their own, and only records alike in key and text stay in one range; an empty table gives no rows; input columns named like an output column are
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.words import fresh
from orderflow.session import materialize

SHARDS, RANGE_ROWS, MOST_RANGES, PER_RANGE, OVERFULL, SEED = 8, 512, 16_384, 48, 2, 29


LEAST = -(1 << 63)


def splitters(sample: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """At most about ``ranges`` ascending pairs (key, tie): quantiles of the sampled keys, of the ties within heavy keys."""
    if ranges < 2:
        return []
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found = sample.agg(F.percentile_approx("key", at, 20 * ranges)).first()[0] or []
    times: dict[int, int] = {}
    for k in found:
        times[k] = times.get(k, 0) + 1
    out = {(k, LEAST) for k in times}
    heavy = {k: n for k, n in times.items() if n > 1}  # each holds over one range's share
    if heavy:
        most = max(heavy.values())
        at = F.array(*[F.lit(i / (most + 1)) for i in range(1, most + 1)])
        ties = (sample.where(F.col("key").isin(list(heavy))).groupBy("key")
                .agg(F.percentile_approx("tie", at, 20 * most).alias("t")).collect())
        for k, t in ties:
            out.update((k, t[i * most // heavy[k]]) for i in range(heavy[k]))
            if k < -LEAST - 1:
                out.add((k + 1, LEAST))
    return sorted(out)


def range_of(key: Column, tie: Column, bounds: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below (key, tie), found in two steps of about sqrt(n) comparisons."""
    if not bounds:
        return F.lit(0).cast("bigint")

    def pairs(rows: list[tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.lit(t).cast("bigint").alias("t")) for k, t in rows])

    def below(b: Column) -> Column:
        return (b["k"] < key) | ((b["k"] == key) & (b["t"] <= tie))

    step = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    n = F.size(F.filter(pairs([r[0] for r in rows]), below))
    inside = F.size(F.filter(F.element_at(F.array(*[pairs(r) for r in rows]), F.greatest(n, F.lit(1))), below))
    return F.when(n == 0, F.lit(0)).otherwise((n - 1) * step + inside).cast("bigint")


def chance(h: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def number_of_ranges(rows: int) -> int:
    return min(MOST_RANGES, max(1, -(-rows // RANGE_ROWS)))


def ranged(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with the columns ``range`` and ``part`` (its subdivision), and the total size."""
    rows = rows.withColumn("key", F.coalesce("key", F.lit(LEAST)))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = number_of_ranges(n)
    h = F.xxhash64(F.lit(SEED), "key", "tie")
    rate = PER_RANGE * ranges / max(1, total)
    bounds = splitters(rows.where(chance(h) < F.col("size") * rate).select("key", "tie"), ranges)
    out = rows.withColumn("range", range_of(F.col("key"), F.col("tie"), bounds))
    # subdivide what is overfull: splitters of its own, from a sample as much finer as it is too large
    mean = max(1, total // max(1, ranges))
    sums = out.groupBy("range").agg(F.sum("size").alias("bytes"))
    full = materialize(sums.where(F.col("bytes") > OVERFULL * mean), "shard-overfull")
    parts = F.least(F.ceil(F.col("bytes") / mean), F.lit(64))
    fine = (out.join(F.broadcast(full), "range").where(chance(h) < F.col("size") * rate * 4)
            .groupBy("range").agg(F.percentile_approx("key", F.array(*[F.lit(i / 64) for i in range(1, 64)]), 10_000)
                                  .alias("all"), F.max(parts).alias("parts")))
    # every (64 / parts)-th of the 64 quantiles
    inner = F.array_distinct(F.expr("transform(sequence(1, CAST(parts AS INT) - 1), "
                                    "i -> element_at(all, CAST(i * 64 DIV parts AS INT)))"))
    fine = fine.where("parts > 1").select("range", inner.alias("inner"))
    out = out.join(F.broadcast(fine), "range", "left")
    part = F.coalesce(F.size(F.filter("inner", lambda b: b <= F.col("key"))), F.lit(0))
    return out.withColumn("part", F.when(F.col("inner").isNull(), 0).otherwise(part).cast("bigint")).drop("inner"), total


def shard(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (key, tie, size and any further columns) with shard and slot."""
    placed, total = ranged(rows)
    w = "PARTITION BY range, part ORDER BY key, tie"
    run = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    inside = placed.selectExpr("*", f"SUM(size) OVER ({w}, size {run}) - size AS bytes_before",
                               f"row_number() OVER ({w}, size) - 1 AS rows_before")
    sums = placed.groupBy("range", "part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"))
    before = "OVER (ORDER BY range, part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sums = materialize(sums.selectExpr("range", "part", f"SUM(b) {before} - b AS bytes_at",
                                       f"SUM(r) {before} - r AS rows_at"), "shard-ranges")
    out = inside.join(F.broadcast(sums), ["range", "part"]).selectExpr(
        "*", "bytes_at + bytes_before AS at", "rows_at + rows_before AS nth")
    # a record belongs where its middle byte lies
    out = materialize(out.selectExpr("*", f"CAST(least({shards - 1}, (at + size DIV 2) * {shards} "
                                          f"DIV {max(1, total)}) AS INT) AS shard")
                      .drop("range", "part", "bytes_at", "bytes_before", "rows_at", "rows_before", "at"),
                      "shard-records")
    first = out.groupBy("shard").agg(F.min("nth").alias("first"))
    return out.join(F.broadcast(first), "shard").withColumn("slot", F.col("nth") - F.col("first")).drop("first", "nth")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = SHARDS) -> DataFrame:
    """The records of ``docs`` with size, text_crc32, law, shard, slot, grown_shard (null: the law is not ``key``)."""
    made = {"size", "text_crc32", "law", "shard", "slot", "grown_shard", id_col.lower()}
    own = {f"c{i}": c for i, c in enumerate(docs.columns) if c.lower() not in made}
    text = fresh(docs.columns, "text_")
    src = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in own.items()],
                      F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias(text))
    rows = src.select(*own, *_measures(text))
    return shard(rows, shards).select(
        F.col("doc_id").alias(id_col), *[F.col(k).alias(c) for k, c in own.items()], "size", "text_crc32",
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _measures(text: str) -> list[Column]:
    t = F.col(text)
    return [F.col("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
            F.col("doc_id").cast("bigint").alias("key"), F.xxhash64(t).alias("tie")]
