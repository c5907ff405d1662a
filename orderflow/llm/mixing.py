"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is laid out as one stream of words: its documents in an order
given by a hash, one behind the other.  The stream is cut into blocks of equal
size (never fewer than ``MIN_BLOCKS`` per source, words permitting).  Slot i
of the schedule holds the point frac(i * golden ratio), mapped through the
cumulative shares of the sources; within a source the slots are ranked, and
slot number r takes block r modulo the number of blocks.  So every prefix of
the schedule follows the weights, a source's blocks are taken evenly, and no
block is taken more than twice (a rank beyond that is left out).

Targets: sources in code-point order (null last) have the weights 3, 1, 2,
repeating, and share ``SHARE`` percent of all words; a target stops at
``PASSES`` times its source and the excess goes to the others by weight, until
none is above.  That fixed point is computed in one pass over the sources
ordered by size over weight.

Everything is DataFrame operations.  Prefix sums never put a source into one
task: documents are grouped by (source, hash range) of about ``BUCKET_ROWS``
rows (more where there would be over ``MOST_BUCKETS`` groups), the small table of group sums gives each group its start.  Slots and
sources meet by an equality on cells of the unit interval, not by a range
join.

Defined cases: null text has size 0; a document of size 0 is never taken;
repeated rows are documents of their own, a null source is a source and a null
id an id; an empty table, or one without words, gives rows that take nothing;
input columns beside id, text and source, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
SHARE, PASSES, SLOTS, MIN_BLOCKS, BUCKET_ROWS, MOST_BUCKETS, SEED = 150, 2, 1 << 17, 64, 256, 1 << 17, 17
WEIGHTS = (3, 1, 2)
_UNIT = 1 << 31
_GOLDEN = 1327217885  # nearest odd whole number to 2^31 / golden ratio
_CELL = 1 << 19


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          keep: dict[str, str] | None = None) -> DataFrame:
    """doc_id, source, size and the document's place in the shuffled order (a 31-bit number and a tie-break);
    ``keep``: further columns by their new name."""
    text = F.col(f"`{text_col}`").cast("string")
    h = F.xxhash64(F.lit(SEED), F.col(f"`{id_col}`"), F.xxhash64(text))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.shiftrightunsigned(h, 33).alias("place"), h.alias("tie"),
        *[F.col(f"`{c}`").alias(k) for k, c in (keep or {}).items()])


def targets(sources: DataFrame) -> DataFrame:
    """sid, source, source_size, docs, weight, target: one row per source."""
    w = "CASE (sid - 1) % 3 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(WEIGHTS)) + " END"
    s = sources.selectExpr("source", "source_size", "docs",
                           "row_number() OVER (ORDER BY source IS NULL, source) AS sid")
    s = s.selectExpr("*", f"CAST({w} AS BIGINT) AS weight")
    # lightest first: a source is at its stop when the level of those not yet stopped would lift it above
    order = f"ORDER BY {PASSES} * source_size / weight, sid"
    s = s.selectExpr(
        "*", f"coalesce(SUM({PASSES} * source_size) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
             " AS stopped",
        f"SUM(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight",
        "SUM(source_size) OVER () AS total")
    s = s.selectExpr("*", f"(total * {SHARE} / 100 - stopped) / open_weight AS level",
                     f"{PASSES} * source_size / weight AS own_level")
    # the level holds from the first source that it does not stop
    s = s.selectExpr("*", f"first_value(CASE WHEN level <= own_level THEN level END, true) OVER ({order} "
                     "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final")
    return s.selectExpr("sid", "source", "source_size", "docs", "weight",
                        f"CAST(CASE WHEN final IS NULL OR own_level <= final THEN {PASSES} * source_size "
                        "ELSE weight * final END AS DOUBLE) AS target")


def streams(rows: DataFrame, table: DataFrame, bucket_rows: int, extra: list[str] | None = None) -> DataFrame:
    """Each document (with the ``extra`` columns of ``rows``) with its source's number and the word ``at``
    which it begins in the source's stream."""
    extra = list(extra or [])
    ranges = F.ceil(F.col("docs") / bucket_rows)  # hash ranges of a source: equal groups, however large it is
    d = rows.join(table.select("sid", "docs", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")))
    d = d.select("sid", (F.col("place") * ranges / F.lit(_UNIT)).cast("bigint").alias("bucket"),
                 "tie", "doc_id", "size", *extra)
    sums = d.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.selectExpr("sid", "bucket", "SUM(n) OVER (PARTITION BY sid ORDER BY bucket) - n AS base")
    d = d.selectExpr("*", "SUM(size) OVER (PARTITION BY sid, bucket ORDER BY tie, doc_id, size "
                          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS inside",
                     "row_number() OVER (PARTITION BY sid, bucket ORDER BY tie, doc_id, size) AS nth")
    return d.join(sums, ["sid", "bucket"]).select(
        "sid", "bucket", "nth", "doc_id", "size", (F.col("base") + F.col("inside")).alias("at"), *extra)


def layout(table: DataFrame, slots: int) -> DataFrame:
    """targets plus the blocks of each source and its interval of the unit line (in 2^-31)."""
    t = table.selectExpr("*", "SUM(target) OVER () AS wanted")
    t = t.selectExpr("*", f"least(source_size, greatest({MIN_BLOCKS}, "
                          f"CAST(ceil(source_size * {slots} / greatest(wanted, 1)) AS BIGINT))) AS blocks")
    # slots a source should get: its target in units of its own block size
    t = t.selectExpr("*", "CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS due")
    t = t.selectExpr("*", "SUM(due) OVER () AS all_due",
                     "SUM(due) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto")
    # without any words there is no interval, and no slot
    return t.selectExpr("*", f"coalesce(CAST(round(try_divide(upto - due, all_due) * {_UNIT}) AS BIGINT), 0) AS low",
                        f"coalesce(CAST(round(try_divide(upto, all_due) * {_UNIT}) AS BIGINT), 0) AS high")


def schedule(lay: DataFrame, slots: int) -> DataFrame:
    """slot, sid, pass, block: which block each slot takes."""
    spark = lay.sparkSession
    point = ((F.col("slot") % _UNIT) * _GOLDEN) % _UNIT
    s = spark.range(slots).select(F.col("id").alias("slot"), point.alias("x"))
    s = s.withColumn("cell", (F.col("x") / _CELL).cast("bigint"))
    parts = lay.where("high > low").select(
        "sid", "low", "high", "blocks",
        F.explode(F.expr(f"sequence(low DIV {_CELL}, (high - 1) DIV {_CELL})")).alias("cell"))
    s = s.join(parts, "cell").where("x >= low AND x < high")
    # rank the slots of a source: within runs of slots, plus the slots in the runs before
    s = s.withColumn("run", (F.col("slot") / 4096).cast("bigint"))
    s = s.selectExpr("*", "row_number() OVER (PARTITION BY sid, run ORDER BY slot) AS inside")
    runs = s.groupBy("sid", "run").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.selectExpr("sid", "run", "SUM(n) OVER (PARTITION BY sid ORDER BY run) - n AS base")
    s = s.join(runs, ["sid", "run"]).withColumn("rank", F.col("base") + F.col("inside") - 1)
    return s.where(f"rank < {PASSES} * blocks").select(
        "slot", "sid", F.expr("rank DIV blocks").alias("pass"), F.expr("rank % blocks").alias("block"))


def segments(stream: DataFrame, lay: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: the words of the document in that block.

    Block j holds the words [j * size DIV blocks, (j + 1) * size DIV blocks) of its source.
    """
    d = stream.join(lay.select("sid", "source_size", "blocks"), "sid").where("size > 0")
    d = d.withColumn("block", F.explode(F.expr(
        "sequence(((at + 1) * blocks - 1) DIV source_size, ((at + size) * blocks - 1) DIV source_size)")))
    return d.selectExpr(
        "sid", "bucket", "nth", "block",
        "greatest(block * source_size DIV blocks, at) - at AS first_word",
        "least((block + 1) * source_size DIV blocks, at + size) - at AS last_word")


class Mix:
    """The tables of one mix: rows, table (targets), stream, lay, plan (schedule)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 slots: int = SLOTS):
        self.rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
        sources = self.rows.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
        self.table = materialize(targets(sources), "mix-targets")
        n = self.rows.count()
        self.bucket_rows = max(BUCKET_ROWS, -(-n // MOST_BUCKETS))
        self.lay = materialize(layout(self.table, slots), "mix-layout")
        self.stream = materialize(streams(self.rows, self.table, self.bucket_rows), "mix-streams")
        total = self.lay.agg(F.max("all_due")).first()[0]
        self.plan = materialize(schedule(self.lay, int(round(total or 0))), "mix-schedule")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken."""
        times = self.plan.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
        words = (segments(self.stream, self.lay).join(times, ["sid", "block"])
                 .groupBy("sid", "bucket", "nth")
                 .agg(F.sum(F.col("times") * (F.col("last_word") - F.col("first_word"))).alias("taken")))
        return (self.stream.join(words, ["sid", "bucket", "nth"], "left")
                .join(self.table.select("sid", "source_size", "target"), "sid")
                .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    return Mix(docs, **options).taken()


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    chars_col: str = "n_chars", **options) -> DataFrame:
    """The documents the mix takes, with the columns of ``docs``: one row per document and pass.

    A pass over a source takes its blocks in order, so it covers the stream
    from the first word to a cut; the document at the cut is shortened to its
    characters up to the last word taken, all before it are whole.
    """
    mix = Mix(docs, id_col, text_col, source_col, **options)
    cut = (mix.plan.groupBy("sid", "pass").agg(F.max("block").alias("last"))
           .join(mix.lay.select("sid", "source_size", "blocks"), "sid")
           .select("sid", F.expr("(last + 1) * source_size DIV blocks").alias("cut")))
    own = {f"c{i}": c for i, c in enumerate(docs.columns)}
    rows = streams(sized(docs, id_col, text_col, source_col, own), mix.table, mix.bucket_rows, list(own))
    out = rows.join(cut, "sid").where("size > 0 AND at < cut")
    text = next(k for k, c in own.items() if c.lower() == text_col.lower())
    words = F.regexp_extract_all(F.col(text).cast("string"), F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    short = F.array_join(F.slice(words, F.lit(1), (F.col("cut") - F.col("at")).cast("int")), "")
    whole = F.col("at") + F.col("size") <= F.col("cut")
    out = out.withColumn(text, F.when(whole, F.col(text)).otherwise(short))
    for k, c in own.items():
        if c.lower() == chars_col.lower():
            kind = docs.schema[c].dataType
            out = out.withColumn(k, F.when(whole, F.col(k)).otherwise(F.char_length(text).cast(kind)))
    return out.select(*[F.col(k).alias(c) for k, c in own.items()])
