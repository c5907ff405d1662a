"""Cheapest repair of conversations, decided by one integer minimum.

A conversation's rows, in the order of their turns (null turns first; equal
turns by role, hash of the text and copy), are edited until their role initials read
``(s?(ua)+)?``: an optional system row, then user and assistant in pairs, or
nothing at all.  Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert
of an empty user or assistant row 5; a truncated row that stays costs 5 more;
blank rows and duplicates must be deleted.  Of the cheapest edit sequences the
one whose initials (D < I < K < R) are the least text is taken.

The weight of an edit sequence is one whole number: its cost in the high
digits, below it one octal digit per edit at a fixed place, the first edit
highest, the places behind the last edit zero.  Comparing weights therefore
compares costs and then audits (a shorter audit before any that continues it),
and an edit has the scalar weight ``cost << width | letter << place``, so an
ordinary shortest path over (rows done, inserts done, state of the pattern)
decides everything.

No cheapest repair inserts: without an inserted row and the other row of its
pair the rest still reads as the pattern (a system row that is left alone goes,
too), and those at most two deletions cost 4 where the insert costs 5.  So
every row has one letter and the place of a letter is the place of its row;
the search takes the number of inserts as a parameter and tests compare both.

Long conversations are cut: rows are range-partitioned in conversation order
and cut into segments of ``SEGMENT`` rows.  A segment's summary holds, for
each pair of pattern states, the cheapest cost between them and the rank of
its audit among the segment's 16.  Two neighbouring summaries combine into
one of the same form (cost, then first rank, then second), so ``FAN``
summaries at a time reduce to one per conversation, and the chosen states go
back down the same tree to every segment, which writes out its letters.  No
task holds more than ``SEGMENT`` rows of texts-free codes or ``FAN``
summaries.

The digest of a repaired conversation is a running hash: its rows, sorted,
stream through one task that keeps only the state of the hash and the audit.

Defined cases: a null in ``conv_id``, ``role``, ``text`` (and in the key of the
damage, in ``turn``) reads as one space; a row whose role is empty cannot be
kept; null ids are one conversation; rows alike in all four columns are rows of their own; a table without rows gives
none; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.session import materialize

RANGE_ROWS, SEGMENT, FAN = 200_000, 512, 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# digits of the audit letters, in the order of their character codes; 0 pads the end
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = " DIKR"
# states of the pattern: nothing yet, after the system row, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FINAL = (START, ASSISTANT)
# code of a row: initial, must it go, is it truncated
_CODES = "sua-"
GO, CUT = 4, 8
_BLANK = r"\A[\x20\x09-\x0D]*\z"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copy of the rows left by the damage that crc32(``conv_id:turn``) % 20 picks."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    d = conversations.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        spaced(role_col).alias("role"), spaced(text_col).alias("text"),
        (F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                       F.explode(copies).alias("copy"))


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, tie, salt, code (initial and faults), fault (1 blank, 2 duplicate, 3 truncated).

    A duplicate is a row whose role and text stand at an earlier place; the
    earliest place of a (conversation, role, text) is a minimum, aggregated
    before its shuffle, so copies of one row never meet in a task.  ``rows``
    is a written table: its ``salt`` orders rows alike in every column, so that
    they are told apart and can lie in several range partitions.
    """
    place = F.struct(F.col("turn").isNotNull().alias("p"), F.coalesce("turn", F.lit(0)).alias("t"), "tie", "copy", "salt")
    d = rows.withColumn("place", place)
    first = (d.groupBy("conv_id", "tie").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("tie").alias("again"), "first"))
    j = d.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("tie") == F.col("again")), "left")
    fault = (F.when(F.col("text").rlike(_BLANK), 1).when(F.col("place") > F.col("first"), 2)
             .when(~F.col("text").rlike(_ENDED), 3).otherwise(0))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    j = j.withColumn("fault", fault)
    mark = F.when(F.col("fault").isin(1, 2), GO).when(F.col("fault") == 3, CUT).otherwise(0)
    return j.select("conv_id", "turn", "role", "text", "copy", "tie", "salt", (code + mark).alias("code"), "fault")


def ordered(rows: DataFrame, n: int) -> DataFrame:
    """conv_id, part, seq, at, turn, role, text, code, fault: the ``n`` rows in their place.

    ``part`` is the range partition, ``seq`` the segment of the conversation in
    it and ``at`` the place in the segment.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, at = TaskContext.get().partitionId(), (), 0
        for rb in batches:
            place = np.empty(rb.num_rows, dtype=np.int64)
            for i, c in enumerate(rb.column(0).to_pylist()):
                conv, at = ((c,), 0) if (c,) != conv else (conv, at + 1)
                place[i] = at
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(np.full(rb.num_rows, part, np.int32)), pa.array(place // SEGMENT),
                 pa.array((place % SEGMENT).astype(np.int32)), *rb.columns[1:]],
                names=["conv_id", "part", "seq", "at", *rb.schema.names[1:]])

    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "tie", "copy", "salt"]
    placed = rows.repartitionByRange(max(1, -(-n // RANGE_ROWS)), *keys).sortWithinPartitions(*keys)
    return placed.select("conv_id", "turn", "role", "text", "code", "fault").mapInArrow(
        run, "conv_id long, part int, seq long, at int, turn long, role string, text string, code int, fault int")


def paths(codes: bytes, start: int, inserts: int = 0) -> dict[int, int]:
    """State at the end -> least weight of the edits from ``start`` over the rows; its low
    ``3 * (rows + inserts)`` bits are the audit."""
    width = len(codes) + inserts
    shift = 3 * width

    def weight(cost: int, letter: str, place: int) -> int:
        return cost << shift | DIGIT[letter] << 3 * (width - 1 - place)

    done: dict[int, int] = {}
    layer = {(0, start): 0}                      # (inserts so far, state) -> least weight
    for i in range(len(codes) + 1):
        for k in range(inserts):                 # an insert leads to the next place of the same row
            for state in range(4):
                if (k, state) in layer:
                    for role in "ua":
                        if state in NEXT[role]:
                            to = (k + 1, NEXT[role][state])
                            w = layer[k, state] + weight(INSERT, "I", i + k)
                            if to not in layer or w < layer[to]:
                                layer[to] = w
        if i == len(codes):
            break
        code, after = codes[i], {}
        initial, stays = _CODES[code & 3], not code & GO
        extra = TRUNCATED if code & CUT else 0
        for (k, state), w in layer.items():
            steps = [(state, DELETE, "D")]
            if stays:
                if state in NEXT.get(initial, {}):
                    steps.append((NEXT[initial][state], KEEP + extra, "K"))
                steps += [(NEXT[role][state], REROLE + extra, "R") for role in "ua" if state in NEXT[role]]
            for to, cost, letter in steps:
                v = w + weight(cost, letter, i + k)
                if (k, to) not in after or v < after[k, to]:
                    after[k, to] = v
        layer = after
    for (_, state), w in layer.items():
        if state not in done or w < done[state]:
            done[state] = w
    return done


def audit_of(weight: int, width: int) -> tuple[int, str]:
    """The cost and the audit that a weight of ``width`` letters stands for."""
    digits = oct((weight & (1 << 3 * width) - 1) | 1 << 3 * width)[3:]
    return weight >> 3 * width, "".join(LETTER[int(d)] for d in digits).rstrip()


# A summary: 16 costs (-1: no way) and 16 ranks, by state before * 4 + state after.

def ranked(entries: dict[tuple[int, int], tuple[int, object]]) -> tuple[list[int], list[int]]:
    place = {a: i for i, a in enumerate(sorted({a for _, a in entries.values()}))}
    cost, rank = [-1] * 16, [0] * 16
    for (p, q), (c, a) in entries.items():
        cost[4 * p + q], rank[4 * p + q] = c, place[a]
    return cost, rank


def segment_summary(codes: bytes) -> tuple[list[int], list[int]]:
    shift = 3 * len(codes)
    return ranked({(p, q): (w >> shift, w & (1 << shift) - 1)
                   for p in range(4) for q, w in paths(codes, p).items()})


def combined(summaries: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """The summary of neighbouring stretches."""
    out = summaries[0]
    for cost2, rank2 in summaries[1:]:
        cost1, rank1 = out
        entries: dict[tuple[int, int], tuple[int, object]] = {}
        for p in range(4):
            for q in range(4):
                ways = [(cost1[4 * p + m] + cost2[4 * m + q], (rank1[4 * p + m], rank2[4 * m + q]))
                        for m in range(4) if cost1[4 * p + m] >= 0 and cost2[4 * m + q] >= 0]
                if ways:
                    entries[p, q] = min(ways)
        out = ranked(entries)
    return out


def states_between(summaries: list[tuple[list[int], list[int]]], start: int, end: int) -> list[int]:
    """The states before every stretch (and behind the last) of the best way from ``start`` to ``end``."""
    # from the back: (cost, rank of the audit of the rest) for every state
    rest: dict[int, tuple[int, int]] = {end: (0, 0)}
    choice: list[dict[int, int]] = []
    for cost, rank in reversed(summaries):
        best = {}
        for p in range(4):
            ways = [(cost[4 * p + q] + rest[q][0], rank[4 * p + q], rest[q][1], q)
                    for q in rest if cost[4 * p + q] >= 0]
            if ways:
                best[p] = min(ways)
        order = {a: i for i, a in enumerate(sorted({(w[1], w[2]) for w in best.values()}))}
        rest = {p: (w[0], order[w[1], w[2]]) for p, w in best.items()}
        choice.append({p: w[3] for p, w in best.items()})
    out = [start]
    for c in reversed(choice):
        out.append(c[out[-1]])
    return out


_SUMMARY = "conv_id long, idx long, cost array<long>, rank array<int>"
_WAY = "conv_id long, idx long, before int, after int"


def segments(rows: DataFrame) -> DataFrame:
    """conv_id, idx, total, part, seq, codes: the segments of every conversation, numbered in order."""
    made = rows.groupBy("conv_id", "part", "seq").agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("c"))
    made = materialize(made.selectExpr("conv_id", "part", "seq", "transform(c, x -> x.code) AS codes"), "talk-codes")
    # segments before each partition's first of a conversation: one row per conversation and partition
    runs = made.groupBy("conv_id", "part").agg((F.max("seq") + 1).alias("n"))
    w = "PARTITION BY conv_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    runs = runs.selectExpr("conv_id AS c", "part AS p", f"sum(n) OVER ({w}) - n AS base",
                           "sum(n) OVER (PARTITION BY conv_id) AS total")
    return made.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(
        "conv_id", (F.col("base") + F.col("seq")).alias("idx"), "total", "part", "seq", "codes")


def summaries(segs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            cost, rank = [], []
            for x in rb.column(2).to_pylist():
                c, r = segment_summary(bytes(x))
                cost.append(c)
                rank.append(r)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(cost, pa.list_(pa.int64())), pa.array(rank, pa.list_(pa.int32()))],
                names=["conv_id", "idx", "cost", "rank"])

    return segs.select("conv_id", "idx", "codes").mapInArrow(run, _SUMMARY)


def _pairs(t: pa.Table) -> list[tuple[list[int], list[int]]]:
    return list(zip(t.column("cost").to_pylist(), t.column("rank").to_pylist()))


def climb(level: DataFrame) -> DataFrame:
    """Every ``FAN`` neighbouring summaries as one."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        c, r = combined(_pairs(t))
        return pa.table({"conv_id": t.column("conv_id").slice(0, 1), "idx": pa.array([t.column("idx")[0].as_py() // FAN]),
                         "cost": pa.array([c], pa.list_(pa.int64())), "rank": pa.array([r], pa.list_(pa.int32()))})

    return level.groupBy("conv_id", F.expr(f"idx DIV {FAN}").alias("up")).applyInArrow(run, _SUMMARY)


def descend(level: DataFrame, above: DataFrame) -> DataFrame:
    """The states before and after every stretch, from those of the stretch above it."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("idx")
        way = states_between(_pairs(t), t.column("from")[0].as_py(), t.column("to")[0].as_py())
        return pa.table({"conv_id": t.column("conv_id"), "idx": t.column("idx"),
                         "before": pa.array(way[:-1], pa.int32()), "after": pa.array(way[1:], pa.int32())})

    a = above.select(F.col("conv_id").alias("c"), F.col("idx").alias("up"), F.col("before").alias("from"),
                     F.col("after").alias("to"))
    j = level.join(a, F.col("conv_id").eqNullSafe(F.col("c")) & (F.expr(f"idx DIV {FAN}") == F.col("up")))
    return j.groupBy("conv_id", "up").applyInArrow(run, _WAY)


def ways(segs: DataFrame) -> DataFrame:
    """conv_id, idx, before, after: the states around every segment on the conversation's best way."""
    def decided(tops: DataFrame) -> DataFrame:
        # one summary per conversation: the cheaper of the final states, then the lower audit
        ends = [F.struct(F.col("cost")[q].alias("c"), F.col("rank")[q].alias("r"), F.lit(q).alias("q")) for q in FINAL]
        best = F.least(*[F.when(e["c"] >= 0, e) for e in ends])
        return tops.select("conv_id", "idx", F.lit(START).alias("before"), best["q"].alias("after"))

    alone = decided(summaries(segs.where("total = 1")))
    long = segs.where("total > 1")
    most = long.agg(F.max("total")).first()[0]
    if most is None:
        return alone
    levels = [materialize(summaries(long), "talk-summaries")]
    while most > 1:
        levels.append(materialize(climb(levels[-1]), "talk-summaries"))
        most = -(-most // FAN)
    out = decided(levels[-1])
    for level in reversed(levels[:-1]):
        out = materialize(descend(level, out), "talk-ways")
    return alone.unionByName(out)


def letters(segs: DataFrame, way: DataFrame) -> DataFrame:
    """conv_id, part, seq, cost, audit of every segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            cost, audit = [], []
            for codes, p, q in zip(*(rb.column(i).to_pylist() for i in (3, 4, 5))):
                c, a = audit_of(paths(bytes(codes), p)[q], len(codes))
                cost.append(c)
                audit.append(a)
            yield pa.RecordBatch.from_arrays([*rb.columns[:3], pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                             names=["conv_id", "part", "seq", "cost", "audit"])

    w = way.select(F.col("conv_id").alias("c"), F.col("idx").alias("i"), "before", "after")
    j = segs.join(w, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("idx") == F.col("i")))
    return j.select("conv_id", "part", "seq", "codes", "before", "after").mapInArrow(
        run, "conv_id long, part int, seq long, cost long, audit string")


class Talk:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv: int | None):
        self.conv, self.cost, self.audit = conv, 0, []
        self.turns, self.least, self.last = 0, None, None
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.hash, self.rows, self.state, self.ops = hashlib.sha256(), 0, START, ""

    def segment(self, cost: int, audit: str) -> None:
        self.cost += cost
        self.audit.append(audit)
        self.ops = audit

    def row(self, at: int, turn: int | None, role: str, text: str, fault: int) -> tuple[str, str] | None:
        """Takes the next row; returns its letter and, if it stays, its role."""
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        op = self.ops[at]
        if op == "D":
            return None
        if op == "R":
            role = "assistant" if self.state == USER else "user"
        self.state = NEXT[role[0]][self.state]
        self.hash.update(("\n" if self.rows else "").encode() + f"{role}:{text}".encode())
        self.rows += 1
        return op, role

    def result(self) -> tuple:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_REPAIRED = "conv_id long, nth long, turn long, role string, text string, edit string"


def stream(conversations: DataFrame, rows: DataFrame, told: DataFrame, conv_col: str, repaired: bool) -> DataFrame:
    """Conversations' rows in order through :class:`Talk`: each segment's letters, then its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: Talk | None = None
        for rb in batches:
            out: list[tuple] = []
            for conv, part, seq, at, turn, role, text, fault, cost, audit in zip(*(c.to_pylist() for c in rb.columns)):
                if talk is None or talk.conv != conv:
                    if talk is not None and not repaired:
                        out.append(talk.result())
                    talk = Talk(conv)
                if part < 0:
                    continue                      # the mark that every conversation has
                if at < 0:
                    talk.segment(cost, audit)
                    continue
                stays = talk.row(at, turn, role, text, fault)
                if repaired and stays:
                    out.append((conv, talk.rows - 1, turn, stays[1], text, stays[0]))
            if out:
                yield _batch(out)
        if talk is not None and not repaired:
            yield _batch([talk.result()])

    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in (_REPAIRED if repaired else _RESULT).split(", ")]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*out), fields)],
                                          names=[n for n, _ in fields])

    every = conversations.select(F.col(f"`{conv_col}`").cast("bigint").alias("conv_id")).distinct()
    cols = ["conv_id", "part", "seq", "at", "turn", "role", "text", "fault", "cost", "audit"]
    marks = every.selectExpr("conv_id", "-1 AS part", "0L AS seq", "-1 AS at", "CAST(NULL AS BIGINT) AS turn",
                             "'' AS role", "'' AS text", "0 AS fault", "0L AS cost", "'' AS audit")
    heads = told.selectExpr("conv_id", "part", "seq", "-1 AS at", "CAST(NULL AS BIGINT) AS turn",
                            "'' AS role", "'' AS text", "0 AS fault", "cost", "audit")
    body = rows.selectExpr("conv_id", "part", "seq", "at", "turn", "role", "text", "fault", "0L AS cost", "'' AS audit")
    flow = marks.unionByName(heads).unionByName(body).select(*cols)
    return flow.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq", "at").mapInArrow(
        run, _REPAIRED if repaired else _RESULT)


def repair(conversations: DataFrame, damage: bool = True, repaired: bool = False, conv_col: str = "conv_id",
           turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, audit and the repaired hash.

    ``damage``: judge the rows that the damage leaves (else the rows as they are).
    ``repaired``: the rows of the repaired conversations instead (conv_id, nth, turn, role, text, edit).
    """
    if damage:
        rows = damaged(conversations, conv_col, turn_col, role_col, text_col)
    else:
        rows = conversations.select(
            F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
            *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(k)
              for c, k in ((role_col, "role"), (text_col, "text"))], F.lit(0).alias("copy"))
    rows = rows.withColumn("tie", F.concat_ws("\x01", "role", F.sha2("text", 256)))
    rows = materialize(rows.withColumn("salt", F.monotonically_increasing_id()), "talk-rows")
    placed = materialize(ordered(judged(rows), rows.count()), "talk-places")
    segs = materialize(segments(placed), "talk-segments")
    told = letters(segs, ways(segs))
    return stream(conversations, placed, told, conv_col, repaired)
