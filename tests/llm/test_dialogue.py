import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from conftest import SF001
from edge import clash
from orderflow.llm import catalog, dialogue as op

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def _cheapest(rows, inserts):
    """(cost, audit, repaired): short conversations by trying every edit sequence in the order of
    (cost, audit), longer ones by the least (cost, audit) for each pattern state row by row."""
    if len(rows) > 5:
        best = {"": (0, "", ())}   # by the initials that matter: none, s, u, a
        for role, text, fault in rows:
            after = {}
            for last, (cost, audit, done) in best.items():
                ways = [(last, cost + 2, "D", done)]
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    for letter, own, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                        if own and last + own[:1] in ("s", "u", "su", "ua", "au") and (own[:1] != "s" or not done):
                            ways.append((own[:1], cost + price + more, letter, done + ((own, text),)))
                for to, c, letter, rest in ways:
                    if to not in after or (c, audit + letter) < after[to][:2]:
                        after[to] = (c, audit + letter, rest)
            best = after
        return min((w for last, w in best.items() if last in ("", "a")), key=lambda w: w[:2])
    heap, n = [(0, "", 0, 0, ())], len(rows)   # cost, audit, rows done, inserts, repaired
    while heap:
        cost, audit, i, k, done = heapq.heappop(heap)
        if i == n and PATTERN.match("".join(r[0][:1] for r in done)):
            return cost, audit, list(done)
        if k < inserts:
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 5, audit + "I", i, k + 1, done + ((role, ""),)))
        if i < n:
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, k, done))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for letter, own, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    after = done + ((own, text),)
                    initials = "".join(r[0][:1] or "-" for r in after)
                    if re.fullmatch(r"s?(ua)*u?", initials):
                        heapq.heappush(heap, (cost + price + more, audit + letter, i + 1, k, after))


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    return out


def _brute(table, inserts=0, damage=True):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if damage and kind == 0:
            continue
        if damage:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
        tie = role + "\x01" + hashlib.sha256(text.encode()).hexdigest()
        rows += [((turn is not None, turn or 0), tie, c, turn, role, text)
                 for c in range(2 if damage and kind == 3 else 1)]
    out = []
    for conv, rows in convs.items():
        rows = [r[3:] for r in sorted(rows, key=lambda r: r[:3])]
        faults = _faults([r[1:] for r in rows])
        turns = [t for t, _, _ in rows if t is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit, done = _cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults)], inserts)
        text = "\n".join(f"{r}:{t}" for r, t in done)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()),
        key=repr)


def _table(seed, convs, longest):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "Why? ", "Yes.\x85", "Ünïcode…", "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "umpire"]
    return [(c, None if r.random() < .05 else t + r.choice([0, 0, 0, 1]), r.choice(roles),
             r.choice(texts) if r.random() < .6 else f"Text {r.randint(0, 5)}.")
            for c in range(convs) for t in range(r.randint(1, longest))]


def test_random_conversations_equal_brute_force_with_inserts(spark):
    rows = _table(1, 60, 6) + [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Yes."),
                               (-5, None, None, None), (900, 3, "system", "Be brief.")]
    rows += rows[:7]  # repeated rows
    df = clash(spark.createDataFrame(rows, SCHEMA), "cost", "audit", "part", "salt", "copy", "tie")
    assert _got(op.repair(df)) == _brute(rows, inserts=2)
    assert _got(op.repair(df, damage=False)) == _brute(rows, inserts=2, damage=False)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_inserts_are_never_cheaper(n):
    for codes in itertools.product([0, 1, 2, 3, 1 + op.GO, 2 + op.CUT], repeat=n):
        free, tight = op.paths(bytes(codes), op.START, inserts=2), op.paths(bytes(codes), op.START)
        best = [min((op.audit_of(w[q], width) for q in op.FINAL if q in w))
                for w, width in ((free, n + 2), (tight, n))]
        assert best[0] == best[1]


def test_segments_and_tree_change_nothing(spark, monkeypatch):
    rows = _table(7, 12, 14) + [(100, t, "user" if t % 3 else "assistant", f"t{t}{'.' if t % 4 else ''}") for t in range(90)]
    rows += [(101, t, "user", "Same.") for t in range(40)] + [(102, 5, "user", "Alike.")] * 30
    df = spark.createDataFrame(rows, SCHEMA)
    exp = _got(op.repair(df))
    monkeypatch.setattr(op, "SEGMENT", 4)
    monkeypatch.setattr(op, "FAN", 3)
    monkeypatch.setattr(op, "RANGE_ROWS", 25)
    assert _got(op.repair(df)) == exp
    assert exp == _brute(rows)


def test_repaired_rows_read_as_the_pattern_and_give_the_hash(spark):
    rows = _table(3, 40, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    told = {r.conv_id: r for r in op.repair(df).collect()}
    kept = {}
    for r in sorted(op.repair(df, repaired=True).collect(), key=lambda r: (r.conv_id, r.nth)):
        kept.setdefault(r.conv_id, []).append(r)
    for conv, t in told.items():
        mine = kept.get(conv, [])
        assert PATTERN.match("".join(r.role[:1] for r in mine))
        assert [r.edit for r in mine] == [x for x in t.audit if x != "D"]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == t.repaired_sha256


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in catalog.table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = _got(catalog.QUERIES["op12_conversation_repair"](spark, SF001))
    assert got == _brute(rows)
    assert sum(r[2] for r in got) and sum(r[3] for r in got) and sum(r[6] for r in got)


def test_one_conversation_with_all_rows_and_long_texts(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"{t} " * 3000 + ".") for t in range(2500)]
    got = {r.conv_id: r for r in op.repair(spark.createDataFrame(rows, SCHEMA), damage=False).collect()}
    assert got[1].cost == 0 and got[1].audit == "K" * 2500
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert got[1].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.repair(empty).count() == 0 and op.repair(empty, repaired=True).count() == 0
