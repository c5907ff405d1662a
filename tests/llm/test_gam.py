import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF01
from edge import SCHEMA, WORD, clash, edge_rows, edge_table, prose
from orderflow.llm import catalog, gam
from orderflow.llm import words as wd


def _features(text):
    """The features of one text, character by character."""
    t = text or ""
    w = WORD.findall(t)
    n, chars, size = max(1, len(w)), max(1, len(t)), max(1, len(t.encode()))
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    low = Counter("".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in w)

    def many(chars_):
        return sum(c in chars_ for c in t)

    def letter(c):
        return "A" <= c <= "Z" or "a" <= c <= "z" or ord(c) > 127

    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    loud = [x for x in w if sum(c in capitals for c in x) > 1 and not any(letter(c) and c not in capitals for c in x)]
    return (math.log1p(len(w)), sum(map(len, w)) / n, many("#*$%&|<>") / n, len(again) / n,
            (len(lines) - len(set(lines))) / (t.count("\n") + 1), len(low) / n, max(low.values(), default=0) / n,
            many(capitals) / chars, many("0123456789") / chars, many("!?") / n, many(".!?") / n, many(",") / n,
            sum(ord(c) > 127 for c in t) / chars, t.count("\n") / n, sum(len(x.encode()) <= 2 for x in w) / n,
            sum(len(x.encode()) >= 15 for x in w) / n, len(loud) / n, many(" \t\n\r\x0b\x0c") / size,
            many("\"'()-/:;=@[\\]_`{}~+") / n, sum(len(c.encode()) for c in t if letter(c)) / size)


def test_features_equal_plain_python(spark):
    rows = edge_rows() + [(70, "LOUD WORDS!! Ab, c? (x) É日 12:30\nLOUD WORDS!!\nLOUD WORDS!!", "en", "a", 0)]
    got = gam.measured(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")).collect()
    got = sorted(tuple(r[2:]) for r in got)
    exp = sorted(tuple(np.array(_features(r[1]), dtype=np.float32).tolist()) for r in rows)
    assert np.allclose(np.array(got), np.array(exp), rtol=1e-5, atol=1e-7)


def test_tables_learn_shapes_and_a_pair():
    r = np.random.default_rng(5)
    x = r.random((4000, 5)).astype(np.float32)
    y = ((np.abs(x[:, 0] - .5) < .25) ^ ((x[:, 1] > .5) & (x[:, 2] > .5))).astype(np.float64)
    m = gam.fit(x[:3000], y[:3000])
    assert {1, 2} <= {f for p in m.pairs[:3] for f in p}
    assert ((m.score(x[3000:]) >= .5) == y[3000:]).mean() > .85
    # the score is the plain sum of looked-up cells
    for row in x[3000:3020]:
        b = [sum(v >= e for e in m.edges[f].tolist()) for f, v in enumerate(row)]
        z = m.intercept + sum(t[k] for t, k in zip(m.tables, b))
        z += sum(g[m.coarse[i][b[i]], m.coarse[j][b[j]]] for (i, j), g in zip(m.pairs, m.grids))
        assert abs(1 / (1 + math.exp(-z)) - m.score(row[None])[0]) < 1e-9


def _auc(score, y):
    rank = {s: i for i, s in enumerate(sorted(set(score)))}
    up, down = Counter(rank[s] for s, v in zip(score, y) if v), Counter(rank[s] for s, v in zip(score, y) if not v)
    wins = sum(a * b * (1.0 if i > j else 0.5 if i == j else 0.0) for i, a in up.items() for j, b in down.items())
    return wins / (sum(up.values()) * sum(down.values()))


def test_query_on_held_out_rows_and_again(spark):
    out = catalog.QUERIES["op13_additive_quality"](spark, SF01)
    assert [f.dataType.simpleString() for f in out.schema][:4] == ["bigint", "boolean", "double", "int"]
    got = {r.doc_id: r for r in out.collect()}
    docs = catalog.documents(spark, SF01)
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in got.values())
    y = {r.doc_id: r.quality for r in catalog.table(spark, SF01, "labels").collect()}
    held = [i for i in y if i in got and got[i].held_out]
    assert _auc([got[i].score for i in held], [y[i] for i in held]) > .93
    assert sum(got[i].predicted == y[i] for i in held) / len(held) > .9
    again = catalog.op13_additive_quality(spark, SF01).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((i, r.score) for i, r in got.items())


def test_labels_of_the_held_out_third_change_nothing(spark):
    docs = clash(edge_table(spark), "score", "quality", "held_out", "log_words")
    r = random.Random(4)
    base = [(i, r.randint(0, 1), 0) for i in range(1, 17)]
    flip = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in base]
    kind = "doc_id long, quality int, toxic int"
    a, b = (sorted(map(tuple, gam.classify(docs, spark.createDataFrame(x, kind)).collect()), key=repr) for x in (base, flip))
    assert a == b and len(a) == len(edge_rows())


@pytest.mark.parametrize("labels, score", [([], .5), ([(1, 1)] * 3, .8), ([(None, 0), (4, None), (4, 7), (999, 0)], .5)])
def test_without_both_labels_the_share_counts(spark, labels, score):
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = spark.createDataFrame([(1, None), (4, ""), (4, prose(1, 50)), (None, "a")], "doc_id long, text string")
    got = gam.classify(docs, labels).collect()
    assert len(got) == 4 and all(abs(r.score - score) < 1e-6 and r.predicted == 1 for r in got)
    assert gam.classify(docs.limit(0), labels).count() == 0


def test_bounded_sample_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(wd, "BLOCK_BYTES", 1000)
    rows = [(i, prose(i, 60) if i % 2 else "A!! B!! " * (20 + i % 9)) for i in range(600)] + [(1001, prose(3, 30_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    got = {r.doc_id: r.predicted for r in gam.classify(docs, labels, sample=100).collect()}
    assert all(got[i] == i % 2 for i in range(600)) and got[1001] == 1
