import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF001
from edge import SCHEMA, WORD, clash, edge_rows, edge_table
from orderflow.llm import catalog, lmscore, sql, words
from tools.check_oracle import digest


def _brute(texts, order, alpha=0.4):
    docs = [["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")] for t in texts]
    grams = [Counter(tuple(d[i:i + k]) for k in range(1, order + 1) for i in range(len(d) - k + 1)) for d in docs]
    every = Counter()
    for g in grams:
        every.update(g)
    n = sum(map(len, docs))
    out = []
    for d, own in zip(docs, grams):
        rest, total = max(n - len(d), 1), 0.0

        def c(g):
            return every[g] - own[g]

        def s(g):
            if len(g) == 1:
                return max(c(g), 1) / rest
            return c(g) / c(g[:-1]) if c(g) > 0 else alpha * s(g[1:])

        for i in range(len(d)):
            total += math.log(s(tuple(d[max(0, i - order + 1):i + 1])))
        out.append((len(d), total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    df = clash(edge_table(spark), "block", "n_words", "log_score")
    got = lmscore.score_documents(df, order=order).collect()
    got = sorted((r.n_words, r.log_score) for r in got)
    exp = sorted(_brute([r[1] for r in edge_rows()], order))
    assert [n for n, _ in got] == [n for n, _ in exp]
    assert all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(got, exp))


def test_many_blocks_and_ranges_change_nothing(spark, monkeypatch):
    df = edge_table(spark)
    exp = sorted((r.n_words, r.log_score) for r in lmscore.score_documents(df).collect())
    monkeypatch.setattr(lmscore, "RANGE_KEYS", 500)
    monkeypatch.setattr(lmscore, "RANGES", 1)
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 20_000)
    got = lmscore.score_documents(df.repartition(7)).collect()
    assert sorted((r.n_words, r.log_score) for r in got) == exp


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    assert digest(catalog.op1_stupid_backoff_scores(spark, SF001).toPandas()) == digest(con.execute(sql.lm_sql()).df())


def test_empty_and_wordless_tables(spark):
    assert lmscore.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, None, "en", "a", 0), (2, "word", "en", "a", 4)], SCHEMA)
    got = {r.doc_id: (r.n_words, r.log_score) for r in lmscore.score_documents(one).collect()}
    assert got == {1: (0, 0.0), 2: (1, 0.0)}


def test_query_equals_brute_force(spark):
    texts = [r.text for r in catalog.documents(spark, SF001).collect()]
    got = sorted((r.n_words, r.log_score) for r in catalog.QUERIES["op1_stupid_backoff_scores"](spark, SF001).collect())
    exp = sorted(_brute(texts, 3))
    assert [n for n, _ in got] == [n for n, _ in exp]
    assert all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(got, exp))


def test_keys_travel_as_steps(spark):
    text = " ".join(f"w{i * 7919 % 30_011}" for i in range(60_000))
    blocks = lmscore.blocks_of(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    for ranges in (1, 64):
        asked = lmscore.requests(blocks, 2, ranges).collect()
        row = blocks.first()
        g = lmscore.Grams(row.texts, np.array(row.offs), 2)
        whole = 0
        for r in asked:
            k, at = divmod(r.part, ranges)
            u = np.unique(g.key[k][g.whole[k]])
            low, high = (at << 64) // ranges, ((at + 1) << 64) // ranges - 1
            u = u[(u >= np.uint64(low)) & (u <= np.uint64(high))]
            steps = words.unpack(bytes(r["keys"]), np.uint64)
            assert (np.cumsum(steps, dtype=np.uint64) + np.uint64(low) == u).all()
            whole += len(words.pack(u))
        assert sum(len(r["keys"]) for r in asked) < 0.98 * whole


def test_the_exchange_of_one_order_is_gone_before_the_next(spark, monkeypatch):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    seen, keep = [], lmscore.materialize

    def watched(df, name):
        before = shuffles()
        out = keep(df, name)
        seen.append((name, shuffles() - before))
        return out

    monkeypatch.setattr(lmscore, "materialize", watched)
    lmscore.score_documents(edge_table(spark))
    assert seen == [("lm-blocks", set()), *((f"lm-answers-{k}", set()) for k in (1, 2, 3))]
