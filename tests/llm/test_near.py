import random

import duckdb
import numpy as np

from conftest import SF001
from edge import SCHEMA, clash, components, edge_rows, edge_table, edited, prose, shingles
from orderflow.llm import catalog, near, sql
from tools.check_oracle import digest


def _corpus():
    rows, n = [], 0
    for f in range(25):
        base = prose(100 + f, random.Random(f).randint(6, 160))
        for k in range(random.Random(f).choice([1, 1, 2, 5, 12])):
            rows.append((n, edited(base, n, random.Random(n).choice([12, 40, 80, 200])) if k else base))
            n += 1
    return rows


def test_components_equal_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near.near_duplicates(df).collect()}
    exp = components(dict(rows))
    assert {i: r.component_id for i, r in got.items()} == exp
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    # one star round or none must not change the answer
    few = near.near_duplicates(df, star_rounds=1)
    assert {r.doc_id: r.component_id for r in few.collect()} == exp


def test_edge_rows(spark):
    df = clash(edge_table(spark), "kept", "component_id", "bands", "digest", "node")
    got = near.near_duplicates(df).collect()
    ids = {i: t for i, t, *_ in edge_rows() if i is not None}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == components(ids)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    kept = near.keep_one(df)
    assert kept.columns == df.columns
    left = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert left == sorted(i for i, c in components(ids).items() if i == c)
    assert kept.where("doc_id IS NULL").count() == 2


def test_repeated_rows_of_one_id_leave_one(spark):
    df = spark.createDataFrame([(5, "a b c d e f")] * 3 + [(6, "q")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near.keep_one(df).collect()) == [5, 6]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near.near_duplicates(df).count() == 0 and near.keep_one(df).count() == 0


def test_minimum_and_maximum_estimate_the_similarity():
    rng = np.random.default_rng(1)
    both, one, two = (np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64)) for n in (700, 150, 150))
    a, b = near.functions(400)
    sig = near.minmax([np.union1d(both, one), np.union1d(both, two)], a, b)
    same = sig[0] == sig[1]
    for half in (same[0::2], same[1::2]):  # minima and maxima each estimate 0.7
        assert abs(half.mean() - 0.7) < 0.08
    bits = near.sketch(sig)
    equal = sum(bin(~int(np.bitwise_or.reduce([bits[0, k * 13 + i] ^ bits[1, k * 13 + i] for k in range(near.PLANES)]))
                    & (2 ** 64 - 1)).count("1") for i in range(13)) - (13 * 64 - 800)
    assert same.sum() <= equal <= same.sum() + 50


def test_a_large_family_has_no_lost_link_and_few_pairs(spark):
    base = prose(5, 146)
    rows = [(i, base if i % 3 == 0 else edited(base, i, 60)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near.near_duplicates(df).collect()} == components(dict(rows))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    got = catalog.op10_minmax_near_dedup(spark, SF001).toPandas()
    assert digest(got) == digest(con.execute(sql.near_sql()).df())


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    one, two, three = prose(21, 80), prose(22, 80), prose(23, 80)
    rows = [(1, one), (1, two), (1, three), (2, two), (3, three), (4, one), (4, prose(24, 80)), (5, ""), (5, "a b")]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in near.keep_one(df).collect())
    assert kept == sorted([(1, one), (1, two), (1, three), (4, prose(24, 80)), (5, ""), (5, "a b")])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near.near_duplicates(df).collect())
    assert got == sorted([(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (4, 1, False), (4, 4, True)]
                         + [(5, 5, True)] * 2)
