import duckdb

from conftest import SF001
from edge import SCHEMA, WORD, clash, edge_rows, edge_table, prose
from orderflow.llm import catalog, quality, sql
from tools.check_oracle import digest


def _counts(text):
    t = text or ""
    w = WORD.findall(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, x in enumerate(tri) if tri.count(x) > 1 for k in range(3)} if len(tri) < 3000 else None
    if hit is None:
        from collections import Counter
        c = Counter(tri)
        hit = {i + k for i, x in enumerate(tri) if c[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_counts_equal_brute_force(spark):
    rows = edge_rows() + [(50, "a b c\na b c\n\n a b c\n#|<x> a b c", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = quality.judged(clash(df, "n_words", "kept", "metric", "bin"), ["doc_id", "text"]).collect()
    assert sorted(tuple(r[c] for c in quality.COUNTS) for r in got) == sorted(_counts(r[1]) for r in rows)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    exp = con.execute(sql.quality_sql()).df()
    assert digest(catalog.op4_adaptive_quality(spark, SF001).toPandas()) == digest(exp)


def test_thresholds_adapt_to_the_group(spark):
    # a source of code-like text keeps its symbols; the same text is an outlier in a prose source
    code = [(i, " ".join(f"w{k}#" if (k + i) % 3 else f"v{k}" for k in range(80)), "en", "code", 0) for i in range(60)]
    text = [(100 + i, prose(i, 80), "en", "prose", 0) for i in range(300)]
    odd = [(999, code[0][1], "en", "prose", 0)]
    out = quality.judged(spark.createDataFrame(code + text + odd, SCHEMA), ["doc_id"], min_rows=50)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert not kept.pop(999) and all(kept.values())


def test_sketches_merge_to_the_groups_quantiles(spark):
    import math
    df = spark.createDataFrame([(f"s{i % 3}", (i * 7919) % 5000) for i in range(6000)], "source string, v long")
    sk = df.selectExpr("'en' AS lang", "source", "'m' AS metric", "v").withColumn(
        "bin", quality.rounded(df.v)).groupBy("lang", "source", "metric", "bin").count().withColumnRenamed("count", "n")
    got = quality.quartiles(sk, ["lang"]).first()
    values = sorted((i * 7919) % 5000 for i in range(6000))
    for q, x in (("q25", values[1499]), ("q75", values[4499])):
        assert x * 31 / 32 - 1 <= got[q] <= x and math.isfinite(got[q])


def test_filter_keeps_columns_and_handles_awkward_tables(spark):
    df = clash(edge_table(spark), "n_words", "base_failed", "high_lines", "lang_", "c0")
    out = quality.quality_filter(df)
    assert out.columns == df.columns
    base = {r[1] for r in edge_rows() if _counts(r[1])[0] >= 50 and 2 * _counts(r[1])[4] <= _counts(r[1])[0]}
    assert {r.text for r in out.collect()} <= base
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.quality_filter(empty).count() == 0 and quality.judged(empty).count() == 0
    short = spark.createDataFrame([(1, "too short", "en", "a", 9)], SCHEMA)
    assert quality.quality_filter(short).count() == 0
