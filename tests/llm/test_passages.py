from conftest import SF001
from edge import SCHEMA, clash, edge_rows, edge_table, passages, prose
from orderflow.llm import catalog, passages as op


def _got(df, **kw):
    out = op.remove_repeats(df, **kw).collect()
    return sorted(((r.doc_id, r.text, [(s.start, s.end) for s in r.removed]) for r in out), key=repr)


def _exp(rows, min_chars):
    return sorted(((i, rest, spans) for i, _, rest, spans in passages(rows, min_chars)), key=repr)


def test_spans_equal_brute_force(spark):
    shared = prose(500, 60)
    rows = [(i, prose(i, 80) + "\n" + (shared + " " if i % 3 == 0 else "") + prose(1000 + i, 40)) for i in range(40)]
    rows += [(100, "Same line here.\n" * 12), (101, "SAME   line\there. Other. Same line here.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for min_chars in (1, 120):
        assert _got(df, min_chars=min_chars) == _exp(rows, min_chars)


def test_edge_rows_and_clashing_columns(spark):
    df = clash(edge_table(spark), "removed", "units", "hash", "id", "h1")
    rows = [(i, t) for i, t, *_ in edge_rows()]
    # equal ids with different texts are ranked by a hash, so only whether text is left is fixed for them
    nulls = [r for r in rows if r[0] is None]
    assert len(nulls) == 2
    got = _got(df)
    exp = _exp(rows, op.MIN_CHARS)
    assert got == exp
    out = op.strip_repeats(df)
    assert out.columns == df.columns
    assert out.where("n_chars <> char_length(text)").count() == 0


def test_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in catalog.documents(spark, SF001).select("doc_id", "text").collect()]
    assert _got(catalog.documents(spark, SF001).select("doc_id", "text")) == _exp(rows, op.MIN_CHARS)
    q = catalog.op8_repeated_passages(spark, SF001).collect()
    assert sorted((r.doc_id, r.text) for r in q) == sorted((i, rest) for i, _, rest, _ in passages(rows, op.MIN_CHARS))


def test_empty_table(spark):
    assert op.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_whole_line_recurs(spark):
    rows = [(r.doc_id, r.text) for r in catalog.documents(spark, SF001).select("doc_id", "text").collect()]
    rows += [(10_000 + i, f"短い行\nonly {i} here\nTe.\n{prose(i, 30)}\nTe. Te.\nTe.") for i in range(5)]
    out = op.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    lines = [" ".join(x.split()).lower() for r in out for x in (r.text or "").split("\n") if x.strip()]
    assert lines.count("短い行") == lines.count("te.") == 1
    assert len(lines) == len(set(lines))


def test_a_text_longer_than_a_block(spark):
    long = "\n".join(f"line {i} of a long text." for i in range(250_000))  # over 5 MB
    rows = [(1, "line 77 of a long text.\nmine"), (2, long), (3, long + "\nmore")]
    got = {r.doc_id: r.text for r in op.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[3] == "more"
    assert "line 77 of" not in got[2] and got[2].count("\n") == 249_998


def test_a_task_holds_one_python_worker(spark):
    # workers outlive their stage: two to a task are twice the memory for all that follows
    df = spark.createDataFrame([(1, "one line\nanother line"), (2, "one line\nmine")], "doc_id long, text string")
    plan = op.remove_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("MapInArrow") == 1
