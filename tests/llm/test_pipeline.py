"""The corpus pipeline, stage by stage, against brute-force versions on its own input."""

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from edge import SCHEMA, components, edge_table, passages
from orderflow.llm import passages as op
from orderflow.llm import sql
from orderflow.llm.catalog import documents, tokenizer_file
from orderflow.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark):
    docs, seen = documents(spark, SF001), []
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF001), f"test-{name}")
        seen.append((name, docs.collect(), out.collect(), out.columns))
        docs = out
    assert [s[0] for s in seen] == ["quality_rules", "near_duplicates", "repeated_passages", "source_mixing",
                                    "sequence_packing"]
    assert all(sorted(cols) == sorted(COLUMNS) for *_, cols in seen[:-1])

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    kept = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({sql.quality_sql()})").fetchall() if k}
    assert {r.doc_id for r in seen[0][2]} == kept

    _, before, after, _ = seen[1]
    comp = components({r.doc_id: r.text for r in before})
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in comp.items() if i == c)

    _, before, after, _ = seen[2]
    exp = {i: rest for i, _, rest, _ in passages([(r.doc_id, r.text) for r in before], op.MIN_CHARS)}
    assert {r.doc_id: r.text for r in after} == exp
    assert all(r.n_chars == len(r.text) for r in after)

    _, before, after, _ = seen[3]
    texts, times = {r.doc_id: r.text for r in before}, {}
    for r in after:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert r.text == texts[r.doc_id] or texts[r.doc_id].split()[:len(r.text.split())] == r.text.split()
    assert max(times.values()) <= 2
    words = sum(len(r.text.split()) for r in before)
    assert abs(sum(len(r.text.split()) for r in after) - 1.5 * words) < 0.01 * words

    _, before, after, _ = seen[4]
    whole = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    total = sum(len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in before)
    assert sum(r.length for r in after) == total
    fill = {}
    for r in after:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= int(np.ceil(total / 2048)) + 2


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_take_awkward_and_empty_tables(spark):
    for df in (edge_table(spark), spark.createDataFrame([], SCHEMA)):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF001), "test-awkward")
        fill = {}
        for r in docs.collect():
            fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in fill.values():  # gapless, never overfull
            parts.sort()
            assert all(o == sum(n for _, n in parts[:k]) for k, (o, _) in enumerate(parts))
            assert sum(n for _, n in parts) <= 2048
        assert bool(fill) == (df.count() > 0)
