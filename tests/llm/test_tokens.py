import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from conftest import SF001
from edge import SCHEMA, clash, edge_rows, edge_table, prose
from orderflow.llm import catalog, orcfiles, packing, tokens, transducer, words
from orderflow.llm.catalog import tokenizer_file
from orderflow.llm.tokens import Encoder
from orderflow.session import scratch_path

ALPHA = (list("abcXYZ  \n\t.,'’éßñ0129<|>!  　日本ñİ́\x1c\x85؀🙂#srvteldm'''")
         + ["'s", "'LL", "<|endoftext|>", "  ", "\r\n", "don't", "'re", "'ve", "'ll", "aaaa", "....", "ing", "tion"])


def _texts(n):
    r = random.Random(3)
    out = ["".join(r.choice(ALPHA) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return out + ["", None, " ", "\n", "a" * 5000, "ab" * 3000, " " * 3000, "日本" * 2000, "'", "'r", " 'll", "a'l",
                  prose(4, 3000)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    path = public_tokenizers.path(name)
    texts = _texts(6000)
    rb = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    enc, got = Encoder(path), []
    for _, data, offs in words.blocks([rb], limit=20_000):
        ids, at = enc.encode(data, offs)
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    whole = Tokenizer.from_file(path)
    assert got == [x.ids for x in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_transducer_counts_are_the_librarys():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = _texts(8000)
    counter = transducer.Counter(path, transducer.character_classes(whole))
    rb = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = np.concatenate([counter.counts(d, o) for _, d, o in words.blocks([rb], limit=30_000)]).tolist()
    assert got == [len(x.ids) for x in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    # starting the machine anew changes nothing
    counter.merger.reset()
    counter.cache.clear()
    assert counter.counts(*words.text_bytes(pa.array(["tokenisation anew", "x"]))).tolist() == [
        len(whole.encode(t).ids) for t in ("tokenisation anew", "x")]


def test_prefix_scan_equals_replay():
    rng = np.random.default_rng(2)
    classes = rng.integers(0, 2 * transducer.N_CLASSES, 5000).astype(np.uint8)
    state, exp = transducer.START, []
    for c in classes:
        state = int(transducer._GO[state, c])
        exp.append(state)
    rows = classes[:4992].reshape(-1, transducer.CHUNK)
    got = transducer.prefix_scan(transducer.state_maps(rows))[:, transducer.START]
    assert got.tolist() == exp[transducer.CHUNK - 1:4992:transducer.CHUNK]


def test_token_count_rows(spark):
    whole = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    df = clash(edge_table(spark), "n_tokens", "n_bytes")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit)
                 for r in transducer.token_counts(df, tokenizer_file("byte_bpe_50k.json")).collect())
    exp = []
    for i, t, *_ in edge_rows():
        n = len(whole.encode(t or "", add_special_tokens=False).ids)
        exp.append((str(i), len((t or "").encode()), n, n > 1024))
    assert got == sorted(exp)
    empty = spark.createDataFrame([], SCHEMA)
    assert transducer.token_counts(empty, tokenizer_file("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        transducer.token_counts(df, tokenizer_file("word_bpe_49k.json"))


def test_orc_files_read_back(spark):
    path, where = tokenizer_file("word_bpe_49k.json"), scratch_path(spark, "orc-test")
    df = clash(edge_table(spark), "ids", "start", "file")
    orcfiles.write_ids(df, where, path, files=4)
    rows = sorted(orcfiles.read_ids(spark, where).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    whole, at = Tokenizer.from_file(path), 0
    exp = sorted((str(i), tuple(whole.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, *_ in edge_rows())
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in rows) == exp
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in orcfiles.checksums(orcfiles.read_ids(spark, where)).collect()}
    assert all(crc[(r.doc_id, r.start)] == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in rows)
    assert [r.doc_id for r in orcfiles.lookup(spark, where, [10, 77]).collect()] == [10]
    plan = orcfiles.lookup(spark, where, [10])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1]


def test_orc_of_an_empty_table(spark):
    assert orcfiles.round_trip(spark.createDataFrame([], SCHEMA), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_packing_is_exact_and_gapless(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    df = clash(edge_table(spark), "length", "piece", "part", "seq")
    got = packing.pack_documents(df, path, capacity=256).collect()
    whole, exp = Tokenizer.from_file(path), []
    for i, t, *_ in edge_rows():
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        lo, hi, k = 0, len(ids) % 256 or 256, 0
        while lo < len(ids):
            exp.append((str(i), k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], dtype="<u4").tobytes())))
            lo, hi, k = hi, hi + 256, k + 1
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(exp)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 256
    bound = packing.lower_bound(np.array([r.length for r in got]), 256)
    assert bound <= len(seqs) <= bound + 1
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), path).count() == 0


def _optimum(lengths, capacity):
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in sorted(set(range(len(bins))), key=lambda k: -bins[k]):
            if bins[k] + lengths[i] <= capacity:
                bins[k] += lengths[i]
                go(i + 1, bins)
                bins[k] -= lengths[i]
        go(i + 1, bins + [lengths[i]])

    go(0, [])
    return best[0]


def test_lower_bound_never_exceeds_the_optimum():
    r = random.Random(8)
    tight = 0
    for _ in range(60):
        lengths = sorted((r.randint(1, 40) for _ in range(r.randint(1, 9))), reverse=True)
        bound, opt = packing.lower_bound(np.array(lengths), 40), _optimum(lengths, 40)
        used = len(packing.best_fit(np.array(lengths), 40)[2])
        assert bound <= opt <= used
        tight += bound == opt
    assert tight > 50


def test_repeated_rows_are_spread_and_no_sequence_overflows(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 100)
    rows = [(7, 0, 0, 1500, 5)] * 6000 + [(i, 0, 0, 2048 if i % 2 else 500, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    sizes = []
    real = packing.pack_parts

    def watched(dealt, capacity):
        sizes.append(dealt.groupBy("part").count().agg({"count": "max"}).first()[0])
        return real(dealt, capacity)

    monkeypatch.setattr(packing, "pack_parts", watched)
    got = packing.pack(df).collect()
    assert len(got) == len(rows) and sizes[0] < 200
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:k]) for k, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 2048
    assert len(fill) == 7500  # every 500 finds a 1500


def test_partitions_exchange_until_the_bound(spark):
    r = random.Random(1)
    rows = [(i, 0, 0, r.randint(100, 1500), i) for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df)
    bound = packing.lower_bound(np.array([x[3] for x in rows]), 2048)
    one_round = packing.pack(df, rounds=1).select("sequence_id").distinct().count()
    used = got.select("sequence_id").distinct().count()
    assert got.count() == 12_000 and bound <= used <= one_round and used <= bound * 1.002


def _library(name, texts, end=None):
    whole = Tokenizer.from_file(tokenizer_file(name))
    return [e.ids + ([] if end is None else [end])
            for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_registered_queries_equal_the_library_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in catalog.documents(spark, SF001).select("doc_id", "text").collect()]
    ids = dict(zip([i for i, _ in rows], _library("byte_bpe_50k.json", [t for _, t in rows])))
    got = catalog.QUERIES["op2_transducer_token_counts"](spark, SF001).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i, len((t or "").encode()), len(ids[i]), len(ids[i]) > 1024) for i, t in rows)

    pieces, fill = {}, {}
    for r in catalog.QUERIES["op3_best_fit_packing"](spark, SF001).collect():
        assert r.ids_crc32 == _crc((ids[r.doc_id] + [0])[r.start:r.start + r.length])
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in pieces.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == len(ids[i]) + 1
        assert all(p[2] == 2048 for p in parts[1:])
    assert set(pieces) == set(ids)
    for parts in fill.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:k]) for k, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 2048

    words = dict(zip([i for i, _ in rows], _library("word_bpe_49k.json", [t for _, t in rows], end=1)))
    at, exp = 0, []
    for i in sorted(words):
        exp.append((i, at, len(words[i]), _crc(words[i])))
        at += len(words[i])
    got = catalog.QUERIES["op7_orc_token_ids"](spark, SF001).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == exp


def test_a_text_longer_than_a_block_is_counted_whole(spark):
    long = " ".join(f"word{i % 977} it's 12,5" for i in range(260_000))  # over 4 MB
    df = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in transducer.token_counts(df, tokenizer_file("byte_bpe_50k.json")).collect()}
    assert got == {i: len(x) for i, x in zip((1, 2), _library("byte_bpe_50k.json", [long, "short"]))}


def test_a_step_of_the_merger_asks_only_where_a_token_ends(monkeypatch):
    """Making a state asks once for each token that could end there, not for the tokens that might go on."""
    path = tokenizer_file("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    merger = transducer.Counter(path, np.zeros(0x110000, dtype=np.uint8)).merger
    asked, steps = [], []
    follows, extend = merger._follows, merger._extend
    monkeypatch.setattr(merger, "_follows", lambda s, t: asked.append(1) or follows(s, t))
    monkeypatch.setattr(merger, "_extend", lambda state, b: steps.append(len(state[-1])) or extend(state, b))
    pieces = [r.encode() for r in ("internationalisation", "xqzvk", "aaaaaaaaaaaaaaaa", "Donaudampfschifffahrt", "Größenänderung")]
    assert [merger.count(p) for p in pieces] == [len(whole.encode(p.decode()).ids) for p in pieces]
    assert len(asked) <= sum(steps)


def test_what_an_encoder_remembers_is_small_and_right():
    enc = Encoder(tokenizer_file("byte_bpe_50k.json"))
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(w) for w in letters[rng.integers(0, 26, (20_000, 8))]) for _ in range(15)]
    texts = [*texts, texts[0], texts[14]]
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        start = tracemalloc.get_traced_memory()[0]
        got = []
        for t in texts:
            data = np.frombuffer(t.encode(), dtype=np.uint8)
            got.append(zlib.crc32(enc.encode(data, np.array([0, len(data)]))[0].tobytes()))
        del data
        held += start - tracemalloc.get_traced_memory()[0] - pa.total_allocated_bytes()
    finally:
        tracemalloc.stop()
    assert -held < 24 << 20  # 300,000 chunks: 54 MB as entries of a dict
    for t, crc in zip(texts[-3:], got[-3:]):
        ids = enc.whole.encode(t, add_special_tokens=False).ids
        assert zlib.crc32(np.array(ids, dtype=np.uint32).tobytes()) == crc


def test_chunks_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 100)
    enc = Encoder(tokenizer_file("byte_bpe_50k.json"))
    texts = ["one two three", "", "four two", "<|endoftext|> one", "five " * 40 + "six", "one two four, six", "four two"]
    for t in texts:
        data = np.frombuffer(t.encode(), dtype=np.uint8)
        ids, first = enc.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == enc.whole.encode(t, add_special_tokens=False).ids and first.tolist() == [0, len(ids)]
    assert len(enc.known) < 10  # not all that were met


def test_a_task_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(words, "release", lambda: calls.append(1))
    rb = pa.RecordBatch.from_arrays([pa.array(["ab c", None, "d"])], names=["text"])
    assert sum(len(o) - 1 for _, _, o in words.blocks(iter([rb, rb]))) == 6 and calls == [1]


def test_batches_follow_bytes(spark):
    # 40 rows of 1 MB: not one batch of 10,000 rows
    df = spark.range(40, numPartitions=1).selectExpr("id", "repeat('x', 1000000) AS text")
    sizes = df.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [rb.num_rows]}) for rb in it), "n long").collect()
    assert sum(r.n for r in sizes) == 40 and max(r.n for r in sizes) <= 10
