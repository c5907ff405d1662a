"""Sharding, fingerprints and mixing: DataFrame operations only, against brute force."""

import hashlib
import zlib
from collections import defaultdict

import xxhash

from conftest import SF001
from edge import SCHEMA, WORD, clash, edge_rows, edge_table, edited, prose
from orderflow.llm import catalog, imatch, mixing, sharding


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "MapPartitions"))


def _check_shards(rows, got, key="doc_id"):
    size = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows}
    assert {(r[key], r["size"], r.text_crc32) for r in got} == size and len(got) == len(rows)
    total, by = sum(r["size"] for r in got), defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    largest = max(r["size"] for r in got)
    for s, rs in by.items():
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and 0 <= s < 8
        assert abs(sum(r["size"] for r in rs) - total / 8) <= largest
    return by


def test_shards_are_even_in_bytes(spark):
    df = catalog.documents(spark, SF001)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    q = catalog.op5_sampled_splitter_shards(spark, SF001)
    _no_python(q)
    got = q.collect()
    by = _check_shards(rows, got)
    keys = [sorted(r.doc_id for r in by[s]) for s in sorted(by)]
    assert all(a[-1] < b[0] for a, b in zip(keys, keys[1:]))  # shards are ranges of the key
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, got))


def test_shards_of_skewed_and_awkward_tables(spark):
    df = clash(edge_table(spark), "shard", "size", "range", "part", "key", "tie", "c0", "at")
    got = sharding.shard_documents(df).collect()
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # a third of the rows with one text and nearly all bytes among a few neighbouring keys
    many = [(i, "same text" if i % 3 == 0 else "x" * (5000 if 3000 <= i < 3100 else 1)) for i in range(6000)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    _check_shards(many, sharding.shard_documents(df).collect())
    # a third of the rows with one id: cut by their texts
    hot = [(7 if i % 3 == 0 else None if i % 3 == 1 and i % 2 else i, f"text {i} " * 5) for i in range(9000)]
    hdf = spark.createDataFrame(hot, "doc_id long, text string")
    _check_shards(hot, sharding.shard_documents(hdf).collect())
    parts = sharding.ranged(hdf.selectExpr("doc_id", "octet_length(text) + 1L AS size", "doc_id AS key",
                                           "xxhash64(text) AS tie"))[0].groupBy("range", "part").count()
    assert parts.agg({"count": "max"}).first()[0] < 2000
    placed, _ = sharding.ranged(df.selectExpr("doc_id", "octet_length(text) + 1L AS size", "doc_id AS key",
                                              "xxhash64(text) AS tie"))
    sums = [r.b for r in placed.groupBy("range", "part").agg({"size": "sum"}).toDF("range", "part", "b").collect()]
    total = sum(len(t) + 1 for _, t in many)
    assert max(sums) < 0.25 * total  # overfull ranges are subdivided
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def _h(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def _s64(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def _terms(t):
    import regex
    return {w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w}


def _print(text, lex):
    own_terms = sorted(_s64(_h(w.encode(), 42)) for w in _terms(text))
    out = []
    for k, rate in enumerate(imatch.RATES):
        first = _h(k.to_bytes(4, "little"), 42)
        own = [x for x in own_terms if x in lex and _s64(_h(x.to_bytes(8, "little", signed=True), first)) % rate == 0]
        h = first
        for x in own:
            h = _h(x.to_bytes(8, "little", signed=True), h)
        out.append(f"{h >> 32:08X}" if own else "-")
    if any(x != "-" for x in out):
        return ".".join(out)
    h = 42  # no term of any subset: a print of its own, over all its terms, else the text
    for w in sorted(_terms(text)):
        h = _h(w.encode(), h)
    return f"={h:X}" if own_terms else f"~{_h(text.encode(), 42):X}"


def _lexicon(texts):
    held = defaultdict(int)
    for t in set(texts):
        for w in _terms(t):
            held[w] += 1
    n = len(set(texts))
    return {_s64(_h(w.encode(), 42)) for w, c in held.items() if imatch.LOW * n <= c <= max(1, imatch.HIGH * n)}


def _likeness(a, b):
    if a == b:
        return 1.0
    if "." not in a or "." not in b:
        a, b = (x if "." in x else ".".join([x] + ["-"] * (len(imatch.RATES) - 1)) for x in (a, b))
    pairs = [(x, y) for x, y in zip(a.split("."), b.split(".")) if (x, y) != ("-", "-")]
    return sum(x == y for x, y in pairs) / max(1, len(pairs))


def _check_prints(docs, got):
    """``docs``: (id, text), ids distinct."""
    docs = sorted(((i, t or "") for i, t in docs), reverse=True)
    lex = _lexicon([t for _, t in docs])
    got = {r.doc_id: r for r in got}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        after, half = docs[(k + 1) % len(docs)], len(t) // 2
        e = t[:len(t) - half] + after[1][:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r.fingerprint == _print(t, lex) and r.edited_fingerprint == _print(e, lex)
        # the likenesses are those of the returned prints
        assert abs(r.near_edited - _likeness(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - _likeness(r.fingerprint, got[after[0]].fingerprint)) < 1e-12
    return got


def test_fingerprints_equal_brute_force(spark):
    df = catalog.documents(spark, SF001)
    q = catalog.op6_imatch_fingerprints(spark, SF001)
    _no_python(q)
    got = _check_prints([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], q.collect())
    near = [r.near_edited for r in got.values()]
    far = [r.near_next for r in got.values()]
    assert sum(near) / len(near) > 5 * sum(far) / len(far)


def test_copies_in_a_third_of_the_rows_keep_their_terms_and_blank_texts_differ(spark):
    rows = [(i, prose(1, 200) if i % 3 == 0 else prose(i + 2, 200)) for i in range(300)]
    rows += [(1000, ""), (1001, None), (1002, "?!"), (1003, "日本語。"), (1004, "中文。")]
    got = _check_prints(rows, imatch.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert "." in got[0].fingerprint and got[0].fingerprint == got[3].fingerprint
    assert len({got[i].fingerprint for i in (1000, 1002, 1003, 1004)}) == 4 and got[1000].fingerprint == got[1001].fingerprint
    assert got[1004].near_next < 1


def test_fingerprints_of_awkward_tables(spark):
    df = clash(edge_table(spark), "fingerprint", "bucket", "tie", "nth", "w", "term")
    got = imatch.fingerprint_documents(df).collect()
    assert len(got) == len(edge_rows())
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.fingerprint)
    assert by[1] == by[2] == by[12] and by[3] == by[-3]  # equal texts, equal fingerprints
    one = spark.createDataFrame([(1, "only one text here", "en", "a", 18)], SCHEMA)
    r = imatch.fingerprint_documents(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"only one only one ").hexdigest() and r.near_next == 1.0
    assert imatch.fingerprint_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_likeness_falls_with_edits(spark):
    base = [prose(i, 300, 900) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, edited(t, i, 100)) for i, t in enumerate(base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lex = imatch.lexicon(df, low=0.02, high=0.5)
    f = {r.doc_id: r.fingerprint for r in imatch.fingerprints(df, ["doc_id"], lex).collect()}
    pairs = spark.createDataFrame([(f[i], f[100 + i], f[100 + (i + 1) % 60]) for i in range(60)], "a string, b string, c string")
    got = pairs.select(imatch.likeness("a", "b").alias("n"), imatch.likeness("a", "c").alias("f")).collect()
    near, far = sum(r.n for r in got) / 60, sum(r.f for r in got) / 60
    assert near > 0.5 > 0.2 > far


def _targets(sizes):
    """Water-filling by the contract's words: share by weight, cap, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, out = 1.5 * sum(sizes.values()), {}
    open_ = list(order)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if 2 * sizes[s] < w[s] * level]
        if not over:
            out.update({s: w[s] * level for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def _check_mix(rows, got, tolerance):
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = defaultdict(int)
    for i, _, s in rows:
        sizes[s] += size[i]
    target, taken = _targets(dict(sizes)), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[s] and r.taken <= 2 * r["size"]
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance * target[s] + 5, s


def test_mix_meets_its_targets(spark):
    df = catalog.documents(spark, SF001)
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    q = catalog.op9_source_mixing(spark, SF001)
    _no_python(q)
    got = q.collect()
    _check_mix(rows, got, 0.01)
    assert sorted(map(tuple, catalog.op9_source_mixing(spark, SF001).collect())) == sorted(map(tuple, got))


def test_mix_of_skewed_and_awkward_tables(spark):
    rows = [(i, prose(i, 20 + i % 50), "hot" if i % 3 else f"s{i % 7}" if i % 2 else None) for i in range(900)]
    rows += [(2000, "", "tiny"), (2001, None, "tiny"), (2002, "two words", "tiny"), (2003, "", "void")]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string, source string"), "size", "sid", "at", "bucket", "c0")
    _check_mix(rows, mixing.mix_sources(df).collect(), 0.02)
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix_sources(spark.createDataFrame([(1, "", "en", "a", 0)], SCHEMA)).first().taken == 0


def test_schedule_is_spread_evenly(spark):
    rows = [(i, prose(i, 50), "abc"[i % 3]) for i in range(300)]
    mix = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    plan = sorted((r.slot, r.sid) for r in mix.plan.collect())
    due = {r.sid: r.due / r.all_due for r in mix.lay.collect()}
    for part in (0.1, 0.37, 0.8):  # every prefix follows the shares
        head = plan[:int(len(plan) * part)]
        for sid, share in due.items():
            assert abs(sum(s == sid for _, s in head) - share * len(head)) < 6
    times = mix.plan.groupBy("sid", "block").count().collect()
    assert max(r["count"] for r in times) <= mixing.PASSES


def test_mixed_documents_are_the_words_taken(spark):
    df = edge_table(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    exp = {r.doc_id: r.taken for r in mixing.mix_sources(df).collect() if r.taken}
    assert dict(words) == exp


def test_copies_and_texts_without_lexicon_terms_have_their_own_prints(spark):
    hot = prose(7, 120)
    rows = [(i, hot) for i in range(300)] + [(1000 + i, prose(100 + i, 120)) for i in range(600)]
    rows += [(2000, "completely unheard"), (2001, "nothing alike"), (2002, "?!"), (2003, "..."), (2004, ""), (2005, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    f = {r.doc_id: r for r in imatch.fingerprint_documents(df).collect()}
    assert len({f[i].fingerprint for i in range(300)}) == 1
    assert sum(x != "-" for x in f[0].fingerprint.split(".")) > 1  # the copies keep their terms
    assert f[5].near_next == 1.0 and f[0].near_edited > 0
    rare = [f[i].fingerprint for i in range(2000, 2005)]
    assert len(set(rare)) == 5 and f[2005].fingerprint == f[2004].fingerprint
    assert f[2001].near_next == 0.0 and f[2003].near_next == 0.0


def test_documents_at_the_cut_keep_their_white_space(spark):
    rows = [(i, f"\n a{i}\tb  c\n\nd{i}   e f\ng" * 20, "abc"[i % 3]) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    text = {i: t for i, t, _ in rows}
    got = mixing.mixed_documents(df).collect()
    assert any(r.text != text[r.doc_id] for r in got) and all(text[r.doc_id].startswith(r.text) for r in got)
