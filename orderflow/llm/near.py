"""Near-duplicate documents by min-max hashing.

A document's set holds the distinct hashes of its ``shingle``-word windows
(fewer words: the whole sequence is the one element; none: the set is empty
and links with nothing).  Each of ``permutations`` hash functions is
evaluated once per element and yields two signature values, its minimum and
its maximum over the set -- two nearly independent, unbiased estimates of the
Jaccard similarity for one evaluation.  Signatures are cut into bands of
``rows`` values; documents that agree on a band are candidates, and a link is
confirmed on the full sets: ``100 * intersection >= threshold * union``.

With the defaults, 128 evaluations give 256 values in 36 bands of 7; a pair at
exactly 0.85 is missed with probability (1 - 0.85^7)^36 = 9e-7.

How groups of any size are handled without forming all pairs:

* Documents with equal sets form a class (grouped by a 128-bit digest of the
  set); only the class representative -- its smallest (id, text hash) -- goes on.
* Inside a bucket (documents sharing a band) representatives are compared
  with one leader, not with each other.  Confirmed links are contracted to
  components, and the next round takes another leader for the members that
  are still outside the leader's component.
* After ``star_rounds`` rounds, only pairs of one bucket in *different*
  components can still hold a link between components: those pairs, and only
  those, are confirmed exactly, if the estimate from four bits of every
  signature value lies within ``SIGMAS`` standard deviations of the
  threshold or above (so large families of texts a little less alike than
  the threshold do not come out as pairs).  A pair that is in one component
  already can add nothing, so the components equal those of the graph of all
  candidate links.

Classes, links and components stay distributed; the components come from
alternating large-star / small-star contraction, each step a table in the
shared folder.

Defined cases: null text is empty; rows with a null id are returned with a
null component and are kept (they cannot be named by a link); a document is an
(id, text hash) pair, so rows with equal id and text are one document, rows with
equal id and different texts are several; texts of any length enter with all
their shingles; an empty table gives no rows; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.session import materialize

SHINGLE, THRESHOLD, PERMUTATIONS, ROWS, STAR_ROUNDS, SIGMAS, PLANES = 5, 85, 128, 7, 2, 4.0, 4
_NODE = "struct<id:bigint,h:bigint>"  # a document: its id and the hash of its text
_SLICE = 1 << 15  # set elements hashed at a time: the working arrays stay in cache


def block_sets(data: np.ndarray, offs: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row of a block."""
    row, codes, distinct = wd.word_codes(wd.lower_ascii(data), offs)
    h = wd.hash64(distinct)[codes]
    win = wd.windows(h, shingle)
    at = np.searchsorted(row, np.arange(len(offs)))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(win[a:b - shingle + 1]))
        elif b > a:
            out.append(wd.windows(h[a:b], b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minmax(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signature of each nonempty set: [min_0, max_0, min_1, max_1, ...] by function.

    Elements are well mixed 64-bit hashes; their upper halves are permuted by
    odd multiples plus an offset modulo 2^32.
    """
    sig = np.empty((len(sets), 2 * len(a)), dtype=np.uint32)
    first = 0
    while first < len(sets):
        last, n = first, 0
        while last < len(sets) and (last == first or n + len(sets[last]) <= _SLICE):
            n += len(sets[last])
            last += 1
        x = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        at = np.zeros(last - first, dtype=np.int64)
        np.cumsum([len(s) for s in sets[first:last - 1]], out=at[1:])
        v = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=v)
            np.add(v, b[k], out=v)
            sig[first:last, 2 * k] = np.minimum.reduceat(v, at)
            sig[first:last, 2 * k + 1] = np.maximum.reduceat(v, at)
        first = last
    return sig


def functions(permutations: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2 ** 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 2 ** 32, permutations, dtype=np.uint32)


def sketch(sig: np.ndarray) -> np.ndarray:
    """``PLANES`` mixed bits of every value, one plane of 64-bit integers after the other."""
    v = wd.mix64(sig.astype(np.uint64) + wd._GOLDEN)
    pad = -sig.shape[1] % 64
    planes = []
    for bit in range(PLANES):
        bits = ((v >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        if pad:
            bits = np.pad(bits, ((0, 0), (0, pad)))
        planes.append(np.packbits(bits, axis=1).view(np.int64))
    return np.concatenate(planes, axis=1)


def alike(x: str, y: str, values: int, threshold: int, sigmas: float = SIGMAS) -> Column:
    """Sketches that agree in as many values as a pair at the threshold does, less ``sigmas`` deviations."""
    chance = 0.5 ** PLANES  # that two different values agree in all their bits
    p = threshold / 100 * (1 - chance) + chance
    least = int(values * p - sigmas * (values * p * (1 - p)) ** 0.5)
    n = -(-values // 64)
    differ = [" | ".join(f"({x}[{k * n + i}] ^ {y}[{k * n + i}])" for k in range(PLANES)) for i in range(n)]
    same = " + ".join(f"bit_count(~({d}))" for d in differ)
    return F.expr(f"{same} >= {least + n * 64 - values}")


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    bands = sig.shape[1] // rows
    out = np.empty((len(sig), bands), dtype=np.uint64)
    for b in range(bands):
        acc = np.full(len(sig), b + 1, dtype=np.uint64)
        for i in range(rows):
            acc = wd.mix64(acc * wd._GOLDEN + sig[:, b * rows + i].astype(np.uint64))
        out[:, b] = acc
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """id, text hash, n_shingles, digest of the set (null: empty set), band keys, bit sketch."""
    a, b = functions(permutations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, "text"):
            sets = block_sets(data, offs, shingle)
            full = [s for s in sets if len(s)]
            sig = minmax(full, a, b)
            has = np.array([len(s) > 0 for s in sets], dtype=bool)

            def lists(values: np.ndarray) -> pa.Array:
                offsets = np.zeros(len(sets) + 1, dtype=np.int32)
                np.cumsum(has * values.shape[1], out=offsets[1:])
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).view(np.int64)))

            yield pa.RecordBatch.from_arrays([
                rb.column(0), rb.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                lists(band_keys(sig, rows)), lists(sketch(sig))],
                names=["doc_id", "h", "n_shingles", "digest", "bands", "bits"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      text_hash(F.col(text_col)).alias("h"))
    return src.mapInArrow(
        run, "doc_id long, h long, n_shingles long, digest binary, bands array<long>, bits array<long>")


def text_hash(text: Column) -> Column:
    """The hash that tells the texts of one id apart (null: empty)."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def node(doc_id: Column, h: Column) -> Column:
    """Documents by id, then text hash."""
    return F.struct(doc_id.alias("id"), h.alias("h"))


def sets_of(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """node and its sorted shingle hashes as little-endian 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, "text"):
            sets = block_sets(data, offs, shingle)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "elements"])

    return docs.select("node", "text").mapInArrow(run, f"node {_NODE}, elements binary")


def near_size(a: Column, b: Column, threshold: int) -> Column:
    """Sets whose sizes alone allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ok = np.zeros(rb.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(rb.column(2), rb.column(3))):
                s = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                t = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok[i] = 100 * both >= threshold * (len(s) + len(t) - both)
            kept = rb.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    two = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "ea", "eb")
    return both.mapInArrow(run, f"a {_NODE}, b {_NODE}")


def components(links: DataFrame, name: str = "near-components") -> DataFrame:
    """(node, component): the smallest node reachable; nodes without links are absent.

    Alternating large-star and small-star steps (Kiveris et al., 2014): hubs
    are handled by a minimum per node and a join, never by gathering a
    node's neighbours.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u > v").distinct(), name)
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def classes(sigs: DataFrame) -> DataFrame:
    """One row per distinct nonempty set: digest, rep (smallest node), n_shingles, bands, bits."""
    return (sigs.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
            .agg(F.min(F.struct("doc_id", "h", "n_shingles", "bands", "bits")).alias("r"))
            .select("digest", node(F.col("r.doc_id"), F.col("r.h")).alias("rep"), F.col("r.n_shingles").alias("n"),
                    F.col("r.bands").alias("bands"), F.col("r.bits").alias("bits")))


def shared_buckets(reps: DataFrame) -> DataFrame:
    """Band buckets with two or more representatives: bucket, rep, n."""
    members = reps.select(F.explode("bands").alias("bucket"), "rep", "n")
    several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    return members.join(several, "bucket")


def star(buckets: DataFrame, labels: DataFrame | None, turn: int, threshold: int) -> DataFrame:
    """Pairs (leader, member) of each bucket across components; the leader changes by turn."""
    if labels is None:
        rows = buckets.withColumn("label", F.col("rep"))
    else:
        rows = buckets.join(labels, buckets.rep == labels.node, "left").select(
            "bucket", "rep", "n", F.coalesce("component", "rep").alias("label"))
    order = F.col("rep") if turn == 0 else F.xxhash64(F.lit(turn), F.col("rep"))
    lead = rows.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "rep", "n", "label")).alias("l"))
    return (rows.join(lead, "bucket")
            .where((F.col("label") != F.col("l.label")) & near_size(F.col("n"), F.col("l.n"), threshold))
            .select(F.least("rep", "l.rep").alias("a"), F.greatest("rep", "l.rep").alias("b")).distinct())


def across(buckets: DataFrame, labels: DataFrame, bits: DataFrame, values: int, threshold: int) -> DataFrame:
    """All pairs of one bucket that lie in different components and look alike (see the module text)."""
    rows = buckets.join(labels, buckets.rep == labels.node, "left").select(
        "bucket", "rep", "n", F.coalesce("component", "rep").alias("label"))
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    rows = materialize(rows.join(mixed.select("bucket"), "bucket").join(bits, "rep"), "near-mixed")
    one = rows.select("bucket", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"),
                      F.col("bits").alias("x"), F.col("bands").alias("p"))
    two = rows.select("bucket", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"),
                      F.col("bits").alias("y"), F.col("bands").alias("q"))
    # a pair is taken in the first band it shares only; the dearer test comes last
    once = F.expr("element_at(filter(zip_with(p, q, (s, t) -> if(s = t, s, null)), s -> s IS NOT NULL), 1)")
    return (one.join(two, (one.bucket == two.bucket) & (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb"))
                     & near_size(F.col("na"), F.col("nb"), threshold) & alike("x", "y", values, threshold)
                     & (once == one.bucket))
            .select("a", "b"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           threshold: int = THRESHOLD, permutations: int = PERMUTATIONS, rows: int = ROWS,
           star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """doc_id, h, n_shingles, component_id, kept -- one row per distinct (id, text hash) and per null-id row."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs = materialize(signatures(src, shingle=shingle, permutations=permutations, rows=rows), "near-signatures")
    reps = materialize(classes(sigs), "near-classes")
    buckets = materialize(shared_buckets(reps.select("rep", "n", "bands")), "near-buckets")

    cand = buckets.select(F.col("rep").alias("node")).distinct()
    named = src.where("doc_id IS NOT NULL").select(node(F.col("doc_id"), text_hash(F.col("text"))).alias("node"), "text")
    sets = materialize(sets_of(named.join(cand, "node", "left_semi"), shingle).dropDuplicates(["node"]), "near-sets")
    labels, links, tried = None, None, None
    for turn in range(star_rounds + 1):
        pairs = star(buckets, labels, turn, threshold) if turn < star_rounds else across(
            buckets, labels, reps.select("rep", "bits", "bands"), 2 * permutations, threshold)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "near-pairs")
        found = materialize(confirm(pairs, sets, threshold), "near-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    member = reps.join(labels, reps.rep == labels.node, "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    ids = (sigs.where("doc_id IS NOT NULL").groupBy("doc_id", "h")
           .agg(F.min(F.struct("digest", "n_shingles")).alias("s")).select("doc_id", "h", "s.n_shingles", "s.digest"))
    ids = ids.unionByName(sigs.where("doc_id IS NULL").select(
        "doc_id", "h", "n_shingles", F.lit(None).cast("binary").alias("digest")))
    out = ids.join(member, "digest", "left")
    own = node(F.col("doc_id"), F.col("h"))
    comp = F.coalesce("component_id", own)
    return out.select("doc_id", "h", "n_shingles", comp["id"].alias("component_id"),
                      (F.col("doc_id").isNull() | (comp == own)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept -- one row per distinct id and text (and per null-id row)."""
    return judged(docs, id_col, text_col, **options).drop("h")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each component stays.

    Rows with equal id and text are one document, of which one row stays; a row
    goes only if its own text is in a group.  Rows with a null id stay.  Documents
    go by (id, text hash), and only those to leave out are joined to the texts.
    """
    drop = materialize(judged(docs, id_col, text_col, **options), "near-verdicts").where("NOT kept").select("doc_id", "h")
    own = {f"c{i}": c for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in own.items()],
                       F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text_hash(F.col(f"`{text_col}`")).alias("h"))
    again = materialize(rows.where("doc_id IS NOT NULL").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("c"))
                        .where("c > 1").select("doc_id", "h"), "near-repeated")
    once = rows.join(drop.unionByName(again).distinct(), ["doc_id", "h"], "left_anti")
    several = rows.join(again.join(drop, ["doc_id", "h"], "left_anti"), ["doc_id", "h"], "left_semi")
    both = once.select(*own).unionByName(several.dropDuplicates(["doc_id", "h"]).select(*own))
    return both.select(*[F.col(k).alias(c) for k, c in own.items()])
