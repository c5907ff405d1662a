"""Document fingerprints by I-Match with randomised lexicons.

Terms are the lower-cased runs of letters and digits.  Their frequency over
the distinct texts of the whole table decides the lexicon: terms held by a
share of ``LOW`` to ``HIGH`` of the texts -- neither too rare to survive an edit nor
too common to tell texts apart.  Copies count once, so the terms of a text do
not leave the lexicon because the text has many copies.  ``len(RATES)`` random subsets of the lexicon
are fixed by hashes of the terms, with inclusion rates one in ``RATES[k]``.  A
document's signature for a subset is the hash of its sorted distinct terms in
that subset; the fingerprint lists the signatures (``-`` where it has none of
the subset's terms).  The likeness of two fingerprints is the share of subsets
with equal signatures among those where either document has terms; equal
fingerprints have likeness 1.  A text without any term of the lexicon has
a print of its own, the hash of all its terms (of the text, if it has none), so
that unrelated texts never compare as equal.

Why the lexicon may be broadcast: a term in it is held by at least LOW * N
documents, so it has at most (mean distinct terms of a document) / LOW terms,
however many documents there are.  Its rows are counted; above
``BROADCAST_TERMS`` (documents with very many distinct terms) it is joined by
a shuffle instead.  It holds a row for each term and subset, so one join hands
every term of a text to its subsets; sorted by subset and term they give all
signatures as slices of one array.

Everything is DataFrame operations.  The neighbour of a document in descending
id order is found inside ranges of ids (sampled splitters; documents of one
id are cut by the hash of their text), only the first document of each range
is passed on to the range before it.

Defined cases: null text is empty; equal ids are ordered by the hash of their
text, null ids come last; repeated rows are documents of their own; a single
document is its own neighbour; an empty table gives no rows; other input
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.sharding import LEAST, chance, number_of_ranges, range_of, splitters
from orderflow.session import materialize

LOW, HIGH = 0.005, 0.1
RATES = (8,) * 8 + (32,) * 12 + (128,) * 12
BROADCAST_TERMS = 1_000_000
_NOT_TERM = "[^\\p{L}\\p{N}]+"


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.split(F.lower(text), _NOT_TERM))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """term (64-bit hash), subset: the subsets that hold each term of the lexicon."""
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # copies collapse before the shuffle
    held = texts.agg(F.countDistinct(F.xxhash64("text"))).first()[0]
    texts = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    df = (texts.select(F.explode(terms(F.col("text"))).alias("w")).where("w <> ''")
          .groupBy(F.xxhash64("w").alias("term")).agg(F.count(F.lit(1)).alias("df")))
    kept = df.where((F.col("df") >= low * held) & (F.col("df") <= max(1.0, high * held)))
    inside = [F.when(F.expr(f"pmod(xxhash64({k}, term), {r}) = 0"), F.lit(k)) for k, r in enumerate(RATES)]
    subsets = F.explode(F.array_compact(F.array(*inside))).alias("subset")
    return materialize(kept.select("term", subsets), "imatch-lexicon")


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """bucket, nth (from 0, descending id), doc_id, text, next_text (of the document nth + 1, cyclic); and
    the number of documents.

    The rows are partitioned by ``bucket``; what is grouped by it and more needs no further shuffle.
    """
    # ``key`` ascends where the id descends; a null id comes last
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = d.select("doc_id", "text", F.coalesce(F.bitwise_not("doc_id"), F.lit(-LEAST - 1)).alias("key"),
                 F.xxhash64("text").alias("tie"))
    n = d.select("doc_id").count()
    ranges = number_of_ranges(n)
    sample = d.select("key", "tie").where(chance(F.xxhash64(F.lit(3), "key", "tie")) < min(1.0, 64 * ranges / max(1, n)))
    bounds = splitters(sample, ranges)
    d = d.select(range_of(F.col("key"), F.col("tie"), bounds).alias("bucket"), "doc_id", "key", "tie", "text")
    w = "PARTITION BY bucket ORDER BY key, tie"
    out = d.selectExpr("*", f"lead(text) OVER ({w}) AS follower", f"row_number() OVER ({w}) - 1 AS inside")
    heads = materialize(d.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("key", "tie")).alias("head")),
                        "imatch-ranges")
    total = "OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    order = heads.selectExpr("bucket", f"SUM(rows) {total} - rows AS base", "rows",
                             "lead(bucket) OVER (ORDER BY bucket) AS after", "min(bucket) OVER () AS least")
    # the text at the head of every range: one record each
    first = (d.withColumn("head", F.struct("key", "tie")).join(F.broadcast(heads.select("bucket", "head")), ["bucket", "head"])
             .groupBy("bucket").agg(F.first("text").alias("head_text")))
    nxt = order.selectExpr("bucket", "base", "coalesce(after, least) AS after").join(
        first.withColumnRenamed("bucket", "after"), "after").select("bucket", "base", "head_text")
    # a merge join keeps the rows where the window left them
    return out.join(nxt.hint("merge"), "bucket").select(
        "bucket", (F.col("base") + F.col("inside")).alias("nth"), "doc_id", "text",
        F.coalesce("follower", "head_text").alias("next_text")), n


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by the first characters of the next."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(next_text, F.lit(1), half))


def fingerprints(texts: DataFrame, keys: list[str], lex: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keys (which tell the texts apart), ``keep`` and the fingerprint of the column ``text``."""
    # the empty term marks every text, so one without lexicon terms has its row, too
    marked = lex.unionByName(lex.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("term"), F.lit(-1).alias("subset")))
    if lex.count() <= BROADCAST_TERMS * 2:  # a term is in one or two subsets
        marked = F.broadcast(marked)
    every = F.array_sort(F.array_remove(terms(F.col("text")), ""))
    alone = F.when(F.size(every) > 0, F.concat(F.lit("="), F.hex(F.xxhash64(every)))).otherwise(
        F.concat(F.lit("~"), F.hex(F.xxhash64("text"))))
    # what else is known of the text goes with its mark only, so the rows that are sorted stay narrow
    about = F.named_struct(*[x for c in keep or [] for x in (F.lit(c), F.col(c))], F.lit("alone"), alone).alias("about")
    words = texts.select(*keys, "text", about).select(
        *keys, "about", F.posexplode(F.array_union(F.array(F.lit("")), terms(F.col("text")))).alias("at", "w"))
    words = words.select(*keys, F.when(F.col("at") == 0, F.col("about")).alias("about"), F.xxhash64("w").alias("term"))
    hits = words.join(marked, "term")
    # a text's terms by subset and term in one sorted array; a mark opens every subset (and one closes the last),
    # so the terms of subset k stand between the marks of k and k + 1
    n = len(RATES)
    marks = F.array(*[F.struct(F.lit(k).alias("subset"), F.lit(LEAST).cast("bigint").alias("term")) for k in range(n + 1)])
    held = hits.groupBy(*keys).agg(F.collect_list(F.struct("subset", "term")).alias("t"),
                                   F.first("about", ignorenulls=True).alias("about"))
    held = held.select(*keys, "about", F.array_sort(F.concat("t", marks)).alias("t"))
    held = held.select(*keys, "about", F.col("t.subset").alias("s"), F.col("t.term").alias("t"))
    held = held.select(*keys, "about", "t", F.array(*[F.array_position("s", F.lit(k)) for k in range(n + 1)]).alias("p"))

    def signature(k: int) -> str:
        own = f"xxhash64({k}, slice(t, CAST(p[{k}] AS INT) + 1, CAST(p[{k + 1}] - p[{k}] AS INT) - 1))"
        return (f"CASE WHEN p[{k + 1}] - p[{k}] > 1 THEN lpad(hex(shiftrightunsigned({own}, 32)), 8, '0') ELSE '-' END")

    whole = ", ".join(signature(k) for k in range(n))
    return held.select(*keys, *[F.col(f"about.{c}").alias(c) for c in keep or []],
                       F.expr(f"CASE WHEN p[{n}] - p[0] = {n} THEN about.alone ELSE concat_ws('.', {whole}) END")
                       .alias("fingerprint"))


def likeness(a: str, b: str) -> Column:
    """Share of subsets with equal signatures among those where either has one; 1 for equal fingerprints."""
    pairs = f"zip_with(split({a}, '[.]'), split({b}, '[.]'), (x, y) -> " \
            "CASE WHEN x = '-' AND y = '-' THEN 0 WHEN x = y THEN 1 ELSE 2 END)"
    return F.expr(f"CASE WHEN {a} = {b} THEN 1.0D ELSE "
                  f"size(filter({pairs}, z -> z = 1)) / greatest(1, size(filter({pairs}, z -> z > 0))) END")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    lex = lexicon(docs, text_col)
    d, n = neighbours(docs, id_col, text_col)
    d = d.select("bucket", "nth", "doc_id", "text", edited(F.col("text"), F.col("next_text")).alias("edited"))
    d = d.select("bucket", "nth", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
                 F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                 F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
                                   F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("x"))
    d = d.select("bucket", "nth", "doc_id", "n_chars", "edited_sha256", "x.which", "x.text")
    # the terms of a text stay where its bucket is: no shuffle between explode and gathering
    f = fingerprints(d, ["bucket", "nth", "which"], lex, ["doc_id", "n_chars", "edited_sha256"])
    f = materialize(f.drop("bucket"), "imatch-prints")
    own = f.where("which = 0").drop("which")
    other = f.where("which = 1").select("nth", F.col("fingerprint").alias("edited_fingerprint"))
    after = own.select(F.expr(f"pmod(nth - 1, {max(1, n)})").alias("nth"), F.col("fingerprint").alias("next_print"))
    return own.join(other, "nth").join(after, "nth").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_print").alias("near_next"))
