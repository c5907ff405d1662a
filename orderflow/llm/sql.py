"""DuckDB SQL twins of the operators that SQL can express."""

from __future__ import annotations

from orderflow.llm import quality, search

_WORD = r"[^\x20\x09-\x0D]+"


def quality_sql(min_rows: int = quality.MIN_ROWS, reach: int = quality.REACH) -> str:
    """Counts, base rule and adaptive verdict of every document."""
    m = quality.METRICS
    values = "\nUNION ALL ".join(
        f"SELECT lang, source, '{k}' AS metric, CASE WHEN n_words > 0 THEN {num} * {f} // n_words ELSE 0 END AS v "
        f"FROM counts WHERE NOT base_failed" for k, (num, f, _, _) in m.items())

    def quart(keys: str) -> str:
        k = f"{keys}, " if keys else ""
        return (f"SELECT {k}metric, max(total) AS total, min(bin) FILTER (4 * below >= total) AS q25, "
                f"min(bin) FILTER (4 * below >= 3 * total) AS q75 FROM (SELECT {k}metric, bin, "
                f"sum(n) OVER (PARTITION BY {k}metric ORDER BY bin) AS below, "
                f"sum(n) OVER (PARTITION BY {k}metric) AS total "
                f"FROM (SELECT {k}metric, bin, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL")

    spread = " ".join(f"WHEN '{k}' THEN {x[2]}" for k, x in m.items())
    value = {k: f"(CASE WHEN c.n_words > 0 THEN c.{num} * {f} // c.n_words ELSE 0 END)"
             for k, (num, f, _, _) in m.items()}
    checks = [f"coalesce({value[k]} <= f.high_{k}, true)" for k in m]
    checks += [f"coalesce({value[k]} >= f.low_{k}, true)" for k, x in m.items() if x[3]]
    pivot = ", ".join([f"max(high) FILTER (metric = '{k}') AS high_{k}" for k in m]
                      + [f"max(low) FILTER (metric = '{k}') AS low_{k}" for k, x in m.items() if x[3]])
    pick = {q: f"CASE WHEN o.total >= {min_rows} THEN o.{q} WHEN p.total >= {min_rows} THEN p.{q} ELSE e.{q} END"
            for q in ("q25", "q75")}
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, text, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
tri AS (SELECT rid, i, ws[i:i + 2] AS t FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM tri) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM hit, (VALUES (0), (1), (2)) x(k) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM
  (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY rid),
counts AS (SELECT d.doc_id, d.lang, d.source, len(w.ws) AS n_words,
    length(array_to_string(w.ws, '')) AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(w.ws) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w.ws) AS base_failed
  FROM d JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
vals AS ({values}),
sketch AS (SELECT lang, source, metric,
    (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bin, count(*) AS n
  FROM vals GROUP BY ALL),
o AS ({quart("lang, source")}), p AS ({quart("lang")}), e AS ({quart("")}),
g AS (SELECT DISTINCT lang, source FROM counts),
q AS (SELECT g.lang, g.source, x.metric, {pick["q25"]} AS q25, {pick["q75"]} AS q75,
    CASE x.metric {spread} END AS spread
  FROM g CROSS JOIN (VALUES {", ".join(f"('{k}')" for k in m)}) x(metric)
  LEFT JOIN o ON o.lang IS NOT DISTINCT FROM g.lang AND o.source IS NOT DISTINCT FROM g.source AND o.metric = x.metric
  LEFT JOIN p ON p.lang IS NOT DISTINCT FROM g.lang AND p.metric = x.metric
  LEFT JOIN e ON e.metric = x.metric),
fence AS (SELECT lang, source, {pivot} FROM (SELECT lang, source, metric,
    q25 - {reach} * greatest(q75 - q25, spread) AS low, q75 + {reach} * greatest(q75 - q25, spread) AS high FROM q)
  GROUP BY lang, source)
SELECT c.doc_id, CAST(c.n_words AS BIGINT) AS n_words, CAST(c.word_chars AS BIGINT) AS word_chars,
  CAST(c.n_symbols AS BIGINT) AS n_symbols, CAST(c.n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(c.n_repeat_words AS BIGINT) AS n_repeat_words, c.base_failed,
  NOT c.base_failed AND {" AND ".join(checks)} AS kept
FROM counts c LEFT JOIN fence f ON f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source
"""


def search_sql(k: int = search.TOP) -> str:
    """The k highest-scoring documents of every item of ``benchmark``, from all postings."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def terms(table: str, key: str) -> str:
        return (f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), "
                f"'{search.TERM}')) AS term FROM {table}")

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
all_terms AS ({terms("d", "rid")}),
n AS (SELECT rid, count(*) AS n FROM all_terms GROUP BY rid),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
items AS (SELECT DISTINCT * FROM ({terms("benchmark", "item_id")})),
post AS (SELECT rid, term, count(*) AS tf FROM all_terms
  WHERE term IN (SELECT term FROM items) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM post GROUP BY term), c),
impact AS (SELECT rid, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))) AS impact
  FROM post JOIN w USING (term) JOIN n USING (rid), c),
s AS (SELECT item_id, rid, CAST(sum(impact) AS BIGINT) AS score FROM items JOIN impact USING (term) GROUP BY item_id, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN d USING (rid) WHERE score > 0) WHERE rank <= {k}
"""


def lm_sql(alpha: float = 0.4) -> str:
    """Trigram stupid backoff with the document's own occurrences left out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def others(*words: str) -> str:
        k = ", ".join(words)
        return f"count(*) OVER (PARTITION BY {k}) - count(*) OVER (PARTITION BY rid, {k})"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{_WORD}') AS ws FROM documents),
w AS (SELECT rid, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS p, CASE WHEN i > 2 THEN ws[i - 2] END AS q
  FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
one AS (SELECT rid, i, p, q, {others("w")} AS c1,
    CASE WHEN p IS NOT NULL THEN {others("p", "w")} END AS c2,
    CASE WHEN q IS NOT NULL THEN {others("q", "p", "w")} END AS c3,
    greatest(count(*) OVER () - count(*) OVER (PARTITION BY rid), 1) AS n FROM w),
two AS (SELECT *, lag(c1) OVER (PARTITION BY rid ORDER BY i) AS b1, lag(c2) OVER (PARTITION BY rid ORDER BY i) AS b2 FROM one),
s2 AS (SELECT *, CASE WHEN p IS NULL THEN greatest(c1, 1) / n WHEN c2 > 0 THEN c2 / b1
    ELSE {alpha} * (greatest(c1, 1) / n) END AS s2 FROM two),
s AS (SELECT rid, CASE WHEN q IS NULL THEN s2 WHEN c3 > 0 THEN c3 / b2 ELSE {alpha} * s2 END AS s FROM s2)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, round(coalesce(t.x, 0), 6) + 0.0 AS log_score
FROM d LEFT JOIN (SELECT rid, sum(ln(s)) AS x FROM s GROUP BY rid) t USING (rid)
"""


def near_sql(shingle: int = 5, threshold: int = 85) -> str:
    """Components of the documents linked by the similarity of their shingle sets, by comparing all that share one."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {shingle - 1}], ' ') AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {shingle - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL),
e AS (SELECT c.a, c.b FROM c JOIN n p ON p.doc_id = c.a JOIN n q ON q.doc_id = c.b
  WHERE 100 * c.k >= {threshold} * (p.n + q.n - c.k)),
r(id, m) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.m FROM r JOIN e ON r.id = e.a),
m AS (SELECT id, min(m) AS m FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.m AS component_id, w.doc_id = m.m AS kept
FROM w JOIN m ON m.id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""
