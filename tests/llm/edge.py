"""Small tables with every awkward row, and plain brute-force versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, vocab: int = 4000) -> str:
    """``n`` words in sentences and lines."""
    r, out = random.Random(seed), []
    while len(out) < n:
        k = min(r.randint(4, 14), n - len(out))
        s = [f"w{r.randint(0, vocab)}" for _ in range(k)]
        s[0] = s[0].capitalize()
        out += s[:-1] + [s[-1] + r.choice([". ", ".\n"])]
    return re.sub(r"(?<=\s) ", "", " ".join(out)).strip()


def edited(text: str, seed: int, every: int) -> str:
    """The text with about one word in ``every`` replaced."""
    r = random.Random(seed)
    return " ".join(f"x{r.randint(0, 10 ** 6)}" if r.randint(1, every) == 1 else w for w in text.split(" "))


def edge_rows() -> list[tuple]:
    long = prose(99, 30_000)
    rows = [
        (1, prose(1, 120), "en", "a"), (2, prose(1, 120), "en", "a"), (3, prose(2, 90), "de", None),
        (4, None, "en", "b"), (5, "", None, "b"), (6, " \t\n\r\x0b\x0c", "fr", "b"), (7, "one", "en", ""),
        (8, "one two three four", "en", "a"), (9, "ONE two three four", "en", "a"),
        (10, long, "en", "a"), (11, long + " tail", "en", "b"), (12, prose(1, 120), "en", "a"),
        (12, prose(1, 120), "en", "a"), (13, prose(5, 70) + "\n\x00 é日本  x\x1c🙂 <|endoftext|> it's", "es", "c"),
        (None, prose(7, 60), "en", "a"), (None, None, None, None), (14, "the " * 400, "en", "c"),
        (15, prose(8, 200) + "\n" + prose(3, 80), "en", "c"), (16, prose(9, 150) + "\n" + prose(3, 80), "en", "b"),
        (-3, prose(2, 90), "de", "c"),
    ]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def edge_table(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def clash(df, *names):
    """The table with further columns of these names."""
    for n in names:
        df = df.selectExpr("*", f"'mine' AS `{n}`")
    return df


def shingles(text: str | None, n: int = 5) -> frozenset:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def components(docs: dict, threshold: int = 85) -> dict:
    """id -> smallest id reachable over links of the similarity."""
    sets = {i: shingles(t) for i, t in docs.items()}
    top = {i: i for i in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in ids}


def units(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, normalised sentence, does it begin a line) of a text, character by character."""
    spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
    fresh = [k == 0 or "\n" in text[spans[k - 1][1]:spans[k][0]] for k in range(len(spans))]
    begins = [k for k in range(len(spans)) if fresh[k] or text[spans[k - 1][1] - 1] in ".!?"]
    out = []
    for k, b in enumerate(begins):
        e = begins[k + 1] if k + 1 < len(begins) else len(spans)
        end = spans[e][0] if e < len(spans) else len(text)
        words = [text[x:y] for x, y in spans[b:e]]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in " ".join(words))
        out.append((spans[b][0], end, low, fresh[b]))
    return out


def passages(docs: list[tuple], min_chars: int) -> list[tuple]:
    """(id, text, rest, removed spans) of every (id, text): later lines go, and runs of ``min_chars`` of what was seen."""
    seen, seen_lines, out = set(), set(), {}
    for i, t in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        if t is None:
            out[(i, t)] = (None, [])
            continue
        us = units(t)
        lines = [k for k, u in enumerate(us) if u[3]] + [len(us)]
        gone, again = [False] * len(us), []
        for a, b in zip(lines[:-1], lines[1:]):
            line = " ".join(u[2] for u in us[a:b])
            gone[a:b] = [line in seen_lines] * (b - a)
            seen_lines.add(line)
        for u in us:
            again.append(u[2] in seen)
            seen.add(u[2])
        k = 0
        drop = list(gone)
        while k < len(us):
            j = k
            while j < len(us) and (gone[j] or again[j]):
                j += 1
            if j > k and us[j - 1][1] - us[k][0] >= min_chars:
                drop[k:j] = [True] * (j - k)
            k = max(j, k + 1)
        spans, k = [], 0
        while k < len(us):
            j = k
            while j < len(us) and drop[j]:
                j += 1
            if j > k:
                spans.append((us[k][0], us[j - 1][1]))
            k = max(j, k + 1)
        rest, at = "", 0
        for a, b in spans:
            rest, at = rest + t[at:a], b
        out[(i, t)] = (rest + t[at:], spans)
    return [(i, t, *out[(i, t)]) for i, t in docs]
