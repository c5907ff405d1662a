"""Exact token counts from finite-state transducers compiled from a tokenizer file.

Two deterministic transducers count the tokens of a byte-level tokenizer
without producing its ids:

*Splitter.*  The tokenizer's splitting pattern as a machine over character
classes.  A transition is annotated with the pieces it closes: a cut before
the character just read and/or before the one preceding it (a run of white
space gives its last character away, ``'r`` is a contraction only if ``e``
follows).  Texts are cut into chunks of ``CHUNK`` characters; every chunk
yields its state map (from each entry state to the exit state), the maps are
composed by a parallel prefix scan, and with every chunk's entry state known
all chunks are replayed side by side.  The first character of a text uses a
class of its own that resets the machine, so one scan runs over many texts.

*Merger.*  The merge list as a machine over the bytes of one piece.  A
transition is annotated with the number of tokens it emits: the change in the
token count of the prefix read so far (zero or negative when the new byte
completes a longer token).  It rests on a property of merge lists: the
encoding of a prefix is determined by its last token, and token t may follow
token s exactly if no merge across their border comes before the merges that
close both.  A state holds the tokens that may still be under way, each with
the token before it; states are made on first use and shared by all pieces
(``STATES`` bounds them; beyond it the machine starts anew).

Piece counts are kept per distinct piece of a block.  Special-token strings
inside a text count one token each and separate what stands around them.

Defined cases: null text is empty and has no bytes and tokens; repeated rows are
counted each, a null id is kept; a text of any length is read whole; an
empty table gives no rows; only the id and the text are read, so other columns
may have any names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.llm.tokens import BYTE_PATTERN, byte_letters

CHUNK, STATES, PIECES = 32, 400_000, 600_000

# ---- splitter ------------------------------------------------------------

# Character classes; a text's first character uses class + N_CLASSES.
LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE, ONE, R_V, E, ELL = range(10)
N_CLASSES = 10
_LETTERS = (LETTER, ONE, R_V, E, ELL)
# States: what the piece under way is.  SPACE_1: one plain space; WHITE_1: one
# other white space; *_N: a run of two or more, by its last character; Q: an
# apostrophe that began a piece; Q_RV, Q_L: the letter behind it; DONE: a
# contraction that is complete.
START, IN_L, IN_N, IN_O, SPACE_1, WHITE_1, SPACE_N, WHITE_N, Q, Q_RV, Q_L, DONE = range(12)
N_STATES = 12


def _begin(c: int) -> int:
    """The state after a character that begins a piece."""
    if c in _LETTERS:
        return IN_L
    return {NUMBER: IN_N, SPACE: SPACE_1, WHITE: WHITE_1, OTHER: IN_O, QUOTE: Q}[c]


def _splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(next state, cut before the character, cut before its predecessor) by state and class."""
    go = np.zeros((N_STATES, 2 * N_CLASSES), dtype=np.uint8)
    here = np.zeros((N_STATES, 2 * N_CLASSES), dtype=bool)
    back = np.zeros((N_STATES, 2 * N_CLASSES), dtype=bool)
    for s in range(N_STATES):
        for c in range(N_CLASSES):
            go[s, c + N_CLASSES], here[s, c + N_CLASSES] = _begin(c), True
            white = c in (SPACE, WHITE)
            nxt, cut, cut_back = _begin(c), True, False
            if s == IN_L and c in _LETTERS or s == IN_N and c == NUMBER:
                nxt, cut = s, False
            elif s in (IN_O, Q) and c in (OTHER, QUOTE):
                nxt, cut = IN_O, False
            elif s == Q and c in (ONE, R_V, ELL):
                # with ONE the contraction is complete, otherwise the next letter decides
                nxt, cut = {ONE: DONE, R_V: Q_RV, ELL: Q_L}[c], False
            elif s == Q_RV and c == E or s == Q_L and c == ELL:
                nxt, cut = DONE, False
            elif s in (Q_RV, Q_L):
                cut_back = True  # the apostrophe stood alone; its letter began a word
                if c in _LETTERS:
                    nxt, cut = IN_L, False
            elif s in (SPACE_1, WHITE_1, SPACE_N, WHITE_N):
                if white:
                    nxt, cut = (SPACE_N if c == SPACE else WHITE_N), False
                else:
                    cut_back = s in (SPACE_N, WHITE_N)
                    cut = s in (WHITE_1, WHITE_N)
                    if not cut and c == QUOTE:
                        nxt = IN_O  # a space took the apostrophe as its piece
            go[s, c], here[s, c], back[s, c] = nxt, cut, cut_back
    return go, here, back


def character_classes(tokenizer) -> np.ndarray:
    """The class of every code point, the library's own view where Unicode versions could differ."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    ask = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F,
           0x205F, 0x3000, 0xFEFF]
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        cat = unicodedata.category(ch)
        k = kind.get(cat[0], OTHER)
        out[cp] = k
        if cat == "Cn" and (letter.match(ch) or number.match(ch)):
            ask.append(cp)
    pre = tokenizer.pre_tokenizer
    for cp in ask:
        ch = chr(cp)
        if len(pre.pre_tokenize_str(f"x{ch}x")) == 1:
            out[cp] = LETTER
        elif len(pre.pre_tokenize_str(f"1{ch}1")) == 1:
            out[cp] = NUMBER
        elif len(pre.pre_tokenize_str(f"\n{ch}")) == 1:
            out[cp] = WHITE
        else:
            out[cp] = OTHER
    out[[9, 10, 11, 12, 13]] = WHITE
    out[0x20] = SPACE
    for chars, c in (("'", QUOTE), ("stmd", ONE), ("rv", R_V), ("e", E), ("l", ELL)):
        out[[ord(x) for x in chars]] = c
    return out


_GO, _HERE, _BACK = _splitter()


def state_maps(classes: np.ndarray) -> np.ndarray:
    """Exit state of every chunk (row of ``classes``) for every entry state."""
    maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (len(classes), N_STATES)).copy()
    flat = _GO.reshape(-1)
    for t in range(classes.shape[1]):
        maps = flat[maps.astype(np.intp) * (2 * N_CLASSES) + classes[:, t, None]]
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """maps[i] after maps[i-1] after ... after maps[0], in log2(n) rounds of pairwise composition."""
    out, d = maps.copy(), 1
    while d < len(out):
        out[d:] = np.take_along_axis(out[d:], out[:-d].astype(np.intp), axis=1)
        d *= 2
    return out


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Flags of the characters that begin a piece."""
    n = len(classes)
    padded = np.full(-(-n // CHUNK) * CHUNK, LETTER, dtype=np.uint8)
    padded[:n] = classes
    rows = padded.reshape(-1, CHUNK)
    entry = np.zeros(len(rows), dtype=np.intp)
    entry[1:] = prefix_scan(state_maps(rows))[:-1, START]
    here, back = np.zeros(rows.shape, dtype=bool), np.zeros(rows.shape, dtype=bool)
    state = entry
    for t in range(CHUNK):
        at = state * (2 * N_CLASSES) + rows[:, t]
        here[:, t], back[:, t] = _HERE.reshape(-1)[at], _BACK.reshape(-1)[at]
        state = _GO.reshape(-1)[at].astype(np.intp)
    starts = here.reshape(-1)[:n].copy()
    starts[:-1] |= back.reshape(-1)[1:n]
    return starts


# ---- merger --------------------------------------------------------------


class Merger:
    """The merge list as a lazily determinised machine over bytes."""

    def __init__(self, vocab: dict[str, int], merges: list):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(pairs)}
        self.made = {vocab[a + b]: (vocab[a], vocab[b], i) for i, (a, b) in enumerate(pairs)}
        base = {vocab[c]: bytes([b]) for c, b in byte_of.items()}
        self.spines: dict[tuple[int, int], list] = {}
        self.pair: dict[tuple[int, int], bool] = {}
        sound = set(base)
        for t, (a, b, _) in self.made.items():
            if a in sound and b in sound and not self._crossed(a, b, own=True):
                sound.add(t)
        # trie of the tokens that encode to themselves: node -> {byte: node}, token at node
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        text = {t: "".join([s]) for s, t in vocab.items()}
        for t in sound:
            node = 0
            for ch in text[t]:
                b = byte_of[ch]
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = t
        self.start: dict = {}
        self.reset()

    def reset(self) -> None:
        # a state maps a byte to (state, emitted); key -1 holds its entries
        # (node, token before it, tokens up to there less tokens so far)
        self.start = {-1: ((0, -1, 0),)}
        self.states = {self.start[-1]: self.start}

    def _spine(self, t: int, side: int) -> list[tuple[int, int, float]]:
        """The tokens at one end of ``t`` while it is built: (token, rank that makes it, rank that uses it up)."""
        got = self.spines.get((t, side))
        if got is None:
            got, used, x = [], float("inf"), t
            while True:
                made = self.made.get(x)
                got.append((x, made[2] if made else -1, used))
                if not made:
                    break
                x, used = made[side], made[2]
            self.spines[(t, side)] = got
        return got

    def _crossed(self, s: int, t: int, own: bool = False) -> bool:
        """A merge across the border of ``s t`` comes first (``own``: other than that of s with t)."""
        rank = self.rank
        for x, x_made, x_used in self._spine(s, 1):
            for y, y_made, y_used in self._spine(t, 0):
                if own and x == s and y == t:
                    continue
                r = rank.get((x, y))
                # both must stand side by side at some time, and equal ranks act from the left
                if r is not None and r < x_used and r <= y_used and x_made <= y_used and y_made < x_used:
                    return True
        return False

    def _follows(self, s: int, t: int) -> bool:
        if s < 0:
            return True
        got = self.pair.get((s, t))
        if got is None:
            if len(self.pair) > 2 * STATES:
                self.pair.clear()
            got = self.pair[(s, t)] = not self._crossed(s, t)
        return got

    def _extend(self, state: dict, b: int) -> tuple[dict, int]:
        under_way, last, emitted = [], -1, 0
        for node, before, rel in state[-1]:
            nxt = self.child[node].get(b)
            if nxt is None:
                continue
            t = self.token[nxt]
            if t >= 0 and last < 0 and self._follows(before, t):
                last, emitted = t, rel + 1
            # whether any longer token may follow is asked where one ends: asking here costs more than the states it saves
            if self.child[nxt]:
                under_way.append((nxt, before, rel))
        entries = tuple((node, before, rel - emitted) for node, before, rel in under_way) + ((0, last, 0),)
        nxt = self.states.get(entries)
        if nxt is None:
            nxt = self.states[entries] = {-1: entries}
        state[b] = (nxt, emitted)
        return nxt, emitted

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: the emissions along its path."""
        if len(self.states) > STATES:
            self.reset()
        state, n = self.start, 0
        for b in piece:
            step = state.get(b)
            if step is None:
                step = self._extend(state, b)
            state, e = step
            n += e
        return n


class Counter:
    """Token counts of blocks of texts."""

    def __init__(self, path: str, classes: np.ndarray):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.classes = classes
        self.merger = Merger(spec["model"]["vocab"], spec["model"]["merges"])
        special = sorted((x["content"] for x in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)).encode()) if special else None
        self.cache: dict[bytes, int] = {}

    def _apart(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts without their special strings: bytes, offsets, row of each part, specials per row."""
        n = len(offs) - 1
        row, specials = np.arange(n), np.zeros(n, dtype=np.int64)
        raw = data.tobytes()
        found = [m.span() for m in self.special.finditer(raw)] if self.special else []
        # a match must lie in one row (the bytes of neighbours touch)
        at = [(a, b, int(np.searchsorted(offs, a, side="right")) - 1) for a, b in found]
        at = [(a, b, r) for a, b, r in at if b <= offs[r + 1]]
        if not at:
            return data, offs, row, specials
        keep = np.ones(len(data), dtype=bool)
        for a, b, r in at:
            keep[a:b] = False
            specials[r] += 1
        cuts = np.concatenate([offs[:-1], [b for _, b, _ in at]])
        rows = np.concatenate([row, [r for _, _, r in at]])
        order = np.lexsort((cuts, rows))
        kept = np.concatenate([[0], np.cumsum(keep)])
        return data[keep], np.append(kept[cuts[order]], kept[-1]), rows[order], specials

    def counts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Tokens of every row."""
        data, at, rows, total = self._apart(data, offs)
        if not len(data):
            return total
        first_byte = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        classes = self.classes[points]
        begin = np.searchsorted(first_byte, at[:-1])
        classes[np.unique(begin[at[:-1] < at[1:]])] += N_CLASSES
        cuts = np.append(first_byte[np.flatnonzero(piece_starts(classes))], len(data))
        codes, distinct = wd.encode(wd.as_binary(data, cuts))
        cache, count = self.cache, self.merger.count
        if len(cache) > PIECES:
            cache.clear()
        size = np.empty(len(distinct), dtype=np.int64)
        for i, piece in enumerate(distinct.to_pylist()):
            n = cache.get(piece)
            if n is None:
                n = cache[piece] = count(piece)
            size[i] = n
        row = rows[np.searchsorted(at[1:], cuts[:-1], side="right")]
        return total + np.bincount(row, weights=size[codes], minlength=len(total)).astype(np.int64)


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every row.

    The tables of the splitter (one byte per code point) are compiled on the
    driver and broadcast; each worker compiles the merger once.
    """
    from tokenizers import Tokenizer
    spec = json.load(open(tokenizer, encoding="utf-8"))
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex") \
            or pre.get("add_prefix_space") or spec["model"].get("ignore_merges"):
        raise ValueError(f"only plain byte-level tokenizers can be compiled ({BYTE_PATTERN})")
    shared = docs.sparkSession.sparkContext.broadcast(character_classes(Tokenizer.from_file(tokenizer)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer, shared.value)
        counter = _COUNTERS[tokenizer]
        for rb, data, offs in wd.blocks(batches, "text"):
            n = counter.counts(data, offs)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
