"""Quality classifier: a generalised additive model with pairwise interactions.

The log-odds of label 1 are a sum of lookup tables: one per feature and one per
chosen pair of features.

    score = sigmoid(intercept + sum_f table_f[bin_f] + sum_(a, b) table_ab[bin_a, bin_b])

Features are measured on the whole text in Arrow blocks (``FEATURES``): lengths,
shares of capitals, digits, symbols and marks, repeated lines and windows,
variety of words.  A feature's bins are quantiles of the training rows.

Fitting is cyclic boosting: round after round, every feature in turn gets a
shallow tree of its own (at most two cuts on its bins, Newton steps on the
log loss, small learning rate), which is added to its table.  Because each
step sees one feature, the tables stay readable.  Then pairs are ranked by what
the best pair of cuts would explain of what is left, and the best ``PAIRS`` are
boosted the same way with trees of one cut on either feature.

Labelled rows outside the held-out third are training rows.  The fit takes at
most about ``SAMPLE`` of them, the documented bound of the classifier: all if
there are no more, else those whose hash falls below the share (the same rows
in every run).  They are ``len(FEATURES)`` numbers each, so the driver holds
some megabytes.  Measuring and scoring run over all documents in Spark tasks; a
document's score is a handful of vectorised bin additions.

Only the text enters a score.  Defined cases: null text is empty and is scored like any
other; documents that share an id are scored each by their own text and are each
training rows if the id is labelled, once per label row; labels other than 0
and 1, and labels of unknown ids, are not used; a null id is not held out and has no label; without training
rows of both labels the score is the smoothed share of label 1 (0.5 without any);
an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words as wd
from orderflow.llm.quality import block_counts
from orderflow.llm.sharding import chance
from orderflow.session import materialize

SAMPLE, BINS, COARSE = 50_000, 32, 12
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, RIDGE, LEAST = 120, 60, 8, 0.1, 1.0, 4.0
FOLDS, HELD = 3, 1
FEATURES = ("log_words", "word_length", "symbols", "repetition", "repeated_lines", "variety", "top_word", "capitals",
            "digits", "exclamations", "stops", "commas", "non_ascii", "line_breaks", "short_words", "long_words",
            "capital_words", "white_space", "other_marks", "bare_letters")


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _flags(bytes(range(65, 91))), _flags(b"0123456789")
_LETTER = _UPPER | _flags(bytes(range(97, 123))) | _flags(bytes(range(128, 256)))
_ENDS, _CALLS, _COMMA, _OTHER = _flags(b".!?"), _flags(b"!?"), _flags(b","), _flags(b"\"'()-/:;=@[\\]_`{}~+")


def measure(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The features (a column each) of every text of a block."""
    n = len(offs) - 1
    c = block_counts(data, offs)
    row, starts, ends, space = wd.words(data, offs)
    word_row, codes, _ = wd.word_codes(wd.lower_ascii(data), offs)
    words = np.maximum(c["n_words"], 1).astype(np.float64)
    chars = np.maximum(wd.per_row((data & 0xC0) != 0x80, offs), 1).astype(np.float64)
    bytes_ = np.maximum(np.diff(offs), 1).astype(np.float64)

    def share(flags: np.ndarray, of: np.ndarray) -> np.ndarray:
        return wd.per_row(flags, offs) / of

    key, times = np.unique(word_row * (int(codes.max(initial=0)) + 1) + codes, return_counts=True)
    owner = key // (int(codes.max(initial=0)) + 1)
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    length = ends - starts
    upper = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_UPPER[data], out=upper[1:])
    lower = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_LETTER[data] & ~_UPPER[data], out=lower[1:])
    shout = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(row[flags], minlength=n) / words

    x = (np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_repeat_words"] / words,
         c["n_dup_lines"] / (wd.per_row(data == 10, offs) + 1.0), np.bincount(owner, minlength=n) / words, most / words,
         share(_UPPER[data], chars), share(_DIGIT[data], chars), share(_CALLS[data], words), share(_ENDS[data], words),
         share(_COMMA[data], words), share(data >= 0xC0, chars), share(data == 10, words), of_words(length <= 2),
         of_words(length >= 15), of_words(shout), share(space, bytes_), share(_OTHER[data], words),
         share(_LETTER[data], bytes_))
    return np.column_stack(x).astype(np.float32)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the features of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, data, offs in wd.blocks(batches, "text"):
            x = measure(data, offs)
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), *[pa.array(v) for v in x.T]],
                                             names=["doc_id", "held_out", *FEATURES])

    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held = F.coalesce(crc % FOLDS == HELD, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, " + ", ".join(f"{f} float" for f in FEATURES))


@dataclass
class Model:
    """Lookup tables over feature bins."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)    # inner borders of each feature's bins
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)    # over the coarse bins of a pair
    coarse: list[np.ndarray] = field(default_factory=list)   # coarse bin of each bin, by feature

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def log_odds(self, bins: list[np.ndarray], n: int) -> np.ndarray:
        out = np.full(n, self.intercept)
        for b, t in zip(bins, self.tables):
            out += t[b]
        for (i, j), g in zip(self.pairs, self.grids):
            out += g[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.log_odds(self.bins(x), len(x)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The step of every bin: a tree of at most two cuts over bins with gradient and curvature sums g, h."""
    cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])

    def gain(a: int, b: int) -> tuple[float, int]:
        """Gain and place of the best cut of the bins a..b."""
        k = np.arange(a + 1, b)
        if not len(k):
            return 0.0, -1
        gl, hl, gr, hr = cg[k] - cg[a], ch[k] - ch[a], cg[b] - cg[k], ch[b] - ch[k]
        whole = (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + RIDGE)
        win = np.where((hl >= LEAST / 4) & (hr >= LEAST / 4),
                       gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - whole, 0.0)
        at = int(win.argmax())
        return float(win[at]), int(k[at])

    cuts = [0, len(g)]
    for _ in range(2):
        best = max(gain(a, b) for a, b in zip(cuts[:-1], cuts[1:]))
        if best[0] <= 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = RATE * (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def crossed(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree with one cut on either axis of a grid."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    a, b = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    if not a.size:
        return 0.0, np.zeros_like(g)

    def four(c: np.ndarray) -> list[np.ndarray]:
        ll = c[a, b]
        return [ll, c[a, -1] - ll, c[-1, b] - ll, c[-1, -1] - c[a, -1] - c[-1, b] + ll]

    gs, hs = four(cg), four(ch)
    win = sum(x ** 2 / (y + RIDGE) for x, y in zip(gs, hs)) - cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)
    at = np.unravel_index(int(win.argmax()), win.shape)
    ll, lr, rl, rr = (RATE * x[at] / (y[at] + RIDGE) for x, y in zip(gs, hs))
    i, j = int(a[at]), int(b[at])
    step = np.empty_like(g)
    step[:i, :j], step[:i, j:], step[i:, :j], step[i:, j:] = ll, lr, rl, rr
    return float(win[at]), step


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the feature tables, then of the best pairs."""
    ones, n = float(y.sum()), len(y)
    model = Model(float(np.log((ones + 1) / (n - ones + 1))))
    if ones in (0.0, float(n)):
        return model
    at = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, f], at, method="nearest")) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(t)) * min(COARSE, len(t)) // len(t) for t in model.tables]
    bins = model.bins(x)
    z = np.full(n, model.intercept)
    for _ in range(ROUNDS):
        for f, t in enumerate(model.tables):
            p = sigmoid(z)
            step = shallow_tree(np.bincount(bins[f], y - p, len(t)), np.bincount(bins[f], p * (1 - p), len(t)))
            t += step
            z += step[bins[f]]

    low = [c[b] for c, b in zip(model.coarse, bins)]
    size = [int(c[-1]) + 1 for c in model.coarse]

    def grid(i: int, j: int) -> tuple[float, np.ndarray]:
        p = sigmoid(z)
        cell = low[i] * size[j] + low[j]
        return crossed(*(np.bincount(cell, v, size[i] * size[j]).reshape(size[i], size[j])
                         for v in (y - p, p * (1 - p))))

    gains = sorted(((grid(i, j)[0], -i, -j) for i in range(len(size)) for j in range(i + 1, len(size))), reverse=True)
    model.pairs = [(-i, -j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.grids = [np.zeros((size[i], size[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.grids):
            step = grid(i, j)[1]
            table += step
            z += step[low[i], low[j]]
    return model


def train(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          sample: int = SAMPLE) -> Model:
    """The model of the labelled rows outside the held-out fold."""
    marks = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    rows = feats.where("NOT held_out").join(marks.where("y IN (0, 1)"), F.col("doc_id") == F.col("id"))
    rows = materialize(rows.select(F.xxhash64("doc_id", *FEATURES).alias("order"), "y", *FEATURES), "gam-training")
    n = rows.count()
    if n > sample:
        rows = rows.where(chance(F.xxhash64(F.lit(13), "order")) < sample / n)
    t = rows.toArrow().sort_by([("order", "ascending"), ("y", "ascending")])
    x = np.column_stack([t.column(f).to_numpy() for f in FEATURES]) if t.num_rows else np.zeros((0, len(FEATURES)))
    return fit(x, t.column("y").to_numpy().astype(np.float64))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    feats = materialize(measured(src), "gam-features")
    model = train(feats, labels, label_id_col, label_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            x = np.column_stack([rb.column(2 + f).to_numpy() for f in range(len(FEATURES))])
            score = np.round(model.score(x), 9)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return feats.select("doc_id", "held_out", *FEATURES).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
