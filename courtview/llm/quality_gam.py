"""Quality classifier: a generalised additive model with pairwise interactions (cyclic boosted shallow trees).

Features are counts over the whole text. They are cut into bins at quantiles of the training rows; the model is
one lookup table for each feature, learnt by boosting shallow trees on one feature after the other in cycles, then one
two-dimensional table for each of the few pairs with the largest gain, learnt likewise. A score is the sum of the
looked-up values through the logistic function: vectorised additions by bin.

Training uses a bounded sample (``max_train_rows``, the labelled ids with the smallest hashes) of the rows outside
the held-out fold; it alone reaches the driver, as numbers. Scoring runs over all rows and keeps no state.

Defined results: null and empty texts get the features of an empty text; labels that are null or contradict each
other are left out; without labels, or with one class only, every score is the smoothed share of label 1; null
doc_ids are scored and not held out; repeated rows each give a row; other columns are ignored or carried.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import small_batches

MAX_TRAIN_ROWS = 20_000
FEATURES = ("log_chars", "word_chars", "letters", "digits", "marks", "symbols", "capitals", "spaces", "lines", "distinct_words", "top_word",
            "distinct_lines", "sentence_marks", "repeated_chars", "words_no_letter", "words_end_symbol", "capital_words")
_CLASS = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 sentence mark, 4 symbol, 5 space, 6 newline, 7 capital, 8 other mark
_CLASS[128:] = 1
for _c in range(256):
    if 97 <= _c <= 122:
        _CLASS[_c] = 1
    elif 65 <= _c <= 90:
        _CLASS[_c] = 7
    elif 48 <= _c <= 57:
        _CLASS[_c] = 2
    elif _c in b".,;:?":
        _CLASS[_c] = 3
    elif _c in b"#$%&*+<=>@^_|~!\\{}[]/":
        _CLASS[_c] = 4
    elif _c in b" \t\r\x0b\x0c":
        _CLASS[_c] = 5
    elif _c == 10:
        _CLASS[_c] = 6
    elif _c < 128:
        _CLASS[_c] = 8


def features(text: str | None) -> list[float]:
    """The numbers of ``FEATURES`` for one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(1, len(raw))
    data = np.frombuffer(raw, np.uint8)
    kinds = _CLASS[data]
    c = np.bincount(kinds, minlength=9)
    words = raw.split()
    w = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    letters = c[1] + c[7]
    ends = np.append(kinds[1:], 5)
    last = (ends == 5) | (ends == 6)
    starts = np.concatenate(([True], (kinds[:-1] == 5) | (kinds[:-1] == 6))) if len(raw) else np.zeros(0, bool)
    return [float(np.log1p(len(raw))), (n - c[5] - c[6]) / w, letters / n, c[2] / n, (c[3] + c[8]) / n, c[4] / n, c[7] / max(1, letters), c[5] / n, c[6] / n,
            len(counts) / w, (max(counts.values()) if counts else 0) / w, len(set(lines)) / max(1, len(lines)), c[3] / w,
            float((data[1:] == data[:-1]).sum()) / n, sum(v for k, v in counts.items() if not _CLASS_LETTER.intersection(k)) / w,
            float((last & (kinds == 4)).sum()) / w, float((starts & (kinds == 7)).sum()) / w]


_CLASS_LETTER = frozenset(np.flatnonzero((_CLASS == 1) | (_CLASS == 7)).tolist())


@dataclass
class Gam:
    """Bin edges, one table per feature, and tables for pairs of features (on coarser bins)."""
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for p in self.pairs for j in p}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Newton values for each bin of the best tree of ``leaves`` leaves on ordered bins (greedy splits)."""
    cuts = [0, len(grad)]
    cg, ch = np.concatenate(([0.0], np.cumsum(grad))), np.concatenate(([0.0], np.cumsum(hess)))
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                at = int(np.argmax(gain))
                best = max(best, (float(gain[at]), int(k[at])), key=lambda t: t[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best pair of cuts of a two-dimensional table: its gain, and Newton values of the four quadrants."""
    cg, ch = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    if grad.shape[0] < 2 or grad.shape[1] < 2:
        return 0.0, np.zeros_like(grad)
    tl_g, tl_h = cg[:-1, :-1], ch[:-1, :-1]
    tr_g, tr_h = cg[:-1, -1:] - tl_g, ch[:-1, -1:] - tl_h
    bl_g, bl_h = cg[-1:, :-1] - tl_g, ch[-1:, :-1] - tl_h
    parts = [(tl_g, tl_h), (tr_g, tr_h), (bl_g, bl_h), (cg[-1, -1] - tl_g - tr_g - bl_g, ch[-1, -1] - tl_h - tr_h - bl_h)]
    worth = sum(g ** 2 / (h + ridge) for g, h in parts)
    i, j = np.unravel_index(int(np.argmax(worth)), worth.shape)
    gain = float(worth[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + ridge))
    out = np.zeros_like(grad)
    v = [float(g[i, j] / (h[i, j] + ridge)) for g, h in parts]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return gain, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, pair_bins: int = 16, cycles: int = 120, n_pairs: int = 6, pair_cycles: int = 60,
        rate: float = 0.15, leaves: int = 3, ridge: float = 5.0) -> Gam:
    """Cyclic boosting on features ``x`` (rows, features) and labels ``y`` (0 or 1)."""
    d = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, j], bins) if len(x) else np.zeros(0) for j in range(d)]
    coarse = [_edges(x[:, j], pair_bins) if len(x) else np.zeros(0) for j in range(d)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Gam(edges, tables, coarse, [], [], base)
    if len(x) == 0 or y.min() == y.max():
        return model
    at = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(d)]
    at2 = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(d)]
    total = np.full(len(x), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(cycles):
        for j in range(d):
            g, h = slopes()
            step = rate * _shallow_tree(np.bincount(at[j], g, len(tables[j])), np.bincount(at[j], h, len(tables[j])), leaves, ridge)
            tables[j] += step
            total += step[at[j]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = at2[a] * shape[1] + at2[b]
        return (np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(((_quadrants(*grid(a, b), ridge)[0], a, b) for a in range(d) for b in range(a + 1, d)), reverse=True)
    model.pairs = [(a, b) for _, a, b in ranked[:n_pairs]]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_cycles):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            step = rate * _quadrants(*grid(a, b), ridge)[1]
            table += step
            total += step[at2[a], at2[b]]
    return model


def held_out(id_col: Column) -> Column:
    """The fold that no label is learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Gam:
    """Fit on at most ``max_train_rows`` labelled ids outside the held-out fold."""
    small_batches(docs.sparkSession)
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("__y"), F.max("quality").alias("__y2")).filter("__y = __y2")
    chosen = known.select(F.col("doc_id").alias("__id"), "__y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))  # max_train_rows ids at most

    @F.pandas_udf("array<double>")
    def numbers(text):
        import pandas as pd
        return pd.Series([features(t) for t in text])

    rows = texts.select("__id", "__y", numbers("text").alias("x")).groupBy("__id").agg(F.min("__y").alias("y"), F.min("x").alias("x"))
    got = rows.orderBy("__id").collect()  # max_train_rows at most, a few numbers each
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def score(docs: DataFrame, model: Gam, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__score``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd
        x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.scores(x))

    return docs.withColumn("__score", scores(F.col(text_col)))


def classify_quality(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, max_train_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= 0.5).cast("int").alias("predicted"))
