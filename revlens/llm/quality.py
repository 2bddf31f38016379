"""Quality rules: gradient-boosted trees over document statistics (operator 2).

Statistics of each whole text are counted in numpy blocks on the executors.
The trees are fitted on the driver from at most ``max_rows`` labelled rows
(numbers only, a documented bound), with second-order boosting on quantile
bins. Features named in ``DECREASING`` may only lower the score as they grow:
a split against that direction is refused, and the middle of the two leaf
values bounds both subtrees. Trees are flattened into numpy node arrays, and a
batch is scored by stepping all rows through them at once.

Defined results: a null text counts as empty; an empty text has all counts 0
and fails the base rule; repeated rows give a result row each; without
labelled rows of both classes there are no trees and every text that passes the
base rule is kept; an empty table gives an empty result; further columns are
never read. A null doc_id gives a row of null id, and is never learned from. A
very long text is read whole, in memory of some 50 bytes for each of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import first_by_hash
from .textblocks import Block, blocks, mix

#: Characters counted as symbols (fixed values of the contract).
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_lines", "n_upper", "n_digits", "n_punct")
FEATURES = ("log_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "digit_ratio", "punct_ratio")
DECREASING = ("symbol_ratio", "dup_line_ratio", "repeat_ratio")


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _DIGIT = _flags(SYMBOLS), _flags(bytes(range(65, 91))), _flags(b"0123456789")
_PUNCT = _flags(b"!?.,;:\"'()[]{}-_/\\@^~`+=")


def _rows_of(offs: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(offs, at, side="right") - 1


def _repeated(key: np.ndarray) -> np.ndarray:
    """For each value, whether it stands in ``key`` twice or more."""
    order = np.argsort(key)
    ranked = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    same[:-1] |= same[1:]
    out = np.empty(len(key), bool)
    out[order] = same
    return out


def block_counts(b: Block) -> np.ndarray:
    """One row of COUNTS + MORE_COUNTS for each text of the block."""
    rows = b.hi - b.lo
    out = np.zeros((rows, len(COUNTS) + len(MORE_COUNTS)), np.int64)
    if not len(b.data):
        return out
    start, end, row = b.words()
    out[:, 0] = np.bincount(row, minlength=rows)
    inside = np.zeros(len(b.data) + 1, np.int8)
    inside[start] += 1
    np.subtract.at(inside, end, 1)
    solid = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out[:, 1] = b.per_row(solid & ((b.data & 0xC0) != 0x80))
    out[:, 2] = b.per_row(_SYMBOL[b.data])
    # Lines that hold a word, by the hash of their bytes; all but the first of equal ones.
    newline = b.data == 10
    breaks = np.flatnonzero(newline)
    line_start = np.unique(np.concatenate([b.offs[:-1][np.diff(b.offs) > 0], breaks + 1]))
    line_start = line_start[line_start < len(b.data)]
    line_row = _rows_of(b.offs, line_start)
    line_end = np.empty_like(line_start)
    line_end[:-1] = line_start[1:]
    line_end[-1:] = len(b.data)
    line_end -= newline[line_end - 1]
    firsts = np.searchsorted(start, line_start)
    used = np.zeros(len(line_start), bool)
    some = firsts < len(start)
    used[some] = start[firsts[some]] < line_end[some]
    ls, le, lr = line_start[used], line_end[used], line_row[used]
    out[:, 5] = np.bincount(lr, minlength=rows)
    key = b.hashes(ls, le) ^ mix(lr.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    out[:, 3] = np.bincount(lr[again], minlength=rows)
    # Words of 3-word windows that stand twice or more in their text.
    if len(start) >= 3:
        h = b.hashes(start, end)
        whole = row[2:] == row[:-2]
        at = np.flatnonzero(whole)
        three = mix(h[at] + np.uint64(3) * mix(h[at + 1]) + np.uint64(5) * mix(mix(h[at + 2]))) ^ mix(row[at].astype(np.uint64) + np.uint64(1))
        at = at[_repeated(three)]
        covered = np.zeros(len(start), bool)
        for k in range(3):
            covered[at + k] = True
        out[:, 4] = np.bincount(row[covered], minlength=rows)
    for k, flags in enumerate((_UPPER, _DIGIT, _PUNCT)):
        out[:, 6 + k] = b.per_row(flags[b.data])
    return out


def features(counts: np.ndarray) -> np.ndarray:
    n_words, chars, symbols, dups, repeats, lines, upper, digits, punct = counts.T.astype(float)
    size = np.maximum(chars, 1)
    return np.column_stack([
        np.log1p(n_words), chars / np.maximum(n_words, 1), symbols / size, dups / np.maximum(lines, 1),
        repeats / np.maximum(n_words, 1), upper / size, digits / size, punct / size,
    ])


@dataclass
class Trees:
    """Flattened nodes of all trees; a leaf is its own left and right child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _best_split(binned, grad, hess, rows, bins, low, high, sign, l2, least):
    """(gain, feature, bin, left value, right value) of the best allowed split."""
    best = None
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    whole = np.clip(-g_all / (h_all + l2), low, high)
    score = lambda v, g, h: -(g * v + 0.5 * (h + l2) * v * v)
    for j in range(binned.shape[1]):
        g = np.cumsum(np.bincount(binned[rows, j], grad[rows], bins))[:-1]
        h = np.cumsum(np.bincount(binned[rows, j], hess[rows], bins))[:-1]
        vl = np.clip(-g / (h + l2), low, high)
        vr = np.clip(-(g_all - g) / (h_all - h + l2), low, high)
        gain = score(vl, g, h) + score(vr, g_all - g, h_all - h) - score(whole, g_all, h_all)
        gain[(h < least) | (h_all - h < least) | (sign[j] * (vr - vl) < 0)] = -np.inf
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (gain[k], j, k, vl[k], vr[k])
    return best


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss with monotonic constraints."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    sign = np.array([-1 if name in DECREASING else 0 for name in FEATURES[: x.shape[1]]])
    if len(y) and 0 < y.mean() < 1:
        prior = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
        margin = np.full(len(y), prior)
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(len(nodes))

            def grow(rows, level, low, high, value):
                at = len(nodes)
                nodes.append([0, np.inf, at, at, value])
                split = _best_split(binned, grad, hess, rows, bins, low, high, sign, l2, 1e-2) if level < depth else None
                if split is None:
                    margin[rows] += rate * value
                    nodes[at][4] = rate * value
                    return at
                _, j, k, vl, vr = split
                middle = (vl + vr) / 2
                go = binned[rows, j] <= k
                bounds = ((low, high), (low, high)) if not sign[j] else (((middle, high), (low, middle)) if sign[j] < 0 else ((low, middle), (middle, high)))
                nodes[at][0], nodes[at][1] = j, edges[j][k] if k < len(edges[j]) else np.inf
                nodes[at][2] = grow(rows[go], level + 1, *bounds[0], vl)
                nodes[at][3] = grow(rows[~go], level + 1, *bounds[1], vr)
                return at

            grow(np.arange(len(y)), 0, -np.inf, np.inf, 0.0)
    else:
        prior = 4.0
    a = np.array(nodes, float).reshape(-1, 5)
    return Trees(np.array(roots, int), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], depth, prior)


_STAT_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + MORE_COUNTS)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS and MORE_COUNTS of every text, counted on the executors."""

    def run(batches):
        for batch in batches:
            parts = [block_counts(b) for b in blocks(batch.column(1))]
            counts = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS + MORE_COUNTS)), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in counts.T)], ["doc_id", *COUNTS, *MORE_COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _STAT_SCHEMA)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Fit on the labelled documents; at most ``max_rows``, those of smallest id hash."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")).dropna()
    marked = first_by_hash(marked.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", max_rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = document_statistics(own.join(F.broadcast(marked.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(marked), "doc_id").toPandas()
    rows = rows.sort_values(["doc_id", *COUNTS])
    return fit_trees(features(rows[list(COUNTS + MORE_COUNTS)].to_numpy(np.int64)), (rows["quality"].to_numpy() >= 0.5).astype(float))


def quality_filter(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """Statistics, base rule, model probability and verdict of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        model = shared.value
        for batch in batches:
            counts = np.column_stack([batch.column(1 + k).to_numpy() for k in range(len(COUNTS + MORE_COUNTS))])
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            p = model.probability(features(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)],
                ["doc_id", *COUNTS, "base_failed", "kept", "probability"],
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, probability double"
    return document_statistics(docs).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    from .tables import table

    docs = table(spark, sf_dir, "documents")
    return quality_filter(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
