"""Toxicity: a subsequence string kernel machine with Nystroem landmarks (operator 8).

Two words are compared by their shared subsequences of four characters; one
that spans s characters weighs ``DECAY ** s`` and may span ``SPAN`` at most, so
a gap or an inserted character lowers the weight instead of losing the match.
The kernel is divided by both words' total weights, which depend on length
alone. Digits and signs that stand for letters are read as those letters.
A run of three or more single characters with spaces or signs between them
("i d i o t", "i-d-i-o-t") is scored as one word too, besides the words themselves.

Training takes at most ``max_toxic`` and ``max_clean`` labelled documents
(smallest id hash, a documented bound) whose id remainder (crc32 mod 4) is not
2. A label belongs to a whole text, so the words answering for it are found by
turns: the words most typical of toxic texts come first; then a linear support
vector machine on Nystroem features (kernel with the landmark words times the
inverse root of the landmarks' own kernel) is fitted to each text's highest
word, and the words are chosen anew. As kernel and machine are linear in the
subsequences, the machine is one weight for each subsequence, and scoring adds
those weights up. A logistic curve over a text's highest word score and its
number of positive words, fitted on the fifth of the sample that the machine
did not see, gives the probability.

Words are scored ``SLICE`` symbols at a time, and a longer word in parts whose
sums are added up, so memory does not grow with a word. Words of more than
``LEARNED`` bytes are scored but not learned from.

Defined results: null and empty texts have no word and take the curve's lowest
value; a null doc_id gives a row of null id that is not held out, and is never
learned from; repeated rows give a result row each; without training rows of
both classes every score is 0; an empty table gives an empty result; further
columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import first_by_hash, remainder, table
from .textblocks import Block, blocks

SPAN = 7  # four letters with a sign between all of them
DECAY = 0.7
SYMBOLS = 64
SIZE = 1 << 20  # subsequences are hashed into so many weights
SLICE = 1 << 16  # symbols scored at a time
LEARNED = 4096

#: Characters read as the letters they stand for (fixed values).
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def _symbols() -> np.ndarray:
    out = np.zeros(256, np.int32)  # 0: all that is left, such as punctuation
    for k in range(26):
        out[97 + k] = out[65 + k] = 1 + k
    for sign, letter in STANDS_FOR.items():
        out[ord(sign)] = out[ord(letter)]
    out[0x80:] = 27 + (np.arange(128) % 35)
    return out


SYMBOL = _symbols()
OPENING, CLOSING = 62, 63  # stand before and after every word
#: Bytes a word may begin and end with.
_END = np.zeros(256, bool)
_END[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: A word answers for a toxic label only with log odds above this, in two toxic texts at least.
MIN_ODDS = 1.5
#: Offsets of the second, third and fourth character of a subsequence.
OFFSETS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]


def trimmed_words(b: Block):
    """Start, end and row of words without punctuation at their ends."""
    start, end, row = b.words()
    plain = _END[b.data]
    before = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(plain, out=before[1:])
    some = before[end] > before[start]
    start, end, row = start[some], end[some], row[some]
    places = np.flatnonzero(plain)
    return places[before[start]], places[before[end] - 1] + 1, row


def joined_runs(b: Block, start: np.ndarray, end: np.ndarray):
    """Bytes, start, end and row of the words that runs of three or more single characters make, without what is between them."""
    edge = np.zeros(len(b.data) + 1, np.int64)
    edge[start] += 1
    edge[end] -= 1
    solid = (np.cumsum(edge[:-1]) > 0) & (SYMBOL[b.data] != 0)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    # words of two rows may touch
    first[start] = solid[start]
    last[end - 1] = solid[end - 1]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(b.offs, lo, side="right") - 1
    chars = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum((b.data & 0xC0) != 0x80, out=chars[1:])
    single = np.flatnonzero(chars[hi] - chars[lo] == 1)
    begins = np.flatnonzero(np.r_[True, (np.diff(single) > 1) | (np.diff(row[single]) > 0)]) if len(single) else single
    size = np.diff(np.r_[begins, len(single)])
    single = single[np.repeat(size >= 3, size)]
    size = size[size >= 3]
    length = hi[single] - lo[single]
    place = np.arange(int(length.sum())) + np.repeat(lo[single] - (np.cumsum(length) - length), length)
    pieces = np.r_[0, np.cumsum(size)].astype(np.int64)
    bounds = np.r_[0, np.cumsum(length)].astype(np.int64)[pieces]
    return b.data[place], bounds[:-1], bounds[1:], row[single[pieces[:-1]]]


def subsequences(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(word, subsequence id, weight) arrays over all given words, and each word's norm."""
    length = end - start + 2
    at = np.cumsum(length) - length
    code = np.zeros(int(length.sum()), np.uint32)
    inner = np.ones(len(code), bool)
    inner[at] = inner[at + length - 1] = False
    within = np.arange(int((end - start).sum())) + np.repeat(start - (np.cumsum(end - start) - (end - start)), end - start)
    code[inner] = SYMBOL[data[within]]
    code[at], code[at + length - 1] = OPENING, CLOSING
    owner = np.repeat(np.arange(len(start)), length)
    left = np.repeat(at + length, length) - np.arange(len(code))  # symbols from here to the word's end
    words, ids, weights = [], [], []
    norm = np.zeros(len(start))
    for a, b, c in OFFSETS:
        p = np.flatnonzero(left > c)
        words.append(owner[p])
        four = ((code[p] * SYMBOLS + code[p + a]) * SYMBOLS + code[p + b]) * SYMBOLS + code[p + c]
        ids.append(((four * np.uint32(2654435761)) >> np.uint32(12)).astype(np.int32))
        weight = DECAY ** (c + 1)
        weights.append(np.full(len(p), weight, np.float32))
        norm += np.maximum(length - c, 0) * weight**2
    return np.concatenate(words), np.concatenate(ids), np.concatenate(weights), np.sqrt(np.maximum(norm, 1e-12))


def _slices(length: np.ndarray):
    """(first word, one past the last, first symbol, one past) of runs of whole words, and of parts of longer words."""
    ends = np.cumsum(length)
    k = 0
    while k < len(length):
        begin = int(ends[k - 1]) if k else 0
        to = int(np.searchsorted(ends, begin + SLICE, side="right"))
        if to > k:
            yield k, to, 0, int(ends[to - 1]) - begin
        else:
            to = k + 1
            for lo in range(0, int(length[k]), SLICE):
                yield k, to, lo, min(lo + SLICE, int(length[k]))
        k = to


def word_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Each word's subsequence weights times ``vector``, over the word's norm."""
    length = end - start + 2
    out = np.zeros(len(start))
    for k, to, lo, hi in _slices(length):
        sizes = length[k:to]
        at = np.cumsum(sizes) - sizes
        # the symbols of the slice, and those after it that its subsequences may end in
        place = np.arange(lo, min(hi + SPAN, int(sizes.sum())))
        owner = np.searchsorted(at, place, side="right") - 1
        within = place - at[owner]
        left = sizes[owner] - within
        inner = (within > 0) & (left > 1)
        code = np.where(within == 0, OPENING, CLOSING).astype(np.uint32)
        code[inner] = SYMBOL[data[(start[k:to][owner] + within - 1)[inner]]]
        for a, b, c in OFFSETS:
            p = np.flatnonzero(left[: hi - lo] > c)
            four = ((code[p] * SYMBOLS + code[p + a]) * SYMBOLS + code[p + b]) * SYMBOLS + code[p + c]
            ids = (four * np.uint32(2654435761)) >> np.uint32(12)
            out[k:to] += DECAY ** (c + 1) * np.bincount(owner[p], vector[ids], to - k)
    norm = sum(np.maximum(length - c, 0) * DECAY ** (2 * c + 2) for _, _, c in OFFSETS)
    return out / np.sqrt(np.maximum(norm, 1e-12))


def word_scores(b: Block, vector: np.ndarray):
    """Score and row of every word of the block."""
    start, end, row = trimmed_words(b)
    if not len(start):
        return np.zeros(0), row
    # Equal words are scored once.
    _, first, back = np.unique(b.hashes(start, end), return_index=True, return_inverse=True)
    score = word_values(b.data, start[first], end[first], vector)
    data, lo, hi, their_row = joined_runs(b, start, end)
    if not len(lo):
        return score[back], row
    return np.concatenate([score[back], word_values(data, lo, hi, vector)]), np.concatenate([row, their_row])


def text_features(score: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Highest word score and number of positive words (log) of each text."""
    top = np.full(rows, -1.5)
    np.maximum.at(top, row, np.clip(score, -1.5, 1.5))
    return np.column_stack([top, np.log1p(np.bincount(row[score > 0], minlength=rows))])


@dataclass
class ToxicityModel:
    vector: np.ndarray
    bias: float
    curve: np.ndarray  # bias and two slopes; empty without training rows

    def score(self, b: Block) -> np.ndarray:
        rows = b.hi - b.lo
        if not len(self.curve):
            return np.zeros(rows)
        score, row = word_scores(b, self.vector)
        x = text_features(score + self.bias, row, rows)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ self.curve[1:], -40, 40)))


def _kernel_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse feature rows (row, id, value) of single words."""
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(lengths) - lengths
    word, ids, weight, norm = subsequences(data, start, start + lengths)
    return word, ids, weight / norm[word]


def _word_values(words: list[bytes], vector: np.ndarray) -> np.ndarray:
    """Value of every word."""
    end = np.cumsum([len(w) for w in words], dtype=np.int64)
    return word_values(np.frombuffer(b"".join(words), np.uint8), np.r_[0, end[:-1]], end, vector)


def _with_landmarks(words: list[bytes], place: np.ndarray, marks: np.ndarray, step: int = 4096) -> np.ndarray:
    """Kernel of words with landmarks; ``marks`` has a column for each landmark, ``place`` the row of a subsequence in it."""
    out = np.zeros((len(words), marks.shape[1]), np.float32)
    for lo in range(0, len(words), step):
        word, ids, value = _kernel_rows(words[lo : lo + step])
        order = np.argsort(word, kind="stable")
        word, ids, value = word[order], ids[order], value[order]
        if len(word):
            begins = np.flatnonzero(np.r_[True, np.diff(word) > 0])
            # a few words at a time, as the gathered rows are wide
            for k in range(0, len(begins), 512):
                hi = begins[k + 512] if k + 512 < len(begins) else len(word)
                part = slice(begins[k], hi)
                out[lo + word[begins[k : k + 512]]] = np.add.reduceat(marks[place[ids[part]]] * value[part, None], begins[k : k + 512] - begins[k], axis=0)
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by Newton steps on its support vectors."""
    x1 = np.column_stack([x, np.ones(len(x))]).astype(float)
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        a = x1[inside] * weight[inside, None]
        new = np.linalg.solve(ridge + 2 * cost * a.T @ x1[inside], 2 * cost * a.T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bias and slopes of a lightly ridged logistic curve; slopes are not negative."""
    x1 = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag([1e-4, 0.02, 0.02])
        w -= np.linalg.solve(h, x1.T @ (p - y) + np.array([1e-4, 0.02, 0.02]) * w)
    w[1:] = np.maximum(w[1:], 0)
    return w


def fit_model(texts: list[str], labels: np.ndarray, n_landmarks: int = 384, turns: int = 5) -> ToxicityModel:
    y = np.asarray(labels, float) >= 0.5
    if not len(y) or y.all() or not y.any():
        return ToxicityModel(np.zeros(SIZE, np.float32), 0.0, np.zeros(0))
    # Word kinds, and for each text the distinct kinds it holds.
    kinds: dict[bytes, int] = {}
    members: list[np.ndarray] = []
    for b in blocks(pa.array(texts, pa.string())):
        start, end, row = trimmed_words(b)
        short = end - start <= LEARNED
        start, end, row = start[short], end[short], row[short]
        raw = bytes(b.lower().data)
        own = np.array([kinds.setdefault(raw[s:e], len(kinds)) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
        cuts = np.searchsorted(row, np.arange(b.hi - b.lo + 1))
        members += [np.unique(own[cuts[k] : cuts[k + 1]]) for k in range(b.hi - b.lo)]
    names = list(kinds)
    if not names:
        return ToxicityModel(np.zeros(SIZE, np.float32), 0.0, np.zeros(0))
    held = np.arange(len(y)) % 5 == 4
    if not (y[held].any() and y[~held].any() and not y[held].all()):
        held[:] = False
    bad, good = (np.bincount(np.concatenate([members[k] for k in np.flatnonzero(~held & side)] or [np.zeros(0, np.int64)]), minlength=len(names)) for side in (y, ~y))
    n_bad, n_good = max(1, (~held & y).sum()), max(1, (~held & ~y).sum())
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
    typical = np.sqrt(bad) * odds
    common = np.argsort(-good, kind="stable")[: n_landmarks // 3]
    marks = list(dict.fromkeys([*np.argsort(-typical, kind="stable")[: n_landmarks - len(common)].tolist(), *common.tolist()]))
    word, ids, value = _kernel_rows([names[k] for k in marks])
    used = np.unique(ids)  # the subsequences of the landmarks; row 0 is for all others
    place = np.zeros(SIZE, np.int32)
    place[used] = 1 + np.arange(len(used))
    wide = np.zeros((len(used) + 1, len(marks)), np.float32)
    np.add.at(wide, (place[ids], word), value)
    own = _with_landmarks([names[k] for k in marks], place, wide).astype(float)
    lam, u = np.linalg.eigh((own + own.T) / 2)
    use = lam > 1e-6 * lam.max()
    root = u[:, use] / np.sqrt(lam[use])
    cols, offs = np.concatenate(members), np.cumsum([0, *map(len, members)])
    score = np.where(bad > 0, typical, odds - 5)
    chosen: set[int] = set()
    vector, bias = np.zeros(SIZE, np.float32), 0.0
    for _ in range(turns):
        tops = [int(cols[offs[k] : offs[k + 1]][np.argmax(score[cols[offs[k] : offs[k + 1]]])]) for k in range(len(y)) if offs[k + 1] > offs[k]]
        with_words = np.flatnonzero(np.diff(offs))
        positive = sorted({t for t, k in zip(tops, with_words, strict=True) if y[k] and not held[k] and odds[t] > MIN_ODDS and bad[t] >= 2})
        chosen |= {t for t, k in zip(tops, with_words, strict=True) if not y[k] and not held[k]}
        negative = sorted(({*chosen, *common.tolist()}) - set(positive))
        if not positive or not negative:
            break
        each = [*positive, *negative]
        x = _with_landmarks([names[k] for k in each], place, wide) @ root
        target = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        weight = np.r_[np.sqrt(bad[positive] + 1.0), np.sqrt(good[negative] + 1.0)]
        beta, bias = _svm(x, target, weight)
        # One weight for each subsequence.
        vector = (wide @ (root @ beta)).astype(np.float32)[place]
        score = _word_values(names, vector) + bias
    rows = held if held.any() else np.ones(len(y), bool)
    word_row = np.repeat(np.arange(len(y)), np.diff(offs))
    x = text_features(score[cols], word_row, len(y))
    return ToxicityModel(vector, bias, _logistic(x[rows], y[rows].astype(float)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_toxic: int = 1_500, max_clean: int = 3_000) -> ToxicityModel:
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic")).dropna()
    marked = marked.where(remainder("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = F.broadcast(first_by_hash(marked.where("toxic >= 0.5"), "doc_id", max_toxic).unionByName(first_by_hash(marked.where("toxic < 0.5"), "doc_id", max_clean)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna()
    rows = texts.join(picked, "doc_id").toPandas().sort_values(["doc_id", "text"])
    return fit_model(rows["text"].tolist(), rows["toxic"].to_numpy(float))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            parts = [m.score(b) for b in blocks(batch.column(2))]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
