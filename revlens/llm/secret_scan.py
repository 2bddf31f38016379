"""Secrets in texts: base patterns and a character convolutional network (operator 11).

Base spans come from three patterns (assignment, access key, hexadecimal run),
leftmost and not overlapping within a kind. The network looks at every candidate
with its surroundings, ``BEFORE`` bytes before and ``AFTER`` behind, and adds
spans of kind ``model`` that touch no base span. Candidates are the maximal runs
of the bytes in ``_TOKEN`` (with up to two ``=`` behind, full stops at the end
taken off) of at least ``MIN_LENGTH`` bytes that hold a digit or a capital after
a small letter, or that begin within ``LED`` bytes after a credential word; runs
that touch a letter beyond ASCII are parts of words and no candidates.

One convolution of width five runs over the characters. Its ReLU maps are pooled
by maximum over the text before, the candidate and the text behind, and by mean
over the candidate; a hidden layer and a logistic output follow. As characters
are one-hot, a filter is five look-ups in small tables, so scoring is gathers
and segmented maxima in numpy. A candidate is read whole at any length, in
slices of ``POSITIONS`` characters whose maxima and sums are put together.

The network learns from the labelled lines of ``findings`` (fixed, small) and
from at most ``max_docs`` documents' base findings as further secrets (smallest
id hash). Each line belongs to one of three parts: fitting, calibration, held
out. A sigmoid fitted on the calibration part turns margins into probabilities,
and the threshold of each group (candidates after a credential word, others) is
the highest one that keeps ``RECALL`` of the group's secrets there.

Defined results: a null text counts as empty and has no spans; repeated rows and
rows of null doc_id give a result row each; an empty table gives an empty result;
further columns are never read (``redact`` keeps them as they are). Offsets are
code points, end exclusive. Very long texts and candidates are read whole; memory
is a few bytes a byte of the longest text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .findings import Example, examples
from .pii import digest, redacted
from .tables import first_by_hash, table
from .textblocks import LOWER, Block, blocks

KINDS = ("assign", "access", "hex", "model")
BASE_KINDS = KINDS[:3]

# The base patterns. Letters of the assignment's words are ASCII in either case.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")

MIN_LENGTH, LED = 8, 32
BEFORE, AFTER, WIDTH = 32, 16, 5
FILTERS, HIDDEN = 24, 16
POSITIONS = 1 << 16
RECALL = 0.95
#: Words after which any run is a candidate, in lower case.
CREDENTIAL_WORDS = (b"passw", b"passphrase", b"secret", b"token", b"credential", b"api key", b"apikey", b"api_key", b"pwd", b"bearer", b"private key", b"contrase\xc3\xb1a", b"mot de passe")

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.~!@$%^&*-"]] = True
_DIGIT, _BIG, _SMALL = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = _BIG[65:91] = _SMALL[97:123] = True

# Symbols: printable ASCII, white space, bytes beyond ASCII, control bytes, and nothing (outside the text).
PAD, N_SYMBOLS = 98, 99
_SYMBOL = np.full(256, 97, np.int64)
_SYMBOL[33:127] = np.arange(94)
_SYMBOL[[0x20, 9, 10, 11, 12, 13]] = 95
_SYMBOL[128:] = 96


def _classes() -> np.ndarray:
    """Symbol by class: digit, small letter, capital, hexadecimal letter, vowel, sign, space, beyond ASCII, nothing."""
    out = np.zeros((N_SYMBOLS, 9))
    for byte in range(33, 127):
        c = chr(byte)
        out[_SYMBOL[byte]] = [c.isdigit(), c.islower(), c.isupper(), c in "abcdefABCDEF", c in "aeiouAEIOU", not c.isalnum(), 0, 0, 0]
    out[95, 6] = out[96, 7] = out[PAD, 8] = 1
    return out


_CLASSES = _classes()


# ---------------------------------------------------------------- base spans


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base spans in bytes, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return _sorted(out)


def _sorted(spans):
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _in_code_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Byte offsets of one text's spans as code points, counted from each offset to the next."""
    if not spans:
        return spans
    at = np.unique([x for _, s, e in spans for x in (s, e)])
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    cuts = np.r_[0, at]
    steps = [int(np.count_nonzero(lead[a:b])) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    place = dict(zip(at.tolist(), np.cumsum(steps).tolist(), strict=True))
    return [(k, place[s], place[e]) for k, s, e in spans]


# ---------------------------------------------------------------- candidates


def candidates(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row, and whether a credential word stands before, of every candidate of a block."""
    d, n = b.data, len(b.data)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none, np.zeros(0, bool)
    solid = _TOKEN[d]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cut = b.offs[(b.offs > 0) & (b.offs < n)]
    first[cut] = solid[cut]
    last[cut - 1] = solid[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= MIN_LENGTH
    start, end = start[long], end[long]
    row = np.searchsorted(b.offs, start, side="right") - 1
    lo, hi = b.offs[row], b.offs[row + 1]
    for _ in range(4):  # full stops that end a sentence
        end = end - ((d[end - 1] == 46) & (end - start > 1))
    one = end + ((end < hi) & (d[np.minimum(end, n - 1)] == 61))  # base64 padding, where nothing is assigned
    two = one + ((one > end) & (one < hi) & (d[np.minimum(one, n - 1)] == 61))
    end = np.where((two < hi) & _TOKEN[d[np.minimum(two, n - 1)]], end, two)
    beyond = ((start > lo) & (d[start - 1] >= 128)) | ((end < hi) & (d[np.minimum(end, n - 1)] >= 128))
    keep = (end - start >= MIN_LENGTH) & ~beyond
    start, end, row, lo = start[keep], end[keep], row[keep], lo[keep]
    if not len(start):
        return none, none, none, np.zeros(0, bool)
    told = np.zeros(n + 1, bool)  # a digit, or a capital after a small letter
    told[1:n] = _BIG[d[1:]] & _SMALL[d[:-1]]
    told[start] = False
    told[:n] |= _DIGIT[d]
    told = np.add.reduceat(told, np.c_[start, end].ravel(), dtype=np.int64)[::2] > 0
    low = LOWER[d].tobytes()
    after = []
    for word in CREDENTIAL_WORDS:
        at = low.find(word)
        while at >= 0:
            after.append(at + len(word))
            at = low.find(word, at + 1)
    led = np.zeros(len(start), bool)
    if after:
        after = np.unique(after)
        k = np.searchsorted(after, start, side="right") - 1
        led = (k >= 0) & (start - after[np.maximum(k, 0)] <= LED) & (after[np.maximum(k, 0)] >= lo)
    keep = told | led
    return start[keep], end[keep], row[keep], led[keep]


# ---------------------------------------------------------------- network


@dataclass
class Network:
    """Filter tables (tap, symbol, filter), their bias, hidden layer, output, calibration and thresholds."""

    taps: np.ndarray
    bias: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, float] = (0.5, 0.5)  # others; after a credential word

    def margins(self, data: np.ndarray, start, end, lo, hi) -> np.ndarray:
        """Output of the last layer for candidates [start, end) in rows [lo, hi) of ``data``."""
        pooled = _pooled(data, start, end, lo, hi, self.taps, self.bias)
        hidden = np.maximum(pooled @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))

    def found(self, data: np.ndarray, start, end, lo, hi, led) -> np.ndarray:
        p = self.probability(self.margins(data, start, end, lo, hi))
        return p >= np.where(led, self.thresholds[1], self.thresholds[0])


def _symbols(data, start, end, lo, hi, begin, upto, cum):
    """Symbols around the positions ``begin`` to ``upto`` of all candidates' windows laid end to end, and their pools."""
    place = np.arange(begin, upto)
    owner = np.searchsorted(cum, place, side="right") - 1
    local = place - cum[owner]
    size = (end - start)[owner]
    at = start[owner] - BEFORE + local
    low = np.maximum(lo, start - BEFORE)[owner]
    high = np.minimum(hi, end + AFTER)[owner]
    seen = at[:, None] + np.arange(WIDTH) - WIDTH // 2
    inside = (seen >= low[:, None]) & (seen < high[:, None])
    symbol = np.where(inside, _SYMBOL[data[np.clip(seen, 0, len(data) - 1)]], PAD)
    segment = (local >= BEFORE).astype(np.int64) + (local >= BEFORE + size)
    return symbol, owner * 3 + segment


def _windows(start, end):
    return np.r_[0, np.cumsum(end - start + BEFORE + AFTER)]


def _pooled(data, start, end, lo, hi, taps, bias) -> np.ndarray:
    n, f = len(start), len(bias)
    peak = np.zeros((n * 3, f))
    total = np.zeros((n * 3, f))
    cum = _windows(start, end)
    for begin in range(0, int(cum[-1]), POSITIONS):
        symbol, pool = _symbols(data, start, end, lo, hi, begin, min(begin + POSITIONS, int(cum[-1])), cum[:-1])
        z = np.broadcast_to(bias, (len(pool), f)).copy()
        for k in range(WIDTH):
            z += taps[k][symbol[:, k]]
        np.maximum(z, 0, out=z)
        at = np.flatnonzero(np.r_[True, pool[1:] != pool[:-1]])
        own = pool[at]
        peak[own] = np.maximum(peak[own], np.maximum.reduceat(z, at, axis=0))
        total[own] += np.add.reduceat(z, at, axis=0)
    mean = total.reshape(n, 3, f)[:, 1] / (end - start)[:, None]
    return np.concatenate([peak.reshape(n, 3 * f), mean], axis=1)


@dataclass
class _Table:
    """Examples as one byte array, with their candidates, labels, groups and parts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    label: np.ndarray
    led: np.ndarray
    line: np.ndarray

    def pick(self, keep) -> "_Table":
        return _Table(self.data, *(x[keep] for x in (self.start, self.end, self.lo, self.hi, self.label, self.led, self.line)))

    def score(self, net: Network) -> np.ndarray:
        return net.margins(self.data, self.start, self.end, self.lo, self.hi)


def as_table(rows: list[Example]) -> _Table:
    """Examples with offsets in bytes; an example's group is that of a candidate at its place."""
    texts = [x.text.encode() for x in rows]
    begins = np.cumsum([0] + [len(t) for t in texts])
    start = np.array([begins[k] + len(x.text[: x.start].encode()) for k, x in enumerate(rows)])
    end = np.array([begins[k] + len(x.text[: x.end].encode()) for k, x in enumerate(rows)])
    led = np.array([any(w in t[max(0, s - LED - 12) : s].lower() for w in CREDENTIAL_WORDS) for t, s in zip(texts, (start - begins[:-1]).tolist(), strict=True)])
    return _Table(
        np.frombuffer(b"".join(texts), np.uint8), start, end, begins[:-1], begins[1:],
        np.array([x.label for x in rows]), led, np.array([x.line for x in rows]),
    )


def part_of(line: np.ndarray) -> np.ndarray:
    """0 to 2: fitting, 3: calibration, 4: held out; all variations of a line share it."""
    return (np.asarray(line) * 7 + 3) % 5


def fit_network(rows: _Table, epochs: int = 14, rate: float = 0.01, batch: int = 128, ridge: float = 2e-4, seed: int = 5) -> Network:
    """Adam on the log-likelihood; characters share the tables of their classes, so rare ones learn too."""
    rng = np.random.default_rng(seed)
    f, c = FILTERS, _CLASSES.shape[1]
    p = {
        "own": rng.normal(0, 0.05, (WIDTH, N_SYMBOLS, f)), "shared": rng.normal(0, 0.3, (WIDTH, c, f)), "bias": np.zeros(f),
        "w1": rng.normal(0, (4 * f) ** -0.5, (4 * f, HIDDEN)), "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(1),
    }
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    weight = np.where(rows.label == 1, 0.5 / max(1, (rows.label == 1).sum()), 0.5 / max(1, (rows.label == 0).sum())) * len(rows.label)
    for _ in range(epochs):
        order = rng.permutation(len(rows.label))
        for at in range(0, len(order), batch):
            g = _gradient(rows.pick(order[at : at + batch]), weight[order[at : at + batch]], p)
            step += 1
            for k, v in p.items():
                d = g[k] + ridge * v
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(_tables(p), p["bias"], p["w1"], p["b1"], p["w2"], float(p["b2"][0]))


def _tables(p) -> np.ndarray:
    return p["own"] + np.einsum("vc,kcf->kvf", _CLASSES, p["shared"])


def _gradient(rows: _Table, weight: np.ndarray, p) -> dict[str, np.ndarray]:
    taps, f, n = _tables(p), FILTERS, len(rows.label)
    cum = _windows(rows.start, rows.end)
    symbol, pool = _symbols(rows.data, rows.start, rows.end, rows.lo, rows.hi, 0, int(cum[-1]), cum[:-1])
    z = p["bias"] + sum(taps[k][symbol[:, k]] for k in range(WIDTH))
    a = np.maximum(z, 0)
    at = np.flatnonzero(np.r_[True, pool[1:] != pool[:-1]])  # all three pools of every example have positions
    peak = np.maximum.reduceat(a, at, axis=0)
    size = (rows.end - rows.start)[:, None]
    mean = np.add.reduceat(a, at, axis=0)[1::3] / size
    x = np.concatenate([peak.reshape(n, 3 * f), mean], axis=1)
    h0 = x @ p["w1"] + p["b1"]
    h = np.maximum(h0, 0)
    out = h @ p["w2"] + p["b2"][0]
    d = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - rows.label) * weight / n
    dh = np.outer(d, p["w2"]) * (h0 > 0)
    dx = dh @ p["w1"].T
    span = np.diff(np.r_[at, len(pool)])
    which = np.repeat(np.arange(len(at)), span)
    top = (a == peak[which]) & (a > 0)
    ties = np.maximum(np.add.reduceat(top, at, axis=0, dtype=np.int64), 1)
    dz = np.where(top, (dx[:, : 3 * f].reshape(3 * n, f) / ties)[which], 0)
    middle = np.flatnonzero(which % 3 == 1)
    dz[middle] += (dx[:, 3 * f :] / size)[which[middle] // 3] * (a[middle] > 0)
    moved = np.flatnonzero(dz.any(axis=1))
    own = np.zeros_like(p["own"])
    columns = np.arange(f)
    for k in range(WIDTH):
        flat = (symbol[moved, k][:, None] * f + columns).ravel()
        own[k] = np.bincount(flat, weights=dz[moved].ravel(), minlength=N_SYMBOLS * f).reshape(N_SYMBOLS, f)
    return {
        "own": own, "shared": np.einsum("vc,kvf->kcf", _CLASSES, own), "bias": dz.sum(axis=0),
        "w1": x.T @ dh, "b1": dh.sum(axis=0), "w2": h.T @ d, "b2": np.array([d.sum()]),
    }


def calibrate(net: Network, rows: _Table, recall: float = RECALL, steps: int = 200) -> Network:
    """Sigmoid over the margins by Newton's method, then the highest threshold of each group that keeps ``recall``."""
    margin, y = rows.score(net), rows.label.astype(float)
    # Targets short of 0 and 1, as in Platt's scaling, keep the sigmoid finite when the parts are separable.
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.c_[margin, np.ones(len(y))]
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, x.T @ (q - target))
        w -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    net.slope, net.shift = float(w[0]), float(w[1])
    p = net.probability(margin)
    limits = []
    for group in (False, True):
        own = np.sort(p[(rows.led == group) & (rows.label == 1)])
        limits.append(float(own[int(np.floor((1 - recall) * len(own)))]) if len(own) else 0.5)
    net.thresholds = (limits[0], limits[1])
    return net


def fit_scanner(docs: DataFrame | None = None, max_docs: int = 2_000, window: int = 64) -> Network:
    """The network fitted and calibrated; ``docs`` adds its base findings with ``window`` characters around each."""
    rows = examples()
    if docs is not None:
        rows = rows + _corpus_examples(docs, max_docs, window)
    all_rows = as_table(rows)
    part = part_of(all_rows.line)
    net = fit_network(all_rows.pick((part < 3) | (all_rows.line < 0)))
    return calibrate(net, all_rows.pick((part == 3) & (all_rows.line >= 0)))


def _corpus_examples(docs: DataFrame, max_docs: int, window: int) -> list[Example]:
    """Base findings of at most ``max_docs`` documents: only short snippets, one a document, reach the driver."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, valid, b in ((d, True, t) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t):
                text = b.encode()
                spans = base_spans(text)
                if spans and doc is not None:
                    kind, s, e = spans[0]
                    if kind == "assign":
                        s = e - len(_ASSIGN.match(text, s)[2])
                    if e - s <= 4 * window:
                        before = text[max(0, s - window) : s].decode("utf-8", "ignore")
                        word = text[s:e].decode()
                        after = text[e : e + window].decode("utf-8", "ignore")
                        out.append((doc, before, word, after))
            columns = list(zip(*out)) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(x, pa.string()) for x in columns[1:])], ["doc_id", "before", "word", "after"])

    found = own.mapInArrow(run, "doc_id long, before string, word string, after string")
    rows = first_by_hash(found, "doc_id", max_docs).toPandas().sort_values(["doc_id", "before", "word", "after"])
    return [Example(x.before + x.word + x.after, len(x.before), len(x.before) + len(x.word), 1, -1) for x in rows.itertuples()]


# ---------------------------------------------------------------- operator


def block_spans(b: Block, net: Network | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text of the block, in code points."""
    added: dict[int, list[tuple[str, int, int]]] = {}
    if net is not None:
        start, end, row, led = candidates(b)
        if len(start):
            found = net.found(b.data, start, end, b.offs[row], b.offs[row + 1], led)
            for s, e, r in zip(start[found].tolist(), end[found].tolist(), row[found].tolist(), strict=True):
                added.setdefault(r, []).append(("model", s - int(b.offs[r]), e - int(b.offs[r])))
    raw, out = b.data.tobytes(), []
    for r in range(b.hi - b.lo):
        text = raw[b.offs[r] : b.offs[r + 1]]
        base = base_spans(text)
        more = added.get(r, [])
        if base and more:
            # Base spans of different kinds may overlap: the furthest end so far tells whether one reaches a candidate.
            begins = np.array([s for _, s, _ in base])
            reach = np.maximum.accumulate([e for _, _, e in base])
            k = np.searchsorted(begins, [e for _, _, e in more], side="left")
            more = [x for x, at in zip(more, k.tolist(), strict=True) if at == 0 or reach[at - 1] <= x[1]]
        out.append((_in_code_points(text, base), _in_code_points(text, _sorted(base + more)) if more else None))
    return [(base, base if spans is None else spans) for base, spans in out]


def find_secrets(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per document: base counts, the digest of the base spans, all spans, and how many the network added."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            found = [x for b in blocks(batch.column(1)) for x in block_spans(b, shared.value)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *counts,
                    pa.array([hashlib.sha256(digest(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([digest(spans) for _, spans in found], pa.string()),
                    pa.array([len(spans) - len(base) for base, spans in found], pa.int64()),
                ],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_model"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long")


def redact(docs: DataFrame, net: Network | None) -> DataFrame:
    """The same rows and columns; secrets in ``text`` replaced by their kind in brackets, null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts = []
            for b in blocks(batch.column(at)):
                raw = b.data.tobytes()
                for r, (_, spans) in enumerate(block_spans(b, shared.value)):
                    texts.append(redacted(raw[b.offs[r] : b.offs[r + 1]].decode(), spans))
            valid = batch.column(at).is_valid().to_pylist()
            columns = list(batch.columns)
            columns[at] = pa.array([t if ok else None for t, ok in zip(texts, valid, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, fit_scanner(docs))
