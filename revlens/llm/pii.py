"""Personal data: base patterns and a linear-chain conditional random field (operator 7).

Base spans come from four patterns (e-mail, IP, card, phone), leftmost and not
overlapping within a kind, checked as the contract says. A conditional random
field over word shapes adds spans the patterns miss: numbers without a country
code, addresses spelled out or masked ("name at site dot com", "(at)"), cards of
13 to 15 digits or with other separators, IPv6, masked octets, and spans a base
pattern loses to a number beside them. It has a label O and begin and inside
labels for each kind. Words are O by definition unless they have a digit, ``@``
or ``+``, stand next to a spelled-out "dot", a bracketed "at" or an ``@`` of its own, or come right
before such a word (as context); so a text falls into independent runs of the
other words, and Viterbi decoding steps through all runs of a block at once in
numpy.

The field is trained by AdaGrad on the log-likelihood of a small labelled table
(``pii_examples``), whose held-out part it never sees; the corpus is not read
for it. A span it proposes is added if an exact check of its kind holds (check
digit, octets, digits of a phone, form of an address, no date).

Added spans never touch a base span. Offsets are code points, end exclusive.

Defined results: a null text counts as empty and has no spans; a null doc_id
gives a row of null id; repeated rows give a result row each; a very long text
is read whole, as one block; an empty table gives an empty result; further
columns are never read (``redact`` keeps them as they are).
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pii_examples
from .pii_examples import luhn
from .tables import table
from .textblocks import LOWER, Block, blocks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

# The base patterns. Runs of digits are entered at their start
# only, and e-mails are searched from their @, which finds the same matches in
# linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[[*range(48, 58), ord("@"), ord("+")]] = True


# Spelled-out separators of an address.
_SPELLED = re.compile(rb"dot|@|[\[({<]at[\])}>]")
_BRACKETED = re.compile(rb"[\[({<]at[\])}>]")
_APART = frozenset((b"@", b"dot", b"[dot]", b"(dot)", b"{dot}", b"<dot>"))
_EDGE = ".,;:!?\"'[]{}*%&$#|<>"

#: Words the field knows by their meaning; all others are known by shape alone.
CUES = {
    "at": "at", "dot": "dot", "com org net edu gov io info de fr es uk eu": "top",
    "call phone tel telephone mobile cell fax whatsapp ring text dial reach telefon handy móvil teléfono téléphone mobil": "phone",
    "card visa mastercard amex karte kreditkarte tarjeta carte credit charge": "card",
    "ip host server address ping login attacker blocked": "host",
    "mail e-mail email write contact reach schreib": "mail",
    "order invoice isbn part ticket version page pages year section room id serial zip model chapter hash token release build ratio grid price key": "item",
}
_CUE = {word: cue for words, cue in CUES.items() for word in words.split()}

_MAIL = re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)*\.[^\W\d_]{2,}")
_DATE = re.compile(r"[0-9]{1,2}([-./])[0-9]{1,2}\1[0-9]{2,4}|[0-9]{4}([-./])[0-9]{1,2}\2[0-9]{1,2}|[0-9]{4}-[0-9]{4}|[0-9]{1,2}(:[0-9]{2})+")
_NUMBER = re.compile(r"[0-9()+./\s-]+")
_CARD_FORM = re.compile(r"[0-9]+([\s./_:-]+[0-9]+)*")


def plain_address(text: str) -> str:
    """An address with its spelled-out separators as signs."""
    text = re.sub(r"\s*[\[({<]\s*(at|dot)\s*[\])}>]\s*", lambda m: "@" if m[1].lower() == "at" else ".", text, flags=re.I)
    text = re.sub(r"\s+dot\s+", ".", text, flags=re.I)
    return re.sub(r"\s+at\s+|\s*@\s*", "@", text, count=1, flags=re.I)


@cache
def _is_v6(text: str) -> bool:
    try:
        return ":" in text and ipaddress.ip_address(text).version == 6
    except ValueError:
        return False


def is_valid(kind: str, text: str) -> bool:
    """The exact check of a proposed span."""
    if len(text) > 400:
        return False
    digits = "".join(_DIGITS.findall(text))
    if kind == "email":
        return _MAIL.fullmatch(plain_address(text)) is not None
    if kind == "card":
        return 13 <= len(digits) <= 19 and _CARD_FORM.fullmatch(text) is not None and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and _NUMBER.fullmatch(text) is not None and _DATE.fullmatch(text) is None
    parts = re.split(r"\.", re.sub(r"\s", "", plain_address(text).replace("[.]", ".").replace("(.)", ".")))
    return _is_v6(text) or (len(parts) == 4 and all(x.isascii() and x.isdigit() and len(x) < 4 and int(x) <= 255 for x in parts))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base spans, by kind as listed, then start."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    if _DIGITS.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(g := x.lstrip("0")) < 4 and int(g or 0) <= 255 for x in m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _shape(word: str) -> str:
    """Runs of digits as 9 and their length, of letters as a; other characters as they are."""
    word = re.sub(r"[0-9]+", lambda m: f"9{{{min(len(m[0]), 24)}}}", word)
    return re.sub(r"[^\W\d_]+", "a", word)[:60]


def word_features(word: str) -> tuple[list[str], str]:
    """The word's own features and what its neighbours see: its shape, or its cue."""
    inner = word.strip(_EDGE)
    shape = _shape(inner)
    loose = re.sub(r"\{[0-9]+\}", "", shape)
    if loose == "a" or _CUE.get(inner.lower().strip("()")):
        cue = _CUE.get(inner.lower().strip("()"), "none")
        if cue in ("at", "dot") and inner != word.strip(".,;:!?\"'"):
            cue = f"[{cue}]"
        elif cue in ("at", "dot") and inner.startswith("("):
            cue = f"[{cue}]"
        return [f"cue:{cue}"], f"cue:{cue}"
    digits = "".join(_DIGITS.findall(inner))
    facts = [f"s:{shape}", f"l:{loose}", f"d:{min(len(digits), 20)}", f"f:{loose[:2]}", f"e:{loose[-2:]}"]
    if "@" in inner or _BRACKETED.search(inner.lower().encode()):
        facts.append(f"at:{_MAIL.fullmatch(plain_address(inner)) is not None}")
    elif not digits:
        facts.append(f"name:{'.' in inner}")
    if 13 <= len(digits) <= 19:
        facts.append(f"luhn:{luhn(digits)}")
    if inner.count(":") > 1:
        facts.append(f"v6:{_is_v6(inner)}")
    if _DATE.fullmatch(inner):
        facts.append("date")
    if loose == "9.9.9.9":
        facts.append(f"octets:{all(int(x) <= 255 for x in inner.split('.') if len(x) < 9)}")
    return facts, loose


#: Places of the neighbours that count for a word's label.
OFFSETS = (-2, -1, 1, 2)


def neighbours(first: np.ndarray):
    """For each of OFFSETS, the words that have such a neighbour in their run, and those neighbours."""
    run = np.cumsum(first)
    for d in OFFSETS:
        here = np.arange(max(0, -d), len(run) - max(0, d))
        here = here[run[here] == run[here + d]] if len(here) else here
        yield here, here + d


@dataclass
class Field:
    """Weights of the random field: rows of label scores by feature, and transitions."""

    own: dict[str, int]
    near: dict[str, int]
    w: np.ndarray  # own features, one row each; the last row is for unknown ones
    around: np.ndarray  # what is seen of the words at each of OFFSETS, in the same run
    trans: np.ndarray
    memory: dict = field(default_factory=dict, repr=False)

    def word(self, raw: bytes) -> tuple[list[int], int]:
        known = self.memory.get(raw)
        if known is None:
            facts, loose = word_features(raw.decode("utf-8", "replace"))
            known = ([self.own.get(x, len(self.own)) for x in facts], self.near.get(loose, len(self.near)))
            if len(self.memory) < 100_000 and len(raw) < 64:
                self.memory[raw] = known
        return known

    def emissions(self, words: list[bytes], first: np.ndarray) -> np.ndarray:
        """Label scores of each word; ``first`` marks the first word of a run."""
        found = [self.word(x) for x in words]
        flat = np.array([i for ids, _ in found for i in ids], np.int64)
        sizes = np.array([len(ids) for ids, _ in found])
        out = np.add.reduceat(self.w[flat], np.cumsum(sizes) - sizes, axis=0)
        near = np.array([n for _, n in found])
        for weights, (at, there) in zip(self.around, neighbours(first), strict=True):
            out[at] += weights[near[there]]
        return out

    def __getstate__(self):
        return {**self.__dict__, "memory": {}}


def _steps(first: np.ndarray):
    """For runs in one row: start and length, longest first, and how many runs have a t-th word."""
    start = np.flatnonzero(first)
    length = np.diff(np.r_[start, len(first)])
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    return start, length, [int((length > t).sum()) for t in range(int(length.max(initial=0)))]


def viterbi(e: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels of all runs; every run begins after and ends before an O."""
    start, length, alive = _steps(first)
    best = np.zeros_like(e)
    back = np.zeros(e.shape, np.int8)
    for t, n in enumerate(alive):
        at = start[:n] + t
        if t == 0:
            best[at] = trans[0] + e[at]
        else:
            every = best[at - 1][:, :, None] + trans
            back[at] = every.argmax(axis=1)
            best[at] = every.max(axis=1) + e[at]
    labels = np.zeros(len(e), np.int8)
    last = start + length - 1
    labels[last] = (best[last] + trans[:, 0]).argmax(axis=1)
    for t in range(len(alive) - 1, 0, -1):
        at = start[: alive[t]] + t
        labels[at - 1] = back[at, labels[at]]
    return labels


def _expectations(e: np.ndarray, first: np.ndarray, trans: np.ndarray):
    """Label probabilities of each word, and the expected transitions (with the run's ends)."""
    start, length, alive = _steps(first)
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    a, b = np.zeros_like(e), np.zeros_like(e)
    for t, n in enumerate(alive):
        at = start[:n] + t
        a[at] = (trans[0] if t == 0 else lse(a[at - 1][:, :, None] + trans, 1)) + e[at]
    last = start + length - 1
    b[last] = trans[:, 0]
    for t in range(len(alive) - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        b[at] = lse(trans + (e[at + 1] + b[at + 1])[:, None, :], 2)
    z = np.empty(len(e))
    run = np.cumsum(first) - 1
    total = np.empty(len(start))
    total[run[start]] = lse(a[last] + trans[:, 0], 1)
    z = total[run]
    p = np.exp(a + b - z[:, None])
    moves = np.zeros_like(trans)
    moves[0] += p[start].sum(axis=0)
    moves[:, 0] += p[last].sum(axis=0)
    at = np.flatnonzero(~first)
    if len(at):
        moves += np.exp(a[at - 1][:, :, None] + trans + (e[at] + b[at] - z[at, None])[:, None, :]).sum(axis=0)
    return p, moves


def runs_of(b: Block):
    """Start, end, row and first-of-run mark of the words that are not O by definition."""
    start, end, row = b.words()
    sums = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(_CANDIDATE[b.data], out=sums[1:])
    use = sums[end] > sums[start]
    raw = LOWER[b.data].tobytes()
    for m in _SPELLED.finditer(raw):
        k = int(np.searchsorted(start, m.start(), side="right")) - 1
        if m.end() <= end[k] and (m.end() - m.start() > 3 or raw[start[k] : end[k]].strip(b".,;:!?\"'") in _APART):
            near = np.arange(max(0, k - 5), min(len(start), k + 3))
            use[near[row[near] == row[k]]] = True
    use[:-1] |= use[1:] & (row[1:] == row[:-1])  # the word before, as context
    pick = np.flatnonzero(use)
    first = np.ones(len(pick), bool)
    first[1:] = (np.diff(pick) > 1) | (row[pick][1:] != row[pick][:-1])
    return start[pick], end[pick], row[pick], first


def _code_points(b: Block) -> np.ndarray:
    sums = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum((b.data & 0xC0) != 0x80, out=sums[1:])
    return sums


def train_field(labelled: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 120, rate: float = 0.3, ridge: float = 1e-3) -> Field | None:
    """The field of texts and their spans (kind, start, end)."""
    words: list[bytes] = []
    gold: list[int] = []
    marks: list[np.ndarray] = []
    done = 0
    for b in blocks(pa.array([text for text, _ in labelled], pa.string())):
        start, end, row, first = runs_of(b)
        points, raw = _code_points(b), b.data.tobytes()
        for s, e, r in zip(start.tolist(), end.tolist(), row.tolist(), strict=True):
            lo, hi = points[s] - points[b.offs[r]], points[e] - points[b.offs[r]]
            label = 0
            for kind, x, y in labelled[done + r][1]:
                if x < hi and y > lo:
                    label = 1 + 2 * KINDS.index(kind) + (lo > x)
                    break
            words.append(raw[s:e])
            gold.append(label)
        marks.append(first)
        done += b.hi - b.lo
    if not words:
        return None
    first, y, n = np.concatenate(marks), np.array(gold), len(LABELS)
    facts = [word_features(x.decode("utf-8", "replace")) for x in words]
    own = {x: k for k, x in enumerate(sorted({f for fs, _ in facts for f in fs}))}
    near = {x: k for k, x in enumerate(sorted({s for _, s in facts}))}
    f = Field(own, near, np.zeros((len(own) + 1, n)), np.zeros((len(OFFSETS), len(near) + 1, n)), np.zeros((n, n)))
    flat = np.array([own[x] for fs, _ in facts for x in fs])
    owner = np.repeat(np.arange(len(words)), [len(fs) for fs, _ in facts])
    shape = np.array([near[s] for _, s in facts])
    inside = np.flatnonzero(~first)
    squares = [np.full_like(m, 1e-6) for m in (f.w, f.around, f.trans)]
    seen = np.zeros_like(f.trans)
    np.add.at(seen, (np.zeros(first.sum(), int), y[first]), 1)
    last = np.r_[first[1:], True]
    np.add.at(seen, (y[last], np.zeros(last.sum(), int)), 1)
    np.add.at(seen, (y[inside - 1], y[inside]), 1)
    for _ in range(epochs):
        p, moves = _expectations(f.emissions(words, first), first, f.trans)
        p[np.arange(len(y)), y] -= 1
        grads = [np.zeros_like(f.w), np.zeros_like(f.around), moves - seen]
        np.add.at(grads[0], flat, p[owner])
        for g, (at, there) in zip(grads[1], neighbours(first), strict=True):
            np.add.at(g, shape[there], p[at])
        for m, g, q in zip((f.w, f.around, f.trans), grads, squares, strict=True):
            g += ridge * len(y) / 100 * m
            q += g**2
            m -= rate * g / np.sqrt(q)
    f.w[-1] = 0  # an unknown feature says nothing
    f.around[:, -1] = 0
    return f


def _added(b: Block, model: Field) -> dict[int, list[tuple[str, int, int]]]:
    """Spans the field finds, by row of the block, without regard to base spans."""
    start, end, row, first = runs_of(b)
    if not len(start):
        return {}
    raw, points = b.data.tobytes(), _code_points(b)
    words = [raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    labels = viterbi(model.emissions(words, first), first, model.trans)
    out: dict[int, list] = {}
    open_kind = None
    for k in np.flatnonzero(labels):
        kind, begins = (labels[k] - 1) // 2, labels[k] % 2 == 1
        r = int(row[k])
        text = words[k].decode("utf-8", "replace")
        lead = len(text) - len(text.lstrip(_EDGE))
        tail = len(text) - len(text.rstrip(_EDGE + "()"))
        lo = int(points[start[k]] - points[b.offs[r]])
        hi = lo + len(text) - tail
        if hi <= lo + lead:
            continue
        if not begins and open_kind == (r, kind, k - 1) and not first[k]:
            out[r][-1] = (KINDS[kind], out[r][-1][1], hi)
        else:
            out.setdefault(r, []).append((KINDS[kind], lo + lead, hi))
        open_kind = (r, kind, k)
    return out


def block_spans(b: Block, model: Field | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text of the block."""
    some = b.per_row(_CANDIDATE[b.data]) > 0
    added = _added(b, model) if model is not None else {}
    raw = b.data.tobytes()
    out = []
    for r in range(b.hi - b.lo):
        if not some[r] and r not in added:
            out.append(([], []))
            continue
        text = raw[b.offs[r] : b.offs[r + 1]].decode()
        base = base_spans(text)
        if r in added:
            taken = sorted((s, e) for _, s, e in base)
            k, more = 0, []
            for kind, s, e in added[r]:  # in order of start
                while k < len(taken) and taken[k][1] <= s:
                    k += 1
                if is_valid(kind, text[s:e]) and all(not (x < e and y > s) for x, y in taken[max(0, k - 4) : k + 4]):
                    more.append((kind, s, e))
            out.append((base, sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))))
        else:
            out.append((base, base))
    return out


@cache
def fit_field() -> Field:
    """The field of the labelled table, without its held-out part."""
    return train_field([(text, spans) for text, spans, part in pii_examples.examples() if part != pii_examples.HELD])


def find_spans(docs: DataFrame, model: Field | None) -> DataFrame:
    """Per document: base counts, the digest of the base spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [x for b in blocks(batch.column(1)) for x in block_spans(b, shared.value)]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *counts,
                    pa.array([hashlib.sha256(digest(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    pa.array([digest(spans) for _, spans in found], pa.string()),
                    pa.array([len(spans) for _, spans in found], pa.int64()),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans fall together."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Field | None) -> DataFrame:
    """The same rows and columns; spans in ``text`` replaced, ``n_chars`` set anew where it exists."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            column, texts = batch.column(at), []
            for b in blocks(column):
                raw = b.data.tobytes()
                for r, (_, spans) in enumerate(block_spans(b, shared.value)):
                    text = raw[b.offs[r] : b.offs[r + 1]].decode()
                    texts.append(redacted(text, spans) if spans else text)
            valid = column.is_valid().to_pylist()
            texts = [t if ok else None for t, ok in zip(texts, valid, strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_spans(docs, fit_field())
