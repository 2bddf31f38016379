"""Language identification: averaged hashed subword embeddings, linear softmax (operator 10).

A text is the average of the embeddings of its subwords: every word, and every
3- and 4-byte sequence of a word with its boundaries, hashed into ``buckets``.
Embeddings and the softmax layer are trained by minibatch gradient descent in
numpy on at most ``per_lang`` documents of each language (those of smallest id
hash, a documented bound): the whole texts, and two short runs of words of each
so that short texts are learned too. Because averaging and the softmax layer
are both linear, scoring uses their product: one row of class scores a bucket.

Probabilities are calibrated on a fifth of the sample with a temperature. A
text is rejected (``accepted`` false) when its calibrated probability is under
``least``, by default a half: its language is then more likely wrong than right.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; repeated rows give a result row each; without training rows every
text is ``und``; an empty table gives an empty result; further columns are
never read; rows of null lang or doc_id are never learned from; a null doc_id
gives a row of null id that is not held out. Very long texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.customers import salted_join

from .tables import remainder, table
from .textblocks import SPACE, Block, blocks, mix

BUCKETS = 1 << 16
UNDETERMINED = "und"
#: Rows of a language that are ordered for its ``per_lang`` training rows, as a multiple of them.
WIDER = 4

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def subwords(b: Block, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every subword of a lower-cased block."""
    start, end, row = b.words()
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, rows = [(b.hashes(start, end) % np.uint64(buckets)).astype(np.int64)], [row]
    # Bytes with one boundary byte before and after each word; no sequence leaves its word.
    length = end - start + 2
    at = np.cumsum(length) - length
    padded = np.zeros(int(length.sum()), np.uint32)
    solid = ~SPACE[b.data]
    inner = np.ones(len(padded), bool)
    inner[at] = False
    inner[at + length - 1] = False
    padded[inner] = b.data[solid].astype(np.uint32) + 1
    owner = np.repeat(np.arange(len(start)), length)
    for n in (3, 4):
        if len(padded) < n:
            continue
        whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
        code = np.zeros(len(padded) - n + 1, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + padded[k : len(padded) - n + 1 + k]
        ids.append((mix(code[whole] + np.uint64(n << 40)) % np.uint64(buckets)).astype(np.int64))
        rows.append(row[owner[: len(whole)][whole]])
    return np.concatenate(ids), np.concatenate(rows)


def has_letter(b: Block) -> np.ndarray:
    """Whether each text of the block has a letter of any script."""
    found = b.per_row(_LETTER[b.data]) > 0
    for k in np.flatnonzero(~found & (b.per_row(b.data >= 0x80) > 0)):
        text = b.data[b.offs[k] : b.offs[k + 1]].tobytes().decode("utf-8", "replace")
        found[k] = any(c.isalpha() for c in text)
    return found


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # a row of class scores for each bucket
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """Class and calibrated probability of each text of a block."""
        rows, n = b.hi - b.lo, len(self.languages)
        ids, row = subwords(b.lower(), len(self.scores))
        size = np.maximum(np.bincount(row, minlength=rows), 1)
        logits = np.column_stack([np.bincount(row, self.scores[ids, k], rows) for k in range(n)]) / size[:, None] + self.bias
        p = _softmax(logits / self.temperature)
        best = np.argmax(p, axis=1)
        return best, p[np.arange(rows), best]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _sparse(texts: list[str], buckets: int):
    """Per text: its distinct buckets and their shares."""
    ids, share, offs = [], [], [0]
    for b in blocks(pa.array(texts, pa.string())):
        i, row = subwords(b.lower(), buckets)
        key, n = np.unique(row * buckets + i, return_counts=True)
        per = np.bincount(row, minlength=b.hi - b.lo)
        r = key // buckets
        ids.append((key % buckets).astype(np.int32))
        share.append((n / np.maximum(per[r], 1)).astype(np.float32))
        offs.extend((offs[-1] + np.cumsum(np.bincount(r, minlength=b.hi - b.lo))).tolist())
    return np.concatenate(ids or [np.zeros(0, np.int32)]), np.concatenate(share or [np.zeros(0, np.float32)]), np.array(offs)


def fit_model(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 8, rate: float = 0.5, batch: int = 64, buckets: int = BUCKETS, least: float = 0.5) -> LanguageModel:
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(11)
    held = rng.random(len(texts)) < 0.2
    rows, y, test = list(texts), [names.index(x) for x in langs], list(held)
    for t, lang, h in zip(texts, langs, held, strict=True):
        words = t.split()
        for _ in range(2):
            if len(words) > 1:
                n = int(rng.integers(1, 13))
                k = int(rng.integers(0, max(1, len(words) - n)))
                rows.append(" ".join(words[k : k + n]))
                y.append(names.index(lang))
                test.append(h)
    ids, share, offs = _sparse(rows, buckets)
    y, test = np.array(y), np.array(test)
    table_, layer, bias = (rng.normal(0, 1 / dim, (buckets, dim)).astype(np.float32), np.zeros((dim, len(names)), np.float32), np.zeros(len(names), np.float32))
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    train = np.flatnonzero(~test)
    seen = np.zeros(buckets, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(train)
        for lo in range(0, len(train), batch):
            part = order[lo : lo + batch]
            spans = [slice(offs[k], offs[k + 1]) for k in part]
            i = np.concatenate([ids[s] for s in spans])
            w = np.concatenate([share[s] for s in spans])
            owner = np.repeat(np.arange(len(part)), [s.stop - s.start for s in spans])
            rows_of = table_[i]
            x = np.zeros((len(part), dim), np.float32)
            if len(i):
                begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                x[owner[begins]] = np.add.reduceat(rows_of * w[:, None], begins, axis=0)
            g = _softmax(x @ layer + bias)
            g[np.arange(len(part)), y[part]] -= 1
            back = g @ layer.T
            layer -= step * (x.T @ g) / len(part)
            bias -= step * g.mean(axis=0)
            if len(i):
                # Rows seldom met take larger steps (AdaGrad, one figure for each row).
                by = np.argsort(i, kind="stable")
                begins = np.flatnonzero(np.r_[True, np.diff(i[by]) > 0])
                slope = np.add.reduceat((w[:, None] * back[owner])[by], begins, axis=0)
                met = i[by][begins]
                seen[met] += (slope**2).mean(axis=1)
                table_[met] -= step * 0.5 * slope / np.sqrt(seen[met] + 1e-12)[:, None]
    scores = table_ @ layer
    cal = np.flatnonzero(test) if test.any() else np.arange(len(y))
    logits = np.vstack([(share[offs[k] : offs[k + 1], None] * scores[ids[offs[k] : offs[k + 1]]]).sum(axis=0) for k in cal]) + bias
    grid = np.geomspace(0.1, 10, 41)
    temperature = float(grid[np.argmin([-np.log(_softmax(logits / t)[np.arange(len(cal)), y[cal]] + 1e-12).mean() for t in grid])])
    return LanguageModel(names, scores.astype(np.float32), bias.astype(float), temperature, least)


def fit_languages(docs: DataFrame, per_lang: int = 600) -> LanguageModel:
    """Train on documents whose id remainder (crc32 mod 4) is not 2 and whose lang is known."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    own = own.where(F.col("lang").isNotNull() & (remainder("doc_id", 4) != 2)).withColumn("h", F.xxhash64("doc_id"))
    # A language's rows are cut to a few times ``per_lang`` by their hash before one task orders them.
    counts = own.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    place = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    own = salted_join(own, counts, "lang", "doc_id", "inner").where(place <= F.lit(float(WIDER * per_lang)) / F.col("_n"))
    own = own.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("k") <= per_lang)
    picked = F.broadcast(own.select("doc_id").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = texts.where("lang is not null and text is not null").join(picked, "doc_id", "left_semi").toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "lang", "text")])
    return fit_model(rows["text"].to_pylist(), rows["lang"].to_pylist())


def _judge(b: Block, m: LanguageModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class (one more than the last: undetermined), score and acceptance of each text."""
    known = has_letter(b)
    if not m.languages:
        return np.zeros(b.hi - b.lo, int), np.zeros(b.hi - b.lo), np.zeros(b.hi - b.lo, bool)
    best, p = m.predict(b)
    score = np.where(known, p, 0.0)
    return np.where(known, best, len(m.languages)), score, known & (score >= m.threshold)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], object)
        for batch in batches:
            parts = [_judge(b, m) for b in blocks(batch.column(2))] or [(np.zeros(0, int), np.zeros(0), np.zeros(0, bool))]
            k, score, keep = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[k], pa.string()), pa.array(score, pa.float64()), pa.array(keep, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = [_judge(b, shared.value)[2] for b in blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs))
