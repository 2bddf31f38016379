"""Spelling variants of words: PartEnum signatures over letter multisets (operator 13).

A word's letters form a multiset, read as a binary vector with one dimension for
each (letter, k-th occurrence). One inserted, deleted or replaced code point
changes at most two dimensions, so near words lie within Hamming distance two.
PartEnum finds all pairs within that distance by equality alone: the dimensions
are dealt to ``PARTS`` parts, and a word has one signature for every choice of
``PARTS`` - 2 parts, which holds its vector on them. Two words that differ in at
most two dimensions agree on all but two parts, hence on one signature at least.

Besides, one edit in words of six code points and more leaves the first three or
the last three alone; each signature is joined with either, which keeps words of
the same letters in another order apart. Pairs that meet are verified by their
edit distance inside the join, and found once each after it. A signature that
very many words share is dealt to a grid of tasks (``blockjoin.grid_join``).

Words are counted by document, with sums per task before the shuffle. Forms point
to words at least ``ratio`` (2 or more) times as frequent, so a chain is short:
63-bit counts allow 27 steps at five times, and five doublings of the pointers
reach the end of every chain.

Defined results: a null or empty text has no words; a null doc_id is written as
nothing (its words are hashed as ``:<run>``); every row is a document, equal rows
count each; an empty table gives an empty result; further columns are never
read. Very long texts are read whole. Ties of largest count go to the smallest
word in code-point order.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.blockjoin import grid_join

from .tables import stored, table
from .textblocks import LOWER, Block, blocks, mix

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
CHANGED_OF = 199
PARTS = 4
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 1 << 19

# Letters are A-Z, a-z and U+00C0 to U+00FF, whose UTF-8 form is C3 and a byte from 80 on.
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def runs_of(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal letter runs of a block."""
    d = b.data
    none = np.zeros(0, np.int64)
    if not len(d):
        return none, none, none
    lead = d == 0xC3
    solid = _ASCII[d] | lead
    solid[1:] |= lead[:-1]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cut = b.offs[(b.offs > 0) & (b.offs < len(d))]
    first[cut] = solid[cut]
    last[cut - 1] = solid[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(b.offs, start, side="right") - 1


def word_of(run: bytes, h: int) -> str:
    """The word a lower-cased run counts as: one code point less where ``CHANGED_OF`` divides its hash."""
    word = run.decode()
    if h % CHANGED_OF:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count_rows(batches):
    """(word, count) of one partition; a document's equal runs share one hash and are counted together."""
    held: Counter[str] = Counter()
    same: Counter[bytes] = Counter()  # runs that stay as they are, by their bytes

    def passed():
        for run, n in same.items():
            held[run.decode()] += n
        words = [w for w in held if len(w) >= MIN_LENGTH]
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])
        held.clear()
        same.clear()
        return out

    for batch in batches:
        ids = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
        for b in blocks(batch.column(1)):
            low = Block(b.lo, b.hi, LOWER[b.data], b.offs)
            start, end, row = runs_of(low)
            # A shorter run has no word of MIN_LENGTH, with or without a code point less.
            long = end - start >= MIN_LENGTH
            start, end, row = start[long], end[long], row[long]
            if not len(start):
                continue
            order = np.lexsort((low.hashes(start, end), row))
            start, end, row = start[order], end[order], row[order]
            h = low.hashes(start, end)
            new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]
            at = np.flatnonzero(new)
            n = np.diff(np.r_[at, len(h)])
            raw = low.data.tobytes()
            prefix, of = 0, -1
            for s, e, r, k in zip(start[at].tolist(), end[at].tolist(), row[at].tolist(), n.tolist(), strict=True):
                if r != of:
                    of, prefix = r, zlib.crc32(f"{ids[b.lo + r]}:".encode())
                run = raw[s:e]
                crc = zlib.crc32(run, prefix)
                if crc % CHANGED_OF:
                    same[run] += k
                else:
                    held[word_of(run, crc)] += k
            if len(held) + len(same) > HELD_WORDS:
                yield passed()
    yield passed()


def words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words of ``MIN_LENGTH`` code points that occur ``min_count`` times or more."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = own.mapInArrow(_count_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _vectors(words_: list[str], parts: int) -> np.ndarray:
    """For each word and part, a 64-bit sum that stands for the word's dimensions in that part.

    Dimension (letter, k) has its own pseudo-random value and lies in part
    (letter + k) mod ``parts``.
    """
    lengths = np.array([len(w) for w in words_])
    letters = np.frombuffer("".join(words_).encode("utf-32-le"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words_)), lengths)
    order = np.lexsort((letters, word))
    letters, word = letters[order], word[order]
    new = np.r_[True, (letters[1:] != letters[:-1]) | (word[1:] != word[:-1])]
    at = np.flatnonzero(new)
    k = np.arange(len(letters)) - np.repeat(at, np.diff(np.r_[at, len(letters)]))
    value = mix((letters * 4096 + k + 1).astype(np.uint64))
    out = np.zeros((len(words_), parts), np.uint64)
    np.add.at(out, (word, (letters + k) % parts), value)
    return out


def _signature_rows(batches, parts: int):
    """(sig, word, n): every choice of all but two parts, with the first and with the last three code points."""
    for batch in batches:
        names, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        if not names:
            continue
        vectors = _vectors(names, parts)
        ends = [np.array([zlib.crc32(e.encode()) for e in (side(w) for w in names)], np.uint64) for side in (lambda w: w[:3], lambda w: w[-3:])]
        sigs = []
        for number, left in enumerate(combinations(range(parts), parts - 2)):
            h = np.full(len(names), number + 1, np.uint64)
            for p in left:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + vectors[:, p])
            sigs += [mix(h + (e << np.uint64(1)) + np.uint64(side)) for side, e in enumerate(ends)]
        again = pa.array(np.tile(np.arange(len(names)), len(sigs)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sigs).view(np.int64)), batch.column(0).take(again), pa.array(np.tile(n, len(sigs)), pa.int64())],
            ["sig", "word", "n"],
        )


def near_pairs(counted: DataFrame, parts: int = PARTS, hot: int = 4096) -> DataFrame:
    """(word, near, n_near): every ordered pair of words at edit distance one, with the near word's count."""
    sigs = counted.select("word", "n").mapInArrow(lambda batches: _signature_rows(batches, parts), "sig long, word string, n long")
    edit = F.levenshtein(F.col("l_word"), F.col("r_word"), 1) == 1
    pairs = grid_join(sigs, sigs, "sig", "word", "word", hot, residual=(F.col("l_word") < F.col("r_word")) & edit)
    pairs = pairs.select("l_word", "l_n", "r_word", "r_n").distinct()
    both = F.array(
        F.struct(F.col("l_word").alias("word"), F.col("r_word").alias("near"), F.col("r_n").alias("n_near")),
        F.struct(F.col("r_word").alias("word"), F.col("l_word").alias("near"), F.col("l_n").alias("n_near")),
    )
    return pairs.select(F.inline(both))


def variants(docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO, parts: int = PARTS) -> DataFrame:
    """Every word with its count, form, root, number of near words and the form's count."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms of equal counts could point at each other")
    counted = stored(words(docs, min_count), "variants-words")
    # Joins of words are merged, not broadcast: the stages' files are a small part of what the driver would hold.
    best = F.min(F.struct((-F.col("n_near")).alias("minus"), F.col("near").alias("near")))
    near = near_pairs(counted, parts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    own = counted.join(near.hint("merge"), "word", "left")
    enough = -F.col("best.minus") >= ratio * F.col("n")
    rows = own.select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    rows = stored(rows, "variants-forms")
    ends = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(63 / math.log2(ratio)))):
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = stored(ends.join(step.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variants-roots")
    return rows.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
