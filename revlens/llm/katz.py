"""Language-model scoring: a Katz backoff model in partitioned tables (operator 6).

Texts have A-Z lower-cased; their tokens are words and one end. The lowest
level is the contract's base: (c + 1) / (N + V + 1) with one share for all
unseen words, so it sums to 1. Above it stand all bigrams of the training texts,
whatever their words' counts, with the start and the end; they are counted
without a limit, in tables that are partitioned by a hash of the key.

The most frequent repeated words, at most ``SHARE``, are listed: what is known of them is broadcast, and bigrams of two listed words go
by their numbers. Bigrams with another word go by their words' hashes, and
fetch what is known of these words from the word's partition. The list saves
exchanges only; no result depends on it.

Counts up to ``K`` are discounted by Good and Turing's rule. A history h keeps
the mass of its discounted bigrams; where that would leave nothing, one count
in c(h) + 1 is set aside. The rest goes to the words not seen after h by the
lowest level, times alpha(h) = (1 - kept mass) / (1 - lowest level of the seen
words), so every history's probabilities sum to exactly 1. A history without
bigrams goes straight to the lowest level.

Nothing is sent token by token. Tasks gather the distinct keys of many texts
with the texts they stand in, in binary columns; a partition meets the counts
of its keys, and sends on one partial sum for each text, in binary columns again.
There is a partition for every ``PART_BYTES`` of text, up to ``FINER`` times the
session's shuffle partitions, and a row of a table holds at most ``ROW_KEYS``
keys.

Words are known by the 64-bit hash of their bytes.

Defined results: null and empty texts have the end token alone; repeated rows
are counted and scored each; a null doc_id counts as training; without training
rows N and V are 0, and every token has probability 1; an empty table gives an
empty result; further columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import remainder, stored, table
from .textblocks import Block, blocks, mix

SHARE = 1_000_000
K = 5
#: Tokens that a task gathers before it sends them on.
GATHER = 1 << 21
#: Keys in one row of a table, text of one partition, and partitions for each shuffle partition of the session at most.
ROW_KEYS, PART_BYTES, FINER = 1 << 16, 8 << 20, 4
_MOST = 1 << 16  # counts from here on are one when the list is chosen
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token's hash
START = np.uint64(0x14057B7EF767814F)  # and for that of the start, which is a history only

NO_ID = -(1 << 63)  # stands for a null doc_id

_COLUMNS = ["r", "kind", "keys", "counts", "texts", "ids"]
_SCHEMA = "r int, kind int, keys binary, counts binary, texts binary, ids binary"
_ARROW = pa.schema([pa.field(c, pa.int32() if c in ("r", "kind") else pa.binary()) for c in _COLUMNS])
MODEL_WORDS, MODEL_PAIRS, MODEL_RARE, MODEL_ALPHA, WORDS, PAIRS, RARE, TEXTS = range(8)


def _parts(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    most = FINER * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(most, -(-size // PART_BYTES)))


def _own(docs: DataFrame, keep) -> DataFrame:
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.col("text").cast("string").alias("text"))
    return own.where(keep(F.col("held"))) if keep else own


def tokens(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token; each row ends with END."""
    low = b.lower()
    start, end, row = low.words()
    rows = b.hi - b.lo
    n = np.bincount(row, minlength=rows)
    stop = np.cumsum(n + 1) - 1
    out = np.empty(len(start) + rows, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[stop] = False
    out[is_word] = low.hashes(start, end) if len(start) else np.zeros(0, np.uint64)
    out[stop] = END
    return out, np.repeat(np.arange(rows), n + 1)


def _both(pairs: np.ndarray) -> np.ndarray:
    """Hash of each bigram from the hashes of its two words."""
    return mix(pairs[:, 0] * np.uint64(0x9E3779B97F4A7C15) + pairs[:, 1])


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if keys.ndim == 2:
        _, first, back = np.unique(_both(keys), return_index=True, return_inverse=True)
        return keys[first], np.bincount(back, counts, len(first)).astype(np.int64)
    if counts is None:
        return np.unique(keys, return_counts=True)
    out, back = np.unique(keys, return_inverse=True)
    return out, np.bincount(back, counts, len(out)).astype(np.int64)


def _split(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """Positions of the keys of each part, in order."""
    keys = _both(keys) if keys.ndim == 2 else keys
    part = (mix(keys ^ np.uint64(0xA5A5A5A5)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.cumsum(np.bincount(part, minlength=parts))[:-1])


def _packed(keys: np.ndarray) -> np.ndarray:
    """Steps between keys, first all their lowest bytes and so on: sorted keys leave mostly zeros, which compress."""
    if keys.ndim == 2:
        return keys
    return np.ascontiguousarray(np.diff(keys, prepend=keys.dtype.type(0)).view(np.uint8).reshape(-1, 8).T)


def _each(batches):
    """The rows of Arrow batches one by one; binary columns as buffers, without a copy."""
    for batch in batches:
        columns = [(f.name, c, pa.types.is_binary(f.type)) for f, c in zip(batch.schema, batch.columns, strict=True)]
        for k in range(batch.num_rows):
            yield {name: (c[k].as_buffer() if binary else c[k].as_py()) for name, c, binary in columns}


def _unpacked(data) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """Binary rows; arrays are stored by their bytes, single keys packed."""
    cols = list(zip(*rows, strict=True))
    cols[2] = [_packed(x) for x in cols[2]]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in cols[2:])], _COLUMNS)


_NONE = np.zeros(0, np.uint8)


def _send_counts(parts: int, keys_of):
    """Tasks send distinct keys with their counts; ``keys_of`` gives a block's keys by kind."""

    def flush(held):
        rows = []
        for kind, own in held.items():
            keys, counts = _counted(np.concatenate(own))
            rows += [(r, kind, keys[at], counts[at].astype(np.uint32), _NONE, _NONE) for r, at in enumerate(_split(keys, parts)) if len(at)]
        return _rows(rows)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for b in blocks(batch.column(0)):
                for kind, keys in keys_of(b).items():
                    if len(keys):
                        held.setdefault(kind, []).append(keys)
                        size += len(keys)
                if size >= GATHER:
                    yield flush(held)
                    held, size = {}, 0
        if size:
            yield flush(held)

    return run


def _keys(row: dict) -> np.ndarray:
    """Single keys, or both hashes of bigrams with a word outside the list."""
    return np.frombuffer(row["keys"], np.uint64).reshape(-1, 2) if row["kind"] == MODEL_RARE else _unpacked(row["keys"])


def _merge(batches):
    """A partition's keys with their sums, sorted, in rows of one kind and at most ``ROW_KEYS`` keys."""
    held: dict[int, tuple[list, list]] = {}
    for row in _each(batches):
        keys, counts = held.setdefault(row["kind"], ([], []))
        keys.append(_keys(row))
        counts.append(np.frombuffer(row["counts"], np.uint32))
        if sum(map(len, keys)) > 4 * GATHER and len(keys) > 1:
            k, c = _counted(np.concatenate(keys), np.concatenate(counts))
            keys[:], counts[:] = [k], [c]
    for kind, (keys, counts) in held.items():
        k, c = _counted(np.concatenate(keys), np.concatenate(counts))
        keys.clear()
        counts.clear()
        for at in range(0, len(k), ROW_KEYS):
            own, n = k[at : at + ROW_KEYS], c[at : at + ROW_KEYS].astype(np.int64)
            row = [pa.array([kind], pa.int32()), pa.array([_packed(own).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary()), pa.array([int(n.sum())], pa.int64()), pa.array([len(own)], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, ["kind", "keys", "counts", "total", "distinct"])


_TABLE = "kind int, keys binary, counts binary, total long, distinct long"


@dataclass
class Model:
    """Bounded arrays for the listed words, and the tables of all words and bigrams."""

    words: DataFrame
    pairs: DataFrame
    rare: DataFrame  # gains of bigrams with a word outside the list, and log10 alpha of such histories
    n: int
    v: int
    parts: int
    shared: object  # broadcast: listed words' hashes (sorted), counts, log10 alpha, kept-mass scale, discounts

    @property
    def bottom(self) -> float:
        return float(np.log10(self.n + self.v + 1))


def _numbers(h: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """List numbers of words (-1: not listed)."""
    at = np.searchsorted(vocabulary, h)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == h, at, -1) if len(vocabulary) else np.full(len(h), -1)


def _history_numbers(h: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    return np.where(h == START, len(vocabulary), _numbers(h, vocabulary))


def _pair_keys(h: np.ndarray, row: np.ndarray, vocabulary: np.ndarray):
    """For every token: its list number (or -1) and that of the token before it; the number after the last stands for the start."""
    own = _numbers(h, vocabulary)
    before = np.empty_like(own)
    before[1:] = own[:-1]
    begins = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
    before[begins] = len(vocabulary)
    return own, before


def _key(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64)


def _rare_pairs(h: np.ndarray, row: np.ndarray, own: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of each bigram with a word outside the list, and its row."""
    first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
    rare = np.flatnonzero((own < 0) | (before < 0))
    return np.column_stack([np.where(first[rare], START, h[rare - 1]), h[rare]]), row[rare]


def _found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Values of the asked keys, 0 where unknown; ``keys`` are sorted."""
    if not len(keys):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0).astype(values.dtype)


def _sorted_table(parts: list[tuple[np.ndarray, np.ndarray]], dtype) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts] or [np.zeros(0, np.uint64)])
    values = np.concatenate([c for _, c in parts] or [np.zeros(0, dtype)])
    order = np.argsort(keys)
    return keys[order], values[order]


_RESOLVED = "listed boolean, keys binary, counts binary, own binary, before binary"


def _resolved(words: DataFrame, pairs: DataFrame, parts: int, shared_list) -> DataFrame:
    """Bigrams with a word outside the list, with both words' counts.

    A bigram goes to its word's partition for that word's count and on to its
    history's. Words outside the list are rare, so none has many bigrams; a
    bigram of a listed history has the count there already and is spread by both words.
    A history outside the list has all its bigrams in one row; rows are cut
    between histories, at about ``ROW_KEYS`` bigrams.
    """

    def to_history(keys, counts, own):
        vocabulary, _ = shared_list.value
        rare = _numbers(keys[:, 0], vocabulary) < 0
        rare &= keys[:, 0] != START
        for r, at in enumerate(_split(np.where(rare, keys[:, 0], _both(keys)), parts)):
            if len(at):
                yield (r, MODEL_RARE, keys[at], counts[at].astype(np.uint32), own[at].astype(np.uint32) if own.max() < 1 << 32 else own[at], _NONE)

    def ask(batches):
        vocabulary, _ = shared_list.value
        for row in _each(batches):
            keys, counts = _keys(row), np.frombuffer(row["counts"], np.int64)
            rare = np.flatnonzero(_numbers(keys[:, 1], vocabulary) < 0)
            keys, counts = keys[rare], counts[rare]
            out = [(r, MODEL_RARE, keys[at], counts[at].astype(np.uint32), _NONE, _NONE) for r, at in enumerate(_split(keys[:, 1], parts)) if len(at)]
            if out:
                yield _rows(out)

    def listed_word(batches):
        vocabulary, count = shared_list.value
        for row in _each(batches):
            keys, counts = _keys(row), np.frombuffer(row["counts"], np.int64)
            number = _numbers(keys[:, 1], vocabulary)
            use = number >= 0
            if use.any():
                yield _rows(list(to_history(keys[use], counts[use], count[number[use]])))

    def unlisted(batches):
        """Counts of words outside the list."""
        vocabulary, _ = shared_list.value
        for row in _each(batches):
            keys, counts = _keys(row), np.frombuffer(row["counts"], np.int64)
            use = _numbers(keys, vocabulary) < 0
            out = [(r, MODEL_WORDS, keys[use][at], counts[use][at], _NONE, _NONE) for r, at in enumerate(_split(keys[use], parts)) if len(at)]
            if out:
                yield _rows(out)

    def gathered(batches):
        known, asked = [], []
        for row in _each(batches):
            if row["kind"] == MODEL_WORDS:
                known.append((_keys(row), np.frombuffer(row["counts"], np.int64)))
            else:
                counts = np.frombuffer(row["counts"], np.uint32)
                own = np.frombuffer(row["texts"], np.uint32 if len(row["texts"]) == 4 * len(counts) else np.int64)
                asked.append((_keys(row), counts, own))
        return _sorted_table(known, np.int64), asked

    def by_word(batches):
        (words, count), asked = gathered(batches)
        for keys, counts, _ in asked:
            own = _found(words, count, keys[:, 1])
            yield _rows(list(to_history(keys, counts, own)))

    def by_history(batches):
        vocabulary, _ = shared_list.value
        (words, count), asked = gathered(batches)
        if not asked:
            return
        keys, counts, own = (np.concatenate([a[k] for a in asked]) for k in range(3))
        listed = _history_numbers(keys[:, 0], vocabulary) >= 0
        before = _found(words, count, keys[:, 0])
        for use, flag in ((listed, True), (~listed, False)):
            own_keys = keys[use]
            order = np.argsort(own_keys[:, 0], kind="stable")
            columns = [x[use][order].astype(t) for x, t in ((keys, np.uint64), (counts, np.int64), (own, np.int64), (before, np.int64))]
            name = columns[0][:, 0]
            at = 0
            while at < len(name):
                end = min(at + ROW_KEYS, len(name))
                if not flag:  # the rest of the last history too
                    end = int(np.searchsorted(name, name[end - 1], side="right"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flag]), *(pa.array([x[at:end].tobytes()], pa.binary()) for x in columns)], ["listed", "keys", "counts", "own", "before"]
                )
                at = end

    rare = pairs.where(F.col("kind") == MODEL_RARE).select("kind", "keys", "counts")
    counted = words.select("kind", "keys", "counts").mapInArrow(unlisted, _SCHEMA)
    first = rare.mapInArrow(ask, _SCHEMA).unionByName(counted).repartition(parts, "r").mapInArrow(by_word, _SCHEMA)
    second = first.unionByName(rare.mapInArrow(listed_word, _SCHEMA)).unionByName(counted)
    return stored(second.repartition(parts, "r").mapInArrow(by_history, _RESOLVED), "katz-rare")


def _of_resolved(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["keys"], np.uint64).reshape(-1, 2), *(np.frombuffer(row[x], np.int64) for x in ("counts", "own", "before"))


def _gains(resolved: DataFrame, n: int, v: int, parts: int, shared) -> DataFrame:
    """What each of these bigrams adds to its history's alpha and its word's lowest level; log10 alpha of their histories outside the list."""

    def run(batches):
        vocabulary, history, alpha, scale, d = shared.value
        for row in _each(batches):
            keys, c, own, before = _of_resolved(row)
            kept = np.where(c <= K, d[np.minimum(c, K)], 1.0) * c
            low = (own + 1) / (n + v + 1)
            out = []
            if row["listed"]:
                h = _history_numbers(keys[:, 0], vocabulary)
                p, a = kept * scale[h] / history[h], alpha[h]
            else:
                name, first, back = np.unique(keys[:, 0], return_index=True, return_inverse=True)
                of = before[first].astype(float)
                share, most = np.bincount(back, kept, len(name)) / of, 1 - 1 / (of + 1)
                by = np.where(share > most, most / np.maximum(share, 1e-300), 1.0)
                own_alpha = np.log10((1 - share * by) / np.maximum(1 - np.bincount(back, low, len(name)), 1e-12))
                p, a = kept * by[back] / of[back], own_alpha[back]
                out += [(r, MODEL_ALPHA, name[at], own_alpha[at], _NONE, _NONE) for r, at in enumerate(_split(name, parts)) if len(at)]
            key, gain = _both(keys), np.log10(np.maximum(p, 1e-300)) - a - np.log10(low)
            order = np.argsort(key)
            key, gain = key[order], gain[order]
            yield _rows(out + [(r, MODEL_RARE, key[at], gain[at], _NONE, _NONE) for r, at in enumerate(_split(key, parts)) if len(at)])

    return resolved.mapInArrow(run, _SCHEMA)


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discounts for counts 1 to K from counts of counts n[1..K+1]; 1 above K."""
    d = np.ones(K + 1)
    if n[1] > 0:
        common = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] > 0 else 1.0
            d[r] = (ratio - common) / (1 - common) if common < 1 else 1.0
            # Small corpora give figures outside (0, 1); a fixed discount takes their place.
            if not 0.05 < d[r] < 1:
                d[r] = 1 - 0.5 / r
    return d


def fit(docs: DataFrame, share: int = SHARE) -> Model:
    """Count the training rows (crc32 of the id mod 7 is not 2)."""
    spark = docs.sparkSession
    parts = _parts(docs)
    train = _own(docs, lambda held: ~held).select("text")

    run = _send_counts(parts, lambda b: {MODEL_WORDS: tokens(b)[0]})
    words = stored(train.mapInArrow(run, _SCHEMA).repartition(parts, "r").mapInArrow(_merge, _TABLE), "katz-words")
    n, v = words.agg(F.sum("total"), F.sum("distinct")).first()
    n, v = n or 0, v or 0

    def how_often(batches):
        for batch in batches:
            for counts in map(pa.BinaryScalar.as_buffer, batch.column(0)):
                c, words_of = np.unique(np.minimum(np.frombuffer(counts, np.int64), _MOST), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(words_of)], ["count", "words"])

    often = words.select("counts").mapInArrow(how_often, "count long, words long").groupBy("count").agg(F.sum("words").alias("words")).collect()  # at most _MOST rows
    least, listed_words = max(2, -(-n // share)), 0  # words of that count or more are at most ``share``
    for r in sorted(often, reverse=True):
        listed_words += r["words"]
        if r["count"] < 2 or listed_words > share:
            break
        least = min(least, r["count"])

    def frequent(batches):
        for batch in batches:
            for keys, counts in zip(map(pa.BinaryScalar.as_buffer, batch.column(0)), map(pa.BinaryScalar.as_buffer, batch.column(1)), strict=True):
                k, c = _unpacked(keys), np.frombuffer(counts, np.int64)
                use = (c >= least) | (k == END)
                yield pa.RecordBatch.from_arrays([pa.array(k[use].view(np.int64)), pa.array(c[use])], ["word", "count"])

    listed = words.select("keys", "counts").mapInArrow(frequent, "word long, count long").toArrow()  # at most share words and the end
    vocabulary = listed["word"].to_numpy().view(np.uint64)
    order = np.argsort(vocabulary)
    vocabulary, count = vocabulary[order], listed["count"].to_numpy()[order]
    starts = train.count() if n else 0
    history = np.r_[count, starts].astype(float)
    shared_words = spark.sparkContext.broadcast(vocabulary)

    def keys_of(b: Block):
        h, row = tokens(b)
        own, before = _pair_keys(h, row, shared_words.value)
        both = (own >= 0) & (before >= 0)
        return {MODEL_PAIRS: _key(before[both], own[both]), MODEL_RARE: _rare_pairs(h, row, own, before)[0]}

    run = _send_counts(parts, keys_of)
    every = stored(train.mapInArrow(run, _SCHEMA).repartition(parts, "r").mapInArrow(_merge, _TABLE), "katz-pairs", by="kind")
    pairs = every.where(F.col("kind") == MODEL_PAIRS)
    resolved = _resolved(words, every, parts, spark.sparkContext.broadcast((vocabulary, count)))
    lowest = (count + 1) / (n + v + 1)
    shared_lowest = spark.sparkContext.broadcast(lowest)
    stat = ["h", *(f"s{r}" for r in range(1, K + 2)), "more", "seen"]

    def histories(batches):
        """Per history: bigrams of each count up to K + 1, tokens of those above K, lowest level of the seen words."""
        low = shared_lowest.value
        for batch in batches:
            for keys, counts in zip(map(pa.BinaryScalar.as_buffer, batch.column(0)), map(pa.BinaryScalar.as_buffer, batch.column(1)), strict=True):
                k, c = _unpacked(keys), np.frombuffer(counts, np.int64)
                h, back = np.unique((k >> np.uint64(32)).astype(np.int64), return_inverse=True)
                w = (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
                cols = [np.bincount(back, c == r, len(h)) for r in range(1, K + 2)]
                cols += [np.bincount(back, np.where(c > K, c, 0), len(h)), np.bincount(back, low[w], len(h))]
                yield pa.RecordBatch.from_arrays([pa.array(h), *(pa.array(x.astype(float)) for x in cols)], stat)

    def rare_histories(batches):
        """The same of bigrams with a word outside the list; -1 stands for all histories outside it."""
        vocabulary = shared_words.value
        for row in _each(batches):
            keys, c, own, _ = _of_resolved(row)
            h, back = np.unique(_history_numbers(keys[:, 0], vocabulary), return_inverse=True)
            cols = [np.bincount(back, c == r, len(h)) for r in range(1, K + 2)]
            cols += [np.bincount(back, np.where(c > K, c, 0), len(h)), np.bincount(back, (own + 1) / (n + v + 1), len(h))]
            yield pa.RecordBatch.from_arrays([pa.array(h), *(pa.array(x.astype(float)) for x in cols)], stat)

    schema = "h long, " + ", ".join(f"{x} double" for x in stat[1:])
    sums = pairs.select("keys", "counts").mapInArrow(histories, schema).unionByName(resolved.mapInArrow(rare_histories, schema))
    sums = stored(sums.groupBy("h").agg(*(F.sum(x).alias(x) for x in stat[1:])), "katz-histories")
    by_count = np.zeros(K + 2)
    by_count[1:] = [x or 0 for x in sums.agg(*(F.sum(f"s{r}") for r in range(1, K + 2))).first()]
    d = discounts(by_count)
    scale, alpha = np.ones(len(history)), np.zeros(len(history))  # no bigram: all to the lowest level, log10 alpha 0
    mass = sum((F.col(f"s{r}") * float(d[r] * r) for r in range(1, K + 1)), F.col("more")).alias("mass")
    sums = sums.where("h >= 0").select("h", mass, "seen").toArrow()  # a row for each listed word and the start at most
    h = sums["h"].to_numpy()
    kept = sums["mass"].to_numpy() / history[h] if len(h) else np.zeros(0)
    most = 1 - 1 / (history[h] + 1)
    scale[h] = np.where(kept > most, most / np.maximum(kept, 1e-300), 1.0)
    alpha[h] = np.log10((1 - kept * scale[h]) / np.maximum(1 - sums["seen"].to_numpy(), 1e-12))
    shared = spark.sparkContext.broadcast((vocabulary, history, alpha, scale, d))
    return Model(words, pairs, _gains(resolved, n, v, parts, shared), n, v, parts, shared)


def _send_texts(model: Model):
    """Tasks send, for many texts at once: words outside the list, bigrams, and what they know of the texts already."""
    parts, shared = model.parts, model.shared

    def flush(words, pairs, rare, texts):
        rows = []
        base, count = texts[0][0][0], sum(len(t[0]) for t in texts)  # texts are numbered one after the other
        place = np.uint16 if count <= 65536 else np.uint32
        for kind, held in ((WORDS, words), (PAIRS, pairs), (RARE, rare)):
            key, text = (np.concatenate([x[k] for x in held]) for k in (0, 1))
            order = np.argsort(key, kind="stable")
            key, text = key[order], text[order]
            begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.r_[begins, len(key)])
            for r, at in enumerate(_split(key[begins], parts)):
                if len(at):
                    n = size[at]
                    inside = np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    rows.append((r, kind, key[begins[at]], n.astype(np.uint32), text[inside].astype(place), np.array([base, count])))
        known = [np.concatenate([t[k] for t in texts]) for k in range(7)]
        part = known[0] % parts
        for r in np.unique(part):
            at = part == r
            rows.append((int(r), TEXTS, known[0][at], known[1][at], np.column_stack([x[at] for x in known[2:]]).astype(float), _NONE))
        return _rows(rows)

    def run(batches):
        vocabulary, history, alpha, _, _ = shared.value
        number = TaskContext.get().partitionId() << 40
        words, pairs, rare, texts, size, first = [], [], [], [], 0, 0
        for batch in batches:
            ids, held = batch.column(0).fill_null(NO_ID).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(2)):
                h, row = tokens(b)
                row = row.astype(np.int32)
                own, before = _pair_keys(h, row, vocabulary)
                rows = b.hi - b.lo
                listed = own >= 0
                c = np.where(listed, history[own], 0)
                gain = np.bincount(row, np.where(~listed & (before >= 0), alpha[before], 0), rows)
                both = listed & (before >= 0)
                words.append((h[~listed], row[~listed] + first))
                pairs.append((_key(before[both], own[both]), row[both] + first))
                others, their_row = _rare_pairs(h, row, own, before)
                rare.append((_both(others), their_row + first))
                texts.append((number + np.arange(rows), ids[b.lo : b.hi], held[b.lo : b.hi], np.bincount(row, minlength=rows), np.bincount(row, listed, rows), np.bincount(row, np.log10(c + 1), rows), gain))
                number += rows
                first += rows
                size += len(h)
                if size >= GATHER:
                    yield flush(words, pairs, rare, texts)
                    words, pairs, rare, texts, size, first = [], [], [], [], 0, 0
        if texts:
            yield flush(words, pairs, rare, texts)

    return run


def _score(model: Model):
    """A partition's keys meet their counts; the texts' partial sums go on in binary rows, by text."""
    shared, bottom, parts = model.shared, model.bottom, model.parts

    def flush(sums):
        """sums: (text, values) arrays; values are n_known, low and gain."""
        uid, back = np.unique(np.concatenate([u for u, _ in sums]), return_inverse=True)
        values = np.concatenate([v for _, v in sums])
        total = np.column_stack([np.bincount(back, values[:, k], len(uid)) for k in range(3)])
        part = uid % parts
        return _rows([(int(r), WORDS, uid[part == r], _NONE, total[part == r], _NONE) for r in np.unique(part)])

    def run(batches):
        _, history, alpha, scale, d = shared.value
        known: dict[int, list] = {MODEL_WORDS: [], MODEL_PAIRS: [], MODEL_RARE: [], MODEL_ALPHA: []}
        sent: dict[tuple[int, int], list] = {}
        for row in _each(batches):
            kind = row["kind"]
            if kind in known:
                known[kind].append((_unpacked(row["keys"]), np.frombuffer(row["counts"], np.int64 if kind in (MODEL_WORDS, MODEL_PAIRS) else float)))
            elif kind != TEXTS:
                sent.setdefault(tuple(np.frombuffer(row["ids"], np.int64).tolist()), []).append(row)
            else:  # what the sender knew of the texts passes through
                yield pa.RecordBatch.from_pylist([{k: v if isinstance(v, int) else v.to_pybytes() for k, v in row.items()}], schema=_ARROW)
        tables = {kind: _sorted_table(known.pop(source), np.int64 if kind != RARE else float) for kind, source in ((WORDS, MODEL_WORDS), (PAIRS, MODEL_PAIRS), (RARE, MODEL_RARE))}
        alpha_keys, alphas = _sorted_table(known[MODEL_ALPHA], float)
        sums, size = [], 0
        for base, count in sorted(sent):  # the rows of one sending together: its texts have one partial sum each
            values = np.zeros((count, 3))
            for row in sent.pop((base, count)):
                keys, n = _unpacked(row["keys"]), np.frombuffer(row["counts"], np.uint32).astype(np.int64)
                place = np.frombuffer(row["texts"], np.uint16 if count <= 65536 else np.uint32)
                kind = row["kind"]
                c = _found(*tables[kind], keys)
                total = lambda x, place=place, n=n, count=count: np.bincount(place, np.repeat(x, n), count)
                if kind == WORDS:
                    values[:, 0] += total(c > 0)
                    values[:, 1] += total(np.log10(c + 1.0))
                    # Every word is the history of one more token.
                    values[:, 2] += total(_found(alpha_keys, alphas, keys))
                elif kind == RARE:
                    values[:, 2] += total(c)
                else:
                    h, w = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    own = np.log10(np.maximum(np.where(c <= K, d[np.minimum(c, K)], 1.0) * c * scale[h] / np.maximum(history[h], 1), 1e-300))
                    gain = np.where(c > 0, own - (np.log10(history[w] + 1) - bottom), alpha[h])
                    values[:, 2] += total(gain)
            some = np.flatnonzero(values.any(axis=1))
            if len(some):
                sums.append((base + some, values[some]))
                size += len(some)
            if size >= GATHER:
                yield flush(sums)
                sums, size = [], 0
        if sums:
            yield flush(sums)

    return run


def _total(batches):
    """One row for each text, from all its partial sums."""
    texts, sums = [], []
    for row in _each(batches):
        uid, values = _unpacked(row["keys"]).view(np.int64), np.frombuffer(row["texts"], float)
        if row["kind"] == TEXTS:
            texts.append((uid, np.frombuffer(row["counts"], np.int64), values.reshape(-1, 5)))
        else:
            sums.append((uid, values.reshape(-1, 3)))
    if not texts:
        return
    uid, ids, own = (np.concatenate([t[k] for t in texts]) for k in range(3))
    order = np.argsort(uid)
    uid, ids, own = uid[order], ids[order], own[order]
    total = own[:, 2:].copy()  # n_known, low and gain as the sender knew them
    for text, values in sums:
        np.add.at(total, np.searchsorted(uid, text), values)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "low", "gain"]
    for lo in range(0, len(uid), 1 << 16):
        k = slice(lo, lo + (1 << 16))
        doc = pa.array(ids[k], mask=ids[k] == NO_ID)
        yield pa.RecordBatch.from_arrays([doc, pa.array(own[k, 0] > 0), pa.array(own[k, 1].astype(np.int64)), pa.array(total[k, 0].astype(np.int64)), pa.array(total[k, 1]), pa.array(total[k, 2])], names)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, counts, base_score and score of every row."""
    sent = _own(docs, None).mapInArrow(_send_texts(model), _SCHEMA)
    parts = model.parts

    def numbered(batches):
        for row in _each(batches):
            keys, counts = _unpacked(row["keys"]), np.frombuffer(row["counts"], np.int64)
            yield _rows([(r, row["kind"], keys[at], counts[at], _NONE, _NONE) for r, at in enumerate(_split(keys, parts)) if len(at)])

    for tables in (model.words, model.pairs):
        sent = sent.unionByName(tables.select("kind", "keys", "counts").mapInArrow(numbered, _SCHEMA))
    sent = sent.unionByName(model.rare)
    sums = sent.repartition(parts, "r").mapInArrow(_score(model), _SCHEMA).repartition(parts, "r")
    rows = sums.mapInArrow(_total, "doc_id long, held_out boolean, n_tokens long, n_known long, low double, gain double")
    base = F.col("low") - F.col("n_tokens") * F.lit(model.bottom)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs))
