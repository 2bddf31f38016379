"""Suffix-array dedup by external induced sorting, in shards (operator 3).

A byte goes when a string of ``length`` bytes that covers it also starts
earlier: in a document of smaller id, or earlier in the same one. Matches never
cross documents.

Only some suffixes are sorted; the others are induced from them. The sampled
suffixes are those at minimizers: of all ``GRAM``-byte strings in a window of
``length`` bytes, the leftmost of least hash. Equal windows have their sample at
the same place, so they fall into the same shard, the samples of one gram; a
sample with all windows it stands for is a short string (at most
``2 * length - GRAM`` bytes) whatever the size of the document or the shard.

1. Every sample is sent as the hash of its gram and the hash of its string.
   Strings found before are duplicates as a whole and need no sorting. Only
   grams with several different strings go on, each string once.
2. Those strings go to their gram's shard, and Spark's external sort, which
   spills to disk, puts the sampled suffixes of a shard in order. From there
   the suffixes one byte further left are induced again and again: stably by
   their first byte, in the order of the suffixes that follow them. Each tuple
   carries its place and its common prefix with the tuple before, which is one
   more than the least in the range between the two before. Neighbours with a
   common prefix of ``length`` or more are equal windows; all but the earliest
   are duplicates. Tuples that cannot reach that length any more leave.
3. Duplicate windows meet their document, which is cut.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes; repeated rows (same id and text) count as one document and each get its
result; an empty table gives an empty result; further columns are never read.
Rows of null doc_id come before all ids. Of rows of one id with unlike texts,
the earlier start comes first, and of equal starts the smaller hash of id and
text. Very long texts are read whole, in parts of ``1 << 24`` bytes that overlap.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bitmap, stored, table
from .textblocks import Block, blocks, mix

LENGTH = 100
GRAM = 20
_PLACE = 24  # bits for a place in a block; the rest of a gram's hash decides
MAP_BITS = 1 << 27
GATHER = 1 << 20  # samples a task gathers before it sends them
CHUNK = 1 << 16  # strings sorted at a time, or one whole shard if larger


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    ahead = np.minimum.accumulate(padded.reshape(-1, width), axis=1).ravel()
    behind = np.minimum.accumulate(padded.reshape(-1, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def _pieces(b: Block):
    """The block, or overlapping parts of a document too long for the place bits."""
    most = 1 << _PLACE
    if len(b.data) <= most:
        yield b, 0
        return
    step = most - LENGTH  # a block this large is one document
    for lo in range(0, len(b.data) - LENGTH + 1, step):
        part = b.data[lo : lo + step + LENGTH - 1]
        yield Block(b.lo, b.hi, part, np.array([0, len(part)], np.int64)), lo


def samples(b: Block):
    """Gram hash, string hash, row, first window, last window (in the row) and sample place of all samples."""
    out = []
    for part, shift in _pieces(b):
        n = len(part.data)
        if n < LENGTH:
            continue
        at = np.arange(n - GRAM + 1)
        gram = part.hashes(at, at + GRAM)
        low = np.uint64((1 << _PLACE) - 1)
        least = _window_minimum((gram & ~low) | at.astype(np.uint64), LENGTH - GRAM + 1)
        start = np.arange(len(least))
        row = np.searchsorted(part.offs, start, side="right") - 1
        inside = start + LENGTH <= part.offs[row + 1]
        start, row, place = start[inside], row[inside], (least[inside] & low).astype(np.int64)
        if not len(start):
            continue
        begins = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(start) > 1)])
        a, z, p, r = start[begins], start[np.r_[begins[1:], len(start)] - 1], place[begins], row[begins]
        string = mix(part.hashes(a, z + LENGTH) + (p - a).astype(np.uint64))
        base = part.offs[r] - shift
        out.append((gram[p], string, r, a - base, z - base, p - base))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


_SENT = ["r", "grams", "strings", "texts", "starts", "windows", "keys", "ids"]


def _send(parts: int):
    def flush(held):
        gram, string, text, start, windows = (np.concatenate([h[k] for h in held]) for k in range(5))
        keys, ids = (np.concatenate([h[k] for h in held]) for k in (5, 6))
        part = (mix(gram) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cols: list[list] = [[] for _ in _SENT]
        for r, at in enumerate(np.split(order, np.cumsum(np.bincount(part, minlength=parts))[:-1])):
            if len(at):
                who, place = np.unique(text[at], return_inverse=True)
                values = (r, gram[at], string[at], place.astype(np.uint32), start[at].astype(np.uint32), windows[at].astype(np.uint8), keys[who], ids[who])
                for c, v in zip(cols, values, strict=True):
                    c.append(v if isinstance(v, int) else v.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], _SENT)

    def run(batches):
        held, size, first = [], 0, 0
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in blocks(batch.column(2)):
                gram, string, row, a, z, _ = samples(b)
                held.append((gram, string, row + first, a, z - a + 1, keys[b.lo : b.hi], ids[b.lo : b.hi]))
                first += b.hi - b.lo
                size += len(gram)
                if size >= GATHER:
                    yield flush(held)
                    held, size, first = [], 0, 0
        if size:
            yield flush(held)

    return run, "r int, " + ", ".join(f"{c} binary" for c in _SENT[1:])


def _wanted_bit(string: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    return (mix(string ^ mix(key.view(np.uint64) + start.astype(np.uint64))) % np.uint64(MAP_BITS)).astype(np.int64)


def _meet(batches):
    """Whole strings found before (key, first and last window); bits of the strings to be sorted."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    get = lambda name, kind: [np.frombuffer(row[name], kind) for row in rows]
    place, keys, ids = get("texts", np.uint32), get("keys", np.int64), get("ids", np.int64)
    key = np.concatenate([k[p] for k, p in zip(keys, place, strict=True)])
    doc = np.concatenate([i[p] for i, p in zip(ids, place, strict=True)])
    gram, string, start, windows = (np.concatenate(get(n, t)) for n, t in (("grams", np.uint64), ("strings", np.uint64), ("starts", np.uint32), ("windows", np.uint8)))
    del rows, place, keys, ids
    order = np.lexsort((key, start, doc, string, gram))
    gram, string, key, doc, start, windows = (x[order] for x in (gram, string, key, doc, start, windows))
    first = np.r_[True, (gram[1:] != gram[:-1]) | (string[1:] != string[:-1])]
    leader = np.flatnonzero(first)[np.cumsum(first) - 1]
    own = (doc == doc[leader]) & (start == start[leader]) & (key == key[leader])  # the first, and rows that repeat it
    again = np.flatnonzero(~own)
    for lo in range(0, len(again), CHUNK):
        k = again[lo : lo + CHUNK]
        yield pa.RecordBatch.from_arrays([pa.array(key[k]), pa.array(start[k].astype(np.int64)), pa.array(start[k].astype(np.int64) + windows[k] - 1), pa.nulls(len(k), pa.int64())], ["key", "first", "last", "bit"])
    # Grams with more than one string.
    strings = np.flatnonzero(first)
    group = gram[strings]
    same = np.zeros(len(strings), bool)
    same[1:] = group[1:] == group[:-1]
    same[:-1] |= group[1:] == group[:-1]
    k = strings[same]
    bits = np.unique(_wanted_bit(string[k], key[k], start[k]))
    for lo in range(0, len(bits), CHUNK):
        part = bits[lo : lo + CHUNK]
        none = pa.nulls(len(part), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(part)], ["key", "first", "last", "bit"])


def _strings(shared):
    """The strings to be sorted, with what stands right and left of their sample."""
    names = ["gram", "right", "left", "key", "doc", "first"]

    def run(batches):
        wanted = shared.value
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in blocks(batch.column(2)):
                gram, string, row, a, z, p = samples(b)
                bit = _wanted_bit(string, keys[b.lo + row], a)
                use = np.flatnonzero((wanted[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1))
                if not len(use):
                    continue
                raw = b.data.tobytes()
                base = b.offs[row[use]]
                right = [raw[s:e] for s, e in zip((base + p[use]).tolist(), (base + z[use] + LENGTH).tolist(), strict=True)]
                left = [raw[s:e] for s, e in zip((base + a[use]).tolist(), (base + p[use]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(gram[use].view(np.int64)), pa.array(right, pa.binary()), pa.array(left, pa.binary()), pa.array(keys[b.lo + row[use]]), pa.array(ids[b.lo + row[use]]), pa.array(a[use])], names)

    return run, "gram long, right binary, left binary, key long, doc long, first long"


def _matrix(column: pa.Array, width: int, from_end: bool) -> tuple[np.ndarray, np.ndarray]:
    """Binary rows as a matrix with padding, and their lengths."""
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.diff(offs)
    out = np.zeros((len(column), width), np.uint8)
    body = np.frombuffer(data, np.uint8) if data is not None and offs[-1] else np.zeros(0, np.uint8)
    row = np.repeat(np.arange(len(column)), size)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[row, (np.repeat(size, size) - 1 - at) if from_end else at] = body[offs[0] : offs[-1]]
    return out, size


def _range_minimum(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``x[lo : hi + 1]`` for each pair, from a table of doubling steps."""
    out = np.empty(len(lo), x.dtype)
    level = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
    row = x
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            step = 1 << (k - 1)
            row = np.minimum(row[: len(row) - step], row[step:])
        at = level == k
        out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k) + 1])
    return out


def induce(group: np.ndarray, right: np.ndarray, n_right: np.ndarray, left: np.ndarray, n_left: np.ndarray, age: np.ndarray):
    """(row, distance left of the sample) of all duplicate windows.

    Rows are in order of group and right side. ``left`` is read away from the
    sample; ``age`` is less for an earlier string, and equal only for the same one.
    """
    rows, far = [], []
    order = np.arange(len(group))
    common = np.full(len(group), -1, np.int64)
    if len(group) > 1:
        unlike = right[1:] != right[:-1]
        first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), right.shape[1])
        common[1:] = np.where(group[1:] == group[:-1], np.minimum(first, np.minimum(n_right[1:], n_right[:-1])), -1)
    for d in range(left.shape[1] + 1):
        if len(order) < 2:
            break
        joined = common >= LENGTH
        if joined.any():
            begins = np.flatnonzero(~joined)
            least = np.minimum.reduceat(age[order], begins)
            later = age[order] > np.repeat(least, np.diff(np.r_[begins, len(order)]))
            rows.append(order[later])
            far.append(np.full(int(later.sum()), d))
        best = np.maximum(common, np.r_[common[1:], -1])
        alive = np.flatnonzero((n_left[order] > d) & (best >= 0) & (best + n_left[order] - d >= LENGTH))
        if d == left.shape[1] or len(alive) < 2:
            break
        byte = group[order[alive]] * 256 + left[order[alive], d]
        by = np.argsort(byte, kind="stable")
        place, byte = alive[by], byte[by]
        same = byte[1:] == byte[:-1]
        after = np.full(len(place), -1, np.int64)
        least = _range_minimum(common, place[:-1][same] + 1, place[1:][same])
        after[1:][same] = np.where(least >= 0, least + 1, -1)
        order, common = order[place], after
    none = np.zeros(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(far or [none])


def _sort_shards(batches):
    """Induce over whole shards, some at a time; rows come sorted by gram and right side."""

    def work(t: pa.RecordBatch):
        gram = t.column(0).to_numpy()
        group = np.cumsum(np.r_[True, gram[1:] != gram[:-1]]).astype(np.int64)
        right, n_right = _matrix(t.column(1), LENGTH, False)
        left, n_left = _matrix(t.column(2), LENGTH - GRAM, True)
        key, doc, first = (t.column(k).to_numpy() for k in (3, 4, 5))
        start = first + n_left  # place of the sample
        rank = np.lexsort((key, start, doc))
        new = np.r_[True, (np.diff(doc[rank]) != 0) | (np.diff(start[rank]) != 0) | (np.diff(key[rank]) != 0)]
        age = np.empty(len(rank), np.int64)
        age[rank] = np.cumsum(new)
        row, d = induce(group, right, n_right, left, n_left, age)
        window = start[row] - d
        order = np.lexsort((window, row))
        row, window = row[order], window[order]
        begins = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(window) != 1)]) if len(row) else np.zeros(0, np.int64)
        ends = np.r_[begins[1:], len(row)] - 1
        return pa.RecordBatch.from_arrays([pa.array(key[row[begins]]), pa.array(window[begins]), pa.array(window[ends] if len(row) else window)], ["key", "first", "last"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        gram = whole.column(0).to_numpy()
        cut = int(np.searchsorted(gram, gram[-1], side="left"))  # sorted; the last shard may go on
        if cut:
            yield work(whole.slice(0, cut))
        held = [whole.slice(cut)]
        size = whole.num_rows - cut
        if size >= CHUNK:
            size = 0  # one large shard: look again after as many rows
    if held:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()
        if whole:
            yield work(whole[0])


def duplicate_windows(docs: DataFrame) -> DataFrame:
    """key, first, last: runs of window starts that are duplicates; ``docs`` has key, doc and text."""
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    run, schema = _send(parts)
    met = stored(docs.mapInArrow(run, schema).repartition(parts, "r").mapInArrow(_meet, "key long, first long, last long, bit long"), "suffix-met")
    # A bitmap of fixed size tells which strings go on; one that passes it wrongly is sorted without need.
    wanted = bitmap(met.where("bit is not null").select("bit"), MAP_BITS)
    run, schema = _strings(spark.sparkContext.broadcast(wanted))
    sorted_ = docs.mapInArrow(run, schema).repartition(parts, "gram").sortWithinPartitions("gram", "right")
    found = sorted_.mapInArrow(_sort_shards, "key long, first long, last long")
    return met.where("bit is null").select("key", "first", "last").unionByName(found)


def _cut(keep_bytes: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode()
                removed = n = done = 0
                left = []
                for span in sorted(spans or ()):
                    lo, hi = span >> 32, (span & 0xFFFFFFFF) + LENGTH
                    if lo > done or not n:
                        left.append(raw[done:lo])
                        n += 1
                        removed += hi - lo
                        done = hi
                    elif hi > done:
                        removed += hi - done
                        done = hi
                left.append(raw[done:])
                kept = b"".join(left)
                values = (doc, len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept)
                for c, v in zip(cols, values, strict=False):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names)

    return run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes


def dedup(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """Sizes, spans and digest of what is left of every document; its bytes too if asked for."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    own = own.select(F.xxhash64("doc", "text").alias("key"), F.coalesce("doc", F.lit(-(1 << 62))).alias("doc"), "text")
    spans = duplicate_windows(own).select("key", (F.shiftleft("first", 32) + F.col("last")).alias("span"))
    spans = spans.groupBy("key").agg(F.collect_set("span").alias("spans"))
    again = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    run, schema = _cut(keep_bytes)
    return again.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
