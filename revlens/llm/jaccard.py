"""Set-similarity join on word shingles, rare ones first (operator 9).

A document's set holds the 64-bit hashes of its distinct shingles. Documents of
equal sets are one class, named by the hash of its set; everything below works
on classes. Two classes link when ``100 * intersection >= percent * union``.

1. One pass over the texts writes each document's class and a parity sketch of its
   set (bits that every shingle flips one of), and counts shingles in a table of ``1 << SKETCH_BITS`` buckets: a size
   that does not grow with the data, so it may be broadcast. It decides only in
   which order shingles are taken; any order gives the same links.
2. Linked classes share one of their n - ceil(t n) + 1 rarest shingles. A second
   pass emits these prefixes; rows of one shingle meet in a bucket. Buckets of
   frequent shingles are salted by class before they meet.
3. Each bucket's classes are paired with its leader, the class of most common
   content: pairs grow with the bucket, not with its square. Pairs must pass the
   length and positional filters, and the suffix filter: parity sketches differ
   in no more bits than the sets differ in shingles, which for linked sets is
   bounded. Each pair is verified once.
4. Verified links give components. What remains are buckets with more than one
   component; there, all pairs across components pass the same filters and are
   verified. Pairs within a component cannot change it. So no link between
   components is lost, and no group of copies is expanded into its pairs.

Sets are verified on 48 bits of their shingles' hashes.

Defined results: a text of fewer words than a shingle is one shingle; null,
empty and blank texts have an empty set and link with nothing; repeated rows and
equal texts share a component; an empty table gives an empty result; further
columns are never read. Rows link by their texts alone: one doc_id with unlike
texts may be in several components, and a row of null doc_id has the smallest id
of its component, or null where there is none. Very long texts are read whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .components import components
from .tables import bitmap, stored, table
from .textblocks import Block, blocks, mix

SKETCH_BITS = 24
_PART = 1 << 16
SKETCH_WORDS = 8
SALTS = 16
#: A bucket is salted by so many rows that its shingle's sketch may stand for.
SALT_ROWS = 4096
MAP_BITS = 1 << 24


def shingle_sets(b: Block, width: int):
    """(row, sorted distinct shingle hashes) of every text that has a word."""
    low = b.lower()
    start, end, row = low.words()
    if not len(start):
        return
    h = low.hashes(start, end)
    parts = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        parts = mix(parts * np.uint64(31) + h[k : k + len(parts)])
    cuts = np.searchsorted(row, np.arange(b.hi - b.lo + 1))
    for r in range(b.hi - b.lo):
        lo, hi = cuts[r], cuts[r + 1]
        if hi - lo >= width:
            yield r, np.unique(parts[lo : hi - width + 1])
        elif hi > lo:
            one = np.array([hi - lo], np.uint64)
            for x in h[lo:hi]:
                one = mix(one * np.uint64(31) + x)
            yield r, one


def class_of(s: np.ndarray) -> int:
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _parity(s: np.ndarray) -> list[int]:
    bits = np.bincount((s >> np.uint64(40)).astype(np.int64) % (64 * SKETCH_WORDS), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def _pack(own: np.ndarray) -> tuple[bytes, bytes]:
    """Which of a part's buckets are not empty, as bits, and their counts less one, low bytes first."""
    rest = own[own > 0] - np.uint32(1)
    return zlib.compress(np.packbits(own > 0).tobytes(), 1), zlib.compress(rest.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _add(own: np.ndarray, places: bytes, counts: bytes) -> None:
    """Add a packed part to ``own``."""
    rest = np.frombuffer(zlib.decompress(counts), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    own[np.unpackbits(np.frombuffer(zlib.decompress(places), np.uint8)).astype(bool)] += rest + np.uint64(1)


def _first_pass(width: int):
    """Rows of documents (doc_id, n, sid, parity) and of sketch parts (part, places, counts)."""
    names = ["doc_id", "n", "sid", "parity", "part", "places", "counts"]

    def row(ids, n, sid, parity):
        k = len(ids)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(parity, pa.list_(pa.int64())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], names)

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n, sid, parity = [0] * len(ids), [None] * len(ids), [None] * len(ids)
            for b in blocks(batch.column(1)):
                for r, s in shingle_sets(b, width):
                    k = b.lo + r
                    n[k], sid[k], parity[k] = len(s), class_of(s), _parity(s)
                    sketch[(s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)] += 1
            yield row(ids, n, sid, parity)
        for part in range(len(sketch) // _PART):
            own = sketch[part * _PART : (part + 1) * _PART]
            if own.any():
                places, counts = _pack(own)
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.array([part], pa.int32()), pa.array([places], pa.binary()), pa.array([counts], pa.binary())], names)

    return run, "doc_id long, n long, sid long, parity array<long>, part int, places binary, counts binary"


def _add_up(batches):
    """Sum the sketch parts of a partition; levels are eight steps a doubling, rounded up."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _add(total.setdefault(part, np.zeros(_PART, np.uint64)), places, counts)
    for part, own in total.items():
        level = np.minimum(np.ceil(8 * np.log2(1 + own.astype(float))), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "levels"])


def _levels(first: DataFrame) -> np.ndarray:
    """Frequency level of every bucket: ``1 << SKETCH_BITS`` bytes, whatever the input."""
    parts = first.where("part is not null").select("part", "places", "counts").repartition("part").mapInArrow(_add_up, "part int, levels binary")
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for part, own in parts.collect():
        out[part * _PART : (part + 1) * _PART] = np.frombuffer(own, np.uint8)
    return out


def _prefixes(shared, width: int, percent: int):
    """Rows of prefix shingles; ``size`` holds n and pos, ``rank`` the class's score and the shingle's level."""
    names = ["token", "sid", "size", "rank"]

    def run(batches):
        levels, seen = shared.value, set()
        for batch in batches:
            for b in blocks(batch.column(0)):
                out = []
                for _, s in shingle_sets(b, width):
                    sid = class_of(s)
                    if sid in seen:
                        continue
                    seen.add(sid)
                    level = levels[(s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                    length = len(s) - -(-percent * len(s) // 100) + 1
                    order = np.lexsort((s, level))[:length]
                    out.append((s[order].view(np.int64), np.full(length, sid, np.int64), np.arange(length) + (len(s) << 32), (int(level.mean() * 256) << 8) + level[order].astype(np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)

    return run, "token long, sid long, size long, rank int"


def _meetings(prefixes: DataFrame) -> DataFrame:
    """Prefix rows that meet another class in their bucket, with the bucket's leader.

    Of the salts a shingle's buckets have, a class takes one; it is mixed into
    the shingle's hash, so that rows are shuffled by a single key. Rows of a
    class that several tasks have emitted fall into one here.
    """
    level, first = F.col("rank").bitwiseAND(F.lit(255)), F.col("sid").bitwiseAND(F.lit(0x7FFFFFFF))
    salts = F.greatest(F.lit(1), F.ceil(F.pow(F.lit(2.0), level / 8) / SALT_ROWS))
    salt = (first % salts).cast("int")
    salted = lambda column: F.when(salt > 0, F.col(column).bitwiseXOR(F.xxhash64(salt))).otherwise(F.col(column))
    bucket = Window.partitionBy("key")
    met = prefixes.select(salted("token").alias("key"), "sid", "size", "rank")
    met = met.withColumn("before", F.lag("sid").over(bucket.orderBy("sid")))
    met = met.withColumn("lead", F.max(F.struct("rank", "sid", "size")).over(bucket)).withColumn("alone", F.min("sid").over(bucket) == F.max("sid").over(bucket))
    n, pos = lambda c: F.shiftright(c, 32).cast("int"), lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    lead = F.struct(F.shiftright("lead.rank", 8).alias("score"), F.col("lead.sid").alias("sid"), n("lead.size").alias("n"), pos("lead.size").alias("pos"))
    return met.where((~F.col("alone") | (salts > 1)) & ~F.col("sid").eqNullSafe(F.col("before"))).select(
        salted("key").alias("token"), salt.alias("salt"), salts.cast("int").alias("salts"), "sid", n("size").alias("n"), pos("size").alias("pos"), lead.alias("lead")
    )


def _may_link(n1, p1, n2, p2, percent: int) -> Column:
    """Length and positional filters on a shared prefix shingle."""
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * most.cast("long") >= percent * (n1 + n2).cast("long"))


def _near_enough(n1: str, p1: str, n2: str, p2: str, percent: int) -> Column:
    """Suffix filter: the sketches differ in no more bits than linked sets differ in shingles."""
    unlike = sum((F.bit_count(F.get(p1, k).bitwiseXOR(F.get(p2, k))) for k in range(SKETCH_WORDS)), F.lit(0))
    total = F.col(n1) + F.col(n2)
    return unlike <= total - 2 * F.ceil(F.lit(percent) * total / (100 + percent))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _unpacked(members: bytes) -> np.ndarray:
    """Shingle hashes from their upper six bytes."""
    out = np.zeros((len(members) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(members, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


class _Sets:
    """Fetches and verifies pairs of classes."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int):
        self.docs, self.classes, self.width, self.percent = docs, classes, width, percent

    def _suffix_filter(self, pairs: DataFrame) -> DataFrame:
        """Keep pairs whose sketches differ by no more than linked sets may."""
        own = self.classes.select("sid", "n", "parity")
        wide = pairs.join(own.toDF("a", "na", "pa"), "a").join(own.toDF("b", "nb", "pb"), "b")
        return wide.where(_near_enough("na", "pa", "nb", "pb", self.percent)).select("a", "b")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that link."""
        width, percent = self.width, self.percent
        left = stored(self._suffix_filter(pairs), f"{name}-pairs")
        spark = left.sparkSession
        # A bitmap of the documents that stand for a class concerned, of fixed size; what passes it
        # wrongly finds no pair below, or the same pair again.
        bit = F.pmod(F.col("sid").bitwiseXOR(F.xxhash64("least_id")), F.lit(MAP_BITS))
        concerned = left.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(self.classes.select("sid", "least_id"), "sid")
        shared = spark.sparkContext.broadcast(bitmap(concerned.select(bit.alias("bit")), MAP_BITS))

        def fetch(batches):
            wanted, seen = shared.value, set()
            for batch in batches:
                marks = batch.column(1).to_numpy()
                for b in blocks(batch.column(0)):
                    sids, sets = [], []
                    for r, s in shingle_sets(b, width):
                        sid = class_of(s)
                        k = (sid ^ int(marks[b.lo + r])) % MAP_BITS
                        if sid not in seen and int(wanted[k // 64]) >> (k % 64) & 1:
                            seen.add(sid)
                            sids.append(sid)
                            sets.append(s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
                    if sids:
                        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["sid", "members"])

        def verify(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    s, t = _unpacked(x), _unpacked(y)
                    both = len(np.intersect1d(s, t))
                    keep.append(100 * both >= percent * (len(s) + len(t) - both))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        sets = stored(self.docs.select("text", F.xxhash64("doc_id").alias("mark")).mapInArrow(fetch, "sid long, members binary"), f"{name}-sets")
        wide = left.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        return stored(wide.mapInArrow(verify, "a long, b long"), f"{name}-links")


def similarity_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, schema = _first_pass(width)
    first = stored(own.mapInArrow(run, schema), "jaccard-first")
    shared = own.sparkSession.sparkContext.broadcast(_levels(first))
    rows = first.where("part is null").select("doc_id", "n", "sid", "parity")
    classes = stored(rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.count("*").alias("size")), "jaccard-classes")
    sets = _Sets(own, classes, width, percent)

    run, schema = _prefixes(shared, width, percent)
    met = stored(_meetings(own.select("text").mapInArrow(run, schema)), "jaccard-met")
    with_lead = met.where((F.col("sid") != F.col("lead.sid")) & _may_link(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), percent))
    # The leaders of a salted shingle's buckets, with the first among them.
    leads = met.where("salts > 1").select("token", "lead").distinct().withColumn("top", F.max("lead").over(Window.partitionBy("token")))
    leads = leads.where((F.col("lead.sid") != F.col("top.sid")) & _may_link(F.col("lead.n"), F.col("lead.pos"), F.col("top.n"), F.col("top.pos"), percent))
    pairs = stored(with_lead.select(*_pair("sid", "lead.sid")).union(leads.select(*_pair("lead.sid", "top.sid"))).distinct(), "jaccard-star")
    links = sets.links(pairs, "jaccard-star")
    labels = components(links, "jaccard-star")

    labelled = met.select("token", "salt", "salts", "sid", "n", "pos").join(labels.withColumnRenamed("id", "sid"), "sid", "left")
    labelled = stored(labelled.withColumn("label", F.coalesce("label", "sid")), "jaccard-labelled")
    sizes = labelled.groupBy("token", "label").agg(F.count("*").alias("size"), F.max("salts").alias("salts"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("size", "label"))["label"].alias("main"), F.count("*").alias("k"), F.max("salts").alias("salts")).where("k > 1")
    mixed = mixed.select("token", "main", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rest = stored(labelled.join(mixed, ["token", "salt"]).select("token", "sid", "n", "pos", "label", "main").join(classes.select("sid", "parity"), "sid"), "jaccard-rest")
    x, y = rest.where("label <> main").alias("x"), rest.alias("y")
    across = x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label"))
        & ((F.col("y.label") == F.col("y.main")) | (F.col("x.sid") < F.col("y.sid")))
        & _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)
        & _near_enough("x.n", "x.parity", "y.n", "y.parity", percent),
    )
    more = across.select(*_pair("x.sid", "y.sid")).distinct().join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(sets.links(more, "jaccard-rest"))
    labels = components(links, "jaccard-all").withColumnRenamed("id", "sid")

    least = labels.join(classes, "sid").groupBy("label").agg(F.min("least_id").alias("component_id"))
    linked = labels.join(least, "label").select("sid", "component_id")
    # Classes of several rows or with links, repeated over the salts of their rows.
    groups = classes.join(linked, "sid", "left").where("size > 1 or component_id is not null")
    groups = groups.select("sid", F.coalesce("component_id", "least_id").alias("component_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "sid", salt.alias("salt")).join(groups, ["sid", "salt"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents"))
