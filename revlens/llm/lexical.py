"""Ranked lexical search, reversed: documents stream past an inverted index of the items (operator 12).

The items' terms form an inverted index (term to items), which is broadcast; the
documents are never shuffled. Two passes read them:

1. counts: documents with a term, all terms with repeats, and for each term of
   the index the documents that hold it, added up by Spark;
2. scores: each document's counts of index terms run through the index, and
   every partition keeps a heap of at most ``top`` rows for each item. A document
   enters a heap only if it beats the heap's least row. The heaps of all
   partitions are merged in two steps, by (item, partition group) and by item.

The index is bounded: it holds at most ``block_postings`` (item, term) postings,
and more items are searched in several blocks, each against all documents. One
item's terms are never cut, so an item beyond the bound is a block of its own.
Counts of terms travel as (term, count) rows, so nothing that grows with the
documents reaches the driver.

Terms are known by 64-bit hashes of their bytes. All scores are 64-bit integers
from the weight on, so they do not depend on the order of addition.

Defined results: a null or termless text has no terms, is not counted in N and
is never found. Every row of the documents is a document: equal rows are found
once each, and rows of one score come by ascending doc_id, null ids last. Rows of
one item_id (null is an id too) are one item with all their terms; an item
without terms, or whose terms no document holds, has no rows. An empty table on
either side gives an empty result. Further columns are never read. Very long
texts are read whole, in slices of ``textblocks.BLOCK_BYTES`` cut between terms.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, table
from .textblocks import BLOCK_BYTES, LOWER, Block, blocks

TOP = 10
#: Postings of one broadcast index: 16 bytes each, and 16 for each term.
BLOCK_POSTINGS = 500_000
#: (document, item) cells scored at a time.
CELLS = 1 << 20
#: Groups of partitions whose heaps are merged first.
MERGE_GROUPS = 32

# A term is a run of ASCII letters, digits and bytes of other characters.
_SOLID = np.ones(256, bool)
_SOLID[:0x30] = _SOLID[0x3A:0x41] = _SOLID[0x5B:0x61] = _SOLID[0x7B:0x80] = False

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _slices(b: Block) -> Iterator[tuple[int, Block]]:
    """A block of one long text as pieces cut between terms; other blocks as they are. Yields (row, piece)."""
    if b.hi - b.lo > 1 or len(b.data) <= BLOCK_BYTES:
        yield 0, b
        return
    at, n = 0, len(b.data)
    while at < n:
        end = min(n, at + BLOCK_BYTES)
        while end < n and _SOLID[b.data[end]]:
            gap = np.flatnonzero(~_SOLID[b.data[end : end + BLOCK_BYTES]])
            end = end + int(gap[0]) if len(gap) else min(n, end + BLOCK_BYTES)
        piece = b.data[at:end]
        yield 0, Block(b.lo, b.hi, piece, np.array([0, len(piece)], np.int64))
        at = end


def terms_of(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row (counted from the block's first) of every term occurrence."""
    solid = _SOLID[b.data]
    if not solid.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(solid)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cut = b.offs[(b.offs > 0) & (b.offs < n)]
    first[cut] = solid[cut]
    last[cut - 1] = solid[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    low = Block(b.lo, b.hi, LOWER[b.data], b.offs)
    return low.hashes(start, end), np.searchsorted(b.offs, start, side="right") - 1


class Index:
    """Inverted index of one block of items: sorted term hashes, and the items of each term."""

    def __init__(self, item: np.ndarray, term: np.ndarray):
        """``item`` numbers and ``term`` hashes of distinct postings."""
        order = np.lexsort((item, term))
        self.terms, begins = np.unique(term[order], return_index=True)
        self.items = item[order].astype(np.int32)
        self.begins = np.append(begins, len(order)).astype(np.int64)
        self.n_items = int(item.max()) + 1 if len(item) else 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for hashes that are no term of the index."""
        if not len(self.terms):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def _counted(b: Block, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each row with repeats; and row, term number and count of the rows' index terms, by row."""
    n = np.zeros(b.hi - b.lo, np.int64)
    keys, counts = [], []
    width = max(1, len(index.terms))
    for _, piece in _slices(b):
        hashes, row = terms_of(piece)
        n += np.bincount(row, minlength=len(n))
        found = index.find(hashes)
        hit = found >= 0
        key, c = np.unique(row[hit] * width + found[hit], return_counts=True)
        keys.append(key)
        counts.append(c)
    if len(keys) > 1:
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
    else:
        key, count = (keys[0], counts[0].astype(np.int64)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return n, key // width, key % width, count


def _count_rows(batches, index: Index):
    """(term number, documents) of one partition; term -1 carries N and term -2 carries L."""
    df = np.zeros(len(index.terms), np.int64)
    documents = occurrences = 0
    for batch in batches:
        for b in blocks(batch.column(0)):
            n, _, term, _ = _counted(b, index)
            documents += int((n > 0).sum())
            occurrences += int(n.sum())
            df += np.bincount(term, minlength=len(df))
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, -2, held], pa.int64()), pa.array(np.r_[documents, occurrences, df[held]], pa.int64())], ["term", "n"]
    )


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class _Heaps:
    """At most ``top`` rows for each item, the least on top: higher scores first, then smaller ids, null ids last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.rows: list[list[tuple[int, int, int]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # a score below this cannot enter
        self.least_doc = np.full(n_items, np.iinfo(np.int64).max)  # nor can a later document of this score

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        may = (score > self.least[item]) | (doc <= self.least_doc[item]) | ~known
        for i, s, d, k in zip(item[may].tolist(), score[may].tolist(), doc[may].tolist(), known[may].tolist(), strict=True):
            heap, row = self.rows[i], (s, int(k), -d)
            if len(heap) < self.top:
                heapq.heappush(heap, row)
            elif row > heap[0]:
                heapq.heapreplace(heap, row)
            if len(heap) == self.top:
                s, k, d = heap[0]
                self.least[i] = s
                self.least_doc[i] = -d if k else np.iinfo(np.int64).max


def _score_rows(batches, index: Index, weights: np.ndarray, n_documents: int, length: int, top: int):
    heaps = _Heaps(index.n_items, top)
    step = max(1, CELLS // max(1, index.n_items))
    for batch in batches:
        ids = batch.column(0)
        known = np.asarray(ids.is_valid())
        ids = ids.fill_null(0).to_numpy()
        for b in blocks(batch.column(1)):
            n, row, term, tf = _counted(b, index)
            m = 10 + (90 * n * n_documents) // max(1, length)
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            for lo in range(0, b.hi - b.lo, step):
                a, z = np.searchsorted(row, [lo, lo + step])
                if a == z:
                    continue
                size = np.diff(index.begins)[term[a:z]]
                at = np.repeat(index.begins[term[a:z]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                scores = np.zeros((min(step, b.hi - b.lo - lo), index.n_items), np.int64)
                np.add.at(scores.ravel(), np.repeat(row[a:z] - lo, size) * index.n_items + index.items[at], np.repeat(value[a:z], size))
                r, i = np.nonzero(scores >= heaps.least)
                heaps.offer(i, scores[r, i], ids[b.lo + lo + r], known[b.lo + lo + r])
    out = [(i, s, -d if k else None) for i, heap in enumerate(heaps.rows) for s, k, d in heap]
    item, score, doc = zip(*out) if out else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, pa.int64())], ["item", "score", "doc_id"]
    )


def _postings(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term hash) rows of the items."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column(1)):
                for _, piece in _slices(b):
                    hashes, row = terms_of(piece)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(b.lo + row)), pa.array(hashes.view(np.int64), pa.int64())], ["item_id", "term"]
                    )

    return items.mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, term long").distinct()


def _item_blocks(postings: DataFrame, block_postings: int) -> DataFrame:
    """Each item and the block it is searched in: a block takes the items whose first posting lies in its share."""
    sizes = postings.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    # Items, not documents, are numbered here: one row of two numbers each, dealt by hash and summed up in two steps.
    spread = sizes.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(4096)))
    inside = F.sum("size").over(Window.partitionBy("part").orderBy(F.xxhash64("item_id"), "item_id"))
    totals = spread.groupBy("part").agg(F.sum("size").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    numbered = spread.withColumn("inside", inside).join(F.broadcast(before), "part")
    return numbered.select("item_id", F.floor((F.col("before") + F.col("inside") - F.col("size")) / block_postings).alias("block"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    postings = _postings(items)
    dealt = _item_blocks(postings, block_postings).withColumnRenamed("item_id", "_item")
    placed = stored(postings.join(dealt, F.col("item_id").eqNullSafe(F.col("_item"))).select("item_id", "term", "block"), "lexical-postings")
    found = None
    for (block,) in placed.select("block").distinct().orderBy("block").collect():
        own = placed.where(F.col("block") == block).select("item_id", "term").toArrow()
        names = own.column("item_id").combine_chunks().dictionary_encode("encode")
        index = Index(names.indices.to_numpy(), own.column("term").to_numpy().view(np.uint64))
        part = _search_block(spark, texts, index, names.dictionary, kind, top)
        found = part if found is None else found.unionByName(part)
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    return spark.createDataFrame([], schema) if found is None else found


def _search_block(spark, texts: DataFrame, index: Index, names: pa.Array, kind: str, top: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(index)
    counted = texts.select("text").mapInArrow(lambda batches: _count_rows(batches, shared.value), "term long, n long")
    counts = dict(counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pandas().itertuples(index=False))
    n_documents, length = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([weight(n_documents, int(counts.get(t, 0))) for t in range(len(index.terms))], np.int64)
    weighed = spark.sparkContext.broadcast(weights)
    heaps = texts.mapInArrow(
        lambda batches: _score_rows(batches, shared.value, weighed.value, n_documents, length, top), "item int, score long, doc_id long"
    )
    heaps = heaps.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "_group"], ["item"]):
        heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    numbers = pa.table({"item": pa.array(range(len(names)), pa.int32()), "item_id": names})
    return heaps.join(F.broadcast(spark.createDataFrame(numbers)), "item").select(F.col("item_id").cast(kind), "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = rf"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_SMALL}'), '{PATTERN}')) AS term FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
doc AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS len FROM doc),
norm AS (SELECT doc_id, 10 + (90 * n * n_docs) // len AS m FROM doc, total),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_SMALL}'), '{PATTERN}')) AS term FROM benchmark
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN w USING (term) JOIN norm USING (doc_id) GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
