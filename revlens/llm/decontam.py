"""Benchmark decontamination with spaced seeds (operator 1). DataFrame functions only.

Texts are lower-cased and split at everything but letters and digits. A seed is
the hash of some tokens of a short window, chosen by a fixed mask; the window's
other positions are ignored, so a changed token there loses nothing. Windows of
twelve, nine and eight tokens have masks (``SHAPES``). Benchmark seeds are joined
with the seeds of all documents, and each hit is verified around itself: along
its diagonal (the same shift between document and item) some stretch of 12, 16
or 20 tokens that holds the hit's window and lies in both texts must agree in
10, 13 or 16 tokens.

Of all placements of changed tokens in a passage, verification included, are
found: 12 tokens with 1 change 100 of 100, with 2 90.9; 16 with 3 100; 20 with 4
99.8; 15 with 3 79.8; 16 with 4 54 (enumerated; a stretch must agree to five
sixths, 13 of 16 or four fifths, so the last two are mostly beyond it).

An item of 6 to 11 tokens has masks of its own that leave out its first, middle
or last third, and is verified as a whole with one token that may differ; one of
up to 5 tokens is sought as it is. The documents' tokens are gone over four times
at most, once for each span of the usual masks and once for all short lengths.

All masks of a span look at the first and the last of their tokens, and those of
some spans at more of the same. A window is tested for these first, and its seeds after that, against a bitmap of the
benchmark's keys of that kind and its seeds. Its size is a parameter and does not grow with the
data; the join after it is exact, so a full bitmap costs time only. The hits are
written once; a seed that very many documents hold is dealt to a grid of tasks
(``blockjoin.grid_join``).

Result: one row for each document and benchmark item with a verified overlap:
n_windows (item positions where a verified stretch starts), n_tokens (item tokens
covered by them) and item_tokens.

Defined results: null and empty texts or items overlap with nothing; repeated
rows of a doc_id or an item_id fall into one row, and so do all rows of null
doc_id (callers that must tell them apart give ``keys`` that do); empty tables
give an empty result; further columns are never read. Very long texts are read
whole: a text's tokens are one array of longs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.blockjoin import grid_join

from .tables import stored, table

SPAN = 12
#: Token positions that each mask of a span looks at (fixed masks), for items of SPAN tokens and more.
SHAPES = {
    12: ((0, 2, 6, 8, 9, 10, 11), (0, 1, 2, 4, 6, 7, 11), (0, 2, 3, 5, 7, 10, 11), (0, 1, 5, 6, 7, 9, 11), (0, 1, 2, 3, 8, 9, 10, 11)),
    9: ((0, 1, 3, 4, 5, 7, 8),),
    8: ((0, 1, 2, 3, 4, 5, 6, 7),),
}
#: Lengths of the stretches around a hit, and how many of their tokens must agree.
STRETCHES = {12: 10, 16: 13, 20: 16}
#: Items of at least so many tokens may differ in one.
TOLERANT = 6
REACH = max(STRETCHES) - min(SHAPES)
BITMAP_BITS = 1 << 24


def short_shapes(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """(span, mask) of an item of n tokens, fewer than SPAN: each leaves out one third, or nothing below TOLERANT tokens."""
    if n < TOLERANT:
        return [(n, tuple(range(n)))]
    third = n // 3
    ends = tuple(range(third)) + tuple(range(n - third, n))
    return [(n, ends), (n - third, tuple(range(n - third)))]


def shapes_of(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """(span, mask) of all seeds of an item of n tokens."""
    return [(span, m) for span, masks in SHAPES.items() for m in masks] if n >= SPAN else short_shapes(n)


def _all_shapes(lengths: Sequence[int]) -> dict[int, list[tuple[int, ...]]]:
    """Masks by span for the item lengths there are; lengths from SPAN on have the same."""
    out: dict[int, list] = {}
    for n in lengths:
        for span, mask in shapes_of(n):
            if mask not in out.setdefault(span, []):
                out[span].append(mask)
    return out


#: Masks of every span, whatever lengths there are.
EVERY = _all_shapes(range(1, SPAN + 1))


def stretches_of(n: int) -> dict[int, int]:
    """Lengths and agreeing tokens that verify a hit on an item of n tokens."""
    return STRETCHES if n >= SPAN else {n: n - (n >= TOLERANT)}


def tokens(text: Column) -> Column:
    """64-bit hashes of a text's tokens."""
    words = F.filter(F.split(F.lower(text.cast("string")), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.coalesce(F.transform(words, lambda x: F.xxhash64(x)), F.array().cast("array<bigint>"))


def _pair(toks: Column, at: Column, span: int) -> Column:
    """Of what is common to all masks of a span, the first two and the last two tokens."""
    common = sorted(set.intersection(*(set(m) for m in EVERY[span])))
    looked = sorted(set(common[:2] + common[-2:]))
    return F.xxhash64(F.lit(span), *(F.get(toks, at + p) for p in looked))


def _seed(window: Column, first: Column, span: int, mask: tuple[int, ...]) -> Column:
    """The hash of the tokens a mask looks at, in a window that begins at ``first`` of an array."""
    return F.xxhash64(F.lit(span), F.lit(" ".join(map(str, mask))), F.transform(F.array(*(F.lit(p) for p in mask)), lambda p: F.get(window, first + p)))


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(key, F.lit(bits))


def _bitmap(keys: DataFrame, bits: int) -> Column:
    """One array of longs in which the bit of every key is set, as a scalar subquery."""
    words = keys.select(_bit(F.col("key"), bits).alias("bit")).groupBy((F.col("bit") / 64).cast("int").alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("word"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("id")).join(words, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
    return every.agg(F.transform(listed, lambda x: x["word"]).alias("bitmap")).scalar()


def _set_in(bitmap: Column, key: Column, bits: int) -> Column:
    bit = _bit(key, bits)
    return F.getbit(F.get(bitmap, (bit / 64).cast("int")), (bit % 64).cast("int")) == 1


def item_seeds(items: DataFrame) -> DataFrame:
    """item_id, n (tokens), item_at, span, pair, seed, and the item's tokens around: ``around`` from item_at - ``lead`` on."""
    rows = items.select("item_id", tokens(F.col("text")).alias("toks")).withColumn("n", F.size("toks")).where("n > 0").distinct()
    # Written once: each of the steps below would plan the distinct items again.
    rows = stored(rows, "decontam-tokens")
    parts = []
    for low, high in [(n, n) for n in range(1, SPAN)] + [(SPAN, None)]:  # a fixed number of small steps over the benchmark
        own = rows.where(F.col("n") == low) if high else rows.where(F.col("n") >= low)
        for span, mask in shapes_of(low):
            at = own.withColumn("item_at", F.explode(F.sequence(F.lit(0), F.col("n") - span)))
            lead = F.least(F.col("item_at"), F.lit(REACH)).alias("lead")
            around = F.slice("toks", F.col("item_at") - lead + 1, REACH + max(STRETCHES)).alias("around")
            toks, begin = F.col("toks"), F.col("item_at")
            parts.append(at.select("item_id", "n", "item_at", F.lit(span).alias("span"), _pair(toks, begin, span).alias("pair"), _seed(toks, begin, span, mask).alias("seed"), lead, around))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def hits_of(docs: DataFrame, known: DataFrame, keys: Sequence[str], bitmap_bits: int) -> DataFrame:
    """(keys, seed, d_lead, d_around) of the document windows whose seed the benchmark may hold."""
    lengths = [r.n for r in known.select(F.least("n", F.lit(SPAN)).alias("n")).distinct().collect()]  # at most SPAN rows
    shapes = _all_shapes(sorted(lengths)) or {SPAN: list(SHAPES[SPAN])}
    bitmap = _bitmap(known.select(F.col("pair").alias("key")).union(known.select("seed")), bitmap_bits)
    rows = docs.select(*keys, tokens(F.col("text")).alias("toks"))
    out = None
    # A pass for each usual span and one for all others: tests of many spans in one step are too much code to be compiled.
    for group in [[span] for span in SHAPES] + [[span for span in shapes if span not in SHAPES]]:
        group = {span: shapes[span] for span in group if span in shapes}
        if group:
            part = _group_hits(rows, group, bitmap, keys, bitmap_bits)
            out = part if out is None else out.unionByName(part)
    return out.where(F.col("seed").isNotNull() & _set_in(bitmap, F.col("seed"), bitmap_bits))


def _group_hits(rows: DataFrame, group: dict[int, list], bitmap: Column, keys: list[str], bitmap_bits: int) -> DataFrame:
    """The seeds, with the tokens around, of all windows of these spans whose first test passes."""
    least = min(group)
    # Up to a window's tokens there are only functions with generated code, in little of it: else a
    # text's tokens would be copied for each of its windows. The explode of one value keeps the
    # seeds' functions, which have none, out of that step.
    at = rows.where(F.size("toks") >= least).select(*keys, "toks", F.explode(F.sequence(F.lit(0), F.size("toks") - least)).alias("at"))
    some = None
    for span in group:
        test = _set_in(bitmap, _pair(F.col("toks"), F.col("at"), span), bitmap_bits)
        some = test if some is None else some | test
    lead = F.least(F.col("at"), F.lit(REACH))
    around = F.slice("toks", F.col("at") - lead + 1, REACH + max(STRETCHES))
    own = at.where(some).select(*keys, lead.alias("d_lead"), F.explode(F.array(around)).alias("d_around"))
    room = F.size("d_around") - F.col("d_lead")
    seeds = [F.when(room >= span, _seed(F.col("d_around"), F.col("d_lead"), span, m)) for span, masks in group.items() for m in masks]
    return own.select(*keys, "d_lead", "d_around", F.explode(F.array(*seeds)).alias("seed"))


def _agreement() -> Column:
    """Bit REACH + k of a long is set where document and item agree k tokens from the hit's begin."""
    lead = F.least("l_d_lead", "r_lead")
    a = F.slice("l_d_around", F.col("l_d_lead") - lead + 1, REACH + max(STRETCHES))
    b = F.slice("r_around", F.col("r_lead") - lead + 1, REACH + max(STRETCHES))
    bits = F.transform(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same, k: F.when(same, F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long")))
    return F.call_function("shiftleft", F.aggregate(bits, F.lit(0).cast("long"), lambda x, y: x + y), F.lit(REACH) - lead)


def _verified() -> Column:
    """Stretches around a hit that agree enough: structs of their item position and length. Reads ``agreement``."""
    at, n = F.col("r_item_at"), F.col("r_n")
    low = -F.least("l_d_lead", "r_lead")
    high = F.least(F.size("l_d_around") - F.col("l_d_lead"), F.size("r_around") - F.col("r_lead"))
    held = []
    for length, need in STRETCHES.items():
        for k in range(min(SHAPES) - length, 1):
            agreeing = F.bit_count(F.col("agreement").bitwiseAND(F.lit(((1 << length) - 1) << (REACH + k)).cast("long")))
            inside = (low <= k) & (high >= k + length) & (F.col("r_span") <= k + length)
            held.append(F.when(inside & (agreeing >= need), F.struct((at + k).alias("start"), F.lit(length).alias("length"))))
    # An item below SPAN tokens lies within reach of the hit as a whole.
    agreeing = F.bit_count(F.col("agreement").bitwiseAND(F.expr(f"shiftleft(shiftleft(1L, r_n) - 1L, {REACH} - r_item_at)")))
    inside = (low <= -at) & (high >= n - at)
    whole = F.when(inside & (agreeing >= n - F.when(n >= TOLERANT, 1).otherwise(0)), F.struct(F.lit(0).alias("start"), n.alias("length")))
    return F.when(n >= SPAN, F.array_compact(F.array(*held))).otherwise(F.array_compact(F.array(whole)))


def overlaps(docs: DataFrame, items: DataFrame, bitmap_bits: int = BITMAP_BITS, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Verified overlaps of documents, told apart by ``keys``, with benchmark items."""
    keys = list(keys)
    docs = docs.select(*((F.col(k).cast("long") if k == "doc_id" else F.col(k)).alias(k) for k in keys), "text")
    known = stored(item_seeds(items), "decontam-items")
    hits = stored(hits_of(docs, known, keys, bitmap_bits).withColumn("by", F.xxhash64(*keys)), "decontam-hits")
    met = grid_join(hits, known.drop("pair"), "seed", "by", "item_id")
    least = F.when(F.col("r_n") >= SPAN, min(STRETCHES.values())).otherwise(F.col("r_n") - 1)
    # Exploded as the one value of an array, the agreement is computed once and not wherever it is read.
    met = met.withColumn("agreement", F.explode(F.array(_agreement()))).where(F.bit_count("agreement") >= least).withColumn("held", _verified())
    found = met.select(*(F.col(f"l_{k}").alias(k) for k in keys), F.col("r_item_id").alias("item_id"), F.col("r_n").cast("long").alias("item_tokens"), F.inline("held"))
    starts = found.distinct().groupBy(*keys, "item_id", "item_tokens").agg(F.collect_set(F.struct("start", "length")).alias("held"))
    n_windows = F.size(F.array_distinct(F.transform("held", lambda x: x["start"])))
    covered = F.array_distinct(F.flatten(F.transform("held", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    return starts.select(*keys, "item_id", n_windows.cast("long").alias("n_windows"), F.size(covered).cast("long").alias("n_tokens"), "item_tokens")


def query(spark, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    toks = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    lengths = list(range(1, SPAN + 1))
    shapes = EVERY
    key = lambda span, mask, at: f"'{span}:{','.join(map(str, mask))}:' || " + " || ' ' || ".join(f"t[{at} + {p + 1}]" for p in mask)
    doc = " UNION ALL ".join(
        f"SELECT doc_id, t, p, {key(span, m, 'p')} AS seed FROM (SELECT doc_id, t, unnest(range(0, len(t) - {span - 1})) AS p FROM d WHERE len(t) >= {span})"
        for span, masks in shapes.items() for m in masks
    )
    item = " UNION ALL ".join(
        f"SELECT item_id, t, n, q, {span} AS span, {key(span, m, 'q')} AS seed FROM (SELECT item_id, t, n, unnest(range(0, n - {span - 1})) AS q FROM i WHERE n {'>=' if n == SPAN else '='} {n})"
        for n in lengths for span, m in shapes_of(n)
    )
    need = " UNION ALL ".join(
        [f"SELECT n, {length} AS size, {need} AS need FROM (SELECT DISTINCT n FROM i WHERE n >= {SPAN})" for length, need in STRETCHES.items()]
        + [f"SELECT {n} AS n, {size} AS size, {need} AS need" for n in range(1, SPAN) for size, need in stretches_of(n).items()]
    )
    return f"""
WITH d AS (SELECT doc_id, {toks} AS t FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, {toks} AS t, len({toks}) AS n FROM benchmark WHERE text IS NOT NULL),
ds AS ({doc}),
seeds AS ({item}),
need AS ({need}),
hits AS (
  SELECT DISTINCT ds.doc_id, ds.t AS dt, ds.p, s.item_id, s.t AS it, s.n, s.q, s.span
  FROM ds JOIN seeds s ON ds.seed = s.seed),
stretch AS (
  SELECT hits.*, size, need, unnest(range(span - size, 1)) AS k FROM hits JOIN need USING (n)),
w AS (
  SELECT DISTINCT doc_id, item_id, n, q + k AS pos, size FROM stretch
  WHERE p + k >= 0 AND q + k >= 0 AND p + k + size <= len(dt) AND q + k + size <= n
    AND len(list_filter(range(1, size + 1), lambda x: dt[p + k + x] = it[q + k + x])) >= need),
cov AS (SELECT doc_id, item_id, n, pos, unnest(range(pos, pos + size)) AS covered FROM w)
SELECT doc_id, item_id, count(DISTINCT pos) AS n_windows, count(DISTINCT covered) AS n_tokens, CAST(n AS BIGINT) AS item_tokens
FROM cov GROUP BY doc_id, item_id, n"""


SQL = _sql()
