"""Packing: concatenate and cut by two-pass prefix sums (operator 5).

First pass: every partition turns its texts into token ids, gives each document
its offset within the partition, and the rows are written to the shared folder.
Second pass: the partitions' token totals are summed up into global offsets
(one row for each partition, a Spark window), and the run of all tokens is cut
into windows of ``size``. Each document's share of a window is one boundary
record. Only the last sequence can be shorter than ``size``.

Ids are those of the ``tokenizers`` library. Texts of Latin script are encoded
by ``tiktoken`` from the same vocabulary file, which gives the same ids (tested,
and probed by every worker) at a fifth of the time; all others by ``tokenizers``.

Defined results: a null or empty text is its end id alone; repeated rows are
packed each; an empty table gives an empty result; further columns are never
read. A doc_id that stands in several rows has records for each of them, and so
has a null one. Very long texts are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, table

SIZE = 1024
END_ID = 0

#: The pattern by which byte-level vocabularies of this kind split texts (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Other characters may be of other classes in another library.
_PLAIN = "[\t\n\r\x20-\x7e\xa1-\u024f]*"
_SPECIAL = "<|endoftext|>"
_PROBE = "It's  a probe,\n\n \t of 1,234 naïve_words (über-long)!! "

_coders: dict[str, "Coder"] = {}


def _ranks(path: str) -> dict[bytes, int]:
    """Bytes of every token of a byte-level vocabulary file, by id."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes the file writes as themselves; the others follow from 256 on
    hidden = [b for b in range(256) if b not in shown]
    value = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return {bytes(value[c] for c in word): k for word, k in vocabulary.items() if word != _SPECIAL}


class Coder:
    """Token ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = re.compile(_PLAIN).fullmatch
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={}).encode_to_numpy
        if self.fast(_PROBE).astype("<u4").tobytes() != self._whole(_PROBE):
            self.plain = lambda text: False  # another vocabulary: one library for all

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [
            b"" if not t else self.fast(t).astype("<u4").tobytes() if self.plain(t) and _SPECIAL not in t else self._whole(t)
            for t in texts
        ]


def coder(path: str) -> Coder:
    if path not in _coders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[path] = Coder(path)
    return _coders[path]


def token_rows(docs: DataFrame, vocabulary: str, end_id: int = END_ID, at_once: int = 500) -> DataFrame:
    """part, place (offset within the part), doc_id, n and ids of every document, in the order of its partition."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, place = coder(vocabulary), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                rows = batch.slice(lo, at_once)
                ids = [x + end for x in encode(rows.column(1).to_pylist())]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                start = place + np.cumsum(n) - n
                place += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), pa.array(start), rows.column(0), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "place", "doc_id", "n", "ids"],
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "part long, place long, doc_id long, n long, ids binary")


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """Boundary records: which tokens of which document stand where in which sequence, with the tokens."""
    rows = stored(token_rows(docs, vocabulary), "packing")
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row for each input partition, 16 bytes each: 16 MB at a million partitions.
    at = rows.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("place"))
    last = F.floor((F.col("at") + F.col("n") - 1) / size)
    cut = at.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("at") / size), last)))
    start = F.greatest(F.col("sequence_id") * size, F.col("at")) - F.col("at")
    stop = F.least((F.col("sequence_id") + 1) * size, F.col("at") + F.col("n")) - F.col("at")
    return cut.select(
        "doc_id", start.alias("start"), (stop - start).alias("length"), F.col("n").alias("doc_tokens"), "sequence_id",
        (F.col("at") + start - F.col("sequence_id") * size).alias("offset"),
        F.col("ids").substr((start * 4 + 1).cast("int"), ((stop - start) * 4).cast("int")).alias("ids"),
    )


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """``pack`` with the ids as a checksum."""
    packed = pack(docs, vocabulary, size)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pieces(table(spark, sf_dir, "documents"), vocabulary)
