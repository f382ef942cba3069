"""Operator 4, document fingerprints by one-permutation MinHash.

Every hash of a 5-word shingle falls into one of `BINS` bins by its high bits, and each bin keeps its least value: one hash
per shingle, whatever the number of bins. A bin that stays empty copies another one, found by optimal densification: a
fixed sequence of bins that depends only on the empty bin and the number of tries, until one has a value. The low `BITS`
bits of each bin are packed. Two fingerprints agree in a bin with probability J + (1 - J) / 2^BITS, which `likeness` turns
back into J.

Edited texts need the next document in order of ids. Ids and hashes of the texts are sorted first; their range borders cut the
corpus into blocks, each of which is read by one task in order, with the first document of the next block at its end. Documents
without an id, or with the same, are many blocks unless their texts are equal too.

Defined results: a null text is empty; without words there are no shingles, the fingerprint is the one of the empty set,
which is like itself (1) and unlike all others (0); fewer than five words are one shingle; ties of ids go by a hash of the text, then by the text;
null ids come first; a single document is its own next one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WordHashes, mix64, shingles, split_words

WORDS = 5
BINS = 512
BITS = 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(4096)
def _tries(attempt: int) -> np.ndarray:
    """The bin that each bin looks into at an attempt."""
    at = np.arange(BINS, dtype=np.uint64) + np.uint64(attempt * BINS + 1)
    return (mix64(mix64(at)) >> np.uint64(40)).astype(np.int64) % BINS


def sketch(hashes: np.ndarray) -> np.ndarray | None:
    """Low bits of the least hash of each bin; None of the empty set."""
    if len(hashes) == 0:
        return None
    h = mix64(hashes)
    bins = np.full(BINS, _EMPTY)
    np.minimum.at(bins, (h >> np.uint64(55)).astype(np.int64), h & np.uint64((1 << 55) - 1))
    full = bins != _EMPTY
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        source = _tries(attempt)[empty]
        hit = full[source]
        bins[empty[hit]] = bins[source[hit]]
        empty = empty[~hit]
        attempt += 1
    return (bins & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(values: np.ndarray | None) -> str:
    """Two bins to a byte, in base 64; the empty set has the empty string."""
    if values is None:
        return ""
    return base64.b64encode(((values[0::2] << 4) | values[1::2]).tobytes()).decode()


def unpacked(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    b = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    return np.stack([b >> 4, b & 15], 1).ravel()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity of the shingle sets, without the bias of equal low bits."""
    if a is None or b is None:
        return float(a is None and b is None)
    by_chance = 1 / (1 << BITS)
    return float(np.clip(((a == b).mean() - by_chance) / (1 - by_chance), 0, 1))


class Sketcher:
    def __init__(self) -> None:
        self.words = WordHashes()

    def __call__(self, text: str) -> np.ndarray | None:
        return sketch(shingles(self.words.of(split_words(text.encode("utf-8", "surrogatepass"))), WORDS))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _borders(keys: DataFrame, blocks: int) -> list[tuple[int, int]]:
    """Where the rows, range partitioned into `blocks` by id and hash of the text, have their partitions' first ones: at most
    one key a block."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = min((min(zip(*(c.to_pylist() for c in batch.columns), strict=True)) for batch in batches if batch.num_rows), default=None)
        if least is not None:
            yield pa.RecordBatch.from_pydict({"id": pa.array(least[:1], pa.int64()), "own": pa.array(least[1:], pa.int64())})

    return sorted((r["id"], r["own"]) for r in keys.repartitionByRange(blocks, "id", "own").mapInArrow(first, "id long, own long").collect())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    `blocks`: into how many ranges of ids and texts the corpus is cut; eight for each shuffle partition unless given.
    """
    spark = docs.sparkSession
    least = -(2**63)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("id"),
        F.xxhash64(text).alias("own"),
        text.alias("text"),
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(_borders(rows.select("id", "own"), blocks or 8 * partitions))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row to its block, and the rows that may be a block's first also to the end of the block before."""
        starts = shared.value
        for batch in batches:
            keys = list(zip(batch.column("id").to_pylist(), batch.column("own").to_pylist(), strict=True))
            block = np.array([bisect_right(starts, key) - 1 for key in keys], np.int64)
            own = pa.array(block, pa.int64()), pa.array(np.zeros(len(keys), np.int32)), *batch.columns
            yield pa.RecordBatch.from_arrays(list(own), names=["block", "guest", *batch.schema.names])
            at = np.array([i for i, key in enumerate(keys) if starts[block[i]] == key], np.int64)
            if len(at):
                some = batch.take(pa.array(at))
                before = (block[at] - 1) % len(starts)  # the first of all follows the last of all
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before, pa.int64()), pa.array(np.ones(len(at), np.int32)), *some.columns],
                    names=["block", "guest", *batch.schema.names],
                )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Sketcher()
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        out: list[tuple] = []
        held = None  # the document that waits for its next one: (block, doc_id, text, sketch)

        def row(document, text: str, values: np.ndarray | None) -> None:
            _, doc_id, own, sketch_ = document
            changed = edited(own, text)
            s = make(changed)
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((doc_id, len(own), digest, packed(sketch_), packed(s), likeness(sketch_, s), likeness(sketch_, values)))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out.clear()
            return made

        for batch in batches:
            for block, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text")), strict=True):
                if guest and (held is None or held[0] != block):
                    continue  # of several guests, which share id and text hash, the first is the next document
                values = make(text)
                if held is not None and held[0] == block:
                    row(held, text, values)
                held = None if guest else (block, doc_id, text, values)
                if len(out) >= 2000:
                    yield batch_of()
        if out:
            yield batch_of()

    schema = "block long, guest int, doc_id long, id long, own long, text string"
    blocked = rows.mapInArrow(dealt, schema).repartition(partitions, "block").sortWithinPartitions("block", "guest", "id", "own", "text")
    return blocked.mapInArrow(
        work,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
