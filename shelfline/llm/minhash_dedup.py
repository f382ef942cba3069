"""Operator 3, near-duplicate detection by min-max hashing.

Each hash function of a document's shingles gives two signature values, the least and the greatest, each of which agrees
between two documents with a probability of their Jaccard similarity J: 100 functions make 200 values, in 40 bands of
five. A pair with J = 0.8 shares no band with a probability of about 10^-7. Bands mix no least with a greatest value.

Documents are linked where 100 * |A and B| >= 80 * |A or B|, which is confirmed on the full sets. Groups may be huge, so no
pairs are listed within a band's bucket:

1. Documents with equal sets are one class, represented by the smallest id (map-side combined).
2. Each bucket elects its smallest id as hub. The members of all buckets with the same hub are one group, so that a pair
   that shares a band is in the group of that bucket's hub, and a group of near copies is not sent once for each band.
3. Groups are cut into chunks of about `tile` rows, each with the hub. A task holds one chunk, with full sets, and compares
   rows of different components only; it hands over as few links as connect what it found connected.
4. In groups of several chunks, the rows outside the hub's component are compared with every chunk, in blocks.

So every pair that shares a band is compared, or already within one component; none is dropped.

Defined results: null, empty and wordless texts have an empty set and link with nothing; fewer words than a shingle are one
shingle; repeated rows of an id are one node, whose set is that of any of them; a null id is never linked and kept, with a
null component; an empty table gives no rows; other columns are ignored by `near_duplicates` and carried by
`one_of_each_group`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WordHashes, mix64, shingles, split_words, stored, utf8
from shelfline.llm.components import connected_components

FUNCTIONS = 100
ROWS = 5
BANDS = 2 * FUNCTIONS // ROWS
_ODD = (mix64(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (mix64(np.arange(1001, FUNCTIONS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_BAND = mix64(np.arange(5001, BANDS + 5001, dtype=np.uint64))


def min_max_signature(hashes: np.ndarray) -> np.ndarray:
    """Least values under all functions, then greatest values."""
    folded = (mix64(hashes) >> np.uint64(32)).astype(np.uint32)
    low = np.full(FUNCTIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(FUNCTIONS, np.uint32)
    for at in range(0, len(folded), 2048):  # in parts that stay in the processor's cache
        v = folded[None, at : at + 2048] * _ODD[:, None]
        v += _ADD[:, None]
        np.minimum(low, v.min(1), out=low)
        np.maximum(high, v.max(1), out=high)
    return np.concatenate([low, high])


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band, different for equal rows of different bands."""
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    acc = _BAND.copy()
    for i in range(ROWS):
        acc = mix64(acc ^ rows[:, i]) + np.uint64(0x9E3779B97F4A7C15)
    return acc


def _set_key(hashes: np.ndarray) -> bytes | None:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, n_shingles, key of the set, band hashes); of texts without words the last two are null."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in utf8(batch.column(1)):
                s = shingles(known.of(split_words(text)), words)
                sizes.append(len(s))
                keys.append(_set_key(s))
                bands.append(band_hashes(min_max_signature(s)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "set_key", "bands"],
            )

    return docs.mapInArrow(sign, "id long, n_shingles long, set_key binary, bands array<long>")


def _groups(reps: DataFrame, tile: int) -> DataFrame:
    """(hub, rep, chunks, chunk): the members of all buckets that elected the same hub, the hub itself among them."""
    rows = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = stored(rows.join(stored(shared.drop("size"), "shared"), "bucket").select("hub", "rep").distinct(), "pairs")
    sizes = stored(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / tile).alias("chunks")), "sizes")
    return stored(pairs.join(sizes, "hub").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks"))), "groups")


def _links(tiles: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) found within tiles, as few as connect what is connected.

    `tiles` has rows (hub, x, y, rep, component, active): the active rows of a tile (hub, x, y) are compared with all rows
    of the tile that are not yet in their component. A tile is held by one task at a time; its size is bounded.
    """
    rows = tiles.join(texts, "rep").repartition("hub", "x", "y").sortWithinPartitions("hub", "x", "y", F.desc("active"), "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        key, held = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("hub", "x", "y", "rep", "component", "active", "set_key"))
            for (hub, x, y, rep, component, active, expected), text in zip(zip(*columns, strict=True), utf8(batch.column("text")), strict=True):
                if (hub, x, y) != key:
                    out += _connect(held, percent)
                    key, held = (hub, x, y), []
                s = shingles(known.of(split_words(text)), words)
                if _set_key(s) == expected:  # else another text under the same id
                    held.append((rep, component, active, s))
            yield _edges(out)
        yield _edges(_connect(held, percent))

    return rows.mapInArrow(compare, "a long, b long")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _connect(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links of a tile's active rows with rows outside their components, by counting common shingles over postings."""
    if len(rows) < 2:
        return []
    sizes = np.array([len(s) for *_, s in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    _, term = np.unique(np.concatenate([s for *_, s in rows]), return_inverse=True)
    order = np.argsort(term, kind="stable")
    posting = owner[order]  # rows by shingle
    start = np.searchsorted(term[order], np.arange(term.max() + 2))
    first = np.concatenate([[0], np.cumsum(sizes)])
    names: dict[int, int] = {}
    component = np.array([names.setdefault(c, len(names)) for _, c, _, _ in rows])
    links = []
    for i, (rep, _, active, _) in enumerate(rows):
        if not active:
            continue
        others = component != component[i]
        if not others.any():
            continue
        own = term[first[i] : first[i + 1]]
        common = np.bincount(np.concatenate([posting[start[t] : start[t + 1]] for t in own]), minlength=len(rows))
        near = np.flatnonzero(others & (100 * common >= percent * (sizes + sizes[i] - common)))
        for j in near:
            if component[j] != component[i]:
                links.append((rep, rows[j][0]))
                component[component == component[j]] = component[i]
    return links


def _labelled(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """(rep, component) of all representatives."""
    found = connected_components(edges).withColumnRenamed("node", "rep")
    joined = reps.select("rep").distinct().join(found, "rep", "left")
    return stored(joined.select("rep", F.coalesce("component", "rep").alias("component")), "labels")


def _whole_components(reps: DataFrame, groups: DataFrame, texts: DataFrame, words: int, percent: int, tile: int) -> DataFrame:
    """(rep, component). Groups of one tile are compared whole; of larger ones first each chunk with the hub, then what
    the hub's component has not taken in, in blocks against every chunk."""
    hubs = groups.where("rep = hub").select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("x"), F.col("hub").alias("rep"))
    first = groups.select("hub", F.col("chunk").alias("x"), "rep").unionByName(hubs.select("hub", F.col("x").cast("long"), "rep")).distinct()
    first = first.select("hub", "x", F.lit(0).alias("y"), "rep", F.col("rep").alias("component"), F.lit(True).alias("active"))
    links = stored(_links(first, texts, words, percent), "links")
    labels = _labelled(reps, links)
    large = groups.where("chunks > 1")
    if large.isEmpty():
        return labels
    of_hub = large.where("rep = hub").select("hub").join(labels.withColumnsRenamed({"rep": "hub", "component": "main"}), "hub")
    members = stored(large.join(labels, "rep").join(stored(of_hub, "mains"), "hub"), "members")
    outside = members.where("component != main")
    blocks = stored(outside.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / tile).alias("blocks")), "blocks")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    asking = outside.join(blocks, "hub").select(
        "hub", F.explode(numbers).alias("x"), F.pmod(F.xxhash64(F.lit(3), "rep"), "blocks").alias("y"), "rep", "component", F.lit(True).alias("active")
    )
    asked = members.join(blocks, "hub").select(
        "hub", F.col("chunk").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("y"), "rep", "component", F.lit(False).alias("active")
    )
    more = stored(_links(asking.unionByName(asked), texts, words, percent), "links")
    return _labelled(reps, links.unionByName(more))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, tile: int) -> DataFrame:
    """(id, n_shingles, component) of all rows; without an id or words the component is the id."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stored(_signed(rows, words), "signed")
    linkable = F.col("id").isNotNull() & F.col("set_key").isNotNull()
    reps = signed.where(linkable).groupBy("set_key").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"))
    reps = stored(reps, "reps")
    groups = _groups(reps, tile)
    wanted = groups.select("rep").distinct().join(reps.select("rep", "set_key"), "rep")
    texts = stored(rows.withColumnRenamed("id", "rep").join(wanted, "rep"), "texts")
    labels = _whole_components(reps, groups, texts, words, percent, tile)
    # two sets can have one id as representative only if rows of that id differ; they share its component then
    by_set = stored(reps.select("set_key", "rep").join(labels, "rep").select("set_key", "component"), "by_set")
    found = signed.where(linkable).select("id", "n_shingles", "set_key").join(by_set, "set_key")
    rest = signed.where(~linkable).select("id", "n_shingles", F.col("id").alias("component"))
    return found.select("id", "n_shingles", "component").unionByName(rest)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, tile: int = 256
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable over links), kept."""
    out = _grouped(docs, id_col, text_col, words, percent, tile)
    return out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, tile: int = 256
) -> DataFrame:
    """The documents whose id is the least of their group, with all their columns; rows without an id stay."""
    dropped = _grouped(docs, id_col, text_col, words, percent, tile).where("id != component").select("id").distinct()
    dropped = stored(dropped, "dropped")
    return docs.join(dropped, docs[id_col] == dropped["id"], "left_anti")
