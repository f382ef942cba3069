"""Operator 13, ranked lexical search without random access (NRA) over impact-sorted lists.

Documents are cut into terms once, where they are read, and stored with their length and their counts of the terms that any
item asks for. Corpus statistics come from that table. Then every task turns its documents, a bounded number of postings at a
time, into one list per term, sorted by falling impact, and answers all items from these lists: it reads them from the top,
block after block, and keeps for each document the sum of what was read (the lower bound) and that sum plus the impact at
which each list stands where the document was not yet read (the upper bound). An item is done when no document that was not
read at all can reach the k-th lower bound, and every document that can reach it has equal bounds; then membership, ties and
scores are certain. The best of one share of documents are the floor for the next share of the task.

No posting is shuffled: a term that a third of all documents hold is spread over all tasks, as the documents are. What the
tasks hand on is k rows per item, combined in two stages. Items are asked in blocks of `block_bytes` of text, each block being
one pass over the documents; a block's terms, weights and counts are all that is collected or broadcast.

Defined results: documents without a term, or without text, are in no result and count in no statistic; every row is a document
of its own, also with an id that occurs again; a null id comes after all others; equal rows of items are one item, and items
without a term that a document holds have no rows; an empty table on either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored, utf8

#: A-Z in lower case, every other ASCII byte that is no letter or digit a blank; all bytes of other characters stay.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
_SALTS = 64


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and counts of its terms of the vocabulary, for documents with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
                    if words := terms(text):
                        counts = Counter(map(number, words))
                        counts.pop(None, None)
                        rows.append((doc, len(words), list(counts), list(counts.values())))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<bigint>")


def ranked(docs: list, scores: np.ndarray, k: int) -> list[tuple[int, int | None]]:
    """The best k as (score, doc_id), equal scores by ascending id, null last."""
    return sorted(zip(scores.tolist(), docs, strict=True), key=_place)[:k]


def _place(row: tuple[int, int | None]) -> tuple:
    return -row[0], row[1] is None, row[1] or 0


class ImpactLists:
    """The postings of some documents by term, in order of falling impact."""

    def __init__(self, doc_ids: list, lengths: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        self.doc_ids = doc_ids
        m = 100 - 75 + (75 * lengths * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        order = np.lexsort((-impact, term))
        self.owner, self.impact = owner[order], impact[order]
        numbers, starts = np.unique(term[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)][: len(numbers)]
        self.spans = {t: (a, b) for t, a, b in zip(numbers.tolist(), starts.tolist(), ends, strict=True)}

    def best(self, item: list[tuple[int, int]], k: int, floor: int = 0, first_read: int = 64) -> list[tuple[int, int | None]]:
        """The best k of these documents for (term, weight) pairs: (score, doc_id), scores of at least `floor` and above 0."""
        lists = [(self.owner[a:b], self.impact[a:b], w) for t, w in item if w > 0 and t in self.spans for a, b in (self.spans[t],)]
        limits = [int(impact[0]) * w for _, impact, w in lists]  # of what a list may still add to a document
        if not lists or sum(limits) < floor:
            return []
        lower = np.zeros(len(self.doc_ids), np.int64)
        at, step, reach = 0, first_read, 0
        while any(at < len(owner) for owner, _, _ in lists):
            for j, (owner, impact, w) in enumerate(lists):
                if at < len(owner):
                    lower[owner[at : at + step]] += impact[at : at + step] * w
                    limits[j] = int(impact[at + step]) * w if at + step < len(owner) else 0
            at, step = at + step, 2 * step
            reach = max(floor, int(np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) > k else 0)
            if sum(limits) < reach:  # documents not read at all are out; are the others certain?
                read = np.zeros(len(lower), np.int64)  # the limits of the lists that each document was read in
                for (owner, _, _), limit in zip(lists, limits, strict=True):
                    if limit:
                        read[owner[:at]] += limit
                missing = sum(limits) - read
                if not missing[lower + missing >= reach].any():
                    break
        reach = max(floor, int(np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) > k else 0)
        found = np.flatnonzero((lower >= reach) & (lower > 0))
        return ranked([self.doc_ids[i] for i in found], lower[found], k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 8 << 20,
    postings: int = 1 << 20,
    first_read: int = 64,
) -> DataFrame:
    """item_id, rank from 1, doc_id, score: each item's k best documents. `postings` bounds what a task sorts at a time."""
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).distinct()
    asked = stored(asked, "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    results = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        results.append(_search_block(docs, [(r["item_id"], (r["text"] or "").encode()) for r in rows], k, id_col, text_col, postings, first_read))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_block(docs: DataFrame, items: list[tuple], k: int, id_col: str, text_col: str, postings: int, first_read: int) -> DataFrame:
    spark = docs.sparkSession
    wanted = [Counter(terms(text)) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    rows = stored(document_terms(docs, vocabulary, id_col, text_col), "document_terms")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = {r["term"]: r["count"] for r in held.collect()}  # at most one row per term of the block
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    pairs = [[(vocabulary[t], times * weight.get(vocabulary[t], 0)) for t, times in counts.items()] for counts in wanted]
    shared = spark.sparkContext.broadcast(([i for i, _ in items], pairs))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, pairs = shared.value
        best: list[list] = [[] for _ in pairs]
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                n += len(part.column(2).flatten())
                if n >= postings:
                    _improve(best, held, pairs)
                    held, n = [], 0
        if held:
            _improve(best, held, pairs)
        out = [(no, item_ids[no], doc, score) for no, found in enumerate(best) for score, doc in found]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_no", "item_id", "doc_id", "score"])

    def _improve(best: list[list], held: list[pa.RecordBatch], pairs: list[list[tuple[int, int]]]) -> None:
        whole = pa.Table.from_batches(held).combine_chunks()
        doc_ids, lengths, term, tf = (c.combine_chunks() for c in whole.columns)
        sizes = np.diff(term.offsets.to_numpy())
        owner = np.repeat(np.arange(len(doc_ids)), sizes)
        lists = ImpactLists(doc_ids.to_pylist(), lengths.to_numpy(), owner, term.flatten().to_numpy(), tf.flatten().to_numpy(), n_docs, n_terms)
        for no, item in enumerate(pairs):
            floor = best[no][-1][0] if len(best[no]) == k else 0
            if found := lists.best(item, k, floor, first_read):
                best[no] = sorted(best[no] + found, key=_place)[:k]

    found = rows.mapInArrow(answer, "item_no long, item_id long, doc_id long, score long").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for keys in (("item_no", "salt"), ("item_no",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
