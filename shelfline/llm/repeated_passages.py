"""Operator 5, repeated passages by sparse suffix arrays.

Of a document's suffixes only those are retained that begin at a minimiser: the least hash among the 8-word runs of some
stretch of `least` words. Which it is depends on the stretch alone, so two documents that share `least` words retain
suffixes at the same place of it. Retained suffixes are sorted; neighbours are compared word by word to the right, then to
the left, and what they share is a repeated passage if it has at least `least` words. Words count as equal when they are
equal in lower case (A-Z).

Suffixes whose first eight words occur once are dropped before any context is sent. A suffix may share a long left side
with one suffix and a long right side with another, and a passage with a third that is no neighbour of it; so where three
or more begin alike, the contexts are also put in order for each split of `least` words into left and right, and
neighbours compared there.

Suffixes that begin alike are together in one task, up to `hot` of them. Of more of them, such as those of a passage that
a third of all documents have, no contexts are compared: each window of `least` words whose minimiser is such a suffix is
sent as one 64-bit hash. The hashes are range partitioned together with their places, which deals out a common one evenly;
a window is repeated if a neighbour in this order has the same hash, and the last of each range is compared with the first
of the next. A window has one minimiser and so is sent once.

Defined results: null, empty and short texts have no passages; a passage that occurs twice in one document is repeated,
also where the two overlap; repeated rows repeat each other; null ids are reported as null; an empty table gives no rows;
extra columns are ignored. A document is a row's id and text: rows with the same id, or none, and different texts are different
documents, rows equal in both are reported once. Words are compared by 32-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WordHashes, mix64, split_words, stored, utf8

GRAM = 8
_CHUNK = 20_000
_NO_ID = -(2**63)


def _grams(hashes: np.ndarray) -> np.ndarray:
    acc = np.full(len(hashes) - GRAM + 1, GRAM, np.uint64)
    for i in range(GRAM):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(acc) + i])
    return acc


def _window_hashes(hashes: np.ndarray, least: int) -> np.ndarray:
    """A hash for each run of `least` words, put together from runs of 1, 2, 4 ... words."""
    prime, n = np.uint64(0x9E3779B97F4A7C15), len(hashes) - least + 1
    runs, width, acc, done = hashes, 1, np.full(n, least, np.uint64), 0
    while done < least:
        if least & width:
            acc, done = mix64(acc * prime + runs[done : done + n]), done + width
        if done < least:
            runs, width = mix64(runs[:-width] * prime + mix64(runs[width:] + np.uint64(width))), 2 * width
    return acc


def _window_minimisers(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run of `least` words the position of its minimiser, and the hashes of all 8-word runs."""
    grams = _grams(hashes)
    # the high bits of the hash, then the place, so that the least of a stretch tells where it is, the leftmost of equal ones
    low = np.uint64((1 << max(26, len(grams).bit_length())) - 1)
    span, width = least - GRAM + 1, 1
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    while 2 * width <= span:
        keys, width = np.minimum(keys[:-width], keys[width:]), 2 * width
    if span > width:
        keys = np.minimum(keys[: len(keys) - span + width], keys[span - width :])
    return (keys & low).astype(np.int64), grams


def minimisers(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the retained suffixes, and the hashes of their first words."""
    if len(hashes) < least:
        return np.array([], np.int64), np.array([], np.uint64)
    of_windows, grams = _window_minimisers(hashes, least)
    at = np.unique(of_windows)
    return at, grams[at]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, a hash of the text that tells documents with the same id apart, and the text."""
    text = F.col(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("own"), text.alias("text"))


def _anchors(rows: DataFrame, least: int) -> DataFrame:
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, owns, places, grams = [], [], [], []
            for id_, own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                at, gram = minimisers(known.of(split_words(text)), least)
                ids.append(np.full(len(at), id_, np.int64))
                owns.append(np.full(len(at), own, np.int64))
                places.append(at.astype(np.int32))
                grams.append(gram.view(np.int64))
            if ids:
                columns = [pa.array(np.concatenate(c)) for c in (ids, owns, places, grams)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "own", "at", "gram"])

    return rows.mapInArrow(anchors, "id long, own long, at int, gram long")


def _binaries(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _contexts(rows: DataFrame, least: int) -> DataFrame:
    """From (id, own, text, places), a row per place: gram, right words, left words (the nearest first), their numbers."""
    right, left = least, least - GRAM

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        steps_right, steps_left = np.arange(right), -1 - np.arange(left)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                made: list[tuple] = []
                for id_, own, text, places in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist(), strict=True):
                    hashes = known.of(split_words(text))
                    at = np.array(places, np.int64)
                    if len(at):
                        words = np.zeros(left + len(hashes) + right, np.uint32)
                        words[left : left + len(hashes)] = hashes >> np.uint64(32)
                        grams = _grams(hashes)[at].view(np.int64)
                        sides = (words[(at + left)[:, None] + steps] for steps in (steps_right, steps_left))
                        made.append((grams, *sides, len(hashes) - at, at, np.full(len(at), id_), np.full(len(at), own)))
                if made:
                    grams, r, lf, after, at, ids, owns = (np.concatenate(c) for c in zip(*made, strict=True))
                    n_right, n_left = np.minimum(after, right).astype(np.int32), np.minimum(at, left).astype(np.int32)
                    arrays = [pa.array(grams), _binaries(r), _binaries(lf), *map(pa.array, (n_right, n_left, ids, owns, at.astype(np.int32)))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["gram", "right", "left", "n_right", "n_left", "id", "own", "at"])

    return rows.mapInArrow(contexts, "gram long, right binary, left binary, n_right int, n_left int, id long, own long, at int")


def _shared(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Row by row, how many leading words are equal."""
    differ = a != b
    return np.minimum(np.where(differ.any(1), differ.argmax(1), a.shape[1]), most)


def _compare(rows: list[tuple], least: int) -> Iterator[tuple[int, int, int, int]]:
    """Repeated passages (id, own, begin, end) among sorted suffixes."""
    gram = np.array([r[0] for r in rows], np.int64)
    right = np.frombuffer(b"".join(r[1] for r in rows), np.uint32).reshape(len(rows), -1)
    left = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).reshape(len(rows), -1)
    n_right, n_left, ids, owns, at = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5, 6, 7))
    same = gram[1:] == gram[:-1]
    to_right = _shared(right[1:], right[:-1], np.minimum(n_right[1:], n_right[:-1]))
    to_left = _shared(left[1:], left[:-1], np.minimum(n_left[1:], n_left[:-1]))
    for k in np.flatnonzero(same & (to_right + to_left >= least)):
        for row in (k, k + 1):
            yield int(ids[row]), int(owns[row]), int(at[row] - to_left[k]), int(at[row] + to_right[k])
    # where three or more begin alike: every split of `least` words
    middle = np.flatnonzero(same[1:] & same[:-1]) + 1
    some = np.unique(np.concatenate([middle - 1, middle, middle + 1]))
    if len(some) < 3:
        return
    gram, right, left, n_right, n_left, ids, owns, at = (c[some] for c in (gram, right, left, n_right, n_left, ids, owns, at))
    after = np.empty((len(some), least + 1), np.uint64)
    after[:, 0] = gram.view(np.uint64)
    for k in range(least):
        after[:, k + 1] = mix64(after[:, k] * np.uint64(0x9E3779B97F4A7C15) + right[:, k])
    before = np.zeros(len(some), np.uint64)
    for o in range(left.shape[1] + 1):
        if o:
            before = mix64(before * np.uint64(0x9E3779B97F4A7C15) + left[:, o - 1])
        able = np.flatnonzero((n_left >= o) & (n_right >= least - o))
        key = mix64(after[able, least - o] ^ mix64(before[able] + np.uint64(o + 1)))
        order = np.argsort(key, kind="stable")
        pair = np.flatnonzero(key[order][1:] == key[order][:-1])
        for row in able[np.unique(np.concatenate([order[pair], order[pair + 1]]))]:
            yield int(ids[row]), int(owns[row]), int(at[row] - o), int(at[row] - o + least)


def _blocks(rows: Iterator[tuple], chunk: int) -> Iterator[list[tuple]]:
    """Sorted rows in blocks of about `chunk`; those that begin alike are never parted."""
    held: list[tuple] = []
    for row in rows:
        if len(held) >= chunk and row[0] != held[-1][0]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _passages(sorted_rows: DataFrame, least: int) -> DataFrame:
    """Passages within each partition of sorted suffixes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for block in _blocks(rows, _CHUNK):
            found = dict.fromkeys(_compare(block, least)) if len(block) > 1 else {}
            columns = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "own", "at", "end"])

    return sorted_rows.mapInArrow(find, "id long, own long, at long, end long")


def _windows(rows: DataFrame, least: int) -> DataFrame:
    """From (id, own, text, places), a row per window whose minimiser is at one of the places: hash, id, own, place of its begin."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made: list[tuple] = []
                for id_, own, text, places in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist(), strict=True):
                    hashes = known.of(split_words(text))
                    of_windows, _ = _window_minimisers(hashes, least)
                    begin = np.flatnonzero(np.isin(of_windows, np.array(places, np.int64)))
                    if len(begin):
                        hashed = _window_hashes(hashes, least)[begin].view(np.int64)
                        made.append((hashed, np.full(len(begin), id_, np.int64), np.full(len(begin), own, np.int64), begin.astype(np.int32)))
                if made:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*made, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["hash", "id", "own", "at"])

    return rows.mapInArrow(windows, "hash long, id long, own long, at int")


def _same_as_neighbour(sorted_windows: DataFrame) -> DataFrame:
    """Windows with a neighbour of the same hash in their partition (edge 0), and the partitions' first and last (1 and 2)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, last_same = None, False

        def rows(edge: int, *columns: np.ndarray) -> pa.RecordBatch:
            fixed = [pa.array(np.full(len(columns[0]), v, np.int32)) for v in (edge, task)]
            return pa.RecordBatch.from_arrays([*fixed, *map(pa.array, columns)], names=["edge", "task", "hash", "id", "own", "at"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if last is None:
                yield rows(1, *[c[:1] for c in columns])
            else:
                columns = [np.concatenate(c) for c in zip(last, columns, strict=True)]
            h = columns[0]
            same = np.zeros(len(h), bool)
            same[0] = last_same
            equal = h[1:] == h[:-1]
            same[1:] |= equal
            same[:-1] |= equal
            last, last_same = [c[-1:] for c in columns], bool(same[-1])
            kept = np.flatnonzero(same[:-1])
            if len(kept):
                yield rows(0, *[c[kept] for c in columns])
        if last is not None:
            if last_same:
                yield rows(0, *last)
            yield rows(2, *last)

    return sorted_windows.mapInArrow(find, "edge int, task int, hash long, id long, own long, at int")


def _over_borders(edges: DataFrame) -> DataFrame:
    """The last window of a range and the first of the next, where they are the same: two rows for each range."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        found = dict.fromkeys(r[2:] for a, b in zip(rows, rows[1:], strict=False) if a[0] != b[0] and a[1] == b[1] for r in (a, b))
        ids, owns, begins = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(owns, pa.int64()), pa.array(begins, pa.int32())], names=["id", "own", "at"])

    columns = ["task", "hash", "id", "own", "at"]
    ordered = edges.select("edge", *columns).coalesce(1).sortWithinPartitions("task", "edge").select(*columns)
    return ordered.mapInArrow(find, "id long, own long, at int")


def _merged(ids: np.ndarray, owns: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[tuple[int, int], int, int]]:
    """From spans in order of document and begin, those of one document united where they overlap."""
    if not len(ids):
        return iter(())
    # ends so far of the same document: a later one counts from a higher step
    step = np.concatenate([[0], np.cumsum((ids[1:] != ids[:-1]) | (owns[1:] != owns[:-1]))]) << 32
    reach = np.maximum.accumulate(ends + step)
    fresh = np.concatenate([[True], begins[1:] + step[1:] > reach[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(ids)) - 1
    docs = zip(ids[first].tolist(), owns[first].tolist(), strict=True)
    return zip(docs, begins[first].tolist(), (reach - step)[last].tolist(), strict=True)


def _united(passages: DataFrame) -> DataFrame:
    """A row per document with its passages, where they overlap united, in order."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        now, spans = None, []
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, all_spans = zip(*done, strict=True) if done else ((), ())
            words = [sum(e - b for b, e in s) for s in all_spans]
            columns = [
                pa.array([None if i == _NO_ID else i for i, _ in ids], pa.int64()),
                pa.array([len(s) for s in all_spans], pa.int64()),
                pa.array(words, pa.int64()),
                pa.array([[{"begin": b, "end": e} for b, e in s] for s in all_spans], kind),
            ]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_passages", "repeated_words", "passages"])

        for batch in batches:
            for id_, begin, end in _merged(*(c.to_numpy(zero_copy_only=False) for c in batch.columns)):
                if id_ != now:
                    if spans:
                        done.append((now, spans))
                    now, spans = id_, []
                if spans and begin <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([begin, end])
            if len(done) > 2000:
                yield flush()
        if spans:
            done.append((now, spans))
        yield flush()

    n = int(passages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = passages.select("id", "own", "at", "end").repartition(n, "id", "own").sortWithinPartitions("id", "own", "at")
    return rows.mapInArrow(unite, "doc_id long, n_passages long, repeated_words long, passages array<struct<begin:long,end:long>>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50, hot: int = 512) -> DataFrame:
    """One row per document that has passages of at least `least` words which occur elsewhere: doc_id, n_passages,
    repeated_words, passages (begin and end in words)."""
    if least < 2 * GRAM:
        raise ValueError(f"passages have at least {2 * GRAM} words")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, id_col, text_col)
    anchors = stored(_anchors(rows, least), "anchors")
    often = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = stored(often.select("gram", (F.col("n") > hot).alias("hot")), "often")
    places = anchors.join(often, "gram").groupBy("id", "own").agg(
        F.array_sort(F.collect_set(F.when(~F.col("hot"), F.col("at")))).alias("few"),
        F.array_sort(F.collect_set(F.when(F.col("hot"), F.col("at")))).alias("many"),
    )
    texts = rows.join(stored(places, "places"), ["id", "own"])
    few = _contexts(texts.where(F.size("few") > 0).select("id", "own", "text", "few"), least)
    found = stored(_passages(few.repartition(n, "gram").sortWithinPartitions("gram", "right", "left"), least), "passages")
    if not often.where("hot").isEmpty():
        # stored, since the ranges are drawn from a first pass over the windows
        many = stored(_windows(texts.where(F.size("many") > 0).select("id", "own", "text", "many"), least), "windows")
        ranges = many.repartitionByRange(n, "hash", "id", "own", "at").sortWithinPartitions("hash", "id", "own", "at")
        same = stored(_same_as_neighbour(ranges), "same")
        same = same.where("edge = 0").select("id", "own", "at").unionByName(_over_borders(same.where("edge > 0")))
        found = found.unionByName(same.select("id", "own", F.col("at").cast("long").alias("at"), (F.col("at") + least).cast("long").alias("end")))
    return _united(found)
