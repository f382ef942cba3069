"""Operator 11, byte-level BPE encoding and decoding by length-bucketed padded matrices.

A text is cut by the pattern into pre-tokens, and each pre-token is merged by itself. Pre-tokens that a worker has not seen
yet are put into buckets of like length; a bucket is a padded matrix of token ids, one pre-token a row. In each round every
row merges its leftmost pair of least rank. Ranks of pairs come from an open-addressing hash table in numpy; merged cells
are taken out by compaction, and rows without a further pair leave the matrix.

A row merges further places of its least rank in the same round where that gives what merging them one by one, from left
to right, would give: where no pair that comes about at these places has a lesser rank. So a long run of letters takes as
many rounds as it has ranks, not as many as it has merges.

Defined results: null and empty texts have no ids and decode to the empty text; a pre-token that is a token as a whole is
that token; texts that look like special tokens are ordinary text; repeated rows are encoded row by row; an empty table
gives no rows; extra columns are ignored unless named in `keep`, and may have any name. Memory of a worker: the model, up to
`_REMEMBERED` short pre-tokens, matrices of about `_CELLS` cells, or of one pre-token if that is longer.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from shelfline.llm.common import mix64

_NONE = np.int32(2**31 - 1)
_CELLS = 1 << 19
_REMEMBERED = 400_000
_LONGEST = 64  # bytes of a pre-token that is remembered
_ROWS = 256  # texts encoded at a time


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class PairTable:
    """(left id, right id) -> id of the merged token, in an open-addressing hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        size = 1 << max(4, (4 * len(pairs)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.values = np.full(size, _NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = mix64(keys) & self.mask
        empty = self.keys[0]
        while len(keys):  # all that find their slot free go in, of equals the first; the others try the next slot
            free = np.flatnonzero(self.keys[slots] == empty)
            _, first = np.unique(slots[free], return_index=True)
            into = free[first]
            self.keys[slots[into]] = keys[into]
            self.values[slots[into]] = values[into]
            rest = np.ones(len(keys), bool)
            rest[into] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + np.uint64(1)) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NONE where it has none."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = mix64(keys) & self.mask
        out = np.full(len(keys), _NONE, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.keys[slots]
            hit = found == keys
            out[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (found != np.uint64(2**64 - 1))
            open_, keys, slots = open_[on], keys[on], (slots[on] + np.uint64(1)) & self.mask
        return out


def _row_ranks(pairs: PairTable, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rank of each cell with the cell after it, _NONE at the end of a row and in the padding."""
    ranks = np.full(ids.shape, _NONE, np.int32)
    row, col = np.nonzero(np.arange(ids.shape[1]) < lengths[:, None] - 1)
    ranks[row, col] = pairs.ranks(ids[row, col], ids[row, col + 1])
    return ranks


def _chosen(pairs: PairTable, ids: np.ndarray, ranks: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Cells that merge with the one after them: the leftmost of least rank in each row, and further ones where that is
    the same as one by one."""
    equal = ranks == least[:, None]
    cols = np.arange(ids.shape[1])
    first = equal.argmax(1)
    several = np.flatnonzero(equal.sum(1) > 1)
    chosen = cols == first[:, None]
    if len(several) == 0:
        return chosen
    some = equal[several]
    # of neighbouring candidates every second one, counted from the left: a merge takes the cell after it
    start = np.maximum.accumulate(np.where(~some, cols, -1), 1)
    some &= (cols - start) % 2 == 1
    row, col = np.nonzero(some)
    at = several[row]
    made = least[at]
    bad = np.zeros(len(several), bool)
    has_left = col > 0
    has_right = col + 2 < lengths[at]
    for where, left, right in (
        (has_left, ids[at, col - 1], made),
        (has_right, made, ids[at, np.minimum(col + 2, ids.shape[1] - 1)]),
        (has_left | has_right, made, made),
    ):
        low = pairs.ranks(left[where], right[where]) < made[where]
        bad[row[where][low]] = True
    chosen[several[~bad]] = some[~bad]
    return chosen


def merge_rows(pairs: PairTable, ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All merges of all rows. `ids` is padded; the first `lengths` cells of a row count. Gives, round by round, the rows
    that are done, their numbers of ids, and their ids one after the other."""
    rows = np.arange(len(ids))
    ranks = _row_ranks(pairs, ids, lengths)
    while len(rows):
        least = ranks.min(1)
        if (ended := least == _NONE).any():
            n = lengths[ended]
            yield rows[ended], n, ids[ended][np.arange(ids.shape[1]) < n[:, None]]
            on = ~ended
            width = int(lengths[on].max(initial=0))
            rows, lengths, least = rows[on], lengths[on], least[on]
            ids, ranks = ids[on, :width], ranks[on, :width]
            if len(rows) == 0:
                return
        chosen = _chosen(pairs, ids, ranks, lengths, least)
        taken = np.zeros_like(chosen)  # the right half of each merged pair
        taken[:, 1:] = chosen[:, :-1]
        stays = (np.arange(ids.shape[1]) < lengths[:, None]) & ~taken
        ids = np.where(chosen, least[:, None], ids)
        lengths = stays.sum(1)
        shape = (len(rows), int(lengths.max()))
        row, col = np.nonzero(stays)
        to = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        cells = [np.zeros(shape, np.int32), np.full(shape, _NONE, np.int32), np.zeros(shape, bool)]
        for new, old in zip(cells, (ids, ranks, chosen), strict=True):
            new[row, to] = old[row, col]
        ids, ranks, merged = cells
        merged[:, :-1] |= merged[:, 1:]  # a pair has another rank if its left or its right cell is new
        inner = np.arange(shape[1]) < lengths[:, None] - 1
        ranks[~inner] = _NONE
        row, col = np.nonzero(merged & inner)
        ranks[row, col] = pairs.ranks(ids[row, col], ids[row, col + 1])


class Encoder:
    """A worker's encoder: the model, and the ids of short pre-tokens seen before."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.ranks = read_ranks(data)
        self.pairs = PairTable(self.ranks)
        self.split = regex.compile(pattern).findall
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the model has no token for the bytes {missing[:5]}")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.known: dict[str, bytes] = {}

    def learn(self, parts: Iterable[str]) -> dict[str, bytes]:
        """The ids of each pre-token, as 32-bit little-endian integers."""
        out: dict[str, bytes] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for part in parts:
            raw = part.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                out[part] = whole.to_bytes(4, "little")
            else:
                buckets.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((part, raw))
        for width, members in buckets.items():
            at_once = max(1, _CELLS // width)
            for at in range(0, len(members), at_once):
                some, raws = zip(*members[at : at + at_once], strict=True)
                lengths = np.fromiter(map(len, raws), np.int64, len(raws))
                padded = np.zeros((len(raws), int(lengths.max())), np.int32)
                padded[np.arange(padded.shape[1]) < lengths[:, None]] = self.of_byte[np.frombuffer(b"".join(raws), np.uint8)]
                for rows, counts, ids in merge_rows(self.pairs, padded, lengths):
                    data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                    out.update(zip(map(some.__getitem__, rows.tolist()), (data[x:y] for x, y in zip([0, *ends], ends)), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as 32-bit little-endian integers."""
        split = [self.split(t) if t else [] for t in texts]
        missing = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(missing) > _REMEMBERED:
            self.known.clear()
            missing = set(chain.from_iterable(split))
        self.known.update(self.learn(missing))
        made = [b"".join(map(self.known.__getitem__, parts)) for parts in split]
        for part in missing:
            if len(part) > _LONGEST:
                del self.known[part]
        return made

    def decode(self, packed: list[bytes | None]) -> list[bytes | None]:
        """The bytes that the ids stand for."""
        counts = np.fromiter((len(p) // 4 if p else 0 for p in packed), np.int64, len(packed))
        parts = self.tokens.take(pa.array(np.frombuffer(b"".join(p for p in packed if p), "<u4")))
        if len(parts) == 0:
            return [None if p is None else b"" for p in packed]
        offsets = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, parts.offset * 8)
        ends = offsets[np.concatenate([[0], np.cumsum(counts)])].tolist()
        data = memoryview(parts.buffers()[2])
        return [None if p is None else bytes(data[a:b]) for p, a, b in zip(packed, ends, ends[1:])]


_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    """The worker's encoder of this model; workers go on to further tasks with what they remember."""
    key = hashlib.sha256(data + pattern.encode()).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(data, pattern)
    return _ENCODERS[key]


def _model(frame: DataFrame, path: str, pattern: str):
    with open(path, "rb") as f:
        return frame.sparkSession.sparkContext.broadcast((f.read(), pattern))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id_col, the `keep` columns, n_tokens and `packed`, the ids as little-endian unsigned 32-bit
    integers. `unpacked_ids` makes an array of them."""
    shared = _model(docs, ranks_path, pattern)
    kept = [docs.schema[c] for c in (id_col, *keep)]
    rows = docs.select(*[F.col(f"`{f.name}`").alias(f"kept_{i}") for i, f in enumerate(kept)], F.col(f"`{text_col}`").alias("text"))
    n = len(kept)
    schema = StructType([StructField(f"kept_{i}", f.dataType) for i, f in enumerate(kept)]).add("n_tokens", LongType()).add("packed", BinaryType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                made = encoder.encode([t or "" for t in part.column(n).to_pylist()])
                counts = pa.array([len(m) // 4 for m in made], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n)), counts, pa.array(made, pa.binary())], names=schema.names)

    out = rows.mapInArrow(encode, schema)
    return out.select(*[F.col(f"kept_{i}").alias(f.name) for i, f in enumerate(kept)], "n_tokens", "packed")


def unpacked_ids(packed: str = "packed") -> F.Column:
    """The ids as an array of integers."""
    cells = F.sequence(F.lit(1), F.greatest((F.octet_length(F.col(packed)) / 4).cast("int"), F.lit(1)))

    def at(i: F.Column) -> F.Column:
        cell = F.hex(F.substring(F.col(packed), (i - 1) * 4 + 1, F.lit(4)))
        return F.conv(F.concat(*[F.substring(cell, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")

    return F.when(F.octet_length(F.col(packed)) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(cells, at))


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, packed_col: str = "packed", out_col: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids in a further column; null ids decode to null. The bytes of whole texts are
    UTF-8 again; those of a part of the ids need not be."""
    shared = _model(encoded, ranks_path, pattern)
    at = encoded.columns.index(packed_col)
    schema = StructType(list(encoded.schema.fields)).add(out_col, BinaryType())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                raw = pa.array(encoder.decode(part.column(at).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, raw], names=schema.names)

    return encoded.mapInArrow(decode, schema)
