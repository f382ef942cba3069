"""Operator 12, a prefix trie of conversations, by adaptive radix trees over turn ids.

A turn (role and text) has a 16-byte id, the head of the SHA-256 of both; a conversation is a key, its turn ids one after
the other, compared as big-endian bytes. Keys are sorted over the cluster and put, run by run, into an adaptive radix tree:
inner nodes hold 4, 16, 48 or 256 children and grow from one layout to the next, and paths without a fork are one label.
Bytes inside a turn id fork the tree but are no nodes of the trie; only depths that are a multiple of 16 bytes are.

Only the nodes on the paths of a run's first and last key can have members in other runs. All others are final. Those two
paths are handed on as keys with sums, merged by key, and go through the same step again, until one run holds them all; a
step leaves two paths of each run. So no task holds more than a run, however many conversations begin alike, and no list of
conversations, nodes or links goes to the driver, which only counts the keys that are left. Equal conversations are one key;
the hash over their ids is taken over sorted blocks of ids that were joined where they lay, a block at a time.

Defined results: a null role or text is empty; a row without conv_id belongs to no conversation and is left out; turns are in
the order of `turn` with null first, equal turns in the order of role and turn id, and repeated rows are turns of their own;
a conversation without turns is a member of the root only; an empty table gives no rows; extra columns are ignored, whatever
their names. A conversation is one row of 24 bytes a turn while the trie is built; texts only give ids and lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored

WIDTH = 16
_BLOCK = 4096  # conversation ids joined at a time
_EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_lists(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, turns in order, each with its id in hexadecimal and the bytes of its text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.lpad(F.hex(F.octet_length(role)), 8, "0"), role, text)  # the length keeps role and text apart
    turn = F.col(f"`{turn_col}`").cast("long")
    place = F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"))
    one = F.struct(place.alias("place"), role.alias("role"), F.substring(F.sha2(whole, 256), 1, 2 * WIDTH).alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    rows = convs.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), one.alias("one")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))


def with_shared_heads(lists: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % family, then its own turns after its first h,
    with h = crc32 of c's decimal digits % modulus."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    heads = lists.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, modulus - 1).alias("head"))
    joined = lists.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head_id"), "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _ends(members: DataFrame) -> DataFrame:
    """One row per distinct key: the smallest conv_id, n, and the hash of the conv_ids in ascending order."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        made: list[tuple[str, int, int, str]] = []
        for batch in batches:
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key or len(ids) == _BLOCK:
                    if ids:
                        made.append((key, ids[0], len(ids), ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(i)
            yield rows_of(made, "key_id first n joined")
            made = []
        if ids:
            yield rows_of([(key, ids[0], len(ids), ",".join(map(str, ids)))], "key_id first n joined")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, digest = None, 0, 0, hashlib.sha256()
        made: list[tuple[int, int, str]] = []
        for batch in batches:
            for k, i, m, joined in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if n:
                        made.append((first, n, digest.hexdigest()))
                    key, first, n, digest = k, i, 0, hashlib.sha256()
                digest.update(f",{joined}".encode() if n else joined.encode())
                n += m
            yield rows_of(made, "conv_id n ends")
            made = []
        if n:
            yield rows_of([(first, n, digest.hexdigest())], "conv_id n ends")

    def rows_of(rows: list[tuple], names: str) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names.split())
        types = {"key_id": pa.string(), "joined": pa.string(), "ends": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(c, types.get(name, pa.int64())) for c, name in zip(columns, names.split(), strict=True)], names=names.split())

    order = ["key_id", "conv_id"]
    joined = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = joined.mapInArrow(blocks, "key_id string, first long, n long, joined string")
    return joined.repartition("key_id").sortWithinPartitions("key_id", "first").mapInArrow(hashes, "conv_id long, n long, ends string")


class _Sparse:
    """Up to 4, then up to 16 children: their branch bytes in order, next to them."""

    __slots__ = ("branches", "kids", "room")

    def __init__(self):
        self.branches, self.kids, self.room = bytearray(), [], 4

    def get(self, branch: int):
        i = self.branches.find(branch)
        return self.kids[i] if i >= 0 else None

    def put(self, branch: int, kid):
        i = self.branches.find(branch)
        if i >= 0:
            self.kids[i] = kid
            return self
        if len(self.kids) == self.room:
            if self.room == 16:
                return _Indexed(self.branches, self.kids).put(branch, kid)
            self.room = 16
        i = len(self.branches)
        while i and self.branches[i - 1] > branch:
            i -= 1
        self.branches.insert(i, branch)
        self.kids.insert(i, kid)
        return self

    def items(self):
        return zip(self.branches, self.kids, strict=True)


class _Indexed:
    """Up to 48 children: 256 places that say where a branch byte's child is."""

    __slots__ = ("kids", "places")

    def __init__(self, branches: bytearray, kids: list):
        self.places, self.kids = bytearray(256), list(kids)
        for i, branch in enumerate(branches):
            self.places[branch] = i + 1

    def get(self, branch: int):
        i = self.places[branch]
        return self.kids[i - 1] if i else None

    def put(self, branch: int, kid):
        i = self.places[branch]
        if i:
            self.kids[i - 1] = kid
            return self
        if len(self.kids) == 48:
            return _Direct(self.items()).put(branch, kid)
        self.kids.append(kid)
        self.places[branch] = len(self.kids)
        return self

    def items(self):
        return ((b, self.kids[i - 1]) for b, i in enumerate(self.places) if i)


class _Direct:
    """Up to 256 children, one place for each branch byte."""

    __slots__ = ("kids",)

    def __init__(self, items):
        self.kids = [None] * 256
        for branch, kid in items:
            self.kids[branch] = kid

    def get(self, branch: int):
        return self.kids[branch]

    def put(self, branch: int, kid):
        self.kids[branch] = kid
        return self

    def items(self):
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


class _Node:
    __slots__ = ("kids", "label", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.value, self.kids = label, value, _Sparse()


class RadixTree:
    """An adaptive radix tree from byte strings to values. A key may be the beginning of another."""

    def __init__(self):
        self.root = _Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, at, above = self.root, 0, None
        while True:
            label = node.label
            if not key.startswith(label, at):  # fork inside the label
                part, same = key[at : at + len(label)], 0
                while same < len(part) and part[same] == label[same]:
                    same += 1
                upper = _Node(label[:same])
                above.kids = above.kids.put(label[0], upper)
                node.label = label[same:]
                upper.kids = upper.kids.put(node.label[0], node)
                node = upper
                label = upper.label
            at += len(label)
            if at == len(key):
                node.value = value
                return
            below = node.kids.get(key[at])
            if below is None:
                node.kids = node.kids.put(key[at], _Node(key[at:], value))
                return
            above, node = node, below


class _Below:
    """What lies below a place of the tree: sums over the trie nodes that come next, and those nodes; and a key from there
    with its number of turns and the text sizes of its last turns."""

    __slots__ = ("least", "leaves", "n", "saved", "sample", "tops")

    def __init__(self, n: int = 0, least: int | None = None, leaves: int = 0, saved: int = 0, sample: tuple | None = None):
        self.n, self.least, self.leaves, self.saved, self.sample, self.tops = n, least, leaves, saved, sample, []

    def add(self, other: _Below) -> None:
        self.n += other.n
        if other.least is not None and (self.least is None or other.least < self.least):
            self.least = other.least
        self.leaves += other.leaves
        self.saved += other.saved
        self.tops += other.tops
        self.sample = self.sample or other.sample


class _Run:
    """The trie nodes of one run of sorted keys. A value is (n, least, children, leaves, saved, ends, sizes): conversations
    that end here or in nodes already final below it, sums over those nodes, and the text sizes of the key's last turns."""

    def __init__(self, keys: list[bytes], values: list[tuple], whole: bool):
        tree = RadixTree()
        for key, value in zip(keys, values, strict=True):
            tree.insert(key, (key, *value))
        self.first, self.last, self.whole = keys[0], keys[-1], whole
        self.nodes: list[list] = []  # [key, conv_id, depth, parent, n, children, leaves, saved, ends]
        # nodes of the first key's path, and of the last key's after it leaves the first's: depth -> sums and text size
        self.paths: dict[bool, dict[int, tuple]] = {False: {}, True: {}}
        self._walk(tree.root)

    def _walk(self, root: _Node) -> None:
        """Depth first, children before their parent."""
        stack = [(root, 0, True, True, False)]
        sums = [_Below()]
        while stack:
            node, at, on_first, on_last, seen = stack.pop()
            if seen:
                below = sums.pop()
                sums[-1].add(self._up(node, at, on_first, on_last, below))
                continue
            end = at + len(node.label)
            stack.append((node, at, on_first, on_last, True))
            sums.append(_Below())
            first = self.first[end] if on_first and end < len(self.first) else -1
            last = self.last[end] if on_last and end < len(self.last) else -1
            stack.extend((kid, end, branch == first, branch == last, False) for branch, kid in node.kids.items())

    def _up(self, node: _Node, at: int, on_first: bool, on_last: bool, below: _Below) -> _Below:
        """From what is below the node's end to what is below its start: the trie nodes of its label."""
        end = at + len(node.label)
        value = node.value
        # the places within the label, its start not among them, that lie between two turns; the root has its own
        for place in range(end - end % WIDTH, at, -WIDTH) if end else (0,):
            depth = place // WIDTH
            ends, children, here = None, 0, _Below()
            if value is not None:
                key, n, least, children, leaves, saved, ends, sizes = value
                here, value = _Below(n, least, leaves, saved, (key, depth, sizes)), None
            here.add(below)
            children += len(here.tops)
            key, turns, sizes = here.sample
            # a run that has a key, but not the shorter open key that this size came with, has nothing final there
            text_bytes = 0 if depth == 0 else sizes[depth - 1 - turns] if turns - depth < len(sizes) else None
            if self.whole or not (on_first or on_last):
                here.leaves = here.leaves or 1
                here.saved += (here.n - 1) * text_bytes
                for i in here.tops:
                    self.nodes[i][3] = len(self.nodes)
                here.tops = [len(self.nodes)]
                self.nodes.append([key, here.least, depth, None, here.n, children, here.leaves, here.saved, ends])
            else:  # other runs may have a part of it
                self.paths[not on_first][depth] = (here.n, here.least, children, here.leaves, here.saved, ends, text_bytes)
                for i in here.tops:
                    self.nodes[i][3] = (not on_first, depth)
                here = _Below(sample=here.sample)
            below = here
        return below

    def open_rows(self) -> Iterator[tuple]:
        """The nodes of the two paths that have something of their own, with the text sizes of the turns since the one before."""
        after = min(self.paths[True], default=0)
        shared = [d for d in sorted(self.paths[False]) if d < after]
        for on_last, key, line in (
            (False, self.first, sorted(self.paths[False])),
            (True, self.last, [*shared, *sorted(self.paths[True])]),
        ):
            sizes: list[int] = []
            for depth in line:
                mine = not on_last or depth >= after
                *row, text_bytes = self.paths[on_last and mine][depth]
                if text_bytes is None:
                    sizes = []
                elif depth:
                    sizes.append(text_bytes)
                if row[0] or row[2]:
                    if mine:
                        yield (key[: depth * WIDTH], *row, sizes)
                    sizes = []

    def final_rows(self) -> Iterator[tuple]:
        """(key_id, n, children, leaves, saved, ends, conv_id, depth, parent's conv_id, or else the parent's key_id)"""
        for key, least, depth, parent, n, children, leaves, saved, ends in self.nodes:
            conv, above = None, None
            if isinstance(parent, tuple):
                above = key_id((self.last if parent[0] else self.first)[: parent[1] * WIDTH])
            elif parent is not None:
                conv = self.nodes[parent][1]
            yield key_id(key[: depth * WIDTH]), n, children, leaves, saved, ends, least, depth, conv, above


def key_id(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:WIDTH]


_STEP = pa.schema(
    [("key", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())]
    + [("ends", pa.string()), ("sizes", pa.list_(pa.int64())), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary())]
)
_STEP_SQL = (
    "key binary, n long, least long, children long, leaves long, saved long, ends string, sizes array<bigint>, "
    "conv_id long, depth long, parent_conv_id long, parent_key binary"
)


def _step(rows: DataFrame, run: int, whole: bool) -> DataFrame:
    """Rows with a depth are final nodes, their `key` being the key's id; rows without are keys for the next step."""
    run_bytes = run * 256

    def rows_of(keys: list[bytes], values: list[tuple]) -> Iterator[tuple]:
        made = _Run(keys, values, whole)
        for key, n, children, leaves, saved, ends, *place in made.final_rows():
            yield key, n, None, children, leaves, saved, ends, None, *place
        for row in made.open_rows():
            yield *row, None, None, None, None

    def of_run(keys: list[bytes], values: list[tuple]) -> Iterator[pa.RecordBatch]:
        made = rows_of(keys, values)
        while some := list(islice(made, 16_384)):
            columns = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STEP, strict=True)], schema=_STEP)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        values: list[tuple] = []
        held = 0
        for batch in batches:
            for key, *value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys.append(key)
                values.append(tuple(value))
                held += len(key)
                if not whole and (len(keys) >= run or held >= run_bytes):
                    yield from of_run(keys, values)
                    keys, values, held = [], [], 0
        if keys:
            yield from of_run(keys, values)

    dealt = rows.repartition(1) if whole else rows.repartitionByRange("key")
    return dealt.sortWithinPartitions("key").mapInArrow(build, _STEP_SQL)


def _merged(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("least").alias("least"), *sums, F.max("ends").alias("ends"), F.max("sizes").alias("sizes"))


def prefix_trie(lists: DataFrame, run: int = 32_768) -> DataFrame:
    """One row per node of the trie of the conversations of `lists`, which `turn_lists` and `with_shared_heads` give: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. `run` is the number of keys that a radix
    tree holds at a time; the nodes do not depend on it."""
    key = F.concat_ws("", F.transform("turns", lambda t: t["id"]))
    rows = lists.select("conv_id", F.unhex(key).alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"), F.substring(F.sha2(key, 256), 1, 32).alias("key_id"))
    rows = stored(rows, "conversations")
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    keys = rows.select("conv_id", "key", "sizes").join(_ends(rows), "conv_id").select("key", "n", F.col("conv_id").alias("least"), *none, "ends", "sizes")
    steps: list[DataFrame] = []
    left, whole = None, False
    while not whole:
        made = stored(_step(keys, run, False), "nodes")
        steps.append(made.where("depth is not null"))
        keys = stored(_merged(made.where("depth is null")), "open_keys")
        before, left = left, keys.count()
        whole = left <= run
        if before is not None and left > before / 2:  # nearly all keys are beginnings of each other
            run *= 4
    steps.append(stored(_step(keys, run, True), "top_nodes"))
    nodes = reduce(DataFrame.unionByName, steps)
    # the nodes that were final from the second step on are the parents that were not known before
    parents = reduce(DataFrame.unionByName, steps[1:]).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    known = nodes.where("parent_key is null").withColumn("parent", F.col("parent_conv_id"))
    found = nodes.where("parent_key is not null").join(parents, "parent_key")
    return known.unionByName(found).select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY_SHA256)).alias("ends_sha256"),
    )


def conversation_trie(convs: DataFrame, run: int = 32_768) -> DataFrame:
    """The trie of the rebuilt conversations of a table with conv_id, turn, role and text."""
    return prefix_trie(with_shared_heads(turn_lists(convs)), run)
