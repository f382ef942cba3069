"""The prefix trie against brute force over lists of turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode()):08X}{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * size + sum(saved[k] for k in children[path])
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), parent, len(m), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed, n, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 6 * n), n):
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, t, t, None, 0]), rng.choice(["user", "user", None]), rng.choice([*words, None, ""])))
    rows += [(None, 0, "user", "nobody")] * 3 + rows[:5]
    deep = [(5000, t, "user", f"t{t}") for t in range(60)]
    return rows + deep + [(5000 + k, t, "user", f"t{t}") for k in (1, 2, 3, 6, 7) for t in range(50 + k)]


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize(("seed", "words", "run"), [(1, "ab", 3), (2, ["a", "é", "long text " * 9], 1), (3, [f"w{i}" for i in range(40)], 5), (4, "abc", 1000)])
def test_nodes(spark, seed, words, run):
    rows = some_rows(seed, 60, words)
    convs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert result(prefix_trie.conversation_trie(convs, run=run)) == brute(rows)


def test_one_beginning_for_all(spark, monkeypatch):
    """A first turn that all share, many equal conversations, blocks of few ids."""
    monkeypatch.setattr(prefix_trie, "_BLOCK", 4)
    rng = random.Random(7)
    rows = [(c, t, "user", "same" if t < 2 else f"{t}{rng.randint(0, 2)}") for c in range(0, 600, 5) for t in range(rng.randint(1, 4))]
    convs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(4)
    assert result(prefix_trie.conversation_trie(convs, run=6)) == brute(rows)


def test_edges(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(7, None, None, None)]  # only turns that the head would replace
    rows += [(c, 0, "u", "x") for c in (11, 12, 13, 14)]
    assert result(prefix_trie.conversation_trie(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA))) == brute(rows)


def test_layouts_grow():
    rng = random.Random(3)
    for n in (3, 5, 17, 49, 256):
        tree, want = prefix_trie.RadixTree(), {}
        for b in rng.sample(range(256), n):
            key = b"ab" + bytes([b]) + bytes(rng.choices(range(3), k=rng.randint(0, 3)))
            want[key] = b
            tree.insert(key, b)
        want[b"a"] = -1
        tree.insert(b"a", -1)
        found, stack = {}, [(tree.root, b"")]
        while stack:
            node, path = stack.pop()
            path += node.label
            if node.value is not None:
                found[path] = node.value
            branches = [b for b, _ in node.kids.items()]
            assert branches == sorted(branches)
            for b, kid in node.kids.items():
                assert node.kids.get(b) is kid and kid.label[0] == b
                stack.append((kid, path))
        assert found == want
