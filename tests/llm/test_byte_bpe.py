"""Byte-level BPE against the tokenizer library: ids, round trips, nulls, long and odd texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import byte_bpe
from shelfline.llm.common import token_pattern, tokenizer_path

MODELS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def library(name):
    import tiktoken

    with open(tokenizer_path(name), "rb") as f:
        data = f.read()
    ranks = byte_bpe.read_ranks(data)
    return data, tiktoken.Encoding("own", pat_str=token_pattern(), mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(4)
    alphabet = "ab AZ's\t\n\v\f\r\x1c\x85\xa0  ééΣσςİK 12.,日本<|endoftext|>😀'll"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["".join(rng.choice("aaab=-_ \n") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    out += [c * n for c in "a x=-\n*日" for n in (1, 2, 3, 5, 17, 999)]
    out += ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x11000, 64)]
    return [*out, "<|endoftext|>", "", "x" * 20_000, " ".join("word" + str(i % 77) for i in range(30_000))]


@pytest.mark.parametrize("name", MODELS)
def test_ids_are_the_library_s(name):
    data, ref = library(name)
    encoder = byte_bpe.Encoder(data, token_pattern())
    some = odd_texts()
    made = encoder.encode(some)
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [ref.encode_ordinary(t) for t in some]
    assert encoder.decode(made) == [t.encode() for t in some]


def test_merges_one_by_one_and_together():
    """Models whose merges come back to earlier ranks: runs must not be merged at once there."""
    rng = random.Random(9)
    for _ in range(150):
        tokens = [bytes([b]) for b in range(256)]
        extra = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(rng.randint(3, 25))}
        order = sorted(extra)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(tokens + order)}
        pairs = byte_bpe.PairTable(ranks)
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))).encode() for _ in range(40)]

        def brute(raw):
            parts = [bytes([b]) for b in raw]
            while True:
                found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not found:
                    return [ranks[p] for p in parts]
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]

        lengths = np.array([len(w) for w in words])
        padded = np.zeros((len(words), lengths.max()), np.int32)
        for i, w in enumerate(words):
            padded[i, : len(w)] = list(w)
        got = {}
        for rows, counts, ids in byte_bpe.merge_rows(pairs, padded, lengths):
            for row, part in zip(rows.tolist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                got[row] = part.tolist()
        assert [got[i] for i in range(len(words))] == [brute(w) for w in words]


def test_frames(spark):
    path = tokenizer_path(MODELS[0])
    _, ref = library(MODELS[0])
    rows = [(1, "Hello  world\n", "a", None), (2, None, "b", 1), (None, "no id", None, 2), (1, "Hello  world\n", "a", None), (3, "", "c", 3), (4, "é" * 300, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, packed string, `kept_0` long")
    encoded = byte_bpe.encode_documents(docs, path, token_pattern(), keep=("kept_0",))
    assert encoded.columns == ["doc_id", "kept_0", "n_tokens", "packed"]
    decoded = byte_bpe.decode_documents(encoded, path, token_pattern()).withColumn("ids", byte_bpe.unpacked_ids())
    got = sorted(((r.doc_id, r.n_tokens, tuple(r.ids), bytes(r.decoded)) for r in decoded.collect()), key=str)
    want = [(i, len(ref.encode_ordinary(t or "")), tuple(ref.encode_ordinary(t or "")), (t or "").encode()) for i, t, _, _ in rows]
    assert got == sorted(want, key=str)
    nulls = encoded.withColumn("packed", F.lit(None).cast("binary"))
    assert all(r.decoded is None for r in byte_bpe.decode_documents(nulls, path, token_pattern()).collect())
    assert byte_bpe.encode_documents(docs.limit(0), path, token_pattern()).count() == 0
