"""Rows without ids or with shared ones, keys of low weights, letters, and folders."""

import hashlib
import io
import random
import time
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfline.llm import common, fingerprints, language_id, mixing, repeated_passages, web_archives


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "stone", "river,"]) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.mark.parametrize("hot", [512, 2])
def test_passages_of_rows_that_share_an_id(spark, hot):
    rng = random.Random(11)
    first, second = words(rng, 70), words(rng, 60)
    rows = [(None, first + " " + words(rng, 5)), (None, words(rng, 9) + " " + first), (None, second), (None, words(rng, 100) + " " + second), (None, words(rng, 200)), (None, None)]
    rows += [(4, words(rng, 30) + " " + first), (4, second + " " + words(rng, 3)), (4, words(rng, 90)), (5, second + " x"), (6, words(rng, 80))]
    seen = defaultdict(set)
    for i, t in rows:
        w = (t or "").split()
        for p in range(len(w) - 49):
            seen[tuple(w[p : p + 50])].add((i, t, p))
    spans = defaultdict(list)
    for i, t, p in sorted({x for at in seen.values() if len(at) > 1 for x in at}, key=lambda x: (str(x[0]), x[1], x[2])):
        if spans[i, t] and p <= spans[i, t][-1][1]:
            spans[i, t][-1][1] = p + 50
        else:
            spans[i, t].append([p, p + 50])
    want = sorted((str(i), [tuple(s) for s in found]) for (i, _), found in spans.items())
    got = repeated_passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), hot=hot).collect()
    assert sorted((str(r.doc_id), [tuple(p) for p in r.passages]) for r in got) == want


def test_documents_of_low_weight_are_taken_by_their_keys(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(1, 9)), "ab"[i % 7 == 0]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 3 == 0, 0.05).otherwise(0.9)
    key = mixing._key(F.col("doc_id"), F.col("text"), weight, 7)
    keys = {r.doc_id: r.key for r in docs.select("doc_id", key.alias("key")).collect()}
    assert len(set(keys.values())) == len(keys)
    ranges = docs.select(F.struct(key.alias("key")).alias("place")).groupBy(mixing._bucket(512)).count()
    assert ranges.agg(F.max("count")).first()[0] < len(rows) / 100
    by_source = defaultdict(list)
    got = mixing.mix_decisions(docs, weight=weight, share=0.5).collect()
    for r in got:
        by_source[r.source].append(r)
    for found in by_source.values():
        found.sort(key=lambda r: keys[r.doc_id])
        taken, want = 0, []
        for r in found:
            if taken + r.size / 2 > r.target:
                break
            taken += r.size
            want.append(r.doc_id)
        assert sorted(want) == sorted(r.doc_id for r in found if r.copies)
    low = [r.copies for r in got if r.doc_id % 3 == 0]
    high = [r.copies for r in got if r.doc_id % 3]
    assert sum(low) / len(low) < sum(high) / len(high) / 2


def test_fingerprints_of_rows_without_ids(spark):
    """Blocks also part the documents that have no id, or one id."""
    rng = random.Random(3)
    rows = [(None if i % 3 else 7, words(rng, rng.randint(0, 30))) for i in range(300)] + [(8, "a b"), (8, "a b"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("own", F.xxhash64("text")).collect()
    ordered = sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.own, r.text))
    want = []
    for r, following in zip(ordered, [*ordered[1:], ordered[0]]):
        changed = fingerprints.edited(r.text, following.text)
        want.append((str(r.doc_id), len(r.text), hashlib.sha256(changed.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256) for r in fingerprints.fingerprints(docs, blocks=40).collect()]
    assert sorted(got) == sorted(want)
    least = -(2**63)
    keys = docs.select(F.coalesce("doc_id", F.lit(least)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"))
    assert len({key for key in fingerprints._borders(keys, 40) if key[0] == least}) > 10


def test_numbers_are_no_letters(spark):
    assert [language_id.has_letter(t) for t in ("²", "½ 12", "_", "", "12 a", "ª", "日", "Ⅷ")] == [False, False, False, False, True, True, True, False]
    odd = spark.createDataFrame([(1, "²"), (2, "½ 12"), (3, "a" * 100_000)], "doc_id long, text string")
    train = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the and", "en"), ("der und", "de")] * 20)], "doc_id long, text string, lang string")
    got = language_id.predict_languages(odd, language_id.train(train)).collect()
    assert [(r.doc_id, r.lang_pred == "und") for r in sorted(got)] == [(1, True), (2, True), (3, False)]


@pytest.mark.parametrize("packed", [True, False])
def test_long_and_many_small_records(packed):
    rng = random.Random(1)
    bodies = [rng.randbytes(30_000_000), *[rng.randbytes(rng.randint(0, 300)) for _ in range(5000)], rng.randbytes(3_000_000)]
    made = [web_archives.arc_version_block(1, "f.arc", "20010203040506")]
    made += [web_archives.arc_record(1, f"http://h/{i}", "20010203", b) for i, b in enumerate(bodies)]
    data = b"".join(web_archives._member(m) if packed else m for m in made)
    began = time.process_time()
    assert [c for _, c, _ in web_archives.parse_arc(io.BytesIO(data))] == bodies
    assert time.process_time() - began < 10


def test_folder_without_a_setting():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master=master))

    one, two = (common.workspace(session("local[2]")) for _ in range(2))
    assert one != two and one.rpartition("/")[0] == two.rpartition("/")[0]
    with pytest.raises(ValueError, match="checkpoint"):
        common.workspace(session("spark://host:7077"))
