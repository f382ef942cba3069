"""The corpus operators against brute force, on small tables with nulls, ties, repeated rows and clashing columns."""

import base64
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import (
    exact_dedup,
    fingerprints,
    language_id,
    minhash_dedup,
    mixing,
    quality_classifier,
    repeated_passages,
    sentence_pieces,
    token_counts,
    web_archives,
)
from shelfline.llm.common import WordHashes, crc_mod, split_words, tokenizer_path
from shelfline.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, row string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Ander", "stone", "river,", "ling.", "éau", "wh"]) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = words(rng, 120)
    out = [(i, words(rng, rng.randint(0, 80))) for i in range(1, 40)]
    out += [(i, base) for i in range(50, 60)]
    for i in range(60, 90):  # near copies of one text
        w = base.split()
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 999)}"
        out.append((i, " ".join(w)))
    out += [(90, words(rng, 30) + " " + " ".join(base.split()[20:75]) + " " + words(rng, 30))]
    out += [(100, None), (101, ""), (102, "   \n"), (103, "one"), (104, "One"), (105, "x" * 9000), (106, words(rng, 6000)), (None, base), (110, "same id"), (110, "same id")]
    return [(i, t, None if k % 11 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", None, "clash", None) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(rows):
    return [(r[0], r[1] or "") for r in rows]


def test_token_counts(docs, empty, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = sorted(map(tuple, token_counts.token_counts(docs, path, frequent=50, cache=100).collect()), key=str)
    lengths = [(i, len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for i, x in texts(rows)]
    assert got == sorted(((i, b, n, n > 2048) for i, b, n in lengths), key=str)
    assert token_counts.token_counts(empty, path).count() == 0


def test_frequent_pretokens_are_counted_in_all_documents(spark, monkeypatch):
    """Also those that no task meets twice, in many documents, and where a task hands its counts over often."""
    rng = random.Random(8)
    some = [f"n{i} w{int(rng.paretovariate(0.7))}" for i in range(6000)] + [None, "", "x" * 65 + " " + "x" * 65]
    some += [f"once{k}" for _ in range(4) for k in range(40)]
    docs = spark.createDataFrame([(t,) for t in some], "text string").repartition(8)
    counted = Counter(p for t in some for p in (t or "").encode().split() if len(p) <= 64)
    ordered = sorted((p for p in counted if counted[p] > 1), key=lambda p: (-counted[p], p))
    for bound in (200_000, 7):
        monkeypatch.setattr(token_counts, "_COUNTED", bound)
        for most in (1, 30, 100_000):
            rest = {counted[p] for p in ordered[most:]}
            want = [p for p in ordered[:most] if counted[p] not in rest]
            assert token_counts.frequent_pretokens(docs, "text", most) == want
            assert len(want) == most if most == 1 else len(want) > 15


def test_token_counts_odd_characters(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(3)
    alphabet = "ab AZ's\t\n\v\f\r\x1c\x85\xa0 ééΣσςİK 12.,日本<|endoftext|>😀'll"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["a<|endoftext|>b <|startoftext|>"]
    got = token_counts.token_counts(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(some)}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string")


def test_web_archives(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 5 == 0 else f"http://a/{i} ü\n", rng.choice([None, "", "x", "<p>é\r\n\r\nWARC/1.1\r\n", "long" * 5000]), "x") for i in range(1, 60)]
    rows += [(7, "http://a/7", "again", "x"), (7, "http://a/7", "again", "x"), (None, "http://b", "x", "x")]
    got = web_archives.archive_pages(pages(spark, rows)).collect()
    payloads = [(i, (t or "").encode()) for i, _, t, _ in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    have = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got)
    want, done = [], set()
    for i, p in sorted(payloads, key=lambda r: (r[0] is None, r[0] or 0)):
        new = i is None or (first[p] == i and p not in done)
        done |= {p} if i is not None else set()
        want.append((str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if new else "revisit", "None" if new else str(first[p])))
    assert have == sorted(want)
    assert web_archives.archive_pages(pages(spark, [])).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [True, False])
def test_arc_records(version, packed):
    made = [web_archives.arc_version_block(version, "f.arc", "20010203040506")]
    bodies = [web_archives.http_response(i, b"\n" * i + b"http://x 1 2 3 4\n") for i in range(30)] + [b"plain"]
    made += [web_archives.arc_record(version, f"http://h/{i}", "20010203", b) for i, b in enumerate(bodies)]
    data = b"".join(web_archives._member(m) if packed else m for m in made)
    got = list(web_archives.parse_arc(io.BytesIO(data)))
    assert [c for _, c, _ in got] == bodies
    warc = b"".join(web_archives.convert_record(h, c) for h, c, _ in got)
    back = list(web_archives.parse_warc(io.BytesIO(warc)))
    assert [b for _, b in back] == bodies
    assert back[0][0]["warc-date"] == "2001-02-03T00:00:00Z" and back[-1][0]["warc-type"] == "resource"


@pytest.mark.parametrize("key", [0, 1, -1, 2**63 - 1, -(2**63), 12345678901])
def test_record_ids_hold_the_key(key):
    assert web_archives.key_of_id(web_archives.record_id(key, web_archives.sha1_base32(b"x"))) == key


def brute_components(rows, size, percent=80):
    sets = {}
    for i, t in texts(rows):
        w = t.encode().lower().split()
        k = min(size, len(w))
        sets[i] = frozenset(tuple(w[p : p + k]) for p in range(len(w) - k + 1)) if w else frozenset()
    root = {i: i for i in sets if i is not None}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in combinations(sorted(root), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), None if i is None else find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size,tile", [(2, 256), (5, 256), (2, 4)])
def test_near_duplicates(docs, empty, rows, size, tile):
    got = minhash_dedup.near_duplicates(docs, words=size, tile=tile).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_one_of_each_group_keeps_rows_whole(docs, rows):
    kept = minhash_dedup.one_of_each_group(docs, words=2)
    assert kept.columns == docs.columns
    want = {i for i, (_, c) in brute_components(rows, 2).items() if i == c}
    assert {r.doc_id for r in kept.collect()} == want | {None}


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 99), rng.randint(0, 99)) for _ in range(60)] + [(500, k) for k in range(501, 560)]
    root = {x: x for e in edges for x in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(a != b and x in (a, b) for a, b in edges)}


def test_min_max_values_agree_as_often_as_sets():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**62, 900).astype(np.uint64))
    b = np.unique(np.concatenate([a[:600], rng.integers(0, 2**62, 300).astype(np.uint64)]))
    agree = (minhash_dedup.min_max_signature(a) == minhash_dedup.min_max_signature(b)).mean()
    assert abs(agree - 0.5) < 0.12


def test_fingerprints(docs, empty, rows):
    got = {(r.doc_id, r.edited_sha256): r for r in fingerprints.fingerprints(docs, blocks=5).collect()}
    ordered = sorted(texts(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    make = fingerprints.Sketcher()
    want = {}
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        e = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        want[i, hashlib.sha256(e.encode()).hexdigest()] = (len(t), fingerprints.likeness(make(t), make(e)), fingerprints.likeness(make(t), make(nxt)), fingerprints.packed(make(t)))
    assert {k: (r.n_chars, r.near_edited, r.near_next, r.fingerprint) for k, r in got.items()} == want
    assert fingerprints.fingerprints(empty).count() == 0
    one = fingerprints.fingerprints(docs.where("doc_id = 103")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_likeness_is_without_bias():
    rng = np.random.default_rng(4)
    off = []
    for n in (40, 300, 3000):
        a = rng.integers(0, 2**62, n).astype(np.uint64)
        b = np.concatenate([a[: 2 * n // 3], rng.integers(0, 2**62, n - 2 * n // 3).astype(np.uint64)])
        off.append(fingerprints.likeness(fingerprints.sketch(a), fingerprints.sketch(b)) - 0.5)
    assert max(map(abs, off)) < 0.2 and abs(off[-1]) < 0.08
    assert fingerprints.unpacked(fingerprints.packed(fingerprints.sketch(a))).tolist() == fingerprints.sketch(a).tolist()


def brute_passages(rows, least):
    seen = defaultdict(list)
    for k, (i, t) in enumerate(texts(rows)):
        w = t.encode().lower().split()
        for p in range(len(w) - least + 1):
            seen[tuple(w[p : p + least])].append((i, p))
    out = defaultdict(list)
    for i, p in sorted({x for at in seen.values() if len(at) > 1 for x in at}, key=lambda x: (x[0] is None, x)):
        if out[i] and p <= out[i][-1][1]:
            out[i][-1][1] = p + least
        else:
            out[i].append([p, p + least])
    return {i: [tuple(x) for x in s] for i, s in out.items()}


@pytest.mark.parametrize("least,hot", [(50, 512), (20, 512), (50, 3)])
def test_repeated_passages(docs, empty, rows, least, hot):
    got = repeated_passages.repeated_passages(docs, least=least, hot=hot).collect()
    have = {r.doc_id: [tuple(p) for p in r.passages] for r in got}
    want = brute_passages(rows, least)
    assert set(have) == set(want)
    if hot == 512:
        assert have == want
    assert repeated_passages.repeated_passages(empty).count() == 0


def test_hot_windows(spark, docs, rows):
    """Above `hot` every span is found as well, also of passages that end in a line which many documents have."""
    rng, known = random.Random(8), WordHashes()
    # a line that is the minimiser of nearly every stretch with it
    line = next(t for t in (words(rng, 8) for _ in range(10**6)) if repeated_passages._grams(known.of(split_words(t.encode())))[0] < 2**53)
    ended = [words(rng, 42) + " " + line for _ in range(30)]
    more = [(k, words(rng, 60) + " " + line + " " + words(rng, 50)) for k in range(200, 300)]
    more += [(k, words(rng, 20 + k % 40) + " " + ended[k % 30] + " " + words(rng, 50)) for k in range(300, 360)]
    more = [(i, t, None, None, None, None, None) for i, t in more]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for table, all_rows in ((spark.createDataFrame(more, SCHEMA), more), (docs, rows)):
            got = repeated_passages.repeated_passages(table, hot=3).collect()
            assert {r.doc_id: [tuple(p) for p in r.passages] for r in got} == brute_passages(all_rows, 50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_blocks_keep_what_begins_alike():
    rows = [(g, k) for g, n in ((1, 3), (2, 70), (3, 1), (4, 9), (5, 12)) for k in range(n)]
    blocks = list(repeated_passages._blocks(iter(rows), 10))
    assert [r for b in blocks for r in b] == rows
    assert [{g for g, _ in b} for b in blocks] == [{1, 2}, {3, 4}, {5}]
    assert list(repeated_passages._blocks(iter([]), 10)) == []


def test_window_hashes():
    rng = np.random.default_rng(1)
    for least in (16, 17, 50, 63, 64):
        few = rng.integers(0, 2, 400).astype(np.uint64)
        few[200:300] = few[50:150]
        got = repeated_passages._window_hashes(few, least)
        runs = [tuple(few[p : p + least]) for p in range(len(few) - least + 1)]
        assert len(got) == len(runs) and len(set(zip(runs, got.tolist()))) == len(set(runs)) == len(set(got.tolist()))


def test_sentence_pieces_match_the_library(docs, empty, rows):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = sentence_pieces.encode_documents(docs, path)
    got = sorted(((str(r.doc_id), list(r.ids), r.text) for r in sentence_pieces.decode_documents(encoded, path).collect()), key=str)
    assert got == sorted(((str(i), library.encode(t), t) for i, t in texts(rows)), key=str)
    assert sentence_pieces.encode_documents(empty, path).count() == 0


def test_pieces_of_odd_texts():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        encoder = sentence_pieces.Encoder(sentence_pieces.Pieces(f.read()), remembered=500)
    rng = random.Random(1)
    alphabet = "  ab ▁cé\n\tth e in日本ﬁ<s>12..́😀aaaa  of the ,;"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    some += [" " * 40, "a" * 3000, "".join(rng.choice("abcdefgh") for _ in range(4000))]
    assert [np.frombuffer(b, np.int32).tolist() for b in encoder.encode(some)] == library.encode(some)


def test_unigram_segmentation():
    def field(number, kind, data):
        head = bytes([number << 3 | kind])
        return head + (bytes([len(data)]) + data if kind == 2 else data)

    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "aba": -4.0, "▁a": -3.5, "bb": -4.2, "▁ab": -5.0}
    model = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, np.float32(s).tobytes())) for p, s in [("<unk>", 0.0), *scores.items()])
    pieces = sentence_pieces.Pieces(model + field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(2, 2, b"") + field(4, 0, b"\x00")))
    encoder = sentence_pieces.Encoder(pieces)
    rng = random.Random(0)
    for _ in range(60):
        text = "".join(rng.choice("ab▁") for _ in range(rng.randint(1, 60)))
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            best[end] = max(best[end - len(p)] + s for p, s in scores.items() if text[:end].endswith(p))
        path = [i for part in encoder.stream(text) for i in part]
        assert "".join(pieces.names[i] for i in path) == text
        assert abs(sum(scores[pieces.names[i]] for i in path) - best[len(text)]) < 1e-3


def test_mix(docs, empty, rows):
    got = mixing.mix_decisions(docs, buckets=8).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_decisions(docs.repartition(5), buckets=8).collect()))
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(r.size for r in by_source[s]) for s in order}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in over} if over else {s: level * weight[s] for s in free}
        left -= sum(2 * sizes[s] for s in over)
        free = free - over if over else set()
    for s, rs in by_source.items():
        assert rs[0].target == pytest.approx(target[s]) and rs[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in rs) - target[s]) <= max(r.size for r in rs) / 2 + 1e-6
        assert all(0 <= r.taken <= 2 * r.size for r in rs)
    assert mixing.mix_decisions(empty).count() == 0
    mixed = mixing.mixed_documents(docs, buckets=8)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_languages(spark, empty):
    rng = random.Random(9)
    sound = {"en": ["the", "and", "wh", "ing", "th"], "de": ["der", "sch", "ung", "ei", "ß"], "fr": ["eau", "oi", "les", "é", "que"], "es": ["ción", "de", "ñ", "os", "la"]}
    rows = [(i, " ".join("".join(rng.choices(sound[lang], k=3)) for _ in range(rng.randint(3, 60))), lang) for i, lang in enumerate(list(sound) * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df, usable=crc_mod(F.col("id"), 3) != 1)
    got = {r.doc_id: r for r in language_id.predict_languages(df, model).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (None, "the thing")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.lang_pred, r.score == 0) for r in language_id.predict_languages(odd, model).collect()) == [("1", "und", True), ("2", "und", True), ("3", "und", True), ("None", "en", False)]
    assert language_id.train(empty) is None
    assert [r.lang_pred for r in language_id.predict_languages(odd, None).collect()] == ["und"] * 4


@pytest.mark.parametrize("digest", [exact_dedup._sha256, lambda text: F.length(text).cast("string")])
def test_exact_dedup(docs, empty, rows, digest):
    got = exact_dedup.exact_dedup(docs, digest=digest, salts=3).collect()
    groups = defaultdict(list)
    for i, t in texts(rows):
        groups[t].append(i)
    want = []
    for i, t in texts(rows):
        best = max((x for x in groups[t] if x is not None), default=None)
        want.append((i, best, len(groups[t]), i == best, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.distinct_documents(docs, digest=digest, salts=3)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((max(x for x in ids if x is not None), t) for t, ids in groups.items())


def test_quality(spark, docs, empty):
    rng = random.Random(4)
    bad = [lambda: " ".join(words(rng, 30).upper().replace(" ", "!! ").split()), lambda: " ".join([rng.choice(["aa", "bee"])] * 90), lambda: words(rng, 40).replace(" ", " | ")]
    rows = [(i, bad[i % 3]() if i % 4 == 0 else words(rng, rng.randint(20, 80)), int(i % 4 != 0)) for i in range(600)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5000, None)], "doc_id long, quality int")
    model = quality_classifier.train(df, labels, usable=crc_mod(F.col("id"), 5) != 0)
    got = {r.doc_id: r for r in quality_classifier.quality_scores(df, model).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == q for i, q in held) / len(held) > 0.9
    whole = quality_classifier.quality_scores(docs, model).collect()
    assert len(whole) == docs.count() and all(0 <= r.score <= 1 for r in whole)
    assert quality_classifier.quality_scores(empty, model).count() == 0
    kept = quality_classifier.accepted_documents(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    lone = quality_classifier.train(df, labels.where("quality = 1"))
    assert all(r.score > 0.9 for r in quality_classifier.quality_scores(df, lone).collect())
    none = quality_classifier.train(df, labels.limit(0))
    assert {r.score for r in quality_classifier.quality_scores(df, none).collect()} == {0.5}


def test_pipeline_stages(spark, docs, empty, tmp_path):
    spark.createDataFrame([(i, int(i % 2)) for i in range(1, 40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, empty):
        now, columns = start, start.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, str(tmp_path)).write.parquet(out := f"{tmp_path}/{start is docs}-{k}")
            now = spark.read.parquet(out)
            assert k == len(corpus_pipeline.STAGES) - 1 or now.columns == columns, name
        assert now.columns == ["doc_id", "source", "n_tokens", "ids"]
        assert (now.count() > 0) == (start is docs)
