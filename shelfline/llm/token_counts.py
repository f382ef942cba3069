"""Operator 1, token counts by a map-side two-tier lookup.

A pre-token is a run of bytes between ASCII white space. The tokenizers meant here drop white space, and none of their
tokens or merges reaches across it, so a text has as many tokens as its pre-tokens have together. Tier one is a broadcast
table of frequent pre-tokens and their lengths (at most `frequent` entries of at most 64 bytes); tier two is a bounded
cache in each Python worker, filled by the tokenizer itself. No text is shuffled: texts are counted where they are read.

The table of frequent pre-tokens saves work and changes no result. All documents are counted for it: each task hands over how
often it has met each pre-token, whenever it has met _COUNTED different ones, and these counts are added up.

Defined results: a null or empty text has 0 bytes and 0 tokens; a text without white space is one pre-token and goes to the
tokenizer whole; repeated rows and ids are counted row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, utf8

_LONGEST = 64
# So many different pre-tokens a task counts before it hands the counts over.
_COUNTED = 200_000


def _tokenizer(model: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(model)
    t.no_truncation()
    t.no_padding()
    return t


def _lengths(tokenizer, words: list[bytes]) -> list[int]:
    texts = [w.decode("utf-8", "replace") for w in words]
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def frequent_pretokens(docs: DataFrame, text_col: str, most: int) -> list[bytes]:
    """At most the `most` most frequent pre-tokens of all documents, of those with at most _LONGEST bytes that occur twice or more.
    Equally frequent ones are all among them or none, so that the driver gets no more than that."""
    out = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def handed_over(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], schema=out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                seen.update([p for p in text.split() if len(p) <= _LONGEST] if text else ())
                if len(seen) >= _COUNTED:
                    yield handed_over(seen)
                    seen.clear()
        yield handed_over(seen)

    met = docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(met.where("n > 1"), "pretoken_counts")
    room, least = most, None
    for n, words in counts.groupBy("n").count().orderBy(F.desc("n")).limit(most).collect():
        if words > room:
            break
        room, least = room - words, n
    if least is None:
        return []
    found = counts.where(F.col("n") >= least).collect()  # at most `most`
    return [bytes(r["word"]) for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    frequent: int = 16_384,
    cache: int = 300_000,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    `model_path` names a tokenizers file that drops white space and whose merges stay between white spaces.
    """
    spark = docs.sparkSession
    with open(model_path, encoding="utf-8") as f:
        model = f.read()
    words = frequent_pretokens(docs, text_col, frequent)
    table = dict(zip(words, _lengths(_tokenizer(model), words), strict=True))
    shared = spark.sparkContext.broadcast((model, table))
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, first = shared.value
        tokenizer = _tokenizer(model)
        known = dict(first)  # both tiers under one lookup; the second is emptied when full
        for batch in batches:
            sizes, tokens = [], []
            for text in utf8(batch.column(1)):
                parts = text.split() if text else []
                try:
                    n = sum(map(known.__getitem__, parts))
                except KeyError:
                    missing = list({p for p in parts if p not in known})
                    if len(known) + len(missing) > len(first) + cache:
                        known = dict(first)
                        missing = list({p for p in parts if p not in known})
                    lengths = dict(zip(missing, _lengths(tokenizer, missing), strict=True))
                    known.update((p, k) for p, k in lengths.items() if len(p) <= _LONGEST)
                    n = sum(known[p] if p in known else lengths[p] for p in parts)
                sizes.append(len(text) if text else 0)
                tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                schema=out,
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
