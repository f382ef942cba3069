"""Operator 10, quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad. A text is compressed
in pieces with either; (size with bad - size with good) / (their sum) says which it resembles. Texts that repeat themselves
shrink alike with both, so the logarithm of size with good / size goes with it. A logistic curve over the two, fitted to
the training rows, makes this a probability of label 1.

Training takes at most `per_class` labelled documents of each class, those with the smallest hash of their id (documented
bound); half build the dictionaries, the other half fit the curve. Every whole text is scored, in place, by its text only.

Defined results: a null or empty text gets the share of label 1 among all usable label rows; where a class has no
training rows that is the score of all texts, 0.5 without any; several labels of a document count as several;
null labels are ignored; repeated rows are scored row by row; an empty table gives no rows; extra columns are ignored by
`quality_scores` and carried by `accepted_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import logistic, utf8

#: Texts are compressed in pieces of so many bytes, so that the dictionary counts in long texts as in short ones.
PIECE = 1024
_LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float]
    offset: float
    prior: float  # log odds of label 1

    def scores(self, measures: list[tuple[float, float] | None]) -> np.ndarray:
        z = [self.prior if m is None else self.offset + m[0] * self.weights[0] + m[1] * self.weights[1] for m in measures]
        return logistic(np.array(z, float))

    def coders(self) -> list:
        """A compressor for each dictionary; without one, texts score the prior."""
        if not self.good or not self.bad:
            return []
        made = []
        for content in (self.good, self.bad):
            raw = not content.startswith(b"\x37\xa4\x30\xec")
            kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
            d = zstandard.ZstdCompressionDict(content, dict_type=kind)
            params = zstandard.ZstdCompressionParameters.from_level(
                _LEVEL,
                dict_size=len(content),
                source_size=PIECE,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return made


def measure(coders: list, text: bytes | None) -> tuple[float, float] | None:
    """Normalised difference of the compressed sizes, above 0 where the good dictionary fits better, and the log ratio."""
    if not text or not coders:
        return None
    n = max(1, round(len(text) / PIECE))
    cuts = [len(text) * k // n for k in range(n + 1)]
    good, bad = (sum(len(c.compress(text[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)) for c in coders)
    return (bad - good) / (bad + good), float(np.log(good / len(text)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, float], float]:
    """Weights and offset of a logistic regression with a ridge of 1 on standardised columns, by Newton steps."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(50):
        p = logistic(z @ w)
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.eye(3), z.T @ (p - y) + w)
        w -= np.clip(step, -3, 3)
    a, b = w[:2] / spread
    return (float(a), float(b)), float(w[2] - a * mean[0] - b * mean[1])


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the texts themselves."""
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-size:]


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 1200,
    dictionary_bytes: int = 112_640,
) -> Model:
    """`usable`: which label rows may be learned from (a condition on the id column)."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    if usable is not None:
        rows = rows.where(usable)
    picked = None
    for label in (0, 1):
        some = rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    picked = picked.where("length(text) > 0").select(F.xxhash64("id").alias("h"), "id", "label", "text")
    got = [(r["label"], r["text"].encode("utf-8")) for r in sorted(picked.collect())]
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    prior = float(np.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5)))
    if {label for label, _ in got} != {0, 1}:
        return Model(b"", b"", (0.0, 0.0), prior, prior)
    halves: dict[bool, list] = {True: [], False: []}
    seen = {0: 0, 1: 0}
    for label, text in got:
        halves[seen[label] % 2 == 0].append((label, text))
        seen[label] += 1
    fit = halves[False] if {label for label, _ in halves[False]} == {0, 1} else got
    good, bad = (_dictionary([t for label, t in halves[True] if label == k], dictionary_bytes) for k in (1, 0))
    coders = Model(good, bad, (0.0, 0.0), prior, prior).coders()
    x = np.array([measure(coders, t) for _, t in fit])
    y = np.array([label for label, _ in fit], float)
    weights, offset = _curve(x, y)
    # the classes were drawn alike; the shares of all label rows put the offset right
    offset += prior - float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    return Model(good, bad, weights, offset, prior)


def _scored(docs: DataFrame, model: Model, columns: list[Column], text_col: str) -> DataFrame:
    """The columns, and `score` of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*columns, F.col(text_col).alias("text_to_score"))
    n = len(columns)
    schema = rows.schema
    out = type(schema)(schema.fields[:n]).add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        coders = m.coders()
        for batch in batches:
            scores = m.scores([measure(coders, t) for t in utf8(batch.column(n))])
            arrays = [*(batch.column(i) for i in range(n)), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:n], "score"])

    return rows.mapInArrow(score, out)


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    out = _scored(docs, model, [F.col(id_col).cast("long").alias("doc_id")], text_col)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents that score at least the threshold, with all their columns."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    out = _scored(docs, model, columns, text_col).where(F.col("score") >= threshold)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
