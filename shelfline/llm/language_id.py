"""Operator 8, language identification by hierarchical discrimination.

A text is first given to a language family, then to a language of that family. Both steps take one-versus-one linear
support vector machines over hashed byte trigrams (square roots of their shares, so that length does not matter), each
with a logistic curve over its margin. The score is the probability of the family times that of the language within it.

Training takes about `sample` documents in all, in equal parts from each language (documented bound), drawn by a hash of
the id; every whole text is classified in place, by its text only.

Defined results: a null text, or one without a letter, is `und` with score 0, as is every text where nothing can be
learned; a language with no known family is a family of its own; with one language all texts with a letter get it, score 1;
ties go to the class that is first by name; very long texts are read whole, in memory of their size; repeated rows are
classified row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import fit_platt, logistic, utf8

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "semitic": "am ar he mt",
    "sinitic": "zh",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg mi ms su tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_BUCKETS = 4096
#: ASCII bytes that are no letters become spaces.
_PLAIN = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def has_letter(text: str) -> bool:
    """Whether a character is of category L; numbers such as ² and ½ are not."""
    return any(map(str.isalpha, text))


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, case folded."""
    folded = b" " + text.decode("utf-8", "replace").lower().encode("utf-8") + b" "
    b = _PLAIN[np.frombuffer(folded, np.uint8)]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    code = code[code != 0x202020]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
    counts = np.bincount(code, minlength=_BUCKETS).astype(np.float32)
    return np.sqrt(counts / max(len(code), 1))


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighed alike, by accelerated gradient steps. y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    rate = 1 / (1 / cost + 2 * 2.0)  # rows have length at most the root of 2
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - rate * (ahead / cost - 2 * ((weight * y * slack) @ x))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Vote:
    """One-versus-one machines between `classes`; the columns of `weights` are the pairs in order."""

    classes: tuple[str, ...]
    weights: np.ndarray
    offsets: np.ndarray
    curves: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Row by row the classes' shares of the pairwise probabilities."""
        if len(self.classes) == 1:
            return np.ones((len(x), 1))
        p = logistic((x @ self.weights + self.offsets) * self.curves[:, 0] + self.curves[:, 1])
        out = np.zeros((len(x), len(self.classes)))
        for k, (i, j) in enumerate(combinations(range(len(self.classes)), 2)):
            out[:, i] += p[:, k]
            out[:, j] += 1 - p[:, k]
        return out / len(self.curves)


def fit_vote(x: np.ndarray, names: np.ndarray) -> Vote:
    classes = tuple(sorted(set(names)))
    weights, offsets, curves = [], [], []
    for a, b in combinations(classes, 2):
        rows = (names == a) | (names == b)
        y = np.where(names[rows] == a, 1.0, -1.0).astype(np.float32)
        w, c = fit_svm(x[rows], y)
        weights.append(w)
        offsets.append(c)
        curves.append(fit_platt(x[rows] @ w + c, (y > 0).astype(float)))
    return Vote(classes, np.array(weights).T if weights else np.zeros((_BUCKETS, 0)), np.array(offsets), np.array(curves).reshape(-1, 2))


@dataclass(frozen=True)
class Model:
    families: Vote
    within: dict[str, Vote]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        shares = self.families.shares(x)
        best = shares.argmax(1)
        langs, scores = np.empty(len(x), object), np.zeros(len(x))
        for f in np.unique(best):
            rows = best == f
            vote = self.within[self.families.classes[f]]
            inner = vote.shares(x[rows])
            pick = inner.argmax(1)
            langs[rows] = np.array(vote.classes, object)[pick]
            scores[rows] = shares[rows, f] * inner[np.arange(len(pick)), pick]
        return list(langs), scores


def train(
    docs: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = 3000,
) -> Model | None:
    """A model of the languages in `lang_col`; `usable` says which rows may be learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), (F.lit(True) if usable is None else usable).alias("ok"))
    rows = rows.where("ok and lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(2, sample // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(draw < share[F.col("lang")]).select("lang", "text").where(F.col("text").rlike(r"\p{L}"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = [features(t).tobytes() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(v, pa.binary())], names=["lang", "v"])

    got = sorted((r["lang"], bytes(r["v"])) for r in picked.mapInArrow(vectors, "lang string, v binary").collect())
    if not got:
        return None
    names = np.array([lang for lang, _ in got], object)
    x = np.frombuffer(b"".join(v for _, v in got), np.float32).reshape(len(got), _BUCKETS)
    groups = np.array([family(lang) for lang in names], object)
    by_family: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(names), bool))
    for f in set(groups):
        by_family[f] = groups == f
    return Model(fit_vote(x, groups), {f: fit_vote(x[rows], names[rows]) for f, rows in by_family.items()})


def predict_languages(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = utf8(batch.column(1))
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            if m is not None:
                known = [i for i, t in enumerate(texts) if t and has_letter(t.decode("utf-8", "replace"))]
                for at in range(0, len(known), 256):
                    some = known[at : at + 256]
                    got, p = m.predict(np.stack([features(texts[i]) for i in some]))
                    scores[some] = p
                    for i, lang in zip(some, got, strict=True):
                        langs[i] = lang
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        predict, "doc_id long, lang_pred string, score double"
    )
