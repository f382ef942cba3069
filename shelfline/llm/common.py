"""Helpers shared by the corpus operators: shared folder, stored tables, word splitting, calibration."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of words: space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file of this name is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pattern() -> str:
    """The pattern that cuts texts into pre-tokens for the public rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


_LOCAL_FOLDER: list[str] = []


def workspace(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, which only a local master may do, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL_FOLDER:
            _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="corpus-"))
        base = _LOCAL_FOLDER[0]
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """The frame as a Parquet table in the shared folder: its lineage is cut, and lost executors do not lose it."""
    spark = df.sparkSession
    path = f"{workspace(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id's decimal digits, modulo: the folds that are held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a batch as bytes."""
    return column.cast(pa.binary()).to_pylist()


def split_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case. Null has none."""
    return text.lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound; the hash is a function of the word alone."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.bound:
                self.clear()
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of runs of `size` words, sorted. A shorter text is one run; without words there is none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    acc = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - size + 1 + i])
    return np.unique(acc)


def fit_platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a logistic curve over margins, by Newton steps with a small ridge."""
    if len(label) == 0:
        return 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], 1).astype(float)
    scale = max(float(np.abs(margin).max()), 1e-9)
    x[:, 0] /= scale
    # targets drawn in from 0 and 1, so that separable classes do not send the slope to infinity
    up, down = label.sum(), len(label) - label.sum()
    y = np.where(label > 0, (up + 1) / (up + 2), 1 / (down + 2))
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-6 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
