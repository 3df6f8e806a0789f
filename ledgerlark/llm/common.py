"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import ensure_checkpoint_dir

#: The six ASCII separators of the contracts, 0x20 and 0x09-0x0D; ``bytes.split()`` splits at exactly these.
SEPARATORS = " \t\n\x0b\x0c\r"

#: Rows of text handed to a Python task at once.
BATCH_ROWS = 1000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not the work above.
    The files belong to the job; the folder is cleaned like any checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=4)
def _shipped(context: SparkContext) -> None:
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerlark-code-")) / "ledgerlark-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))


def ship(df: DataFrame) -> DataFrame:
    """Give the executors this package's code, once per application; returns ``df``."""
    _shipped(df.sparkSession.sparkContext)
    return df


def lower_ascii(raw: bytes) -> bytes:
    """Lower-case A-Z only."""
    return raw.translate(_LOWER)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null is the empty text."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [b"" if x is None else x for x in col.to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows, so that long texts stay few per step."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WordHashes(dict):
    """64-bit hash of each word seen, kept for ``limit`` words at most."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x = x * _M2
    x ^= x >> _S33
    return x


_ODD = np.uint64(0x9E3779B97F4A7C15)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of two hashed sequences (order matters)."""
    return mix64(left * _ODD + right)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, by doubling; empty when there are too few."""
    n = len(hashes) - width + 1
    if n < 1:
        return hashes[:0]
    out, have, power, size = None, 0, hashes, 1
    rest = width
    while rest:
        if rest & 1:
            out = power[: len(power)] if out is None else joined(out[: len(power) - have], power[have:])
            have += size
        rest >>= 1
        if rest:
            power = joined(power[:-size], power[size:])
            size *= 2
    return out[:n]


def as_long(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.astype(np.uint64).view(np.int64)


def with_heavy_split(facts: DataFrame, dim: DataFrame, key: str, weight: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of ``facts`` with ``dim`` (one row per ``key``), safe when a key holds a large share of the rows.

    ``dim[weight]`` is the number of fact rows of the key and ``total`` their sum,
    so fewer than ``share`` keys can hold more than ``total / share`` rows each:
    those, at most ``share`` rows, are broadcast and never shuffled. The others
    are joined by a shuffle in which no key holds over ``1 / share`` of the rows.
    """
    heavy = dim.where(F.col(weight) * share > F.lit(total)).drop(weight)
    light = dim.where(F.col(weight) * share <= F.lit(total)).drop(weight)
    hot = facts.join(F.broadcast(heavy), key)
    rest = facts.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)


#: Ids that are broadcast at most (8 bytes each, some 100 MB once hashed); beyond it the join shuffles.
BROADCAST_IDS = 4_000_000


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` semi- or anti-joined (``how``) with a written table of distinct ids ``_id``, by doc_id.

    Few ids are broadcast, so that the texts stay where they are.
    """
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, docs["doc_id"].cast("long") == ids["_id"], how)


def paired_texts(pairs: DataFrame, texts: DataFrame, load: int = 2000) -> DataFrame:
    """``a, b, text_a, text_b`` for the pairs ``a, b`` of doc_ids.

    A ``b`` with many pairs is dealt to several tasks, one for every ``load`` of its pairs.
    """
    uses = stored(pairs.groupBy("b").agg(F.count("*").alias("uses")), "uses")
    total = uses.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    parts = uses.withColumn("parts", F.ceil(F.col("uses") / load).cast("int"))
    salted = with_heavy_split(pairs, parts, "b", "uses", total)
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("parts")
    left = salted.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    right = parts.join(texts.withColumnRenamed("doc_id", "b"), "b")
    right = right.select("b", F.explode(F.expr("sequence(0, parts - 1)")).alias("salt"), F.col("text").alias("text_b"))
    return left.join(right, ["b", "salt"]).select("a", "b", "text_a", "text_b")
