"""Language identification by nearest centroid over TF-IDF weighted byte n-grams.

A text is lower-cased, everything but letters becomes a space, and its byte
trigrams are counted in ``BUCKETS`` hashed buckets. Weights are
log(1 + count) * idf, scaled to length one. The idf comes from all training
rows; each language then gets up to ``CENTROIDS`` spherical k-means centroids,
fitted on at most ``SAMPLE`` of its rows (a parameter; the rows with the
smallest hashes of their id). A text is given the language of the centroid
with the largest cosine, and is *rejected* as unlike every learned language
when that cosine is below the smallest that the centroid's own sample reached
(apart from the outermost ``OUTER`` percent).

Defined results: a null text, or one without a letter, is ``und`` with score
0; with no training row every text is ``und``; ties go to the language first
in order; an empty table gives an empty result; repeated rows are judged one
by one; other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.common import column, ship, slices, stored

BUCKETS = 4096
CENTROIDS = 4
SAMPLE = 1500
OUTER = 1
#: Languages that a model may hold; their centroids take some 64 KB each.
MAX_LANGUAGES = 1000

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MIX = np.uint32(0x9E3779B1)


def letters(text: str | None) -> bytes:
    """The letters of a text in lower case, other stretches as one space; empty if it has no letter."""
    if not text:
        return b""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} ".encode("utf-8", "ignore") if words and any(c.isalpha() for c in words) else b""


def counted(raw: bytes) -> np.ndarray:
    """How often each bucket's trigrams occur."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return np.bincount((grams * _MIX) >> np.uint32(20), minlength=BUCKETS)


def vector(raw: bytes, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counted(raw)).astype(np.float32) * idf
    return v / max(float(np.sqrt(v @ v)), 1e-12)


class Model(NamedTuple):
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    #: Smallest cosine that still counts as the language.
    reach: np.ndarray


def _document_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training rows each bucket occurs, and the number of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches):
            for text in column(batch, "text"):
                if raw := letters(text):
                    total += counted(raw) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(np.append(total, n))], ["bucket", "n"])

    sums = ship(rows).select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)  # never more than BUCKETS + 1 rows
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def clusters(points: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from points far apart: (centroids, centroid of each point)."""
    chosen = [int((points @ points.sum(0)).argmax())]
    while len(chosen) < min(k, len(points)):
        chosen.append(int((points @ points[chosen].T).max(1).argmin()))
    centers = points[chosen]
    own = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        own = (points @ centers.T).argmax(1)
        for c in range(len(centers)):
            if (own == c).any():
                total = points[own == c].sum(0)
                centers[c] = total / max(float(np.sqrt(total @ total)), 1e-12)
    return centers, own


def fit(rows: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model | None:
    """Learn from ``doc_id, text, lang``; rows without language or letters teach nothing."""
    rows = rows.where("lang is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    document_counts, n = _document_counts(rows)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + document_counts)).astype(np.float32) + np.float32(1)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    grid = 1 << 30
    share = F.create_map([x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(grid, sample * grid // r["n"])))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < F.element_at(share, F.col("lang")))

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["doc_id", "text"], kind="stable").head(2 * sample)
        raws = [r for r in map(letters, own["text"]) if r]
        if not raws:
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        points = np.array([vector(r, idf) for r in raws])
        centers, at = clusters(points, k)
        near = (points * centers[at]).sum(1)
        reach = [float(np.percentile(near[at == c], OUTER)) if (at == c).any() else 1.0 for c in range(len(centers))]
        return pd.DataFrame({"lang": own["lang"].iloc[0], "centroid": [c.tobytes() for c in centers], "reach": reach})

    learned = drawn.groupBy("lang").applyInPandas(learn, "lang string, centroid binary, reach double")
    found = sorted(stored(learned, "centroids").collect(), key=lambda r: (r["lang"], r["centroid"]))
    if not found:
        return None
    return Model(idf, [r["lang"] for r in found], np.array([np.frombuffer(r["centroid"], np.float32) for r in found]), np.array([r["reach"] for r in found]))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``."""
    names_new = ("lang_pred", "score", "rejected")
    own = [f for f in docs.schema.fields if f.name not in names_new]
    names = [f.name for f in own]
    schema = T.StructType([*own, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES * CENTROIDS centroids

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            langs, scores, rejected = [], [], []
            for text in column(batch, "text"):
                raw = letters(text) if model else b""
                if not raw:
                    langs.append("und")
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                near = model.centroids @ vector(raw, model.idf)
                best = int(near.argmax())
                langs.append(model.languages[best])
                scores.append(min(1.0, max(0.0, float(near[best]))))
                rejected.append(bool(near[best] < model.reach[best]))
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], [*names, *names_new])

    return ship(docs).select(*names).mapInArrow(judge, schema)
