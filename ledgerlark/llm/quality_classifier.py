"""Document quality from bytes: a convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP`` and
cover it to the end. Every byte has a learned embedding; learned filters slide
over each chunk, and each filter's largest response in a chunk is kept. The
mean and the maximum of these over the chunks of a document go through a
logistic unit to one probability.

The network is fitted in one task on about ``SAMPLE`` labelled rows per class (a
parameter; rows by the hash of their id) and, where these are long, on the first
of them that make up ``SAMPLE_BYTES`` (a parameter too), whole texts always.
Training, like scoring, uses every chunk of every text. Both hold a bounded
number of chunks at a time: training goes over a batch's chunks twice and works
out again, the second time, what it had no room to keep.

Defined results: a null or empty text is one chunk of padding and gets a score
like any other; without training rows of both classes every score is their
share of ones, or 0.5; an empty table gives an empty result; repeated rows are
scored one by one; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.common import binary_column, ship, slices, stored

CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS = 6, 12, 4, 32
SAMPLE = 1500
#: UTF-8 bytes of text per class after which the sample takes no further row.
SAMPLE_BYTES = 64 << 20
EPOCHS, BATCH, RATE = 12, 32, 3e-3
#: Chunks in one matrix product.
_TOGETHER = 64
#: Matrix products of a batch whose results training keeps; those of the others are worked out again.
_HELD = 128
_PAD = 256  # a byte value of its own for what lies past the end


def chunks(text: bytes) -> np.ndarray:
    """Byte values of each chunk."""
    step = CHUNK - OVERLAP
    starts = list(range(0, max(1, len(text) - OVERLAP), step))
    out = np.full((len(starts), CHUNK), _PAD, np.int16)
    raw = np.frombuffer(text, np.uint8)
    for k, s in enumerate(starts):
        part = raw[s : s + CHUNK]
        out[k, : len(part)] = part
    return out


class Chunked:
    """The chunks of a text by their numbers, made when they are asked for."""

    def __init__(self, text: bytes):
        self.text = text

    def __len__(self) -> int:
        return len(range(0, max(1, len(self.text) - OVERLAP), CHUNK - OVERLAP))

    def __getitem__(self, some: slice) -> np.ndarray:
        first, last, _ = some.indices(len(self))
        step = CHUNK - OVERLAP
        return chunks(self.text[first * step : last * step + OVERLAP])


Weights = dict[str, np.ndarray]


def _windows(chunk: np.ndarray, w: Weights) -> np.ndarray:
    """(chunk, position, width * embedding) inputs of the filters."""
    x = w["embed"][chunk]
    flat = np.lib.stride_tricks.sliding_window_view(x.reshape(len(x), -1), WIDTH * EMBED, axis=1)
    return flat[:, :: STRIDE * EMBED]


def responses(chunk: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest response in each chunk, and the position where it is."""
    x = _windows(chunk, w)
    z = (np.ascontiguousarray(x).reshape(-1, WIDTH * EMBED) @ w["filters"]).reshape(len(chunk), -1, FILTERS)
    at = z.argmax(1)
    return np.take_along_axis(z, at[:, None], 1)[:, 0] + w["bias"], at


def combined(top: np.ndarray) -> np.ndarray:
    return np.concatenate([top.mean(0), top.max(0)])


def _start(rng: np.random.Generator) -> Weights:
    return {
        "embed": rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": np.zeros(2 * FILTERS, np.float32),
        "base": np.zeros(1, np.float32),
    }


def _strips(sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """Chunks of documents in lots of ``_TOGETHER``: (document, from, to) each."""
    out: list[list[tuple[int, int, int]]] = []
    room = 0
    for doc, size in enumerate(sizes):
        at = 0
        while at < size:
            if room == 0:
                out.append([])
                room = _TOGETHER
            to = min(size, at + room)
            out[-1].append((doc, at, to))
            room -= to - at
            at = to
    return out


def _slopes(docs: Sequence[np.ndarray | Chunked], truth: np.ndarray, w: Weights) -> Weights:
    """Gradient of the mean log loss over some documents; it flows through the largest responses alone."""
    sizes = [len(d) for d in docs]
    strips = _strips(sizes)
    every = np.arange(FILTERS)

    def passed(strip: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.concatenate([docs[d][a:b] for d, a, b in strip])
        raw, at = responses(rows, w)
        return rows, np.tanh(raw), at

    total, most = np.zeros((len(docs), FILTERS)), np.full((len(docs), FILTERS), -np.inf)
    where = np.zeros((len(docs), FILTERS), np.int64)  # the chunk of each filter's maximum
    held = []
    for strip in strips:
        result = passed(strip)
        if len(held) < _HELD:
            held.append(result)
        begin = 0
        for d, a, b in strip:
            own = result[1][begin : begin + b - a]
            begin += b - a
            total[d] += own.sum(0)
            best = own.argmax(0)
            top = own[best, every]
            where[d] = np.where(top > most[d], a + best, where[d])
            most[d] = np.maximum(most[d], top)
    feats = np.concatenate([total / np.array(sizes)[:, None], most], 1)
    error = (1 / (1 + np.exp(-(feats @ w["out"] + w["base"][0]))) - truth) / len(docs)
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["out"] += error @ feats
    grad["base"] += error.sum()
    to_mean = error[:, None] * w["out"][:FILTERS] / np.array(sizes)[:, None]
    to_most = error[:, None] * w["out"][FILTERS:]
    for k, strip in enumerate(strips):
        rows, top, at = held[k] if k < len(held) else passed(strip)
        d_top = np.concatenate([np.repeat(to_mean[d : d + 1], b - a, 0) for d, a, b in strip]).astype(top.dtype)
        begin = 0
        for d, a, b in strip:
            here = every[(a <= where[d]) & (where[d] < b)]
            d_top[begin + where[d][here] - a, here] += to_most[d][here]
            begin += b - a
        d_raw = d_top * (1 - top**2)
        grad["bias"] += d_raw.sum(0)
        spots = at[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = np.take_along_axis(rows[:, None, :], spots, 2)  # (chunk, filter, width) bytes under each largest response
        x = w["embed"][seen].reshape(*at.shape, WIDTH * EMBED)
        grad["filters"] += np.einsum("cfk,cf->kf", x, d_raw)
        d_x = (d_raw[:, :, None] * w["filters"].T[None]).reshape(-1, EMBED)
        np.add.at(grad["embed"], seen.ravel(), d_x)
    return grad


def train(texts: list[bytes], truth: list[int], epochs: int = EPOCHS, seed: int = 1) -> Weights:
    """Fit the network by Adam on small batches."""
    rng = np.random.default_rng(seed)
    w = _start(rng)
    y = np.array(truth, np.float32)
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lot in range(0, len(texts), BATCH):
            some = order[lot : lot + BATCH]
            grad, step = _slopes([Chunked(texts[i]) for i in some], y[some], w), step + 1
            for k in w:
                mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                square[k] = 0.99 * square[k] + 0.01 * grad[k] ** 2
                w[k] -= (RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def probability(text: bytes, w: Weights) -> float:
    """Score of one text from all its chunks, a bounded number of them at a time."""
    total, most, n = np.zeros(FILTERS, np.float64), np.full(FILTERS, -np.inf), 0
    step = CHUNK - OVERLAP
    for at in range(0, max(1, len(text) - OVERLAP), step * _TOGETHER):
        part = text[at : at + step * _TOGETHER + OVERLAP]
        top = np.tanh(responses(chunks(part), w)[0])
        total += top.sum(0)
        most = np.maximum(most, top.max(0))
        n += len(top)
    z = np.concatenate([total / n, most]) @ w["out"] + w["base"][0]
    return float(1 / (1 + np.exp(-z)))


_SHAPES = {"embed": (257, EMBED), "filters": (WIDTH * EMBED, FILTERS), "bias": (FILTERS,), "out": (2 * FILTERS,), "base": (1,)}


def _within(drawn: DataFrame, sample_bytes: int) -> DataFrame:
    """The rows of a sample, in the order of a hash, up to the one that brings a class to ``sample_bytes``."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = drawn.select("doc_id", "quality", size.alias("_size"))
    ahead = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    kept = sizes.select("doc_id", "quality", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead")).where(F.col("_ahead") < sample_bytes)
    return drawn.join(F.broadcast(kept.select("doc_id", "quality").distinct()), ["doc_id", "quality"], "left_semi")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, sample_bytes: int = SAMPLE_BYTES) -> Weights:
    """Learn from ``doc_id, text`` and ``doc_id, quality`` (0 or 1; other values teach nothing)."""
    marks = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality")).distinct()
    sizes = {r["quality"]: r["n"] for r in marks.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    nothing = _start(np.random.default_rng(1))
    if len(sizes) < 2:
        nothing["base"][:] = {0: -9.0, 1: 9.0}.get(next(iter(sizes), None), 0.0)
        return nothing
    grid = 1 << 30
    share = F.when(F.col("quality") == 0, min(grid, sample * grid // sizes[0])).otherwise(min(grid, sample * grid // sizes[1]))
    drawn = marks.where(F.pmod(F.xxhash64("_id"), F.lit(grid)) < share).limit(4 * sample)  # ids of the sample alone
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = stored(texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).drop("_id"), "sample")
    drawn = _within(drawn, sample_bytes)

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        own = own.assign(text=own["text"].fillna("")).sort_values(["doc_id", "quality", "text"], kind="stable")
        own = own.groupby("quality").head(2 * sample)
        w = train([t.encode("utf-8") for t in own["text"]], own["quality"].tolist(), epochs)
        return pd.DataFrame({"name": list(w), "value": [v.tobytes() for v in w.values()]})

    learned = ship(drawn).withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(learn, "name string, value binary")
    return {r["name"]: np.frombuffer(r["value"], np.float32).reshape(_SHAPES[r["name"]]) for r in stored(learned, "weights").collect()} or nothing


def score(docs: DataFrame, w: Weights) -> DataFrame:
    """``docs`` with ``score``, the probability of quality 1."""
    own = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in own]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [probability(t, w) for t in binary_column(batch, "text")]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], [*names, "score"])

    return ship(docs).select(*names).mapInArrow(judge, T.StructType([*own, T.StructField("score", T.DoubleType())]))
