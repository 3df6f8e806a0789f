"""Repeated passages by seed and extend: winnowed anchors, two-sided extension, maximal repeats.

A passage is repeated when its words stand in a row in a document with a
smaller doc_id too. Of every 41 consecutive 10-word shingles the one with the
smallest hash is an anchor, so each window of 50 words holds at least one, and
the same one wherever the window occurs. Steps:

1. Documents with equal word sequences are one class; all but those with the
   smallest doc_id lose every word (if they have a window at all).
2. The distinct anchors of each class are joined with the *hub* of the anchor,
   the smallest document that has it. Each (document, hub) pair is compared
   once: shared anchors are extended both ways to maximal matches, and those
   of ``window`` words or more are kept.
3. A window whose anchor is shared, but which the anchor's hub does not hold,
   may still be in another smaller document. Only such windows are grouped by
   a 128-bit hash, which finds the smallest document of each exactly.

A passage in n documents thus costs n comparisons, never n * n, and no
document is compared with more hubs than it has anchors.

Defined results: a null, empty or blank text has no words; a text with fewer
words than a window loses none; rows that share a doc_id are not smaller than
each other and should hold the same text (spans belong to a doc_id: of rows
that differ, each loses the places that any of them loses); an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.common import (
    WordHashes,
    as_long,
    binary_column,
    by_ids,
    column,
    mix64,
    paired_texts,
    ship,
    shingles,
    slices,
    stored,
    with_heavy_split,
)

WINDOW = 50
SEED = 10

_FLIP = np.uint64(0xA24BAED4963EE407)
_NO_HASH = np.zeros(0, np.uint64)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def winnowed(words: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each seed shingle, whether it is an anchor, the anchor hash of each window)."""
    if len(words) < window:
        return _NO_HASH, np.zeros(0, bool), _NO_HASH
    grams = shingles(words, seed)
    width = window - seed + 1
    least = _sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    return grams, _sliding(np.concatenate([pad, least, pad]), width, np.maximum) == grams, least


def _runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def repeats(one: np.ndarray, two: np.ndarray, window: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """(start, end) word spans of ``one`` that ``two`` repeats: every window inside a span is in ``two``."""
    grams, anchor, _ = winnowed(one, window, seed)
    others = shingles(two, seed)
    if not len(grams) or len(two) < window:
        return np.zeros((0, 2), np.int64)
    at = np.flatnonzero(anchor & np.isin(grams, others))
    if not len(at):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(others, kind="stable")
    low = np.searchsorted(others, grams[at], sorter=order)
    times = np.searchsorted(others, grams[at], side="right", sorter=order) - low
    if (times > 1).any():  # an anchor that recurs in the other text: windows are looked up instead of extended
        held = np.isin(shingles(one, window), shingles(two, window))
        spans = _runs(held)
        return spans + np.array([0, window - 1])
    found, done = [], {}
    for p, q in zip(at.tolist(), order[low].tolist(), strict=True):
        shift = p - q
        if p < done.get(shift, -1):
            continue
        back = min(p, q)
        left = one[p - back : p] == two[q - back : q]
        start = p - back + (0 if left.all() else back - int(left[::-1].argmin()))
        ahead = min(len(one) - p, len(two) - q)
        right = one[p : p + ahead] == two[q : q + ahead]
        end = p + (ahead if right.all() else int(right.argmin()))
        done[shift] = end
        if end - start >= window:
            found.append((start, end))
    return np.array(found, np.int64).reshape(-1, 2)


def features(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, key, anchors``: word count, key of the word sequence and distinct anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            sizes, keys, anchors = [], [], []
            for text in binary_column(batch, "text"):
                words = hashes.of(text.split())
                grams, chosen, _ = winnowed(words, window, seed)
                sizes.append(len(words))
                keys.append(xxhash.xxh3_128_digest(words.tobytes()) if len(words) >= window else None)
                anchors.append(as_long(np.unique(grams[chosen])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(anchors, pa.list_(pa.int64()))],
                ["doc_id", "n_words", "key", "anchors"],
            )

    slim = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(scan, "doc_id bigint, n_words bigint, key binary, anchors array<bigint>")


def _spans(pairs: DataFrame, window: int, seed: int) -> DataFrame:
    """``doc_id, start, end``: spans of document ``a`` that document ``b`` repeats."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last: tuple[bytes, np.ndarray] = (b"", _NO_HASH)
        for batch in slices(batches, 200):
            ids, spans = [], [np.zeros((0, 2), np.int64)]
            for a, one, two in zip(column(batch, "a"), binary_column(batch, "text_a"), binary_column(batch, "text_b"), strict=True):
                if two != last[0]:
                    last = (two, hashes.of(two.split()))
                own = repeats(hashes.of(one.split()), last[1], window, seed)
                ids += [a] * len(own)
                spans.append(own)
            both = np.concatenate(spans)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(both[:, 0], pa.int32()), pa.array(both[:, 1], pa.int32())], ["doc_id", "start", "end"])

    return ship(pairs).mapInArrow(extend, "doc_id bigint, start int, end int")


def _unsettled(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """``doc_id, start, high, low``: windows that only other documents than their anchor's hub can repeat.

    ``rows``: ``doc_id, text, away`` (its anchors whose hub is another document), ``spans`` (found so far).
    """

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 200):
            ids, starts, high, low = [], [], [_NO_HASH], [_NO_HASH]
            rows = (column(batch, "doc_id"), binary_column(batch, "text"), column(batch, "away"), column(batch, "spans"))
            for doc, text, away, spans in zip(*rows, strict=True):
                words = hashes.of(text.split())
                least = winnowed(words, window, seed)[2]
                if not len(least):
                    continue
                open_ = np.isin(least, np.array(away, np.int64).view(np.uint64))
                for span in spans or ():
                    open_[span["start"] : max(span["start"], span["end"] - window + 1)] = False
                at = np.flatnonzero(open_)
                ids += [doc] * len(at)
                starts += at.tolist()
                high.append(shingles(words, window)[at])
                low.append(shingles(mix64(words ^ _FLIP), window)[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(as_long(np.concatenate(high))), pa.array(as_long(np.concatenate(low)))],
                ["doc_id", "start", "high", "low"],
            )

    return ship(rows).mapInArrow(rest, "doc_id bigint, start int, high bigint, low bigint")


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, spans`` of words to remove, ``_id`` of the documents that lose every word)."""
    found = stored(features(docs, window, seed), "features")
    same = found.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    same = stored(same.where("n > 1"), "same")
    total = same.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    copies = with_heavy_split(found.where("key is not null").select("key", "doc_id"), same, "key", "n", total)
    copies = stored(copies.where("doc_id > first").select(F.col("doc_id").alias("_id")).distinct(), "copies")

    single = by_ids(found.select("doc_id", "anchors"), copies, "left_anti")
    anchors = stored(single.select("doc_id", F.explode("anchors").alias("anchor")).distinct(), "anchors")
    hubs = anchors.groupBy("anchor").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    hubs = stored(hubs, "hubs")
    total = hubs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = with_heavy_split(anchors, hubs, "anchor", "n", total)
    own = stored(
        shared.groupBy("doc_id").agg(
            F.collect_list(F.when(F.col("hub") < F.col("doc_id"), F.col("anchor"))).alias("away"),
            F.collect_set("hub").alias("hubs"),
        ),
        "own",
    )
    pairs = own.select(F.col("doc_id").alias("a"), F.explode("hubs").alias("b")).where("a <> b")
    needed = stored(own.select(F.col("doc_id").alias("_id")), "needed")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = stored(by_ids(slim, needed, "left_semi"), "texts")
    spans = stored(_spans(paired_texts(pairs, texts), window, seed), "spans")

    listed = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    asked = own.where(F.size("away") > 0).select("doc_id", "away").join(listed, "doc_id", "left")
    rest = stored(_unsettled(texts.join(asked, "doc_id"), window, seed), "rest")
    first = rest.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first < last")
    first = stored(first.select(F.struct("high", "low").alias("at"), "first", "n"), "first")
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    late = with_heavy_split(rest.select(F.struct("high", "low").alias("at"), "doc_id", "start"), first, "at", "n", total)
    late = late.where("first < doc_id").select("doc_id", "start", (F.col("start") + window).cast("int").alias("end"))
    every = spans.unionByName(late).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return stored(every, "every"), copies


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` with ``text`` cut to the kept words, joined by one space, and ``n_words`` (before) and ``n_removed``."""
    spans, copies = repeated_spans(docs, window, seed)
    own = [f for f in docs.schema.fields if f.name not in ("n_words", "n_removed")]
    names = [f.name for f in own]
    schema = T.StructType([*own, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, sizes, losses = [], [], []
            for text, lost, gone in zip(binary_column(batch, "text"), column(batch, "_spans"), column(batch, "_gone"), strict=True):
                words = text.split()
                left = words
                if lost or gone:
                    keep = np.full(len(words), not gone)
                    for span in lost or ():
                        keep[span["start"] : span["end"]] = False
                    left = [words[i] for i in np.flatnonzero(keep).tolist()]
                texts.append(b" ".join(left))
                sizes.append(len(words))
                losses.append(len(words) - len(left))
            new = pa.array(texts, pa.binary()).cast(pa.string())
            arrays = [new if n == "text" else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sizes, pa.int64()), pa.array(losses, pa.int64())], [*names, "n_words", "n_removed"])

    span_type = spans.schema["spans"].dataType
    with_spans = lambda d, c, g: d.withColumns({"_spans": c, "_gone": F.lit(g)})
    docs = ship(docs).select(*names)
    ids = stored(spans.select(F.col("doc_id").alias("_id")).unionByName(copies).distinct(), "touched")
    same = with_spans(by_ids(docs, ids, "left_anti"), F.lit(None).cast(span_type), False)
    all_gone = with_spans(by_ids(docs, copies, "left_semi"), F.lit(None).cast(span_type), True)
    some = by_ids(docs, stored(spans.select(F.col("doc_id").alias("_id")), "spanned"), "left_semi")
    some = some.join(spans.select(F.col("doc_id").alias("_id"), F.col("spans").alias("_spans")), F.col("doc_id") == F.col("_id")).drop("_id")
    return same.unionByName(all_gone).unionByName(some.withColumn("_gone", F.lit(False))).mapInArrow(cut, schema)
