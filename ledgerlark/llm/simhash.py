"""Near-duplicate documents by SimHash: a 64-bit fingerprint each, compared exactly in tiles.

Equal fingerprints are one class. The classes are dealt to tiles by population
counts, the bits set in each of a few parts of the fingerprint. A bit that
differs changes one of these counts by one, so tiles whose counts differ by more
than the radius in all are skipped; the others are compared all with all by numpy
(exclusive-or and bit counts), which misses nothing. The number of parts grows
with the table, so that a tile stays small and the skipped share grows. From two
tiles only connections leave, at most one for each fingerprint in them.

Defined results: a null, empty or blank text has the fingerprint zero, which
links like any other; a text with fewer words than a shingle is one shingle; a
bit that is set in exactly half of the hashes is 0; rows that share a doc_id are
one node with the links of all; a row whose doc_id is null links nothing, its
``component_id`` is that of its fingerprint's documents, or null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import as_long, binary_column, lower_ascii, ship, slices, stored, with_heavy_split
from ledgerlark.llm.near_dedup import components, merged
from ledgerlark.llm.tiles import finest_cells, meetings, tiles_of

BITS = 64
WIDTH = 3
RADIUS = 3
SEED = 42
#: Fingerprints of a tile, and those compared at once with a tile.
TILE, STRIP = 2048, 128
#: Shingles of a text that are counted at once.
HASHES = 1 << 16
MOST_PARTS = 8


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The bits set in over half of the hashes of the text's shingles, repeats included."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(width, len(words))
    to = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    ones, n = np.zeros(BITS, np.int64), len(to)
    for at in range(0, n, HASHES):
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + HASHES], to[at : at + HASHES], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in binary_column(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_long(found))], ["doc_id", "fp"])

    slim = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(made, "doc_id bigint, fp bigint")


def counts(fp: Column, parts: int) -> Column:
    """Bits set in each of ``parts`` parts of the fingerprint."""
    cut = [BITS * k // parts for k in range(parts + 1)]
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cut, cut[1:], strict=False)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.array(*[F.bit_count(fp.bitwiseAND(F.lit(m).cast("long"))) for m in signed])


def steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """The differences of counts that fingerprints within the radius can have."""
    found = [()]
    for _ in range(parts):
        found = [s + (d,) for s, d in product(found, range(-radius, radius + 1)) if sum(map(abs, s)) + abs(d) <= radius]
    return found


def connections(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """For the fingerprints of x, then y: the smallest place that each is connected with by links between the two."""
    labels = np.arange(len(x) + len(y))
    for at in range(0, len(x), STRIP):
        a, b = np.nonzero(np.bitwise_count(x[at : at + STRIP, None] ^ y[None, :]) <= radius)
        if len(a):
            labels = merged(labels, a + at, b + len(x))
    return labels


def links(classes: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """``a, b``: connections between the classes (``fp, rep``), by ``rep``; what links reach, these reach."""
    parts = parts or finest_cells(classes, {k: counts(F.col("fp"), k) for k in range(1, MOST_PARTS + 1)})
    tiles = tiles_of(classes.withColumn("cell", counts(F.col("fp"), parts)), F.lit(1), TILE, ["fp", "rep"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            a, b = [], []
            for x, y, x_rep, y_rep in zip(*[batch.column(batch.schema.get_field_index(c)) for c in ("x_fp", "y_fp", "x_rep", "y_rep")], strict=True):
                left, right = (s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in (x, y))
                found = connections(left, right, radius)
                moved = np.nonzero(found != np.arange(len(found)))[0]
                if len(moved):
                    reps = np.concatenate([s.values.to_numpy(zero_copy_only=False) for s in (x_rep, y_rep)])
                    a.append(reps[moved])
                    b.append(reps[found[moved]])
            a, b = (np.concatenate(s) if s else np.zeros(0, np.int64) for s in (a, b))
            other = a != b  # a tile that meets itself holds each fingerprint twice
            yield pa.RecordBatch.from_arrays([pa.array(a[other]), pa.array(b[other])], ["a", "b"])

    met = meetings(ship(tiles), steps(parts, radius)).select("x_fp", "y_fp", "x_rep", "y_rep")
    return met.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id reachable."""
    found = stored(fingerprints(docs, width), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    joined = stored(links(classes.where("rep is not null").select("fp", "rep"), radius), "links")
    if joined.limit(1).count():
        classes = classes.join(components(joined).withColumnRenamed("node", "rep"), "rep", "left")
        classes = classes.select("fp", "n", F.coalesce("component", "rep").alias("component_id"))
    else:
        classes = classes.select("fp", "n", F.col("rep").alias("component_id"))
    named = stored(classes, "named")
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = with_heavy_split(found, named, "fp", "n", total)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
