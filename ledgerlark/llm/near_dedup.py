"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has ``t`` coordinates. In round i every shingle is thrown by a hash
of that round into one coordinate (in rounds t to 2t-1 into coordinate i - t,
so that none stays empty), and a coordinate keeps its smallest (round, hash).
Rounds end once all coordinates are filled, which for large sets is after one
or a few rounds. Two sets agree in a coordinate with probability equal to
their similarity. Coordinates are cut into bands; the number of rows of a band
is the largest for which a pair just at the threshold is missed with
probability below ``MISS``.

Equal sets are one class, represented by its smallest doc_id. Within a bucket
of a band the classes are compared with hubs, first with the smallest class;
a link is confirmed on the full sets. A bucket whose classes are connected by then
is settled. The classes of the others are compared each with each of the same
hub, in tiles: a task counts the common shingles of all sets of two tiles by
numpy and hands on connections only. So a group of n copies costs about n
comparisons, no pair between components is left out, and texts that share a
template but are not alike cost counting, not rows.

Defined results: a null, empty or blank text has an empty set and is linked
with nothing; a text with fewer words than a shingle is one shingle; rows that
share a doc_id are one node with the links of all; a row whose doc_id is null is
no node: it links nothing, its ``component_id`` is that of the rows with an equal
set, or null, its ``kept`` is null, and :func:`one_of_each` keeps it; an empty
table gives an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import (
    BROADCAST_IDS,
    WordHashes,
    as_long,
    binary_column,
    column,
    joined,
    lower_ascii,
    mix64,
    shingles,
    ship,
    slices,
    stored,
    with_heavy_split,
)
from ledgerlark.llm.tiles import meetings, tiles_of

WIDTH, PERCENT = 5, 80
COORDINATES = 192
MISS = 1e-6

#: Shingles of a tile, and elements multiplied at once.
TILE_SHINGLES, COLUMNS = 400_000, 4096

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 40) - 1)
_SEEDS = mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def band_rows(percent: int, t: int = COORDINATES) -> int:
    s = percent / 100
    return max([r for r in range(1, 17) if (1 - s**r) ** (t // r) <= MISS], default=1)


def shingle_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Distinct shingle hashes of a text, sorted."""
    words = lower_ascii(text).split()
    own = hashes.of(words)
    if 0 < len(own) < width:
        return shingles(own, len(own))
    return np.unique(shingles(own, width))


def sketch(elements: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    out = np.full(t, _NONE, np.uint64)
    at, step = 0, max(1, 4096 // len(elements))
    while at < 2 * t and (out == _NONE).any():
        to = min(at + step, t if at < t else 2 * t)
        rounds = np.arange(at, to, dtype=np.uint64)[:, None]
        h = mix64(elements[None, :] ^ _SEEDS[at:to, None])
        coordinate = (h >> np.uint64(40)) % np.uint64(t) if at < t else np.broadcast_to(rounds - np.uint64(t), h.shape)
        np.minimum.at(out, coordinate.ravel().astype(np.int64), ((rounds << np.uint64(40)) | (h & _LOW)).ravel())
        at = to
    return out


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band and sketch; the band's number is part of the key."""
    bands = sketches.shape[1] // rows
    cut = sketches[:, : bands * rows].reshape(len(sketches), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2]).copy()
    for k in range(rows):
        key = joined(key, cut[:, :, k])
    return as_long(key)


def features(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` of every row; an empty set has no key."""
    rows = band_rows(percent)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            sizes, keys, sketches = [], [], []
            for text in binary_column(batch, "text"):
                own = shingle_set(text, width, hashes)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                if len(own):
                    sketches.append(sketch(own))
            bands = iter(band_keys(np.array(sketches), rows) if sketches else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array([next(bands) if n else None for n in sizes], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    slim = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(sketched, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with the sizes of their full sets, ``both`` and ``linked``. ``texts``: ``doc_id, text`` of the classes.

    A class that many others are compared with is dealt to several tasks, one
    for every 2,000 of its pairs.
    """
    uses = stored(pairs.groupBy("b").agg(F.count("*").alias("uses")), "uses")
    total = uses.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    parts = uses.withColumn("parts", F.ceil(F.col("uses") / 2000).cast("int"))
    salted = with_heavy_split(pairs, parts, "b", "uses", total)
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("parts")
    left = salted.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    right = parts.join(texts.withColumnRenamed("doc_id", "b"), "b")
    right = right.select("b", F.explode(F.expr("sequence(0, parts - 1)")).alias("salt"), F.col("text").alias("text_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last: tuple[int | None, bytes, np.ndarray] = (None, b"", np.zeros(0, np.uint64))
        for batch in slices(batches, 200):
            a, b = column(batch, "a"), column(batch, "b")
            counts = []
            for y, left_text, right_text in zip(b, binary_column(batch, "text_a"), binary_column(batch, "text_b"), strict=True):
                if (y, right_text) != last[:2]:
                    last = (y, right_text, shingle_set(right_text, width, hashes))
                one, two = shingle_set(left_text, width, hashes), last[2]
                counts.append((len(one), len(two), len(np.intersect1d(one, two, assume_unique=True))))
            n_a, n_b, both = (pa.array(c, pa.int64()) for c in (zip(*counts, strict=True) if counts else ((), (), ())))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), n_a, n_b, both], ["a", "b", "n_a", "n_b", "both"])

    found = ship(left).join(right, ["b", "salt"]).mapInArrow(confirm, "a bigint, b bigint, n_a bigint, n_b bigint, both bigint")
    return found.withColumn("linked", F.expr(f"100 * both >= {percent} * (n_a + n_b - both)"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of the links: the smallest node reachable.

    Each round a node takes the smallest label among its neighbours and then
    the label of that label, until nothing changes.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("heard"))
        near = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        new = stored(near.join(jump, "near").select("node", "old", F.least("near", "far").alias("component")), "labels")
        labels = new.select("node", "component")
        if not new.where("old <> component").limit(1).count():
            return labels


def _with_component(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``bucket, hub, id`` with the component of ``id``."""
    if labels is None:
        return members.select("bucket", "hub", "id", F.col("id").alias("component"))
    named = labels.select(F.col("node").alias("id"), F.col("component").alias("_c"))
    return members.join(named, "id", "left").select("bucket", "hub", "id", F.coalesce("_c", "id").alias("component"))


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` (each node's smallest connected node) after the links a - b are added."""
    while True:
        one, two = labels[a], labels[b]
        if (one == two).all():
            return labels
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def sets_of(texts: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` of the texts: the sorted distinct shingle hashes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 100):
            sets = [as_long(shingle_set(t, width, hashes)) for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return ship(texts).select(F.col("doc_id").alias("id"), "text").mapInArrow(made, "id bigint, shingles array<bigint>")


def common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of x has in common with each set of y.

    Elements that many of the sets hold are counted by a matrix product, the
    others pair by pair of the few sets that hold them.
    """
    out = np.zeros((len(x), len(y)), np.float32)
    every, place = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    owner = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    left = owner < len(x)
    n_x, n_y = (np.bincount(place[side], minlength=len(every)) for side in (left, ~left))
    dense = n_x * n_y * 32 > len(x) * len(y)
    few = (n_x > 0) & (n_y > 0) & ~dense
    number = np.cumsum(dense) - 1
    for at in range(0, int(dense.sum()), COLUMNS):
        own = dense[place] & (number[place] >= at) & (number[place] < at + COLUMNS)
        a, b = np.zeros((len(x), COLUMNS), np.float32), np.zeros((len(y), COLUMNS), np.float32)
        a[owner[own & left], number[place[own & left]] - at] = 1
        b[owner[own & ~left] - len(x), number[place[own & ~left]] - at] = 1
        out += a @ b.T
    starts = np.concatenate([[0], np.cumsum(n_x + n_y)])
    for k in np.nonzero(few)[0]:  # the owners of one element: those in x, then those in y
        own = owner[starts[k] : starts[k + 1]]
        out[np.ix_(own[: n_x[k]], own[n_x[k] :] - len(x))] += 1
    return out


def links_within(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: connections by links between the members (``hub, id``) of a hub, each with each, tile by tile.

    Two tiles are one row and their sets meet inside a task; only connections
    leave it, at most one for each member, so nothing grows with the pairs but
    the counting itself.
    """
    own = members.select("hub", "id").distinct()
    sets = sets_of(texts.join(own.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), width)
    items = stored(own.join(sets, "id").select(F.array("hub").alias("cell"), "id", "shingles"), "sets")
    tiles = tiles_of(items, F.size("shingles"), TILE_SHINGLES, ["id", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            a, b = [], []
            of = [batch.column(batch.schema.get_field_index(c)) for c in ("x_id", "y_id", "x_shingles", "y_shingles")]
            for x_id, y_id, x_sets, y_sets in zip(*of, strict=True):
                x, y = (np.split(s.values.flatten().to_numpy(), np.cumsum(s.values.value_lengths().to_numpy())[:-1]) for s in (x_sets, y_sets))
                both = common(x, y)
                sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :]
                i, j = np.nonzero(100 * both.astype(np.int64) >= percent * (sizes - both.astype(np.int64)))
                found = merged(np.arange(len(x) + len(y)), i, j + len(x))
                ids = np.concatenate([x_id.values.to_numpy(), y_id.values.to_numpy()])
                moved = np.nonzero(ids != ids[found])[0]
                a.append(ids[moved])
                b.append(ids[found[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(s)) for s in (a, b)], ["a", "b"])

    met = meetings(ship(tiles), [(0,)]).select("x_id", "y_id", "x_shingles", "y_shingles")
    return met.mapInArrow(compare, "a bigint, b bigint")


def linked(found: DataFrame, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """``set_key, rep, n_docs`` of the classes, and ``node, component`` of the linked ones."""
    classes = found.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_docs"))
    classes = stored(classes, "classes")
    reps = found.join(classes.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    placed = stored(reps.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("id")).distinct(), "placed")
    shared = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("hub")).where("size > 1")
    shared = stored(shared, "shared")
    total = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    members = stored(with_heavy_split(placed, shared, "bucket", "size", total), "members")
    asked = members.select("id").distinct()
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(asked.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), "texts")

    compared = stored(members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "compared")
    checked = stored(verified(compared, texts, width, percent), "checked")
    links = checked.where("linked").select("a", "b")
    labels = components(links) if links.limit(1).count() else None
    rest = _open(_with_component(members.where("id <> hub"), labels))
    if rest is not None:
        links = stored(links.unionByName(links_within(rest, texts, width, percent)), "links")
        labels = components(links) if links.limit(1).count() else None
    return classes, labels


def _open(members: DataFrame) -> DataFrame | None:
    """The members (``bucket, hub, id, component`` and more) of the buckets that hold several components; None if there are none."""
    members = stored(members, "rest")
    kinds = members.groupBy("bucket", "component").agg(F.count("*").alias("size"))  # a settled bucket is one row
    split = stored(kinds.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("size").alias("size")).where("parts > 1").drop("parts"), "split")
    found = split.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    if not found["n"]:
        return None
    if found["n"] <= BROADCAST_IDS:  # the members of settled buckets go no further than the scan
        return stored(members.join(F.broadcast(split.select("bucket")), "bucket", "left_semi"), "open")
    return stored(with_heavy_split(members, split, "bucket", "size", found["total"]), "open")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    found = stored(features(docs, width, percent), "features")
    classes, labels = linked(found, docs, width, percent)
    if labels is None:
        named = classes.withColumn("component", F.col("rep"))
    else:
        named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = stored(named.select("set_key", "n_docs", F.coalesce("component", "rep").alias("component_id")), "named")
    total = named.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    own = found.select("doc_id", "n_shingles", "set_key")
    joined_ = with_heavy_split(own.where("set_key is not null"), named, "set_key", "n_docs", total)
    alone = own.where("set_key is null").withColumn("component_id", F.col("doc_id"))
    out = joined_.select("doc_id", "n_shingles", "component_id").unionByName(alone.select("doc_id", "n_shingles", "component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents of ``docs`` that have the smallest doc_id of their group, and those whose doc_id is null."""
    named = docs.where("doc_id is not null")
    kept = near_duplicates(named, width, percent).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return named.join(kept, F.col("doc_id") == F.col("_id"), "left_semi").unionByName(docs.where("doc_id is null"))
