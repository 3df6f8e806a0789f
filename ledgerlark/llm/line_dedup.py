"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

The store has three tables. ``postings`` has a row per distinct doc_id and
line key it holds, ``refs`` the exact number of doc_ids of each key and the
largest among them (the keeper), and ``filters`` one cuckoo filter per shard of
the key space with the *live* keys, those held by ``min_docs`` documents or
more. Inserting documents adds to the counts, deleting documents takes from
them; only keys that cross ``min_docs`` are put into or taken out of the
filters. A batch is served by probing its distinct keys against the filters;
what they let through is confirmed by the exact counts, so a false positive
never costs a line and a deletion brings lines back.

Keys are distinct wherever they are grouped by shard, and the number of shards
follows the number of keys, so a shard is bounded however often a line occurs.

Defined results: a null or empty text is one empty line; rows that share a
doc_id, in one insert or in several, are one document with the lines of all of
them: it counts once, and if it is the keeper all its rows keep the line; each
row gives a row of its own; rows without a doc_id count for nothing and keep
all their lines; an empty table gives an empty result; other columns pass
through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.common import binary_column, by_ids, column, lower_ascii, ship, slices, stored, with_heavy_split

MIN_DOCS = 3
MIN_CHARS = 20
KEYS_PER_SHARD = 200_000

POSTINGS = "key binary, doc_id bigint"
REFS = "key binary, n_docs bigint, keeper bigint"
FILTERS = "shard int, slots binary"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line, or None when its normalised form is too short."""
    line = lower_ascii(line.strip())
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line)


class CuckooFilter:
    """Four 16-bit fingerprints per bucket; a key has two buckets, each found from the other and the fingerprint."""

    SLOTS = 4

    def __init__(self, slots: bytes | None = None, capacity: int = 0):
        if slots is None:
            buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / self.SLOTS / 0.8))))
            self.table = np.zeros((buckets, self.SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(slots, np.uint16).reshape(-1, self.SLOTS).copy()
        self.mask = len(self.table) - 1

    def _places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
        prints = (words[:, 0] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (words[:, 1] & np.uint64(self.mask)).astype(np.int64)
        return prints, first, first ^ self._step(prints)

    def _step(self, prints: np.ndarray) -> np.ndarray:
        return ((prints.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(7)) & np.uint64(self.mask)).astype(np.int64)

    def insert(self, keys: list[bytes]) -> bool:
        """False when the filter is too full; the caller then builds a larger one from the exact counts."""
        if not keys:
            return True
        rng = np.random.default_rng(7)
        for fp, one, two in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            at = one
            for turn in range(500):
                free = np.flatnonzero(self.table[at] == 0)
                if not len(free) and turn == 0:
                    at = two
                    free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = fp
                    break
                k = int(rng.integers(self.SLOTS))
                fp, self.table[at, k] = int(self.table[at, k]), fp
                at ^= int(self._step(np.array([fp], np.uint16))[0])
            else:
                return False
        return True

    def delete(self, keys: list[bytes]) -> None:
        """Take out one fingerprint per key; every key must have been inserted."""
        if not keys:
            return
        for fp, one, two in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for at in (one, two):
                hit = np.flatnonzero(self.table[at] == fp)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        prints, one, two = self._places(keys)
        return (self.table[one] == prints[:, None]).any(1) | (self.table[two] == prints[:, None]).any(1)


def postings_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per distinct doc_id and key that one of its rows holds."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, ids = [], []
            for doc, text in zip(column(batch, "doc_id"), binary_column(batch, "text"), strict=True):
                own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars))}
                keys += own
                ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    slim = ship(docs).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = slim.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("_id")), "repeated")
    if not repeated.limit(1).count():
        return slim.mapInArrow(split, POSTINGS)
    once, more = by_ids(slim, repeated, "left_anti"), by_ids(slim, repeated, "left_semi")
    return once.mapInArrow(split, POSTINGS).unionByName(more.mapInArrow(split, POSTINGS).distinct())


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))


@dataclass(frozen=True)
class LineStore:
    """State of the incremental dedup; every change returns a new store over newly written tables."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS
    keys_per_shard: int = KEYS_PER_SHARD

    @classmethod
    def empty(cls, spark: SparkSession, **settings: int) -> LineStore:
        make = lambda schema: spark.createDataFrame([], schema)
        return cls(make(POSTINGS), make(REFS), make(FILTERS), 0, **settings)

    def _shard(self, shards: int) -> F.Column:
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")

    def insert(self, docs: DataFrame) -> LineStore:
        """Add documents."""
        new = stored(postings_of(docs, self.min_chars), "postings")
        if not self.shards:
            return self._next(new, stored(_counted(new), "refs"), self.refs)
        # a doc_id that is in the store already adds only the keys it did not hold
        known = stored(self.postings.join(new.select("doc_id").distinct(), "doc_id", "left_semi").select("key", "doc_id"), "known")
        new = stored(new.join(known, ["key", "doc_id"], "left_anti"), "added")
        both = self.refs.unionByName(_counted(new))
        refs = both.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        return self._next(self.postings.unionByName(new), stored(refs, "refs"), self.refs)

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Remove the documents whose ``doc_id`` is in ``doc_ids``."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        gone = stored(self.postings.join(ids, "doc_id", "left_semi").groupBy("key").count().select("key"), "gone")
        left = stored(self.postings.join(ids, "doc_id", "left_anti").select("key", "doc_id"), "postings")
        again = _counted(left.join(gone, "key", "left_semi"))
        refs = self.refs.join(gone, "key", "left_anti").unionByName(again)
        return self._next(left, stored(refs, "refs"), self.refs)

    def _next(self, postings: DataFrame, refs: DataFrame, before: DataFrame) -> LineStore:
        n = refs.count()
        shards = self.shards
        live = lambda t: t.where(F.col("n_docs") >= self.min_docs).select("key")
        if not shards or n > 2 * shards * self.keys_per_shard:  # (re)built from the exact counts
            shards = max(1, -(-n // self.keys_per_shard))
            filters = _updated(self.filters.limit(0), live(refs), live(refs).limit(0), live(refs), self._shard(shards))
        else:
            up = live(refs).join(live(before), "key", "left_anti")
            down = live(before).join(live(refs), "key", "left_anti")
            filters = _updated(self.filters, up, down, live(refs), self._shard(shards))
        return replace(self, postings=postings, refs=refs, filters=stored(filters, "filters"), shards=shards)

    def live_keys(self, postings: DataFrame) -> DataFrame:
        """``key, n_docs, keeper`` of the live keys among the postings: probed in the filters, confirmed in the counts."""
        if not self.shards:
            return self.refs
        keys = postings.groupBy("key").count().select("key", self._shard(self.shards).alias("shard"))

        def probe(filters: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(filters) or not len(asked):
                return pd.DataFrame({"key": []})
            found = CuckooFilter(bytes(filters["slots"].iloc[0])).contains([bytes(x) for x in asked["key"]])
            return asked.loc[found, ["key"]]

        maybe = self.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(probe, "key binary")
        return self.refs.where(F.col("n_docs") >= self.min_docs).join(maybe, "key")

    def drops(self, postings: DataFrame | None = None) -> DataFrame:
        """``doc_id, keys``: the keys whose lines each document loses."""
        postings = self.postings if postings is None else postings
        live = stored(self.live_keys(postings), "live")
        total = live.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
        lost = with_heavy_split(postings, live, "key", "n_docs", total).where("doc_id <> keeper")
        return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def _updated(old: DataFrame, up: DataFrame, down: DataFrame, live: DataFrame, shard: F.Column) -> DataFrame:
    """Filters after the keys ``up`` came and ``down`` went; a shard without room is built again from ``live``."""
    marks = up.withColumn("change", F.lit(1)).unionByName(down.withColumn("change", F.lit(-1)))
    keys = live.withColumn("alive", F.lit(True)).join(marks, "key", "full").withColumn("shard", shard)

    def turn(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((filters if len(filters) else keys)["shard"].iloc[0])
        pick = lambda rows: [bytes(x) for x in keys.loc[rows, "key"]]
        ok = False
        if len(filters):
            kept = CuckooFilter(bytes(filters["slots"].iloc[0]))
            kept.delete(pick(keys["change"] == -1))
            ok = kept.insert(pick(keys["change"] == 1))
        room = max(1024, int(keys["alive"].notna().sum()))
        while not ok:
            kept = CuckooFilter(capacity=room)
            ok = kept.insert(pick(keys["alive"].notna()))
            room *= 2
        return pd.DataFrame({"shard": [shard], "slots": [kept.table.tobytes()]})

    return ship(old).groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(turn, FILTERS)


def without_lines(docs: DataFrame, drops: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``, and ``n_lines`` (before) and ``n_dropped``."""
    own = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")]
    schema = T.StructType([*own, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in own]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts, losses = [], [], []
            for text, keys in zip(binary_column(batch, "text"), column(batch, "_keys"), strict=True):
                lines = text.split(b"\n")
                left = lines
                if keys:
                    gone = set(keys)
                    left = [x for x in lines if line_key(x, min_chars) not in gone]
                texts.append(b"\n".join(left))
                counts.append(len(lines))
                losses.append(len(lines) - len(left))
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            arrays = [new[n] if n in new else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64()), pa.array(losses, pa.int64())], [*names, "n_lines", "n_dropped"])

    lost = drops.select(F.col("doc_id").alias("_id"), F.col("keys").alias("_keys")).hint("shuffle_hash")
    joined = ship(docs).select(*names).join(lost, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return joined.mapInArrow(rebuild, schema)


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Put ``docs`` into a new store and take out the lines it lets go."""
    store = LineStore.empty(docs.sparkSession, min_docs=min_docs, min_chars=min_chars).insert(docs)
    return without_lines(docs, store.drops(), min_chars)
