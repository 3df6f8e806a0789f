"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes.

Documents and benchmark items become token sequences (ASCII punctuation and
white space separate, A-Z is lower-cased). A running hash of every
``min_tile`` tokens is joined with those of the items; consecutive seeds on
one diagonal are a maximal match, checked token by token. For each document
and item the longest match is marked as a tile, the tokens it takes are no
longer free in either text, what is left of overlapping matches is put back,
and so on until no free match of ``min_tile`` tokens is left. An item whose
tokens are covered to ``percent`` by tiles, in whatever order the tiles come,
contaminates the document.

The items are the fixed side of the join: they are dealt to blocks of at most
``BLOCK_BYTES`` of text (or one item), each block is broadcast and compared
with all documents, so nothing that is broadcast grows with the input and a
larger benchmark only means more blocks.

Defined results: a null or empty text, or one with fewer than ``min_tile``
tokens, matches nothing (an item so short is matched as a whole if it has a
token); items that share an id are compared one by one and the best counts;
an empty table on either side gives an empty result; repeated documents each
give their rows, those without a doc_id too; other columns are ignored.
:func:`without_leaks` judges documents without a doc_id row by row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import WordHashes, binary_column, column, ship, slices, stored

MIN_TILE = 5
PERCENT = 50
#: Text of the items of one block; its hashes take about six times as much in a task.
BLOCK_BYTES = 4 << 20

MATCHES = "doc_id bigint, item_id bigint, item_tokens int, covered int, tiles int, longest int"

_SEPARATE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_POWER = np.uint64(_BASE)


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATE).split()


def running_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2**64) of every ``width`` consecutive values, from one running sum."""
    n = len(values) - width + 1
    if n < 1:
        return values[:0]
    down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(values) - 1, _INVERSE)]))
    up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _POWER)]))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * down)])
    return (total[width:] - total[:-width]) * up


def maximal_matches(doc_at: np.ndarray, item_at: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(length, document position, item position) of each run of seeds on a diagonal."""
    diagonal = doc_at - item_at
    order = np.lexsort((doc_at, diagonal))
    d, i, g = doc_at[order], item_at[order], diagonal[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1] + 1)]))
    size = np.diff(np.append(first, len(d))) + width - 1
    return list(zip(size.tolist(), d[first].tolist(), i[first].tolist(), strict=True))


def tiles(matches: list[tuple[int, int, int]], item_tokens: int, min_tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: the longest free match first; ties by position in the document, then in the item."""
    heap = [(-n, d, i) for n, d, i in matches]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item = [False] * item_tokens
    out, free = [], item_tokens
    while heap and free >= min_tile:
        n, d, i = heapq.heappop(heap)
        n = -n
        clear = [not in_item[i + k] and d + k not in in_doc for k in range(n)]
        if all(clear):
            out.append((n, d, i))
            in_doc.update(range(d, d + n))
            in_item[i : i + n] = [True] * n
            free -= n
            continue
        at = 0
        while at < n:  # the free stretches of the match compete again
            if not clear[at]:
                at += 1
                continue
            to = at
            while to < n and clear[to]:
                to += 1
            if to - at >= min_tile:
                heapq.heappush(heap, (at - to, d + at, i + at))
            at = to
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ranges that begin at ``start`` and have ``size`` members, and the range of each."""
    which = np.repeat(np.arange(len(start)), size)
    return start[which] + np.arange(len(which)) - (np.cumsum(size) - size)[which], which


class Items:
    """The benchmark items of a block, with their seeds in hash order."""

    def __init__(self, rows: list[tuple[int, bytes]], min_tile: int):
        hashes = WordHashes()
        self.min_tile = min_tile
        self.ids, self.words, seeds, owner, place = [], [], {}, {}, {}
        for item, text in rows:
            own = hashes.of(tokens(text))
            width = min(min_tile, len(own))
            if not width:
                continue
            found = running_hashes(own, width)
            for store, part in ((seeds, found), (owner, np.full(len(found), len(self.ids))), (place, np.arange(len(found)))):
                store.setdefault(width, []).append(part)
            self.ids.append(item)
            self.words.append(own)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.seeds = {}
        for width in seeds:
            found = np.concatenate(seeds[width])
            order = np.argsort(found, kind="stable")
            self.seeds[width] = (found[order], np.concatenate(owner[width])[order], np.concatenate(place[width])[order])

    def match(self, texts: list[bytes], hashes: WordHashes, percent: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item, tokens, covered, tiles, longest) for the items that contaminate a text."""
        words = [tokens(t) for t in texts]
        all_words = hashes.of([w for own in words for w in own])
        ends = np.cumsum([len(w) for w in words])
        for width, (seeds, owner, place) in self.seeds.items():
            found = running_hashes(all_words, width)
            if not len(found):
                continue
            low = np.searchsorted(seeds, found)
            hit = np.flatnonzero(seeds[np.minimum(low, len(seeds) - 1)] == found)
            row = np.searchsorted(ends, hit, side="right")
            inside = hit + width <= ends[row]  # a seed does not run across two documents
            hit, row = hit[inside], row[inside]
            if not len(hit):
                continue
            high = np.searchsorted(seeds, found[hit], side="right")
            low, edges = low[hit], np.flatnonzero(np.diff(row, prepend=-1))
            for begin_at, end_at in zip(edges.tolist(), [*edges[1:].tolist(), len(row)], strict=True):
                r = int(row[begin_at])
                begin = int(ends[r - 1]) if r else 0
                own = all_words[begin : int(ends[r])]
                at, first, last = hit[begin_at:end_at] - begin, low[begin_at:end_at], high[begin_at:end_at]
                for k, doc_at, item_at in self._seeded(at, first, last, owner, place, width, percent):
                    item = self.words[k]
                    real = [m for m in maximal_matches(doc_at, item_at, width) if (own[m[1] : m[1] + m[0]] == item[m[2] : m[2] + m[0]]).all()]
                    if sum(m[0] for m in real) * 100 < percent * len(item):
                        continue
                    tiled = tiles(real, len(item), min(width, self.min_tile))
                    covered = sum(n for n, _, _ in tiled)
                    if tiled and covered * 100 >= percent * len(item):
                        yield r, self.ids[k], len(item), covered, len(tiled), tiled[0][0]

    def _seeded(self, at: np.ndarray, first: np.ndarray, last: np.ndarray, owner: np.ndarray, place: np.ndarray, width: int, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, document positions, item positions) of the seeds of each item that they can cover to ``percent``.

        ``first`` and ``last`` bound the block's seeds that equal the document's seed at ``at``. Every seed of the
        block is taken once, however often the document has it, and what an item's seeds cover together bounds what
        tiles can cover; only the items within reach are paired with every place in the document.
        """
        starts, group = np.unique(first, return_inverse=True)  # one start per distinct seed
        stops = np.zeros(len(starts), np.int64)
        stops[group] = last
        seed, seed_of = _ranges(starts, stops - starts)
        order = np.lexsort((place[seed], owner[seed]))
        seed, seed_of = seed[order], seed_of[order]
        items, spots = owner[seed], place[seed]
        edges = np.flatnonzero(np.diff(items, prepend=-1))
        reach = np.full(len(seed), width)
        same = items[1:] == items[:-1]
        reach[:-1][same] = np.minimum(width, spots[1:] - spots[:-1])[same]
        near = np.add.reduceat(reach, edges) * 100 >= percent * self.sizes[items[edges]]
        keep = np.repeat(near, np.diff(edges, append=len(seed)))
        seed, seed_of = seed[keep], seed_of[keep]
        if not len(seed):
            return
        by_seed = np.argsort(group, kind="stable")  # the document's places, seed by seed
        times = np.bincount(group, minlength=len(starts))
        where, pick = _ranges((np.cumsum(times) - times)[seed_of], times[seed_of])
        items, item_at, doc_at = owner[seed][pick], place[seed][pick], at[by_seed[where]]
        edges = np.flatnonzero(np.diff(items, prepend=-1))  # the seeds are in the order of the items still
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(items)], strict=True):
            yield int(items[a]), doc_at[a:b], item_at[a:b]


def _blocks(items: DataFrame) -> Iterator[DataFrame]:
    """``items`` in blocks that hold ``BLOCK_BYTES`` of text at most, or a single item."""
    sized = items.withColumn("bytes", F.octet_length("text"))
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_BYTES))
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        over = sized.groupBy(block.alias("block")).agg(F.sum("bytes").alias("b"), F.countDistinct("text").alias("c")).where(F.col("b") > BLOCK_BYTES).where("c > 1")
        if not over.limit(1).count():
            break
        n *= 2
    for k in range(n):
        yield items.where(block == k)


def matches(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, percent: int = PERCENT) -> DataFrame:
    """A row per document and item that contaminates it: ``doc_id, item_id, item_tokens, covered, tiles, longest``."""
    slim = ship(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    out = None
    for block in _blocks(bench):
        rows = [(r["item_id"], r["text"].encode("utf-8")) for r in block.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows, min_tile))

        def compare(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in slices(batches, 500):
                ids = column(batch, "doc_id")
                best: dict[tuple[int, int], tuple] = {}
                for r, item, *rest in shared.value.match(binary_column(batch, "text"), hashes, percent):
                    old = best.get((r, item))
                    if old is None or rest[1] * old[0] > old[1] * rest[0]:
                        best[r, item] = tuple(rest)
                found = [(ids[r], item, *rest) for (r, item), rest in best.items()]
                columns = list(zip(*found, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "item_tokens", "covered", "tiles", "longest"])

        part = slim.mapInArrow(compare, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, percent: int = PERCENT) -> DataFrame:
    """The documents that no item contaminates."""

    def clean(rows: DataFrame, key: str) -> DataFrame:
        found = matches(rows.select(F.col(key).alias("doc_id"), "text"), benchmark, min_tile, percent)
        found = stored(found.select(F.col("doc_id").alias("_id")).distinct(), "leaks")
        return rows.join(found, F.col(key) == F.col("_id"), "left_anti")

    named, nameless = clean(docs.where("doc_id is not null"), "doc_id"), docs.where("doc_id is null")
    if not nameless.limit(1).count():
        return named
    keyed = stored(nameless.withColumn("_row", F.monotonically_increasing_id()), "nameless")
    return named.unionByName(clean(keyed, "_row").drop("_row"))
