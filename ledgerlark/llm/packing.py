"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents are tokenized whole, ended with an end id and cut only where longer
than a sequence. The shorter pieces are dealt to shards by a hash; each shard
places its pieces one after another, each where the sum over the residual gaps
of the squared number of open sequences becomes smallest. A shard keeps one
counter per gap and one queue of open sequences per gap, so its memory is set
by ``shard_pieces`` and by the sequence length, not by the corpus.

Defined results: a null or empty text is one piece holding the end id alone;
an empty table gives an empty result; repeated rows are packed one by one;
pieces are placed in the order of a hash of (doc_id, piece, crc), as the rule is
made for lengths that come in no order; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import binary_column, column, lower_ascii, ship, slices, stored

SEQUENCE = 2048
#: Pieces in a shard, about; each shard ends with a few part-filled sequences.
SHARD_PIECES = 100_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Ids(dict):
    """Token ids of white-space-free chunks as little-endian bytes.

    The tokenizer lower-cases, never joins characters across ASCII white space
    and drops white space itself, so the ids of a text are those of its
    lower-cased chunks in order. The first ``keep`` chunks stay (frequent ones
    come early); the others are encoded again where they return.
    """

    def __init__(self, path: str, keep: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encoded(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters alone are encoded in one go and cut at the word ends; the others one by one."""
        texts = [c.decode("utf-8") for c in chunks]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        out = {}
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["\n".join(texts[i] for i in some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                raw, to = ids.tobytes(), (4 * cuts).tolist()
                out.update((chunks[i], raw[x:y]) for i, x, y in zip(some, [0, *to], to, strict=False))
        rest = [i for i, c in enumerate(chunks) if c not in out]
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            found = self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)
            out.update((chunks[i], np.asarray(e.ids, "<u4").tobytes()) for i, e in zip(some, found, strict=True))
        return out

    def _learned(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks that are not kept. A full stop or comma after a letter a-z is a token run of its own."""
        split = {c: c[:-1] for c in chunks if c[-1:] in (b",", b".") and c[-2:-1].islower()}
        need = {split.get(c, c) for c in chunks}
        if split:
            need |= {b",", b"."}
        new = self._encoded([c for c in need if c not in self])
        last = {c: new.get(c) or self.get(c) for c in (b",", b".")}
        new.update([(c, (new.get(base) or self[base]) + last[c[-1:]]) for c, base in split.items()])
        if len(self) < self.keep:
            self.update(new)
        return new

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; texts are taken together to encode many new chunks at once."""
        split = [(t if b"<|" in t else lower_ascii(t)).split() for t in texts]
        found = [list(map(self.get, chunks)) for chunks in split]
        gaps = [[i for i, x in enumerate(row) if x is None] if None in row else [] for row in found]
        missing = {chunks[i] for chunks, at in zip(split, gaps, strict=True) for i in at}
        new = self._learned(missing) if missing else {}
        for chunks, row, at in zip(split, found, gaps, strict=True):
            for i in at:
                row[i] = new[chunks[i]]
        return [b"".join(row) for row in found]


@lru_cache(maxsize=1)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def tokenized(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``. ``tokenizer`` is the path of a tokenizer file."""
    end, step = np.asarray([end_id], "<u4").tobytes(), 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _ids(tokenizer)
        for batch in slices(batches, 500):
            rows: list[tuple[int, int, int, int, int]] = []
            for doc, ids in zip(column(batch, "doc_id"), cache.of(binary_column(batch, "text")), strict=True):
                ids += end
                rows += [(doc, k, k * length, len(x := ids[at : at + step]) // 4, zlib.crc32(x)) for k, at in enumerate(range(0, len(ids), step))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return ship(docs).select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def place(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares placement, in the given order: (number of the sequence, offset in it) of each piece.

    Taking a sequence from gap g to gap g - s changes the sum of squares by
    2 * (N[g - s] - N[g] + 1); a new one by 2 * N[size - s] + 1; a sequence
    that becomes full leaves the sum. Ties go to the smallest gap.
    """
    n = np.zeros(size + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    used = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    big = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        from_gap, to_gap = n[s:size], n[: size - s]  # gaps s .. size-1 hold the piece
        best, change = size, (2 * int(n[size - s]) + 1 if s < size else 0)
        if size > s:
            delta = np.where(from_gap > 0, 2 * (to_gap - from_gap) + 2, big)
            delta[0] = 1 - 2 * int(n[s]) if n[s] else big  # full: the gap vanishes
            k = int(delta.argmin())
            if delta[k] <= change:
                best = s + k
        if best < size:
            number = open_at[best].pop()
            n[best] -= 1
        else:
            number, used = used, used + 1
        bins[i], offsets[i] = number, size - best
        gap = best - s
        if gap:
            open_at[gap].append(number)
            n[gap] += 1
    return bins, offsets


def pack(pieces: DataFrame, length: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (columns of :func:`tokenized`)."""
    pieces = stored(ship(pieces), "pieces")
    short = pieces.where(F.col("length") < length)
    shards = max(1, -(-short.count() // shard_pieces))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id", "piece", "ids_crc32"], kind="stable")
        bins, offsets = place(rows["length"].to_numpy(), length)
        # odd numbers for shared sequences, even ones for whole pieces: no number is used twice
        return rows.assign(sequence_id=(bins * shards + key[0]) * 2 + 1, offset=offsets).drop(columns=["shard", "turn"])

    result = PIECES + ", sequence_id bigint, offset bigint"
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    dealt = dealt.withColumn("turn", F.xxhash64("ids_crc32", "doc_id", "piece"))
    packed = dealt.groupBy("shard").applyInPandas(fill, result)
    whole = pieces.where(F.col("length") >= length)
    whole = whole.withColumn("sequence_id", F.monotonically_increasing_id() * 2).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = 0, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    return pack(tokenized(docs, tokenizer, length, end_id), length, shard_pieces)
