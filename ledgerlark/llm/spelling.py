"""Spelling variants: words that differ by one edit, and the frequent form that each is a variant of.

A word is a vector of letter counts (``LETTERS`` kinds of letters, so that some
accented letters share a kind with a plain one). One inserted or deleted letter
moves it by a squared distance of 1, a replaced one by 2 or, within a kind, 0.
Words are dealt to blocks of one length and one count for each of a few classes
of letters; only blocks of equal or adjacent lengths whose counts an edit can
lead to meet. There a matrix product of the two blocks' count vectors gives all
squared distances; pairs at most two apart are verified letter by letter. The
number of counts grows with the vocabulary, so that a block stays small.

Defined results: a null text has no words; a null doc_id counts as empty in the
hash that decides on deletions; rows that share a doc_id all count; of near words
with equal counts the smallest in code-point order is the form; an empty table
gives an empty result; other columns are ignored. A word of any length is one word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import binary_column, column, lower_ascii, ship, slices, stored
from ledgerlark.llm.tiles import finest_cells, meetings, tiles_of

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: A run whose hash is divisible by this loses one letter.
DELETED = 31
LETTERS = 32
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Words of a block's tile, a long word counting for several, and letters that are verified at once.
TILE, LONG, VERIFIED = 1024, 32, 1 << 22
#: Rows of a block that are multiplied at once, so that the product stays in the cache.
STRIP = 128
#: A letter's class is its code point modulo so many; the classes that blocks count, common ones first.
CLASSES, COUNTED_CLASSES = 8, (1, 5, 4, 6, 7, 3, 2)
#: Different words that a task counts before it hands them on.
COUNTED = 300_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def spelled(run: str, seed: int) -> str:
    """The run, less one letter if its hash (continued from that of ``<doc_id>:``) says so."""
    h = zlib.crc32(run.encode(), seed)
    if h % DELETED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()

        def said() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for doc_id, text in zip(column(batch, "doc_id"), binary_column(batch, "text"), strict=True):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(_RUN.findall(lower_ascii(text).decode())).items():
                    if len(run) >= min_length:  # a deletion only shortens
                        words[spelled(run, seed)] += n
            if len(words) > COUNTED:
                yield said()
                words.clear()
        yield said()

    found = ship(docs).select("doc_id", "text").mapInArrow(counted, "word string, n bigint")
    return found.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def block(word: Column) -> Column:
    """Length of the word and how many letters it has of each class but the last; the first so many are a coarser block."""
    of = ["".join(c for c in ALPHABET if ord(c) % CLASSES == k) for k in COUNTED_CLASSES]
    return F.array(F.length(word), *[F.length(word) - F.length(F.translate(word, own, "")) for own in of])


def steps(numbers: int) -> list[tuple[int, ...]]:
    """What one edit can do to the first ``numbers`` numbers of a block; all other letters are told by the length alone."""
    unit = [tuple(int(i == k) for i in range(numbers)) for k in range(numbers)] + [(0,) * numbers]
    found = {tuple(a - b for a, b in zip(one, two, strict=True)) for one in unit for two in unit}
    return sorted({(sum(s), *s[:-1]) for s in found})


def letters(joined: str, n: int) -> np.ndarray:
    """The ``n`` words of a block, all of one length and written one after the other, as a matrix of code points (all below 256)."""
    return np.frombuffer(joined.encode("latin-1"), np.uint8).reshape(n, -1)


def written(codes: np.ndarray) -> list[str]:
    """The words in the rows of a matrix of code points."""
    every, length = codes.tobytes().decode("latin-1"), codes.shape[1]
    return [every[at : at + length] for at in range(0, len(every), length)]


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    at = np.repeat(np.arange(n) * LETTERS, length) + (codes % LETTERS).ravel()
    counts = np.bincount(at, minlength=n * LETTERS).reshape(n, LETTERS)
    return counts.astype(np.float32 if length < 2000 else np.float64)  # products stay exact


def close(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of rows of x and y with squared distance of their letter counts at most two.

    The product of the count vectors, each lengthened by half its squared length
    and one, is 1 less half the squared distance.
    """
    a, b = letter_counts(x), letter_counts(y)
    half_a, half_b = ((c * c).sum(axis=1, keepdims=True) / 2 for c in (a, b))
    a, b = np.hstack([a, 1 - half_a, np.ones_like(half_a)]), np.hstack([b, np.ones_like(half_b), -half_b]).T.copy()
    found = [np.flatnonzero((a[at : at + STRIP] @ b).ravel() >= 0) + at * len(y) for at in range(0, len(x), STRIP)]
    return np.divmod(np.concatenate(found), len(y))


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the words in the rows of x and y, of equal or adjacent lengths, are one edit apart."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(axis=1) == 1
    short, long = (x, y) if x.shape[1] < y.shape[1] else (y, x)
    n = short.shape[1]
    front = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


def near_words(words: DataFrame, numbers: int | None = None) -> DataFrame:
    """``word, near, near_n``: both directions of every two words that are one edit apart. ``words``: ``word, n``."""
    celled = stored(words.withColumn("whole", block(F.col("word"))), "blocks")
    numbers = numbers or finest_cells(celled, {k: F.slice("whole", 1, k) for k in range(1, CLASSES + 1)})
    celled = celled.withColumn("cell", F.slice("whole", 1, numbers))
    tiles = tiles_of(celled, F.ceil(F.col("cell")[0] / LONG), TILE, ["word", "n"])
    tiles = tiles.select("cell", "slice", F.array_join("word", "").alias("letters"), "n")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            of = [batch.column(batch.schema.get_field_index(c)) for c in ("x_letters", "y_letters", "x_n", "y_n", "own")]
            for x_letters, y_letters, x_n, y_n, own in zip(*of, strict=True):
                x, y = (letters(s.as_py(), len(n.values)) for s, n in ((x_letters, x_n), (y_letters, y_n)))
                i, j = close(x, y)
                if own.as_py():  # a tile with itself
                    i, j = i[i < j], j[i < j]
                strip = max(1, VERIFIED // x.shape[1])
                sure = [one_edit(x[i[at : at + strip]], y[j[at : at + strip]]) for at in range(0, len(i), strip)]
                if not sure or not (sure := np.concatenate(sure)).any():
                    continue
                i, j = i[sure], j[sure]
                left, right = written(x[i]), written(y[j])
                near_n = pa.concat_arrays([y_n.values.take(pa.array(j)), x_n.values.take(pa.array(i))])
                yield pa.RecordBatch.from_arrays([pa.array(left + right, pa.string()), pa.array(right + left, pa.string()), near_n], ["word", "near", "near_n"])

    met = meetings(ship(tiles), steps(numbers))
    own = (F.col("x_cell") == F.col("y_cell")) & (F.col("x_slice") == F.col("y_slice"))
    return met.select("x_letters", "y_letters", "x_n", "y_n", own.alias("own")).mapInArrow(compare, "word string, near string, near_n bigint")


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the end of the chain of forms, by doubling the steps."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("on")), "roots")
        roots = moved.select("word", "root")
        if not moved.where("on").limit(1).count():
            return roots


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary.

    ``form`` is the most frequent near word if it occurs ``ratio`` times as often
    or more, else null; ``root`` ends the chain of forms.
    """
    words = stored(vocabulary(docs, min_length, min_count), "vocabulary")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    led = F.col("near_n") >= ratio * F.col("n")
    out = words.join(near, "word", "left").withColumn("near_n", -F.col("best.n"))
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(led, F.col("best.near")).alias("form"), F.when(led, F.col("near_n")).alias("form_n"))
    out = stored(out, "forms")
    roots = roots_of(out.where("form is not null"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
