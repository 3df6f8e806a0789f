"""Tiles: items are dealt to cells of integer coordinates, and only tiles whose cells can match meet.

A coordinate is a count that a match changes by a bounded amount at most (bits
set in a part of a fingerprint, letters of one kind in a word), so the cells
that a cell can match are a fixed list of steps away. A crowded cell is cut into
several tiles. Two tiles that meet are one row; comparing their items is up to the task.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import stored, with_heavy_split

#: Items of a cell on average at least: a finer cut costs more in tiles than it saves in comparisons.
CELL_ITEMS = 64
#: Meetings of a task: at least, while there are partitions to fill, and about at most.
FEW, MANY = 32, 4000


def finest_cells(items: DataFrame, cells: dict[int, Column], least: int = CELL_ITEMS) -> int:
    """The largest key of ``cells`` whose cells hold ``least`` items on average, or the smallest key.

    Only the amount of work depends on it: any choice finds the same matches.
    """
    kinds = sorted(cells)
    counted = items.agg(F.count("*").alias("n"), *[F.approx_count_distinct(cells[k]).alias(f"c{k}") for k in kinds]).first()
    return max([k for k in kinds if counted["n"] >= least * counted[f"c{k}"]], default=kinds[0])


def tiles_of(items: DataFrame, load: Column, capacity: int, columns: list[str]) -> DataFrame:
    """``cell, slice`` and a list per column: tiles of items whose ``load`` adds up to about ``capacity``.

    Inside a tile the items ascend by the first of the ``columns``, which also deals a crowded cell's items to its tiles.
    """
    counts = stored(items.groupBy("cell").agg(F.count("*").alias("_n"), F.sum(load).alias("_load")), "cells")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    parts = counts.select("cell", "_n", F.ceil(F.col("_load") / capacity).cast("int").alias("_parts"))
    dealt = with_heavy_split(items, parts, "cell", "_n", total)
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64(columns[0]), F.col("_parts")).cast("int"))
    listed = dealt.groupBy("cell", "slice").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_x"))
    return stored(listed.select("cell", "slice", *[F.col("_x")[c].alias(c) for c in columns]), "tiles")


def meetings(tiles: DataFrame, steps: Iterable[tuple[int, ...]]) -> DataFrame:
    """``x_*`` and ``y_*`` of the columns of every two tiles whose cells are the same or a step apart.

    ``steps`` holds each step and its opposite. Each pair of tiles comes once, a
    tile with itself too. The cell that a step leads to is found by equality.
    A row is small and its work is not, so the number of tasks follows from the
    number of rows, not from their bytes.
    """
    ways = sorted({s for s in steps if s >= tuple(-x for x in s)})
    names = tiles.select("cell", "slice")
    ahead = F.explode(F.from_json(F.lit(json.dumps(ways)), "array<array<int>>")).alias("step")
    led = names.select("cell", "slice", ahead).withColumn("to", F.zip_with("cell", "step", lambda a, b: a + b)).drop("step")
    there = names.select(F.col("cell").alias("to"), F.col("slice").alias("to_slice"))
    pairs = led.join(there, "to").where((F.col("cell") != F.col("to")) | (F.col("slice") <= F.col("to_slice")))
    pairs = pairs.select(*[F.col(a).alias(b) for a, b in (("cell", "x_cell"), ("slice", "x_slice"), ("to", "y_cell"), ("to_slice", "y_slice"))])
    pairs = stored(pairs, "pairs")
    n = pairs.count()
    tasks = max(1, min(-(-n // FEW), int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-n // MANY))
    side = lambda s: tiles.select(*[F.col(c).alias(f"{s}_{c}") for c in tiles.columns])
    met = pairs.join(side("x"), ["x_cell", "x_slice"]).repartition(tasks, "y_cell", "y_slice")
    return met.join(side("y").repartition(tasks, "y_cell", "y_slice"), ["y_cell", "y_slice"])
