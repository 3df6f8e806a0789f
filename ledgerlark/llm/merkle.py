"""Merkle manifest of a dataset, kept as a persistent tree that is changed by path copying.

A document is a leaf: the digest of its fields. Per source the leaves ascend by
doc_id; every ``FANOUT`` consecutive nodes become one until a subroot is left,
and the subroots, ordered by source, become the root the same way.

The tree is cut into aligned blocks of ``BLOCK`` nodes, which hold all nodes of
two levels; a block is one row and one small tree in a task, its top a node of
the next, smaller table of blocks, and so on until one block per source is left.
Going down again, a block learns the siblings that its top meets on the way to
the root. A tampered leaf makes a version: within its block only the ancestors
of the leaf are copied, every other node is shared with the tree before, and
from the block's new top on the copied ancestors follow from the siblings of the
upper blocks. So a version costs a few digests, whatever the size of the tree,
and no block, source or version needs more than one block at once.

Defined results: a null field is ``-``; a null source is a source of its own and
comes first, a null doc_id comes first in its source and is never tampered with
by the query; rows that share source and doc_id are a leaf each, in the order of
their digests; a source of one document has its leaf as subroot, and its leaf's
proof holds only the siblings above; with no sibling at all the proof is the
digest of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import column, ship, slices, stored, with_heavy_split

FANOUT = 16
#: Nodes of a block: two levels of the tree.
BLOCK = FANOUT**2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The way from a node to a root: per level the digests left and right of the path, concatenated.
Path = list[tuple[str, str]]
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@dataclass(frozen=True, slots=True)
class Node:
    """A node that never changes; a changed tree is a new root that shares the nodes it kept."""

    digest: str
    children: tuple[Node, ...] = ()


def levels(n: int) -> int:
    """Levels above ``n`` nodes within one block."""
    return 0 if n <= 1 else 1 if n <= FANOUT else 2


def grown(digests: list[str], height: int) -> Node:
    """The tree of ``height`` levels over the digests."""
    nodes = [Node(d) for d in digests]
    for _ in range(height):
        runs = [tuple(nodes[k : k + FANOUT]) for k in range(0, len(nodes), FANOUT)]
        nodes = [Node(digest(*[x.digest for x in run]), run) for run in runs]
    return nodes[0]


def replaced(root: Node, at: int, leaf: str, height: int) -> Node:
    """The version of the tree whose leaf ``at`` is ``leaf``: copies the leaf's ancestors, shares the rest."""
    if not height:
        return Node(leaf)
    below = FANOUT ** (height - 1)
    k = at // below
    children = root.children[:k] + (replaced(root.children[k], at % below, leaf, height - 1),) + root.children[k + 1 :]
    return Node(digest(*[x.digest for x in children]), children)


def ancestors(root: Node, at: int, height: int) -> list[str]:
    """Digests of the leaf ``at`` and the nodes above it, upwards."""
    if not height:
        return [root.digest]
    below = FANOUT ** (height - 1)
    return [*ancestors(root.children[at // below], at % below, height - 1), root.digest]


def siblings(root: Node, at: int, height: int) -> Path:
    """What stands left and right of the way from the leaf ``at`` to the top, upwards."""
    if not height:
        return []
    below = FANOUT ** (height - 1)
    k = at // below
    beside = ("".join(x.digest for x in root.children[:k]), "".join(x.digest for x in root.children[k + 1 :]))
    return [*siblings(root.children[k], at % below, height - 1), beside]


def climbed(node: str, path: Path) -> list[str]:
    """The ancestors of a node with these siblings, upwards."""
    out = []
    for left, right in path:
        node = digest(left, node, right)
        out.append(node)
    return out


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a document's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    said = []
    for name in FIELDS:
        value = fields[name].cast("string")
        said.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*said).cast("binary"), 256)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 in the order of ``order`` within their ``g``, and ``n``, the rows of ``g``.

    Rows are dealt to tasks by ranges of the whole order, so a large ``g`` is
    spread; what is added up per ``g`` is one count per task.
    """
    sorted_ = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("g", *order)])
    sorted_ = sorted_.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("g", *order)])
    # the place in the task's sorted rows and the task's number, both in one id
    numbered = sorted_.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    numbered = stored(numbered, "sorted")
    spans = numbered.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("g", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    return numbered.join(spans, ["g", "_part"]).select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "n")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``g, block, n, nodes``: the nodes of a block as one list, by ``pos``. ``nodes`` has ``g, n, pos, digest`` and what else goes along."""
    own = F.struct("pos", *[c for c in nodes.columns if c not in ("g", "n", "pos")])
    at = F.floor(F.col("pos") / BLOCK).alias("block")
    return stored(nodes.groupBy("g", at).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(own)).alias("nodes")), "blocks")


def tops_of(blocks: DataFrame) -> DataFrame:
    """``g, block, n, top``: the top digest of every block."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [grown(d, levels(n)).digest for n, d in zip(column(batch, "n"), column(batch, "digests"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.string())], ["g", "block", "n", "top"])

    slim = ship(blocks).select("g", "block", "n", F.col("nodes.digest").alias("digests"))
    return stored(slim.mapInArrow(tops, "g string, block bigint, n bigint, top string"), "tops")


def paths_above(tops: DataFrame) -> DataFrame:
    """``g, block, top_root, path``: the root of ``g`` and the siblings on the way to it, for the top of every block."""
    done = tops.where(F.col("n") <= BLOCK).select("g", "block", F.col("top").alias("top_root"), F.expr(f"cast(array() as {PATH})").alias("path"))
    more = tops.where(F.col("n") > BLOCK)
    if not more.limit(1).count():
        return done
    upper = blocks_of(more.select("g", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"), F.col("top").alias("digest")))
    return done.unionByName(node_paths(upper, paths_above(tops_of(upper))))


def node_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``g, block, top_root, path`` of every node of the blocks; the node's ``pos`` is the block below it."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            g, pos, root, paths = [], [], [], []
            for name, n, where, digests, top, path in zip(*[column(batch, c) for c in ("g", "n", "places", "digests", "top_root", "path")], strict=True):
                tree, height = grown(digests, levels(n)), levels(n)
                upper = [(x["left"], x["right"]) for x in path]
                for at, place in enumerate(where):
                    g.append(name)
                    pos.append(place)
                    root.append(top)
                    paths.append([{"left": a, "right": b} for a, b in siblings(tree, at, height) + upper])
            kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(pos, pa.int64()), pa.array(root, pa.string()), pa.array(paths, kind)], ["g", "block", "top_root", "path"])

    slim = blocks.select("g", "block", "n", F.col("nodes.pos").alias("places"), F.col("nodes.digest").alias("digests")).join(above, ["g", "block"])
    return stored(ship(slim).mapInArrow(listed, f"g string, block bigint, top_root string, path {PATH}"), "paths")


def _versions(blocks: DataFrame) -> DataFrame:
    """A row per leaf of ``blocks`` (with ``subroot``, ``root`` and the ``path`` of the block's top)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            out: list[tuple] = []
            for n, leaves, subroot, root, path in zip(*[column(batch, c) for c in ("n", "nodes", "subroot", "root", "path")], strict=True):
                height = levels(n)
                tree = grown([x["digest"] for x in leaves], height)
                upper = [(x["left"], x["right"]) for x in path]
                for at, x in enumerate(leaves):
                    beside = siblings(tree, at, height) + upper
                    proof = digest(*[part for pair in beside for part in pair])
                    if x["changed"] is None:
                        copied, folded = None, [x["digest"], *climbed(x["digest"], beside)][-1]
                    else:
                        version = replaced(tree, at, x["changed"], height)
                        copied = ancestors(version, at, height)
                        copied += climbed(copied[-1], upper)
                        folded = copied[-1]
                    out.append((x["doc_id"], x["digest"], subroot, root, proof, folded, folded == root, copied))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())]
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copied"]
            columns = zip(*out, strict=True) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"
    return ship(blocks).mapInArrow(made, schema)


def manifest(docs: DataFrame, tampered: Column | None = None, altered: Column | None = None) -> DataFrame:
    """The leaf of every document, the roots, the digest of its proof, and the root that its version has.

    Where ``tampered`` holds, the document's version has the text ``altered``;
    ``copied`` are the nodes which that version has of its own, from the leaf up
    to the root (null where nothing is tampered with). ``folded_root`` is that
    version's root, ``verified`` whether it equals the ``root``.
    """
    fields = {c: F.col(c) for c in FIELDS}
    changed = F.when(tampered, leaf(fields | {"text": altered})) if tampered is not None else F.lit(None).cast("string")
    # null sources come first and are a group like any other; a prefix tells them from the empty name
    g = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(g.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), leaf(fields).alias("digest"), changed.alias("changed"))
    blocks = blocks_of(placed(leaves, ["doc_id", "digest"]))
    above = paths_above(tops_of(blocks))
    sources = stored(above.groupBy("g").agg(F.first("top_root").alias("subroot"), F.count("*").alias("blocks")), "sources")
    roots = placed(sources.select(F.lit("").alias("g"), F.col("g").alias("source"), F.col("subroot").alias("digest")), ["source"])
    upper = blocks_of(roots)
    # the subroots' own way to the root: by place, then by the source at that place
    way = node_paths(upper, paths_above(tops_of(upper))).select(F.col("block").alias("pos"), F.col("top_root").alias("root"), F.col("path").alias("rest"))
    named = upper.select(F.explode("nodes").alias("x")).select("x.pos", F.col("x.source").alias("g"))
    ends = stored(sources.join(named.join(way, "pos"), "g").select("g", "subroot", "blocks", "root", "rest"), "ends")
    total = ends.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    whole = with_heavy_split(above.select("g", "block", "path"), ends, "g", "blocks", total)
    whole = whole.select("g", "block", "subroot", "root", F.concat("path", "rest").alias("path"))
    return _versions(blocks.join(whole, ["g", "block"]))
