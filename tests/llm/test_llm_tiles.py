"""SimHash, spelling variants and the Merkle manifest against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import combinations

import llm_cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlark.llm import merkle, near_dedup, simhash, spelling
from ledgerlark.llm.queries import op13_merkle_manifest


def plain_fingerprint(text: str | None) -> int:
    words = [w.translate(llm_cases.UPPER) for w in llm_cases.words(text)]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict[int, int], radius: int) -> dict[int, int]:
    root = {i: i for i in prints}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: top(i) for i in prints}


def test_simhash_is_exact(docs):
    prints = {i: plain_fingerprint(t) for i, t, *_ in llm_cases.documents()}
    want = groups(prints, simhash.RADIUS)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(llm_cases.documents())  # repeated rows stay
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in prints}


def test_simhash_long_text_in_strips(monkeypatch):
    text = llm_cases.prose(random.Random(3), 500).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())


@pytest.mark.parametrize("parts", [1, 3, 8, None])
def test_simhash_tiles_miss_nothing(spark, parts):
    """Chains of flipped bits around a few centres: the same groups however the tiles are cut."""
    rng = random.Random(8)
    centres = [0, (1 << 64) - 1, *[rng.getrandbits(64) for _ in range(40)]]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(25)}
    prints = dict(enumerate(sorted(values)))
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in prints.items()]
    found = simhash.links(spark.createDataFrame(signed, "fp bigint, rep bigint").repartition(4), 3, parts).collect()
    root = np.arange(len(prints))
    root = simhash.merged(root, np.array([r.a for r in found]), np.array([r.b for r in found]))
    assert dict(enumerate(root.tolist())) == groups(prints, 3)


def test_simhash_edge_tables(spark, no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    rows = [(None, "one two three four"), (5, "one two three four"), (None, "alone here"), (4, None), (9, "  ")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted([(None, 5), (5, 5), (None, None), (4, 4), (9, 4)], key=str)


def plain_variants(docs: list[tuple], least: int = 7) -> set[tuple]:
    counts: dict[str, int] = {}
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(llm_cases.UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    kept = {w: n for w, n in counts.items() if n >= 2 and len(w) >= least}

    def edit(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [x for x in kept if abs(len(x) - len(w)) < 2 and edit(w, x)] for w in kept}
    best = {w: min(near[w], key=lambda x: (-kept[x], x), default=None) for w in kept}
    form = {w: b if b and kept[b] >= 10 * kept[w] else None for w, b in best.items()}
    out = set()
    for w in kept:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, kept[w], len(near[w]), form[w], kept.get(form[w]), root))
    return out


def spelled_docs(seed: int = 2) -> list[tuple]:
    rng = random.Random(seed)
    letters = "abcdeáéßxÀ"
    bases = ["".join(rng.choices(letters, k=rng.randrange(6, 12))) for _ in range(40)]
    out = []
    for i in range(120):
        said = []
        for _ in range(60):
            w = bases[min(rng.randrange(40), rng.randrange(40))]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            said.append(w.title() if rng.random() < 0.3 else w)
        out.append((i, " ".join(said)))
    chain = ["verylongword" + "z" * k for k in (0, 1, 2, 3)]  # each ten times rarer: a chain of forms
    out += [(500 + k, " ".join([w] * n)) for k, (w, n) in enumerate(zip(chain, (3000, 300, 30, 3), strict=True))]
    return out + [(None, "nothing but this nothing nothing"), (7, None), (8, ""), out[0], (600, ("a" * 3000 + " ") * 3 + ("a" * 3001 + " ") * 2)]


@pytest.mark.parametrize("numbers", [1, 3, 8, None])
def test_spelling_against_all_pairs(spark, numbers, monkeypatch):
    rows = spelled_docs()
    if numbers:
        monkeypatch.setattr(spelling, "finest_cells", lambda *_: numbers)
    got = spelling.variants(spark.createDataFrame([(*r, -1) for r in rows], "doc_id int, text string, n int").repartition(3))
    got = {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got.collect()}
    want = plain_variants(rows)
    assert got == want
    assert any(w[5] != w[3] and w[3] for w in want)  # a chain is followed


def test_spelling_empty(no_docs):
    assert spelling.variants(no_docs).collect() == []


def test_spelling_edits_at_all_places():
    word = np.frombuffer(b"abacabad", np.uint8)[None, :]
    for k in range(8):
        less = np.delete(word, k, axis=1)
        assert spelling.one_edit(word, less)[0] and spelling.one_edit(less, word)[0]
    assert not spelling.one_edit(word, word)[0]
    assert not spelling.one_edit(word, np.frombuffer(b"bacabad"[::-1], np.uint8)[None, :])[0]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows: list[tuple], tampered) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded, verified) of ``doc_id, source, lang, n_chars, text`` rows."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: h(*map(said, r))

    def tree(nodes: list[str]) -> list[list[str]]:
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
        return out

    own: dict = {}
    for r in rows:
        own.setdefault(r[1], []).append(r)
    order = sorted(own, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(own[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    trees = {s: tree([leaf(r) for r in own[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(own[s]):
            node, beside = leaf((*r[:4], r[4] and r[4].translate(llm_cases.UPPER)) if tampered(r[0]) else r), []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    run, j = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    beside += run[:j] + run[j + 1 :]
                    node, at = h(*run[:j], node, *run[j + 1 :]), at // 16
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], h(*beside), node, node == top[-1][0]))
    return out


MERKLE = "doc_id bigint, source string, lang string, n_chars bigint, text string, root string, pos int"


def merkle_rows() -> list[tuple]:
    rng = random.Random(4)
    rows = [(i, "big", "en", i, f"Text {i}") for i in rng.sample(range(100_000), 4500)]  # three levels of blocks
    rows += [(i, "seventeen", None, None, f"É{i}") for i in range(17)] + [(1, "one", "de", 3, "Bär")]
    rows += [(i, f"s{i}", "en", 1, "A") for i in range(300)]  # more sources than a block
    rows += [(5, None, "en", None, None), (6, None, "en", 0, ""), (None, None, "en", 2, "Ab"), (10, "", "en", 2, "Ab")]
    return rows + [rows[0], rows[0], (rows[0][0], "big", "en", 9, "other")]


def test_merkle_against_whole_tree(spark):
    rows = merkle_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], MERKLE).repartition(5)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = merkle.manifest(df, hit, lowered).collect()
    want = plain_manifest(rows, lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
    assert sorted([tuple(r)[:7] for r in got], key=str) == sorted(want, key=str)
    for r in got:
        if r.copied is not None:
            assert r.copied[-1] == r.folded_root and (r.copied[0] == r.leaf) == r.verified


def test_merkle_shares_untouched_nodes():
    leaves = [h(str(k)) for k in range(200)]
    tree = merkle.grown(leaves, 2)
    version = merkle.replaced(tree, 37, h("x"), 2)
    assert merkle.grown([*leaves[:37], h("x"), *leaves[38:]], 2).digest == version.digest != tree.digest
    shared = [a is b for a, b in zip(tree.children, version.children, strict=True)]
    assert shared.count(False) == 1 and not shared[2]
    assert [a is b for a, b in zip(tree.children[2].children, version.children[2].children, strict=True)].count(False) == 1


def test_merkle_small_tables(spark):
    assert merkle.manifest(spark.createDataFrame([], MERKLE)).collect() == []
    one = merkle.manifest(spark.createDataFrame([(1, "s", "en", 1, "A", "", 0)], MERKLE)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h() and one.verified


def test_merkle_query_columns(spark):
    got = op13_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def template_docs(members: int) -> list[tuple]:
    """Texts of one template: 60 slots of two own words among 600; a few of them are near copies of another."""
    rng = random.Random(members)
    frame = [f"t{k}" for k in range(480)]
    out = []
    for i in range(members):
        words = list(frame)
        for k in range(60):
            words[k * 8 : k * 8] = [f"x{rng.randrange(10**9)}", f"y{rng.randrange(10**9)}"]
        out.append((i, " ".join(words)))
    for i in range(0, members, 10):
        out.append((members + i, out[i][1].replace(" t100 ", " changed ")))
    return out


@pytest.mark.parametrize("percent", [40, 85])
def test_template_texts_are_not_paired_row_by_row(spark, percent):
    rows = template_docs(60)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"), 3, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == llm_cases.jaccard_groups(dict(rows), 3, percent)


def test_common_counts(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 5)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60 if k % 2 else 4000, 80)) for k in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]
    assert near_dedup.common(sets[:25], sets[25:]).tolist() == want


@pytest.mark.parametrize("load", [400_000, 500])
def test_links_within_a_hub(spark, monkeypatch, load):
    monkeypatch.setattr(near_dedup, "TILE_SHINGLES", load)
    rows = template_docs(40)
    members = spark.createDataFrame([(0, i) for i, _ in rows], "hub bigint, id bigint")
    found = near_dedup.links_within(members, spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert {frozenset((r.a, r.b)) for r in found} == {frozenset((40 + i, i)) for i in range(0, 40, 10)}
