"""Quality rules, line dedup, near dedup and substring dedup on awkward documents, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import xxhash
from llm_cases import documents, jaccard_groups, kept_lines, words

from ledgerlark.llm import line_dedup, near_dedup, quality_rules, queries, substring_dedup


def test_quality_counts(docs, no_docs):
    got = [r.asDict() for r in quality_rules.judge(docs).collect()]
    assert len(got) == len(documents()) and quality_rules.judge(no_docs).count() == 0
    for r in got:
        w = words(r["text"])
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        lines = [x for x in (r["text"] or "").split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r["text"] or ""), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (not r["failed_rules"])


def test_keep_good_returns_the_columns(docs):
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_cuckoo_filter_inserts_and_deletes():
    keys = [xxhash.xxh3_128_digest(str(i)) for i in range(20_000)]
    f = line_dedup.CuckooFilter(capacity=10_000)
    assert f.insert(keys[:10_000]) and f.contains(keys[:10_000]).all()
    assert f.contains(keys[10_000:]).mean() < 0.01
    f.delete(keys[:5_000])
    assert f.contains(keys[5_000:10_000]).all() and f.contains(keys[:5_000]).mean() < 0.01
    again = line_dedup.CuckooFilter(f.table.tobytes())
    assert (again.table == f.table).all()
    assert not line_dedup.CuckooFilter(capacity=8).insert(keys[:2_000])


def test_line_dedup(docs, no_docs):
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup(docs).collect())
    assert got == kept_lines(documents())
    assert line_dedup.dedup(no_docs).count() == 0


def test_line_store_is_reversible(spark):
    """Insert, insert, delete: the store always drops what a new one over the same documents would."""
    rng = random.Random(3)
    pool = [f"a line that several documents share, number {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.sample(pool, 6) + [f"own {i}"])) for i in range(60)]
    make = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    store = line_dedup.LineStore.empty(spark, keys_per_shard=16)
    live = []
    for step, part in (("+", rows[:20]), ("+", rows[20:60]), ("-", rows[5:50]), ("+", rows[10:15])):
        live = live + part if step == "+" else [r for r in live if r not in part]
        store = store.insert(make(part)) if step == "+" else store.delete(make(part))
        got = sorted((r["doc_id"], r["text"]) for r in line_dedup.without_lines(make(live), store.drops()).collect())
        assert got == kept_lines(live)
    assert store.shards > 1 and store.filters.count() == store.shards


def test_repeated_and_missing_doc_ids(spark):
    """Rows that share a doc_id are one document, within an insert and over several; a row without one keeps its lines."""
    a, b, c = ("the first long line of them", "another long line, the second", "a third long line, held by few")
    rows = [(1, a), (2, a), (2, a), (3, b), (4, f"{b}\n{a}"), (4, b), (5, b), (5, c), (5, c), (6, c)]
    make = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup(make(rows)).collect())
    assert got == kept_lines(rows) and len(got) == len(rows) and (3, "") in got and (6, c) in got
    nameless = line_dedup.dedup(make([*rows[:2], (None, a), (None, a)])).collect()
    assert all(r["text"] == a for r in nameless) and len(nameless) == 4
    store = line_dedup.LineStore.empty(spark).insert(make(rows[:3])).insert(make([(2, a), (2, b)]))
    assert {r["n_docs"] for r in store.refs.collect()} == {1, 2} and store.drops().count() == 0
    store = store.insert(make([(7, a)]))
    assert {r["doc_id"] for r in store.drops().collect()} == {1, 2}
    assert store.delete(make([(2, "")])).drops().count() == 0


def test_repeated_doc_ids_match_sql(spark, tmp_path):
    """The queries of op5 and op10 on a table with repeated doc_ids (for op10, of equal texts): a row for each row, as in their SQL."""
    line = "a long line that several documents hold"
    rows = [(1, line), (2, line), (2, line), (3, f"{line}\nmore"), (3, "more"), (4, None)]
    words = " ".join(f"w{i}" for i in range(70))
    rows += [(5, words), (6, "x " + words), (6, "x " + words), (7, words), (7, words)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op5_line_dedup", "op10_substring_dedup"):
        want = con.execute(queries.SQL[name]).df()
        got = queries.QUERIES[name](spark, str(tmp_path)).toPandas()[list(want.columns)]
        key = lambda df: sorted(df.itertuples(index=False, name=None))
        assert key(got) == key(want) and len(got) == len(rows)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 1000).astype(np.uint64)
    two = np.concatenate([one[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    same = np.mean([(near_dedup.sketch(one ^ np.uint64(s)) == near_dedup.sketch(two ^ np.uint64(s))).mean() for s in range(8)])
    assert abs(same - 800 / 1200) < 0.06
    for n in (1, 3, 50):  # small sets fill every coordinate as well
        s = near_dedup.sketch(one[:n])
        assert len(s) == near_dedup.COORDINATES and (s != np.uint64(2**64 - 1)).all()


def test_band_rows_keep_the_miss_small():
    for percent in (70, 80, 85, 95):
        r = near_dedup.band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (near_dedup.COORDINATES // r) <= near_dedup.MISS


def test_near_duplicates(docs, no_docs):
    for width, percent in ((3, 85), (5, 80)):
        got = near_dedup.near_duplicates(docs, width, percent).collect()
        want = jaccard_groups({r[0]: r[1] for r in documents()}, width, percent)
        assert len(got) == len(documents())
        assert all(r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_in_crowded_buckets(spark):
    """Many variants of one text around the threshold: hubs alone do not settle them."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = rng.choice(["p", "q", f"n{rng.randrange(30)}"])
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_groups(dict(rows), 3, 85)
    assert len(set(want.values())) > 5
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, 3, 85).collect()}
    assert got == want


def test_one_of_each_returns_the_columns(docs):
    left = near_dedup.one_of_each(docs)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()


def _without_repeats(rows, window=50):
    first: dict[tuple, int] = {}
    own = [(doc, words(text)) for doc, text, *_ in rows]
    for doc, w in own:
        for k in range(len(w) - window + 1):
            at = tuple(w[k : k + window])
            first[at] = min(doc, first.get(at, doc))
    out = []
    for doc, w in own:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < doc for j in range(window)}
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_substring_dedup(docs, no_docs):
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.without_repeats(docs).collect())
    assert got == _without_repeats(documents())
    assert substring_dedup.without_repeats(no_docs).count() == 0


def test_substring_dedup_of_mixed_passages(spark):
    """Passages in changing company, also repeated inside a text, so that hubs do not hold every window."""
    rng = random.Random(4)
    pool = [[f"p{k}_{i}" for i in range(rng.choice((30, 55, 80)))] for k in range(6)]
    loop = ["x", "y"] * 60
    rows = []
    for i in range(40):
        parts = [rng.choice(pool) for _ in range(rng.randrange(1, 5))] + ([loop] if i % 5 == 0 else [])
        rng.shuffle(parts)
        rows.append((i, " ".join(w for p in parts for w in (*p, *([f"u{i}"] if rng.random() < 0.5 else [])))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.without_repeats(df).collect())
    assert got == _without_repeats(rows)
