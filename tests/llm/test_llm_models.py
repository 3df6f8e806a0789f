"""Decontamination, language identification, personal data, quality classifier, packing, url rules and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, jaccard_groups, prose
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlark.llm import decontamination, language_id, packing, pii, quality_classifier, url_rules
from ledgerlark.llm.queries import TOKENIZER, URL_RULES

SF = "/root/testdata/sf0.001"


def test_running_hashes_are_those_of_each_window():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 300).astype(np.uint64)
    x[100:110] = x[200:210]
    h = decontamination.running_hashes(x, 10)
    assert h[100] == h[200] and len(set(h.tolist())) == len(h) - 1
    assert len(decontamination.running_hashes(x[:4], 10)) == 0


def test_decontamination_catches_reordered_passages(spark, no_docs):
    rng = random.Random(9)
    item = prose(rng, 40).split()
    halves = " ".join(item[20:]) + " filler " + " ".join(item[:20])
    partial = " ".join(item[:12])
    docs = spark.createDataFrame(
        [(1, prose(rng, 300) + " " + " ".join(item).upper() + "!"), (2, "x " + halves + " y"), (3, prose(rng, 500)), (4, partial + " " + prose(rng, 50)), (5, None), (6, ""), (2, "x " + halves + " y")],
        "doc_id int, text string",
    )
    bench = spark.createDataFrame([(10, " ".join(item)), (11, prose(rng, 30)), (12, None), (13, ""), (14, "short one")], "item_id int, text string")
    got = sorted((r["doc_id"], r["item_id"], r["tiles"]) for r in decontamination.matches(docs, bench).collect())
    assert got == [(1, 10, 1), (2, 10, 2), (2, 10, 2)]
    left = decontamination.without_leaks(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6] and left.columns == docs.columns
    assert decontamination.matches(no_docs, bench).count() == 0
    assert decontamination.matches(docs, bench.limit(0)).count() == 0


def test_decontamination_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(decontamination.matches(docs, bench).collect())
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 3000)
    assert sorted(decontamination.matches(docs, bench).collect()) == whole


def test_language(spark, docs, no_docs):
    rng = random.Random(1)
    vocabulary = {"aa": ["zug", "über", "straße", "wald"], "bb": ["rivière", "forêt", "été", "chemin"]}
    rows = [(i, " ".join(rng.choice(v) for _ in range(rng.randrange(1, 60))), lang) for lang, v in vocabulary.items() for i in range(60)]
    rows += [(200, None, "aa"), (201, "12 34", "bb"), (202, "zug", None)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    test = spark.createDataFrame([(1, "über den Wald", "x"), (2, "forêt été", "x"), (3, None, "x"), (4, "123 !?", "x"), (5, "", "x"), (6, "wald " * 50_000, "x")], "doc_id int, text string, lang_pred string")
    got = {r["doc_id"]: r for r in language_id.predict(test, model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["aa", "bb", "und", "und", "und", "aa"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[3]["score"] == 0
    assert language_id.predict(docs, model).count() == len(documents()) and language_id.predict(no_docs, model).count() == 0
    assert language_id.fit(no_docs.selectExpr("doc_id", "text", "'x' as lang")) is None
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"))
    out = language_id.predict(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"), model).toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95


def test_classifier_chunks_cover_the_text():
    for n in (0, 1, 448, 512, 513, 5000, 100_000):
        text = bytes(i % 251 for i in range(n))
        part = quality_classifier.chunks(text)
        step = quality_classifier.CHUNK - quality_classifier.OVERLAP
        seen = {k * step + i for k, row in enumerate(part) for i in np.flatnonzero(row < 256).tolist()}
        assert seen == set(range(n))
    w = quality_classifier._start(np.random.default_rng(0))
    w["out"][:] = 1
    text = bytes(i % 251 for i in range(100_000))
    top = np.tanh(quality_classifier.responses(quality_classifier.chunks(text), w)[0])
    z = quality_classifier.combined(top) @ w["out"]
    assert quality_classifier.probability(text, w) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_classifier_gradient():
    rng = np.random.default_rng(3)
    w = {k: v.astype(np.float64) for k, v in quality_classifier._start(rng).items()}
    w["out"] = rng.normal(0, 0.3, w["out"].shape)
    docs = [rng.integers(0, 256, (n, quality_classifier.CHUNK)).astype(np.int16) for n in (1, 3)]
    y = np.array([1.0, 0.0])

    def loss() -> float:
        z = [quality_classifier.combined(np.tanh(quality_classifier.responses(d, w)[0])) @ w["out"] + w["base"][0] for d in docs]
        return float(np.mean([np.log1p(np.exp(-v if t else v)) for v, t in zip(z, y, strict=True)]))

    grad = quality_classifier._slopes(docs, y, w)
    for k in ("out", "filters", "bias", "embed"):
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old, eps = w[k][at], 1e-5
        w[k][at] = old + eps
        up = loss()
        w[k][at] = old - eps
        down = loss()
        w[k][at] = old
        assert grad[k][at] == pytest.approx((up - down) / (2 * eps), rel=1e-2)


def test_classifier_held_out(spark, docs, no_docs):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    mine = "crc32(cast(cast(doc_id as string) as binary)) % 4"
    w = quality_classifier.fit(table, labels.where(f"{mine} <> 2"))
    out = quality_classifier.score(table.where(f"{mine} = 2"), w).join(labels, "doc_id").toPandas()
    rank = out["score"].rank()
    good = out["quality"] == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.9
    scored = quality_classifier.score(docs, w).collect()
    assert len(scored) == len(documents()) and all(0 <= r["score"] <= 1 for r in scored)
    assert quality_classifier.score(no_docs, w).count() == 0
    none = quality_classifier.fit(table, labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(docs, none).collect()} == {0.5}


SPANS = [
    ("plain a.b@c.de and 10.0.0.1", ["a.b@c.de", "10.0.0.1"]),
    ("mail john dot doe (at) example [dot] com now", ["john dot doe (at) example [dot] com"]),
    ("reach jane.smith at example dot org, ok", ["jane.smith at example dot org"]),
    ("call plus one five five five, two three four five six seven eight today", ["plus one five five five, two three four five six seven eight"]),
    ("card four one one one 1111 1111 1111 x", ["four one one one 1111 1111 1111"]),
    ("é ４１１１１１１１１１１１１１１１ é", ["４１１１１１１１１１１１１１１１"]),
    ("jоhn@exаmple.com", ["jоhn@exаmple.com"]),
    ("jo​hn@example.com", ["jo​hn@example.com"]),
    ("ip one nine two dot one six eight dot one dot one.", ["one nine two dot one six eight dot one dot one"]),
    ("he was at home dot and the end, one two three", []),
    ("300.1.1.1 4111111111111112 +1 23", []),
]


@pytest.mark.parametrize(("text", "want"), SPANS)
def test_pii_spans(text, want):
    plain = pii.plain_spans(text)
    spans = plain + pii.disguised_spans(text, plain)
    got = [text[a:b] for a, b, _ in pii._listed(spans)]
    assert [x for x in want if x not in got and x.lstrip("jo​") not in got] == [] and len(got) == len(want)


def test_pii_table(spark, docs, no_docs):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SPANS)] + [(90, None), (91, "x" * 200_000 + " a@b.co")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in pii.find(rows).collect()}
    assert [(s["start"], s["end"], s["kind"]) for s in got[0]["spans"]] == [(6, 14, "email"), (19, 27, "ip")]
    assert got[90]["spans"] == [] and got[91]["spans"][0]["start"] == 200_001
    assert len(got[1]["plain"]) == 0 and len(got[1]["spans"]) == 1
    assert pii.find(docs).count() == len(documents()) and pii.find(no_docs).count() == 0


def test_sum_of_squares_rule():
    """Against the rule written out: try every gap, add up the squares."""
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 33, 300)
    bins, offsets = packing.place(sizes, 32)
    gaps: dict[int, int] = {}
    for s, b, o in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        counts = Counter(g for g in gaps.values() if g)
        value = lambda c: sum(v * v for g, v in c.items() if g)
        options = [(value(counts - Counter([g]) + Counter([g - s])), g) for g in counts if g >= s] + [(value(counts + Counter([32 - s])), 32)]
        assert gaps.get(b, 32) == 32 - o and gaps.get(b, 32) >= s
        assert value(counts - Counter([gaps[b]] if b in gaps else []) + Counter([gaps.get(b, 32) - s])) == min(options)[0]
        gaps[b] = gaps.get(b, 32) - s


def test_packing_round_trip(docs, no_docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = [r.asDict() for r in packing.pack_documents(docs, TOKENIZER, shard_pieces=8).collect()]
    want = Counter()
    for doc, text, *_ in documents():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[doc, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(no_docs, TOKENIZER).count() == 0


def test_tokens_of_strange_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["It's a DON'T, e.g. 'S 3.14!!", "<|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>", "ÀÉ́ é İstanbul ΣΑΣ ﬁ", "a b c\x1cd\x85e", "日本語 😀👍🏽 ½", "a,b. c., d.. E,", "́x ́,"]
    for keep in (0, 1000):
        ids = packing._Ids(TOKENIZER, keep)
        for _ in range(2):
            got = [np.frombuffer(x, "<u4").tolist() for x in ids.of([t.encode() for t in texts])]
            assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


URLS = [
    ("http://A.Example.com/en/1?x=1#f", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/2", "x.www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("http://b.net/es/", "b.net", "/es/", "net/es/", "block"),
    ("http://b.net/es", "b.net", "/es", None, "allow"),
    ("http://myexample.com/en/", "myexample.com", "/en/", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://a.com?q=/en/", "a.com", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://net/fr/x", "net", "/fr/x", "net/fr/", "block"),
    ("http://a.org/p#://b.net/es/", "a.org", "/p", None, "allow"),
]


def test_fixed_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id int, url string, host string")
    none = url_rules.mine(spark.createDataFrame([], "url string, verdict string"))
    got = {r["page_id"]: r for r in url_rules.judge(pages, none, URL_RULES).collect()}
    for i, (_, *want) in enumerate(URLS):
        assert [got[i][c] for c in ("host", "path", "rule", "verdict")] == want
    assert url_rules.judge(pages.limit(0), none, URL_RULES).count() == 0


def test_mined_url_rules_match_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        host = rng.choice(["ads.site.org", "news.site.org", "cdn.other.org"])
        way = rng.choice(["casino", "story", "page"])
        bad = (host.startswith("ads") or way == "casino") and rng.random() < 0.9
        rows.append((f"http://{host}/{way}/{i}" + rng.choice(["", "?ref=x"]), "block" if bad else "allow"))
    rows += [(None, "block"), ("x", "allow"), ("http://a.b/", None)]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    rules = url_rules.mine(labelled, 0.02, 0.8)
    sets = [(set(r["t"]), r["verdict"]) for r in url_rules.with_tokens(labelled).selectExpr("tokens as t", "verdict").collect() if r["t"] and r["verdict"]]
    found = rules.collect()
    assert found and any("path0=casino" in r["tokens"] for r in found)
    for r in found:
        have = [v for t, v in sets if set(r["tokens"]) <= t]
        assert r["support"] == have.count(r["verdict"]) >= 0.02 * len(sets) and r["confidence"] == pytest.approx(have.count(r["verdict"]) / len(have))
        assert r["confidence"] >= 0.8
    pages = labelled.select("url")
    for r in url_rules.with_tokens(url_rules.judge(pages, rules)).selectExpr("url", "tokens as t", "verdict", "mined_rule").collect():
        fits = [x for x in found if set(x["tokens"]) <= set(r["t"] or [])]
        best = max(fits, key=lambda x: (x["confidence"], x["support"], len(x["tokens"]), x["rule"], x["verdict"]), default=None)
        assert (r["mined_rule"], r["verdict"]) == ((best["rule"], best["verdict"]) if best else (None, "allow"))


def test_pipeline_stages(spark):
    """Every stage against what its operator is to leave, on the whole small table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left
        left = stage(spark, before, SF)
        assert left.columns == docs.columns, name
        rows = {r["doc_id"]: r["text"] for r in left.collect()}
        if name == "minhash_near_dedup":
            groups = jaccard_groups({r["doc_id"]: r["text"] for r in before.collect()}, 5, 80)
            assert set(rows) == {i for i, g in groups.items() if i == g}
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(rows)
    assert Counter(corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()) == Counter(packed.select("doc_id", "piece", "ids_crc32").collect())
    assert left.where("n_chars <> length(text)").count() == 0
