"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations, product

import duckdb
import numpy as np
import pytest
from llm_cases import kept_lines, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerlark.llm import decontamination, near_dedup, packing, pii, quality_classifier, queries, url_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def exceptions(spark):
    """Blocked host with a clean path: 40 blocked and 10 allowed pages, besides 50 allowed ones of another host."""
    rows = [(f"http://ads.site.org/{'story' if i < 10 else 'casino' if i < 20 else 'page'}/{i}", "allow" if i < 10 else "block") for i in range(50)]
    rows += [(f"http://news.other.org/{'story' if i < 25 else 'page'}/{i}", "allow") for i in range(50)]
    return spark.createDataFrame(rows, "url string, verdict string")


def test_allow_rules_overrule_block_rules(exceptions):
    rules = url_rules.mine(exceptions, 0.05, 0.6)
    assert {r["verdict"] for r in rules.collect()} == {"allow", "block"}
    for r in url_rules.judge(exceptions.select("url"), rules).collect():
        assert r["verdict"] == ("allow" if "/story/" in r["url"] or "news." in r["url"] else "block")
        assert r["mined_rule"] and r["confidence"] == 1 or r["verdict"] == "block"


def test_rules_for_both_verdicts_on_the_same_tokens(spark):
    rows = [(f"http://a.org/x/{i}", "allow" if i % 2 else "block") for i in range(10)] + [(f"http://b.net/y/{i}", "allow") for i in range(4)]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    got = url_rules.mine(labelled, 0.05, 0.4).collect()
    assert len({(r["rule"], r["verdict"]) for r in got}) == len(got)
    assert {r["verdict"] for r in got if r["rule"] == "path0=x"} == {"allow", "block"}


def test_rule_of_four_tokens(spark):
    """Only scheme, host, path and query together tell a blocked page."""
    ways = product(("http", "https"), ("one.site.org", "two.site.org"), ("x", "y"), ("", "?ref=x"), range(3))
    bad = ("https", "one.site.org", "x", "?ref=x")
    rows = [(f"{s}://{h}/{p}/{i}{q}", "block" if (s, h, p, q) == bad else "allow") for s, h, p, q, i in ways]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    rules = url_rules.mine(labelled, 0.05, 0.6)
    blocked = [r for r in rules.collect() if r["verdict"] == "block"]
    assert blocked and all(len(r["tokens"]) == 4 and r["confidence"] == 1 for r in blocked)
    assert {(r["url"], r["verdict"]) for r in url_rules.judge(labelled.select("url"), rules).collect()} == set(rows)


def test_rules_are_those_of_all_token_sets(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        host = rng.choice(["ads1.site.org:80", "ads2.org.org", "cdn.site.org"])
        way = rng.choice(["x", "y.html"])
        query = rng.choice(["", "?r=1"])
        bad = rng.random() < 0.3 + 0.3 * host.startswith("ads") + 0.2 * (way == "x") - 0.3 * (query == "" and way == "x")
        rows.append((f"{rng.choice(['http', 'https'])}://{host}/{way}{query}", "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    times = Counter()
    for r in url_rules.with_tokens(labelled).collect():
        for n in range(1, len(r["tokens"]) + 1):
            times.update((s, v) for s in combinations(sorted(r["tokens"]), n) for v in (r["verdict"], None))
    sure = {(s, v): n / times[s, None] for (s, v), n in times.items() if v and n >= 0.02 * len(rows)}
    parts = lambda s: (p for n in range(1, len(s)) for p in combinations(s, n))
    want = {(s, v, times[s, v], c) for (s, v), c in sure.items() if c >= 0.55 and all(sure[p, v] < c for p in parts(s))}
    got = {(tuple(r["tokens"]), r["verdict"], r["support"], r["confidence"]) for r in url_rules.mine(labelled, 0.02, 0.55).collect()}
    assert got == want and max(len(s) for s, *_ in want) >= 4


def _spans(text, **options):
    plain = pii.plain_spans(text)
    return [(text[a:b], kind) for a, b, kind in pii._listed(plain + pii.disguised_spans(text, plain, **options))]


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("192[.]168[.]1[.]1", "ip"),
        ("192(dot)168(dot)1(dot)1", "ip"),
        ("192 dot 168 dot 1 dot 1", "ip"),
        ("192 point 168 point 1 point 1", "ip"),
        ("192.168[.]1.1", "ip"),
        ("one nine two (dot) one six eight (dot) one (dot) one", "ip"),
        ("plus 44 20 7946 0958", "phone"),
        ("plus 44 (0)20 7946 0958", "phone"),
        ("plus 1 dot 555 dot 1234567", "phone"),
    ],
)
def test_disguised_dots_and_plus(text, kind):
    assert _spans(f"see {text}, ok") == [(text, kind)]


def test_dots_between_other_numbers_are_no_address():
    for text in ("300 dot 1 dot 1 dot 1", "1 dot 2 dot 3", "version 1 point 2 and 5 plus 3 is 8"):
        assert _spans(text) == []


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("+1 555 five 123 4567", "phone"),
        ("4111 1111 1111 111 one", "card"),
        ("4111 1111 one 111 1111", "card"),
        ("“one” “four 111 1111 1111 1111", "card"),
        ("4111\xa01111\xa01111\xa01111", "card"),
        ("jane [  at  ] example [  dot ] com", "email"),
        ("jane@example[.]com", "email"),
        ("jane at example point com", "email"),
        ("jªne@exºmple.com", "email"),
    ],
)
def test_gate_lets_disguises_through(text, kind):
    got = _spans(f"see {text} ok")
    assert got == _spans(f"see {text} ok", gated=False) and [k for _, k in got] == [kind] and text.endswith(got[0][0])


def test_gate_changes_no_span():
    parts = "one Two FÜNF ZÉRO oh nine 4111 1111 555 192 1 44 dot point (dot) [.] { punkt } plus + at (at) [  at ] @ jane example com org the . , - ( ) “ — é _ º \xa0 \n".split(" ")
    rng, found = random.Random(2), 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "", "  ", "-", ", "]) for _ in range(rng.randrange(3, 16)))
        whole = _spans(text, gated=False)
        assert _spans(text) == whole, text
        found += len(whole) > len(pii.plain_spans(text))
    assert found > 50


def test_classifier_learns_from_every_chunk(monkeypatch):
    texts = [bytes(i % 251 for i in range(n)) for n in (0, 300, 40_000, 9_000)]
    seen, slopes = [], quality_classifier._slopes
    monkeypatch.setattr(quality_classifier, "_slopes", lambda docs, *rest: seen.extend(map(len, docs)) or slopes(docs, *rest))
    w = quality_classifier.train(texts, [0, 1, 0, 1], epochs=1)
    assert sorted(seen) == sorted(len(quality_classifier.chunks(t)) for t in texts) and max(seen) > 64
    docs, y = [quality_classifier.chunks(t) for t in texts], np.array([0, 1, 0, 1], np.float32)
    few = slopes(docs, y, w)
    monkeypatch.setattr(quality_classifier, "_TOGETHER", 10_000)
    for k, v in slopes(docs, y, w).items():
        assert np.allclose(v, few[k], atol=1e-5), k


def test_classifier_memory_does_not_follow_the_text(monkeypatch):
    """Slopes of a batch with a long text are the same whatever is kept of the first pass; no more chunks are made at once than fit."""
    texts = [bytes((i * i + k) % 253 for i in range(n)) for k, n in enumerate((60_000, 0, 5_000, 448, 449, 64))]
    w = quality_classifier._start(np.random.default_rng(2))
    w["out"] = np.random.default_rng(3).normal(0, 0.3, w["out"].shape).astype(np.float32)
    y = np.array([0, 1, 0, 1, 1, 0], np.float32)
    whole = quality_classifier._slopes([quality_classifier.chunks(t) for t in texts], y, w)
    made, chunks = [], quality_classifier.chunks
    monkeypatch.setattr(quality_classifier, "chunks", lambda t: made.append(len(out := chunks(t))) or out)
    monkeypatch.setattr(quality_classifier, "_HELD", 1)
    for k, v in quality_classifier._slopes([quality_classifier.Chunked(t) for t in texts], y, w).items():
        assert np.allclose(v, whole[k], atol=1e-6), k
    assert max(made) == quality_classifier._TOGETHER and sum(made) > 1.4 * sum(len(chunks(t)) for t in texts)
    for t in texts:
        lazily = quality_classifier.Chunked(t)
        assert len(lazily) == len(chunks(t)) and all(np.array_equal(lazily[k : k + 2], chunks(t)[k : k + 2]) for k in range(len(lazily)))


def test_classifier_sample_is_bounded_by_bytes(spark):
    rows = [(i, "é" * 500, i % 2) for i in range(40)] + [(99, None, 1), (98, "", 0)]
    drawn = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    some = quality_classifier._within(drawn, 5_500).collect()
    for q in (0, 1):
        own = [r for r in some if r["quality"] == q]
        assert sum(bool(r["text"]) for r in own) == 6 and all(r["text"] in ("é" * 500, "", None) for r in own)
    assert quality_classifier._within(drawn, 1 << 30).count() == len(rows)


def test_documents_without_an_id(spark):
    """Kept by near dedup; kept or dropped by decontamination for what they hold."""
    rng = random.Random(5)
    item, clean, other = prose(rng, 40), prose(rng, 300), prose(rng, 300)
    rows = [(None, clean), (None, other + " " + item), (1, other), (2, other), (3, prose(rng, 200) + " " + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    key = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    left = near_dedup.one_of_each(docs)
    assert left.columns == docs.columns and key(left) == sorted([r for r in rows if r[0] != 2], key=str)
    assert key(decontamination.without_leaks(docs, bench)) == sorted([rows[0], rows[2], rows[3]], key=str)
    assert decontamination.without_leaks(docs.where("doc_id = 3"), bench).count() == 0


def test_pipeline_keeps_a_clean_document_without_an_id(spark):
    """What stays with its doc_id also stays without."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 30")

    def stages(left):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, sf)
        return left

    one = stages(docs).agg({"doc_id": "min"}).first()[0]
    left = stages(docs.withColumn("doc_id", F.when(F.col("doc_id") != one, F.col("doc_id"))))
    assert left.where("doc_id is null").count() == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sf)
    assert packed.where("doc_id is null and start = 0").count() == 1


def test_packing_is_near_the_lower_bound(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(150, 651, 10_000).tolist()
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(sizes)], packing.PIECES)
    used = packing.pack(pieces).select("sequence_id").distinct().count()
    assert used <= 1.015 * -(-sum(sizes) // 2048)


def _naive_tiling(doc, item, width):
    """(covered, tiles, longest) by looking for the longest free common run again and again."""
    free_d, free_i, sizes = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and free_d[d + n] and free_i[i + n]:
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < width:
            return sum(sizes), len(sizes), max(sizes, default=0)
        free_d[d : d + n], free_i[i : i + n] = [False] * n, [False] * n
        sizes.append(n)


def test_decontamination_against_naive_tiling(spark):
    rng = random.Random(12)
    items = [[f"i{k}x{rng.randrange(12)}" for _ in range(rng.choice((3, 14, 30)))] for k in range(6)]
    docs = []
    for _ in range(40):
        out = []
        for _ in range(rng.randrange(1, 6)):
            item = rng.choice(items)
            at = rng.randrange(len(item))
            out += item[at : at + rng.randrange(3, 25)] + [f"u{rng.randrange(50)}"] * rng.randrange(2)
        docs.append(out)
    want = set()
    for d, doc in enumerate(docs):
        for k, item in enumerate(items):
            covered, tiles, longest = _naive_tiling(doc, item, min(decontamination.MIN_TILE, len(item)))
            if tiles and covered * 100 >= decontamination.PERCENT * len(item):
                want.add((d, k, len(item), covered, tiles, longest))
    frame = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], f"{name} long, text string")
    got = {tuple(r) for r in decontamination.matches(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert got == want and any(r[4] > 1 for r in want)


def _leaked(text, items, width=5, percent=50):
    """Whether a text holds some item, by naive tiling of the items of which enough could be covered at all."""
    doc = re.findall(rb"[a-z0-9\x80-\xff]+", text.encode().lower())
    for item in items:
        own = min(width, len(item))
        grams = {tuple(doc[k : k + own]) for k in range(len(doc) - own + 1)}
        within = {at for k in range(len(item) - own + 1) if tuple(item[k : k + own]) in grams for at in range(k, k + own)}
        if item and 100 * len(within) >= percent * len(item) and 100 * _naive_tiling(doc, item, own)[0] >= percent * len(item):
            return True
    return False


def test_pipeline_filters_against_plain_versions(spark):
    """What the stages for quality, lines and leaks keep of the rows that each gets: SQL, counted lines, naive tiling."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    good = stages["quality_rules"](spark, docs, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = set(con.execute(f"SELECT doc_id FROM ({queries.SQL['op3_quality_rules']}) WHERE kept").df()["doc_id"])
    assert pairs(good) == [p for p in pairs(docs) if p[0] in kept] and 0 < len(kept) < docs.count()
    unrepeated = stages["line_dedup"](spark, good, SF)
    assert pairs(unrepeated) == kept_lines(pairs(good)) != pairs(good)
    benchmark = [r["text"] or "" for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().lower()) for t in benchmark]
    clean = stages["benchmark_decontamination"](spark, unrepeated, SF)
    assert pairs(clean) == [p for p in pairs(unrepeated) if not _leaked(p[1], items)] != pairs(unrepeated)


def _registered(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF).collect()]


def _kept_out(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def test_registered_held_out_columns(spark):
    for name, divisor, left in (("op4_language_id", 3, 1), ("op6_quality_classifier", 4, 2)):
        rows = _registered(spark, name)
        assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
        assert all(r["held_out"] == (_kept_out(r["doc_id"], divisor) == left) for r in rows)
        assert name.startswith("op4") or all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_registered_pii_columns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = _registered(spark, "op8_pii")
    assert len(rows) == len(texts) and any(r["spans"] for r in rows)
    listed = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in pii._listed(spans))
    for r in rows:
        plain = pii.plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(plain).encode()).hexdigest()
        assert r["spans"] == listed(plain + pii.disguised_spans(texts[r["doc_id"]], plain, gated=False))
        assert all(r[f"n_{k}"] == sum(s[2] == k for s in plain) for k in pii.KINDS)


def _luhn(digits):
    """By the table of doubled digits, from the right."""
    doubled = dict(zip("0123456789", (0, 2, 4, 6, 8, 1, 3, 5, 7, 9), strict=True))
    return sum(doubled[c] if k % 2 else int(c) for k, c in enumerate(digits[::-1])) % 10 == 0


def _personal(text):
    """The contract's base spans, told again: kind:start:end by start, then kind."""
    ways = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, n: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, n: max(map(int, s.split("."))) <= 255),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s, n: 12 <= len(n) <= 19 and _luhn(n)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, n: 9 <= len(n) <= 15),
    }
    out = []
    for rank, (kind, (pattern, fits)) in enumerate(ways.items()):
        at = 0
        while m := re.compile(pattern).search(text, at):
            digits = "".join(c for c in m[0] if c in "0123456789")
            out += [(m.start(), rank, m.end(), kind)] if fits(m[0], digits) else []
            at = m.end()
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


CARD = "4111 1111 1111 1111"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f"😀 {CARD}, 4111-1111-1111-1112", ["card:2:21"]),
        ("1.2.3.4 1.2.3.256 0001.2.3.4.5", ["ip:0:7", "ip:18:28"]),
        ("a@b a@b.c x..y@z-.q", ["email:4:9", "email:10:19"]),
        ("+1 (555) 123-4567 +12345678 +123456789", ["phone:0:17", "phone:28:38"]),
        ("378282246310005, 3782822463100050, 79927398713; 378282246310005 1", ["card:0:15"]),
        ("", []),
    ],
)
def test_plain_personal_data(text, want):
    listed = [f"{k}:{a}:{b}" for a, b, k in pii._listed(pii.plain_spans(text))]
    assert listed == want == _personal(text)


def test_plain_personal_data_of_random_texts():
    rng, found = random.Random(6), Counter()
    parts = ["+", ".", "@", "-", " ", "(", ")", "a", "b.c", "1", "25", "255", "256", "4111", "1111", "é", "\n", "_", "%", CARD, "10.0.0.1", "555"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        want = _personal(text)
        assert [f"{k}:{a}:{b}" for a, b, k in pii._listed(pii.plain_spans(text))] == want, text
        found.update(s.split(":")[0] for s in want)
    assert min(found[k] for k in pii.KINDS) > 50


def test_registered_pii_against_plain_version(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in _registered(spark, "op8_pii"):
        base = _personal(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(f"{k}:") for s in base) for k in pii.KINDS]


def test_registered_url_labels(spark):
    """Pages whose number has a label decide the mined rules: support and confidence counted by hand."""
    bad = {r["doc_id"]: r["quality"] == 0 or r["toxic"] == 1 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pages = url_rules.with_tokens(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")).collect()
    number = {r["page_id"]: re.search(r"/([0-9]{1,18})[^0-9/]*/?$", re.sub(r"[?#].*", "", r["url"] or "")) for r in pages}
    sets = [(set(r["tokens"]), bad[int(m[1])]) for r in pages if (m := number[r["page_id"]]) and int(m[1]) in bad]
    rows = _registered(spark, "op1_url_rules")
    assert len(rows) == len(pages) and any(r["mined_rule"] for r in rows)
    for r in rows:
        if r["mined_rule"]:
            have = [b for t, b in sets if set(r["mined_rule"].split(" ")) <= t]
            assert r["confidence"] in (sum(have) / len(have), 1 - sum(have) / len(have), (len(have) - sum(have)) / len(have))
            if r["rule"] is None and r["confidence"] > 0.5:
                assert r["verdict"] == ("block" if 2 * sum(have) > len(have) else "allow")


def test_registered_packing_and_leaks(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    packed = _registered(spark, "op9_best_fit_packing")
    assert {r["doc_id"] for r in packed} == ids and all(r["offset"] + r["length"] <= packing.SEQUENCE for r in packed)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = _registered(spark, "op2_benchmark_decontamination")
    assert found and all(r["contaminated"] for r in found)
    words = lambda t: [w.decode() for w in decontamination.tokens(t.encode())]
    for r in [r for r in found if len(words(texts[r["doc_id"]])) < 300][:5]:
        item = words(items[r["item_id"]])
        assert (r["covered"], r["tiles"], r["longest"]) == _naive_tiling(words(texts[r["doc_id"]]), item, min(decontamination.MIN_TILE, len(item))) and r["item_tokens"] == len(item)


def test_long_labelled_url_is_one_item(spark):
    """Forty segments that only one url (with a copy) has, and as many in a url of its own: neither doubles per token."""
    deep = "http://deep.org/" + "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))
    rows = [(f"http://a{i % 3}.site.org/{'x' if i % 2 else 'y'}", "block" if i % 2 else "allow") for i in range(40)]
    rows += [(deep, "block"), (deep, "block"), (deep.replace("/s", "/t"), "block")]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    rules = url_rules.mine(labelled, 0.002, 0.6)
    got = {(r["rule"], r["verdict"], r["support"]) for r in rules.collect()}
    assert sum(rule.startswith("path") and len(rule.split(" ")) == 1 and n == 2 for rule, _, n in got) >= 40
    assert not any("=t" in rule for rule, *_ in got)  # one row supports nothing
    assert {r["url"]: r["verdict"] for r in url_rules.judge(labelled.select("url"), rules).collect()}[deep] == "block"


def test_tokens_of_every_labelled_url(spark):
    """What all urls share is a rule by itself, once, with the share of its labels."""
    rows = [(f"https://site.org/{'x' if i < 3 else 'y'}", "block" if i < 3 else "allow") for i in range(10)]
    got = {r["rule"]: (r["verdict"], r["support"]) for r in url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"), 0.1, 0.6).collect()}
    assert got["scheme=https"] == ("allow", 7) and got["path0=x"] == ("block", 3) and got["path0=y"] == ("allow", 7)


def test_items_that_share_a_prompt(monkeypatch):
    """Thousands of items begin alike: only those that their seeds can cover are paired with the places in the text."""
    rng = random.Random(12)
    prompt = [f"p{k}" for k in range(11)]
    item = lambda k: " ".join([*prompt, *(f"i{k}_{j}" for j in range(25))]).encode()
    rows = [(k, item(k)) for k in range(4_000)]
    block = decontamination.Items(rows, 5)
    paired = []
    matches = decontamination.maximal_matches
    monkeypatch.setattr(decontamination, "maximal_matches", lambda d, i, w: paired.append(len(d)) or matches(d, i, w))
    noise = lambda n: " ".join(f"n{rng.randrange(300)}" for _ in range(n)).encode()
    texts = [b" ".join([*(" ".join(prompt).encode(), noise(20)) * 30]), item(7), b"x " + item(9) + b" " + noise(9) + b" " + item(11), noise(50)]
    hashes = decontamination.WordHashes()
    got = list(block.match(texts, hashes, 50))
    # punctuation separates tokens, "_" too: an item has 11 of the prompt and 25 * 2 of its own
    assert [(r, k, covered, n) for r, k, _, covered, n, _ in got] == [(1, 7, 61, 1), (2, 9, 61, 1), (2, 11, 61, 1)]
    assert len(paired) == 3  # not one per item that shares the prompt


def test_tiling_in_a_block_is_that_of_each_item_alone():
    """Blocks, repeated seeds and short items change nothing: random texts over few words."""
    rng = random.Random(13)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n)).encode()
    items = [(k, text(rng.choice((2, 4, 7, 15, 30)))) for k in range(25)]
    texts = [text(rng.randrange(60)) for _ in range(40)]
    hashes = decontamination.WordHashes()
    got = sorted(decontamination.Items(items, 5).match(texts, hashes, 50))
    want = sorted((r, k, *rest) for k, t in items for r, _, *rest in decontamination.Items([(k, t)], 5).match(texts, hashes, 50))
    assert got == want and len(got) > 50
    naive = {(r, k): _naive_tiling(decontamination.tokens(t), decontamination.tokens(i), min(5, len(decontamination.tokens(i)))) for r, t in enumerate(texts) for k, i in items}
    assert {(r, k): tuple(rest) for r, k, _, *rest in got} == {p: (c, n, m) for p, (c, n, m) in naive.items() if c and c * 100 >= 50 * len(decontamination.tokens(dict(items)[p[1]]))}
