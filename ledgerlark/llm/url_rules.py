"""URL filtering by association rules that FP-growth mines from labelled URLs.

Every url becomes a set of tokens: scheme, each domain suffix of its host,
each label, path segments with their place, the shape of numbers, extension,
query keys and pairs, fragment. Labelled urls are transactions of these tokens
and their label. Frequent token sets with a label give rules; a rule stays
when its support and confidence reach the thresholds and no rule for the same
verdict on a part of its tokens is as confident. Tokens that occur in exactly
the same labelled urls are mined as one item, and tokens of all labelled urls
not at all, so a long url costs one item for all that only it (and its copies)
has; the rules are then spelled out for every token of an item, which gives
the rules of all token sets. Tokens nested in each other (each in fewer urls
than the one before) are still mined one by one. Urls are matched by an
inverted index that lists each rule under its rarest token; the rules found
there fit when the url has their other tokens too. The most confident fitting
rule decides (then the larger support, the longer rule, the rule text), so an
allow rule can overrule a block rule; no rule means allow.

Fixed host and path rules go before: the longest that fits.

Defined results: a null url, or one without ``://``, has an empty host and
path, no tokens, no fixed rule and the verdict allow; an empty table gives an
empty result; without labels of both kinds no rule is mined; repeated rows are
judged one by one; other columns pass through unchanged.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import stored

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
#: Labelled urls that a rule needs at least, however few there are.
MIN_ROWS = 2
#: Rows of an index or of a list of tokens that are broadcast at most; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000

ALLOW, BLOCK = "allow", "block"
_LABEL = "label="


class HostRule(NamedTuple):
    """A verdict for a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shape(c: Column) -> Column:
    return F.regexp_replace(c, r"[0-9]+", "0")


def _part(url: Column, pattern: str) -> Column:
    """What ``pattern`` captures after the first ``://``; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, "://" + pattern, 1), F.lit(""))


def host(url: Column) -> Column:
    return _lower(_part(url, r"([^/?#]*)"))


def path(url: Column) -> Column:
    return _part(url, r"[^/?#]*([^?#]*)")


def fixed_rule(host_col: Column, path_col: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, or null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host_col == rule.host) | host_col.endswith("." + rule.host)) & path_col.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def with_tokens(urls: DataFrame) -> DataFrame:
    """``urls`` with ``tokens``: the distinct tokens of ``url``; empty without a host."""
    url, shape = F.col("url"), _shape
    # in steps, so that each part is cut out once and not again in every place that uses it
    cut = urls.withColumns({"_host": host(url), "_path": path(url), "_query": _part(url, r"[^?#]*\?([^#]*)"), "_fragment": _part(url, r"[^#]*#(.*)")})
    named = lambda c: F.filter(F.split(*c), lambda s: s != "")
    cut = cut.withColumns({"_labels": named((F.regexp_replace("_host", r":[0-9]*$", ""), r"\.")), "_parts": named((F.col("_path"), "/")), "_query": named((F.col("_query"), "[&;]"))})
    labels = F.col("_labels")
    found = F.concat(
        F.array(F.concat(F.lit("scheme="), _lower(F.regexp_extract(url, r"^([^:]*)://", 1)))),
        F.transform(labels, lambda _, i: F.concat(F.lit("domain="), F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))),
        F.transform(labels, lambda s: F.concat(F.lit("label."), shape(s))),
        F.transform("_parts", lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), shape(s))),
        F.filter(F.array(F.regexp_extract("_path", r"(\.[A-Za-z0-9]{1,8})$", 1)), lambda s: s != ""),
        F.transform("_query", lambda s: F.concat(F.lit("query="), shape(s))),
        F.filter(F.array(F.concat(F.lit("fragment="), shape(F.col("_fragment")))), lambda s: s != "fragment="),
    )
    some = F.when(F.col("_host") != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))
    return cut.withColumn("tokens", some).drop("_host", "_path", "_query", "_fragment", "_labels", "_parts")


def _implied(tokens: Column) -> Column:
    """Whether a token of the set follows from another by the way tokens are made: a domain brings its suffixes and labels."""
    name = lambda d: F.substr(d, F.lit(len("domain=") + 1))
    label = lambda d: F.transform(F.split(name(d), r"\."), lambda s: F.concat(F.lit("label."), _shape(s)))
    suffix = lambda d, t: t.startswith("domain=") & d.endswith(F.concat(F.lit("."), name(t)))
    domains = F.filter(tokens, lambda t: t.startswith("domain="))
    return F.exists(domains, lambda d: F.arrays_overlap(tokens, label(d)) | F.exists(domains, lambda t: suffix(d, t)))


def _unrepeated(rules: DataFrame) -> DataFrame:
    """The rows of ``rules`` (``tokens, verdict, confidence``; with each all its parts) that no part of the tokens equals in confidence.

    Level by level: the best confidence of any part is that of the parts with one token less, or of their parts.
    """
    longest = rules.agg(F.coalesce(F.max(F.size("tokens")), F.lit(0))).first()[0]
    less = F.transform("tokens", lambda t: F.array_remove("tokens", t))
    out = rules.where(F.size("tokens") == 1)
    best = out.withColumn("best", F.col("confidence"))
    for n in range(2, longest + 1):
        own = rules.where(F.size("tokens") == n)
        parts = own.select("tokens", "verdict", F.explode(less).alias("part"))
        of_parts = parts.join(best.select(F.col("tokens").alias("part"), "verdict", "best"), ["part", "verdict"])
        of_parts = of_parts.groupBy("tokens", "verdict").agg(F.max("best").alias("of_part"))
        level = stored(own.join(of_parts, ["tokens", "verdict"]), "level")
        best = level.withColumn("best", F.greatest("confidence", "of_part"))
        out = out.unionByName(level.where("confidence > of_part").drop("of_part"))
    return out


def _classes(rows: DataFrame, least: int) -> DataFrame:
    """``token, rep, freq`` of the tokens in ``least`` rows or more of ``rows`` (``_row, tokens``).

    Tokens that occur in exactly the same rows share the smallest of them as ``rep``: proposed by two hashes of the
    rows, confirmed by the number of rows that hold both.
    """
    each = rows.select("_row", F.explode("tokens").alias("token"))
    seen = each.groupBy("token").agg(F.count("*").alias("freq"), F.bit_xor(F.xxhash64("_row")).alias("h1"), F.bit_xor(F.xxhash64("_row", F.lit(1))).alias("h2"))
    seen = stored(seen.where(F.col("freq") >= least), "tokens")
    reps = seen.groupBy("freq", "h1", "h2").agg(F.min("token").alias("rep"))
    named = stored(seen.join(reps, ["freq", "h1", "h2"]).select("token", "rep", "freq"), "named")
    others = _small(named.where("token <> rep"))
    both = rows.select("tokens", F.explode("tokens").alias("token")).join(others, "token").where(F.array_contains("tokens", F.col("rep")))
    both = both.groupBy("token").agg(F.count("*").alias("both"))
    rep = F.when((F.col("token") == F.col("rep")) | (F.col("both") == F.col("freq")), F.col("rep")).otherwise(F.col("token"))
    return stored(named.join(both, "token", "left").select("token", rep.alias("rep"), "freq"), "classes")


def _small(written: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has ``BROADCAST_ROWS`` rows at most."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def _frequent(rows: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """``tokens, label, freq`` of the sets of ``rep`` tokens, with and without a label, in ``least`` rows or more.

    Tokens that every row has are left out of the mining, as they change the count of no set; each is a set by itself.
    """
    total = rows.count()
    sizes = [(None, total), *((r["verdict"], r["count"]) for r in rows.groupBy("verdict").count().collect())]  # two labels
    each = F.array(*[F.struct(F.lit(label).cast("string").alias("label"), F.lit(n).cast("long").alias("freq")) for label, n in sizes if n >= least])
    everywhere = classes.where(F.col("freq") == total).select("rep").distinct()
    whole = everywhere.select(F.array("rep").alias("tokens"), F.explode(each).alias("of")).select("tokens", "of.label", "of.freq")
    some = _small(classes.where(F.col("freq") < total).select("token", "rep"))
    items = rows.select("_row", "verdict", F.explode("tokens").alias("token")).join(some, "token").groupBy("_row", "verdict").agg(F.collect_set("rep").alias("reps"))
    items = stored(items.select(F.array_append("reps", F.concat(F.lit(_LABEL), F.col("verdict"))).alias("items")), "transactions")
    n = items.count()
    if n < least:
        return whole
    # a fraction half a row below the count, so that rounding cannot move it
    frequent = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n).fit(items).freqItemsets
    is_label = lambda x: x.startswith(_LABEL)
    found = frequent.select(
        F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
        F.substr(F.get(F.filter("items", is_label), F.lit(0)), F.lit(len(_LABEL) + 1)).alias("label"),
        F.col("freq"),
    )
    return found.where(F.size("tokens") > 0).unionByName(whole)


def _spelled_out(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Each rule with every choice of a token for each of its classes."""
    members = classes.groupBy("rep").agg(F.collect_list("token").alias("members"))
    each = rules.select("tokens", F.explode("tokens").alias("rep")).distinct().join(members, "rep")
    ways = each.groupBy("tokens").agg(F.collect_list("members").alias("members"))
    none = F.array(F.array().cast("array<string>"))
    longer = lambda have, more: F.flatten(F.transform(have, lambda h: F.transform(more, lambda t: F.array_append(h, t))))
    ways = ways.select("tokens", F.explode(F.aggregate("members", none, longer)).alias("way"))
    return rules.join(ways, "tokens").withColumn("tokens", F.array_sort("way")).drop("way")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``rule, tokens, rarest, verdict, support, confidence`` from ``url, verdict``.

    A rule needs ``min_support`` of the labelled urls, and two of them at least.
    """
    spark = labelled.sparkSession
    schema = "rule string, tokens array<string>, rarest string, verdict string, support bigint, confidence double"
    rows = with_tokens(labelled.select("url", "verdict").where(F.col("verdict").isin(ALLOW, BLOCK))).where(F.size("tokens") > 0)
    rows = stored(rows.select(F.monotonically_increasing_id().alias("_row"), "tokens", "verdict"), "labelled")
    least = max(MIN_ROWS, math.ceil(min_support * rows.count()))
    if rows.limit(least).count() < least:
        return spark.createDataFrame([], schema)
    classes = _classes(rows, least)
    # a set with an implied token is as frequent, with and without a label, as the set without it: its rule is superfluous
    named = stored(_frequent(rows, classes, least).where(~_implied(F.col("tokens"))), "itemsets")
    whole = named.where("label is null").select("tokens", F.col("freq").alias("all"))
    rules = named.where("label is not null").join(whole, "tokens")
    rules = rules.select("tokens", F.col("label").alias("verdict"), F.col("freq").alias("support"), (F.col("freq") / F.col("all")).alias("confidence"))
    kept = stored(_unrepeated(stored(rules, "rules")).where(F.col("confidence") >= min_confidence), "unrepeated")
    kept = stored(_spelled_out(kept, classes), "spelled_out")
    each = kept.select("tokens", F.explode("tokens").alias("token")).distinct().join(classes.select("token", "freq"), "token")
    rarest = each.groupBy("tokens").agg(F.min(F.struct("freq", "token"))["token"].alias("rarest"))
    return stored(kept.join(rarest, "tokens").select(F.array_join("tokens", " ").alias("rule"), "tokens", "rarest", "verdict", "support", "confidence"), "pruned")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, mined_rule, mined_verdict, confidence`` for the distinct urls that a rule fits."""
    index = rules.withColumnRenamed("tokens", "needed")
    small = index.count() <= BROADCAST_ROWS
    own = with_tokens(urls.select("url")).select("url", "tokens", F.explode("tokens").alias("rarest"))
    hits = own.join(F.broadcast(index) if small else index, "rarest").where(F.size(F.array_except("needed", "tokens")) == 0)
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", "support", F.size("needed").alias("size"), "rule", "verdict")).alias("best"))
    return best.select("url", F.col("best.rule").alias("mined_rule"), F.col("best.verdict").alias("mined_verdict"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, rules: DataFrame, fixed: tuple[HostRule, ...] = ()) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (fixed, or null), ``verdict``, ``mined_rule`` and ``confidence``."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "mined_rule", "confidence")]
    found = match(pages.where("url is not null").select("url"), rules)  # tokens are cut in the tasks that read the pages
    found = found.withColumnRenamed("url", "_url")
    out = pages.select(*own).join(found, F.col("url") == F.col("_url"), "left").drop("_url")
    out = out.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    text, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    return out.withColumns({"rule": text, "verdict": F.coalesce(verdict, "mined_verdict", F.lit(ALLOW))}).drop("mined_verdict")
