"""Quality rules: a threshold table compiled into one Spark projection.

Every rule compares an integer count with a percentage of another count, so
the verdict needs no floating point. Counts come from SQL functions over the
whole text; there is no user function and no shuffle.

Defined results: a null text is an empty text (no words, not kept); an empty
table gives an empty result; repeated rows are judged one by one; columns of
the input that share a name with a result column are replaced by it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the four languages of the corpus, plain ASCII-lower-cased.
STOP_WORDS = (
    "a al an and are as at au auf be by con das de del dem den der des die du ein eine el en es est et for "
    "from für ich il im in is ist it la las le les lo los mit nicht not of on or par pas pour por qu que qui "
    "se sich sie su sur that the this to un una une und von was with y zu"
).split()


class Rule(NamedTuple):
    """Reject when ``100 * part`` is over (or, for ``least``, under) ``percent * whole``."""

    name: str
    part: str
    whole: str
    percent: int
    least: bool = False


#: ``one`` is the count 1, for rules on absolute lengths.
BASE_RULES = (
    Rule("too_few_words", "n_words", "one", 50 * 100, least=True),
    Rule("repeated_windows", "n_repeat_words", "n_words", 50),
)
METHOD_RULES = (
    Rule("short_words", "word_chars", "n_words", 200, least=True),
    Rule("long_words", "word_chars", "n_words", 2000),
    Rule("symbols", "n_symbols", "n_words", 30),
    Rule("shouting", "n_bangs", "n_words", 30),
    Rule("stop_words", "n_stop_words", "n_words", 2, least=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 50),
)



def _without(text: str, chars: str) -> str:
    """SQL for ``text`` with single ASCII characters taken out (plain byte searches, one per character)."""
    for c in chars:
        text = f"replace({text}, '{c}', '')"
    return text


#: Names of the projection's counts and their SQL over ``t`` (text), ``f`` (fields between separators), ``w`` (words), ``l`` (lines with a word).
_COUNTS = {
    "n_words": "cast(size(w) as bigint)",
    "word_chars": "cast(length(t) - (size(f) - 1) as bigint)",
    "n_symbols": f"cast(length(t) - length({_without('t', '#*$%&|<>')}) as bigint)",
    "n_dup_lines": "cast(size(l) - size(array_distinct(l)) as bigint)",
    "n_lines": "cast(size(l) as bigint)",
    "n_bangs": f"cast(length(t) - length({_without('t', '!')}) as bigint)",
}


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeated_words() -> str:
    """Words inside a 3-word window that the text has twice or more.

    Most texts have no repeated window, which distinct 64-bit hashes prove.
    The others sort (window, position), keep the positions whose neighbour in
    that order has the same words, and add up the stretches they cover.
    """
    windows = "slice(w, 1, greatest(size(w) - 2, 0))"
    hashes = f"transform({windows}, (x, i) -> xxhash64(x, w[i + 1], w[i + 2]))"
    pairs = "sort_array(transform(h, (x, i) -> struct(x as h, i as p)))"
    same = "s[{0}].h = x.h and w[s[{0}].p] = w[x.p] and w[s[{0}].p + 1] = w[x.p + 1] and w[s[{0}].p + 2] = w[x.p + 2]"
    before, after = same.format("i - 1"), same.format("i + 1")
    twice = f"filter(s, (x, i) -> (i > 0 and {before}) or (i + 1 < size(s) and {after}))"
    spots = f"sort_array(transform({_let(pairs, 's', twice)}, x -> x.p))"
    spans = "transform(q, (x, i) -> if(i + 1 < size(q), least(3, q[i + 1] - x), 3))"
    covered = _let(spots, "q", f"aggregate({spans}, 0L, (a, x) -> a + x)")
    return _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {covered})")


def _counts_sql(text: str, result: str) -> str:
    """SQL for ``result``, an expression over ``c``, the struct of all counts of ``text``."""
    stops = ", ".join(f"'{x}'" for x in STOP_WORDS)
    fields = dict(_COUNTS)
    fields["n_repeat_words"] = _repeated_words()
    fields["n_stop_words"] = f"cast(size(filter(w, x -> x in ({stops}))) as bigint)"
    fields["one"] = "1L"
    body = _let("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")", "c", result)
    blanks = "t"
    for c in (r"\t", r"\n", r"\u000b", r"\u000c", r"\r"):
        blanks = f"replace({blanks}, '{c}', ' ')"
    lines = r"filter(split(t, '\n'), x -> translate(x, ' \t\n\u000b\u000c\r', '') <> '')"
    inner = _let("filter(f, x -> x <> '')", "w", _let(lines, "l", body))
    return _let(f"coalesce(`{text}`, '')", "t", _let(f"split({blanks}, ' ')", "f", inner))


def counts(text: str = "text") -> Column:
    """One struct column with every count the rules use."""
    return F.expr(_counts_sql(text, "c"))


def _broken(rule: Rule, at: Column) -> Column:
    part, whole = at[rule.part] * 100, at[rule.whole] * rule.percent
    return part < whole if rule.least else part > whole


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and ``failed_rules`` (names, in table order) to ``docs``."""
    at = F.col("_counts")
    counted = docs.withColumn("_counts", counts(text))
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | _broken(rule, at)
    broken = [F.when(_broken(r, at), F.lit(r.name)) for r in (*BASE_RULES, *rules)]
    out = counted.withColumns({k: at[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")})
    out = out.withColumns({"base_failed": base, "failed_rules": F.array_compact(F.array(*broken))})
    return out.withColumn("kept", F.size("failed_rules") == 0).drop("_counts")


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """The documents that break no rule, with their own columns.

    The verdict is one expression that counts once: a filter on the columns of
    :func:`judge` would be pushed below them and count again for every rule.
    """
    broken = [f"c.{r.part} * 100 {'<' if r.least else '>'} c.{r.whole} * {r.percent}" for r in (*BASE_RULES, *rules)]
    return docs.where(F.expr(_counts_sql(text, "not (" + " or ".join(broken) + ")")))
