"""DuckDB text of the queries that SQL can express."""

from __future__ import annotations

from ledgerlark.llm.quality_rules import BASE_RULES, METHOD_RULES, STOP_WORDS, Rule

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _broken(rule: Rule) -> str:
    return f"{rule.part} * 100 {'<' if rule.least else '>'} {rule.whole} * {rule.percent}"


def quality_rules() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    broken = " OR ".join(f"({_broken(r)})" for r in BASE_RULES)
    kept = " OR ".join(f"({_broken(r)})" for r in (*BASE_RULES, *METHOD_RULES))
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS l FROM base),
spots AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM base, unnest(range(1, len(w) - 1)) AS s(i)),
again AS (
  SELECT doc_id, i FROM spots QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(translate(t, '!', '')) AS BIGINT) AS n_bangs,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({stops}))) AS BIGINT) AS n_stop_words, 1 AS one
  FROM base JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({broken}) AS base_failed, NOT ({kept}) AS kept
FROM counted"""


def line_dedup() -> str:
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM numbered),
keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM lines),
live AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, coalesce(l.keeper <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN live l USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id"""


def near_dedup() -> str:
    return f"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM base, unnest(range(1, len(w) - 1)) AS r(i)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM base WHERE len(w) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, to_node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.to_node),
least AS (SELECT node, min(to_node) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


def substring_dedup() -> str:
    return f"""
WITH base AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM base, unnest(range(1, len(w) - 48)) AS s(i)),
late AS (
  SELECT r, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM late),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM base),
kept AS (
  SELECT words.r, count(*) AS n_words, count(gone.p) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
  FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p GROUP BY words.r)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM base d LEFT JOIN kept USING (r)"""


CRC32 = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS t
  FROM range(256) AS r(i))"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text of code points below 256; needs ``crc_table`` (``t``) in scope."""
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295)"


def spelling_variants() -> str:
    """Words an edit apart share a text with one letter left out, at the same place or with the whole of the shorter."""
    return f"""
WITH RECURSIVE {CRC32.strip()},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)),
hashed AS (
  SELECT run, c, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY ALL), crc_table),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
less AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.at = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN forms ON chain.at = forms.word WHERE forms.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, coalesce(e.root, f.word) AS root FROM forms f LEFT JOIN ends e ON f.word = e.word
"""


def merkle_manifest(heights: int = 8) -> str:
    """The tree level by level, ``heights`` of 16 nodes each for a source and for the sources; enough for 16**heights."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"WITH {CRC32.strip()}",
        f"""docs AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
         CASE WHEN ({_crc32("doc_id::VARCHAR")}) % 5 = 0 THEN {leaf(f"({lowered})")} ELSE {leaf("text")} END AS changed
  FROM documents, crc_table)""",
        """s_0 AS (
  SELECT coalesce('=' || source, '') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest, doc_id, changed
  FROM docs)""",
        "fold_s_0 AS (SELECT doc_id, g, pos, digest AS leaf, changed AS folded, '' AS proof FROM s_0)",
    ]

    def climb(name: str, nodes: str) -> None:
        for k in range(heights):
            parts.append(f"""runs_{name}_{k} AS (
  SELECT g, pos // 16 AS run, list(digest ORDER BY pos) AS members, max(count(*)) OVER (PARTITION BY g) = 1 AND count(*) OVER (PARTITION BY g) = 1 AS done
  FROM {nodes} GROUP BY g, pos // 16)""")
            parts.append(f"{name}_{k + 1} AS (SELECT g, run AS pos, CASE WHEN done THEN members[1] ELSE sha256(array_to_string(members, '')) END AS digest FROM runs_{name}_{k})")
            parts.append(f"""fold_{name}_{k + 1} AS (
  SELECT f.* REPLACE (f.pos // 16 AS pos,
    CASE WHEN done THEN folded ELSE sha256(array_to_string(members[:f.pos % 16], '') || folded || array_to_string(members[f.pos % 16 + 2:], '')) END AS folded,
    CASE WHEN done THEN proof ELSE proof || array_to_string(members[:f.pos % 16], '') || array_to_string(members[f.pos % 16 + 2:], '') END AS proof)
  FROM fold_{name}_{k} f JOIN runs_{name}_{k} r ON f.g = r.g AND f.pos // 16 = r.run)""")
            nodes = f"{name}_{k + 1}"

    climb("s", "s_0")
    parts.append(f"r_0 AS (SELECT '' AS g, g AS source, row_number() OVER (ORDER BY g) - 1 AS pos, digest FROM s_{heights})")
    parts.append(f"fold_r_0 AS (SELECT f.* REPLACE ('' AS g, r.pos AS pos), r.digest AS subroot FROM fold_s_{heights} f JOIN r_0 r ON f.g = r.source)")
    climb("r", "r_0")
    parts.append(f"""final AS (
  SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
  FROM fold_r_{heights}, r_{heights})""")
    return ",\n".join(parts) + "\nSELECT * FROM final\n"
