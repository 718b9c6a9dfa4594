"""SQL that must give the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

import re

from brightwell.llm import chat, quality, warc


def _listed(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _distance(counts: str, reference: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    shares = f"list_zip(list_transform({counts}, lambda x: x / list_sum({counts})), list_transform({reference}, lambda x: x / list_sum({reference})))"
    def half(k):
        return f"CASE WHEN z[{k}] > 0 THEN z[{k}] * log2(z[{k}] / ((z[1] + z[2]) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform({shares}, lambda z: {half(1)} + {half(2)})) / 2))"


def divergence() -> str:
    limits, common = quality.Limits(), quality.vocabulary()
    word, blank = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
    def without(pattern):
        return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"
    quoted = [c.replace("'", "''") for c in quality.CLASSES]
    classes = ", ".join(without(c) for c in ("[a-z]", blank, *quoted))
    own = max(len(words.split()) for words in quality.COMMON_WORDS.values()) + 1
    def chance(bins, n):
        return f"{limits.chance} * sqrt({bins - 1} / (8 * 0.6931471805599453) / {n})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(t, '{word}+') AS w, [{classes}] AS c FROM d),
places AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM places) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM often, range(3) s(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
repeats AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup FROM lines WHERE regexp_matches(l, '{word}') GROUP BY r),
spoken AS (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM w) WHERE x IN ({_listed(common)[1:-1]}) GROUP BY r, x),
counted AS (SELECT r, map_from_entries(list((x, n))) AS m FROM spoken GROUP BY r),
figures AS MATERIALIZED (
  SELECT w.r, doc_id, lang, len(w) AS n_words, length(t) - c[2] AS word_chars, c[{3 + quality.CLASSES.index(quality.SYMBOLS)}] AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    list_append(c, length(t) - CAST(list_sum(c) AS BIGINT)) AS chars, length(t) AS n_chars,
    list_transform({_listed(common)}, lambda x: coalesce(m[x], 0)) AS found
  FROM w LEFT JOIN repeats ON repeats.r = w.r LEFT JOIN covered ON covered.r = w.r LEFT JOIN counted ON counted.r = w.r),
judged AS MATERIALIZED (SELECT *, list_append(found, n_words - coalesce(CAST(list_sum(found) AS BIGINT), 0)) AS commons,
  n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures),
sums AS (SELECT lang, 'c' AS kind, i, sum(chars[i]) AS n FROM judged, range(1, {quality.BINS + 1}) s(i) WHERE n_words >= {quality.MIN_WORDS} GROUP BY lang, i
  UNION ALL SELECT lang, 'w', i, sum(commons[i]) FROM judged, range(1, {len(common) + 2}) s(i) WHERE n_words >= {quality.MIN_WORDS} GROUP BY lang, i),
refs AS (SELECT lang AS known, list(n ORDER BY i) FILTER (WHERE kind = 'c') AS rc, list(n ORDER BY i) FILTER (WHERE kind = 'w') AS rw
  FROM sums WHERE lang IN ({_listed(quality.COMMON_WORDS)[1:-1]}) GROUP BY lang),
near AS (SELECT r, min({_distance('chars', 'rc')}) AS dc, min({_distance('commons', 'rw')}) AS dw
  FROM judged, refs WHERE NOT base_failed GROUP BY r),
strange AS MATERIALIZED (SELECT w.r, w.lang, w.w, j.chars, j.n_words FROM w JOIN judged j ON j.r = w.r
  WHERE w.lang NOT IN ({_listed(quality.COMMON_WORDS)[1:-1]}) AND j.n_words >= {quality.MIN_WORDS}),
their_chars AS (SELECT lang AS known, list(n ORDER BY i) AS oc FROM (
  SELECT lang, i, sum(chars[i]) AS n FROM strange, range(1, {quality.BINS + 1}) s(i) GROUP BY lang, i) GROUP BY lang),
their_docs AS (SELECT lang AS known, count(*) AS n_docs, sum(n_words) AS n FROM strange GROUP BY lang),
their_words AS (SELECT lang, x, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, x) AS k
  FROM (SELECT lang, unnest(w) AS x FROM strange) GROUP BY lang, x QUALIFY k <= {quality.LEARNED}),
their_top AS (SELECT lang AS known, list(x ORDER BY k) AS top, list(n ORDER BY k) AS tn FROM their_words GROUP BY lang),
theirs AS (SELECT *, list_append(tn, CAST(n - list_sum(tn) AS BIGINT)) AS ow FROM their_chars JOIN their_docs USING (known) JOIN their_top USING (known)),
told AS (SELECT r, chars, oc, ow, n_docs, n_words, list_transform(top, lambda x: len(list_filter(w, lambda y: y = x))) AS few
  FROM strange JOIN theirs ON theirs.known = strange.lang),
far AS (SELECT r, n_docs, {_distance('chars', 'oc')} AS oc,
  {_distance('list_append(few, n_words - CAST(list_sum(few) AS BIGINT))', 'ow')} AS ow FROM told),
tested AS (SELECT judged.*, dc, dw, far.r IS NOT NULL AS has_own, coalesce(lang IN ({_listed(quality.COMMON_WORDS)[1:-1]}), false) AS listed,
  n_chars >= {limits.min_chars} AND coalesce(dc, 0) > {limits.chars} + {chance(quality.BINS, 'n_chars')} AS far_chars,
  n_words >= {limits.min_words} AND coalesce(dw, 0) > {limits.words} + {chance(own, 'n_words')} AS far_words,
  n_chars >= {limits.min_chars} AND oc > {limits.chars} + {limits.few} / sqrt(n_docs) + {chance(quality.BINS, 'n_chars')} AS own_chars,
  n_words >= {limits.min_words} AND ow > {limits.words} + {limits.few} / sqrt(n_docs) + {chance(own, 'n_words')} AS own_words
  FROM judged LEFT JOIN near ON near.r = judged.r LEFT JOIN far ON far.r = judged.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT CASE WHEN listed THEN far_chars OR far_words WHEN NOT has_own THEN false
    ELSE (own_chars AND (dc IS NULL OR far_chars)) OR (own_words AND (dw IS NULL OR far_words)) END AS kept
FROM tested"""


def mixture(mix) -> str:
    """The mix, with the budget handed down level by level by window functions."""
    levels = ("domain", "lang", "source")
    steps = []
    for depth, (level, named) in enumerate(zip(levels, (mix.domains, mix.langs, mix.sources))):
        parents = levels[:depth]
        keys = ", ".join([*parents, level])
        by = f"PARTITION BY {', '.join(parents)} " if parents else ""
        order = f"{by}ORDER BY need, {level} NULLS FIRST"
        cases = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in named.items())
        weight = f"CASE {level} {cases} ELSE {mix.rest} END" if cases else str(mix.rest)
        same = " AND ".join(f"g.{k} IS NOT DISTINCT FROM l.{k}" for k in (*parents, level))
        steps.append(f"""
children{depth} AS (SELECT {keys}, sum(cap) AS supply, any_value(budget) AS given_down, CAST({weight} AS HUGEINT) AS w,
  CAST(sum(cap) AS DOUBLE) / CAST({weight} AS DOUBLE) AS need FROM level{depth} GROUP BY {keys}),
lined{depth} AS (SELECT *, row_number() OVER ({order}) AS place,
  given_down - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
  sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares FROM children{depth}),
full{depth} AS (SELECT *, min(place) FILTER (WHERE supply * shares > remaining * w) OVER ({by}) AS first FROM lined{depth}),
given{depth} AS (SELECT *, max(remaining) FILTER (WHERE place = first) OVER ({by}) AS pool,
  max(shares) FILTER (WHERE place = first) OVER ({by}) AS pool_shares FROM full{depth}),
level{depth + 1} AS (SELECT l.domain, l.lang, l.source, l.tokens, l.cap,
  CASE WHEN supply * shares <= remaining * w THEN supply ELSE pool * w // pool_shares END AS budget
  FROM level{depth} l JOIN given{depth} g ON {same})""")
    leaf = "domain, lang, source"
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM d.{k}" for k in levels)
    return f"""
WITH d AS (SELECT doc_id, lang, source, regexp_extract(source, '^(.*?[0-9]?)[0-9]?$', 1) AS domain,
  CAST((coalesce(strlen(text), 0) + 3) // 4 AS BIGINT) AS tokens FROM documents),
leaves AS (SELECT {leaf}, CAST(sum(tokens) AS HUGEINT) AS tokens FROM d GROUP BY ALL),
level0 AS (SELECT *, tokens * {mix.max_epochs} AS cap, (SELECT least(sum(tokens) * {mix.budget_percent} // 100, sum(tokens) * {mix.max_epochs})
  FROM leaves) AS budget FROM leaves),{",".join(steps)},
plan AS (SELECT {leaf}, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS part FROM level3),
placed AS (SELECT d.*, budget, whole, part, md5('{mix.seed}:' || (whole + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM d JOIN plan s ON {same}),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY {leaf} ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  - sum(tokens) OVER (PARTITION BY {leaf}, place) AS before FROM placed),
timed AS (SELECT *, CAST(whole + CASE WHEN part > 0 AND before < part THEN 1 ELSE 0 END AS BIGINT) AS times FROM summed)
SELECT doc_id, domain, lang, source, CAST(unnest(range(1, times + 1)) AS INTEGER) AS epoch, tokens, CAST(budget AS BIGINT) AS budget FROM timed"""


def derivatives() -> str:
    """Metadata and conversion records of all pages."""
    def quoted(text):
        return "E'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\r", "\\r").replace("\n", "\\n") + "'"

    def replaced(text, pattern, sign):
        return f"regexp_replace({text}, '{pattern}', {quoted(sign)}, 'g')"
    text = "payload"
    for pattern, sign in ((warc.HIDDEN, " "), (warc.BLOCK, "\n"), (warc.TAG, "")):
        text = replaced(text, pattern, sign)
    for entity, sign in warc.ENTITIES.items():
        text = f"replace({text}, {quoted(entity)}, {quoted(sign)})"
    for pattern, sign in warc.GAPS:
        text = replaced(text, pattern, sign)
    line = quoted(warc.CRLF)

    def named(kind, target, content):
        name = f"md5({kind} || '|' || page || '|' || {target} || '|' || sha256({content}))"
        return (f"'<urn:uuid:' || substr({name}, 1, 8) || '-' || substr({name}, 9, 4) || '-3' || substr({name}, 14, 3) || '-8' || "
                f"substr({name}, 18, 3) || '-' || substr({name}, 21, 12) || '>'")
    return f"""
WITH r AS (SELECT page_id, coalesce(CAST(page_id AS VARCHAR), '') AS page, coalesce(url, '') AS target, coalesce(html, '') AS payload FROM pages),
made AS (SELECT *, {named("'response'", "target", "payload")} AS refers_to,
  'HTTP/1.1 200 OK' || {line} || 'Content-Type: text/html; charset=utf-8' || {line} || 'Content-Length: ' || strlen(payload) || {line} AS source_headers,
  trim({text}, E' \\n') AS words FROM r),
two AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'title: ' || regexp_replace(regexp_extract(payload, '{warc.TITLE}', 1), '{warc._B}+', ' ', 'g') || {line}
    || 'language: ' || regexp_extract(payload, '{warc.LANGUAGE}', 1) || {line}
    || 'links: ' || len(regexp_extract_all(payload, '{warc.LINK}')) || {line} || 'payload-length: ' || strlen(payload) || {line}
    || 'text-length: ' || strlen(words) || {line} AS content FROM made
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', words FROM made)
SELECT page_id, record_type, {named("record_type", "refers_to", "content")} AS record_id, refers_to, target, '{warc.DATE}' AS date, source_headers,
  'sha256:' || sha256(payload) AS source_digest, content_type, content, CAST(strlen(content) AS BIGINT) AS content_length,
  'sha256:' || sha256(content) AS block_digest FROM two"""


def chat_examples() -> str:
    """Digests of every conversation, from the raw table; only the escape signs are counted as the operator sets them."""
    template = chat.Template()
    rests = {}
    for control in template.controls:
        rests.setdefault(control[0], []).append(re.escape(control[1:]))
    broken = "|".join(f"{re.escape(first)}{re.escape(template.escape)}*(?:{'|'.join(rest)})" for first, rest in rests.items())
    def chars(column):
        return f"(length({column}) + len(regexp_extract_all({column}, '{broken}')))"
    marks = len(template.open) + len(template.sep) + len(template.close)
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) s(i)),
c AS (SELECT *, {marks} + {chars("role")} + {chars("text")} AS chars, role = '{chat.TRAINED}' AS trained FROM t),
p AS (SELECT *, sum(chars) OVER w AS upto, row_number() OVER w AS place, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE trained), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE trained), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE trained OR last) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id"""


def trie_nodes() -> str:
    """Nodes by the prefixes themselves. The checksum of a conversation id goes bit by bit."""
    bits = ", ".join(["-1"] * 8)
    crc = f"""xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), {bits}])),
  lambda held, x: CASE WHEN x >= 0 THEN xor(held, x) WHEN held % 2 = 1 THEN xor(held // 2, 3988292384) ELSE held // 2 END, 4294967295), 4294967295)"""
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT n.conv_id, n.conv_id - n.conv_id % 5 AS base, {crc.replace("conv_id", "n.conv_id")} % 9 AS h, n.n, coalesce(b.n, 0) AS base_n
  FROM n LEFT JOIN n b ON b.conv_id = n.conv_id - n.conv_id % 5),
r AS (SELECT c.conv_id, t.i + 1 AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.i < c.h
  UNION ALL SELECT c.conv_id, least(h, base_n) + t.i - h + 1, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i >= c.h),
m AS (SELECT conv_id, depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path,
    strlen(text) AS bytes, depth = least(h, base_n) + greatest(0, n - h) AS ends FROM r JOIN c USING (conv_id)
  UNION ALL SELECT conv_id, 0, [], 0, least(h, base_n) + greatest(0, n - h) = 0 FROM c),
nodes AS MATERIALIZED (SELECT path, min(conv_id) AS conv_id, max(depth) AS depth, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY path),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (SELECT path[1:d] AS path, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved FROM (
    SELECT nodes.path, n_convs, bytes, children.n IS NULL AS leaf, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN children USING (path)) GROUP BY ALL)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes above ON nodes.depth > 0 AND above.path = nodes.path[1:nodes.depth - 1]"""
