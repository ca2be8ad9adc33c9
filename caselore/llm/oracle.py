"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from caselore.llm.licenses import TEMPLATES
from caselore.llm.queries import WEIGHTS

SPACED_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {SPACED_WORDS} AS ws FROM documents),
m AS (
  SELECT doc_id, text, ws, len(ws) AS n_words, list_sum(list_transform(ws, lambda x: length(x))) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w),
g AS (
  SELECT doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY 1),
c AS (
  SELECT m.doc_id, m.text, m.ws, m.n_words, coalesce(m.word_chars, 0) AS word_chars, m.n_symbols, len(m.lines) AS n_lines,
         len(m.lines) - len(list_distinct(m.lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM m LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         length(regexp_replace(text, '[^!]', '', 'g')) AS bangs, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
         len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS stutter
  FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 2 * n_dup_lines > n_lines OR 5 * bangs > n_words OR 2 * capitals > letters OR 5 * stutter > n_words) AS kept
FROM f
"""


def _case(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in weights.items()) + " ELSE 1.0 END"


def _level(name: str, above: str, parent: list[str], level: str, weight: str) -> str:
    """One split of budgets: children filled up to the water level of their family."""
    family, order = ", ".join(parent), f"PARTITION BY {', '.join(parent)} ORDER BY capacity / w, {level}"
    return f"""
{name}_c AS (SELECT {family}, {level}, sum(capacity) AS capacity, {weight} AS w FROM leaf GROUP BY ALL),
{name}_r AS (
  SELECT c.*, budget, row_number() OVER ({order}) AS k,
         (budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER (PARTITION BY {family}) - coalesce(sum(w) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS now
  FROM {name}_c AS c JOIN {above} USING ({family})),
{name}_w AS (SELECT {family}, arg_min(now, k) AS water FROM {name}_r WHERE now * w <= capacity GROUP BY ALL),
{name} AS (SELECT {family}, {level}, CASE WHEN water IS NULL THEN capacity ELSE least(capacity, w * water) END AS budget
           FROM {name}_r LEFT JOIN {name}_w USING ({family}))"""


OP4 = rf"""
WITH t AS (
  SELECT doc_id, coalesce('d' || (regexp_extract(source, '(\d+)$', 1)::INT % 4), '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, len({SPACED_WORDS}) AS n_tokens FROM documents),
leaf AS (SELECT 'all' AS root, domain, lang, source, sum(n_tokens)::DOUBLE AS tokens, 3 * sum(n_tokens)::DOUBLE AS capacity
         FROM t GROUP BY ALL),
top AS (SELECT 'all' AS root, least(sum(capacity), sum(tokens) * 0.8) AS budget FROM leaf),
{_level("a", "top", ["root"], "domain", _case("domain", WEIGHTS["domain"]))},
{_level("b", "a", ["root", "domain"], "lang", _case("lang", WEIGHTS["lang"]))},
{_level("c", "b", ["root", "domain", "lang"], "source", "1.0")},
plan AS (SELECT domain, lang, source, tokens, floor(budget + 1e-6)::BIGINT AS budget,
                CASE WHEN tokens > 0 THEN floor(floor(budget + 1e-6) / tokens) ELSE 0 END::INT AS whole
         FROM c JOIN leaf USING (domain, lang, source)),
o AS (SELECT t.*, budget, whole, sum(n_tokens) OVER (PARTITION BY domain, lang, source
             ORDER BY md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, ''))) <= budget - whole * tokens AND whole < 3 AS last
      FROM t JOIN plan USING (domain, lang, source))
SELECT doc_id, unnest(range(0, whole + last::INT))::INT AS epoch, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       budget AS leaf_budget
FROM o
"""


def _sql_list(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


OP8 = f"""
WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS ws FROM documents),
t AS (SELECT * FROM (VALUES {", ".join(
    f"({k}, '{t.label}', {_sql_list(t.text)}, {_sql_list(t.key)}, {t.text.split().index(t.key.split()[0])}, {t.base})"
    for k, t in enumerate(TEMPLATES))}) AS v(t, label, body, key, key_at, base)),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
hit AS (
  SELECT doc_id, label, base, i - 1 AS place,
         len(list_filter(range(1, len(body) + 1), lambda k: i - key_at + k - 1 >= 1 AND ws[i - key_at + k - 1] = body[k]))
         / len(body)::DOUBLE AS share
  FROM p JOIN t ON ws[i] = key[1] WHERE ws[i:i + len(key) - 1] = key),
s AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(place) FILTER (WHERE base) AS first_word,
         max(place) FILTER (WHERE base) AS last_word, list_sort(list_distinct(list(label) FILTER (WHERE base))) AS bl,
         list_sort(list_distinct(list(label))) AS al, max(share) AS score
  FROM hit GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(al, ','), '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN s USING (doc_id)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10 + 1, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
grams AS (
  SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
hit AS (SELECT doc_id, i, m, item_id FROM grams JOIN win USING (m, win)),
w AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hit) GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN w USING (doc_id) LEFT JOIN x USING (doc_id)
"""

OP12 = rf"""
WITH d AS (SELECT doc_id, {SPACED_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
late AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS lo FROM win) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM late),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {SPACED_WORDS} AS ws FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY 1),
f AS (
  SELECT part, good, bad, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)::INT AS mask
  FROM d LEFT JOIN lab USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad FROM f GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l AS a, l AS b, l AS c, l AS d, l AS e
      WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS c, (1 << (ascii(filter_order[step]) - 65))::INT AS bit,
             coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, c, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM r
"""

ORACLES = {"op2_quality_rules": OP2, "op4_mixing": OP4, "op8_licenses": OP8, "op9_decontamination": OP9,
           "op12_substring_dedup": OP12, "op13_filter_audit": OP13}
