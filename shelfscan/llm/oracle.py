"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from shelfscan.llm.common import LOWER, UPPER
from shelfscan.llm.license_scan import COVERAGE, DRIFT, GRAM, SHORT_COVERAGE, STRETCH, templates
from shelfscan.llm.mixing import DOMAIN_WEIGHTS, LANG_WEIGHTS, MAX_EPOCHS, ORDER_HEX, SEED, SHARE

_WORD = r"[^\x20\x09-\x0D]+"
_WHITE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

_LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(str_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), '{UPPER}', '{LOWER}') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1
          GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), ''))
         AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY doc_id
"""

_WORDS = f"""
w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
"""

_RULES = f"""
WITH {_WORDS}
next AS (
  SELECT *, lead(word, 1) OVER d AS w2, lead(word, 2) OVER d AS w3, lag(word) OVER d AS w0
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
thrice AS (SELECT *, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS again
           FROM next),
covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    AS inside FROM thrice),
by_word AS (
  SELECT doc_id, sum(length(word))::BIGINT AS word_chars, count(*) FILTER (WHERE inside) AS n_repeat_words,
         count(*) FILTER (WHERE word = w0) AS n_same_next
  FROM covered GROUP BY doc_id),
line AS (SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line FROM documents),
by_line AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM line WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
stat AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT
      AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_same_next, 0) AS n_same_next, coalesce(n_lines, 0) AS n_lines,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Z]', '', 'g')) AS n_upper,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[a-z]', '', 'g')) AS n_lower,
    length(coalesce(text, '')) - length(replace(coalesce(text, ''), '!', '')) AS n_shouts
  FROM w LEFT JOIN by_word USING (doc_id) LEFT JOIN by_line USING (doc_id)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stat)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR (n_upper > n_lower AND 2 * n_upper > word_chars)
    OR 5 * n_shouts > n_words OR 2 * n_dup_lines > n_lines OR 4 * n_same_next > n_words
    OR word_chars < 2 * n_words OR word_chars > 30 * n_words) AS kept
FROM base
"""

_SUBSTRINGS = f"""
WITH {_WORDS}
windows AS (
  SELECT doc_id, s AS i, array_to_string(words[s:s + 34], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS s FROM w WHERE len(words) >= 35)),
repeated AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM windows) WHERE n > 1),
marked AS (
  SELECT doc_id, i, word, max(r.i) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM word LEFT JOIN repeated r USING (doc_id, i)),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text FROM marked GROUP BY doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def _case(column: str, weights: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items()))
    return f"(CASE {column} {whens} ELSE 1 END)" if weights else "1"


def _level(name: str, path: list[str], weight: str, parent: str) -> str:
    """One level of the budget tree; ``parent`` has the path above and ``give``."""
    above = path[:-1]
    key = ", ".join(above) if above else "1"
    cols = ", ".join(path)
    using = f"JOIN {parent} USING ({', '.join(above)})" if above else f"CROSS JOIN {parent}"
    order = f"PARTITION BY {key} ORDER BY cap::DOUBLE / weight, {path[-1]}"
    return f"""
{name}_node AS (
  SELECT {cols}, sum(cap)::HUGEINT AS cap, any_value({weight})::HUGEINT AS weight FROM leaf GROUP BY {cols}),
{name}_fit AS (
  SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS taken,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS open
  FROM {name}_node {using} WINDOW o AS ({order})),
{name}_full AS (
  SELECT *, bool_and(cap * open <= (give - taken) * weight AND cap <= give)
    OVER ({order} ROWS UNBOUNDED PRECEDING) AS is_full FROM {name}_fit),
{name}_rest AS (
  SELECT *, give - coalesce(sum(cap) FILTER (WHERE is_full) OVER (PARTITION BY {key}), 0)::HUGEINT AS rest,
    coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER (PARTITION BY {key}), 0)::HUGEINT AS w_open,
    coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER ({order} ROWS UNBOUNDED PRECEDING), 0)::HUGEINT AS upto
  FROM {name}_full),
{name} AS (
  SELECT {cols}, (CASE WHEN is_full THEN cap
    ELSE (rest * upto) // w_open - (rest * (upto - weight)) // w_open END)::HUGEINT AS give
  FROM {name}_rest),"""


_DOMAIN = """CASE WHEN source IS NULL OR regexp_extract(source, '([0-9]{1,9})$', 1) = '' THEN 'reference'
  WHEN regexp_extract(source, '([0-9]{1,9})$', 1)::INT < 7 THEN 'web'
  WHEN regexp_extract(source, '([0-9]{1,9})$', 1)::INT < 14 THEN 'books' ELSE 'reference' END"""

_MIXING = f"""
WITH doc AS (
  SELECT doc_id, {_DOMAIN} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS cap
         FROM doc GROUP BY domain, lang, source),
root AS (SELECT least(floor((SELECT sum(tokens) FROM doc)::DOUBLE * {SHARE})::HUGEINT, sum(cap)) AS give FROM leaf),
{_level("domains", ["domain"], _case("domain", DOMAIN_WEIGHTS), "root")}
{_level("langs", ["domain", "lang"], _case("lang", LANG_WEIGHTS), "domains")}
{_level("sources", ["domain", "lang", "source"], "1", "langs")}
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN give // tokens ELSE 0 END AS epochs,
    CASE WHEN tokens > 0 THEN give % tokens ELSE 0 END AS prefix
  FROM sources JOIN leaf USING (domain, lang, source)),
placed AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, {ORDER_HEX}))::BIGINT
    AS o
  FROM doc JOIN plan USING (domain, lang, source)),
summed AS (
  SELECT *, prefix > 0 AND sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY o, doc_id
    ROWS UNBOUNDED PRECEDING) <= prefix AS within FROM placed)
SELECT doc_id, domain, lang, source, tokens, (epochs + within::INT)::INTEGER AS copies
FROM summed WHERE epochs + within::INT > 0
"""

def _templates() -> str:
    """One VALUES row per template position."""
    rows = []
    for tid, (phrase, label, is_base, k) in enumerate(templates()):
        words = phrase.split()
        n = len(words) - k + 1
        rows += [f"({tid}, '{label}', {str(is_base).lower()}, {len(words)}, {k}, {n}, {i}, '{' '.join(words[i:i + k])}')"
                 for i in range(n)]
    return ", ".join(rows)


_LICENSES = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
t(tid, label, is_base, len, k, n_grams, tpos, gram) AS (VALUES {_templates()}),
pos AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
grams AS (SELECT doc_id, i - 1 AS i, array_to_string(words[i:i + 1], ' ') AS two,
            array_to_string(words[i:i + 2], ' ') AS three FROM pos),
votes AS (
  SELECT doc_id, tid, label, is_base, len, k, n_grams, i - tpos AS diagonal,
    list(DISTINCT tpos) AS seen
  FROM (SELECT doc_id, i, 2 AS k, two AS gram FROM grams UNION ALL SELECT doc_id, i, 3, three FROM grams)
    JOIN t USING (k, gram)
  GROUP BY doc_id, tid, label, is_base, len, k, n_grams, i - tpos),
marked AS (SELECT *, len(seen) = n_grams OR is_base AS alone FROM votes),
cut AS (
  SELECT *, alone OR coalesce(lag(alone) OVER o, true) OR diagonal - lag(diagonal) OVER o > {DRIFT} AS is_new
  FROM marked WINDOW o AS (PARTITION BY doc_id, tid ORDER BY diagonal)),
merged AS (SELECT *, sum(is_new::INT) OVER (PARTITION BY doc_id, tid ORDER BY diagonal) AS part FROM cut),
spans AS (
  SELECT doc_id, is_base, label, len(list_distinct(flatten(list(seen)))) / n_grams AS coverage, len AS words,
    k, min(diagonal + list_min(seen)) AS first, max(diagonal + list_max(seen) + k - 1) AS last
  FROM merged GROUP BY doc_id, tid, is_base, label, len, k, n_grams, part),
fine AS (SELECT * FROM spans WHERE coverage >= CASE k WHEN {GRAM} THEN {COVERAGE} ELSE {SHORT_COVERAGE} END AND last - first + 1 <= words + {STRETCH}),
best AS (
  SELECT *, max(coverage) OVER (PARTITION BY doc_id, is_base ORDER BY first
    RANGE BETWEEN {STRETCH} PRECEDING AND {STRETCH} FOLLOWING) AS top FROM fine),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE is_base) AS n_base, min(first) FILTER (WHERE is_base) AS first_word,
    max(first) FILTER (WHERE is_base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE is_base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage) AS score
  FROM best WHERE is_base OR coverage = top GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN by_doc USING (doc_id)
"""

ORACLE = {
    "op2_line_dedup": _LINES,
    "op5_source_mixing": _MIXING,
    "op6_license_scan": _LICENSES,
    "op7_quality_rules": _RULES,
    "op9_substring_dedup": _SUBSTRINGS,
}
