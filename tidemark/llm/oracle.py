"""The queries that SQL can express, in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from tidemark.llm.mixing import ROUNDS, SEED, SHARE, TARGETS
from tidemark.llm.quality import FLOOR, MIN_DOCUMENTS, REACH

ORACLE: dict[str, str] = {}

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _without(text: str, characters: str) -> str:
    for character in characters:
        text = f"replace({text}, '{character}', '')"
    return text


_VALUES = {
    "symbols": "1000 * n_symbols // nullif(word_chars, 0)",
    "shouts": "1000 * n_shouts // nullif(word_chars, 0)",
    "dup_lines": "1000 * n_dup_lines // nullif(n_lines, 0)",
    "repeats": "1000 * n_repeat_words // nullif(n_words, 0)",
    "word_length": "100 * word_chars // nullif(n_words, 0)",
}
_FLOORS = " ".join(f"WHEN '{name}' THEN {least}" for name, least in FLOOR.items())

ORACLE["op1_quality_rules"] = f"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE trim(line, {SPACES}) <> '' GROUP BY doc_id),
measured AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(strlen(text) - strlen({_without("text", "#*$%&|<>")}) AS BIGINT) AS n_symbols,
         CAST(strlen(text) - strlen({_without("text", "!?")}) AS BIGINT) AS n_shouts,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
long AS (
  {" UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{name}' AS measure, CAST(coalesce({value}, 0) AS BIGINT) AS value FROM based" for name, value in _VALUES.items())}),
binned AS (
  SELECT lang, source, measure, (value >> d) << d AS bin
  FROM (SELECT *, CAST(greatest(length(bin(value)) - 7, 0) AS BIGINT) AS d FROM long WHERE NOT base_failed)),
levels AS (
  SELECT 0 AS level, lang, source, measure, bin FROM binned
  UNION ALL SELECT 1, lang, NULL, measure, bin FROM binned
  UNION ALL SELECT 2, NULL, NULL, measure, bin FROM binned),
ranked AS (
  SELECT level, lang, source, measure, bin,
         row_number() OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS r,
         count(*) OVER (PARTITION BY level, lang, source, measure) AS n
  FROM levels),
quantiles AS (
  SELECT level, lang, source, measure, max(n) AS n, min(bin) FILTER (WHERE 10 * r >= n) AS p10,
         min(bin) FILTER (WHERE 2 * r >= n) AS p50, min(bin) FILTER (WHERE 10 * r >= 9 * n) AS p90
  FROM ranked GROUP BY ALL),
fences AS (
  SELECT level, lang, source, measure, n, p50 - {REACH} * greatest(p50 - p10, least_reach) AS low,
         p50 + {REACH} * greatest(p90 - p50, least_reach) AS high
  FROM (SELECT *, CASE measure {_FLOORS} END AS least_reach FROM quantiles)),
chosen AS (
  SELECT a.lang, a.source, a.measure,
         CASE WHEN a.n >= {MIN_DOCUMENTS} THEN a.low WHEN b.n >= {MIN_DOCUMENTS} THEN b.low ELSE c.low END AS low,
         CASE WHEN a.n >= {MIN_DOCUMENTS} THEN a.high WHEN b.n >= {MIN_DOCUMENTS} THEN b.high ELSE c.high END AS high
  FROM fences a
  JOIN fences b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure
  JOIN fences c ON c.level = 2 AND a.measure = c.measure
  WHERE a.level = 0),
judged AS (
  SELECT long.doc_id, bool_and(coalesce(value BETWEEN low AND high, false)) AS inside
  FROM long LEFT JOIN chosen ON long.measure = chosen.measure
   AND long.lang IS NOT DISTINCT FROM chosen.lang AND long.source IS NOT DISTINCT FROM chosen.source
  GROUP BY long.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND inside AS kept
FROM based JOIN judged USING (doc_id)"""

ORACLE["op5_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, line, place,
         translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
lost AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT lines.*, lost.key IS NOT NULL AS gone FROM lines LEFT JOIN lost USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def _raked() -> str:
    steps, last = [], "shared"
    for number in range(ROUNDS):
        for dimension in TARGETS:
            name = f"raked_{number}_{dimension}"
            steps.append(
                f"{name} AS (SELECT * EXCLUDE (weight), weight * share_{dimension}"
                f" / sum(weight) OVER (PARTITION BY {dimension}) AS weight FROM {last})"
            )
            last = name
    return ",\n".join(steps) + f",\nraked AS (SELECT *, weight / tokens AS factor FROM {last})"


_SHARES = ",\n".join(
    f"""of_{d} AS (
  SELECT {d}, pow(sum(tokens), {target}) / sum(pow(sum(tokens), {target})) OVER () AS share_{d}
  FROM cells GROUP BY {d})"""
    for d, target in TARGETS.items()
)
_JOINS = " ".join(f"JOIN of_{d} ON cells.{d} IS NOT DISTINCT FROM of_{d}.{d}" for d in TARGETS)

ORACLE["op2_mixing"] = f"""
WITH counted AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text, CAST(len({WORDS}) + 1 AS BIGINT) AS n_tokens
  FROM documents),
rows AS (
  SELECT doc_id, source, lang, n_tokens,
         CASE WHEN n_tokens < 50 THEN 'note'
              WHEN 50 * (strlen(text) - strlen({_without("text", "<>|{}")})) >= strlen(text) THEN 'markup'
              WHEN strlen(text) < 80 * (strlen(text) - strlen(replace(text, chr(10), '')) + 1) THEN 'list'
              WHEN n_tokens >= 2000 THEN 'book' ELSE 'article' END AS topic
  FROM counted),
cells AS (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL),
{_SHARES},
shared AS (
  SELECT cells.*, {', '.join(f'share_{d}' for d in TARGETS)}, CAST(tokens AS DOUBLE) AS weight
  FROM cells {_JOINS}),
{_raked()},
below AS (
  SELECT coalesce(sum(tokens) OVER before, 0) AS full_tokens,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest, sum(tokens) OVER () AS total
  FROM raked WINDOW before AS (ORDER BY factor DESC, source, lang, topic
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
scaled AS (SELECT max(({SHARE} * total - full_tokens) / rest) AS scale FROM below WHERE rest > 1e-12)
SELECT doc_id, rows.source, rows.lang, rows.topic, n_tokens,
       round(least(1.0, factor * scale), 6) AS probability,
       CAST('0x' || substr(md5('{SEED}/' || doc_id), 1, 8) AS BIGINT) / pow(2, 32) < least(1.0, factor * scale)
         AS sampled
FROM rows JOIN raked ON rows.source IS NOT DISTINCT FROM raked.source
 AND rows.lang IS NOT DISTINCT FROM raked.lang AND rows.topic = raked.topic, scaled"""

ORACLE["op11_hard_negatives"] = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5"""

ORACLE["op13_fill_in_middle"] = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''),
           '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM formed),
outputs AS (
  SELECT *, CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM parts),
restored AS (
  SELECT *, split_part(output, '<M>', 1) AS head, split_part(output, '<M>', 2) AS tail FROM outputs)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                WHEN 'psm' THEN substr(split_part(head, '<S>', 1), 4) || tail || split_part(head, '<S>', 2)
                ELSE split_part(head, '<P>', 2) || tail || substr(split_part(head, '<P>', 1), 4) END)
         AS restored_sha256
FROM restored"""
