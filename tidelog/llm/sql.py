"""DuckDB SQL for the queries that SQL can express."""

import string

from tidelog.llm.urls import DAMPING, DIGITS, RATIO, RULES, STEPS

_WORD = r"'[^\x20\x09-\x0D]+'"

_SUBSTRING = f"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN firsts USING (s) WHERE doc_id > first_id)),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, k)
  GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

_MIXING = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORD})), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM sizes GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][source_no % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM named),
leveled AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER fill, 0.0::DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0.0::DOUBLE)) AS level
  FROM weighed WINDOW fill AS (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (
  SELECT *, first_value(CASE WHEN level * weight < cap THEN level END IGNORE NULLS) OVER (
    ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_level
  FROM leveled),
targets AS (SELECT source, source_no, source_size, coalesce(least(open_level * weight, cap), cap) AS target FROM opened),
played AS (
  SELECT s.*, source_no, source_size, target, sum(size) OVER (PARTITION BY source_no ORDER BY place, size) AS played
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, (played + epoch * source_size)::DOUBLE / target AS finish
  FROM played, (VALUES (0), (1)) e(epoch) WHERE size > 0 AND target > 0),
mixed AS (SELECT *, sum(size) OVER (ORDER BY finish, source_no, place) AS upto FROM copies),
taken AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM mixed WHERE upto <= (SELECT sum(size) FROM sizes) * 1.5 GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM played LEFT JOIN taken USING (doc_id)"""


def _url_filters() -> str:
    """The propagation as one CTE per step; each adds what the step before sent on."""
    host = r"translate(regexp_extract(coalesce({}, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{}', '{}')"
    host_of = lambda url: host.format(url, string.ascii_uppercase, string.ascii_lowercase)
    path_of = lambda url: rf"regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"
    rules = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in RULES)
    steps = "".join(
        f""",
s{k} AS MATERIALIZED (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT kind, host, score FROM s0 UNION ALL
    SELECT e.kind, e.receiver, s.score * e.share * {DAMPING}
    FROM edges e JOIN s{k - 1} s ON e.kind = s.kind AND e.sender = s.host)
  GROUP BY kind, host)"""
        for k in range(1, STEPS + 1)
    )
    return f"""
WITH rules AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host, rule[instr(rule, '/'):] AS rule_path
  FROM (VALUES {rules}) r(verdict, rule)),
links AS MATERIALIZED (
  SELECT page_host, {host_of("url")} AS host, {path_of("url")} AS path FROM (
    SELECT page_host, CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END AS url FROM (
      SELECT {host_of("url")} AS page_host, unnest(regexp_extract_all(html,
        '(?i)href\\s*=\\s*["'']?\\s*((?:[a-z][a-z0-9+.\\-]*:)?//[^\\s"''<>]+)', 1)) AS link
      FROM pages))),
named AS (SELECT page_id, {host_of("url")} AS host, {path_of("url")} AS path FROM pages),
met AS (SELECT host, path FROM named UNION ALL SELECT host, path FROM links),
ruled AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM met) m JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path),
shares AS (
  SELECT host, count(*) FILTER (verdict = 'allow') / count(*) AS trust, count(*) FILTER (verdict = 'block') / count(*) AS distrust
  FROM met LEFT JOIN ruled USING (host, path) WHERE host <> '' GROUP BY host),
s0 AS MATERIALIZED (
  SELECT 'trust' AS kind, host, trust * (1 - {DAMPING}) AS score FROM shares WHERE trust > 0 UNION ALL
  SELECT 'distrust', host, distrust * (1 - {DAMPING}) FROM shares WHERE distrust > 0),
pairs AS (
  SELECT page_host, host, count(*) AS n FROM links WHERE page_host <> host AND page_host <> '' AND host <> '' GROUP BY ALL),
edges AS MATERIALIZED (
  SELECT kind, sender, receiver, n / sum(n) OVER (PARTITION BY kind, sender) AS share FROM (
    SELECT 'trust' AS kind, page_host AS sender, host AS receiver, n FROM pairs UNION ALL
    SELECT 'distrust', host, page_host, n FROM pairs)){steps},
hosts AS (
  SELECT host, round(sum(score) FILTER (kind = 'trust'), {DIGITS}) AS trust,
         round(sum(score) FILTER (kind = 'distrust'), {DIGITS}) AS distrust
  FROM s{STEPS} GROUP BY host)
SELECT page_id, named.host AS host, named.path AS path, rule,
       coalesce(verdict, CASE WHEN distrust > coalesce(trust, 0) * {RATIO} THEN 'block' ELSE 'allow' END) AS verdict
FROM named LEFT JOIN ruled USING (host, path) LEFT JOIN hosts USING (host)"""


def oracle_sql() -> dict[str, str]:
    return {"op3_substring": _SUBSTRING, "op4_mixing": _MIXING, "op12_url_filters": _url_filters()}
