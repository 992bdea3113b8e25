"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from plumbline.llm.urls import TWO_LABEL_SUFFIXES

_DOUBLE = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_LABELS = "array_to_string(list_slice(string_split(host, '.'), -{n}, -1), '.')"


def _strength(table: str) -> str:
    """Prior strength by the method of moments over ``n``, ``x``, ``m``."""
    v = "n * m * (1 - m)"
    return f"(SELECT CASE WHEN coalesce(sum({v} * (n - 1)), 0) = 0 THEN 100.0 ELSE (1 - rho) / rho END FROM (SELECT *, 1 AS one FROM {table}) t, (SELECT least(greatest(sum((x - n * m) ** 2 - {v}) / nullif(sum({v} * (n - 1)), 0), 1e-4), 0.5) AS rho FROM {table}) r GROUP BY rho)"


# The rules of the query, as (action, host, path).
_RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
_CASES = {c: " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{a if c == 'action' else h + p}'" for a, h, p in sorted(_RULES, key=lambda r: -len(r[1] + r[2]))) for c in ("text", "action")}

URL_FILTERS = f"""
WITH cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
urls AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
  CASE WHEN coalesce(contains(html, '</html>'), false) THEN 0 ELSE 1 END AS bad FROM parts),
hosts AS (SELECT host, count(bad)::DOUBLE AS n, sum(bad)::DOUBLE AS x,
  CASE WHEN {_LABELS.format(n=2)} IN ({_DOUBLE}) THEN {_LABELS.format(n=3)} ELSE {_LABELS.format(n=2)} END AS domain,
  CASE WHEN {_LABELS.format(n=2)} IN ({_DOUBLE}) THEN {_LABELS.format(n=2)} ELSE {_LABELS.format(n=1)} END AS suffix FROM urls GROUP BY host),
top AS (SELECT suffix, sum(n) AS n, sum(x) AS x, (SELECT (sum(x) + 0.5) / (sum(n) + 1.0) FROM hosts) AS m FROM hosts GROUP BY suffix),
top_rate AS (SELECT suffix, (x + s * m) / (n + s) AS rate FROM top, (SELECT {_strength('top')} AS s) q),
middle AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x, any_value(rate) AS m FROM hosts JOIN top_rate USING (suffix) GROUP BY domain, suffix),
middle_rate AS (SELECT domain, (x + s * m) / (n + s) AS rate FROM middle, (SELECT {_strength('middle')} AS s) q),
low AS (SELECT host, n, x, rate AS m FROM hosts JOIN middle_rate USING (domain)),
bound AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + s + 1)) AS bound FROM (SELECT host, n, s, (x + s * m) / (n + s) AS rate FROM low, (SELECT {_strength('low')} AS s) q))
SELECT page_id, host, path, CASE {_CASES['text']} END AS rule, coalesce(CASE {_CASES['action']} END, CASE WHEN bound > 0.2 THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN bound USING (host)"""

_HEX = "string_split('0000 0001 0010 0011 0100 0101 0110 0111 1000 1001 1010 1011 1100 1101 1110 1111', ' ')"
_BITS = f"array_to_string(list_transform(range(1, 41), lambda i: {_HEX}[strpos('0123456789abcdef', substr(sha, i, 1))]), '')"
_VALUE = " + ".join(f"{1 << (4 - k)} * CAST(substr(bits, 5 * j + {k + 1}, 1) AS INTEGER)" for k in range(5))

WARC = f"""
WITH digests AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
bits AS (SELECT *, {_BITS} AS bits, min(page_id) OVER (PARTITION BY sha) AS first_id FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_VALUE}, 1)), '') AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM bits"""

ORACLE_SQL = {"op2_warc": WARC, "op7_url_filters": URL_FILTERS}
