"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from collections.abc import Mapping

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def overlap_sql(window: int = 13, share: int = 20) -> str:
    """The decontamination report by joining word windows as texts."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lowered = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered}, '{pattern}') AS w, string_split_regex({lowered}, '{pattern}') AS gaps
  FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({lowered}, '{pattern}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[k:k + size - 1], ' ') AS t
  FROM (SELECT item, w, least({window}, len(w)) AS size, unnest(range(1, greatest(1, len(w) - {window} + 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
shown AS (
  SELECT r, size, k, array_to_string(w[k:k + size - 1], ' ') AS t
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT r, k, size, item FROM shown JOIN windows USING (t, size)),
places AS (SELECT DISTINCT r, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT r, k, size FROM h)),
islands AS (SELECT r, min(p) AS a, max(p) AS b FROM (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS g FROM places) GROUP BY r, g),
spans AS (
  SELECT r, string_agg(a0::VARCHAR || ':' || b0::VARCHAR, ',' ORDER BY a0) AS spans
  FROM (SELECT r, coalesce(list_sum(list_transform(gaps[1:a], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(w[1:a - 1], lambda x: length(x))), 0)::BIGINT AS a0,
               coalesce(list_sum(list_transform(gaps[1:b], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(w[1:b], lambda x: length(x))), 0)::BIGINT AS b0
        FROM islands JOIN d USING (r)) GROUP BY r),
hits AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * {share} >= len(w) AS contaminated,
       coalesce(spans.spans, '') AS spans
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r) LEFT JOIN spans USING (r)
"""


def _weight(column: str, weights: Mapping[str, int]) -> str:
    cases = "".join(f" WHEN {column} = '{k}' THEN {int(v)}" for k, v in weights.items())
    return f"(CASE{cases} ELSE 1 END)" if cases else "1"


def _level(name: str, before: str, path: list[str], weight: str) -> str:
    """One level of water-filling as four views."""
    keys, parent = ", ".join(path), ", ".join(path[:-1])
    family = f"PARTITION BY {parent}" if parent else ""
    budget = f"JOIN {before} USING ({parent})" if parent else f"CROSS JOIN {before}"
    return f"""
{name}_nodes AS (
  SELECT n.*, budget, {weight}::HUGEINT AS weight
  FROM (SELECT {keys}, sum(capacity)::HUGEINT AS capacity FROM leaves GROUP BY {keys}) n {budget}),
{name}_order AS (
  SELECT *, sum(weight) OVER ({family})::HUGEINT - coalesce(sum(weight) OVER w, 0)::HUGEINT AS weights, budget - coalesce(sum(capacity) OVER w, 0)::HUGEINT AS rest
  FROM {name}_nodes
  WINDOW w AS ({family} ORDER BY CASE WHEN weight > 0 THEN capacity::DOUBLE / weight::DOUBLE ELSE 'infinity'::DOUBLE END, {path[-1]}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_full AS (SELECT *, weight > 0 AND capacity * weights <= weight * rest AS filled FROM {name}_order),
{name} AS (
  SELECT {keys}, greatest(0, CASE WHEN filled THEN capacity WHEN weight > 0 THEN
      weight * (budget - coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({family}), 0)::HUGEINT)
      // (sum(weight) OVER ({family}) - coalesce(sum(CASE WHEN filled THEN weight END) OVER ({family}), 0))::HUGEINT ELSE 0 END)::HUGEINT AS budget
  FROM {name}_full)"""


def mixing_sql(weights: Mapping[str, Mapping[str, int]], max_epochs: int, seed: int, domains: int = 4) -> str:
    """The mixing plan with one window over each leaf's epochs."""
    nothing = [f"{c} IN ({', '.join(repr(k) for k, v in w.items() if v <= 0)})" for c, w in weights.items() if any(v <= 0 for v in w.values())]
    capacity = f"CASE WHEN {' OR '.join(nothing)} THEN 0 ELSE sum(tokens) * {max_epochs} END" if nothing else f"sum(tokens) * {max_epochs}"
    return rf"""
WITH counted AS (
  SELECT doc_id, CASE WHEN number <> '' THEN 'domain' || (number::BIGINT % {domains})::VARCHAR ELSE 'unknown' END AS domain, lang, source, tokens
  FROM (SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, coalesce(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS number,
               len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS tokens FROM documents)
  WHERE tokens > 0),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS leaf_tokens, ({capacity})::HUGEINT AS capacity FROM counted GROUP BY domain, lang, source),
root AS (SELECT least((SELECT sum(leaf_tokens) FROM leaves), (SELECT sum(capacity) FROM leaves))::HUGEINT AS budget),
{_level('by_domain', 'root', ['domain'], _weight('domain', weights.get('domain', {})))},
{_level('by_lang', 'by_domain', ['domain', 'lang'], _weight('lang', weights.get('lang', {})))},
{_level('by_source', 'by_lang', ['domain', 'lang', 'source'], _weight('source', weights.get('source', {})))},
targets AS (SELECT domain, lang, source, leaf_tokens::BIGINT AS leaf_tokens, least(budget, capacity)::BIGINT AS target FROM leaves JOIN by_source USING (domain, lang, source)),
epochs AS (
  SELECT c.*, t.leaf_tokens, t.target, unnest(range(0, (t.target + t.leaf_tokens - 1) // t.leaf_tokens))::INTEGER AS epoch
  FROM counted c JOIN targets t USING (domain, lang, source) WHERE t.target > 0),
placed AS (
  SELECT *, epoch * leaf_tokens + coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch
      ORDER BY substr(md5('{seed}:' || epoch::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM epochs)
SELECT doc_id, domain, lang, source, epoch, tokens, start::BIGINT AS stream_start, least(tokens, target - start)::BIGINT AS tokens_taken
FROM placed WHERE start < target
"""
