"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from matchweave.llm.rules import POLICIES, mask

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents
), grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '[A-Z][A-Z]'))::BIGINT AS n_caps_pairs
  FROM d JOIN lines USING (r) LEFT JOIN covered USING (r)
), b AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
    + 64 * (4 * n_caps_pairs > word_chars)::INT)::BIGINT AS fail_bits
  FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""

ABLATION = f"""
WITH marked AS ({RULES}), rules AS (
  SELECT unnest({list(POLICIES["v2"])}) AS rule, unnest({[mask([name]) for name in POLICIES["v2"]]}) AS bit
), failed AS (
  SELECT fail_bits & {mask(POLICIES["v2"])} AS bits FROM marked
)
SELECT rule, (count(*) FILTER (bits & bit <> 0))::BIGINT AS n_failed, (count(*) FILTER (bits = bit))::BIGINT AS n_only,
  (count(*) FILTER (bits = 0 OR bits = bit))::BIGINT AS n_kept_without
FROM rules, failed GROUP BY rule
"""

_NORMAL = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

WINNOWING = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_NORMAL} AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_NORMAL} AS w FROM benchmark) WHERE len(w) > 0
), items AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)
), windows AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)
), hits AS (
  SELECT r, i, windows.k AS k, item_id FROM windows JOIN items ON windows.k = items.k AND windows.g = items.g
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r
), s AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""

PHRASES = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k))
  GROUP BY lang, k, phrase HAVING count(*) >= 30
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS b
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE b IS NULL OR 100 * b < 80 * a
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, j, ((2000000 * a::HUGEINT) // (x.f + y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) JOIN totals USING (lang) WHERE rank <= 2000
"""

PASSAGES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), again AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1
), gone AS (
  SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM again) GROUP BY r
), numbered AS (
  SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM numbered WHERE NOT EXISTS (SELECT 1 FROM (SELECT r AS gr, unnest(ps) AS gp FROM gone) WHERE gr = r AND gp = p) GROUP BY r
), spans AS (
  SELECT r, count(*) AS n_spans FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM again) WHERE before IS NULL OR i > before + 35 GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN spans USING (r)
"""


def _clusters(rounds: int = 10) -> str:
    """Rounds of assigning and averaging, each a pair of table expressions."""
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS (SELECT row, v, arg_min(cluster, (distance, cluster)) AS cluster FROM (SELECT row, v, cluster, {_DISTANCE} AS distance FROM kept, c{k}) GROUP BY row, v)")
        steps.append(f"s{k} AS (SELECT cluster, d, floor(sum(x) / count(*)) AS est, sum(x)::HUGEINT AS total, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM a{k}) GROUP BY cluster, d)")
        floor = "(CASE WHEN total >= 0 THEN total // n ELSE -((-total + n - 1) // n) END)::BIGINT"
        steps.append(f"m{k} AS (SELECT cluster, list({floor} ORDER BY d) AS c FROM s{k} GROUP BY cluster)")
        steps.append(f"c{k + 1} AS (SELECT cluster, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))")
    return ",\n".join(steps)


_DISTANCE = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"

CLUSTERS = rf"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS v
  FROM whole WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INTEGER AS cluster, v AS c FROM kept QUALIFY cluster < 8
),
{_clusters()},
done AS (
  SELECT row, vec_id, min((distance, cluster)) AS best FROM (SELECT row, vec_id, cluster, {_DISTANCE} AS distance FROM kept, c10) GROUP BY row, vec_id
), flat AS (
  SELECT vec_id, best[2] AS cluster, best[1] AS distance FROM done
)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM flat JOIN c10 USING (cluster)
"""

ORACLES = {"op1_rule_ledger": RULES, "rule_ablation": ABLATION, "op6_winnowing": WINNOWING, "op11_phrase_graph": PHRASES, "op12_shard_fm_index": PASSAGES, "op13_va_file_clusters": CLUSTERS}
