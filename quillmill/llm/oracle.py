"""SQL of the queries that can be said in it, for DuckDB."""

from __future__ import annotations

from quillmill.llm import decontam, mixing, repetition, secrets

SQL: dict[str, str] = {}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(k: int, pattern: str, group: int, keep: str) -> str:
    return f"""
    SELECT doc_id, owner, repo, {k} AS k, beg, beg + length(m) AS stop, v
    FROM (
        SELECT doc_id, owner, repo, f[i] AS m, v[i] AS v,
               CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS beg
        FROM (
            SELECT doc_id, owner, repo, regexp_extract_all(text, {_q(pattern)}, 0) AS f,
                   regexp_extract_all(text, {_q(pattern)}, {group}) AS v, string_split_regex(text, {_q(pattern)}) AS g
            FROM docs WHERE regexp_matches(text, {_q(pattern)})
        ), unnest(range(1, len(f) + 1)) AS r(i)
    ) WHERE {keep}"""


SQL["op8_secrets"] = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(lang, '') AS repo FROM documents
), found AS (
    {_matches(0, secrets.ASSIGN, 2, "length(v) >= 8")}
    UNION ALL {_matches(1, secrets.ACCESS, 0, "true")}
    UNION ALL {_matches(2, secrets.HEX, 0, "true")}
    UNION ALL {_matches(3, secrets.OPAQUE, 0, "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')")}
), held AS (
    SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos FROM found GROUP BY v
), judged AS (
    SELECT f.*, n_owners, n_repos, n_owners < {secrets.EXAMPLE_OWNERS} AND n_repos < {secrets.EXAMPLE_REPOS} AND len(list_distinct(string_split(f.v, ''))) >= {secrets.LEAST_CHARACTERS}
        AND NOT regexp_matches(f.v, {_q(secrets.PLACEHOLDERS)}) AS live
    FROM found f JOIN held h ON f.v = h.v
), kept AS (
    SELECT * FROM judged j WHERE k < 3 OR live AND NOT EXISTS (
        SELECT 1 FROM found b WHERE b.doc_id = j.doc_id AND b.k < 3 AND b.beg < j.stop AND j.beg < b.stop)
), texts AS (
    SELECT doc_id, k, beg, live, n_owners || ':' || n_repos AS held_by, (['assign', 'access', 'hex', 'opaque'])[k + 1] || ':' || beg || ':' || stop AS span FROM kept
), per_doc AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           string_agg(span, ',' ORDER BY beg, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY beg, k) AS spans,
           count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example, string_agg(held_by, ',' ORDER BY beg, k) AS held_by
    FROM texts GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(held_by, '') AS held_by
FROM docs d LEFT JOIN per_doc p USING (doc_id)
"""


_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    f"{_q(decontam.WORD_BREAK)}), lambda x: x <> '')"
)

SQL["op4_decontam"] = f"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark
), held AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + {decontam.WINDOW - 1}], ' ') AS phrase, least(len(w), {decontam.WINDOW}) AS size
    FROM items, unnest(range(1, greatest(len(w) - {decontam.WINDOW - 1}, 1) + 1)) AS r(i) WHERE len(w) > 0
), docs AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), sizes AS (
    SELECT DISTINCT size FROM held
), hits AS (
    SELECT d.doc_id, i, s.size, h.item_id
    FROM docs d, sizes s, unnest(range(1, len(w) - s.size + 2)) AS r(i)
    JOIN held h ON h.phrase = array_to_string(w[i:i + s.size - 1], ' ') AND h.size = s.size
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


_BLANK = r"[\x20\x09-\x0D]+"


def _repeated(size: int) -> str:
    """Words of each text in windows of ``size`` words that occur twice in it."""
    return f"""
        SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(i, i + {size})) AS p FROM (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + {size - 1}], ' ')) AS times
                FROM docs, unnest(range(1, len(w) - {size - 2})) AS r(i)
            ) WHERE times > 1
        ) GROUP BY doc_id"""


SQL["op2_repetition"] = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), {_q(_BLANK)}), lambda x: x <> '') AS w
    FROM documents
), lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), eights AS ({_repeated(repetition.WINDOW)}
), fives AS ({_repeated(repetition.SHORTEST)}
), longer AS ({_repeated(repetition.LONGEST + 1)}
), measured AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
           coalesce(e.n, 0) AS n_repeat_words, coalesce(f.n, 0) AS n_covered, g.n IS NULL AS short_repeats
    FROM docs d LEFT JOIN lines l USING (doc_id) LEFT JOIN eights e USING (doc_id) LEFT JOIN fives f USING (doc_id) LEFT JOIN longer g USING (doc_id)
), ruled AS (
    SELECT *, n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_covered <= {repetition.MOST_COVERED_PERCENT} * n_words AND short_repeats AS kept
FROM ruled
"""


SQL["op11_negatives"] = """
WITH usable AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), held AS (
    SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM held a JOIN held r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positive AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3
"""


_MIX_OFFSET = "CAST(('0x' || substr(md5('{seed}:' || {name}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"

SQL["op13_mix"] = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_q(mixing.WORD)})), 0) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST(([{", ".join(map(str, mixing.WEIGHTS))}])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS INTEGER) + 1] AS DOUBLE) AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *, {mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce({mixing.MOST} * sum(source_size) OVER below, 0) AS rest,
           sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS left_w
    FROM sources WINDOW below AS (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
    SELECT source FROM levels WHERE w * rest / left_w > {mixing.MOST} * source_size
), level AS (
    SELECT {mixing.SHARE}::DOUBLE * sum(source_size) - {mixing.MOST} * coalesce(sum(source_size) FILTER (is_capped), 0) AS rest,
           sum(w) FILTER (NOT is_capped) AS left_w
    FROM (SELECT *, EXISTS (SELECT 1 FROM capped c WHERE c.source IS NOT DISTINCT FROM s.source) AS is_capped FROM sources s)
), targets AS (
    SELECT s.source, source_size, least(w * rest / left_w, CAST({mixing.MOST} * source_size AS DOUBLE)) AS target,
           {_MIX_OFFSET.format(seed=mixing.SEED, name="CASE WHEN s.source IS NULL THEN 'none' ELSE 'source:' || s.source END")} AS u
    FROM sources s, level
), placed AS (
    SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
           row_number() OVER (PARTITION BY d.source ORDER BY size DESC, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS nth
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(floor((nth + 1) * rate + u) - floor(nth * rate + u), ceil(rate)) * size AS BIGINT) AS taken
FROM placed
"""
