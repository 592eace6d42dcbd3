"""The registered queries in SQL, written from their meaning and not from their plans."""

from __future__ import annotations

from quillmill.operators import documents
from quillmill.plans.catalog import RANK_QUERY
from quillmill.plans.inputs import AS_OF, CREATED

SQL: dict[str, str] = {}

_TITLE = r"regexp_extract(text, '^[^.!?\n]*')"
_SPACE = r"[\s\x0b\x1c-\x1f\x85\pZ]+"


def _clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'))"


def _words(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\pL\pN]+')"


def _add(name: str, body: str, *parts: str) -> None:
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    SQL[name] = head + body


# -- the views ------------------------------------------------------------------------------------

HITS = f"""
hashed AS (SELECT *, substr(sha256(text), 1, 12) AS h FROM documents),
hits AS (
    SELECT {_TITLE} AS title,
        CASE substr(h, 1, 1)
            WHEN '0' THEN '10.48550/arXiv.' || h
            WHEN '1' THEN '10.1145/' || h
            WHEN '2' THEN '10.20944/preprints' || h
            WHEN '3' THEN '10.31219/OSF.io/' || h || '_v1'
            WHEN '4' THEN '10.22541/au.' || h
            WHEN '5' THEN ''
            WHEN '6' THEN NULL
            ELSE '10.1000/' || upper(h) END AS doi,
        CASE lang
            WHEN 'de' THEN 'https://files.example.org/' || h || '.pdf'
            WHEN 'es' THEN 'https://www.preprints.org/manuscript/' || doc_id || '/v1//'
            ELSE 'https://doi.org/' || h END AS url,
        2000 + n_chars % 25 AS year, source, (n_chars % 100) / 100.0 AS score,
        doc_id AS ord, doc_id, lang, h, sha256(text) AS sha256
    FROM hashed)"""

RESOLVED = (
    HITS
    + """,
oa AS (
    SELECT lower(doi) AS k, min('https://oa.example.org/' || h || '.pdf') AS oa_url
    FROM hits WHERE doi <> '' AND lang NOT IN ('es', 'fr') GROUP BY 1),
pmc AS (
    SELECT lower(doi) AS k, arg_min(struct_pack(v := CASE WHEN toxic = 0 THEN 'PMC' || doc_id END), doc_id).v AS pmcid
    FROM hits JOIN labels USING (doc_id) WHERE doi <> '' GROUP BY 1),
matched AS (
    SELECT hits.*, CASE
        WHEN url LIKE '%.pdf' THEN [url, source]
        WHEN coalesce(doi, '') = '' THEN NULL
        WHEN starts_with(lower(doi), '10.48550/arxiv.') THEN ['https://arxiv.org/pdf/' || substr(lower(doi), 16) || '.pdf', 'arxiv']
        WHEN oa_url IS NOT NULL THEN [oa_url, 'unpaywall']
        WHEN pmcid IS NOT NULL THEN ['https://www.ncbi.nlm.nih.gov/pmc/articles/' || pmcid || '/pdf', 'pmc']
        WHEN starts_with(lower(doi), '10.1145/') THEN ['https://dl.acm.org/doi/pdf/' || lower(doi), 'acm']
        WHEN starts_with(lower(doi), '10.20944/preprints') AND contains(url, '/manuscript/') THEN [rtrim(url, '/') || '/download/pdf', 'preprints']
        WHEN starts_with(lower(doi), '10.31219/osf.io/') THEN ['https://osf.io/' || replace(substr(lower(doi), 17), '_v1', '') || '/download', 'osf']
        WHEN starts_with(lower(doi), '10.22541/au.') THEN ['https://www.authorea.com/doi/pdf/' || lower(doi), 'authorea']
        END AS found
    FROM hits LEFT JOIN oa ON lower(doi) = oa.k LEFT JOIN pmc ON lower(doi) = pmc.k),
resolved AS (SELECT * EXCLUDE (found), found[1] AS pdf_url, found[2] AS resolver_source FROM matched)"""
)

PAPERS = (
    HITS
    + f""",
incoming AS (SELECT doi, title, year, url AS pdf_url, sha256, source, ord FROM hits WHERE doi IS NULL OR doi <> ''),
papers AS (
    SELECT doc_id AS id, doi, 'old ' || title AS title, lang AS authors, 1999 AS year, url AS pdf_url, h AS sha256, source,
        TIMESTAMP '{CREATED}' AS created_at, TIMESTAMP '{CREATED}' AS updated_at
    FROM hits SEMI JOIN labels USING (doc_id) WHERE doi <> ''
    QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ord) = 1),
latest AS (
    SELECT * FROM incoming WHERE doi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ord DESC) = 1
    UNION ALL SELECT * FROM incoming WHERE doi IS NULL)"""
)

TOPICS = r"""
asked AS (
    SELECT item_id, regexp_extract(text, '^[^\pL]*([\pL]+[^\pL]+[\pL]+)', 1) AS topic FROM benchmark)"""

VECTORS = """
vectors AS (
    SELECT vec_id AS paper_id, label, embedding, ['title', 'abstract', 'full_text'][label % 3 + 1] AS embedding_type
    FROM embeddings),
query AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0),
scored AS (
    SELECT vectors.*, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS similarity FROM vectors, query)"""

CENTRES = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m FROM parts GROUP BY ALL),
centres AS (SELECT label, list(m ORDER BY pos) AS centre FROM means GROUP BY label)"""

TITLED = f"titled AS (SELECT doc_id AS paper_id, {_TITLE} AS title FROM documents)"

EDGES = """
edges AS (
    SELECT l_partkey AS source_paper_id, l_suppkey AS target_paper_id,
        CASE l_returnflag WHEN 'A' THEN 'cites' WHEN 'R' THEN 'cited_by' ELSE 'related_to' END AS relationship_type,
        max(l_discount) AS confidence
    FROM lineitem GROUP BY ALL)"""

METADATA = """
metadata AS (
    SELECT user_id AS paper_id, event_type AS key, props AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)"""

FETCHES = """
fetches AS (
    SELECT url AS pdf_url, event_id AS attempt, html,
        CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 403 ELSE 200 END AS status
    FROM events JOIN pages ON page_id = user_id)"""

QUEUE = f"""
queue AS (
    SELECT c_custkey AS ingest_id, c_name AS file_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'pending' ELSE 'done' END AS status,
        0::BIGINT AS retries, CAST(NULL AS VARCHAR) AS last_error, TIMESTAMP '{CREATED}' AS updated_at
    FROM customer)"""


def _status(blank: str) -> str:
    return f"""
reports AS (
    SELECT user_id AS ingest_id, event_id AS ord, event_type AS status,
        CASE event_type WHEN 'error' THEN 'code ' || json_extract_string(props, '$.k') {blank} END AS error
    FROM events),
folded AS (
    SELECT ingest_id, arg_max(status, ord) AS status, arg_max(error, ord) FILTER (WHERE error <> '') AS last_error,
        count(*) FILTER (WHERE error <> '') AS errors
    FROM reports GROUP BY ingest_id)"""


# -- sources and sinks -----------------------------------------------------------------------------

_add(
    "hit_json_roundtrip",
    "SELECT title, coalesce(doi, '') AS doi, url, year, source, score FROM hits",
    HITS,
)
SQL["hit_json_arrays"] = SQL["hit_json_roundtrip"]
_add(
    "resolved_json_roundtrip",
    "SELECT title, doi, url, year, source, score, pdf_url, resolver_source FROM resolved WHERE pdf_url IS NOT NULL",
    RESOLVED,
)
_add(
    "stored_files",
    """SELECT sha256(text) AS sha256, sha256(text) || '.pdf' AS file_path, strlen(any_value(text)) AS size, count(*) AS copies
    FROM documents GROUP BY 1, 2""",
)
_add(
    "accepted_fetches",
    "SELECT pdf_url, attempt, sha256(html) AS sha256, strlen(html) AS size FROM fetches WHERE status = 200",
    FETCHES,
)
_add(
    "rejected_fetches",
    "SELECT 'download' AS stage, pdf_url AS key, 'HTTP ' || status AS reason FROM fetches WHERE status <> 200",
    FETCHES,
)
_add("paper_ids", "SELECT id FROM papers ORDER BY id", PAPERS)

# -- topics, search, resolution --------------------------------------------------------------------

_add(
    "topic_queries",
    """SELECT topic, 0::BIGINT AS query_idx, topic AS query FROM topics
    UNION ALL SELECT topic, 1, lower(topic) FROM topics WHERE lower(topic) <> topic
    UNION ALL SELECT topic, CASE WHEN lower(topic) = topic THEN 1 ELSE 2 END, topic || ' review' FROM topics""",
    TOPICS,
    "topics AS (SELECT DISTINCT topic FROM asked)",
)
SEARCH = f"""
found AS (
    SELECT item_id AS query_idx, CASE WHEN lang = 'en' THEN 0::BIGINT ELSE 1 END AS source_idx, doc_id AS hit_idx, title, doi, url
    FROM asked JOIN hits ON list_has_all({_words('title')}, {_words('topic')}) WHERE len({_words('topic')}) > 0)"""
_add("provider_search", "SELECT * FROM found", TOPICS, HITS, SEARCH)
_add(
    "search_and_merge",
    """SELECT query_idx, source_idx, hit_idx, doi, title FROM found WHERE doi <> ''
    QUALIFY row_number() OVER (PARTITION BY doi ORDER BY query_idx, source_idx, hit_idx) = 1""",
    TOPICS, HITS, SEARCH,
)
_add(
    "coerced_hits",
    """SELECT title, coalesce(doi, '') AS doi, '' AS url, CASE WHEN lang = 'en' THEN year ELSE 0 END AS year,
        'unknown' AS source, 0.0::DOUBLE AS score, doc_id FROM hits""",
    HITS,
)
_add(
    "union_sources",
    "SELECT title, doi, doc_id AS hit_idx, CASE WHEN lang = 'en' THEN 0::BIGINT ELSE 1 END AS source_idx FROM hits",
    HITS,
)
_add("resolver_chain", "SELECT doc_id, doi, url, pdf_url, resolver_source FROM resolved", RESOLVED)
_add("unresolved_hits", "SELECT title, doi, url, year, source, score FROM resolved WHERE pdf_url IS NULL", RESOLVED)
SQL["unresolved_hits"] = SQL["unresolved_hits"].replace("url, year, source, score FROM", "url, source FROM")
_add(
    "resolve_success_rate",
    "SELECT count(*) AS total, count(pdf_url) AS resolved, round(count(pdf_url) / count(*) * 100, 6) AS success_rate FROM resolved",
    RESOLVED,
)
_add(
    "fetch_plan",
    """SELECT pdf_url, 0::BIGINT AS try_no, replace(pdf_url, '/pdf', '/pdf/') AS request_url,
        'https://www.ncbi.nlm.nih.gov/' AS referer, 13::BIGINT AS n_headers
    FROM resolved WHERE pdf_url LIKE '%ncbi.nlm.nih.gov%' AND pdf_url LIKE '%/pdf%'
    UNION ALL
    SELECT pdf_url, CASE WHEN pdf_url LIKE '%ncbi.nlm.nih.gov%' AND pdf_url LIKE '%/pdf%' THEN 1 ELSE 0 END, pdf_url,
        CASE WHEN pdf_url LIKE '%ncbi.nlm.nih.gov%' THEN 'https://www.ncbi.nlm.nih.gov/' END,
        CASE WHEN pdf_url LIKE '%ncbi.nlm.nih.gov%' THEN 13 ELSE 11 END
    FROM resolved WHERE pdf_url IS NOT NULL""",
    RESOLVED,
)
FOUND = f"""
matching AS (
    SELECT *, CASE WHEN lang = 'en' THEN 0::BIGINT ELSE 1 END AS source_idx FROM resolved WHERE doi <> '' AND EXISTS (
        SELECT 1 FROM asked WHERE len({_words('topic')}) > 0 AND list_has_all({_words('title')}, {_words('topic')}))),
merged AS (SELECT * FROM matching QUALIFY row_number() OVER (PARTITION BY doi ORDER BY source_idx, doc_id) = 1),
located AS (
    SELECT * FROM merged WHERE pdf_url IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY pdf_url ORDER BY source_idx, doc_id) = 1)"""
_add("found_papers", "SELECT doi, pdf_url, resolver_source FROM located", RESOLVED, TOPICS, FOUND)
_add(
    "topic_to_papers",
    """SELECT doi, pdf_url, body_sha256 AS sha256, resolver_source AS source FROM located JOIN bodies USING (pdf_url)
    QUALIFY row_number() OVER (PARTITION BY body_sha256 ORDER BY source_idx, doc_id) = 1""",
    RESOLVED, TOPICS, FOUND,
    """bodies AS (
        SELECT pdf_url, sha256 AS body_sha256 FROM resolved WHERE pdf_url IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY pdf_url ORDER BY ord) = 1)""",
)

# -- de-duplication and statistics -----------------------------------------------------------------

_add(
    "merge_hits",
    """SELECT title, doi, url, year, source, score, ord FROM hits WHERE doi <> ''
    QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ord) = 1""",
    HITS,
)
_add(
    "unique_urls",
    """SELECT pdf_url, resolver_source, doc_id FROM resolved WHERE pdf_url IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY pdf_url ORDER BY ord) = 1""",
    RESOLVED,
)
_add(
    "drop_processed",
    "SELECT doc_id, url AS pdf_url FROM hits WHERE url NOT IN (SELECT url FROM hits SEMI JOIN labels USING (doc_id))",
    HITS,
)
_add(
    "content_dedup",
    """SELECT doc_id, sha256(text) AS sha256, lang FROM documents
    QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1""",
)
_add(
    "content_rejects",
    """SELECT doc_id, sha256(text) AS sha256, 'duplicate_sha256' AS reason FROM documents
    QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) > 1""",
)
_add(
    "merge_by_title",
    """SELECT doc_id, title FROM keyed
    QUALIFY len(w) = 0 OR row_number() OVER (PARTITION BY w ORDER BY ord) = 1""",
    HITS,
    f"keyed AS (SELECT *, list_sort({_words('title')}) AS w FROM hits)",
)
_add(
    "merge_similar_titles",
    """SELECT doc_id, title FROM keyed WHERE t = '' OR ord IN (SELECT id FROM titles) AND ord NOT IN (SELECT x FROM reached WHERE y < x)""",
    HITS,
    f"""keyed AS (SELECT *, array_to_string({_words('title')}, ' ') AS t FROM hits),
titles AS (SELECT t, min(ord) AS id FROM keyed WHERE t <> '' GROUP BY t),
near AS (
    SELECT a.id AS x, b.id AS y FROM titles a JOIN titles b ON a.id <> b.id
        AND least(length(a.t), length(b.t)) >= 0.85 * greatest(length(a.t), length(b.t)) - 0.000000001
        AND levenshtein(a.t, b.t) <= floor(greatest(length(a.t), length(b.t)) * (1 - 0.85::DOUBLE) + 0.000000001))""",
    "reached(x, y) AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reached r JOIN near n ON r.y = n.x)",
)
SQL["merge_similar_titles"] = SQL["merge_similar_titles"].replace("WITH ", "WITH RECURSIVE ", 1)
_add("unique_items", "SELECT count(DISTINCT pdf_url) AS unique_items FROM resolved", RESOLVED)
_add(
    "dedup_ratio",
    """SELECT count(*) AS before, count(DISTINCT pdf_url) AS after, round(count(DISTINCT pdf_url) / count(*), 6) AS kept_ratio
    FROM resolved WHERE pdf_url IS NOT NULL""",
    RESOLVED,
)
_add(
    "text_stats",
    """SELECT lang, count(*) AS documents, sum(length(text))::BIGINT AS chars, max(length(text)) AS longest,
        sum(ceil(length(text) / 4000.0))::BIGINT AS chunks
    FROM documents GROUP BY lang""",
)
_add(
    "stage_dashboard",
    """SELECT event_type AS stage, count(*) AS items, count(*) FILTER (WHERE value < 20) AS succeeded,
        round(avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) * 100, 6) AS success_rate, max(ts) AS last_at
    FROM events GROUP BY 1""",
)

# -- summaries (also used by the digest) -------------------------------------------------------------

_CUES = "\n".join(
    f"UNION ALL SELECT '{kind}', unnest([{', '.join(repr(c) for c in cues)}])"
    for kind, cues in documents.SUMMARY_CUES.items()
    if cues
).removeprefix("UNION ALL ")
_KINDS = ", ".join(f"'{kind}'" for kind in documents.SUMMARY_CUES)
def _summaries(source: str, key: str = "doc_id") -> str:
    """Summaries of the texts of ``source``, one row for each ``key``."""
    return f"""
cues(kind, cue) AS ({_CUES}),
runs AS (SELECT {key} AS doc_id, regexp_extract_all(text, '[^.!?]+[.!?]*') AS raw FROM {source}),
cleaned AS (
    SELECT doc_id, list_filter(list_transform(raw, lambda r: {_clean('r')}), lambda r: length(r) > 0) AS s FROM runs),
sentences AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS sentence_no FROM cleaned),
worded AS (SELECT *, {_words('sentence')} AS words FROM sentences),
flat AS (SELECT doc_id, sentence_no, unnest(words) AS word FROM worded),
counts AS (SELECT doc_id, word, count(*) AS n FROM flat GROUP BY ALL),
scores AS (
    SELECT doc_id, sentence_no, sum(n)::BIGINT * 1000 // count(*) AS score
    FROM flat JOIN counts USING (doc_id, word) GROUP BY ALL),
kinds AS (SELECT unnest([{_KINDS}]) AS summary_type),
ranked AS (
    SELECT doc_id, summary_type, sentence_no, sentence FROM worded JOIN scores USING (doc_id, sentence_no), kinds
    QUALIFY row_number() OVER (PARTITION BY doc_id, summary_type ORDER BY
        EXISTS (SELECT 1 FROM cues WHERE kind = summary_type AND list_contains(words, cue)) DESC, score DESC, sentence_no) <= 3),
summaries AS (
    SELECT doc_id, summary_type, string_agg(sentence, ' ' ORDER BY sentence_no) AS content FROM ranked GROUP BY ALL)"""


SUMMARIES = _summaries("documents")
_add("extractive_summaries", "SELECT * FROM summaries", SUMMARIES)
_add(
    "complete_summaries",
    """SELECT doc_id, summary_type FROM summaries WHERE length(content) >= 40
    QUALIFY count(*) OVER (PARTITION BY doc_id) = 4""",
    SUMMARIES,
)
_add(
    "topic_digest",
    """SELECT topic, rank, doc_id AS paper_id, title, year, content
    FROM top LEFT JOIN (SELECT * FROM summaries WHERE summary_type = 'executive') USING (doc_id)""",
    HITS, SUMMARIES,
    """top AS (
        SELECT lang AS topic, doc_id, title, year,
            row_number() OVER (PARTITION BY lang ORDER BY score DESC, year DESC, doc_id) AS rank
        FROM hits QUALIFY rank <= 3)""",
)

# -- relevance -----------------------------------------------------------------------------------------


def _scores(source: str, query: str) -> str:
    """Scores of ``source(ord, sentence)`` for the word counts ``query(query_id, word, tf)``."""
    return f"""
source AS ({source}),
own AS (SELECT ord, sentence, list_distinct({_words('sentence')}) AS w FROM source),
asked_words AS ({query}),
present AS (SELECT unnest(w) AS word FROM own),
dfs AS (SELECT word, count(*) AS df FROM present GROUP BY word),
weights AS (
    SELECT query_id, word, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM source)) / (1 + coalesce(df, 0))) + 1) AS w
    FROM asked_words LEFT JOIN dfs USING (word)),
lengths AS (SELECT query_id, sqrt(sum(w * w)) AS len FROM weights GROUP BY query_id),
exploded AS (SELECT ord, unnest(w) AS word, len(w) AS n FROM own),
sums AS (
    SELECT query_id, ord, sum(weights.w) / any_value(len) / sqrt(any_value(n)) AS score
    FROM exploded JOIN weights USING (word) JOIN lengths USING (query_id) GROUP BY ALL)"""


_TITLE_ROWS = f"SELECT doc_id AS ord, {_TITLE} AS sentence FROM documents"
_ONE_QUERY = f"""
    SELECT 0 AS query_id, word, count(*) AS tf FROM (SELECT unnest({_words(repr(RANK_QUERY))}) AS word) GROUP BY word"""
_ALL = "SELECT ord, sentence, round(round(coalesce(score, 0), 9), 6) AS score FROM source LEFT JOIN sums USING (ord)"
_add("rank_titles", _ALL, _scores(_TITLE_ROWS, _ONE_QUERY))
_add("relevance_filter", _ALL + " WHERE round(score, 9) >= 0.35", _scores(_TITLE_ROWS, _ONE_QUERY))
_add("ranked_titles_json", _ALL.replace("SELECT ord, ", "SELECT "), _scores(_TITLE_ROWS, _ONE_QUERY))
_add(
    "rank_passages",
    "SELECT ord AS corpus_id, sentence AS text, round(round(coalesce(score, 0), 9), 6) AS score FROM source LEFT JOIN sums USING (ord)",
    _scores("SELECT item_id AS ord, text AS sentence FROM benchmark", _ONE_QUERY),
)
_add(
    "top_titles_per_query",
    """SELECT query_id, ord, round(round(score, 9), 6) AS score,
        row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, ord) AS rank
    FROM sums WHERE round(score, 9) > 0 QUALIFY rank <= 5""",
    _scores(
        _TITLE_ROWS,
        f"SELECT item_id AS query_id, word, count(*) AS tf FROM (SELECT item_id, unnest({_words('text')}) AS word FROM benchmark) GROUP BY ALL",
    ),
)

_add(
    "rank_pairs",
    """SELECT doc_id, round(round(coalesce(sum(w) FILTER (held) / (sqrt(sum(w * w)) * sqrt(any_value(n))), 0), 9), 6) AS score
    FROM pairs LEFT JOIN weighed USING (doc_id) GROUP BY doc_id""",
    f"""pairs AS (
        SELECT doc_id, {_words("title")} AS asked, list_distinct({_words("rest")}) AS own
        FROM (SELECT doc_id, {_TITLE} AS title, substr(text, length({_TITLE}) + 1) AS rest FROM documents))""",
    """weighed AS (
        SELECT doc_id, (1 + ln(tf)) * CASE WHEN held THEN 1 ELSE 1 + ln(2) END AS w, held, n FROM (
            SELECT doc_id, count(*) AS tf, list_contains(any_value(own), word) AS held, nullif(len(any_value(own)), 0) AS n
            FROM (SELECT doc_id, own, unnest(asked) AS word FROM pairs) GROUP BY doc_id, word))""",
)
_LETTER_WORDS = "list_distinct(regexp_extract_all({0}, '[A-Za-z]+'))"
_add(
    "rank_titles_by_model",
    f"""SELECT ord, sentence, round(coalesce(len(list_intersect(a, b)) / nullif(len(list_distinct(list_concat(a, b))), 0), 0), 6) AS score
    FROM (SELECT *, {_LETTER_WORDS.format(repr(RANK_QUERY))} AS a, {_LETTER_WORDS.format("sentence")} AS b FROM titles)""",
    f"titles AS ({_TITLE_ROWS})",
)

# -- text ------------------------------------------------------------------------------------------------

_add(
    "clean_text",
    f"""SELECT doc_id, sha256({_clean('text')}) AS clean_sha256, length({_clean('text')}) AS clean_chars,
        ceil(length(text) / 4.0)::BIGINT AS tokens FROM documents""",
)
_NO_TAGS = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), "
    r"'(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
)
_DECODED = (
    f"replace(replace(replace(replace(replace({_NO_TAGS}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&amp;', '&')"
)
_add("html_text", f"SELECT page_id, {_clean(_DECODED)} AS text FROM pages")
TURNS = f"""
turns AS (
    SELECT conv_id, {_clean("string_agg(text, chr(10) ORDER BY turn)")} AS text FROM conversations GROUP BY conv_id)"""
_CUT = "substr(text, i::BIGINT * 4000 + 1, 4000) AS chunk"
_add(
    "assembled_turns",
    f"""SELECT conv_id, i AS chunk_no, {_CUT}
    FROM (SELECT conv_id, text, unnest(range(0, (length(text) + 3999) // 4000)) AS i FROM turns)""",
    TURNS,
)
_PARTS = "unnest(range(0, (length(text) + 29999) // 30000)) AS part_no"
_add(
    "opening_of_turns",
    f"""SELECT conv_id, part_no, substr(text, part_no * 30000 + 1, 30000) AS text FROM (SELECT conv_id, text, {_PARTS} FROM turns)""",
    TURNS,
)
_add(
    "empty_text_rejects",
    rf"""SELECT 'parse' AS stage, page_id::VARCHAR AS key, 'empty_text' AS reason FROM pages
    WHERE {_clean("regexp_extract(html, '(?s)<h2[^>]*>(.*?)</h2>', 1)")} = ''""",
)
_add(
    "chunks_4000",
    f"""SELECT doc_id, i AS chunk_no, {_CUT}
    FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 3999) // 4000)) AS i FROM documents)""",
)
_add(
    "section_slices",
    f"""SELECT doc_id, embedding_type, part_no, section_text FROM (
        SELECT doc_id, 'title' AS embedding_type, 0::BIGINT AS part_no, substr(text, 1, 200) AS section_text FROM documents
        UNION ALL SELECT doc_id, 'abstract', 0, substr(text, 201, 800) FROM documents
        UNION ALL SELECT doc_id, 'full_text', part_no, substr(text, part_no * 30000 + 1, 30000)
        FROM (SELECT doc_id, text, {_PARTS} FROM documents))
    WHERE {_clean('section_text')} <> ''""",
)
_PROMPT_ROWS = ", ".join(
    f"('{kind}', '{model}', '{instruction.strip()}')" for kind, (model, instruction) in documents.PROMPTS.items()
)
_add(
    "prompt_table",
    f"""SELECT doc_id, i AS chunk_no, summary_type, model, instruction || chr(10) || chr(10) || chunk AS prompt, 500::BIGINT AS max_tokens
    FROM (SELECT doc_id, i, {_CUT} FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 3999) // 4000)) AS i FROM documents)), prompts""",
    f"prompts(summary_type, model, instruction) AS (VALUES {_PROMPT_ROWS})",
)
KEYWORDS = f"""
long_words AS (
    SELECT doc_id, unnest(list_filter({_words('text')}, lambda w: length(w) >= 5)) AS keyword FROM documents),
tfs AS (SELECT doc_id, keyword, count(*) AS tf FROM long_words GROUP BY ALL),
kdfs AS (SELECT keyword, count(*) AS df FROM tfs GROUP BY ALL),
keyed AS (
    SELECT doc_id, keyword, round(tf * ln((SELECT count(*) FROM documents) / df), 9) AS weight FROM tfs JOIN kdfs USING (keyword)),
best AS (
    SELECT doc_id, keyword, weight, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, keyword) AS rank
    FROM keyed QUALIFY rank <= 5)"""
_add("document_keywords", "SELECT doc_id, rank, keyword, round(weight, 6) AS weight FROM best", KEYWORDS)


def _field(name: str) -> str:
    pattern = documents.METADATA_PATTERNS[name].replace("'", "''")
    if name in ("authors", "institutions"):
        every = f"regexp_extract_all(text, '{pattern}', 1)"
        return f"CASE WHEN len({every}) > 0 THEN array_to_string(list_distinct({every}), '|') END AS {name}"
    one = f"nullif(regexp_extract(text, '{pattern}', 1), '')"
    if name in ("citations", "sample_size"):
        return f"TRY_CAST(replace({one}, ',', '') AS BIGINT) AS {name}"
    return f"{one} AS {name}"


_add("metadata_fields", f"SELECT doc_id, {', '.join(map(_field, documents.METADATA_PATTERNS))} FROM documents")


def _json_field(name: str) -> str:
    """A field as JSON text: lists and strings in quotes with marks escaped, numbers as they are."""
    if name in ("citations", "sample_size"):
        return f"{name}::VARCHAR"
    if name in ("authors", "institutions"):
        return f"to_json(string_split({name}, '|'))::VARCHAR"
    return f"to_json({name})::VARCHAR"


def _field_rows(source: str, key: str) -> str:
    fields = ", ".join(map(_field, documents.METADATA_PATTERNS))
    return " UNION ALL ".join(
        f"SELECT {key}, '{name}' AS key, {_json_field(name)} AS value FROM (SELECT {key}, {fields} FROM {source}) WHERE {name} IS NOT NULL"
        for name in documents.METADATA_PATTERNS
    )


_add(
    "metadata_rows",
    f"""SELECT doc_id AS paper_id, 'keywords' AS key, '[' || string_agg('"' || keyword || '"', ',' ORDER BY rank) || ']' AS value
    FROM best GROUP BY doc_id
    UNION ALL {_field_rows('documents', 'doc_id')}""",
    KEYWORDS,
)

# -- vectors -----------------------------------------------------------------------------------------------

_TOP = "ORDER BY similarity DESC, paper_id LIMIT 10"
_OUT = "SELECT paper_id, title, round(similarity, 6) AS similarity FROM"
_add(
    "find_similar_papers",
    f"{_OUT} (SELECT * FROM scored JOIN titled USING (paper_id) WHERE similarity > 0.2 {_TOP})",
    VECTORS, TITLED,
)
SQL["find_similar_sql"] = SQL["find_similar_papers"]
_add(
    "find_similar_best_per_paper",
    f"""{_OUT} (
        SELECT label::BIGINT AS paper_id, title, max(similarity) AS similarity FROM scored JOIN titled ON label = titled.paper_id
        WHERE similarity > 0.2 GROUP BY ALL {_TOP})""",
    VECTORS, TITLED,
)
_add(
    "find_similar_by_type",
    f"""{_OUT} (SELECT * FROM scored JOIN titled USING (paper_id)
        WHERE similarity > 0.1 AND embedding_type = 'abstract' {_TOP})""",
    VECTORS, TITLED,
)
_add(
    "cosine_to_centre",
    """SELECT vec_id AS paper_id, label::BIGINT AS label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6) AS similarity,
        round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6) AS distance
    FROM embeddings JOIN centres USING (label)""",
    CENTRES,
)
_add(
    "nearest_chunks",
    """SELECT paper_id AS chunk_id, round(1 - similarity, 6) AS distance FROM scored
    ORDER BY 1 - similarity NULLS LAST, paper_id LIMIT 10""",
    VECTORS,
)
_add(
    "search_many",
    """SELECT query_id, paper_id, round(s, 6) AS similarity, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, paper_id) AS rank
    FROM pairs QUALIFY rank <= 10""",
    CENTRES,
    """pairs AS (
        SELECT centres.label::BIGINT AS query_id, vec_id AS paper_id,
            round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 9) AS s
        FROM embeddings, centres)""",
)
_add("ivf_search_all_cells", f"SELECT paper_id, round(similarity, 6) AS similarity FROM (FROM scored {_TOP})", VECTORS)
def _means(name: str, points: str, count: int, rounds: int) -> str:
    """K-means over ``points (s, place, v)``, for every ``s``: tables ``<name>_0`` to ``<name>_<rounds>`` of ``(s, c, v)``."""
    steps = [f"{name}_0 AS MATERIALIZED (SELECT s, place AS c, v FROM {points} WHERE place <= {count})"]
    for n in range(1, rounds + 1):
        steps.append(f"""
        {name}_near_{n} AS MATERIALIZED (
            SELECT p.s, o.c, p.v FROM {points} p JOIN {name}_{n - 1} o USING (s)
            QUALIFY row_number() OVER (PARTITION BY p.s, p.place ORDER BY round(list_distance(p.v, o.v) ** 2, 9), o.c) = 1),
        {name}_mean_{n} AS (
            SELECT s, c, list(x ORDER BY d) AS v FROM (
                SELECT s, c, d, round(avg(x), 9) AS x FROM (
                    SELECT s, c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM {name}_near_{n}) GROUP BY ALL)
            GROUP BY ALL),
        {name}_{n} AS MATERIALIZED (
            SELECT s, c, coalesce(m.v, o.v) AS v FROM {name}_{n - 1} o LEFT JOIN {name}_mean_{n} m USING (s, c))""")
    return ",".join(steps)


def _coded(cells: int, words: int, parts: int, rounds: int, probes: int, candidates: int) -> str:
    """``found (query_id, paper_id, similarity, rank)`` over ``asked (query_id, q)`` with ``q`` at length one."""
    sliced = f"list_slice({{0}}, part * 64 // {parts} + 1, (part + 1) * 64 // {parts})"
    part = f"generate_series(0, {parts - 1})"
    return f"""
    units AS MATERIALIZED (
        SELECT vec_id AS id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS v
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
    points AS MATERIALIZED (
        SELECT 0 AS s, row_number() OVER (ORDER BY md5(id::VARCHAR)) AS place, v FROM units QUALIFY place <= {64 * max(cells, words)}),
    {_means("cell", "points", cells, rounds)},
    left_over AS MATERIALIZED (
        SELECT p.place, list_transform(list_zip(p.v, o.v), lambda z: z[1] - z[2]) AS r FROM points p, cell_{rounds} o
        QUALIFY row_number() OVER (PARTITION BY p.place ORDER BY round(list_distance(p.v, o.v) ** 2, 9), o.c) = 1),
    part_points AS MATERIALIZED (
        SELECT part AS s, place, {sliced.format("r")} AS v FROM left_over, (SELECT unnest({part}) AS part)),
    {_means("word", "part_points", words, rounds)},
    placed AS MATERIALIZED (
        SELECT u.id, o.c AS cell, list_transform(list_zip(u.v, o.v), lambda z: z[1] - z[2]) AS r FROM units u, cell_{rounds} o
        QUALIFY row_number() OVER (PARTITION BY u.id ORDER BY round(list_distance(u.v, o.v) ** 2, 9), o.c) = 1),
    coded AS MATERIALIZED (
        SELECT id, cell, part, w.v AS word FROM (SELECT id, cell, part, {sliced.format("r")} AS v FROM placed, (SELECT unnest({part}) AS part)) p
        JOIN word_{rounds} w ON w.s = part
        QUALIFY row_number() OVER (PARTITION BY id, part ORDER BY round(list_distance(p.v, w.v) ** 2, 9), w.c) = 1),
    probed AS (
        SELECT query_id, q, c AS cell, list_inner_product(q, v) AS base FROM asked, cell_{rounds}
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(list_distance(q, v) ** 2, 9), c) <= {probes}),
    by_code AS (
        SELECT query_id, id, any_value(q) AS q, round(any_value(base) + sum(list_inner_product({sliced.format("q")}, word)), 6) AS score
        FROM probed JOIN coded USING (cell) GROUP BY query_id, id
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= {candidates}),
    found AS (
        SELECT query_id, id AS paper_id, round(list_inner_product(q, v), 9) AS similarity,
            row_number() OVER (PARTITION BY query_id ORDER BY round(list_inner_product(q, v), 9) DESC, id) AS rank
        FROM by_code JOIN units USING (id) QUALIFY rank <= 10)"""


def _asked(condition: str) -> str:
    return f"""asked AS (
        SELECT vec_id AS query_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS q
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {condition}))"""


_CODED = _coded(cells=16, words=32, parts=16, rounds=3, probes=14, candidates=160)
_add("ivf_search", "SELECT paper_id, round(similarity, 6) AS similarity FROM found", _asked("vec_id = 0"), _CODED)
_add("ivf_search_many", "SELECT query_id, paper_id, round(similarity, 6) AS similarity, rank FROM found", _asked("vec_id % 100 = 0"), _CODED)
_add(
    "ivf_recall",
    """SELECT count(found.paper_id) / count(*) AS recall FROM exact LEFT JOIN found USING (query_id, paper_id)""",
    _asked("vec_id % 100 = 0"), _CODED,
    """exact AS (
        SELECT query_id, id AS paper_id FROM asked, units
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(list_inner_product(q, v), 9) DESC, id) <= 10)""",
)
_add(
    "parsed_vectors",
    """SELECT vec_id AS paper_id, CASE WHEN vec_id % 10 <> 3 THEN len(embedding) END AS dims,
        CASE WHEN vec_id % 10 <> 3 THEN round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 5) END AS length
    FROM embeddings""",
)
_VOWELS = ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE AS {c}" for c in "aeiou")
_add("embed_by_model", f"SELECT doc_id, {_VOWELS} FROM documents WHERE regexp_matches(text, '[aeiou]')")
_add("wrong_dimension", "SELECT vec_id AS paper_id, len(embedding) AS dims FROM embeddings WHERE len(embedding) <> 768")
SQL["embed_sections"] = (
    "SELECT DISTINCT doc_id, embedding_type, 256::BIGINT AS dims, 1.0::DOUBLE AS length FROM (" + SQL["section_slices"] + ")"
)

# -- table edits ----------------------------------------------------------------------------------------------

_UPSERT = f"""
    SELECT p.id, p.doi, CASE WHEN l.doi IS NULL THEN p.title ELSE l.title END AS title, p.authors,
        CASE WHEN l.doi IS NULL THEN p.year ELSE l.year END AS year,
        CASE WHEN l.doi IS NULL THEN p.pdf_url ELSE l.pdf_url END AS pdf_url,
        CASE WHEN l.doi IS NULL THEN p.sha256 ELSE l.sha256 END AS sha256,
        CASE WHEN l.doi IS NULL THEN p.source ELSE l.source END AS source,
        p.created_at, CASE WHEN l.doi IS NULL THEN p.updated_at ELSE TIMESTAMP '{AS_OF}' END AS updated_at
    FROM papers p LEFT JOIN latest l ON p.doi = l.doi
    UNION ALL
    SELECT (SELECT max(id) FROM papers) + row_number() OVER (ORDER BY ord), doi, title, NULL, year, pdf_url, sha256, source,
        TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
    FROM latest WHERE doi IS NULL OR doi NOT IN (SELECT doi FROM papers)"""
_add("upsert_papers", _UPSERT, PAPERS)
SQL["upsert_papers_stored"] = SQL["upsert_papers"]
_add(
    "insert_if_absent",
    f"""SELECT * FROM papers UNION ALL
    SELECT (SELECT max(id) FROM papers) + row_number() OVER (ORDER BY ord), doi, title, 'new', year, pdf_url, sha256, source,
        TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
    FROM (
        SELECT * FROM incoming WHERE doi NOT IN (SELECT doi FROM papers)
        QUALIFY row_number() OVER (PARTITION BY doi ORDER BY ord) = 1
        UNION ALL SELECT * FROM incoming WHERE doi IS NULL)""",
    PAPERS,
)


def _child(kind: str, payload: str, source: str) -> str:
    return f"""
given AS ({source}),
last_given AS (SELECT * FROM given QUALIFY row_number() OVER (PARTITION BY doi, {kind} ORDER BY ord DESC) = 1),
known AS (SELECT papers.id AS paper_id, {kind}, {payload}, ord FROM last_given JOIN papers USING (doi))"""


_SUMMARY_KIND = "CASE WHEN lang = 'en' THEN 'executive' ELSE 'methodology' END"
GIVEN_SUMMARIES = _child(
    "summary_type", "content", f"SELECT doi, {_SUMMARY_KIND} AS summary_type, title AS content, ord FROM hits WHERE doi IS NOT NULL"
)
_add("resolve_paper_ids", "SELECT paper_id, summary_type, content, ord FROM known", PAPERS, GIVEN_SUMMARIES)
_add(
    "upsert_summaries",
    f"""SELECT p.id, p.id AS paper_id, 'executive' AS summary_type, coalesce(k.content, 'old') AS content, created_at,
        CASE WHEN k.paper_id IS NULL THEN updated_at ELSE TIMESTAMP '{AS_OF}' END AS updated_at
    FROM papers p LEFT JOIN known k ON k.paper_id = p.id AND k.summary_type = 'executive'
    UNION ALL
    SELECT (SELECT max(id) FROM papers) + row_number() OVER (ORDER BY ord, paper_id, summary_type), paper_id, summary_type, content,
        TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
    FROM known WHERE summary_type <> 'executive'""",
    PAPERS, GIVEN_SUMMARIES,
)
_add(
    "upsert_embeddings",
    f"""SELECT p.id, p.id AS paper_id, 'title' AS embedding_type, coalesce(len(k.embedding), 1) AS dims,
        round(coalesce(k.embedding[1]::DOUBLE, 0), 6) AS first, created_at
    FROM papers p LEFT JOIN known k ON k.paper_id = p.id AND k.embedding_type = 'title'
    UNION ALL
    SELECT (SELECT max(id) FROM papers) + row_number() OVER (ORDER BY ord, paper_id, embedding_type), paper_id, embedding_type,
        len(embedding), round(embedding[1]::DOUBLE, 6), TIMESTAMP '{AS_OF}'
    FROM known WHERE embedding_type <> 'title'""",
    PAPERS,
    _child(
        "embedding_type", "embedding",
        """SELECT doi, CASE WHEN lang = 'en' THEN 'title' ELSE 'abstract' END AS embedding_type, embedding, ord
        FROM hits JOIN embeddings ON vec_id = doc_id WHERE doi IS NOT NULL""",
    ),
)
_add(
    "upsert_metadata",
    f"""SELECT c_custkey AS id, c_custkey AS paper_id, 'view' AS key,
        coalesce(value, '{{"c_mktsegment":"' || c_mktsegment || '"}}') AS value, TIMESTAMP '{CREATED}' AS created_at,
        CASE WHEN value IS NULL THEN TIMESTAMP '{CREATED}' ELSE TIMESTAMP '{AS_OF}' END AS updated_at
    FROM customer LEFT JOIN (SELECT * FROM last_events WHERE key = 'view') ON paper_id = c_custkey
    UNION ALL
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY ord), paper_id, key, value,
        TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}'
    FROM last_events WHERE key <> 'view' OR paper_id NOT IN (SELECT c_custkey FROM customer)""",
    """last_events AS (
        SELECT user_id AS paper_id, event_type AS key, props AS value, event_id AS ord FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)""",
)
NEW_EDGES = """
given AS (
    SELECT l_partkey AS source_paper_id, l_suppkey AS target_paper_id,
        CASE l_linestatus WHEN 'O' THEN 'cites' ELSE 'cited_by' END AS relationship_type,
        l_orderkey * 8 + l_linenumber AS ord, max(l_discount) AS confidence
    FROM lineitem GROUP BY ALL),
judged AS (
    SELECT given.*, e.source_paper_id IS NOT NULL
            OR row_number() OVER (PARTITION BY given.source_paper_id, given.target_paper_id, given.relationship_type ORDER BY ord) > 1 AS bad
    FROM given LEFT JOIN (SELECT * FROM edges WHERE relationship_type = 'cites') e
        USING (source_paper_id, target_paper_id, relationship_type))"""
_add(
    "insert_edges",
    f"""SELECT source_paper_id * 1000000 + target_paper_id AS id, source_paper_id, target_paper_id, relationship_type, confidence,
        TIMESTAMP '{CREATED}' AS created_at
    FROM edges WHERE relationship_type = 'cites'
    UNION ALL SELECT (SELECT max(source_paper_id * 1000000 + target_paper_id) FROM edges WHERE relationship_type = 'cites') + row_number() OVER (ORDER BY ord, source_paper_id, target_paper_id, relationship_type),
        source_paper_id, target_paper_id, relationship_type, confidence, TIMESTAMP '{AS_OF}' FROM judged WHERE NOT bad""",
    EDGES, NEW_EDGES,
)
_add(
    "edge_conflicts",
    """SELECT source_paper_id, target_paper_id, relationship_type, confidence, ord, 'duplicate_edge' AS reason
    FROM judged WHERE bad""",
    EDGES, NEW_EDGES,
)
_add(
    "create_rows",
    f"""SELECT * FROM queue UNION ALL
    SELECT o_orderkey + 1000000000, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'pending' END, 0, NULL,
        TIMESTAMP '{AS_OF}' FROM orders""",
    QUEUE,
)
_add(
    "patch_rows",
    """SELECT c_custkey AS work_id,
        CASE WHEN t.o_custkey IS NULL THEN c_name WHEN t.o_orderstatus = 'P' THEN NULL ELSE t.o_orderpriority END AS title,
        CASE WHEN s.o_custkey IS NULL THEN c_mktsegment ELSE s.o_orderstatus END AS segment
    FROM customer LEFT JOIN titles t ON t.o_custkey = c_custkey LEFT JOIN segments s ON s.o_custkey = c_custkey""",
    """titles AS (
        SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)""",
    """segments AS (
        SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)""",
)
_add(
    "delete_rows",
    """SELECT o_orderkey AS file_id, o_custkey AS work_id, o_orderpriority AS uri FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
_add(
    "delete_report",
    "SELECT c_custkey AS work_id, c_custkey IN (SELECT o_custkey FROM orders) AS existed FROM customer",
)
_add(
    "cascade_delete",
    """SELECT 'works' AS "table", c_custkey AS key, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY ALL
    UNION ALL SELECT 'files', o_orderkey, count(*) FROM kept GROUP BY ALL
    UNION ALL SELECT 'chunks', l_orderkey, count(*) FROM lineitem JOIN kept ON l_orderkey = o_orderkey GROUP BY ALL
    UNION ALL SELECT 'file_summaries', o_orderkey, count(*) FROM kept WHERE o_orderstatus = 'F' GROUP BY ALL
    UNION ALL SELECT 'ingest_queue', l_orderkey, count(*) FROM lineitem JOIN kept ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' GROUP BY ALL""",
    "kept AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))",
)
SQL["delete_works_stored"] = SQL["cascade_delete"]
_add(
    "delete_papers_stored",
    """SELECT 'papers' AS "table", id, '' AS kind FROM papers WHERE id NOT IN (SELECT * FROM toxic)
    UNION ALL SELECT 'embeddings', vec_id, ['title', 'abstract', 'full_text'][label % 3 + 1] FROM embeddings
    WHERE vec_id NOT IN (SELECT * FROM toxic WHERE doc_id IN (SELECT id FROM papers))""",
    PAPERS, "toxic AS (SELECT doc_id FROM labels WHERE toxic = 1)",
)
_add(
    "save_hits_works",
    f"""SELECT DISTINCT doi, CAST(NULL AS VARCHAR) AS title, 36::BIGINT AS id_chars, TIMESTAMP '{AS_OF}' AS created_at
    FROM hits WHERE doi <> ''""",
    HITS,
)
_add("save_hits_again", f"SELECT DISTINCT doi, TIMESTAMP '{AS_OF}' AS created_at FROM hits WHERE doi <> ''", HITS)
_add(
    "save_hits",
    "SELECT nullif(doi, '') AS doi, url, source AS provider, 'a topic' AS topic, 1::BIGINT AS hits_with_this_id FROM hits",
    HITS,
)
_add(
    "hit_json_rejects",
    """SELECT 'read' AS outcome, source, count(*) AS n FROM hits WHERE lang <> 'de' GROUP BY source
    UNION ALL SELECT 'broken_json', 'read', count(*) FROM hits WHERE lang = 'de' HAVING count(*) > 0""",
    HITS,
)
_add(
    "serial_ids",
    "SELECT o_orderkey, o_custkey, 1000 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id FROM orders",
)

# -- constraints, lookups, joins ------------------------------------------------------------------------------

_add("unique_violations", "SELECT doi, count(*) AS n FROM hits WHERE doi IS NOT NULL GROUP BY doi HAVING count(*) > 1", HITS)
_add("null_violations", "SELECT doc_id, 'doi' AS missing FROM hits WHERE doi IS NULL", HITS)
_add(
    "fk_violations",
    "SELECT paper_id, embedding_type FROM vectors WHERE paper_id NOT IN (SELECT doc_id FROM labels)",
    VECTORS,
)
_add("enum_violations", "SELECT * FROM edges WHERE relationship_type NOT IN ('cites', 'cited_by')", EDGES)
_add(
    "violation_counts",
    """SELECT 'papers' AS "table", 'unique(doi)' AS "constraint", count(*) AS violations
    FROM (SELECT doi FROM papers GROUP BY doi HAVING count(*) > 1)
    UNION ALL SELECT 'papers', 'unique(sha256)', count(*) FROM (SELECT sha256 FROM papers GROUP BY sha256 HAVING count(*) > 1)
    UNION ALL SELECT 'papers', 'not null', count(*) FROM papers WHERE id IS NULL OR title IS NULL
    UNION ALL SELECT 'paper_relationships', 'unique(source_paper_id, target_paper_id, relationship_type)', count(*)
    FROM (SELECT 1 FROM edges GROUP BY source_paper_id, target_paper_id, relationship_type HAVING count(*) > 1)
    UNION ALL SELECT 'paper_relationships', 'not null', count(*) FROM edges WHERE relationship_type IS NULL""",
    PAPERS, EDGES,
)
_SEEN = """CASE WHEN coalesce(doi, '') <> '' THEN doi IN (SELECT doi FROM papers)
    ELSE url IN (SELECT url FROM hits SEMI JOIN labels USING (doc_id)) END"""
_add("seen_before", f"SELECT doc_id, doi, url FROM hits WHERE {_SEEN}", PAPERS)
_add("unseen_hits", f"SELECT doc_id, doi, url FROM hits WHERE NOT {_SEEN}", PAPERS)
_FILES = "SELECT o_orderkey AS file_id, o_custkey AS work_id, o_orderpriority AS uri FROM orders"
_add("rows_by_key", f"{_FILES} WHERE o_custkey = 7")
_add("first_by_key", "SELECT c_custkey AS work_id, c_name AS title FROM customer WHERE c_custkey = 7 LIMIT 1")
_add("page_of_rows", f"{_FILES} ORDER BY o_orderkey LIMIT 100 OFFSET 50")
_add("pending_items", "SELECT * FROM queue WHERE status = 'pending' ORDER BY ingest_id LIMIT 100", QUEUE)
_add(
    "work_tree",
    """SELECT o_orderkey AS file_id, o_custkey AS work_id, c_name AS title, o_orderpriority AS uri,
        CASE WHEN o_orderstatus = 'F' THEN 'tl_dr' END AS kind, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS summary_text,
        coalesce(n, 0) AS n_chunks, coalesce(r, 0) AS n_jobs
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (
        SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1
    ) ON l_orderkey = o_orderkey""",
)

# -- graph and metadata --------------------------------------------------------------------------------------

_OUT_EDGES = """SELECT source_paper_id AS paper_id, target_paper_id AS neighbour_id, s_name AS neighbour_title, relationship_type, confidence
    FROM edges JOIN supplier ON s_suppkey = target_paper_id"""
_add("all_out_neighbours", _OUT_EDGES, EDGES)
_add("out_neighbours", _OUT_EDGES + " WHERE source_paper_id = 42", EDGES)
_add(
    "in_neighbours",
    """SELECT target_paper_id AS paper_id, source_paper_id AS neighbour_id, p_name AS neighbour_title, relationship_type, confidence
    FROM edges JOIN part ON p_partkey = source_paper_id WHERE target_paper_id = 3""",
    EDGES,
)
_add("edges_by_type", "SELECT * FROM edges WHERE relationship_type = 'cites' AND confidence >= 0.05", EDGES)
_add("metadata_of", "SELECT * FROM metadata WHERE paper_id = 7", METADATA)
_add("metadata_values", "SELECT paper_id, key, json_extract_string(value, '$.k')::BIGINT AS typed FROM metadata", METADATA)
_add(
    "metadata_pivot",
    """SELECT paper_id, max(value) FILTER (WHERE key = 'view') AS view, max(value) FILTER (WHERE key = 'click') AS click,
        max(value) FILTER (WHERE key = 'error') AS error
    FROM metadata GROUP BY paper_id""",
    METADATA,
)

# -- ingest state and streams --------------------------------------------------------------------------------

_add("ingest_state", "SELECT * FROM folded", _status("WHEN 'view' THEN ''"))
_add("stream_status", "SELECT * FROM folded", _status(""))
_add(
    "apply_status_events",
    f"""SELECT ingest_id, file_id, coalesce(f.status, q.status) AS status, retries + coalesce(errors, 0) AS retries,
        coalesce(f.last_error, q.last_error) AS last_error,
        CASE WHEN f.status IS NULL THEN updated_at ELSE TIMESTAMP '{AS_OF}' END AS updated_at
    FROM queue q LEFT JOIN folded f USING (ingest_id)""",
    QUEUE, _status("WHEN 'view' THEN ''"),
)
_add(
    "retry_schedule",
    """SELECT pdf_url, attempts, last_at,
        CASE WHEN attempts < 3 THEN last_at + to_seconds(least(10, greatest(4, pow(2, attempts - 1)))::INT) END AS next_at
    FROM tried WHERE NOT done""",
    """tried AS (
        SELECT user_id || '/' || json_extract_string(props, '$.k') AS pdf_url, count(*) AS attempts, max(ts) AS last_at,
            bool_or(event_type = 'purchase') AS done
        FROM events GROUP BY 1)""",
)
_add(
    "stream_unique_urls",
    "SELECT DISTINCT event_type || '/' || json_extract_string(props, '$.k') AS pdf_url FROM events",
)
_FETCHED = f"""
fetched AS (
    SELECT '10.1000/' || page_id AS doi, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, url AS pdf_url, page_id,
        CASE WHEN html LIKE '%lang="fr"%' THEN 403 ELSE 200 END AS status, sha256(html) AS sha256, html,
        {_clean(_DECODED)} AS text
    FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1),
parsed AS (SELECT * FROM fetched WHERE status = 200 AND text <> ''),
unique_files AS (SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY page_id) = 1),
stored AS (SELECT * FROM unique_files WHERE len({_words('text')}) > 0)"""
_add(
    "stream_ingest_papers",
    "SELECT doi, title, 2024::BIGINT AS year, pdf_url, sha256, 'web' AS source FROM stored",
    _FETCHED,
)
_add(
    "stream_ingest_children",
    """SELECT doc_id AS doi, summary_type AS kind, content FROM summaries
    UNION ALL SELECT doi, 'title', '64 numbers' FROM stored WHERE trim(substr(text, 1, 200)) <> ''
    UNION ALL SELECT doi, 'abstract', '64 numbers' FROM stored WHERE trim(substr(text, 201, 800)) <> ''
    UNION ALL SELECT doi, 'full_text', '64 numbers' FROM stored""",
    _FETCHED, _summaries("stored", "doi"),
)
_add(
    "stream_ingest_metadata",
    f"""{_field_rows("stored", "doi")}
    UNION ALL SELECT doi, 'keywords', '[' || string_agg('"' || keyword || '"', ',' ORDER BY n DESC, keyword) || ']' FROM (
        SELECT doi, keyword, count(*) AS n FROM (
            SELECT doi, unnest(list_filter({_words('text')}, lambda w: length(w) >= 5)) AS keyword FROM stored) GROUP BY doi, keyword
        QUALIFY row_number() OVER (PARTITION BY doi ORDER BY count(*) DESC, keyword) <= 5) GROUP BY doi""",
    _FETCHED,
)
_add(
    "stream_ingest_dashboard",
    """SELECT 'download' AS stage, count(*) AS items, count(*) FILTER (WHERE status = 200) AS succeeded FROM fetched
    UNION ALL SELECT 'parse', count(*) FILTER (WHERE status = 200), (SELECT count(*) FROM parsed) FROM fetched
    UNION ALL SELECT 'summarise', count(*), (SELECT count(*) FROM stored) FROM unique_files
    UNION ALL SELECT 'embed', count(*), count(*) FROM unique_files
    UNION ALL SELECT 'store', (SELECT count(*) FROM parsed) - count(*) + (SELECT count(*) FROM stored), (SELECT count(*) FROM stored) FROM unique_files""",
    _FETCHED,
)
_add(
    "stream_fetch_outcomes",
    """SELECT pdf_url, status, ord, 'accepted' AS outcome, failed AS attempts, CAST(NULL AS TIMESTAMP) AS next_at FROM won WHERE failed < 3
    UNION ALL SELECT pdf_url, status, ord, 'rejected', 3, NULL FROM lost
    UNION ALL SELECT pdf_url, arg_max(status, ord), max(ord), 'retry', count(*),
        max(tried_at) + to_seconds(least(10, greatest(4, pow(2, count(*) - 1)))::INT)
    FROM tried WHERE pdf_url NOT IN (SELECT pdf_url FROM won WHERE failed < 3 UNION ALL SELECT pdf_url FROM lost) GROUP BY pdf_url""",
    """tried AS (
        SELECT user_id || '/' || json_extract_string(props, '$.k') AS pdf_url, event_id AS ord, ts AS tried_at,
            CASE WHEN event_type IN ('purchase', 'signup') THEN 200::BIGINT WHEN event_type = 'error' THEN 403 ELSE 404 END AS status
        FROM events)""",
    "counted AS (SELECT *, count(*) FILTER (WHERE status <> 200) OVER (PARTITION BY pdf_url ORDER BY ord) AS failed FROM tried)",
    "won AS (SELECT * FROM counted WHERE status = 200 QUALIFY row_number() OVER (PARTITION BY pdf_url ORDER BY ord) = 1)",
    """lost AS (
        SELECT * FROM counted c WHERE status <> 200 AND failed = 3
            AND NOT EXISTS (SELECT 1 FROM won w WHERE w.pdf_url = c.pdf_url AND w.failed < 3))""",
)
_add(
    "stream_store_files",
    """SELECT DISTINCT sha256(html) AS sha256, sha256(html) || '.pdf' AS file_path, strlen(html) AS size FROM pages
    WHERE html NOT LIKE '%lang="fr"%'""",
)
