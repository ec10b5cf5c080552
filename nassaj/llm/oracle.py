"""DuckDB SQL of the queries that SQL can express, written from their definitions.

Models, tokenizers, keyed permutations and the pipeline have none; tests hold those against
brute force, round trips and held-out rows.
"""

from __future__ import annotations

from hashlib import md5

OP1 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS query_id, b.vec_id,
        CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE a.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

_WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS words FROM d),
win AS (
    SELECT row, i, array_to_string(words[i:i + 4], ' ') AS five
    FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM w)
), twice AS (SELECT row, five FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (
    SELECT row, count(DISTINCT p) AS n
    FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM win JOIN twice USING (row, five)) GROUP BY row
), l AS (
    SELECT row, k, x[k] AS line, regexp_extract_all(x[k], '{_WORD}') AS words
    FROM (SELECT row, x, unnest(range(1, len(x) + 1)) AS k FROM (SELECT row, string_split(t, chr(10)) AS x FROM d))
), judged AS (
    SELECT *, CASE
        WHEN row_number() OVER (PARTITION BY row, line ORDER BY k) > 1 THEN 'repeat'
        WHEN 4 * (
            list_sum(list_transform(['|', '>', '<', '/', '-', '*', '»', '›', '•', '·'],
                lambda s: (length(line) - length(replace(line, ' ' || s || ' ', ''))) // 3))
        ) >= len(words) THEN 'navigation'
        WHEN 4 * (length(lower(line)) - length(regexp_replace(lower(line), 'all rights reserved|cookie policy|we use cookies|'
            || 'accept cookies|privacy policy|terms of use|terms of service|enable javascript|javascript is disabled|'
            || 'subscribe to our newsletter|sign up for our newsletter|skip to content|powered by', '', 'g'))) >= length(lower(line))
            THEN 'boilerplate'
        WHEN 2 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) >= len(words) THEN 'punctuation'
        WHEN 2 * ((length(line) - length(replace(line, '!!', ''))) // 2) >= len(words) THEN 'punctuation'
        WHEN len(words) >= 3 AND length(regexp_replace(line, '[^\p{{Lu}}]', '', 'g')) >= 10
            AND length(regexp_replace(line, '[^\p{{Lu}}]', '', 'g')) > length(regexp_replace(line, '[^\p{{Ll}}]', '', 'g'))
            THEN 'punctuation'
        WHEN len(words) >= 12 AND NOT regexp_matches(line, '[.!?:;…。！？؟।]') THEN 'punctuation'
        END AS fault
    FROM l WHERE len(words) > 0
), per AS (
    SELECT row, count(*) AS n_lines, count(fault) AS n_failed_lines,
        coalesce(sum(len(words)) FILTER (fault IS NOT NULL), 0) AS lost_words,
        count(*) FILTER (fault = 'repeat') AS repeat, count(*) FILTER (fault = 'navigation') AS navigation,
        count(*) FILTER (fault = 'boilerplate') AS boilerplate, count(*) FILTER (fault = 'punctuation') AS punctuation,
        string_agg(line, chr(10) ORDER BY k) FILTER (fault IS NULL) AS cleaned
    FROM judged GROUP BY row
), all_ AS (
    SELECT w.doc_id, len(w.words) AS n_words, length(array_to_string(w.words, '')) AS word_chars,
        length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(rep.n, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(lost_words, 0) AS lost_words,
        coalesce(repeat, 0) AS repeat, coalesce(navigation, 0) AS navigation, coalesce(boilerplate, 0) AS boilerplate,
        coalesce(punctuation, 0) AS punctuation, sha256(coalesce(cleaned, '')) AS cleaned_sha256
    FROM w LEFT JOIN rep USING (row) LEFT JOIN per USING (row)
), failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM all_)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(repeat AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
    CAST(n_failed_lines AS BIGINT) AS n_failed_lines, CAST(lost_words AS BIGINT) AS lost_words,
    CAST(repeat AS BIGINT) AS repeat, CAST(navigation AS BIGINT) AS navigation, CAST(boilerplate AS BIGINT) AS boilerplate,
    CAST(punctuation AS BIGINT) AS punctuation, base_failed,
    NOT base_failed AND 100 * lost_words <= 50 * n_words AS kept, cleaned_sha256
FROM failed
"""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORD}') AS words FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS start, doc_id AS here FROM w
    UNION
    SELECT start, y FROM reach JOIN both_ways ON x = here
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT start AS doc_id, min(here) AS component_id FROM reach GROUP BY start) c USING (doc_id)
"""

OP8 = r"""
WITH a AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS inside FROM pages
), b AS (
    SELECT page_id, url, unnest(string_split(regexp_replace(inside, '</?(p|h1)>', chr(1), 'g'), chr(1))) AS block,
        generate_subscripts(string_split(regexp_replace(inside, '</?(p|h1)>', chr(1), 'g'), chr(1)), 1) AS k
    FROM a
), c AS (
    SELECT page_id, url, k, trim(regexp_replace(
        replace(replace(replace(replace(replace(regexp_replace(replace(block, '<br>', ' '), '<[^>]*>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'),
        '\s+', ' ', 'g')) AS t
    FROM b
), d AS (SELECT page_id, string_agg(t, chr(10) ORDER BY k) FILTER (t <> '') AS text FROM c GROUP BY page_id)
SELECT page_id, url, coalesce(d.text, '') AS text, CAST(length(coalesce(d.text, '')) AS BIGINT) AS n_chars
FROM a LEFT JOIN d USING (page_id)
"""


def _turns(names: list[str], slots: int) -> str:
    """The lookup table by its definition, as one comma-separated list: in turn, each takes its next free slot."""

    def preferred(name: str):
        h = md5(name.encode()).hexdigest()
        first, step = int(h[0:15], 16) % slots, int(h[16:31], 16) % (slots - 1) + 1
        return ((first + k * step) % slots for k in range(slots))

    free, holder, orders = set(range(slots)), {}, [preferred(name) for name in names]
    while free:
        for shard, order in enumerate(orders):
            if free:
                taken = next(s for s in order if s in free)
                free.remove(taken)
                holder[taken] = shard
    return ",".join(str(holder[s]) for s in range(slots))


OP6 = f"""
WITH d AS (
    SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % 65537 AS slot FROM documents
), t AS (SELECT string_split('{_turns([f"shard-{k:02d}" for k in range(64)], 65537)}', ',') AS holders)
SELECT doc_id, slot, 'shard-' || lpad(holders[slot + 1], 2, '0') AS shard FROM d, t
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_TERM}') AS terms
    FROM documents
), q AS (
    SELECT item, item_id, unnest(list_distinct(terms)) AS term
    FROM (
        SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_TERM}') AS terms
        FROM benchmark
    )
), t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL),
g AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, g GROUP BY term
), m AS (
    SELECT row, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, g WHERE len(terms) > 0
), scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (row) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

OP12 = rf"""
WITH d AS (
    SELECT doc_id, {_LOW.format("coalesce(text, '')")} AS t, row_number() OVER () AS row FROM documents
), o AS (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, row) AS place,
        count(*) OVER (PARTITION BY t) AS group_size, max(doc_id) OVER (PARTITION BY t) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM o
"""

ORACLE_SQL: dict[str, str] = {
    "op1_vector_search": OP1,
    "op2_line_rules": OP2,
    "op4_jaccard_join": OP4,
    "op6_shard_lookup": OP6,
    "op8_main_text": OP8,
    "op11_ranked_search": OP11,
    "op12_exact_dedup": OP12,
}
