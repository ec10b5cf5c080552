"""DuckDB SQL for the queries of files and jobs: what the jobs should write, from the tables themselves."""

from __future__ import annotations

from nassaj.workload import oracle
from nassaj.workload.files import SHORT_WORD
from nassaj.workload.oracle import BUILT_IN, DOCS, TOKENS, W, cleaned, collapse, kept, stems, words
from nassaj.workload.views import ARABIC, LATIN


def held_out(id: str) -> str:
    """Whether a row is of the tenth whose ids have the smallest digests."""
    return (f"row_number() OVER (ORDER BY md5({id} || ':42'), {id}) "
            "<= ceil(round(0.1 * count(*) OVER (), 9)) AS is_validation")


NUMBERED = f"""SELECT id, labels, {held_out('id')} FROM (
  SELECT row_number() OVER (ORDER BY id) - 1 AS id, labels FROM ({oracle.ORACLE_SQL['prepared_tags']}))"""

ORACLE_SQL: dict[str, str] = {
    "read_lines": rf"""WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS l FROM documents)),
stripped AS (SELECT doc_id, i, regexp_replace(line, '^{W}+|{W}+$', '', 'g') AS text FROM lines)
SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS row_id, text FROM stripped WHERE text <> ''""",
    "csv_round_trip": "SELECT * FROM documents",
    "json_round_trip": "SELECT * FROM documents",
    "read_tagged": f"""WITH {TOKENS}
SELECT id::VARCHAR AS id, string_agg(token, ' ' ORDER BY pos) AS tokens, string_agg(tag, ' ' ORDER BY pos) AS tags
FROM truth GROUP BY ALL""",
    "read_summary_pairs": oracle.ORACLE_SQL["seq2seq_pairs"],
    "process_custom_stages": f"""WITH c AS (SELECT doc_id, text AS original, lower({collapse('text')}) AS cleaned FROM documents)
SELECT doc_id, original, cleaned, cleaned AS tokens,
       array_to_string(list_transform(string_split(cleaned, ' '), lambda w: w[1:4]), ' ') AS stemmed_tokens FROM c""",
    "preprocess_job": oracle.ORACLE_SQL["process_columns"],
    "preprocess_job_listed": f"""WITH {DOCS},
b AS (SELECT translate(lower(text), '{LATIN}', '{ARABIC}') AS text FROM benchmark),
w AS (SELECT list(DISTINCT word) AS l FROM (SELECT unnest({words(cleaned())}) AS word FROM b) WHERE length(word) <= {SHORT_WORD}),
c AS (SELECT doc_id, lang, {cleaned()} AS cleaned_text FROM docs),
t AS (SELECT doc_id, lang, cleaned_text, list_filter({kept(words('cleaned_text'), BUILT_IN)}, lambda x: NOT list_contains(l, x)) AS t FROM c, w)
SELECT doc_id, lang, cleaned_text, array_to_string(t, ' ') AS tokens, array_to_string({stems('t')}, ' ') AS stemmed_tokens FROM t""",
    "prepare_ner_job": NUMBERED,
    "prepare_seq2seq_job": f"SELECT *, {held_out('id')} FROM ({oracle.ORACLE_SQL['seq2seq_ids']})",
    "infer_classification_job": f"SELECT doc_id, prediction FROM ({oracle.ORACLE_SQL['stated_predictions']})",
    "infer_ner_job": oracle.ORACLE_SQL["tagger_hook"],
    "infer_summarization_job": f"""SELECT doc_id, coalesce(summary, '') AS summary
FROM documents LEFT JOIN ({oracle.ORACLE_SQL['extractive_summary']}) USING (doc_id)""",
    "evaluate_classification_job": oracle.ORACLE_SQL["classification_metrics"],
    "evaluate_ner_job": f"SELECT * FROM ({oracle.ORACLE_SQL['ner_token_accuracy']}), ({oracle.ORACLE_SQL['ner_metrics']})",
    "evaluate_summarization_job": oracle.ORACLE_SQL["rouge_summary"],
}
