"""DuckDB SQL for the registered queries.

Written from the definitions, with regular expressions, unnested rows and joins
where the Spark side works on arrays, so that the two share no logic.
"""

from __future__ import annotations

import string

from nassaj.functions import fixed
from nassaj.workload.views import ARABIC, LATIN

W = r"[\s\x1c-\x1f\x{85}\p{Z}]"
DOCS = f"docs AS (SELECT doc_id, lang, translate(lower(text), '{LATIN}', '{ARABIC}') AS text FROM documents)"
PUNCT = "،؛؟«»…ـ" + string.punctuation.replace("'", "''")
TERM = r"[\p{L}\p{N}_]{2,}"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w + "'" for w in words)


def diacritics(x: str) -> str:
    return rf"regexp_replace({x}, '[\x{{064B}}-\x{{065F}}]', '', 'g')"


def tatweel(x: str) -> str:
    return f"replace({x}, 'ـ', '')"


def alef(x: str) -> str:
    return f"regexp_replace({x}, '[آأإ]', 'ا', 'g')"


def teh(x: str) -> str:
    return f"replace({x}, 'ة', 'ه')"


def punctuation(x: str) -> str:
    return f"translate({x}, '{PUNCT}', '')"


def numbers(x: str) -> str:
    return rf"regexp_replace({x}, '[0-9\x{{0660}}-\x{{0669}}\x{{06F0}}-\x{{06F9}}]', '', 'g')"


def english(x: str) -> str:
    return f"regexp_replace({x}, '[a-zA-Z]', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{W}+', ' ', 'g'), ' ')"


def cleaned(x: str = "text") -> str:
    return collapse(punctuation(teh(alef(tatweel(diacritics(x))))))


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{W}+'), lambda t: t <> '')"


def kept(x: str, stopwords: list[str]) -> str:
    return f"list_filter({x}, lambda t: length(t) > 1 AND t NOT IN ({quoted(stopwords)}))"


def stem(x: str) -> str:
    for _ in range(3):
        x = rf"regexp_replace({x}, '^(?:ال|[سفولبتينأإ])(.{{2,}})$', '\1')"
    for _ in range(3):
        x = rf"regexp_replace({x}, '^(.{{2,}})(?:كما|ها|هم|هن|كم|كن|نا|ني|وا|ون|ين|ات|ان|ية)$', '\1')"
    return x


def stems(x: str) -> str:
    return f"list_transform({x}, lambda w: {stem('w')})"


def text_query(expression: str, source: str = "docs") -> str:
    return f"WITH {DOCS} SELECT doc_id, {expression} AS cleaned FROM {source}"


def token_query(expression: str) -> str:
    return (
        f"WITH {DOCS}, t AS (SELECT doc_id, {expression} AS t FROM docs) "
        "SELECT doc_id, len(t)::BIGINT AS n, array_to_string(t, ' ') AS tokens FROM t"
    )


# --- fixed values: the built-in stopwords, and six English ones in the respelling ----
BUILT_IN = [
    "في", "من", "إلى", "على", "عن", "مع", "كان", "هذا", "هذه", "ذلك",
    "تلك", "هو", "هي", "هم", "هن", "أن", "إن", "ما", "لا", "هل",
    "أي", "كل", "بعض", "لم", "لن", "قد", "لقد", "إنه", "إنها", "حتى",
    "بعد", "قبل", "عند", "تحت", "فوق", "بين", "خلال", "حول", "حيث", "هناك",
    "هنا", "ثم", "أو", "و", "ف", "ب", "ل", "ك", "ا", "فقد",
    "بل", "لكن", "ليس", "ليست", "كن", "تكون", "يكون", "كانت", "كانوا",
]
WITH_CUSTOM = BUILT_IN + [
    "طه", "اند", "ف", "يس", "ن", "شيطه",
]
ALL_CLEAN = collapse(numbers(english(punctuation(teh(alef(tatweel(diacritics("text"))))))))

STATS = f"""s AS (
  SELECT doc_id, lang, len(w) AS n, length(text) AS chars, len(list_distinct(w)) AS d,
         length(regexp_replace(text, '{W}+', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\\x{{0600}}-\\x{{06FF}}\\x{{0750}}-\\x{{077F}}]', '', 'g')) AS ar, w
  FROM (SELECT *, {words('text')} AS w FROM src))"""

# --- terms -------------------------------------------------------------------
TERMS = f"""words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{TERM}') AS w FROM documents),
terms AS (
  SELECT doc_id, unnest(w) AS term FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counted AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY ALL)"""
VOCABULARY = """vocab AS (
  SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM counted GROUP BY term
  ORDER BY tf DESC, term LIMIT 5000),
fit AS (SELECT *, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM vocab)"""
WEIGHTS = f"""WITH {TERMS}, {VOCABULARY},
raw AS (SELECT doc_id, term, (1 + ln(n)) * idf AS w FROM counted JOIN fit USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""

# A logistic model whose coefficients are stated by each term's length and first letter.
STATED = f"""{TERMS}, {VOCABULARY},
raw AS (SELECT doc_id, term, (1 + ln(n)) * idf AS w FROM counted JOIN fit USING (term)),
unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw),
stated AS (
  SELECT d.doc_id, 1 / (1 + exp(-0.1 - coalesce(sum(w * (((7 * length(term) + unicode(term)) % 11 - 5) / 2.0)), 0))) AS p
  FROM documents d LEFT JOIN unit USING (doc_id) GROUP BY d.doc_id)"""
STATED_REPORT = f"""WITH {STATED},
pairs AS (SELECT quality::VARCHAR AS t, CASE WHEN p > 0.5 THEN '1' ELSE '0' END AS y FROM stated JOIN labels USING (doc_id)),
names AS (SELECT t AS label FROM pairs UNION SELECT y FROM pairs),
tally AS (
  SELECT label, (SELECT count(*) FROM pairs WHERE t = label) AS support, (SELECT count(*) FROM pairs WHERE y = label) AS guessed,
    (SELECT count(*) FROM pairs WHERE t = label AND y = label) AS hit FROM names),
scores AS (
  SELECT label, support, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r
  FROM tally),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM scores),
n AS (SELECT count(*) AS n, avg((t = y)::INT) AS a FROM pairs),
rows AS (
  SELECT label, p, r, f1, support FROM f
  UNION ALL SELECT 'accuracy', a, a, a, n FROM n
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM rows"""

# --- tags --------------------------------------------------------------------
TOKENS = r"""tok AS (
  SELECT doc_id AS id, unnest(string_split(text, ' ')) AS token,
         generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents),
kinds AS (
  SELECT *, CASE WHEN regexp_matches(token, '\A[0-9]+\z') THEN 'NUM'
                 WHEN regexp_matches(token, '\A\p{Lu}') THEN 'CAP' ELSE 'O' END AS kind FROM tok),
truth AS (
  SELECT id, pos, token, CASE WHEN kind = 'O' THEN 'O'
      WHEN kind = 'CAP' AND lag(kind) OVER (PARTITION BY id ORDER BY pos) = 'CAP' THEN 'I-CAP'
      ELSE 'B-' || kind END AS tag FROM kinds),
pred AS (
  SELECT id, pos, token, CASE WHEN pos % 7 = 6 THEN 'O'
      WHEN pos % 11 = 10 THEN regexp_replace(tag, '^B-', 'I-') ELSE tag END AS tag FROM truth)"""


def spans_of(source: str) -> str:
    return f"""{source}_tags AS (
  SELECT id, pos, tag FROM {source}
  UNION ALL SELECT id, max(pos) + 1, 'O' FROM {source} GROUP BY id),
{source}_parts AS (
  SELECT id, pos, tag[1] AS h,
         CASE WHEN regexp_replace(tag[2:], '^[^-]*-', '') = '' THEN '_'
              ELSE regexp_replace(tag[2:], '^[^-]*-', '') END AS k FROM {source}_tags),
{source}_prev AS (
  SELECT *, coalesce(lag(h) OVER o, 'O') AS ph, coalesce(lag(k) OVER o, '_') AS pk
  FROM {source}_parts WINDOW o AS (PARTITION BY id ORDER BY pos)),
{source}_flags AS (
  SELECT *, ph IN ('E','S') OR (ph IN ('B','I') AND h IN ('B','S','O'))
            OR (ph NOT IN ('O','.') AND pk <> k) AS ends,
         h IN ('B','S') OR (h IN ('E','I') AND ph IN ('E','S','O'))
            OR (h NOT IN ('O','.') AND pk <> k) AS starts FROM {source}_prev),
{source}_begin AS (
  SELECT *, last_value(CASE WHEN starts THEN pos END IGNORE NULLS) OVER (
      PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
  FROM {source}_flags),
{source}_spans AS (
  SELECT DISTINCT id, pk AS entity_type, coalesce(b, 0) AS first, pos - 1 AS last
  FROM {source}_begin WHERE ends)"""


SPANS = f"WITH {TOKENS}, {spans_of('truth')}, {spans_of('pred')}"
SPAN_TALLY = """tally AS (
  SELECT coalesce(t.entity_type, p.entity_type) AS label,
         count(t.id) AS support, count(p.id) AS predicted,
         count(*) FILTER (WHERE t.id IS NOT NULL AND p.id IS NOT NULL) AS correct
  FROM truth_spans t FULL JOIN pred_spans p
    ON t.id = p.id AND t.entity_type = p.entity_type AND t.first = p.first AND t.last = p.last
  GROUP BY 1)"""

SCORES = """scores AS (
  SELECT label, support, predicted, correct, p, r,
         CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f
  FROM (SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS p,
               CASE WHEN support > 0 THEN correct / support ELSE 0 END AS r FROM tally))"""
REPORT = """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
       support::BIGINT AS support FROM (
  SELECT label, p, r, f, support FROM scores
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), sum(support) FROM scores
  UNION ALL {overall})"""
MICRO = """SELECT 'micro avg', c / p, c / s, 2 * (c / p) * (c / s) / (c / p + c / s), s
  FROM (SELECT sum(correct) AS c, sum(predicted) AS p, sum(support) AS s FROM tally)"""
ACCURACY = """SELECT 'accuracy', sum(correct) / sum(support), sum(correct) / sum(support),
  sum(correct) / sum(support), sum(support) FROM tally"""

EVENT_PAIRS = """ev AS (
  SELECT event_type AS truth, CASE WHEN value > 10 THEN 'error' ELSE event_type END AS prediction FROM events),
labels_seen AS (SELECT truth AS label FROM ev UNION SELECT prediction FROM ev)"""
EVENT_TALLY = """tally AS (
  SELECT label,
         (SELECT count(*) FROM ev WHERE truth = label) AS support,
         (SELECT count(*) FROM ev WHERE prediction = label) AS predicted,
         (SELECT count(*) FROM ev WHERE prediction = label AND truth = label) AS correct
  FROM labels_seen)"""

ROC = """g AS (
  SELECT value AS score, sum((event_type = 'error')::INT) AS pos, sum((event_type <> 'error')::INT) AS neg
  FROM events GROUP BY value),
c AS (
  SELECT score, sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(neg) FROM g) AS fpr,
         sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(pos) FROM g) AS tpr FROM g)"""

# --- pieces ------------------------------------------------------------------
WORD_IDS = """pieces AS (
  SELECT id, pos, unnest(range(0, 1 + length(token) // 5)) AS piece, tag FROM truth),
ids AS (
  SELECT id, pos AS word, piece, tag, row_number() OVER (PARTITION BY id ORDER BY pos, piece) AS ix FROM pieces
  UNION ALL SELECT DISTINCT id, NULL, NULL, NULL, 0 FROM pieces
  UNION ALL SELECT id, NULL, NULL, NULL, count(*) + 1 FROM pieces GROUP BY id)"""
TAG_IDS = "dict AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS tag_id FROM (SELECT DISTINCT tag FROM truth))"

PREDICTIONS = """cut AS (
  SELECT id, pos, token, tag, unnest(range(0, 1 + greatest(length(token) - 1, 0) // 5)) AS j FROM truth),
pieces AS (
  SELECT id, pos, j, CASE WHEN j % 2 = 1 THEN 'O' ELSE tag END AS tag,
         1.0::DOUBLE / (length(token) + j + 1) AS score,
         (CASE WHEN j > 0 THEN '##' ELSE '' END) || substring(token, j * 5 + 1, 5) AS word,
         pos * 1000 + j * 5 AS s, pos * 1000 + j * 5 + length(substring(token, j * 5 + 1, 5)) AS e,
         row_number() OVER (PARTITION BY id ORDER BY pos, j) AS ix FROM cut)"""
WHOLE_WORDS = """whole AS (
  SELECT id, arg_min(tag, j) AS tag, arg_min(score, j) AS score,
         replace(string_agg(word, ' ' ORDER BY j), ' ##', '') AS word, min(s) AS s, arg_max(e, j) AS e, pos AS ix
  FROM pieces GROUP BY id, pos)"""


def grouped_entities(source: str) -> str:
    return f"""typed AS (SELECT *, regexp_replace(tag, '^[BI]-', '') AS kind FROM {source}),
flagged AS (
  SELECT *, (starts_with(tag, 'B-') OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY id ORDER BY ix))::INT AS f
  FROM typed),
islands AS (SELECT *, sum(f) OVER (PARTITION BY id ORDER BY ix) AS island FROM flagged),
ents AS (
  SELECT id, island, kind, avg(score) AS score, string_agg(word, ' ' ORDER BY ix) AS word,
         min(s) AS s, arg_max(e, ix) AS e FROM islands GROUP BY ALL)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY island) - 1 AS k, kind AS entity_group,
       round(score, 6) AS score, replace(word, ' ##', '') AS word, s AS start_at, e AS end_at
FROM ents WHERE kind <> 'O'"""


# --- text pairs --------------------------------------------------------------
TURNS = """turns AS (
  SELECT a.conv_id || ':' || a.turn AS id, a.text AS ref, b.text AS hyp
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


UNICODE = r"[\p{L}\p{N}]+"


def rouge_n(pattern: str) -> str:
    parts = []
    for n in (1, 2):
        for side in ("ref", "hyp"):
            gram = "w[i]" if n == 1 else "w[i] || ' ' || w[i + 1]"
            parts.append(f"""{side}{n} AS (
  SELECT id, g, count(*) AS c FROM (
    SELECT id, unnest(list_transform(range(1, len(w) + {2 - n}), lambda i: {gram})) AS g
    FROM (SELECT id, regexp_extract_all(lower({side}), '{pattern}') AS w FROM turns)) GROUP BY ALL)""")
        parts.append(f"""m{n} AS (
  SELECT t.id, coalesce((SELECT sum(c) FROM ref{n} r WHERE r.id = t.id), 0) AS nr,
         coalesce((SELECT sum(c) FROM hyp{n} h WHERE h.id = t.id), 0) AS nh,
         coalesce((SELECT sum(least(r.c, h.c)) FROM ref{n} r JOIN hyp{n} h ON r.id = h.id AND r.g = h.g
                   WHERE r.id = t.id), 0) AS o FROM turns t),
x{n} AS (SELECT id, o / greatest(nh, 1) AS p, o / greatest(nr, 1) AS r,
         CASE WHEN o > 0 THEN 2 * (o / greatest(nh, 1)) * (o / greatest(nr, 1))
              / (o / greatest(nh, 1) + o / greatest(nr, 1)) ELSE 0 END AS f FROM m{n})""")
    return ", ".join(parts)


def rouge_columns(measures: str) -> list[tuple[str, str, str]]:
    return [
        (n, m, c) for n in measures for m, c in (("precision", "p"), ("recall", "r"), ("fmeasure", "f"))
    ]


def rouge_rows(pattern: str) -> str:
    cols = ", ".join(f"round(x{n}.{c}, 6) AS rouge{n}_{m}" for n, m, c in rouge_columns("12"))
    return f"WITH {TURNS}, {rouge_n(pattern)} SELECT id, {cols} FROM x1 JOIN x2 USING (id)"


def rouge_means(measures: str) -> str:
    cols = rouge_columns(measures)
    means = ", ".join(f'round(avg(x{n}.{c}), 4) AS "rouge{n}_{m}"' for n, m, c in cols)
    stds = ", ".join(f'round(stddev_pop(x{n}.{c}), 4) AS "rouge{n}_{m}_std"' for n, m, c in cols)
    tables = f"{TURNS}, {rouge_n(UNICODE)}" + (f", {LCS}" if "L" in measures else "")
    joins = " ".join(f"JOIN x{n} USING (id)" for n in measures[1:])
    return f"WITH RECURSIVE {tables} SELECT count(*) AS num_samples, {means}, {stds} FROM x1 {joins}"


# The longest common subsequence row by row: a row is the running maximum of
# "above" and, where the words agree, "above left plus one".
LCS = f"""r AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i
      FROM (SELECT id, regexp_extract_all(lower(ref), '{UNICODE}') AS w FROM turns)),
h AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS j
      FROM (SELECT id, regexp_extract_all(lower(hyp), '{UNICODE}') AS w FROM turns)),
step AS (
  SELECT id, 0::BIGINT AS i, j, word, 0::BIGINT AS v FROM h
  UNION ALL
  SELECT id, i, j, word, max(c) OVER (PARTITION BY id ORDER BY j) FROM (
    SELECT s.id, r.i AS i, s.j, s.word,
           CASE WHEN s.word = r.word
                THEN 1 + coalesce(lag(s.v) OVER (PARTITION BY s.id ORDER BY s.j), 0) ELSE s.v END AS c
    FROM step s JOIN r ON r.id = s.id AND r.i = s.i + 1)),
lcs AS (SELECT id, max(v) AS o FROM step GROUP BY id),
mL AS (
  SELECT t.id, (SELECT count(*) FROM r WHERE r.id = t.id) AS nr, (SELECT count(*) FROM h WHERE h.id = t.id) AS nh,
         coalesce(l.o, 0) AS o FROM turns t LEFT JOIN lcs l USING (id)),
xL AS (
  SELECT id, p, r, CASE WHEN o > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f
  FROM (SELECT id, o, o / greatest(nh, 1) AS p, o / greatest(nr, 1) AS r FROM mL))"""
ROUGE_L = f"""WITH RECURSIVE {TURNS}, {LCS}
SELECT id, round(p, 6) AS "rougeL_precision", round(r, 6) AS "rougeL_recall",
       round(f, 6) AS "rougeL_fmeasure" FROM xL"""


def padded(list_sql: str, length: int, pad: str) -> str:
    return f"({list_sql})[1:{length}] || list_transform(range(len(({list_sql})[1:{length}]), {length}), lambda i: {pad})"


def seq2seq(fill: str) -> str:
    def lengths(c: str) -> str:
        return f"list_transform({words(c)}, lambda t: length(t))"

    def text(x: str) -> str:
        return f"array_to_string({x}, ' ')"

    return f"""WITH {TURNS}, e AS (SELECT id, {lengths('ref')} AS s, {lengths('hyp')} AS t FROM turns)
SELECT id, {text(padded('s', 512, '0'))} AS input_ids,
       {text(padded('list_transform(s, lambda q: 1)', 512, '0'))} AS attention_mask,
       {text(padded('t', 128, fill))} AS labels FROM e"""


# Sentence terms are counted per sentence against the vocabulary of the corpus.
EXTRACTIVE = f"""WITH {TERMS}, {VOCABULARY},
parts AS (SELECT doc_id, string_split_regex(text, '[.!?؟\\n]+') AS p FROM documents),
sent AS (
  SELECT doc_id, unnest(q) AS sentence, generate_subscripts(q, 1) - 1 AS pos FROM (
    SELECT doc_id, list_filter(list_transform(p, lambda x: {collapse('x')}), lambda x: x <> '') AS q FROM parts)),
sw AS (SELECT doc_id, pos, regexp_extract_all(lower(sentence), '{TERM}') AS w FROM sent),
st AS (
  SELECT doc_id, pos, unnest(w) AS term FROM sw
  UNION ALL
  SELECT doc_id, pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM sw),
sc AS (
  SELECT doc_id, pos, avg((1 + ln(n)) * idf) AS score FROM (
    SELECT doc_id, pos, term, count(*) AS n FROM st GROUP BY ALL) JOIN fit USING (term) GROUP BY ALL),
ranked AS (
  SELECT doc_id, pos, sentence, row_number() OVER (
      PARTITION BY doc_id ORDER BY round(coalesce(score, 0), 9) DESC, pos) AS rk
  FROM sent LEFT JOIN sc USING (doc_id, pos))
SELECT doc_id, array_to_string(string_split(string_agg(sentence, ' ' ORDER BY pos), ' ')[1:128], ' ') AS summary
FROM ranked WHERE rk <= 3 GROUP BY doc_id"""

GAZETTEER = f"""WITH phrases AS (
  SELECT phrase, len(string_split(phrase, ' ')) AS n, min(kind) AS kind FROM (
    SELECT array_to_string({words('s')}, ' ') AS phrase, kind FROM (
      SELECT unnest(string_split_regex(text, '[.!?\\n]+')) AS s,
             CASE WHEN item_id % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS kind FROM benchmark))
  WHERE phrase <> '' GROUP BY phrase),
d AS (SELECT doc_id, {words("regexp_replace(text, '[.!?\\n]+', ' ', 'g')")} AS w FROM documents),
t AS (SELECT doc_id, w, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM d),
hit AS (
  SELECT doc_id, i, n, kind FROM t JOIN phrases ON string_split(phrase, ' ')[1] = token
  WHERE array_to_string(w[i : i + n - 1], ' ') = phrase),
cover AS (SELECT doc_id, i, n, kind, unnest(range(i, i + n)) AS ix FROM hit),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, ix ORDER BY n DESC, i, kind DESC) AS rk FROM cover)
SELECT b.doc_id, b.ix - 1 AS pos, t.token,
       (CASE WHEN b.ix = b.i THEN 'B-' ELSE 'I-' END) || b.kind AS tag
FROM best b JOIN t ON t.doc_id = b.doc_id AND t.i = b.ix WHERE rk = 1"""

LABELS_OF_PIECES = f"""WITH {TOKENS}, {WORD_IDS}, {TAG_IDS}"""


def piece_labels(label: str, after: str = "") -> str:
    return f"""{LABELS_OF_PIECES},
l AS (SELECT id, list({label} ORDER BY ix) AS l FROM ids LEFT JOIN dict USING (tag) GROUP BY id)
SELECT id, array_to_string({after or 'l'}, ' ') AS labels FROM l"""


ALL_PIECES = "CASE WHEN word IS NULL THEN -100 ELSE tag_id END"

ORACLE_SQL: dict[str, str] = {
    "clean_default": text_query(cleaned()),
    "clean_all_flags": text_query(ALL_CLEAN),
    "clean_flag_off_tatweel": text_query(collapse(punctuation(teh(alef(diacritics("text")))))),
    "clean_keep_whitespace": text_query(
        f"CASE WHEN {collapse('text')} = '' THEN '' ELSE {teh(alef(tatweel(diacritics('text'))))} END"),
    "remove_diacritics": text_query(diacritics("text")),
    "remove_tatweel": text_query(tatweel("text")),
    "normalize_alef": text_query(alef("text")),
    "normalize_teh_marbuta": text_query(teh("text")),
    "remove_punctuation": text_query(punctuation("text")),
    "remove_english": text_query(english("text"), "documents"),
    "remove_numbers": text_query(numbers("text")),
    "collapse_whitespace": text_query(collapse("text")),
    "tokenize": token_query(words("text")),
    "tokenize_punctuation": token_query(
        words(r"regexp_replace(text, '([!-/:-@\[-`{-~])', ' \1 ', 'g')")),
    "remove_stopwords": token_query(kept(words(cleaned()), WITH_CUSTOM)),
    "remove_listed_stopwords": token_query(kept(words(cleaned()), WITH_CUSTOM)),
    "process_tokens": token_query(kept(words(cleaned()), BUILT_IN)),
    "stem_tokens": token_query(stems(words(diacritics("text")))),
    "process_struct": f"""WITH {DOCS}, c AS (SELECT doc_id, text, {cleaned()} AS cleaned FROM docs),
t AS (SELECT *, {kept(words('cleaned'), WITH_CUSTOM)} AS t FROM c)
SELECT doc_id, text AS original, cleaned, array_to_string(t, ' ') AS tokens,
       array_to_string({stems('t')}, ' ') AS stemmed_tokens FROM t""",
    "process_columns": f"""WITH {DOCS}, c AS (SELECT doc_id, lang, {ALL_CLEAN} AS cleaned_text FROM docs),
t AS (SELECT *, {kept(words('cleaned_text'), BUILT_IN)} AS t FROM c)
SELECT doc_id, lang, cleaned_text, array_to_string(t, ' ') AS tokens,
       array_to_string({stems('t')}, ' ') AS stemmed_tokens FROM t""",
    "top_stems_by_lang": f"""WITH {DOCS},
s AS (SELECT lang, unnest({stems(kept(words(cleaned()), BUILT_IN))}) AS stem FROM docs),
n AS (SELECT lang, stem, count(*) AS n FROM s GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, stem) AS rank FROM n)
WHERE rank <= 20""",
    "text_stats": f"""WITH {DOCS}, src AS (FROM docs), {STATS}
SELECT doc_id, n::BIGINT AS word_count, chars::BIGINT AS char_count, d::BIGINT AS unique_words,
       round(CASE WHEN n > 0 THEN letters / n ELSE 0 END, 2) AS avg_word_length,
       round(CASE WHEN chars > 0 THEN ar / chars ELSE 0 END, 4) AS arabic_char_ratio,
       round(CASE WHEN n > 0 THEN d / n ELSE 0 END, 4) AS lexical_diversity FROM s""",
    "stat_columns": f"""WITH src AS (FROM documents), {STATS}
SELECT doc_id, n::BIGINT AS words, chars::BIGINT AS chars,
       round(CASE WHEN n > 0 THEN letters / n ELSE 0 END, 6) AS avg_length,
       round(CASE WHEN chars > 0 THEN ar / chars ELSE 0 END, 6) AS arabic_ratio,
       d::BIGINT AS unique_words, round(CASE WHEN n > 0 THEN d / n ELSE 0 END, 6) AS diversity FROM s""",
    "text_stats_by_lang": f"""WITH {DOCS}, src AS (FROM docs), {STATS},
v AS (SELECT lang, count(DISTINCT word) AS u FROM (SELECT lang, unnest(w) AS word FROM s) GROUP BY lang)
SELECT lang, count(*) AS documents, sum(n)::BIGINT AS words, sum(chars)::BIGINT AS chars,
       any_value(u) AS unique_words, round(sum(letters) / sum(n), 6) AS avg_word_length,
       round(avg(CASE WHEN chars > 0 THEN ar / chars ELSE 0 END), 6) AS avg_arabic_char_ratio,
       round(any_value(u) / sum(n), 6) AS lexical_diversity FROM s JOIN v USING (lang) GROUP BY lang""",
    "label_dictionary": """SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id
FROM (SELECT DISTINCT quality::VARCHAR AS label FROM labels)""",
    "stratified_split": """SELECT doc_id, quality::VARCHAR AS label,
       row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || ':42'), doc_id)
       <= ceil(round(0.2 * count(*) OVER (PARTITION BY quality), 9)) AS is_validation FROM labels""",
    "unstratified_split": """SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id)
       <= ceil(round(0.1 * count(*) OVER (), 9)) AS is_validation FROM documents""",
    "stratified_folds": """SELECT doc_id, lang,
       (row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42'), doc_id) - 1) % 3 AS fold
FROM documents""",
    "ngram_terms": f"WITH {TERMS} SELECT doc_id, term, n FROM counted",
    "vocabulary_topk": f"WITH {TERMS}, {VOCABULARY} SELECT term, tf, df FROM vocab",
    "tfidf_fit": f"WITH {TERMS}, {VOCABULARY} SELECT term, tf, df, round(idf, 6) AS idf FROM fit",
    "tfidf_transform": WEIGHTS,
    "tfidf_transform_join": WEIGHTS,
    "tag_dictionary": f"WITH {TOKENS}, {TAG_IDS} SELECT tag, tag_id FROM dict",
    "align_labels": piece_labels(ALL_PIECES),
    "align_labels_first_piece": piece_labels(
        "CASE WHEN word IS NULL OR piece > 0 THEN -100 ELSE tag_id END"),
    "pad_truncate": f"""{LABELS_OF_PIECES},
l AS (SELECT id, list(coalesce(word, -1) ORDER BY ix) AS l FROM ids GROUP BY id)
SELECT id, 128::BIGINT AS n, array_to_string({padded('l', 128, '0')}, ' ') AS ids FROM l""",
    "prepared_tags": piece_labels(ALL_PIECES, padded("l", 128, "-100")),
    "entity_groups_none": f"""WITH {TOKENS}, {PREDICTIONS}
SELECT id, row_number() OVER (PARTITION BY id ORDER BY ix) - 1 AS k, tag AS entity_group,
       round(score, 6) AS score, word, s AS start_at, e AS end_at FROM pieces WHERE tag <> 'O'""",
    "entity_groups_simple": f"WITH {TOKENS}, {PREDICTIONS}, {grouped_entities('pieces')}",
    "entity_groups_first": f"WITH {TOKENS}, {PREDICTIONS}, {WHOLE_WORDS}, {grouped_entities('whole')}",
    "gazetteer_tags": GAZETTEER,
    "seq2seq_pairs": f"WITH {TURNS} SELECT id, ref AS text, hyp AS summary FROM turns",
    "seq2seq_ids": seq2seq("0"),
    "seq2seq_ids_masked": seq2seq("-100"),
    "extractive_summary": EXTRACTIVE,
    "predict_labels": """SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error'
       WHEN 2 THEN 'view' ELSE (user_id % 5)::VARCHAR END AS label FROM events""",
    "batch_hook": f"SELECT doc_id, len({words('text')})::VARCHAR AS result FROM documents",
    "tagger_hook": r"""WITH t AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS token,
         generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
o AS (
  SELECT *, regexp_matches(token, '\A\p{Lu}') AS up,
         sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(token) - 1 AS s FROM t),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, up ORDER BY i) AS island FROM o)
SELECT doc_id, 'NAME' AS entity_group, string_agg(token, ' ' ORDER BY i) AS word,
       min(s)::BIGINT AS start_at, max(s + length(token))::BIGINT AS end_at
FROM g WHERE up GROUP BY doc_id, island""",
    "confusion_matrix": f"""WITH {EVENT_PAIRS}
SELECT a.label AS truth, b.label AS prediction, count(ev.truth) AS n
FROM labels_seen a JOIN labels_seen b ON TRUE
LEFT JOIN ev ON ev.truth = a.label AND ev.prediction = b.label GROUP BY ALL""",
    "classification_metrics": f"""WITH {EVENT_PAIRS}, {EVENT_TALLY}, {SCORES}
SELECT round(sum(correct) / sum(support), 6) AS accuracy,
  round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f), 6) AS f1_macro,
  round(sum(p * support) / sum(support), 6) AS precision_weighted,
  round(sum(r * support) / sum(support), 6) AS recall_weighted,
  round(sum(f * support) / sum(support), 6) AS f1_weighted FROM scores""",
    "classification_report": f"WITH {EVENT_PAIRS}, {EVENT_TALLY}, {SCORES} " + REPORT.format(overall=ACCURACY),
    "roc_points": f"""WITH {ROC} SELECT score AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM c""",
    "roc_auc": f"""WITH {ROC},
p AS (SELECT fpr, tpr, coalesce(lag(fpr) OVER (ORDER BY fpr, tpr), 0) AS f0,
             coalesce(lag(tpr) OVER (ORDER BY fpr, tpr), 0) AS t0 FROM c)
SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 6) AS roc_auc FROM p""",
    "ner_spans": f"{SPANS} SELECT id, entity_type, first, last FROM pred_spans",
    "ner_token_accuracy": f"""WITH {TOKENS}
SELECT round(avg((t.tag = p.tag)::INT), 6) AS accuracy FROM truth t JOIN pred p USING (id, pos)""",
    "ner_metrics": f"""{SPANS}, {SPAN_TALLY},
m AS (SELECT sum(correct) / sum(predicted) AS p, sum(correct) / sum(support) AS r FROM tally)
SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM m""",
    "ner_report": f"{SPANS}, {SPAN_TALLY}, {SCORES} " + REPORT.format(overall=MICRO),
    "rouge_n": rouge_rows(UNICODE),
    "rouge_n_ascii": rouge_rows("[a-z0-9]+"),
    "rouge_l": ROUGE_L,
    "rouge_summary_n": rouge_means("12"),
    "rouge_summary": rouge_means("12L"),
    "paired_eval": """SELECT doc_id AS id, quality::VARCHAR AS truth, toxic::VARCHAR AS prediction FROM labels""",
    "paired_tables": """SELECT doc_id AS id, quality::VARCHAR AS truth, (n_chars > 500)::INT::VARCHAR AS prediction
FROM labels JOIN documents USING (doc_id)""",
    "stated_predictions": f"""WITH {STATED}
SELECT doc_id, CASE WHEN p > 0.5 THEN '1' ELSE '0' END AS prediction, round(p, 6) AS probability FROM stated""",
    "stated_report": STATED_REPORT,
}
