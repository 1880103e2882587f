"""DuckDB SQL equivalents of every query in :mod:`lexiflow.plans.catalog`.

Written independently of the Spark plans: tokens come from DuckDB regex
functions, stop words are removed with NOT IN, similarities are computed by
counting shared tokens over the whole (unfiltered) index, not with prefixes.
"""

from __future__ import annotations

T = 4000  # QUERY_STOP_THRESHOLD
T_LIST = 400  # LIST_THRESHOLD
EOL = "'\\r\\n|\\n|\\r'"

LINES = f"""
lines AS (
  SELECT doc_id * 1000000 + line_no AS line_id, doc_id, line_no, source, value
  FROM (SELECT doc_id, source, unnest(string_split_regex(text, {EOL})) AS value,
               unnest(generate_series(1, len(string_split_regex(text, {EOL})))) AS line_no
        FROM documents))"""

RAW_TOKENS = """
raw_tokens AS (
  SELECT unnest(CASE WHEN regexp_matches(value, '^\\s+$') THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(value, '\\s+$', ''), '\\s+') END)
         AS word
  FROM lines)"""

CLEAN_TOKENS = """
clean_tokens AS (
  SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS word FROM documents)"""

TAGGED = f"""
tagged AS (
  SELECT source AS doc, lower(w) AS word
  FROM (SELECT source, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents)),
stop AS (SELECT word FROM tagged GROUP BY word HAVING count(*) > {T}),
tf AS (SELECT word, doc, count(*) AS tf FROM tagged
       WHERE word NOT IN (SELECT word FROM stop) GROUP BY word, doc)"""

# line documents: distinct case-kept tokens, stop words (> T occurrences) removed,
# ordered by (global count, word)
def _processed(threshold: int) -> str:
    return f"""
{LINES.strip()},
kept AS (SELECT line_id, value FROM lines WHERE value <> ''),
occ AS (SELECT unnest(regexp_extract_all(value, '[A-Za-z0-9]+')) AS word FROM kept),
vocab AS (SELECT word, count(*) AS n FROM occ GROUP BY word),
line_words AS (
  SELECT DISTINCT line_id, word
  FROM (SELECT line_id, unnest(regexp_extract_all(value, '[A-Za-z0-9]+')) AS word FROM kept)),
ranked AS (
  SELECT l.line_id AS doc_id, l.word, v.n FROM line_words l JOIN vocab v USING (word)
  WHERE l.word NOT IN (SELECT word FROM vocab WHERE n > {threshold})),
docs AS (
  SELECT doc_id, list(word ORDER BY n, word) AS tokens, count(*) AS size
  FROM ranked GROUP BY doc_id)"""


PROCESSED = _processed(T)


def _pairs(p: int, q: int, measure: str, strict: bool, processed: str = PROCESSED) -> str:
    """Similar pairs from overlap counts of the whole index, no prefix filter.

    Sizes further apart than the threshold allows cannot reach it and are not counted.
    """
    far = (p, q) if measure == "jaccard" else (p, q - p)
    if measure == "jaccard":
        denom = "(sa.size + sb.size - o)"
    else:
        denom = "(sa.size + sb.size)"
    op = ">" if strict else ">="
    return f"""
WITH {processed.strip()},
dw AS (SELECT ranked.doc_id, word, size FROM ranked JOIN docs ON ranked.doc_id = docs.doc_id),
ov AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS o
       FROM dw a JOIN dw b ON a.word = b.word AND a.doc_id < b.doc_id
       WHERE least(a.size, b.size) * {far[1]} >= greatest(a.size, b.size) * {far[0]} GROUP BY 1, 2)
SELECT doc_a, doc_b, o::DOUBLE / {denom}::DOUBLE AS similarity
FROM ov JOIN docs sa ON sa.doc_id = ov.doc_a JOIN docs sb ON sb.doc_id = ov.doc_b
WHERE o * {q} {op} {denom} * {p}"""


def _prefix_len(p: int, q: int, size: str = "size") -> str:
    return f"least({size}, greatest(1, {size} - ({size} * {p} + {q - 1}) // {q} + 1))"


ORACLE_SQL: dict[str, str] = {
    "word_count_clean": f"""
WITH {CLEAN_TOKENS.strip()}
SELECT word, count(*) AS n FROM clean_tokens GROUP BY word""",

    "word_count_raw": f"""
WITH {LINES.strip()}, {RAW_TOKENS.strip()}
SELECT word, count(*) AS n FROM raw_tokens GROUP BY word""",

    "word_count_lower": f"""
WITH {CLEAN_TOKENS.strip()}
SELECT lower(word) AS word, count(*) AS n FROM clean_tokens GROUP BY lower(word)""",

    "first_letter_count": f"""
WITH {LINES.strip()}, {RAW_TOKENS.strip()}
SELECT lower(substring(word, 1, 1)) AS letter, count(*) AS n
FROM raw_tokens GROUP BY lower(substring(word, 1, 1))""",

    "stop_words_lower": f"""
WITH {CLEAN_TOKENS.strip()}
SELECT lower(word) AS word, count(*) AS n FROM clean_tokens GROUP BY lower(word)
HAVING count(*) > {T_LIST}""",

    "stop_words_case": f"""
WITH {CLEAN_TOKENS.strip()}
SELECT word, count(*) AS n FROM clean_tokens GROUP BY word HAVING count(*) > {T_LIST}""",

    "top_words": f"""
WITH {CLEAN_TOKENS.strip()}
SELECT word, count(*) AS n FROM clean_tokens GROUP BY word ORDER BY n DESC, word LIMIT 100""",

    "inverted_index": f"""
WITH {TAGGED.strip()}
SELECT word, count(*) AS n_docs, string_agg(doc, ', ' ORDER BY doc) AS docs
FROM tf GROUP BY word""",

    "inverted_index_tf": f"""
WITH {TAGGED.strip()}
SELECT word, string_agg(doc || '#' || CAST(tf AS VARCHAR), ', ' ORDER BY doc) AS postings
FROM tf GROUP BY word""",

    "single_document_words": f"""
WITH {TAGGED.strip()}
SELECT word, min(doc) AS doc FROM tf GROUP BY word HAVING count(*) = 1""",

    "vocabulary_stats": f"""
WITH {TAGGED.strip()},
pw AS (SELECT word, count(*) AS n_docs FROM tf GROUP BY word)
SELECT count(*) AS unique_words,
       count(*) FILTER (WHERE n_docs = 1) AS single_document_words FROM pw""",

    "preprocess_documents": f"""
WITH {PROCESSED.strip()}
SELECT doc_id, array_to_string(tokens, ';') AS tokens FROM docs""",

    "preprocess_ties_collapsed": f"""
WITH {PROCESSED.strip()},
last_of_run AS (SELECT doc_id, n, max(word) AS word FROM ranked GROUP BY doc_id, n)
SELECT doc_id, string_agg(word, ';' ORDER BY n, word) AS tokens
FROM last_of_run GROUP BY doc_id""",

    "document_count": f"""
WITH {PROCESSED.strip()}
SELECT count(*) AS n_documents FROM docs""",

    "prefix_index": f"""
WITH {PROCESSED.strip()},
posted AS (SELECT doc_id, unnest(tokens[1:{_prefix_len(4, 5)}]) AS word FROM docs)
SELECT word, count(*) AS n_docs, string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS docs
FROM posted GROUP BY word""",

    "similar_pairs_naive": _pairs(1, 2, "jaccard", False),
    "similar_pairs_prefix": _pairs(4, 5, "jaccard", False),
    "similar_pairs_overlap_ratio": _pairs(1, 4, "overlap_ratio", True),

    "comparison_stats": f"""
WITH {PROCESSED.strip()},
sets AS (SELECT tokens, min(doc_id) AS set_id, any_value(size) AS size FROM docs GROUP BY tokens),
probe AS (SELECT set_id, size, unnest(tokens[1:{_prefix_len(4, 5)}]) AS tok,
                 unnest(generate_series(1, {_prefix_len(4, 5)})) AS pos FROM sets),
idx AS (SELECT set_id, size, unnest(tokens[1:{_prefix_len(8, 9)}]) AS tok,
               unnest(generate_series(1, {_prefix_len(8, 9)})) AS pos FROM sets),
cand AS (SELECT x.set_id AS l, y.set_id AS r FROM probe x JOIN idx y
         ON x.tok = y.tok AND (x.size > y.size OR (x.size = y.size AND x.set_id > y.set_id))
         WHERE least(x.size, y.size) * 5 >= greatest(x.size, y.size) * 4
         GROUP BY x.set_id, y.set_id, x.size, y.size
         HAVING (count(*) + least(x.size - max(x.pos), y.size - max(y.pos))) * 9
                >= (x.size + y.size) * 4),
c AS (SELECT (SELECT count(*) FROM docs) AS n_documents,
             (SELECT count(*) FROM sets) AS distinct_sets,
             (SELECT count(*) FROM cand) AS candidate_pairs)
SELECT n_documents, n_documents * (n_documents - 1) // 2 AS all_pairs, distinct_sets,
       candidate_pairs,
       CASE WHEN n_documents * (n_documents - 1) // 2 > 0
            THEN candidate_pairs / (n_documents * (n_documents - 1) // 2)::DOUBLE END
         AS saving_ratio
FROM c""",

    "sample_lines": f"""
WITH {LINES.strip()}
SELECT line_id AS doc_id, value AS line FROM lines ORDER BY line_id LIMIT 1000""",
}

_SAME = {
    "text_round_trip_tab": "first_letter_count",
    "text_round_trip_comma": "word_count_clean",
    "text_round_trip_processed": "preprocess_documents",
    "document_count_round_trip": "document_count",
    "file_name_index": "single_document_words",
    "stop_words_bucketed": "stop_words_case",
    "base_name_index": "inverted_index",
    "preprocess_stop_file": "preprocess_documents",
}
for _name, _base in _SAME.items():
    ORACLE_SQL[_name] = ORACLE_SQL[_base]

ORACLE_SQL["stop_list_round_trip"] = f"""
WITH {CLEAN_TOKENS.strip()}
SELECT word FROM clean_tokens GROUP BY word HAVING count(*) > {T_LIST}"""

ORACLE_SQL["text_round_trip_arrow"] = f"""
WITH {TAGGED.strip()}
SELECT word, string_agg(doc, ', ' ORDER BY doc) AS docs FROM tf GROUP BY word"""

ORACLE_SQL["corpus_from_files"] = f"""
SELECT source AS doc, CAST(sum(len(string_split_regex(text, {EOL}))) AS BIGINT) AS n_lines,
       CAST(sum(len(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS BIGINT) AS n_words
FROM documents GROUP BY source"""

ORACLE_SQL["numbered_lines"] = f"""
WITH {LINES.strip()}
SELECT row_number() OVER (ORDER BY doc_id, line_no) AS line_id, value AS line
FROM lines WHERE value <> ''"""


ORACLE_SQL["streaming_word_count"] = ORACLE_SQL["word_count_clean"]
ORACLE_SQL["streaming_stop_words"] = ORACLE_SQL["stop_words_lower"]

ORACLE_SQL["word_count_counters"] = f"""
WITH {LINES.strip()},
toks AS (SELECT CASE WHEN regexp_matches(value, '^\\s+$') THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(value, '\\s+$', ''), '\\s+') END AS t
         FROM lines)
SELECT (SELECT count(*) FROM toks) AS input_records,
       (SELECT CAST(coalesce(sum(len(t)), 0) AS BIGINT) FROM toks) AS output_records,
       (SELECT count(DISTINCT w) FROM (SELECT unnest(t) AS w FROM toks)) AS output_groups"""

ORACLE_SQL["similar_pairs_text"] = f"""
SELECT doc_a, doc_b, CAST(CAST(similarity AS FLOAT) AS VARCHAR) AS similarity
FROM ({_pairs(4, 5, "jaccard", False)})"""

ORACLE_SQL["all_pairs_stats"] = f"""
WITH {PROCESSED.strip()}
SELECT count(*) AS n_documents, count(*) * (count(*) - 1) // 2 AS all_pairs,
       count(DISTINCT tokens) AS distinct_sets
FROM docs"""

ORACLE_SQL["preprocess_chained"] = f"""
WITH {_processed(T_LIST).strip()}
SELECT doc_id, array_to_string(tokens, ';') AS tokens FROM docs"""
ORACLE_SQL["similar_pairs_chained"] = _pairs(4, 5, "jaccard", False, _processed(T_LIST))

ORACLE_SQL["inverted_index_stop_file"] = f"""
WITH {CLEAN_TOKENS.strip()},
stop AS (SELECT lower(word) AS word FROM clean_tokens GROUP BY word HAVING count(*) > {T_LIST}),
tagged AS (
  SELECT DISTINCT source AS doc, lower(w) AS word
  FROM (SELECT source, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents))
SELECT word, count(*) AS n_docs, string_agg(doc, ', ' ORDER BY doc) AS docs
FROM tagged WHERE word NOT IN (SELECT word FROM stop) GROUP BY word"""

ORACLE_SQL["posting_blocks"] = """
WITH tagged AS (
  SELECT DISTINCT doc_id, lower(w) AS word
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents))
SELECT word, doc_id // 500 AS block, count(*) AS n_docs,
       string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS docs
FROM tagged GROUP BY word, doc_id // 500"""

ORACLE_SQL["posting_blocks_tf"] = """
WITH tf AS (
  SELECT doc_id, lower(w) AS word, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents)
  GROUP BY doc_id, lower(w))
SELECT word, doc_id // 500 AS block, count(*) AS n_docs,
       string_agg(doc_id || '#' || tf, ', ' ORDER BY doc_id) AS postings
FROM tf GROUP BY word, doc_id // 500"""

ORACLE_SQL["posting_blocks_by_name"] = """
WITH names AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM (SELECT DISTINCT source FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z0-9]+')) > 0)),
tf AS (
  SELECT source, lower(w) AS word, count(*) AS tf
  FROM (SELECT source, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM documents)
  GROUP BY source, lower(w))
SELECT word, place // 2 AS block, count(*) AS n_docs,
       string_agg(source || '#' || tf, ', ' ORDER BY source) AS postings
FROM tf JOIN names USING (source) GROUP BY word, place // 2"""

ORACLE_SQL["prefix_index_blocks"] = f"""
WITH {PROCESSED.strip()},
posted AS (SELECT doc_id, unnest(tokens[1:{_prefix_len(4, 5)}]) AS word FROM docs)
SELECT word, doc_id // 100000000 AS block, count(*) AS n_docs,
       string_agg(CAST(doc_id AS VARCHAR), ', ' ORDER BY doc_id) AS docs
FROM posted GROUP BY word, doc_id // 100000000"""

ORACLE_SQL["similar_sets"] = f"""
WITH {PROCESSED.strip()},
firsts AS (SELECT min(doc_id) AS set_id FROM docs GROUP BY tokens)
SELECT doc_a AS set_a, doc_b AS set_b, similarity FROM ({_pairs(4, 5, "jaccard", False)})
WHERE doc_a IN (SELECT set_id FROM firsts) AND doc_b IN (SELECT set_id FROM firsts)"""

ORACLE_SQL["similar_set_members"] = f"""
WITH {PROCESSED.strip()}
SELECT doc_id, min(doc_id) OVER (PARTITION BY tokens) AS set_id,
       count(*) OVER (PARTITION BY tokens) AS copies, size::INTEGER AS size FROM docs"""

ORACLE_SQL["multi_corpus_index"] = f"""
WITH corpus AS (
  SELECT source AS doc, text FROM documents
  UNION ALL SELECT 'benchmark' AS doc, text FROM benchmark
  UNION ALL SELECT role AS doc, text FROM conversations),
tagged AS (
  SELECT doc, lower(w) AS word
  FROM (SELECT doc, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM corpus)),
stop AS (SELECT word FROM tagged GROUP BY word HAVING count(*) > {T}),
tf AS (SELECT word, doc, count(*) AS tf FROM tagged
       WHERE word NOT IN (SELECT word FROM stop) GROUP BY word, doc)
SELECT word, count(*) AS n_docs, string_agg(doc, ', ' ORDER BY doc) AS docs
FROM tf GROUP BY word"""
ORACLE_SQL["streaming_inverted_index_tf"] = ORACLE_SQL["inverted_index_tf"]
