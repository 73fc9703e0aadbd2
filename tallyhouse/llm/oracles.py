"""The queries that SQL can express, in DuckDB's dialect."""

OP3 = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2
), windows AS (
    SELECT doc_id, i,
           count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
    FROM places
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE times > 1)
    GROUP BY doc_id
), measured AS (
    SELECT split.doc_id, len(words) AS n_words,
           length(array_to_string(words, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (doc_id)
), ledger AS (
    SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS failed_rules
    FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(failed_rules AS BIGINT) AS failed_rules
FROM ledger
"""

OP9 = """
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM hashed WINDOW w AS (PARTITION BY text_sha256)
"""
