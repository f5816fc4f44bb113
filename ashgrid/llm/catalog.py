"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import op8_decontamination
from .filter_audit import op13_filter_audit
from .fingerprints import op4_fingerprints
from .infill import op11_infill
from .jaccard import op3_jaccard_join
from .personal import op6_pii
from .pieces import op2_sentencepiece
from .quality import op1_quality
from .secret_scan import op9_secrets
from .sharding import op5_sharding
from .substrings import op12_substring_dedup
from .token_counts import op10_token_counts
from .toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_fingerprints": op4_fingerprints,
    "op5_sharding": op5_sharding,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_secrets": op9_secrets,
    "op10_token_counts": op10_token_counts,
    "op11_infill": op11_infill,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_filter_audit": op13_filter_audit,
}

#: Only where SQL can express the operator.
SQL: dict[str, str] = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
                THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                ELSE [array_to_string(w, ' ')] END) AS g
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 5 * c >= 4 * (x.n + y.n - c)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT r.doc_id, min(r.other) AS class_id,
               (SELECT count(*) FROM links l WHERE l.a = r.doc_id) AS n_links
        FROM reach r GROUP BY r.doc_id
    """,
    "op11_infill": r"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
            FROM documents),
        numbers AS (
            SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1,
                   CAST('0x' || hex[9:16] AS BIGINT) AS h2, CAST('0x' || hex[17:24] AS BIGINT) AS h3,
                   CAST('0x' || hex[25:32] AS BIGINT) AS h4
            FROM drawn),
        cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM numbers),
        parts AS (
            SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m,
                   array_to_string(w[b + 1:n], '') AS s
            FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op12_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS v
            FROM words, unnest(range(1, len(w) - 48)) AS t(i)),
        earliest AS (SELECT v, min(doc_id) AS lo FROM windows GROUP BY v),
        gone AS (
            SELECT DISTINCT x.doc_id, unnest(range(i, i + 50)) AS pos
            FROM windows x JOIN earliest e ON e.v = x.v AND e.lo < x.doc_id),
        lost AS (SELECT doc_id, list(pos) AS lost FROM gone GROUP BY doc_id)
        SELECT x.doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(len(lost), 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(CASE WHEN lost IS NULL THEN w ELSE
                   [w[i] for i in range(1, len(w) + 1) if NOT list_contains(lost, i)] END, ' '))
                   AS kept_sha256
        FROM words x LEFT JOIN lost l ON l.doc_id = x.doc_id
    """,
    "op13_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        marks AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
            FROM labels GROUP BY doc_id),
        failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
                          CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                          CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
                               THEN 'C' ELSE '' END,
                          CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                          CASE WHEN min(t.doc_id) OVER (PARTITION BY text) < t.doc_id
                               THEN 'E' ELSE '' END) AS f
            FROM texts t LEFT JOIN marks m ON m.doc_id = t.doc_id),
        counts AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good,
                   count(*) FILTER (toxic) AS toxic
            FROM failed GROUP BY part, f),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS before
            FROM orders, unnest(range(1, 6)) AS t(step)),
        seen AS (
            SELECT part, filter_order, step, n, good, toxic, f = own AS alone, contains(f, own) AS fails,
                   len(translate(before, f, '')) < len(before) AS earlier,
                   CASE WHEN contains(f, own) THEN n * 120 // len(f) ELSE 0 END AS turns
            FROM counts, steps)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step,
               CAST(sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
               CAST(sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
               CAST(sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
               CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
               CAST(sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
               CAST(sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
               CAST(sum(turns) AS BIGINT) AS shapley
        FROM seen GROUP BY part, filter_order, step
    """,
}
