"""The training-data operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdcmart.llm import bpe, chat, contamination, forest, html, language, neardup, ranked, repeats, shards, tokens, toxicity, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_tree": shards.op1_hash_tree,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_prob_minhash": neardup.op3_prob_minhash,
    "op4_classifier_chain": toxicity.op4_classifier_chain,
    "op5_fingerprint_chat": chat.op5_fingerprint_chat,
    "op6_suffix_array": repeats.op6_suffix_array,
    "op7_tree_scoring": html.op7_tree_scoring,
    "op8_block_max": contamination.op8_block_max,
    "op9_word_backoff": language.op9_word_backoff,
    "op10_prefix_forest": forest.op10_prefix_forest,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_token_counts": tokens.op12_token_counts,
    "op13_treap_search": ranked.op13_treap_search,
}

ORACLE: dict[str, str] = {
    "op5_fingerprint_chat": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), said AS (
            SELECT *, length(replace(replace(replace(replace(role, '%', '%25'), '[INST]', '%5BINST]'), '[/INST]', '%5B/INST]'), '</s>', '%3C/s>'))
                      + length(replace(replace(replace(replace(text, '%', '%25'), '[INST]', '%5BINST]'), '[/INST]', '%5B/INST]'), '</s>', '%3C/s>'))
                      AS chars FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars + length('[INST]') + 1 + length('[/INST]</s>') + 1) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id
    """,
    "op13_treap_search": """
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ), sizes AS (
            SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0
        ), whole AS (
            SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes
        ), wanted AS (
            SELECT DISTINCT row_number() OVER () AS i, item_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM benchmark WHERE text IS NOT NULL
        ), asked AS (
            SELECT DISTINCT i, item_id, unnest(terms) AS term FROM wanted
        ), points AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY r, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM points, whole GROUP BY term, nn
        ), scores AS (
            SELECT a.i, a.item_id, s.r, s.doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // l))))) AS BIGINT) AS score
            FROM points p JOIN weights USING (term) JOIN asked a USING (term) JOIN sizes s ON s.r = p.r, whole
            GROUP BY a.i, a.item_id, s.r, s.doc_id
        ), ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    # A member's h is the CRC-32 of its id's digits, bit by bit: 3988292384 is the reversed polynomial.
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), lists AS (
            SELECT c, list(turn ORDER BY pos) AS turns, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS digits
            FROM turns GROUP BY c
        ), hashed AS (
            SELECT *, xor(list_reduce(list_prepend(4294967295, digits), lambda crc, b: list_reduce(
                       list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                       lambda x, bit: CASE x % 2 WHEN 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS h FROM lists
        ), members AS (
            SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
            FROM hashed a LEFT JOIN hashed b ON b.c = a.c - a.c % 5
        ), prefixes AS (
            SELECT c, len(turns) AS n, d, turns[1:d] AS prefix
            FROM (SELECT *, unnest(range(0, CAST(len(turns) AS BIGINT) + 1)) AS d FROM members)
        ), nodes AS (
            SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
                   coalesce(strlen(prefix[d].t), 0) * (count(*) - 1) AS own,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
            FROM prefixes GROUP BY prefix, d
        ), kids AS (
            SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
        ), known AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (prefix, d)
        ), above AS (
            SELECT prefix[1:e] AS prefix, e AS d, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves
            FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM known) GROUP BY ALL
        )
        SELECT k.conv_id, k.d AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
               CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, k.ends_sha256
        FROM known k JOIN above a ON a.prefix = k.prefix AND a.d = k.d
        LEFT JOIN nodes p ON p.prefix = k.prefix[1:k.d - 1] AND p.d = k.d - 1
    """,
}
