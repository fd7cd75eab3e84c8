"""SQL for the text queries that SQL can express; DuckDB runs it over the same tables."""

from __future__ import annotations

def crc32(text: str) -> str:
    """SQL of the crc32 of a string's UTF-8 bytes, by a table ``crc`` of one row whose list ``t`` has the 256 steps."""
    digits = f"hex(encode({text}))"
    byte = f"(instr('0123456789ABCDEF', substr({digits}, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr({digits}, 2 * i + 2, 1)) - 1"
    data = f"list_transform(range(length({digits}) // 2), lambda i: ({byte})::BIGINT)"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))"
    return f"xor({folded}, 4294967295::BIGINT)"


#: The 256 steps of crc32, by shifting out eight bits of each number.
CRC_TABLE = """
        RECURSIVE steps(i, k, a) AS (
            SELECT i, 0, i FROM range(256) r(i)
            UNION ALL
            SELECT i, k + 1, xor(a >> 1, (a & 1) * 3988292384::BIGINT) FROM steps WHERE k < 8),
        crc AS (SELECT list(a ORDER BY i) AS t FROM steps WHERE k = 8)"""

CHECKS: dict[str, str] = {
    "op10_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_credentials": """
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        kinds(rank, kind, pattern) AS (VALUES
            (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
            (1, 'access', 'AKIA[A-Z0-9]+'),
            (2, 'hex', '[0-9a-f]{32,}'),
            (3, 'endpoint', '(?:https?|wss?|s3|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+'),
            (4, 'bare', '[A-Za-z0-9+/]{40,}')),
        cut AS (
            SELECT doc_id, rank, kind, unnest(string_split_regex(text, pattern)) AS gap,
                   unnest(regexp_extract_all(text, pattern) || ['']) AS hit,
                   unnest(regexp_extract_all(text, pattern, CASE WHEN rank = 0 THEN 2 ELSE 0 END) || ['']) AS part,
                   generate_subscripts(string_split_regex(text, pattern), 1) AS n
            FROM docs, kinds WHERE regexp_matches(text, pattern)),
        placed AS (
            SELECT doc_id, rank, kind, hit, part, length(hit) AS size,
                   sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY n) AS stop
            FROM cut),
        parts AS (
            SELECT doc_id, rank, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop FROM placed
            WHERE hit <> '' AND CASE rank WHEN 0 THEN length(part) >= 8 WHEN 1 THEN size >= 16 ELSE true END),
        linked AS (
            SELECT * FROM parts WHERE rank < 3
            UNION ALL
            SELECT * FROM parts p WHERE rank >= 3 AND EXISTS (
                SELECT 1 FROM parts o
                WHERE o.doc_id = p.doc_id AND o.start - p.stop <= 400 AND p.start - o.stop <= 400
                  AND CASE p.rank WHEN 3 THEN o.rank IN (0, 1) ELSE o.rank IN (1, 3) END)),
        listed AS (
            SELECT doc_id,
                   count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
                   count(*) FILTER (rank = 2) AS n_hex,
                   coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
                            FILTER (rank < 3), '') AS base,
                   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
            FROM linked GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN listed USING (doc_id)""",
    "op11_spelling_variants": f"""
        WITH {CRC_TABLE},
        found AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents),
        hashed AS (
            SELECT run, rows, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
            FROM (SELECT doc_id, run, count(*) AS rows FROM found GROUP BY ALL), crc),
        spelt AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word, rows
            FROM hashed),
        words AS (
            SELECT word, sum(rows)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(rows) >= 2),
        shorter AS (
            SELECT word, n, p, substr(word, 1, p::INT) || substr(word, p::INT + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
            UNION
            SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
            UNION
            SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, min({{'n': -other_n, 'word': other}}) AS top FROM near GROUP BY word),
        judged AS (
            SELECT words.word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -top.n >= 10 * words.n THEN top.word END AS form,
                   CASE WHEN -top.n >= 10 * words.n THEN (-top.n)::BIGINT END AS form_n
            FROM words LEFT JOIN best ON words.word = best.word),
        way(word, root, hops) AS (
            SELECT word, word, 0 FROM judged
            UNION ALL
            SELECT way.word, judged.form, hops + 1 FROM way JOIN judged ON way.root = judged.word
            WHERE judged.form IS NOT NULL)
        SELECT judged.word, form, arg_max(way.root, hops) AS root, any_value(n) AS n, any_value(n_near) AS n_near,
               any_value(form_n) AS form_n
        FROM judged JOIN way ON judged.word = way.word GROUP BY judged.word, form""",
    "op12_nearest_neighbours": """
        WITH usable AS (
            SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op13_prefix_trie": f"""
        WITH {CRC_TABLE},
        turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        whole AS (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS said FROM turns GROUP BY conv_id),
        headed AS (SELECT conv_id, said, {crc32("conv_id::VARCHAR")} % 4 AS h FROM whole, crc),
        made AS (
            SELECT c.conv_id, coalesce(b.said[1:c.h], []) || c.said[c.h + 1:] AS said
            FROM headed c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 20),
        met AS (SELECT conv_id, d, said[1:d] AS said, len(said) AS size FROM (SELECT *, unnest(range(len(said) + 1)) AS d FROM made)),
        nodes AS (
            SELECT said, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
            FROM met GROUP BY said, d),
        linked AS (
            SELECT n.*, p.conv_id AS parent_conv_id,
                   (n.n_convs - 1) * coalesce(len(regexp_extract_all(n.said[n.depth].text, '[^\\x20\\x09-\\x0D]+')), 0) AS saved
            FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.said = n.said[1:n.depth - 1]),
        counted AS (
            SELECT l.*, (SELECT count(*) FROM linked c WHERE c.parent_conv_id = l.conv_id AND c.depth = l.depth + 1) AS n_children FROM linked l),
        upwards AS (SELECT said[1:up] AS said, up, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted)),
        totals AS (
            SELECT said, up, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM upwards GROUP BY said, up)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
        FROM counted c JOIN totals t ON t.up = c.depth AND t.said = c.said""",
}
