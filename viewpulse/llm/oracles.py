"""DuckDB SQL of the queries that SQL can express. The others are tested against brute force in tests/llm."""

from __future__ import annotations

ORACLES = {
    "op10_line_dedup": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line),
        frequent AS (
            SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
            SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.holder AS gone
            FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op13_merkle": r"""
        WITH RECURSIVE coded AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS tree,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS size_part,
                   coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1)::VARCHAR, '-') AS more_part,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))))) AS crc
            FROM documents),
        leaves AS (
            SELECT doc_id, tree, sha256(head || size_part || tail) AS leaf,
                   CASE WHEN crc % 7 = 0 THEN sha256(head || more_part || tail) ELSE sha256(head || size_part || tail) END AS tried
            FROM coded),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
            FROM leaves),
        inner_nodes(tree, lvl, idx, digest, n) AS (
            SELECT tree, 0::BIGINT, idx, leaf, n FROM placed
            UNION ALL
            SELECT tree, any_value(lvl) + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
            FROM inner_nodes WHERE n > 1 GROUP BY tree, idx // 2),
        subroots AS (
            SELECT tree, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
            FROM inner_nodes WHERE n = 1),
        outer_nodes(lvl, idx, digest, n) AS (
            SELECT 0::BIGINT, idx, subroot, n FROM subroots
            UNION ALL
            SELECT any_value(lvl) + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
            FROM outer_nodes WHERE n > 1 GROUP BY idx // 2),
        top AS (SELECT digest AS root, lvl AS height FROM outer_nodes WHERE n = 1),
        beside AS (
            SELECT p.tree, p.idx, i.lvl AS step, i.digest, i.idx < p.idx >> i.lvl AS before
            FROM placed p JOIN subroots s USING (tree) JOIN inner_nodes i ON i.tree = p.tree AND i.lvl < s.height AND i.idx = xor(p.idx >> i.lvl, 1)
            UNION ALL
            SELECT p.tree, p.idx, s.height + o.lvl, o.digest, o.idx < s.idx >> o.lvl
            FROM placed p JOIN subroots s USING (tree) CROSS JOIN top JOIN outer_nodes o ON o.lvl < top.height AND o.idx = xor(s.idx >> o.lvl, 1)),
        proofs AS (SELECT tree, idx, string_agg(digest, '' ORDER BY step) AS proof FROM beside GROUP BY ALL),
        folds(tree, idx, step, steps, digest) AS (
            SELECT p.tree, p.idx, 0::BIGINT, s.height + top.height, p.tried FROM placed p JOIN subroots s USING (tree) CROSS JOIN top
            UNION ALL
            SELECT f.tree, f.idx, f.step + 1, f.steps,
                   sha256(CASE WHEN b.before THEN b.digest || f.digest ELSE f.digest || coalesce(b.digest, '') END)
            FROM folds f LEFT JOIN beside b ON b.tree = f.tree AND b.idx = f.idx AND b.step = f.step WHERE f.step < f.steps)
        SELECT p.doc_id, p.leaf, s.subroot, top.root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.digest AS folded_root,
               f.digest = top.root AS verified
        FROM placed p JOIN subroots s USING (tree) CROSS JOIN top
        JOIN folds f ON f.tree = p.tree AND f.idx = p.idx AND f.step = f.steps
        LEFT JOIN proofs q ON q.tree = p.tree AND q.idx = p.idx""",
}
