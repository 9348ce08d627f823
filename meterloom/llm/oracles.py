"""The registered queries that another engine's SQL can answer, as SQL over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    # All pairs of a label, then what links reach.
    "op2_sorted_projection": r"""WITH RECURSIVE given AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
        usable AS (
          SELECT *, sqrt(list_sum([x * x FOR x IN v])) AS norm FROM given
          WHERE label IS NOT NULL AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM given UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, vec_id = l.component_id AS kept
        FROM given g JOIN lowest l ON l.a = g.vec_id LEFT JOIN degree d ON d.a = g.vec_id""",
    # Sets joined on shared shingles, one set for equal ones, then what links reach.
    "op4_ngram_jaccard": r"""WITH RECURSIVE split AS (
          SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM split),
        runs AS (
          SELECT doc_id, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS m,
            lead(w, 4) OVER o IS NOT NULL OR i = 1 AS whole
          FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        sets AS (SELECT DISTINCT doc_id, m FROM runs WHERE whole),
        sized AS (SELECT doc_id, count(*) AS n, sha256(string_agg(m, chr(10) ORDER BY m)) AS same FROM sets GROUP BY doc_id),
        classes AS (SELECT same, n, min(doc_id) AS rep FROM sized GROUP BY same, n),
        members AS (SELECT rep, n, m FROM classes JOIN sets ON doc_id = rep),
        numbered AS (SELECT m, row_number() OVER () AS k FROM members GROUP BY m HAVING count(*) > 1),
        shared AS (SELECT rep, n, k FROM members JOIN numbered USING (m)),
        met AS (
          SELECT a.rep AS a, b.rep AS b FROM shared a JOIN shared b
            ON a.k = b.k AND a.rep < b.rep AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        links AS (SELECT a, b FROM met UNION ALL SELECT b, a FROM met),
        reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        lowest AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
        FROM documents d LEFT JOIN sized z ON z.doc_id = d.doc_id LEFT JOIN classes c ON c.same = z.same AND c.n = z.n
        LEFT JOIN lowest l ON l.rep = c.rep""",
    # Turns joined in order; each control string and backslash is one character longer when escaped.
    "op9_incremental_chat": r"""WITH turns AS (
          SELECT conv_id, turn, role, text, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
          UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]', r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, r)),
        escaped AS (
          SELECT *, len(regexp_extract_all(t, '\[/?INST\]|</?s>|\[/?ROLE\]|\[TEXT\]|\\')) + length(t) AS chars,
            len(regexp_extract_all(r, '\[/?INST\]|</?s>|\[/?ROLE\]|\[TEXT\]|\\')) + length(r) AS role_chars FROM turns)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
          coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS loss_sha256,
          sum(chars + CASE r WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 19 + role_chars END)::BIGINT AS formatted_chars,
          0::BIGINT AS rewritten
        FROM escaped GROUP BY conv_id""",
}
