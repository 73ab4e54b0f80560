"""SQL twins of the operators that SQL can express, in DuckDB's dialect. Whole tables, no shortcuts."""

from __future__ import annotations

from harmlens.llm import lexical_search, line_dedup, near_duplicates, secret_ledger, shards, vector_duplicates

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets() -> str:
    """Gaps between matches and the matches give all positions."""
    parts = []
    for rank, rule in enumerate(secret_ledger.RULES, 1):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
          SELECT doc_id, {rank} AS rank, '{rule.name}' AS kind, start, start + n AS stop FROM (
            SELECT doc_id, i, n, ok, sum(gap + n) OVER (PARTITION BY row_no ORDER BY i) - n AS start FROM (
              SELECT row_no, doc_id, i, length(gaps[i]) AS gap, length(hits[i]) AS n, length(vals[i]) >= {rule.least} AS ok FROM (
                SELECT row_no, doc_id, string_split_regex(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}) AS hits,
                  regexp_extract_all(t, {pattern}, {rule.group}) AS vals, unnest(range(1, len(regexp_extract_all(t, {pattern})) + 1)) AS i
                FROM docs WHERE regexp_matches(t, {pattern}))))
          WHERE ok""")
    base = ", ".join(f"'{r.name}'" for r in secret_ledger.RULES if r.base)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.name}') AS n_{r.name}" for r in secret_ledger.RULES if r.base)
    one = "kind || ':' || start::BIGINT || ':' || stop::BIGINT"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({' UNION ALL '.join(parts)}),
        joined AS (
          SELECT doc_id, {counts}, string_agg({one}, ',' ORDER BY start, rank) FILTER (WHERE kind IN ({base})) AS b,
            string_agg({one}, ',' ORDER BY start, rank) AS a
          FROM found GROUP BY doc_id)
        SELECT docs.doc_id, {", ".join(f"coalesce(n_{r.name}, 0)::BIGINT AS n_{r.name}" for r in secret_ledger.RULES if r.base)},
          sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
        FROM docs LEFT JOIN joined ON docs.doc_id = joined.doc_id"""


def extendible_shards(settings: shards.Settings = shards.Settings(), deepest: int = 24) -> str:
    """Shortest prefix that fits; deep enough for tables whose shards need at most ``deepest`` bits."""
    return f"""
        WITH r AS (
          SELECT row_number() OVER () AS row_no, doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
            ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 8))::BIGINT AS h FROM documents),
        p AS (SELECT row_no, doc_id, bytes, depth, h >> (32 - depth)::INTEGER AS node FROM r, unnest(range({deepest} + 1)) AS d(depth)),
        nodes AS (SELECT depth, node, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY ALL),
        leaf AS (
          SELECT row_no, min(p.depth) AS depth FROM p JOIN nodes USING (depth, node)
          WHERE shard_bytes <= {settings.limit_bytes} OR shard_rows = 1 GROUP BY row_no)
        SELECT p.doc_id, p.bytes, CASE WHEN p.depth = 0 THEN '' ELSE lpad(bin(p.node), p.depth::INTEGER, '0') END AS shard,
          p.depth::INTEGER AS depth, shard_rows, shard_bytes
        FROM leaf JOIN p USING (row_no, depth) JOIN nodes USING (depth, node)"""


REACH = """
        reach AS (
          SELECT a AS id, b AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
        least_reached AS (SELECT id, min(r) AS r FROM reach GROUP BY id)"""


def near_documents(settings: near_duplicates.Settings = near_duplicates.Settings(words=4)) -> str:
    k, p = settings.words, settings.percent
    return f"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        s AS (
          SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - {k - 1}, 1) + 1), lambda i: array_to_string(words[i : i + {k - 1}], ' '))) AS shingle
          FROM w WHERE len(words) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM common JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= {p} * (na.n + nb.n - c)),
        {REACH}
        SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(r, w.doc_id)) AS component_id,
          w.doc_id <= coalesce(r, w.doc_id) AS kept
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_reached ON id = w.doc_id"""


def near_vectors(settings: vector_duplicates.Settings = vector_duplicates.Settings()) -> str:
    return f"""
        WITH RECURSIVE v AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
          WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {settings.threshold}),
        {REACH},
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id, vec_id <= coalesce(r, vec_id) AS kept
        FROM embeddings LEFT JOIN counted ON a = vec_id LEFT JOIN least_reached ON id = vec_id"""


def ranked_documents(settings: lexical_search.Settings = lexical_search.Settings()) -> str:
    """Every document that shares a term with an item is scored."""
    terms = f"unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{lexical_search.TERM}'))"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
        held AS (SELECT d, term, count(*) AS tf FROM (SELECT d, {terms} AS term FROM docs) GROUP BY ALL),
        long AS (SELECT d, sum(tf)::BIGINT AS n FROM held GROUP BY d),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM long),
        weight AS (
          SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, total GROUP BY term),
        items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
        asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, {terms} AS term FROM items) GROUP BY ALL),
        scored AS (
          SELECT i, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
          FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN long USING (d), total GROUP BY i, d),
        placed AS (
          SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS place, doc_id, score
          FROM scored JOIN items USING (i) JOIN docs USING (d) WHERE score >= {settings.lowest})
        SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= {settings.best}"""


def repeated_lines(settings: line_dedup.Settings = line_dedup.Settings()) -> str:
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS cut FROM documents),
        lines AS (SELECT d, doc_id, unnest(range(1, len(cut) + 1)) AS i, unnest(cut) AS line FROM docs),
        keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines),
        repeated AS (
          SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= {settings.characters}
          GROUP BY key HAVING count(DISTINCT d) >= {settings.documents}),
        judged AS (
          SELECT d, doc_id, i, line, repeated.key IS NOT NULL AND doc_id IS NOT NULL AND doc_id <> largest AS gone
          FROM keyed LEFT JOIN repeated USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY d, doc_id"""
