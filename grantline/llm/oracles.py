"""DuckDB SQL for the queries that SQL can express."""

_ITEM_SHINGLES = r"""
    SELECT id, unnest(CASE WHEN len(w) >= 5
                           THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')))
                           WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s
    FROM (SELECT id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM (SELECT {id} AS id, text FROM {table}))
"""

_REACHED = """
    reached(id, other) AS (
        SELECT id, id FROM vertices
        UNION SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.other)
"""

CHAT = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
    written AS (
        SELECT *, '<|im_start|>'
                  || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
                  || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS segment
        FROM turns),
    placed AS (
        SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS finish
        FROM written)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(coalesce(sum(finish) FILTER (role = 'assistant'), 0) AS BIGINT) AS formatted_chars,
           count(*) FILTER (role = 'assistant') AS n_examples, true AS contexts_agree
    FROM placed GROUP BY conv_id
"""

DECONTAMINATION = f"""
    WITH items AS ({_ITEM_SHINGLES.format(id="item_id", table="benchmark")}),
         sets AS ({_ITEM_SHINGLES.format(id="doc_id", table="documents")}),
         sizes AS (SELECT id, count(*) AS n FROM items GROUP BY id),
         common AS (SELECT sets.id AS doc_id, items.id AS item_id, count(*) AS n FROM sets JOIN items USING (s) GROUP BY ALL)
    SELECT doc_id, item_id, sizes.n AS n_item_shingles, common.n AS n_common, common.n / sizes.n AS containment
    FROM common JOIN sizes ON sizes.id = item_id
    WHERE 5 * common.n >= 4 * sizes.n
"""

NEAR_DUPLICATES = (
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    sets AS (
        SELECT doc_id AS id, unnest(CASE WHEN len(w) >= 5
                   THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')))
                   WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s
        FROM words),
    sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
    common AS (SELECT l.id AS a, r.id AS b, count(*) AS n FROM sets l JOIN sets r ON l.s = r.s AND l.id <> r.id GROUP BY ALL),
    links AS (
        SELECT common.a, common.b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
        WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
    vertices AS (SELECT doc_id AS id FROM documents),
    """
    + _REACHED
    + """
    SELECT id AS doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id, id = min(other) AS kept
    FROM reached LEFT JOIN sizes USING (id) GROUP BY id
    """
)

NEAR_VECTORS = (
    """
    WITH RECURSIVE v AS (
        SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL),
    normed AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v),
    links AS (
        SELECT l.id AS a, r.id AS b FROM normed l JOIN normed r ON l.label = r.label AND l.id <> r.id
        WHERE l.n > 0 AND r.n > 0 AND list_dot_product(l.e, r.e) / (l.n * r.n) >= 0.98),
    vertices AS (SELECT vec_id AS id FROM embeddings),
    degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a),
    """
    + _REACHED
    + """
    SELECT id AS vec_id, coalesce(any_value(degrees.n), 0) AS n_links, min(other) AS component_id, id = min(other) AS kept
    FROM reached LEFT JOIN degrees USING (id) GROUP BY id
    """
)
