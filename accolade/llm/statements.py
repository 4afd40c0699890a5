"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from accolade.llm.site_lines import LEAST_PAGES, RATIO

_LINE = r"trim(line, E' \t\r\n')"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates(table: str) -> str:
    """Common table expressions; ``near`` has (doc_id, n_shingles, component_id) of the table."""
    return rf"""
        words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
            FROM {table}
        ), sets AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS own
            FROM words
        ), each AS MATERIALIZED (SELECT doc_id, len(own) AS n, hash(unnest(own)) AS shingle FROM sets),
        links AS MATERIALIZED (
            SELECT a.doc_id AS u, b.doc_id AS v FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other
        ), near AS (
            SELECT s.doc_id, len(own)::BIGINT AS n_shingles, c.component_id FROM sets s
            JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = s.doc_id
        )"""


def repeated_spans(table: str) -> str:
    """Common table expressions; ``spans`` has (rid, doc_id, body, n_bytes, n_removed, n_spans, kept) of the table.

    Texts are written as hexadecimal digits, two for a byte, and cut into overlapping stretches.
    """
    return f"""
        hexed AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS body FROM {table}
        ), stretches AS (
            SELECT rid, p, substr(body, 2 * p + 1, 2 * 1199) AS piece
            FROM (SELECT rid, body, unnest(range(0, greatest(len(body) // 2 - 199, 0), 1000)) AS p FROM hexed)
        ), starts AS MATERIALIZED (
            SELECT rid, p + i AS pos, md5_number(substr(piece, 2 * i + 1, 400)) AS digest
            FROM (SELECT rid, p, piece, unnest(range(0, least(1000, len(piece) // 2 - 199))) AS i FROM stretches)
        ), again AS (
            SELECT rid, pos FROM starts WHERE digest IN (SELECT digest FROM starts GROUP BY digest HAVING count(*) > 1)
        ), marked AS (
            SELECT rid, pos, pos > coalesce(lag(pos) OVER (PARTITION BY rid ORDER BY pos), -1000) + 200 AS opens FROM again
        ), runs AS (
            SELECT rid, run, min(pos) AS lo, max(pos) + 200 AS hi
            FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY rid ORDER BY pos) AS run FROM marked) GROUP BY rid, run
        ), gaps AS (
            SELECT rid, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS since FROM runs
        ), cut AS (
            SELECT h.rid, string_agg(substr(body, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept,
                   max(hi) AS upto, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans
            FROM gaps g JOIN hexed h ON h.rid = g.rid GROUP BY h.rid
        ), spans AS (
            SELECT h.rid, h.doc_id, h.body, (len(h.body) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
                   coalesce(n_spans, 0) AS n_spans, unhex(coalesce(kept || substr(h.body, 2 * upto + 1), h.body)) AS kept
            FROM hexed h LEFT JOIN cut c ON c.rid = h.rid
        )"""


#: CRC-32 of the decimal digits of conv_id, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
                string_split(conv_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda b: (ascii(c)::BIGINT >> b::BIGINT) & 1)))),
                lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

_WORDS = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {
    "op2_suffix_array_spans": f"""
        WITH {repeated_spans("documents")}
        SELECT doc_id, n_bytes, n_removed, n_spans, sha256(kept) AS kept_sha256 FROM spans""",
    "op4_minmax_components": f"""
        WITH RECURSIVE {near_duplicates("documents")}
        SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near""",
    "op5_threshold_topk": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vec FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )
        SELECT q.vec_id AS query_id,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.vec, c.vec) DESC, c.vec_id)::INTEGER AS rank,
               c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
        FROM usable q JOIN usable c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        QUALIFY rank <= 20""",
    "op6_site_line_frequency": f"""
        WITH lines AS (
            SELECT doc_id, source, rid, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS place
            FROM (SELECT *, row_number() OVER () AS rid FROM documents)
        ), totals AS (SELECT source, count(*) AS site_pages FROM documents GROUP BY source),
        bad AS (
            SELECT source, key FROM (SELECT DISTINCT source, rid, {_LINE} AS key FROM lines) JOIN totals USING (source)
            WHERE key <> '' GROUP BY source, key, site_pages
            HAVING count(*) >= {LEAST_PAGES} AND count(*)::DOUBLE / site_pages > {RATIO}
        )
        SELECT l.doc_id, l.source, count(*) AS n_lines, count(b.key) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (b.key IS NULL), '') AS text
        FROM lines l LEFT JOIN bad b ON b.source = l.source AND b.key = {_LINE}
        GROUP BY l.doc_id, l.source, l.rid""",
    "op11_rollup_trie": rf"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(printf('%08X', strlen(role)) || role || text)) AS pos
            FROM said
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 20 AS head, {_CRC32} % 4 AS h, n FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id)
        ), plan AS (
            SELECT c.*, least(c.h, coalesce(b.n, 0)) AS m, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) AS turns
            FROM convs c LEFT JOIN convs b ON b.conv_id = c.head
        ), rebuilt AS (
            SELECT p.conv_id, pos, role, text FROM plan p JOIN own o ON o.conv_id = p.head AND o.pos <= p.h
            UNION ALL
            SELECT p.conv_id, pos - h + m, role, text FROM plan p JOIN own o ON o.conv_id = p.conv_id WHERE pos > h
        ), paths AS (
            SELECT conv_id, pos AS depth, list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM rebuilt
            UNION ALL SELECT conv_id, 0, [] FROM plan
        ), nodes AS MATERIALIZED (
            SELECT path, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(q.turns) = depth AS leaf,
                   CASE depth WHEN 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].t, {_WORDS})) END AS saved,
                   coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (q.turns = depth), '') AS ended
            FROM paths p JOIN plan q ON q.conv_id = p.conv_id GROUP BY path, depth
        ), above AS (
            SELECT path[1:up] AS path, depth, leaf, saved, up FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes)
        ), below AS (
            SELECT path, count(*) FILTER (depth = up + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
            FROM above GROUP BY path, up
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves, b.saved_tokens, sha256(n.ended) AS ends_sha256
        FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]""",
    "op13_tensor_audit": rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
                   regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents
        ), firsts AS (SELECT body, min(doc_id) AS first FROM texts GROUP BY body),
        marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        judged AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
                    100 * len(regexp_extract_all(body, '[A-Z]')) > 10 * length(body), regexp_matches(body, '[#$%&*|]'),
                    coalesce(doc_id > first, FALSE)] AS fails
            FROM texts JOIN firsts USING (body) LEFT JOIN marks USING (doc_id)
        ), cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
        letters AS (SELECT unnest(range(1, 6)) AS f),
        orders AS (
            SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
        sums AS (
            SELECT part, o, step, o[step] AS own,
                   sum(n) FILTER (NOT early AND NOT fails[o[step]]) AS kept, sum(n) FILTER (NOT early AND fails[o[step]]) AS removed,
                   sum(n) FILTER (early AND fails[o[step]]) AS redundant,
                   sum(n) FILTER (fails[o[step]] AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
                   sum(good) FILTER (NOT early AND fails[o[step]]) AS good_lost, sum(toxic) FILTER (NOT early AND fails[o[step]]) AS toxic_lost
            FROM (SELECT *, len(list_filter(o[1:step - 1], lambda f: fails[f])) > 0 AS early FROM cells, steps) GROUP BY part, o, step
        )
        SELECT part, array_to_string(list_transform(o, lambda f: chr((64 + f)::INTEGER)), '') AS filter_order, step::INTEGER AS step,
               coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
        FROM sums""",
}
