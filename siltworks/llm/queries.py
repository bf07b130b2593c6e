"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltworks.llm import bpe, common, embeddings, lines, minhash, mixing, pieces, quality, ranking, secrets, sharding, suffixes, topk, tries


def mix_targets(spark, sf_dir: str):
    """What op1 aims at, by source: the part of it that SQL has too."""
    docs = common.table(spark, sf_dir, "documents").select("source", common.word_count(F.col("text")).alias("size"))
    return mixing.source_targets(docs).select("source", "source_size", F.round("target", 3).alias("target"))


def secret_base(spark, sf_dir: str):
    """The base spans of op3: the part of it that SQL has too."""
    return secrets.op3(spark, sf_dir).drop("spans")


QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_embeddings": embeddings.op2,
    "op3_secrets": secrets.op3,
    "op4_pieces": pieces.op4,
    "op5_suffixes": suffixes.op5,
    "op6_quality": quality.op6,
    "op7_topk": topk.op7,
    "op8_lines": lines.op8,
    "op9_minhash": minhash.op9,
    "op10_shard_bytes": sharding.op10,
    "op11_byte_bpe": bpe.op11,
    "op12_ranked": ranking.op12,
    "op13_prefix_trie": tries.op13,
    "mix_targets": mix_targets,
    "secret_base": secret_base,
}

#: Links a (smaller) - b between ids, to component_id: the smallest id that each id reaches.
_REACH = """
    , reach AS (
        SELECT id, id AS r FROM ids
        UNION
        SELECT b, r FROM reach JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) l ON l.a = reach.id
    ), component AS (SELECT id, MIN(r) AS component_id FROM reach GROUP BY id)
"""

#: (doc_id, start, rank, stop) of the matches of one kind in which a group has so many characters.
_SPANS = """
    SELECT doc_id, CAST(list_sum(list_transform(gap[1:k], lambda x: length(x))) + COALESCE(list_sum(list_transform(hit[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS start, {rank} AS rank, length(hit[k]) AS n
    FROM (
        SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gap, regexp_extract_all(t, '{pattern}', 0) AS hit, regexp_extract_all(t, '{pattern}', {group}) AS value
        FROM t WHERE regexp_matches(t, '{pattern}')
    ), unnest(range(1, len(hit) + 1)) AS u(k)
    WHERE length(value[k]) >= {least}
"""
#: (crc) with one row: the CRC-32 of each byte.
_CRC = """
    SELECT list(c ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), list_transform(range(0, 8), lambda x: CAST(0 AS UBIGINT))), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS c
        FROM range(0, 256) AS r(i)
    )
"""
_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
)

ORACLE_SQL: dict[str, str] = {
    "mix_targets": r"""
        WITH s AS (
            SELECT source, CAST(SUM(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+'))) AS BIGINT) AS source_size FROM documents GROUP BY source
        ), w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
        r AS (
            SELECT *, 2.0 * source_size / weight AS full_at, COALESCE(SUM(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
                   SUM(weight) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still_open FROM w
        ), l AS (SELECT level FROM (SELECT *, ((SELECT 1.5 * SUM(source_size) FROM s) - full_before) / still_open AS level FROM r) WHERE level <= full_at ORDER BY full_at, source LIMIT 1)
        SELECT source, source_size, round(least(weight * level, 2.0 * source_size)::DOUBLE, 3) AS target FROM w, l
    """,
    "secret_base": f"""
        WITH t AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
        s AS ({" UNION ALL ".join(_SPANS.format(rank=k, pattern=p, group=g, least=n) for k, (_, p, g, n) in enumerate(_KINDS))}),
        g AS (
            SELECT doc_id, COUNT(*) FILTER (rank = 0) AS n_assign, COUNT(*) FILTER (rank = 1) AS n_access, COUNT(*) FILTER (rank = 2) AS n_hex,
                   string_agg(['assign', 'access', 'hex'][rank + 1] || ':' || start || ':' || (start + n), ',' ORDER BY start, rank) AS spans
            FROM s GROUP BY doc_id
        )
        SELECT doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex, sha256(COALESCE(spans, '')) AS base_sha256
        FROM t LEFT JOIN g USING (doc_id)
    """,
    "op13_prefix_trie": rf"""
        WITH table_ AS ({_CRC}),
        o AS (
            SELECT conv_id, COALESCE(text, '') AS t, length(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '') AS s,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, list(md5(s) ORDER BY p) AS l, list(CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) ORDER BY p) AS w FROM o GROUP BY conv_id
        ), h AS (
            SELECT conv_id, l, w, CAST(xor(CAST(4294967295 AS UBIGINT), list_reduce(
                list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, len(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[CAST(i AS BIGINT)]) AS UBIGINT))),
                lambda c, x: xor(c >> 8, crc[CAST(xor(c & 255, x) AS BIGINT) + 1]))) AS BIGINT) % 4 AS h
            FROM c, table_
        ), r AS (
            SELECT h.conv_id, list_concat(COALESCE(b.l, [])[1:h], h.l[h + 1:]) AS l, list_concat(COALESCE(b.w, [])[1:h], h.w[h + 1:]) AS w
            FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20
        ), n AS (
            SELECT conv_id, CAST(d AS BIGINT) AS d, array_to_string(l[1:CAST(d AS BIGINT)], ',') AS k, array_to_string(l[1:CAST(d - 1 AS BIGINT)], ',') AS up, COALESCE(w[CAST(d AS BIGINT)], 0) AS words, len(l) = d AS ends
            FROM r, unnest(range(0, len(l) + 1)) AS t(d)
        ), g AS (
            SELECT d, k, MIN(conv_id) AS conv_id, any_value(up) AS up, COUNT(*) AS n_convs, (COUNT(*) - 1) * MAX(words) AS saved,
                   sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM n GROUP BY d, k
        ), e AS (SELECT g.*, (SELECT COUNT(*) FROM g x WHERE x.d = g.d + 1 AND x.up = g.k) AS n_children FROM g),
        pairs AS (SELECT DISTINCT x.d AS d, x.k AS k, y.d AS below_d, y.k AS below FROM n x JOIN n y ON x.conv_id = y.conv_id AND x.d <= y.d),
        s AS (
            SELECT p.d, p.k, COUNT(*) FILTER (e.n_children = 0) AS n_leaves, CAST(SUM(e.saved) AS BIGINT) AS saved_tokens
            FROM pairs p JOIN e ON e.d = p.below_d AND e.k = p.below GROUP BY p.d, p.k
        )
        SELECT e.conv_id, e.d AS depth, u.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens, e.ends_sha256
        FROM e JOIN s USING (d, k) LEFT JOIN e u ON u.d = e.d - 1 AND u.k = e.up
    """,
    "op10_shard_bytes": f"""
        WITH table_ AS ({_CRC}), b AS (
            SELECT doc_id, text IS NULL AS nothing, strlen(COALESCE(text, '')) + 1 AS size, hex(encode(COALESCE(text, ''))) AS h FROM documents
        ), c AS (
            SELECT doc_id, size, CASE WHEN NOT nothing THEN CAST(xor(CAST(4294967295 AS UBIGINT), list_reduce(
                list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(0, size - 1), lambda i: CAST((instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS UBIGINT))),
                lambda c, x: xor(c >> 8, crc[CAST(xor(c & 255, x) AS BIGINT) + 1]))) AS BIGINT) END AS text_crc32
            FROM b, table_
        ), p AS (SELECT *, SUM(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before, SUM(size) OVER () AS whole FROM c),
        s AS (SELECT *, CAST((2 * before + size) * 8 // (2 * whole) AS INTEGER) AS shard FROM p)
        SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
    """,
    "op12_ranked": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), c AS (SELECT COUNT(*) AS N_, CAST(SUM(len(w)) AS BIGINT) AS L_ FROM d WHERE len(w) > 0),
        q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), t AS (SELECT k, doc_id, len(w) AS n, unnest(w) AS term FROM d),
        p AS (SELECT k, doc_id, n, term, COUNT(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * N_ + 2 AS DOUBLE) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM p, c GROUP BY term, N_),
        s AS (
            SELECT item_id, k, doc_id, CAST(SUM(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_) // L_)))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN f USING (term), c GROUP BY item_id, k, doc_id
        ), r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
    """,
    "op2_embeddings": f"""
        WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
        v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v),
        links AS (
            SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q ON p.vec_id < q.vec_id AND p.size > 0 AND q.size > 0
            WHERE list_sum(list_transform(list_zip(p.e, q.e), lambda t: t[1] * t[2])) / (p.size * q.size) >= 0.95
        )
        {_REACH}
        SELECT id AS vec_id, (SELECT COUNT(*) FROM links WHERE a = id OR b = id) AS n_links, component_id, id = component_id AS kept
        FROM component
    """,
    "op5_suffixes": """
        WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, p, hash(substr(h, CAST(2 * p + 1 AS BIGINT), 100)) AS s FROM d, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS t(p)),
        f AS (SELECT s, MIN(doc_id) AS first FROM w GROUP BY s),
        g AS (SELECT w.doc_id, w.p FROM w JOIN f USING (s) WHERE f.first < w.doc_id),
        k AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM g),
        r AS (SELECT doc_id, p, SUM(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM k),
        spans AS (SELECT doc_id, run, MIN(p) AS lo, MAX(p) + 50 AS hi FROM r GROUP BY doc_id, run),
        e AS (SELECT doc_id, lo, hi, COALESCE(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS after FROM spans),
        kept AS (
            SELECT d.doc_id, SUM(hi - lo) AS n_removed, COUNT(*) AS n_spans,
                   string_agg(substr(h, CAST(2 * after + 1 AS BIGINT), CAST(2 * (lo - after) AS BIGINT)), '' ORDER BY lo) || substr(any_value(h), CAST(2 * MAX(hi) + 1 AS BIGINT)) AS rest
            FROM d JOIN e USING (doc_id) GROUP BY d.doc_id
        )
        SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
               sha256(unhex(COALESCE(rest, h))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op8_lines": r"""
        WITH l AS (
            SELECT doc_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS line_no, unnest(x) AS line
            FROM (SELECT doc_id, string_split(lower(COALESCE(text, '')), chr(10)) AS x FROM documents)
        ), s AS (
            SELECT row_number() OVER (ORDER BY doc_id, line_no) AS k, doc_id, line_no,
                   list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words FROM l
        ), c AS (SELECT words, MIN(k) AS k, len(words) AS n FROM s WHERE len(words) > 0 GROUP BY words),
        t AS (SELECT k, n, unnest(words) AS w FROM c),
        df AS (SELECT w, COUNT(*) AS f FROM t GROUP BY w),
        o AS (SELECT k, n, w, row_number() OVER (PARTITION BY k ORDER BY f, w) AS pos FROM t JOIN df USING (w)),
        p AS (SELECT k, n, w FROM o WHERE pos <= n - (n * 80 + 99) // 100 + 1),
        pairs AS (
            SELECT DISTINCT x.k AS a, y.k AS b FROM p x JOIN p y ON x.w = y.w AND x.k < y.k
            AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        ), similar_ AS (
            SELECT DISTINCT b AS k FROM pairs JOIN c x ON x.k = a JOIN c y ON y.k = b
            WHERE 180 * len(list_intersect(x.words, y.words)) >= 80 * (x.n + y.n)
        ), stay AS (SELECT k FROM c WHERE k NOT IN (SELECT k FROM similar_)),
        gone AS (SELECT doc_id, line_no FROM s WHERE len(words) > 0 AND k NOT IN (SELECT k FROM stay))
        SELECT doc_id, COUNT(*) AS n_lines, COUNT(g.line_no) AS n_removed, COALESCE(string_agg(CAST(g.line_no AS VARCHAR), ',' ORDER BY g.line_no), '') AS removed_lines
        FROM l LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id
    """,
    "op9_minhash": f"""
        WITH RECURSIVE ids AS (SELECT doc_id AS id FROM documents),
        w AS (
            SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[CAST(k AS BIGINT):CAST(k + 4 AS BIGINT)], ' ') AS s
            FROM w, unnest(range(1, greatest(2, len(w) - 3))) AS t(k) WHERE len(w) > 0
        ), n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c))
        {_REACH}
        SELECT id AS doc_id, COALESCE(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM component LEFT JOIN n ON n.doc_id = id
    """,
}
