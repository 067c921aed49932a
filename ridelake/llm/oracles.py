"""DuckDB SQL for the corpus queries that SQL can express, over the driver's tables."""

from __future__ import annotations

# The round trip changes nothing, so digests come from the source; only the length tells whether a conversation is escaped.
CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
, checked AS (SELECT *, bool_or(regexp_matches(role, '<\\*n?\||\n') OR regexp_matches(text, '<\\*\||<\\+n\|'))
    OVER (PARTITION BY conv_id) AS esc FROM said)
, shown AS (SELECT *,
    CASE WHEN esc THEN replace(regexp_replace(role, '<(\\*)(n?)\|', '<\\\1\2|', 'g'), chr(10), '<n|') ELSE role END AS r,
    CASE WHEN esc THEN regexp_replace(text, '<(\\*)(n?)\|', '<\\\1\2|', 'g') ELSE text END AS t FROM checked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || r || chr(10) || t || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""

ARCHIVE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages)
, bits AS (SELECT page_id, body, array_to_string(list_transform(string_split(sha1(encode(body)), ''),
    lambda c: list_extract(['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'],
                           instr('0123456789abcdef', c))), '') AS b FROM p)
, named AS (SELECT page_id, strlen(body) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(substr(b, i * 5 + 1, 1) AS INT) + 8 * CAST(substr(b, i * 5 + 2, 1) AS INT)
      + 4 * CAST(substr(b, i * 5 + 3, 1) AS INT) + 2 * CAST(substr(b, i * 5 + 4, 1) AS INT) + CAST(substr(b, i * 5 + 5, 1) AS INT) AS INT), 1)),
    '') AS payload_digest FROM bits)
, firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM named)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
CONTAMINATION = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark)
, windows AS (SELECT item, least(len(w), 13) AS k,
    unnest(list_transform(range(1, CAST(greatest(len(w) - 12, 1) + 1 AS BIGINT)), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM items WHERE len(w) > 0)
, sizes AS (SELECT DISTINCT k FROM windows)
, doc AS (SELECT doc_id, {_WORDS} AS w FROM documents)
, places AS (SELECT doc_id, k, unnest(range(1, CAST(greatest(len(w) - k + 1, 0) + 1 AS BIGINT))) AS i, w FROM doc, sizes)
, found AS (SELECT p.doc_id, p.i, p.k, x.item FROM places p
  JOIN (SELECT DISTINCT k, s, item FROM windows) x ON x.k = p.k AND x.s = array_to_string(p.w[p.i:p.i + p.k - 1], ' '))
, hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY 1)
, named AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

# bytes as hexadecimal text: two characters each
REPEATS = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents)
, starts AS (SELECT doc_id, unnest(range(0, CAST(greatest(length(h) // 2 - 49, 0) AS BIGINT))) AS i, h FROM d)
, windows AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS a, md5_number(substr(h, 2 * i + 1, 100)) AS b FROM starts)
, repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY a, b) AS first FROM windows) WHERE first < doc_id)
, marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 50, TRUE) AS new FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i))
, grouped AS (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked)
, spans AS (SELECT doc_id, g, min(i) AS s, max(i) + 50 AS e FROM grouped GROUP BY ALL)
, gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans)
, parts AS (SELECT gaps.doc_id, s, e, substr(h, 2 * before + 1, 2 * (s - before)) AS part FROM gaps JOIN d USING (doc_id))
, cut AS (SELECT doc_id, sum(e - s) AS n, count(*) AS k, max(e) AS last, string_agg(part, '' ORDER BY s) AS kept FROM parts GROUP BY ALL)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN k IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"


def _hashed(text: str) -> str:
    return "sha256(" + " || ".join(f"({_field(x)})" for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda x: CAST(ord(x) AS UBIGINT))), lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS UBIGINT) for z in range(8)]),
    lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))), CAST(4294967295 AS UBIGINT))"""


def _merkle(levels: int = 6, fanout: int = 16) -> str:
    """One CTE per level, ``levels`` within a source and as many above: enough for ``fanout ** levels`` nodes each."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"""leaves AS (SELECT row_number() OVER () AS r, doc_id, source, leaf, CASE WHEN {_CRC32} % 5 = 0 THEN tampered ELSE leaf END AS shown
  FROM (SELECT *, {_hashed('text')} AS leaf, {_hashed(lower)} AS tampered FROM documents))""",
            """n0 AS (SELECT source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS p, r, leaf AS h FROM leaves)""",
            """s0 AS (SELECT leaves.r, g, p, shown AS cur, '' AS proof FROM n0 JOIN leaves ON n0.r = leaves.r)"""]
    for k in range(2 * levels):
        if k == levels:  # what is left of each source, ordered by source
            ctes.append(f"subroots AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM n{k})")
            ctes.append(f"n{k}t AS (SELECT CAST(0 AS BIGINT) AS g, i AS p, subroot AS h FROM subroots)")
            ctes.append(f"s{k}t AS (SELECT r, CAST(0 AS BIGINT) AS g, i AS p, cur, proof FROM s{k} JOIN subroots ON g IS NOT DISTINCT FROM source)")
        t = "t" if k == levels else ""
        ctes.append(f"""u{k} AS (SELECT g, p // {fanout} AS q, list(h ORDER BY p) AS hs FROM
  (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM n{k}{t}) WHERE n > 1 GROUP BY ALL)""")
        ctes.append(f"""n{k + 1} AS (SELECT g, q AS p, sha256(array_to_string(hs, '')) AS h FROM u{k} UNION ALL
  SELECT g, p, h FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM n{k}{t}) WHERE n = 1)""")
        ctes.append(f"""s{k + 1} AS (SELECT r, s.g, CASE WHEN hs IS NULL THEN p ELSE q END AS p,
  CASE WHEN hs IS NULL THEN cur ELSE sha256(array_to_string(hs[1:p % {fanout}], '') || cur || array_to_string(hs[p % {fanout} + 2:], '')) END AS cur,
  proof || CASE WHEN hs IS NULL THEN '' ELSE array_to_string(hs[1:p % {fanout}], '') || array_to_string(hs[p % {fanout} + 2:], '') END AS proof
  FROM s{k}{t} s LEFT JOIN u{k} u ON s.g IS NOT DISTINCT FROM u.g AND s.p // {fanout} = u.q)""")
    return ("WITH " + "\n, ".join(ctes) + f"""
SELECT doc_id, leaf, subroot, n.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = n.h AS verified
FROM leaves JOIN s{2 * levels} s ON leaves.r = s.r JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source, n{2 * levels} n""")


MERKLE = _merkle()

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
, scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x))
, ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5"""
