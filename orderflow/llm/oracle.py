"""DuckDB SQL of the training-data queries."""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(encode(coalesce(html, ''))) AS hex
  FROM pages),
best AS (SELECT hex, max(page_id) AS original FROM p GROUP BY hex),
sym AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1), '' ORDER BY i) AS digest
  FROM best, range(0, 32) AS r(i) GROUP BY hex)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, sym.digest AS payload_digest,
       CASE WHEN p.page_id = best.original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = best.original THEN NULL ELSE best.original END AS refers_to
FROM p JOIN best USING (hex) JOIN sym USING (hex)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM g),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p WHERE 100 * c >= 90 * (na + nb - c)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, min(r)::BIGINT AS component_id
FROM g JOIN reach USING (doc_id) GROUP BY g.doc_id, g.s
"""

SEARCH = r"""
WITH w AS (
  SELECT doc_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS term
  FROM documents),
len AS (SELECT doc_id, count(*) AS dl FROM w GROUP BY 1),
tot AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, sum(dl)::DOUBLE / (SELECT count(*) FROM documents) AS mean FROM len),
tf AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM w GROUP BY 1, 2),
idf AS (SELECT term, round(ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) * 4096)::BIGINT AS idf FROM tf, tot GROUP BY term, n),
post AS (
  SELECT doc_id, term, round(4096 * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / mean)))::BIGINT AS weight
  FROM tf JOIN len USING (doc_id), tot),
hits AS (
  SELECT q.doc_id AS query_id, post.doc_id, sum(idf.idf * post.weight) AS units
  FROM (SELECT DISTINCT doc_id, term FROM tf WHERE doc_id % 20 = 0) q JOIN idf USING (term) JOIN post USING (term)
  GROUP BY 1, 2 HAVING sum(idf.idf * post.weight) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY units DESC, doc_id) AS rank FROM hits)
SELECT query_id, rank::INT AS rank, doc_id, units::DOUBLE / 16777216 AS score FROM ranked WHERE rank <= 10
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Integer product quantization, one pair of steps (nearest entry, means) for each round."""
    dist = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))"
    ctes = [f"""
k AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER () AS rid FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (
  SELECT rid, vec_id, p::BIGINT AS p, list_transform(embedding[1 + p * (len(embedding) // {parts}) : (p + 1) * (len(embedding) // {parts})],
           lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS v
  FROM k, range({parts}) AS r(p)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM x
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    near = "SELECT x.rid, x.p, any_value(x.v) AS v, min({d} * {n} + b.e) AS best FROM x JOIN b{r} b USING (p) GROUP BY x.rid, x.p"
    for r in range(rounds):
        ctes.append(f"a{r} AS MATERIALIZED ({near.format(d=dist, n=entries, r=r)})")
        ctes.append(f"""
s{r} AS (SELECT p, best % {entries} AS e, i, sum(v[i])::BIGINT AS s, count(*) AS n
       FROM a{r}, range(1, (SELECT max(len(v)) FROM x) + 1) AS t(i) GROUP BY 1, 2, 3)""")
        ctes.append(f"m{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY 1, 2)")
        ctes.append(f"b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (p, e))")
    ctes.append(f"f AS MATERIALIZED ({near.format(d=dist, n=entries, r=rounds)})")
    ctes.append(f"""
g AS (SELECT rid, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM f GROUP BY rid)""")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})")
    return "WITH " + ",\n".join(ctes) + """
SELECT k.vec_id, g.code, g.error, sum(g.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, h.h AS codebooks_sha256
FROM k JOIN g USING (rid), h
"""


VECTOR_CODES = _vector_codes()

def _merkle() -> str:
    field = "coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))
    byte = "CASE WHEN t % 8 = 0 THEN xor(c, ord(substr(doc_id::VARCHAR, (t // 8 + 1)::BIGINT, 1))::BIGINT) ELSE c END"
    level = """
  SELECT {key}level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM {t} WHERE n > 1 GROUP BY {key}level, idx // 3"""
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source,
    sha256({head} || {field.format(c='text')}) AS leaf,
    CASE WHEN list_reduce(range(0, 8 * length(doc_id::VARCHAR)),
                lambda c, t: CASE WHEN ({byte}) % 2 = 1 THEN xor(({byte}) >> 1, 3988292384::BIGINT) ELSE ({byte}) >> 1 END,
                4294967295::BIGINT) % 2 = 1
         THEN sha256({head} || {field.format(c="replace(text, chr(10), '')")}) END AS other
  FROM documents),
p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM d),
lv AS (
  SELECT source, 0 AS level, pos AS idx, n, leaf AS h FROM p
  UNION ALL{level.format(key='source, ', t='lv')}),
sub AS MATERIALIZED (
  SELECT source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
tp AS (
  SELECT 0 AS level, pos AS idx, n, h FROM sub
  UNION ALL{level.format(key='', t='tp')}),
runs AS MATERIALIZED (
  SELECT false AS top, source, level, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM lv WHERE n > 1 GROUP BY source, level, idx // 3
  UNION ALL
  SELECT true, NULL, level, idx // 3, list(h ORDER BY idx) FROM tp WHERE n > 1 GROUP BY level, idx // 3),
climb AS (
  SELECT p.rid, false AS top, p.source, 0 AS level, p.pos AS idx, p.n, coalesce(p.other, p.leaf) AS cur, '' AS proof FROM p
  UNION ALL (
  SELECT c.rid, c.top, c.source, c.level + 1, c.idx // 3, (c.n + 2) // 3,
         sha256(array_to_string(list_transform(r.hs, lambda h, i: CASE WHEN i = c.idx % 3 + 1 THEN c.cur ELSE h END), '')),
         c.proof || array_to_string(list_filter(r.hs, lambda h, i: i <> c.idx % 3 + 1), '')
  FROM climb c JOIN runs r ON r.top = c.top AND r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.idx // 3
  WHERE c.n > 1
  UNION ALL
  SELECT c.rid, true, NULL, 0, s.pos, s.n, c.cur, c.proof
  FROM climb c JOIN sub s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1 AND NOT c.top))
SELECT d.doc_id, d.leaf, sub.h AS subroot, tp.h AS root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root, c.cur = tp.h AS verified
FROM d JOIN climb c ON c.rid = d.rid AND c.top AND c.n = 1
JOIN sub ON sub.source IS NOT DISTINCT FROM d.source JOIN tp ON tp.n = 1
"""


MERKLE = _merkle()
