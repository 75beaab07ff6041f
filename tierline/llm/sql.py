"""DuckDB SQL for the queries that SQL can express."""

LINE_DEDUP = r"""
WITH RECURSIVE docs AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
lines AS (
  SELECT r, doc_id, u.line, u.i FROM docs, LATERAL (
    SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i) u
  WHERE text IS NOT NULL),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
raws AS (
  SELECT *, coalesce(((lag(h) OVER w % 2147483647) * 1000003579 + h) % 2147483647 < 2147483647 // 3, false) AS raw, lead(i) OVER w IS NULL AS last,
         coalesce(h = lag(h, 2) OVER w, false) AS again
  FROM hashed WINDOW w AS (PARTITION BY r ORDER BY i)),
stretches AS (SELECT *, i - row_number() OVER (PARTITION BY r, again ORDER BY i) AS stretch FROM raws),
pairs AS (SELECT *, row_number() OVER (PARTITION BY r, again, stretch ORDER BY i) AS at FROM stretches),
cuts AS (
  SELECT *, last OR (again AND at % 2 = 0) OR (NOT again AND lead(again) OVER w)
            OR (NOT again AND i > 1 AND raw AND NOT coalesce(lag(raw) OVER w, false)) AS cut
  FROM pairs WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS no
  FROM cuts),
chunks AS (
  SELECT r, doc_id, no, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n_lines,
         count(*) FILTER (WHERE regexp_matches(line, '[^ \t\r\f\v]')) AS full_lines
  FROM numbered GROUP BY r, doc_id, no),
ranked AS (
  SELECT *, full_lines >= 2 AND row_number() OVER (PARTITION BY body, full_lines >= 2 ORDER BY doc_id, no) > 1 AS gone
  FROM chunks),
kept AS (
  SELECT r, count(*) AS n_chunks, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(sum(n_lines) FILTER (WHERE gone), 0) AS removed_lines,
         coalesce(string_agg(body, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS body
  FROM ranked GROUP BY r)
SELECT d.doc_id, coalesce(n_chunks, 0)::INT AS n_chunks, coalesce(n_removed, 0)::INT AS n_removed,
       coalesce(removed_lines, 0)::INT AS removed_lines, sha256(coalesce(body, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (r)
"""

def url_filter(levels: int = 8) -> str:
    """The template tree level by level; paths that many pages share are fewer
    than ``levels`` segments deep."""
    steps = []
    for d in range(1, levels + 1):
        steps.append(f"""c{d} AS (SELECT *, row_number() OVER (PARTITION BY host, tpl, g) AS rn, count(*) OVER (PARTITION BY host, tpl, g) AS n
  FROM (SELECT *, CASE WHEN done OR len(s) < {d} THEN NULL ELSE s[{d}] END AS g FROM t{d - 1}))""")
        steps.append(f"""t{d} AS (SELECT page_id, host, path, rule, label, s,
    CASE WHEN g IS NULL THEN tpl WHEN node < 5 THEN tpl || ['**'] WHEN n < 5 AND kinds >= 5 AND 2 * kinds >= pages THEN tpl || ['*']
         ELSE tpl || [g] END AS tpl, done OR (g IS NOT NULL AND node < 5) AS done
  FROM (SELECT *, count(*) OVER w AS node, count(*) FILTER (WHERE n < 5 AND rn = 1) OVER w AS kinds, count(*) FILTER (WHERE n < 5) OVER w AS pages
        FROM c{d} WINDOW w AS (PARTITION BY host, tpl, g IS NULL)))""")
    tree = ",\n".join(steps)
    return r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT page_id, coalesce(rest, '') AS rest FROM parsed)),
rules(r_host, r_path, label) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (
  SELECT s.page_id, s.host, s.path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
         arg_max(label, length(r_host || r_path)) AS label
  FROM (SELECT *, row_number() OVER () AS rid FROM split) s
  LEFT JOIN rules ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY s.rid, s.page_id, s.host, s.path),
t0 AS (
  SELECT *, string_split(regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '#', 'g'), '/') AS s, []::VARCHAR[] AS tpl, false AS done
  FROM ruled),
""" + tree + rf""",
prior AS (SELECT CASE WHEN count(label) > 0 THEN count(*) FILTER (WHERE label = 'block') / count(label) ELSE 0 END AS p FROM ruled),
lab AS (SELECT host, tpl, count(label) AS n_lab, count(*) FILTER (WHERE label = 'block') AS n_block FROM t{levels} GROUP BY ALL),
kinds AS (
  SELECT *, coalesce(list_position(list_transform(tpl, lambda x: x <> '*' AND x <> '**' AND NOT contains(x, '#')), true), 0) AS lit_pos,
         (n_block - n_lab * p) * (n_block - n_lab * p) >= 1.96 * 1.96 * p * (1 - p) * n_lab AS clear, n_block - n_lab * p AS off
  FROM lab, prior),
around AS (
  SELECT *, list_transform(tpl, lambda x, i: CASE WHEN i = lit_pos THEN '|' ELSE x END) AS ctx,
         CASE WHEN n_lab = 0 THEN 'unlabelled' WHEN clear AND off > 0 THEN 'more' WHEN clear AND off < 0 THEN 'less' ELSE 'neither' END AS kind
  FROM kinds),
merged AS (SELECT host, tpl, min(array_to_string(tpl, '/')) OVER w AS template, sum(n_lab) OVER w AS m_lab, sum(n_block) OVER w AS m_block
  FROM around WINDOW w AS (PARTITION BY host, ctx, kind))
SELECT t.page_id, t.host, t.path, t.rule, m.template,
       coalesce(t.label, CASE WHEN m.m_lab >= 5 AND (m.m_block + 5 * prior.p) / (m.m_lab + 5) > 0.6 THEN 'block' ELSE 'allow' END) AS verdict
FROM t{levels} t JOIN merged m USING (host, tpl), prior
"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, strlen(h) AS n, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int, dims: int) -> str:
    """The rounds of the codebooks, one pair of tables each."""
    w = dims // parts

    def nearest(books: str) -> str:
        # distance and entry as one number: the least distance, then the least entry
        return f"""SELECT r, p, min(d * {entries} + e) AS k FROM (
            SELECT r, c.p, b.e, sum((c.v - b.v) * (c.v - b.v))::HUGEINT AS d FROM comp c JOIN {books} b USING (j) GROUP BY r, c.p, b.e)
          GROUP BY r, p"""

    steps = [f"b0 AS MATERIALIZED (SELECT j, p, rank - 1 AS e, v FROM comp WHERE rank <= {entries})"]
    for i in range(rounds):
        steps.append(f"n{i} AS MATERIALIZED ({nearest(f'b{i}')})")
        steps.append(f"""b{i + 1} AS MATERIALIZED (
          SELECT b.j, b.p, b.e, CASE WHEN s.n IS NULL THEN b.v ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS v
          FROM b{i} b LEFT JOIN (
            SELECT c.j, n.k % {entries} AS e, sum(c.v)::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM comp c JOIN n{i} n ON c.r = n.r AND c.p = n.p GROUP BY c.j, n.k % {entries}) s ON s.j = b.j AND s.e = b.e)""")
    books = f"b{rounds}"
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
comp AS MATERIALIZED (
  SELECT r, r AS rank, g.j, g.j // {w} AS p, floor({scale} * embedding[g.j + 1]::DOUBLE)::HUGEINT AS v
  FROM kept, (SELECT unnest(range({dims})) AS j) g),
{", ".join(steps)},
final AS MATERIALIZED ({nearest(books)}),
coded AS (
  SELECT r, string_agg(printf('%02x', (k % {entries})::INT), '' ORDER BY p) AS code, sum(k // {entries})::BIGINT AS error FROM final GROUP BY r),
hashed AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM {books})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), hashed
"""
