"""DuckDB statements that give the same rows as the registered queries."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"[^\x20\x09-\x0D]+"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE
 words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPLIT}') AS w
           FROM documents),
 sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
 sized AS (SELECT doc_id, s, n FROM sh JOIN n USING (doc_id)),
 links AS (SELECT a.doc_id AS x, b.doc_id AS y
           FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id
                AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
           GROUP BY a.doc_id, b.doc_id, a.n, b.n
           HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
 both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
 reach AS (SELECT x AS doc_id, y AS other FROM both_ways
           UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON r.other = b.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) m USING (doc_id)
"""

MIXING = rf"""
WITH rows AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPLIT}')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS o
  FROM documents),
 sized AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY k),
 weighed AS (SELECT *, 3 * source_size AS most, row_number() OVER (ORDER BY encode(k)) AS place,
                    1 + (row_number() OVER (ORDER BY encode(k)) - 1) % 3 AS w FROM sized),
 level AS (SELECT *, sum(source_size) OVER () - sum(most) OVER up + most AS rest,
                  sum(w) OVER () - sum(w) OVER up + w AS rest_w, row_number() OVER up AS turn
           FROM weighed WINDOW up AS (ORDER BY most / w, place ROWS UNBOUNDED PRECEDING)),
 first_free AS (SELECT rest, rest_w FROM level WHERE w * rest <= most * rest_w ORDER BY turn LIMIT 1),
 target AS (SELECT k, source_size,
                   least(CAST(most AS DOUBLE), coalesce(w * CAST((SELECT rest FROM first_free) AS DOUBLE)
                         / CAST((SELECT rest_w FROM first_free) AS DOUBLE), CAST(most AS DOUBLE))) AS target
            FROM level),
 laid AS (SELECT r.*, source_size, target, CAST(least(floor(target), 3 * source_size) AS BIGINT) AS words,
                 CAST(sum(size) OVER (PARTITION BY k ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size
                   AS start
          FROM rows r JOIN target USING (k)),
 quota AS (SELECT k, met, blocks, words // source_size * blocks + (met + 63) // 64 AS quota
           FROM (SELECT DISTINCT k, words, source_size, words % source_size AS met, (source_size + 63) // 64 AS blocks
                 FROM laid WHERE source_size > 0)),
 shares AS (SELECT k, quota, CAST(floor((sum(quota) OVER u - quota) / (sum(quota) OVER ()) * 2147483648) AS BIGINT) AS low,
                   CAST(floor(sum(quota) OVER u / (sum(quota) OVER ()) * 2147483648) AS BIGINT) AS high,
                   CAST(sum(quota) OVER () AS BIGINT) AS total
            FROM quota WINDOW u AS (ORDER BY encode(k) ROWS UNBOUNDED PRECEDING)),
 points AS (SELECT i AS slot, i % 2147483648 * 1327217885 % 2147483648 AS point
            FROM (SELECT unnest(range((SELECT any_value(total) FROM shares))) AS i)),
 turns AS (SELECT k, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS rank
           FROM points JOIN shares ON point >= low AND point < high),
 reached AS (SELECT k, count(*) AS n FROM turns GROUP BY k)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 AND (words >= source_size OR start < words % source_size) THEN coalesce(
         (SELECT t.slot FROM turns t WHERE t.k = laid.k AND t.rank = start // 64),
         (SELECT any_value(total) FROM shares) + start // 64) END AS slot,
       CASE WHEN size = 0 THEN 0 ELSE
         size * (words // source_size)
         + greatest(0, least(size, words % source_size - start)) END AS taken
FROM laid
"""


def _merkle(records: str, name: str, levels: int = 6, fan: int = 16) -> str:
    """CTEs {name}0 .. {name}N of a tree over ``records``; the last is the root."""
    out = [f"{name}0 AS (SELECT ordinal, start, start + length AS stop, hash FROM {records})"]
    for k in range(1, levels + 1):
        below = f"{name}{k - 1}"
        out.append(f"""{name}{k} AS (
  SELECT ordinal // {fan} AS ordinal, min(start) AS start, max(stop) AS stop,
         sha256(CAST(min(start) AS VARCHAR) || '|' || CAST(max(stop) AS VARCHAR) || '|'
                || string_agg(hash, '' ORDER BY ordinal)) AS hash
  FROM {below} WHERE (SELECT count(*) FROM {below}) > 1 GROUP BY ordinal // {fan}
  UNION ALL SELECT ordinal, start, stop, hash FROM {below} WHERE (SELECT count(*) FROM {below}) <= 1)""")
    return ",\n".join(out)


def _records(body: str) -> str:
    return f"""
  SELECT page_id, row_number() OVER o - 1 AS ordinal, length, hash,
         CAST(sum(length) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) - length AS start
  FROM (SELECT page_id, sha256(r) AS hash, strlen(r) AS length FROM (
    SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
           || chr(13) || chr(10) || 'Content-Length: ' || strlen(body) || repeat(chr(13) || chr(10), 2)
           || body || repeat(chr(13) || chr(10), 2) AS r
    FROM (SELECT page_id, url, coalesce({body}, '') AS body FROM pages)))
  WINDOW o AS (ORDER BY page_id NULLS FIRST, hash)"""


_DAMAGED = """CASE WHEN md5(CAST(page_id AS VARCHAR)) < '03' AND length(html) > 0
  THEN CASE WHEN substr(html, 1, 1) = '#' THEN '*' ELSE '#' END || substr(html, 2) ELSE html END"""

FIXITY = f"""
WITH ours AS ({_records('html')}),
 theirs AS ({_records(_DAMAGED)}),
 {_merkle('ours', 'a')},
 {_merkle('theirs', 'b')}
SELECT o.page_id, o.ordinal, o.start, o.length, o.hash, o.hash <> t.hash AS corrupt,
       (SELECT hash FROM a6) AS root, (SELECT hash FROM b6) AS replica_root
FROM ours o JOIN theirs t USING (ordinal)
"""


FILTER_AUDIT = rf"""
WITH facts AS (
  SELECT coalesce(d.source, '') AS part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         regexp_extract_all(coalesce(text, ''), '{_SPLIT}') AS w, coalesce(text, '') AS t,
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY coalesce(text, '')), FALSE) AS e
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CAST(coalesce(quality = 1, FALSE) AS INT)) AS good,
           max(CAST(coalesce(toxic = 1, FALSE) AS INT)) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
 fails AS (
  SELECT part, good, toxic,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN e THEN 'E' ELSE '' END AS f
  FROM facts),
 n AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
 letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
 orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
 turns AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS x, substr(filter_order, 1, s - 1) AS before
           FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
 hits AS (SELECT n.*, t.*, contains(f, x) AS own, translate(f, before, '') <> f AS earlier FROM n, turns t),
 done AS (
  SELECT part, filter_order, step, x,
         CAST(sum(CASE WHEN own OR earlier THEN 0 ELSE n END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN own AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN own AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN f = x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN own AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN own AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM hits GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM done
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Assignments and means by plain comparison with every entry."""
    out = [f"""
 kept AS (SELECT vec_id, label, [CAST(floor(4096.0 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v,
                 row_number() OVER (ORDER BY vec_id) AS row
          FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
 cells AS (SELECT row, vec_id, label, p, i, v[p * (len(v) // {parts}) + i] AS x
           FROM (SELECT *, unnest(range(1, len(v) // {parts} + 1)) AS i FROM
                 (SELECT *, unnest(range({parts})) AS p FROM kept))),
 book0 AS (SELECT p, row - 1 AS e, i, x FROM cells WHERE row <= {entries})"""]
    for k in range(rounds + 1):
        out.append(f"""
 near{k} AS (SELECT row, p, min(struct_pack(d := d, e := e)) AS best FROM (
   SELECT c.row, c.p, b.e, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS d
   FROM cells c JOIN book{k} b USING (p, i) GROUP BY c.row, c.p, b.e) GROUP BY row, p)""")
        if k < rounds:
            out.append(f"""
 book{k + 1} AS (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
   SELECT c.p, n.best.e AS e, c.i, CAST(sum(c.x) AS BIGINT) // count(*)
          - CASE WHEN CAST(sum(c.x) AS BIGINT) % count(*) < 0 THEN 1 ELSE 0 END AS x
   FROM cells c JOIN near{k} n ON c.row = n.row AND c.p = n.p GROUP BY c.p, n.best.e, c.i) m
   ON b.p = m.p AND b.e = m.e AND b.i = m.i)""")
    last = f"near{rounds}"
    return "WITH" + ",".join(out) + f""",
 coded AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', CAST(n.best.e AS INT)), '' ORDER BY n.p) AS code,
                  CAST(sum(n.best.d) AS BIGINT) AS error
           FROM kept k JOIN {last} n ON k.row = n.row GROUP BY k.row, k.vec_id, k.label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


VECTOR_CODES = _vector_codes()
