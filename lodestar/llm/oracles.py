"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sharding(limit: int) -> str:
    return f"""
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0))), 1, 15) AS BIGINT) AS h FROM documents),
cell AS (SELECT r.*, CAST(d AS INTEGER) AS depth, h >> (60 - d) AS prefix FROM r, range(0, 61) t(d)),
bucket AS (SELECT depth, prefix, count(*) AS shard_rows, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes FROM cell GROUP BY ALL),
placed AS (SELECT cell.doc_id, n_bytes, depth, prefix, shard_rows, shard_bytes,
                  row_number() OVER (PARTITION BY h, cell.doc_id, n_bytes ORDER BY depth) AS k,
                  count(*) FILTER (depth = 60) OVER (PARTITION BY h, cell.doc_id, n_bytes) AS copies
           FROM cell JOIN bucket USING (depth, prefix) WHERE shard_bytes <= {limit} OR depth = 60)
SELECT doc_id, n_bytes, depth, prefix, right(lpad(bin(prefix), 60, '0'), depth) AS shard, shard_rows, shard_bytes,
       shard_bytes <= {limit} AS fits FROM placed WHERE k <= copies"""


NEARDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s FROM w, unnest(range(1, len(ws) - 3)) t(i)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents
          UNION SELECT e.b, reach.root FROM reach JOIN both_ways e ON e.a = reach.node)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id"""


SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
wd AS (SELECT doc_id, i AS p, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) t(i)),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS s FROM w, unnest(range(1, len(ws) - 11)) t(i)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN least USING (s), range(0, 13) t(k) WHERE m < doc_id),
kept AS (SELECT doc_id, count(*) AS n_words, count(gone.p) AS n_removed,
                string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS body
         FROM wd LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""


def _quotient(total: str, n: str) -> str:
    """floor(total / n) of integers, n > 0."""
    return f"CAST(({total} - ((({total}) % {n}) + {n}) % {n}) // {n} AS BIGINT)"


def _round(k: int) -> str:
    return f"""near{k} AS MATERIALIZED (
  SELECT q.vec_id, q.p, any_value(q.x) AS x, min(list_sum(list_transform(list_zip(q.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.e) AS best
  FROM part q JOIN book{k} b USING (p) GROUP BY q.vec_id, q.p)"""


def _means(k: int) -> str:
    return f"""mean{k} AS (
  SELECT p, e, list({_quotient("s", "n")} ORDER BY i) AS x
  FROM (SELECT p, best % 64 AS e, i, sum(x[i]) AS s, count(*) AS n FROM near{k}, unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (p, e))"""


#: Product codes of unique vec_ids: 16 parts, 64 entries, two rounds, components times 256.
CODES = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
              WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x FROM kept, range(0, 16) t(p)),
start AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS MATERIALIZED (SELECT p, e, x FROM part JOIN start USING (vec_id)),
{_round(0)},
{_means(0)},
{_round(1)},
{_means(1)},
{_round(2)},
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM near2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, i, x[i] AS c FROM book2, unnest(range(1, len(x) + 1)) t(i)))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


SUFFIXES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
win AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM h, unnest(range(0, n - 49)) t(i)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
later AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS head FROM win JOIN least USING (s) WHERE m < doc_id),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b
         FROM (SELECT doc_id, i, sum(CAST(head AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM later) GROUP BY doc_id, g),
edge AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span),
body AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, max(b) AS stop,
                string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM edge JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(x, 2 * stop + 1), x))) AS kept_sha256 FROM h LEFT JOIN body USING (doc_id)"""
