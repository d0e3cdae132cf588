"""The same results as SQL, for the queries that SQL can express (DuckDB, by plain joins over all rows)."""

WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Smallest node that each node of ``links`` (a, b in both directions) can reach.
REACHED = """reach AS (SELECT a AS node, least(a, b) AS low FROM links UNION
  SELECT l.a, r.low FROM links l JOIN reach r ON l.b = r.node),
named AS (SELECT node, min(low) AS component FROM reach GROUP BY node)"""

SUBSTRINGS = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d) x),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM win JOIN again USING (s), range(35) r(o)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id) k
  USING (doc_id)"""

JACCARD = rf"""WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM d) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
{REACHED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN named ON node = d.doc_id"""

FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

EMBEDDINGS = f"""WITH RECURSIVE
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {FINITE} AND label IS NOT NULL
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.93),
{REACHED}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN named ON node = vec_id LEFT JOIN (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a) l ON a = vec_id"""

TOP_K = f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e FROM embeddings WHERE {FINITE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

# The pages of the given tables hold no redirect and no canonical link: aliases are the urls with one key. Linked pages
# are tested on fixtures.
URLS = rf"""WITH p AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1), '') AS raw,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3), '') AS q FROM pages),
u AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, path,
    regexp_replace(regexp_replace(substr(q, 2), '(?i)(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&+', '') AS query FROM p),
k AS (SELECT page_id, host, path, CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') || '?' || query END AS key FROM u),
r(verdict, h, t) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (SELECT page_id, h || t AS rule, r.verdict FROM k JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || t) DESC, r.verdict) = 1),
blocked AS (SELECT DISTINCT key FROM k JOIN best USING (page_id) WHERE verdict = 'block')
SELECT page_id, host, path, rule, coalesce(best.verdict, CASE WHEN blocked.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM k LEFT JOIN best USING (page_id) LEFT JOIN blocked ON k.key = blocked.key"""

# CRC-32 byte by byte: the table of all bytes, then one step for each byte of a value in turn.
CRC_TABLE = """RECURSIVE step(i, k, c) AS (SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM step WHERE k = 8)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, in a query over crc_table."""
    pairs = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    begin = "list_value(CAST(4294967295 AS BIGINT))"
    step = "xor(c >> 8, crcs[CAST(xor(c, b) & 255 AS BIGINT) + 1])"
    return f"xor(list_reduce(list_concat({begin}, {pairs}), lambda c, b: {step}), 4294967295)"


SHARDS = f"""WITH {CRC_TABLE},
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {crc32("coalesce(text, '')")} AS text_crc32,
  CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS s,
  CAST('0x' || substr(sha256('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents, crc_table),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) - 1 AS r, count(*) OVER (PARTITION BY s) AS n,
  CAST('0x' || substr(sha256('11:' || s), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (CAST(r AS DOUBLE) + u) / CAST(n AS DOUBLE), s, r) - 1 AS p, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(((p + 1) * 24 - 1) // total AS INTEGER) AS shard,
  p - ((((p + 1) * 24 - 1) // total) * total) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""

ASCII_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESAMPLING = rf"""WITH {CRC_TABLE},
f AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ASCII_WORDS}')) AS w FROM documents),
g AS (SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{ASCII_WORDS}')) AS w FROM benchmark),
w AS (SELECT w, {crc32("w")} % 10000 AS b FROM (SELECT w FROM f UNION SELECT w FROM g) x, crc_table),
s AS (SELECT b, count(*) AS s FROM f JOIN w USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM g JOIN w USING (w) GROUP BY b),
n AS (SELECT coalesce((SELECT sum(s) FROM s), 0) + 10000 AS s, coalesce((SELECT sum(t) FROM t), 0) + 10000 AS t),
gain AS (SELECT w, CAST(floor(1000 * ln(CAST((coalesce(t.t, 0) + 1) * n.s AS DOUBLE) / CAST((s.s + 1) * n.t AS DOUBLE))) AS BIGINT) AS gain
  FROM w JOIN s USING (b) LEFT JOIN t USING (b), n),
m AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM f JOIN gain USING (w) GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN m USING (doc_id)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
  QUALIFY rank <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)"""

# A run of period q holds six words again q words on, at consecutive places; stretches of one length are the same run
# with its smallest period.
RUNS = rf"""WITH {CRC_TABLE},
h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS o, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM h),
p AS (SELECT *, 1 + (len(o) - a) // (3 + (h // 10) % 8) AS p FROM a),
d AS (SELECT doc_id, CASE WHEN a IS NULL THEN o ELSE list_transform(range(len(o)), lambda i: o[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM p),
g AS (SELECT doc_id, i, hash(w[i + 1:i + 6]) AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM d) x),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
island AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e) x GROUP BY doc_id, q, k),
run AS (SELECT doc_id, start, length, min(q) AS q FROM island WHERE length >= greatest(12, 2 * q) GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM d) x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, q) = 1),
list AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS l FROM run GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_runs, start, length, q AS period, (1000 * length) // q AS exponent_milli,
  sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN list USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""

SQL = {
    "op5_substring_dedup": SUBSTRINGS,
    "op6_ngram_jaccard": JACCARD,
    "op7_embedding_near_dedup": EMBEDDINGS,
    "op9_exact_top_k": TOP_K,
    "op10_url_filter": URLS,
    "op11_interleaved_shards": SHARDS,
    "op12_importance_resampling": RESAMPLING,
    "op13_periodic_runs": RUNS,
}
