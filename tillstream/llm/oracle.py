"""DuckDB statements for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Every later place of a long line and of a run of three lines goes; so do runs of two lines whose gram is a fingerprint, that is
# no larger than the gram after or before it (window of two), as far as they match their gram's first place.
ORACLE["op5_line_dedup"] = """
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(lines) AS line, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS pos FROM cut),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h FROM lines),
around AS (
  SELECT *, lead(h) OVER w AS h2, lag(h) OVER w AS before, lead(h, 2) OVER w AS after
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
grams AS (
  SELECT *, CAST('0x' || substr(md5(concat(h, ':', h2)), 1, 15) AS BIGINT) AS gram FROM around WHERE h2 IS NOT NULL),
nearby AS (
  SELECT *, lead(gram) OVER w AS next_gram, lag(gram) OVER w AS prev_gram
  FROM grams WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
marks AS (
  SELECT * FROM nearby
  WHERE (next_gram IS NULL AND prev_gram IS NULL) OR gram <= next_gram OR gram <= prev_gram),
placed AS (SELECT *, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS place FROM marks),
runs AS (
  SELECT m.doc_id,
         m.pos - CASE WHEN m.before = f.before THEN 1 ELSE 0 END AS start,
         m.pos + 2 + CASE WHEN m.after = f.after THEN 1 ELSE 0 END AS stop
  FROM placed m JOIN placed f ON m.gram = f.gram AND f.place = 1
  WHERE m.place > 1 AND m.h = f.h AND m.h2 = f.h2),
long_lines AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS place FROM lines
  WHERE length(line) > 60 OR len(string_split_regex(trim(line), '[ \\t\\n\\x0B\\f\\r]+')) > 5),
threes AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY h, h2, after ORDER BY doc_id, pos) AS place FROM around
  WHERE after IS NOT NULL),
found AS (
  SELECT doc_id, start, stop FROM runs
  UNION ALL SELECT doc_id, pos, pos + 1 FROM long_lines WHERE place > 1
  UNION ALL SELECT doc_id, pos, pos + 3 FROM threes WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, stop)) AS pos FROM found),
marked AS (SELECT l.*, g.pos IS NOT NULL AS gone FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos),
joined AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, j.text, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""

# Weights are square roots of the sources' counts; 52 bits of MD5 are the uniform numbers.
ORACLE["op9_mixing"] = """
WITH RECURSIVE sources AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), 0.5) AS w FROM documents GROUP BY source),
whole AS (SELECT sum(n) AS n_all, sum(w) AS w_all FROM sources),
rates AS (SELECT source, w * (n_all / w_all) / n AS rate FROM sources, whole),
cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < 150),
tables AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
drawn AS (
  SELECT d.doc_id, d.source, d.text, cs,
         concat(coalesce(CAST(d.doc_id AS VARCHAR), '~'), '|', coalesce(md5(d.text), '~')) AS tag
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, (CAST(CAST('0x' || substr(md5(concat('17|', tag)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u FROM drawn),
copies AS (
  SELECT *, unnest(range(len(list_filter(cs, lambda c: c < u)))) AS copy FROM counted)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy,
       (CAST(CAST('0x' || substr(md5(concat('18|', tag, '|', copy)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS order_key
FROM copies
"""

# Vectors with a null or non-finite component, zero vectors and null labels link with nothing.
ORACLE["op3_embedding_near_dedup"] = """
WITH RECURSIVE wide AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
fit AS (
  SELECT * FROM wide
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)
    AND list_dot_product(v, v) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
smallest AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT w.vec_id, coalesce(n, 0) AS n_links, least(w.vec_id, coalesce(s.y, w.vec_id)) AS component_id,
       w.vec_id <= coalesce(s.y, w.vec_id) AS kept
FROM wide w LEFT JOIN smallest s ON w.vec_id = s.x LEFT JOIN counted c ON w.vec_id = c.x
"""

ORACLE["op7_exact_top_k"] = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
