"""SQL that must give the rows of those queries that SQL can express."""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\f\r]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, COALESCE((SELECT MIN(other) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""


def url_filter(z: float, limit: float, low: float, high: float, share: float, suffixes: tuple[str, ...]) -> str:
    """The rules as in the library's ``RULES``, and the same shrinkage level by level."""
    host = r"lower_az(COALESCE(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''))".replace("lower_az(", "translate(").replace(
        ", ''))", ", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

    def fits(rule: str) -> str:
        at, _, rest = rule.partition("/")
        return f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{rest}')"

    def level(table: str, parent: str, known: str) -> str:
        m = f"greatest(least({parent}, 0.9999), 0.0001)"
        return f"""(SELECT *, COALESCE((m * prior + bad) / NULLIF(prior + n, 0), m) AS mean, prior + n AS size FROM (
          SELECT t.*, {m} AS m, least(CASE WHEN f.spread IS NULL OR f.spread <= 0 THEN {high} ELSE least({high}, greatest({low}, f.inside / f.spread - 1)) END, {known}) AS prior
          FROM {table} t, (SELECT SUM(n * power(bad / NULLIF(n, 0) - {m}, 2) - {m} * (1 - {m})) / NULLIF(SUM(n), 0) AS spread, SUM(n * {m} * (1 - {m})) / NULLIF(SUM(n), 0) AS inside FROM {table}) f))"""

    def labels(k: int) -> str:
        return f"array_to_string(list_slice(string_split(host, '.'), -{k}, -1), '.')"

    text = r"regexp_replace(html, '<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'gs')"
    return rf"""
WITH p AS (SELECT page_id, html, {host} AS host, COALESCE(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
o AS (SELECT host, CASE WHEN len(regexp_extract_all(t, '\S+')) > 0 THEN CAST(len(regexp_extract_all(t, '(?:[%#*$~^|]{{3,}}|(?:&amp;){{3,}}|&{{3,}})(?:\s|$)')) > {share} * len(regexp_extract_all(t, '\S+')) AS INTEGER) END AS bad
  FROM (SELECT host, {text} AS t FROM p)),
h AS (SELECT host, CAST(COUNT(bad) AS DOUBLE) AS n, CAST(COALESCE(SUM(bad), 0) AS DOUBLE) AS bad,
  CASE WHEN {labels(2)} IN {suffixes} THEN {labels(3)} ELSE {labels(2)} END AS domain,
  CASE WHEN {labels(2)} IN {suffixes} THEN {labels(2)} ELSE {labels(1)} END AS suffix FROM o GROUP BY host),
d AS (SELECT domain, suffix, SUM(n) AS n, SUM(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, SUM(n) AS n, SUM(bad) AS bad FROM d GROUP BY 1),
s1 AS (SELECT s.*, t.rate AS parent, t.total AS known FROM s, (SELECT COALESCE(SUM(bad) / NULLIF(SUM(n), 0), 0) AS rate, SUM(n) AS total FROM s) t),
s2 AS (SELECT * FROM {level("s1", "parent", "known")}),
d1 AS (SELECT d.*, s2.mean AS parent, s2.size AS known FROM d JOIN s2 USING (suffix)),
d2 AS (SELECT * FROM {level("d1", "parent", "known")}),
h1 AS (SELECT h.*, d2.mean AS parent, d2.size AS known FROM h JOIN d2 USING (domain, suffix)),
h2 AS (SELECT host, mean - {z} * sqrt(mean * (1 - mean) / (size + 1)) AS bound FROM {level("h1", "parent", "known")}),
r AS (SELECT page_id, host, path, CASE WHEN {fits("example.com/de/")} THEN 'example.com/de/' WHEN {fits("example.net/en/")} THEN 'example.net/en/'
  WHEN {fits("org/fr/")} THEN 'org/fr/' WHEN {fits("net/")} THEN 'net/' END AS rule FROM p)
SELECT page_id, r.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN bound > {limit} THEN 'block' ELSE 'allow' END AS verdict FROM r LEFT JOIN h2 ON h2.host = r.host
"""
