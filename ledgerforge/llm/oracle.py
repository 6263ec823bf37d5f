"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

_WORDS5 = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5 = rf"""
WITH d AS (SELECT doc_id, {_WORDS5} AS w FROM documents),
b AS (SELECT item_id, {_WORDS5} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hit AS (SELECT DISTINCT doc_id, item_id, size, i FROM dw JOIN bw USING (size, gram)),
words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + size)) AS t(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS gram
  FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS place FROM win)
  WHERE place > 1),
gone AS (
  SELECT doc_id, j FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n_kept
  FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, i, size, array_to_string(lines[i : i + size - 1], chr(10)) AS content
  FROM d, (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(lines) - size + 2)) AS t(i)
  WHERE size = 3 OR len(regexp_extract_all(array_to_string(lines[i : i + size - 1], ' '), '[^\\x20\\x09-\\x0D]+')) >= 20),
later AS (
  SELECT doc_id, i, size FROM (
    SELECT doc_id, i, size, row_number() OVER (PARTITION BY size, content ORDER BY doc_id, i) AS place FROM w)
  WHERE place > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS gone FROM later, unnest(range(i, i + size)) AS t(j) GROUP BY doc_id)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(lines, lambda line, j : NOT list_contains(coalesce(gone, []), j)), chr(10)))
         AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

OP8 = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
  FROM p LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM fits WHERE place = 1
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a) USING (vec_id)
"""

_LEVELS = 9  # of trees in the SQL: more than any of the tables needs


def _merkle_tree(name: str, leaves: str) -> str:
    """CTEs name0, name1, ...: each level's nodes (grp, pos, n, h) and the digests before and after each in its run."""

    def siblings(level: str) -> str:
        run = "OVER (PARTITION BY grp, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f"""SELECT *,
    coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM ({level})"""

    ctes = [f"{name}0 AS MATERIALIZED ({siblings(leaves)})"]
    for k in range(_LEVELS):
        up = f"""SELECT grp, pos // 8 AS pos, (any_value(n) + 7) // 8 AS n,
    CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
    FROM {name}{k} GROUP BY grp, pos // 8"""
        ctes.append(f"{name}{k + 1} AS MATERIALIZED ({siblings(up)})")
    return ",\n".join(ctes)


def _merkle_climb(first: str, tree: str, group: str, place: str) -> str:
    """CTEs that fold `first` (doc_id, lang, pos, proof, folded) up `tree`; a node that is alone stays."""
    ctes, last = [], first
    for k in range(_LEVELS):
        name = f"{tree}_way{k}"
        ctes.append(f"""{name} AS (
  SELECT w.* EXCLUDE (proof, folded), CASE WHEN t.n = 1 THEN proof ELSE proof || t.before || t.after END AS proof,
         CASE WHEN t.n = 1 THEN folded ELSE sha256(t.before || folded || t.after) END AS folded
  FROM {last} w JOIN {tree}{k} t ON t.grp = {group} AND t.pos = {place} // {8**k})""")
        last = name
    return ",\n".join(ctes)


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    cast = [f"CAST({field} AS VARCHAR)" for field in fields]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in cast) + ")"


OP11 = rf"""
WITH RECURSIVE crc_rows AS (
  SELECT 0 AS step, i, CAST(i AS BIGINT) AS c FROM range(256) AS t(i)
  UNION ALL
  SELECT step + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_rows WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_rows WHERE step = 8),
marked AS (
  SELECT documents.*,
         CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS grp,
         xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 3 = 0 AS tampered
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT doc_id, grp, {_leaf_sql("text")} AS leaf,
         CASE WHEN tampered
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf_sql("text")} END AS start
  FROM marked),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n
  FROM leaves),
{_merkle_tree("low", "SELECT grp, pos, n, leaf AS h FROM placed")},
subroots AS MATERIALIZED (
  SELECT '' AS grp, grp AS own, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, count(*) OVER () AS n, h
  FROM low{_LEVELS}),
{_merkle_tree("high", "SELECT grp, pos, n, h FROM subroots")},
started AS (
  SELECT p.doc_id, p.leaf, p.grp, p.pos, s.h AS subroot, s.pos AS place, '' AS proof, p.start AS folded
  FROM placed p JOIN subroots s ON s.own = p.grp),
{_merkle_climb("started", "low", "w.grp", "w.pos")},
{_merkle_climb(f"low_way{_LEVELS - 1}", "high", "''", "w.place")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM high_way{_LEVELS - 1}, (SELECT h FROM high{_LEVELS})
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS MATERIALIZED (
  SELECT lang, w[i : i + size - 1] AS words, any_value(size) AS size, count(*) AS f
  FROM w, unnest(range(1, 6)) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i) GROUP BY ALL HAVING count(*) >= 100
  ),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, words, size, f AS a FROM f WHERE size > 1),
inside AS (
  SELECT lang, words[i : i + k - 1] AS words, max(a) AS most
  FROM c, unnest(range(2, size)) AS s(k), unnest(range(1, size - k + 2)) AS t(i) GROUP BY ALL),
cuts AS (
  SELECT c.*, k, lf.f AS l, rf.f AS r, n.n,
         CAST(CAST(1000 AS HUGEINT) * a * n.n // (CAST(lf.f AS HUGEINT) * rf.f) AS BIGINT) AS score
  FROM c ANTI JOIN (SELECT inside.lang, inside.words FROM inside JOIN c USING (lang, words) WHERE 100 * most >= 100 * a) gone
         USING (lang, words), unnest(range(1, size)) AS t(k), f lf, f rf, n
  WHERE lf.lang = c.lang AND lf.words = c.words[1 : k] AND rf.lang = c.lang AND rf.words = c.words[k + 1 :]
    AND n.lang = c.lang),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS place FROM cuts) WHERE place = 1),
ranked AS (
  SELECT *, array_to_string(words, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(words, ' '))) AS rank
  FROM best)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""

ORACLE_SQL = {
    "op4_substring_dedup": OP4,
    "op11_merkle_manifest": OP11,
    "op13_collocations": OP13,
    "op10_near_vectors": OP10,
    "op8_url_filter": OP8,
    "op9_line_dedup": OP9,
    "op5_decontamination": OP5,
}
