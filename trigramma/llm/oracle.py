"""The queries in DuckDB SQL, where SQL can say them."""

URL_FILTER = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(ruled, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(ruled, length(h || p)) AS ruled
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path
), found AS (
  SELECT page_id, host, path, rule, ruled FROM parts LEFT JOIN best USING (host, path)
), listed AS (
  SELECT host, sum(CASE ruled WHEN 'block' THEN 1 WHEN 'allow' THEN -1 ELSE 0 END) > 0 AS bad
  FROM found GROUP BY host
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM found JOIN listed USING (host)
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, w, least(len(w), 10) AS win FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, win, array_to_string(w[i:i + win - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - win + 2)) AS i FROM b)
), dw AS (
  SELECT doc_id, i, win, array_to_string(w[i:i + win - 1], ' ') AS g FROM (
    SELECT doc_id, w, win, unnest(range(1, len(w) - win + 2)) AS i
    FROM d, (SELECT DISTINCT win FROM b))
), hit AS (
  SELECT doc_id, item_id, i, win FROM dw JOIN bw USING (win, g)
), spot AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + win)) AS p FROM hit) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spot USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL
), l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), r AS (
  SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(c) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = r.doc_id) AS n_links
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), solid AS (
  SELECT doc_id, lines, list_filter(range(1, len(lines) + 1), lambda i: regexp_matches(lines[i], '\S')) AS spot FROM l
), w AS (
  SELECT doc_id, spot[k] AS a, spot[k + 1] AS b, array_to_string(lines[spot[k]:spot[k + 1]], chr(10)) AS said
  FROM (SELECT *, unnest(range(1, len(spot))) AS k FROM solid)
), again AS (
  SELECT doc_id, unnest(range(a, b + 1)) AS i FROM (
    SELECT *, row_number() OVER (PARTITION BY said ORDER BY doc_id, a) AS n FROM w) WHERE n > 1
), gone AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT DISTINCT doc_id, i FROM again)
), g AS (
  SELECT doc_id, list(i) AS gone, count(*) AS n_lines, count(*) FILTER (before IS NULL OR before < i - 1) AS n_chunks
  FROM gone GROUP BY doc_id
)
SELECT l.doc_id, coalesce(n_chunks, 0) AS n_removed_chunks, coalesce(n_lines, 0) AS n_removed_lines,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10)) END AS text
FROM l LEFT JOIN g ON l.doc_id = g.doc_id
"""

MIXING = r"""
WITH RECURSIVE s AS (
  SELECT source, CASE WHEN source = 'src0' THEN 3 ELSE 1 END AS w,
         row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM (SELECT DISTINCT source FROM documents)
), cfg AS (
  SELECT list(w ORDER BY i) AS w, sum(w)::BIGINT AS q FROM s
), e(t, c, pick) AS (
  SELECT 0::BIGINT, list_transform(w, lambda x: 0::BIGINT), NULL::BIGINT FROM cfg
  UNION ALL
  SELECT t + 1, list_transform(c, lambda x, k: CASE WHEN k = p THEN x + 1 ELSE x END), p FROM (
    SELECT t, c, (list_min(list_transform(
      list_filter(range(1, len(c) + 1), lambda k: c[k] * q < (t + 1) * w[k]),
      lambda k: ((c[k] + 1) * q + w[k] - 1) // w[k] * 1000000 + k)) % 1000000)::BIGINT AS p
    FROM e, cfg WHERE t < q)
), turns AS (
  SELECT pick AS i, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM e WHERE pick IS NOT NULL
), r AS (
  SELECT d.doc_id, d.source, s.i, s.w,
    row_number() OVER (PARTITION BY s.i ORDER BY md5(d.doc_id::VARCHAR), d.doc_id) - 1 AS n
  FROM documents d JOIN s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, n // 64 AS mix_block, (n // 64) // r.w * q + slot AS mix_slot,
       ((n // 64) // r.w * q + slot) * 64 + n % 64 AS mix_position
FROM r JOIN turns ON r.i = turns.i AND (n // 64) % r.w = turn, cfg
"""


LEXICAL_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), k AS (
  SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM d
), b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark
), p AS MATERIALIZED (
  SELECT r, doc_id, size, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS size, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM b) GROUP BY ALL
), f AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, k GROUP BY term, docs
), s AS (
  SELECT item_id, doc_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * docs) // terms))))::BIGINT AS score
  FROM b JOIN p USING (term) JOIN f USING (term), k GROUP BY item_id, doc_id, r
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0
) WHERE place <= 10
"""


def _levels(name: str, leaves: str, levels: int) -> str:
    """Levels of the trees in ``leaves(key, pos, node)`` and the runs of each."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT key, pos, node, count(*) OVER (PARTITION BY key) AS n FROM {leaves})"]
    for k in range(levels):
        parts.append(f"""{name}_runs{k} AS MATERIALIZED (
          SELECT key, pos // 3 AS run, n, list(node ORDER BY pos) AS ns FROM {name}{k} WHERE n > 1 GROUP BY key, pos // 3, n)""")
        parts.append(f"""{name}{k + 1} AS MATERIALIZED (
          SELECT key, run AS pos, sha256(array_to_string(ns, '')) AS node, (n + 2) // 3 AS n FROM {name}_runs{k}
          UNION ALL SELECT key, pos, node, n FROM {name}{k} WHERE n = 1)""")
    return ", ".join(parts)


def _proofs(name: str, first: str, out: str, levels: int) -> str:
    """Columns ``proof`` and ``folded`` of ``first`` taken from the runs of every level."""
    parts, before = [], first
    for k in range(levels):
        slot = f"(p.pos // {3 ** k} % 3)::BIGINT"
        left = f"array_to_string(ns[1:{slot}], '')"
        right = f"array_to_string(ns[{slot} + 2:], '')"
        after = out if k == levels - 1 else f"{out}{k}"
        parts.append(f"""{after} AS MATERIALIZED (SELECT p.* EXCLUDE (proof, folded),
          CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,
          CASE WHEN run IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded
          FROM {before} p LEFT JOIN {name}_runs{k} q ON p.key = q.key AND q.run = p.pos // {3 ** (k + 1)})""")
        before = after
    return ", ".join(parts)


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# CRC-32 of the decimal digits of an id, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x // 2, 3988292384::BIGINT * (x % 2)))), 4294967295::BIGINT)"""
# Levels up to 3^16 rows of a source and 3^8 sources.
MERKLE = f"""
WITH found AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, {_leaf("text")} AS node,
    CASE WHEN doc_id IS NOT NULL AND {_CRC32} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS folded
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, '' AS proof FROM found
), {_levels("t", "leaves", 16)},
subroots AS MATERIALIZED (
  SELECT '' AS key, key AS tree, node, row_number() OVER (ORDER BY key) - 1 AS pos FROM t16
), {_levels("u", "subroots", 8)},
{_proofs("t", "leaves", "low", 16)}, top AS (
  SELECT '' AS key, s.pos, low.doc_id, low.node AS leaf, s.node AS subroot, low.proof, low.folded FROM low JOIN subroots s ON s.tree = low.key
), {_proofs("u", "top", "done", 8)}
SELECT doc_id, leaf, subroot, root.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.node AS verified
FROM done, u8 AS root
"""


def oracle_sql():
    return {
        "op2_jaccard_join": JACCARD_JOIN,
        "op3_decontaminate": DECONTAMINATE,
        "op6_mixing": MIXING,
        "op7_line_dedup": LINE_DEDUP,
        "op10_url_filter": URL_FILTER,
        "op11_lexical_search": LEXICAL_SEARCH,
        "op13_merkle_manifest": MERKLE,
    }
