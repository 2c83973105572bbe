"""DuckDB SQL of the registered queries that SQL can express."""

from rehome.llm import licenses

ORACLE = {}

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(col: str) -> str:
    return f"translate({col}, '{_UP}', '{_LOW}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"


def words(col: str, rule: str) -> str:
    return f"regexp_extract_all({lower(f'coalesce({col}, {chr(39) * 2})')}, '{rule}')"


ORACLE["op7_decontam"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words('text', _ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {words('text', _ALNUM)} AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
               array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
              FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM pat),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
occ AS (SELECT DISTINCT dw.rid, dw.n, dw.i, pat.item_id FROM dw JOIN pat USING (n, win)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM occ) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items,
               string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
        FROM (SELECT DISTINCT rid, item_id FROM occ WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""

ORACLE["op2_url_rules"] = f"""
WITH u AS (SELECT page_id, url, strpos(url, '://') AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, {lower("regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
      ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (SELECT page_id, host, path, rhost || rpath AS rule, rverdict FROM h JOIN rules
        ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule,
                arg_max(rverdict, length(rule)) AS verdict FROM fit GROUP BY page_id)
SELECT h.page_id, h.host, h.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM h LEFT JOIN best USING (page_id)
"""


def _invert(u: str, w0: float, w1: float) -> str:
    """Time at which a straight schedule from w0 to w1 reaches share u."""
    area = f"({u}) * {(w0 + w1) / 2.0}::DOUBLE"
    return (f"(0.0::DOUBLE + 2.0::DOUBLE * ({area}) / ({w0}::DOUBLE + sqrt(greatest("
            f"{w0 * w0}::DOUBLE + {2.0 * (w1 - w0)}::DOUBLE * ({area}), 0.0::DOUBLE))))")


def _time(u: str) -> str:
    return (f"CASE kind WHEN 0 THEN {_invert(u, 7.5, 2.5)} WHEN 1 THEN {_invert(u, 2.0, 2.0)} "
            f"ELSE {_invert(u, 0.5, 1.5)} END")


# The level is found from the sources in order of the level at which each is
# capped: the first l = (budget - caps before) / (weights from here) that does
# not reach the next cap.
ORACLE["op4_mixing"] = f"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
                  len(regexp_extract_all(coalesce(text, ''), '{_BLANK}'))::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT source, source_size, 2 * source_size AS cap,
             (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS kind FROM s),
w AS (SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END
             AS weight FROM k),
b AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS rn FROM w),
lv AS (SELECT rn, cap, weight, (budget - coalesce(sum(cap) OVER (ORDER BY rn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(weight) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              AS level FROM o, b),
lev AS (SELECT arg_min(level, rn) AS level FROM lv WHERE cap > level * weight),
t AS (SELECT source, source_size, kind, CASE WHEN cap <= level * weight THEN cap::DOUBLE
             ELSE level * weight END AS target FROM w, lev),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.kind,
             floor(t.target + 0.5::DOUBLE)::BIGINT AS words,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
              ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, least(size, greatest(0, words - start)) AS t0,
             least(size, greatest(0, words - source_size - start)) AS t1 FROM c)
SELECT doc_id, size, source_size, target, (t0 + t1)::BIGINT AS taken,
       CASE WHEN t0 > 0 THEN {_time("(0 * source_size + start) / target")} END AS position,
       CASE WHEN t1 > 0 THEN {_time("(1 * source_size + start) / target")} END AS repeat_position
FROM x
"""


def _places(i: int) -> str:
    ws = licenses.PHRASES[i][0].split()
    cond = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(ws))
    return (f"SELECT rid, i - 1 AS pos, '{licenses.PHRASES[i][1]}' AS label FROM "
            f"(SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE {cond}")


def _template(i: int) -> str:
    label, text = licenses.TEMPLATES[i]
    ws = sorted(set(text.split()))
    return f"({i}, '{label}', [{', '.join(repr(x) for x in ws)}], {len(ws)})"


# Brute force: every block against every template.
ORACLE["op8_licenses"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words('text', _ALNUM)} AS w FROM documents),
pl AS ({' UNION ALL '.join(_places(i) for i in range(len(licenses.PHRASES)))}),
base AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
                list_sort(list(DISTINCT label)) AS labels FROM pl GROUP BY rid),
tp(tid, label, toks, n) AS (VALUES {', '.join(_template(i) for i in range(len(licenses.TEMPLATES)))}),
bl AS (SELECT rid, list_distinct(w[i:i + {2 * licenses.SPAN - 1}]) AS b
       FROM (SELECT rid, w, unnest(range(1, len(w) + 1, {licenses.SPAN})) AS i FROM d)),
fit AS (SELECT rid, label, len(list_intersect(b, toks)) / n::DOUBLE AS share
        FROM bl, tp WHERE len(list_intersect(b, toks)) >= ceil({licenses.THRESHOLD} * n - 1e-9)),
more AS (SELECT rid, list(DISTINCT label) AS labels, max(share) AS share FROM fit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []),
                       coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
"""

# Brute force: all pairs that share a shingle, then the closure of the links.
ORACLE["op1_minhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words('text', _BLANK)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
             FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y
          ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM inter JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(node, seen) AS (SELECT doc_id, doc_id FROM d UNION
                      SELECT reach.node, link.b FROM reach JOIN link ON reach.seen = link.a),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM d JOIN comp ON comp.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

# Brute force: every window of 50 words that stands in two documents.
ORACLE["op5_repeats"] = f"""
WITH d AS (SELECT doc_id, {words('text', _BLANK)} AS w FROM documents),
win AS (SELECT doc_id, i - 1 AS s, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
sh AS (SELECT h FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
f AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 50 AS gap
      FROM win SEMI JOIN sh USING (h)),
g AS (SELECT doc_id, s, sum(CASE WHEN gap THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY s) AS grp FROM f),
sp AS (SELECT doc_id, min(s) AS b, max(s) + 50 AS e FROM g GROUP BY doc_id, grp)
SELECT doc_id, len(any_value(w))::BIGINT AS n_words, sum(e - b)::BIGINT AS n_repeated,
       string_agg(b || ',' || e, ',' ORDER BY b) AS spans
FROM sp JOIN d USING (doc_id) GROUP BY doc_id
"""
