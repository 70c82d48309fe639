"""Equivalent DuckDB SQL for every registered query (the differential oracle).

The fixture views are spelled once as CTEs and prepended to each query.
Integer counts are cast to BIGINT so the result schema matches Spark's.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixture views
# ---------------------------------------------------------------------------
_F_METHODS = r"""
f_m0 AS (
  SELECT 'shop' AS project, p_partkey AS method_ord, 'shop.' || lower(p_type) AS package,
         replace(p_brand, '#', '') AS class_name,
         'shop.' || lower(p_type) || '.' || replace(p_brand, '#', '') AS class_fqn,
         CASE WHEN p_partkey % 50 = 0 THEN
                CASE (p_partkey // 50) % 4 WHEN 0 THEN 'add' WHEN 1 THEN 'get' WHEN 2 THEN 'size' ELSE 'clear' END
              WHEN p_partkey % 2 = 0 THEN 'm' || p_partkey
              ELSE replace(p_name, ' ', '_') END AS method,
         CAST(p_size AS INTEGER) AS loc, CAST(p_partkey % 7 AS INTEGER) AS params,
         split_part(p_name, ' ', 1) AS field
  FROM part),
f_methods AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY class_fqn) AS BIGINT) AS file_ord,
         class_fqn || '.' || method AS method_fqn
  FROM f_m0),
f_classes AS (
  SELECT project, package, class_name, class_fqn, file_ord,
         CAST(count(DISTINCT field) AS INTEGER) AS attr_count
  FROM f_methods GROUP BY ALL),
f_inv AS (
  SELECT DISTINCT a.project, a.class_fqn, a.method_fqn AS caller, a.file_ord, a.method_ord,
         b.method AS callee_simple, b.class_fqn AS callee_class, b.method_fqn AS callee_true
  FROM (SELECT l_partkey, lead(l_partkey) OVER (PARTITION BY l_orderkey
                 ORDER BY l_linenumber, l_partkey, l_suppkey) AS nx FROM lineitem) l
  JOIN f_methods a ON a.method_ord = l.l_partkey
  JOIN f_methods b ON b.method_ord = l.nx),
u_names AS (
  SELECT project, method, min(class_fqn) AS unique_class FROM f_methods
  WHERE method NOT IN ('add', 'remove', 'size', 'isEmpty', 'contains', 'get', 'set', 'clear')
  GROUP BY project, method HAVING count(DISTINCT class_fqn) = 1),
g_calls AS (
  SELECT DISTINCT i.project, i.caller,
         coalesce(u.unique_class || '.' || i.callee_simple, i.callee_simple) AS callee
  FROM f_inv i LEFT JOIN u_names u ON u.project = i.project AND u.method = i.callee_simple),
g_nodes AS (SELECT project, method_fqn AS caller FROM f_methods),
cls_dim AS (
  SELECT project, lower(regexp_extract(c, '([^.]*)$', 1)) AS lshort, min(c) AS cmatch
  FROM (SELECT project, regexp_extract(caller, '^(.+)\.[^.]*$', 1) AS c FROM g_nodes) WHERE c <> ''
  GROUP BY ALL),
g_edges AS (
  SELECT e.project, e.callee,
         coalesce(d1.cmatch, nullif(e.cc, '')) AS cc, coalesce(d2.cmatch, nullif(e.ce, '')) AS ce
  FROM (SELECT project, callee, regexp_extract(caller, '^(.+)\.[^.]*$', 1) AS cc,
               regexp_extract(callee, '^(.+)\.[^.]*$', 1) AS ce FROM g_calls) e
  LEFT JOIN cls_dim d1 ON d1.project = e.project AND e.cc <> '' AND NOT contains(e.cc, '.') AND lower(e.cc) = d1.lshort
  LEFT JOIN cls_dim d2 ON d2.project = e.project AND e.ce <> '' AND NOT contains(e.ce, '.') AND lower(e.ce) = d2.lshort),
coupling AS (
  SELECT project, least(cc, ce) AS a, greatest(cc, ce) AS b, count(DISTINCT callee) AS n_calls
  FROM g_edges
  WHERE cc IS NOT NULL AND ce IS NOT NULL AND cc <> ce
    AND regexp_extract(cc, '^(.+)\.[^.]*$', 1) <> '' AND regexp_extract(ce, '^(.+)\.[^.]*$', 1) <> ''
  GROUP BY ALL),
c_total AS (SELECT project, CAST(sum(n_calls) AS BIGINT) AS total FROM coupling GROUP BY project),
weights AS (
  SELECT c.project, c.a, c.b, c.n_calls,
         CASE WHEN t.total > 0 THEN c.n_calls / CAST(t.total AS DOUBLE) ELSE 0.0 END AS weight
  FROM coupling c JOIN c_total t USING (project)),
t_inv AS (
  SELECT project,
         CASE WHEN starts_with(class_fqn, 'shop.promo.') THEN 'java.' || class_fqn ELSE class_fqn END AS class_fqn,
         CASE WHEN starts_with(class_fqn, 'shop.promo.') THEN 'java.' || caller ELSE caller END AS caller,
         CASE WHEN starts_with(callee_class, 'shop.promo.') THEN 'java.' || callee_class ELSE callee_class END
           AS declaring_class,
         callee_simple
  FROM f_inv),
t_calls AS (
  SELECT DISTINCT project, caller, declaring_class || '.' || callee_simple AS callee FROM t_inv
  WHERE NOT (starts_with(class_fqn, 'java.') OR starts_with(class_fqn, 'javax.') OR starts_with(class_fqn, 'sun.')
             OR starts_with(class_fqn, 'com.sun.') OR starts_with(class_fqn, 'jdk.'))
    AND NOT (starts_with(declaring_class, 'java.') OR starts_with(declaring_class, 'javax.')
             OR starts_with(declaring_class, 'sun.') OR starts_with(declaring_class, 'com.sun.')
             OR starts_with(declaring_class, 'jdk.'))),
d_coupling AS (
  SELECT project, a, b, count(DISTINCT m) AS n_calls FROM (
    SELECT project, regexp_extract(caller, '^(.+)\.[^.]*$', 1) AS a,
           regexp_extract(callee, '^(.+)\.[^.]*$', 1) AS b, regexp_extract(callee, '([^.]*)$', 1) AS m
    FROM t_calls)
  WHERE a <> '' AND b <> '' AND a <> b
  GROUP BY ALL),
d_total AS (SELECT project, CAST(sum(n_calls) AS BIGINT) AS total FROM d_coupling GROUP BY project),
d_weights AS (
  SELECT c.project, c.a, c.b, c.n_calls,
         CASE WHEN t.total > 0 THEN c.n_calls / CAST(t.total AS DOUBLE) ELSE 0.0 END AS weight
  FROM d_coupling c JOIN d_total t USING (project))
"""


# Average-linkage merge list by a recursive CTE: one merge per step, the best pair
# by (s/(na*nb) desc, a, b) over the contracted edges; merged ids are n + it.
# ``pp`` must be defined by the caller: (a, b, n) class pairs of one project.
_CLUSTER = r"""
cls AS (SELECT c, CAST(row_number() OVER (ORDER BY c) - 1 AS BIGINT) AS id
        FROM (SELECT a AS c FROM pp UNION SELECT b FROM pp)),
nn AS (SELECT count(*) AS n FROM cls),
st AS (
  SELECT 0::BIGINT AS it, x.id AS a, y.id AS b, pp.n::BIGINT AS s, 1::BIGINT AS na, 1::BIGINT AS nb,
         0::BIGINT AS ia, 0::BIGINT AS ib
  FROM pp JOIN cls x ON x.c = pp.a JOIN cls y ON y.c = pp.b
  UNION ALL
  SELECT it + 1, least(a2, b2), greatest(a2, b2), sum(s)::BIGINT,
         any_value(CASE WHEN a2 < b2 THEN na2 ELSE nb2 END), any_value(CASE WHEN a2 < b2 THEN nb2 ELSE na2 END),
         any_value(CASE WHEN a2 < b2 THEN ia2 ELSE ib2 END), any_value(CASE WHEN a2 < b2 THEN ib2 ELSE ia2 END)
  FROM (SELECT st.it, st.s,
          CASE WHEN a IN (ba, bb) THEN nn.n + st.it ELSE a END AS a2,
          CASE WHEN b IN (ba, bb) THEN nn.n + st.it ELSE b END AS b2,
          CASE WHEN a IN (ba, bb) THEN bna + bnb ELSE na END AS na2,
          CASE WHEN b IN (ba, bb) THEN bna + bnb ELSE nb END AS nb2,
          CASE WHEN a IN (ba, bb) THEN bia + bib + bs ELSE ia END AS ia2,
          CASE WHEN b IN (ba, bb) THEN bia + bib + bs ELSE ib END AS ib2
        FROM st, nn, (SELECT a AS ba, b AS bb, na AS bna, nb AS bnb, ia AS bia, ib AS bib, s AS bs FROM st
                      ORDER BY s::DOUBLE / (na * nb) DESC, a, b LIMIT 1) z
        WHERE NOT (a = ba AND b = bb))
  GROUP BY it, least(a2, b2), greatest(a2, b2)),
pos AS (
  SELECT it, a AS l, b AS r, s, na + nb AS size, ia + ib + s AS intra, na * nb AS pairs FROM st
  QUALIFY row_number() OVER (PARTITION BY it ORDER BY s::DOUBLE / (na * nb) DESC, a, b) = 1),
npos AS (SELECT count(*) AS p FROM pos),
roots AS (
  SELECT node_id, n_classes, intra, CAST(row_number() OVER (ORDER BY node_id) - 1 AS BIGINT) AS qi FROM (
    SELECT nn.n + it AS node_id, size AS n_classes, intra FROM pos, nn
    WHERE nn.n + it NOT IN (SELECT l FROM pos UNION ALL SELECT r FROM pos)
    UNION ALL
    SELECT id, 1, 0 FROM cls WHERE id NOT IN (SELECT l FROM pos UNION ALL SELECT r FROM pos))),
kk AS (SELECT count(*) AS k FROM roots),
zt AS (SELECT t FROM kk, range(0, greatest(kk.k - 1, 0)) AS r(t)),
zexp AS (
  SELECT t, 2 * t AS item FROM zt UNION ALL SELECT t, 2 * t + 1 FROM zt
  UNION ALL
  SELECT zexp.t, c.item FROM zexp, kk,
    (SELECT t AS pt, 2 * t AS item FROM zt UNION ALL SELECT t, 2 * t + 1 FROM zt) c
  WHERE zexp.item >= kk.k AND c.pt = zexp.item - kk.k),
zsum AS (
  SELECT zexp.t, CAST(sum(roots.n_classes) AS BIGINT) AS n_classes, CAST(sum(roots.intra) AS BIGINT) AS intra
  FROM zexp JOIN roots ON roots.qi = zexp.item GROUP BY zexp.t),
ptot AS (@PTOT@),
dg AS (
  SELECT 'shop' AS project, id AS node_id, c AS label, NULL::BIGINT AS "left", NULL::BIGINT AS "right",
         0.0::DOUBLE AS sim, 0 AS level, 1::BIGINT AS n_classes, 0::BIGINT AS intra_calls FROM cls
  UNION ALL
  SELECT 'shop', nn.n + it, 'Cluster_' || (it + 1), l, r, s / CAST(ptot.total * pairs AS DOUBLE),
         CAST(it + 1 AS INTEGER), size, intra
  FROM pos, nn, ptot
  UNION ALL
  SELECT 'shop', nn.n + npos.p + zt.t, 'Cluster_' || (npos.p + zt.t + 1),
         CASE WHEN 2 * zt.t < kk.k THEN (SELECT node_id FROM roots WHERE qi = 2 * zt.t)
              ELSE nn.n + npos.p + 2 * zt.t - kk.k END,
         CASE WHEN 2 * zt.t + 1 < kk.k THEN (SELECT node_id FROM roots WHERE qi = 2 * zt.t + 1)
              ELSE nn.n + npos.p + 2 * zt.t + 1 - kk.k END,
         0.0, CAST(npos.p + zt.t + 1 AS INTEGER), zsum.n_classes, zsum.intra
  FROM zt JOIN zsum USING (t), nn, npos, kk),
dgt AS (SELECT dg.*, ptot.total FROM dg, ptot),
dga AS (
  SELECT *, CASE WHEN n_classes >= 2 AND total > 0
                 THEN intra_calls / CAST(total * (n_classes * (n_classes - 1) // 2) AS DOUBLE) ELSE 0.0 END
              AS avg_coupling
  FROM dgt),
links AS (
  SELECT p."left" AS node_id, p.node_id AS parent, 1::BIGINT AS off FROM dga p WHERE p."left" IS NOT NULL
  UNION ALL
  SELECT p."right", p.node_id, 2 * l.n_classes FROM dga p JOIN dga l ON l.node_id = p."left"),
walk AS (
  SELECT node_id, 0::BIGINT AS depth, 0::BIGINT AS pre FROM dga WHERE node_id NOT IN (SELECT node_id FROM links)
  UNION ALL
  SELECT links.node_id, walk.depth + 1, walk.pre + links.off FROM walk JOIN links ON links.parent = walk.node_id),
anc AS (
  SELECT node_id, node_id AS anc, 0 AS dist FROM dga
  UNION ALL
  SELECT anc.node_id, links.parent, anc.dist + 1 FROM anc JOIN links ON links.node_id = anc.anc)
"""


# Many projects: methods, calls and coupling of the corpus fixture, every step grouped by project.
CORPUS = r"""
xn AS (SELECT greatest(3, count(*) // 500) AS p, count(*) // 30 + 1 AS c FROM part),
xm0 AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 'hub' ELSE 'proj' || (p_partkey % p) END AS project, p_partkey AS o, p_partkey * 11 % c AS cn,
         CASE WHEN p_partkey % 50 = 0 THEN 'get' ELSE 'm' || (p_partkey // 3) END AS method, p_size AS loc
  FROM part, xn),
xm AS (SELECT *, project || '.p' || (cn % 4) || '.C' || cn AS class_fqn FROM xm0),
xi AS (
  SELECT DISTINCT xm.project, xm.class_fqn, xm.class_fqn || '.' || xm.method AS caller,
         CASE WHEN nx % 50 = 0 THEN 'get' ELSE 'm' || (nx // 3) END AS callee_simple
  FROM (SELECT l_partkey, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS nx
        FROM lineitem) l JOIN xm ON xm.o = l.l_partkey WHERE nx IS NOT NULL),
xu AS (SELECT project, method, min(class_fqn) AS k FROM xm WHERE method <> 'get' GROUP BY ALL HAVING count(DISTINCT class_fqn) = 1),
xc AS (SELECT DISTINCT xi.project, class_fqn, caller, xu.k, coalesce(xu.k || '.' || callee_simple, callee_simple) AS callee
       FROM xi LEFT JOIN xu ON xu.project = xi.project AND xu.method = xi.callee_simple),
xp AS (SELECT project, least(class_fqn, k) AS a, greatest(class_fqn, k) AS b, count(DISTINCT callee) AS n_calls
       FROM xc WHERE k IS NOT NULL AND k <> class_fqn GROUP BY ALL),
xt AS (SELECT project, CAST(sum(n_calls) AS BIGINT) AS total FROM xp GROUP BY project),
xw AS (SELECT xp.*, n_calls / CAST(total AS DOUBLE) AS weight FROM xp JOIN xt USING (project))
"""
# One merge per step and project, as in _CLUSTER.
CORPUS_MERGES = r"""
xcl AS (SELECT project, c, CAST(row_number() OVER (PARTITION BY project ORDER BY c) - 1 AS BIGINT) AS id
        FROM (SELECT project, a AS c FROM xp UNION SELECT project, b FROM xp)),
xnn AS (SELECT project, count(*) AS n FROM xcl GROUP BY project),
st AS (
  SELECT xp.project, 0::BIGINT AS it, x.id AS a, y.id AS b, n_calls::BIGINT AS s, 1::BIGINT AS na, 1::BIGINT AS nb
  FROM xp JOIN xcl x ON x.project = xp.project AND x.c = xp.a JOIN xcl y ON y.project = xp.project AND y.c = xp.b
  UNION ALL
  SELECT project, it + 1, least(a2, b2), greatest(a2, b2), sum(s)::BIGINT,
         any_value(CASE WHEN a2 < b2 THEN na2 ELSE nb2 END), any_value(CASE WHEN a2 < b2 THEN nb2 ELSE na2 END)
  FROM (SELECT st.project, st.it, st.s,
          CASE WHEN a IN (ba, bb) THEN n + st.it ELSE a END AS a2, CASE WHEN b IN (ba, bb) THEN n + st.it ELSE b END AS b2,
          CASE WHEN a IN (ba, bb) THEN bna + bnb ELSE na END AS na2, CASE WHEN b IN (ba, bb) THEN bna + bnb ELSE nb END AS nb2
        FROM st JOIN xnn ON xnn.project = st.project
        JOIN (SELECT project AS zp, arg_min(struct_pack(a := a, b := b, na := na, nb := nb), (-(s::DOUBLE / (na * nb)), a, b)) AS w
              FROM st GROUP BY project) z0 ON z0.zp = st.project,
        LATERAL (SELECT w.a AS ba, w.b AS bb, w.na AS bna, w.nb AS bnb) z
        WHERE NOT (a = ba AND b = bb))
  GROUP BY project, it, least(a2, b2), greatest(a2, b2)),
pos AS (
  SELECT project, it, a AS l, b AS r, s, na + nb AS size, na * nb AS pairs FROM st
  QUALIFY row_number() OVER (PARTITION BY project, it ORDER BY s::DOUBLE / (na * nb) DESC, a, b) = 1)
"""


def with_fixtures(body: str) -> str:
    return "WITH RECURSIVE " + _F_METHODS.strip() + "\n" + body.strip()


# ---------------------------------------------------------------------------
# Query bodies (each may add its own CTEs by starting with ", name AS (...)")
# ---------------------------------------------------------------------------
BODIES: dict[str, str] = {}


def _q(key: str, body: str) -> None:
    BODIES[key] = body


def cluster_block(pairs_sql: str, total_sql: str | None = None) -> str:
    """CTEs ``pp`` (given) + the clustering views, to splice after the fixtures.

    ``total_sql`` yields one row ``total`` (the weight divisor); default: sum of pp.n."""
    tot = total_sql or "SELECT CAST(sum(n) AS BIGINT) AS total FROM pp"
    return ",\npp AS (" + pairs_sql + "),\n" + _CLUSTER.strip().replace("@PTOT@", tot)


def sql_for(key: str) -> str:
    body = BODIES[key].strip()
    if body.startswith("xn AS"):
        return "WITH RECURSIVE " + body
    if body.startswith("WITH "):
        return body
    if body.startswith(","):
        return "WITH RECURSIVE " + _F_METHODS.strip() + body
    return with_fixtures(body)


def all_sql() -> dict[str, str]:
    return {k: sql_for(k) for k in BODIES}
