"""DuckDB SQL equivalents of the registered queries (same column names).

The views (``region nation customer ... conversations``) are registered by
the caller.  Each SQL restates the binding of ``rehome.plans.bindings`` and
the operator semantics independently of the Spark code.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Shared binding fragments -------------------------------------------------
SRC_CLUSTERS = ("SELECT CAST(c_custkey AS VARCHAR) AS cluster_id, c_name AS cluster_name, "
                "c_custkey AS ord FROM customer")
TGT_CLUSTERS = ("SELECT CAST(c_custkey + 500000 AS VARCHAR) AS cluster_id, c_name AS cluster_name, "
                "c_custkey AS ord FROM customer WHERE c_custkey % 4 <> 0")
CLUSTER_MAP = f"""
  SELECT s.cluster_name AS name, s.old_id, t.new_id
  FROM (SELECT cluster_name, arg_max(cluster_id, ord) AS old_id FROM ({SRC_CLUSTERS})
        WHERE cluster_name IS NOT NULL GROUP BY cluster_name) s
  JOIN (SELECT cluster_name, arg_max(cluster_id, ord) AS new_id FROM ({TGT_CLUSTERS})
        WHERE cluster_name IS NOT NULL GROUP BY cluster_name) t
    ON s.cluster_name = t.cluster_name"""
JOBS = ("SELECT o_orderkey AS job_id, 'order-' || CAST(o_orderkey AS VARCHAR) AS name, "
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS ecid "
        "FROM orders")
AWS_DEFAULT_JSON = ('{"spark_version":"6.1.x-scala2.11","node_type_id":"i3.xlarge",'
                    '"num_workers":8,"enable_elastic_disk":false,'
                    '"spark_env_vars":{"PYSPARK_PYTHON":"/usr/bin/python3"}}')

# ---------------------------------------------------------------------------
SRC_USERS = "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS userName, c_custkey AS ord FROM customer"
TGT_USERS = ("SELECT CAST(c_custkey + 500000 AS VARCHAR) AS id, c_name AS userName, c_custkey AS ord "
             "FROM customer WHERE c_custkey % 4 <> 0")
POOLS_SRC = ("SELECT 'pool-' || n_nationkey AS instance_pool_id, n_name AS instance_pool_name, n_regionkey "
             "FROM nation")
POOLS_LISTED = """SELECT 'pool-' || (n_nationkey + 1000) AS instance_pool_id, n_name AS instance_pool_name,
    1 AS ord FROM nation WHERE n_nationkey % 5 <> 0
  UNION ALL SELECT 'pool-' || (n_nationkey + 2000), n_name, 2 FROM nation
  WHERE n_nationkey % 5 <> 0 AND n_nationkey % 3 = 0"""
POOLS_TGT = f"""SELECT instance_pool_name, arg_max(instance_pool_id, ord) AS instance_pool_id
  FROM ({POOLS_LISTED}) GROUP BY instance_pool_name"""
POOL_MAP = f"""SELECT s.instance_pool_name AS name, s.instance_pool_id AS old_id, t.instance_pool_id AS new_id
  FROM ({POOLS_SRC}) s JOIN ({POOLS_TGT}) t ON s.instance_pool_name = t.instance_pool_name"""
CLUSTERS = """SELECT CAST(c_custkey AS VARCHAR) AS cluster_id,
  CASE WHEN c_custkey % 50 = 0 THEN 'job-' || c_custkey || '-run-' || c_nationkey
       WHEN c_custkey % 70 = 0 THEN 'mlflow-model-' || c_custkey ELSE c_name END AS cluster_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'arn:aws:iam::profile/' || c_nationkey END AS arn,
  CASE WHEN c_custkey % 45 = 0 THEN 'pool-gone' WHEN c_custkey % 5 = 0 THEN 'pool-' || c_nationkey END
    AS instance_pool_id,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS team,
  'u' || c_custkey AS creator, c_acctbal > 9000 AS pinned, c_custkey, c_nationkey
  FROM customer"""
REGISTERED = "SELECT 'arn:aws:iam::profile/' || n_nationkey AS arn FROM nation WHERE n_regionkey <> 2"
WS_ITEMS = """SELECT '/Users/u' || o_custkey || CASE WHEN o_orderkey % 10 = 0 THEN '/Trash/' ELSE '//d/' END
    || 'n' || o_orderkey AS path, o_orderkey AS object_id,
    CASE o_orderkey % 3 WHEN 0 THEN 'DIRECTORY' WHEN 1 THEN 'NOTEBOOK' ELSE 'LIBRARY' END AS object_type
  FROM orders
  UNION ALL SELECT '/Users/u' || c_custkey, c_custkey + 1000000000, 'DIRECTORY' FROM customer
  UNION ALL SELECT '/Users/u' || c_custkey || '/Trash', c_custkey + 2000000000,
    CASE WHEN c_custkey % 2 = 0 THEN 'DIRECTORY' ELSE 'NOTEBOOK' END FROM customer WHERE c_custkey % 7 = 0"""
WS_TARGET = """SELECT '/Users/u' || c_custkey AS path, c_custkey + 3000000000 AS object_id,
    CASE WHEN c_custkey % 4 <> 0 THEN 'DIRECTORY' WHEN c_custkey % 8 = 0 THEN 'NOTEBOOK' END AS object_type
  FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 8 = 0"""
PARTS = "list_filter(string_split({p}, '/'), lambda x: x <> '')"
TRASH_KEEP = """NOT coalesce(regexp_matches(path, '^[^/]*/Users/[^/]*/Trash/')
     OR (object_type = 'DIRECTORY' AND regexp_matches(path, '^[^/]*/Users/[^/]*/Trash$')), false)"""

ORACLE["jn1_id_map"] = f"""
SELECT s.userName AS name, s.old_id, t.new_id
FROM (SELECT userName, arg_max(id, ord) AS old_id FROM ({SRC_USERS}) WHERE userName IS NOT NULL GROUP BY 1) s
JOIN (SELECT userName, arg_max(id, ord) AS new_id FROM ({TGT_USERS}) WHERE userName IS NOT NULL GROUP BY 1) t
  ON s.userName = t.userName"""

ORACLE["jn2_remap_pools"] = f"""
SELECT c.cluster_id, c.instance_pool_id AS old_pool_id, m.new_id AS new_pool_id,
  CASE WHEN c.instance_pool_id IS NULL THEN 'none' WHEN m.new_id IS NULL THEN 'unresolved'
       ELSE 'mapped' END AS pool_status
FROM ({CLUSTERS}) c LEFT JOIN ({POOL_MAP}) m ON c.instance_pool_id = m.old_id"""

ORACLE["jn3_remap_clusters"] = f"""
WITH m AS ({CLUSTER_MAP}), j AS ({JOBS})
SELECT j.job_id, CASE WHEN j.ecid IS NULL THEN 'new_cluster' WHEN m.new_id IS NULL THEN 'reset_default'
                      ELSE 'rewired' END AS outcome,
       j.ecid AS old_cluster_id, CASE WHEN j.ecid IS NOT NULL THEN m.new_id END AS new_cluster_id
FROM j LEFT JOIN m ON j.ecid = m.old_id"""

ORACLE["jn4_skip_existing"] = f"""
SELECT c.cluster_id, c.cluster_name,
  CASE WHEN c.cluster_name IS NULL THEN 'invalid_key'
       WHEN EXISTS (SELECT 1 FROM ({TGT_CLUSTERS}) t WHERE t.cluster_name = c.cluster_name) THEN 'skip_existing'
       ELSE 'create' END AS decision
FROM ({CLUSTERS}) c"""

ORACLE["jn5_null_unregistered_profile"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS cluster_id,
  CASE WHEN r.arn IS NOT NULL THEN 'arn:aws:iam::profile/' || s_nationkey END AS profile_arn,
  'us-east-1a' AS zone_id, r.arn IS NULL AS profile_dropped
FROM supplier LEFT JOIN (SELECT DISTINCT arn FROM ({REGISTERED})) r
  ON r.arn = 'arn:aws:iam::profile/' || s_nationkey"""

ORACLE["ag3_distinct_keys"] = "SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL"
ORACLE["ag4_last_wins"] = ("SELECT p_name, max(p_partkey) AS p_partkey, arg_max(p_brand, p_partkey) "
                           "AS p_brand FROM part GROUP BY p_name")
ORACLE["ag5_first_match"] = ("SELECT p_name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) "
                             "AS p_brand FROM part GROUP BY p_name")

ORACLE["prj1_keep_known_fields"] = """
SELECT event_id, '{"event_id":' || event_id || CASE WHEN event_type IS NULL THEN ''
  ELSE ',"event_type":"' || event_type || '"' END || '}' AS doc FROM events"""
ORACLE["prj2_project_items"] = f"SELECT path, object_id FROM ({WS_ITEMS})"
ORACLE["prj3_drop_fields"] = ("SELECT o_orderkey AS job_id, '{\"name\":\"order-' || o_orderkey || '\"}' "
                              "AS settings_json FROM orders")
ORACLE["prj4_project_mounts"] = """
SELECT '/mnt/' || s_name AS path, 's3a://bucket-' || s_nationkey AS source,
  CASE WHEN s_suppkey % 2 = 0 THEN 'sse-s3' ELSE '' END AS encryptionType FROM supplier"""
ORACLE["flt1_running"] = "SELECT event_id FROM events WHERE event_type IS DISTINCT FROM 'error'"
ORACLE["flt2_split_automated"] = """
WITH n AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'mlflow-model-job-' || event_id || '-run-' || user_id
   WHEN event_id % 7 = 0 THEN 'job-' || event_id || '-run-' || user_id || 'x'
   ELSE 'job-' || event_id || '-run-' || user_id END AS cluster_name FROM events)
SELECT event_id, cluster_name, coalesce(regexp_matches(cluster_name, '^job-[0-9]+-run-[0-9]+$')
  OR starts_with(cluster_name, 'mlflow-model-'), false) AS automated FROM n"""
ORACLE["flt3_drop_builtin_admin"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 5 = 0 THEN 'admin' ELSE c_name END AS userName
FROM customer WHERE NOT (c_custkey % 5 = 0 AND c_custkey % 3 <> 0 AND c_custkey % 2 = 0)"""
ORACLE["flt4_filter_item_type"] = f"SELECT path, object_id FROM ({WS_ITEMS}) WHERE object_type = 'NOTEBOOK'"
ORACLE["flt5_prune_trash"] = f"SELECT * FROM ({WS_ITEMS}) WHERE {TRASH_KEEP}"
ORACLE["flt6_classify_path"] = f"""
WITH w AS (SELECT path, object_id, {PARTS.format(p='path')} AS parts FROM ({WS_ITEMS}))
SELECT path, object_id, len(parts) >= 2 AND parts[1] = 'Users' AS is_user_item,
  path IN ('/Users/', '/Users') OR (len(parts) = 2 AND parts[1] = 'Users') AS is_user_root,
  parts[2] AS "user" FROM w"""
ORACLE["flt8_drop_null_elements"] = """
SELECT c_custkey, to_json(list_filter([c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END,
  CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE 'x' END], lambda x: x IS NOT NULL AND x <> '')) :: VARCHAR AS names
FROM customer"""
ORACLE["flt9_files_only"] = f"SELECT path FROM ({WS_ITEMS}) WHERE object_type <> 'DIRECTORY'"
ORACLE["flt10_scope_subtree"] = f"""
SELECT *, '/Users/u1' AS root FROM ({WS_ITEMS}) WHERE starts_with(path, '/Users/u1/')
UNION ALL SELECT *, '/' AS root FROM ({WS_ITEMS}) WHERE path <> '/'"""

# ---------------------------------------------------------------------------
MEMBERS = """
SELECT 'seg-' || c_mktsegment AS group_id, c_mktsegment AS group_name, CAST(c_custkey AS VARCHAR) AS value,
  c_name AS display, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'scim/v2/Users/' || c_custkey END AS ref
FROM customer
UNION ALL
SELECT 'nat-' || c_nationkey, n_name, CAST(c_custkey AS VARCHAR), c_name, 'scim/v2/Users/' || c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT DISTINCT 'seg-' || c_mktsegment, c_mktsegment, 'nat-' || c_nationkey, n_name,
  'scim/v2/Groups/nat-' || c_nationkey
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
GROUPS_LISTED = """SELECT 'T-' || displayName AS id, displayName, 1 AS ord FROM (
    SELECT DISTINCT c_mktsegment AS displayName FROM customer
    UNION ALL SELECT n_name FROM nation WHERE n_regionkey <> 2)
  UNION ALL SELECT 'T2-' || n_name, n_name, 2 FROM nation WHERE n_regionkey = 0"""
GROUPS_TGT = f"SELECT displayName, arg_max(id, ord) AS id FROM ({GROUPS_LISTED}) GROUP BY displayName"
ENRICHED = f"""
SELECT m.group_name, m.value, m.display,
  CASE WHEN m.ref IS NULL THEN NULL WHEN contains(m.ref, 'scim/v2/Users') THEN 'user' ELSE 'group' END AS type,
  CASE WHEN m.ref IS NOT NULL AND contains(m.ref, 'scim/v2/Users') THEN u.userName END AS userName,
  CASE WHEN m.ref IS NULL THEN 'bad_ref'
       WHEN contains(m.ref, 'scim/v2/Users') AND u.userName IS NULL THEN 'unknown_user' ELSE 'ok' END AS status
FROM ({MEMBERS}) m LEFT JOIN ({SRC_USERS}) u
  ON m.ref IS NOT NULL AND contains(m.ref, 'scim/v2/Users') AND m.value = u.id"""
RESOLVED = f"""
SELECT e.group_name, e.value, e.type, coalesce(tu.id, tg.id) AS target_member_id, g.id AS target_group_id,
  CASE WHEN g.id IS NULL THEN 'unresolved_group' WHEN coalesce(tu.id, tg.id) IS NULL THEN 'unresolved_member'
       ELSE 'resolved' END AS status
FROM ({ENRICHED}) e
LEFT JOIN ({TGT_USERS}) tu ON e.type = 'user' AND e.userName = tu.userName
LEFT JOIN ({GROUPS_TGT}) tg ON e.type = 'group' AND e.display = tg.displayName
LEFT JOIN ({GROUPS_TGT}) g ON e.group_name = g.displayName
WHERE e.status = 'ok'"""
PATCH_URN = "urn:ietf:params:scim:api:messages:2.0:PatchOp"

ORACLE["flt7_member_kind"] = f"""
SELECT group_name, value, ref, CASE WHEN ref IS NULL THEN NULL WHEN contains(ref, 'scim/v2/Users') THEN 'user'
  ELSE 'group' END AS kind FROM ({MEMBERS})"""
ORACLE["jn6_enrich_members"] = f"SELECT group_name, value, type, userName, status FROM ({ENRICHED})"
ORACLE["jn7_resolve_members"] = f"SELECT * FROM ({RESOLVED})"
ORACLE["ag6_regroup_members"] = f"""
WITH r AS (SELECT DISTINCT target_group_id, target_member_id FROM ({RESOLVED}) WHERE status = 'resolved'),
b AS (SELECT *, (row_number() OVER (PARTITION BY target_group_id ORDER BY target_member_id) - 1) // 100
        AS batch FROM r)
SELECT target_group_id, CAST(batch AS BIGINT) AS batch, CAST(count(*) AS INTEGER) AS n_members,
  '{{"schemas":["{PATCH_URN}"],"Operations":[{{"op":"add","value":{{"members":['
  || string_agg('{{"value":"' || target_member_id || '"}}', ',' ORDER BY target_member_id) || ']}}}}]}}' AS patch
FROM b GROUP BY target_group_id, batch"""

ORACLE["hr1_reachable"] = f"""
SELECT path, object_id, CAST(len({PARTS.format(p='path')}) AS INTEGER) AS depth
FROM ({WS_ITEMS}) WHERE path <> '/' AND {TRASH_KEEP}"""
# Walked from the top down; what is never met is on a cycle or below one.
ORACLE["hr1_reachable_by_parent"] = """
WITH RECURSIVE t AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 30 <> 0 AND c_custkey <> 1 THEN c_custkey - 1
      WHEN c_custkey // 30 % 7 = 3 THEN c_custkey + 1000000000000
      WHEN c_custkey // 30 % 7 = 5 THEN c_custkey + 29 - c_custkey % 30 END AS parent, c_custkey % 41 = 9 AS trash
  FROM customer UNION ALL SELECT o_orderkey + 1000000000, o_custkey, false FROM orders),
w AS (
  SELECT t.id, t.parent, t.trash, 1 AS depth, t.parent IS NULL AS here FROM t LEFT JOIN t p ON t.parent = p.id
  WHERE p.id IS NULL
  UNION ALL SELECT t.id, t.parent, t.trash OR w.trash, w.depth + 1, w.here FROM w JOIN t ON t.parent = w.id)
SELECT t.id AS object_id, t.parent AS parent_id, CASE WHEN here AND NOT w.trash THEN depth END AS depth,
  CASE WHEN w.id IS NULL THEN 'cycle' WHEN NOT here THEN 'orphan' WHEN w.trash THEN 'pruned' ELSE 'reachable' END AS status
FROM t LEFT JOIN w ON t.id = w.id"""
ACLS = f"""SELECT '/' || CASE WHEN object_type = 'NOTEBOOK' THEN 'notebooks' ELSE 'directories' END
    || '/' || object_id AS object_id,
  '[{{"user_name":"' || regexp_extract(path, '^/Users/([^/]*)', 1) || '","permission_level":"' || l.lvl || '"}}]'
    AS access_control_list, l.ord AS ord
  FROM ({WS_ITEMS}) JOIN (VALUES ('CAN_MANAGE', 1::BIGINT, 2), ('CAN_READ', 2::BIGINT, 12)) l(lvl, ord, every)
  ON object_id % l.every = 0 WHERE object_type IN ('NOTEBOOK', 'DIRECTORY')"""
ORACLE["jn8_attach_acls"] = f"""
SELECT i.object_id, 'notebooks' AS kind, '/notebooks/' || i.object_id AS ref,
  '/permissions/notebooks/' || i.object_id AS permissions_path, a.access_control_list, a.ord AS acl_order,
  a.access_control_list IS NOT NULL AS has_acl
FROM ({WS_ITEMS}) i LEFT JOIN ({ACLS}) a ON a.object_id = '/notebooks/' || i.object_id
WHERE i.object_type = 'NOTEBOOK'"""
ORACLE["so2_union_acls"] = f"""
SELECT '/' || k.kind || '/' || i.object_id AS ref, k.kind, a.object_id IS NOT NULL AS has_acl, k.ord AS apply_order
FROM ({WS_ITEMS}) i
JOIN (VALUES ('NOTEBOOK', 'notebooks', 1), ('DIRECTORY', 'directories', 2)) k(t, kind, ord) ON i.object_type = k.t
LEFT JOIN ({ACLS}) a ON a.object_id = '/' || k.kind || '/' || i.object_id"""
HOMES = f"""SELECT DISTINCT {PARTS.format(p='path')}[2] AS home FROM ({WS_TARGET})
  WHERE object_type = 'DIRECTORY' AND len({PARTS.format(p='path')}) = 2 AND {PARTS.format(p='path')}[1] = 'Users'"""
ROUTE = f"""
WITH i AS (SELECT path, CASE WHEN len({PARTS.format(p='path')}) >= 2 AND {PARTS.format(p='path')}[1] = 'Users'
             THEN {PARTS.format(p='path')}[2] END AS "user"
           FROM ({WS_ITEMS}) WHERE object_type = 'NOTEBOOK')
SELECT i.path, i."user", CASE WHEN i."user" IS NULL OR h.home IS NOT NULL THEN 'upload'
    WHEN {{arch}} THEN 'archive' ELSE 'blocked' END AS action,
  CASE WHEN i."user" IS NOT NULL AND h.home IS NULL AND {{arch}} THEN regexp_replace(i.path, '^(/*)Users', '\\1Archive')
    ELSE i.path END AS upload_path, {{arch}} AS archive_missing
FROM i LEFT JOIN ({HOMES}) h ON i."user" = h.home"""
ORACLE["jn9_route_missing_users"] = ("SELECT * FROM (" + ROUTE.replace("{arch}", "false")
                                     + ")\nUNION ALL\nSELECT * FROM (" + ROUTE.replace("{arch}", "true") + ")")
OUTCOMES = """SELECT '/Users/u' || o_custkey || CASE WHEN o_orderkey % 10 = 0 THEN '/Trash/' ELSE '//d/' END
    || 'n' || o_orderkey AS path, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS n_bytes
  FROM orders WHERE o_orderkey % 3 = 1"""
ORACLE["jn12_reconcile_artifacts"] = f"""
WITH m AS (SELECT DISTINCT rtrim(path) AS path FROM ({WS_ITEMS}) WHERE object_type = 'NOTEBOOK'),
a AS (SELECT path, max(n_bytes) AS n_bytes FROM ({OUTCOMES}) WHERE o_orderstatus = 'F' GROUP BY path),
f AS (SELECT path, max('RESOURCE_DOES_NOT_EXIST') AS error_code FROM ({OUTCOMES}) WHERE o_orderstatus = 'P'
      GROUP BY path)
SELECT m.path, a.n_bytes, f.error_code,
  CASE WHEN a.n_bytes IS NOT NULL THEN 'downloaded' WHEN f.error_code IS NOT NULL THEN 'failed'
       ELSE 'missing' END AS status
FROM m LEFT JOIN a ON m.path = a.path LEFT JOIN f ON m.path = f.path"""
ORACLE["jn13_home_exists"] = f"""
WITH u AS (SELECT DISTINCT {PARTS.format(p='path')}[2] AS "user" FROM ({WS_ITEMS})
           WHERE len({PARTS.format(p='path')}) >= 2 AND {PARTS.format(p='path')}[1] = 'Users')
SELECT u."user", EXISTS (SELECT 1 FROM ({HOMES}) h WHERE h.home = u."user") AS home_exists FROM u"""
EXPORTED_USERS = f"""SELECT DISTINCT {PARTS.format(p='path')}[2] AS u FROM ({{items}})
  WHERE object_type = 'NOTEBOOK' AND len({PARTS.format(p='path')}) >= 3 AND {PARTS.format(p='path')}[1] = 'Users'"""
COUNTS = f"""SELECT (SELECT count(*) FROM ({EXPORTED_USERS.format(items=WS_ITEMS)})) AS exported_users,
  (SELECT count(*) FROM ({HOMES})) AS current_users"""
ORACLE["ag2_count_user_homes"] = COUNTS
ORACLE["ag8_readiness_gate"] = f"""
WITH c AS ({COUNTS})
SELECT exported_users, current_users, CASE WHEN current_users = 0 THEN 'NO_USERS'
  WHEN current_users < exported_users THEN 'MISSING_USERS' ELSE 'OK' END AS status, false AS archive_missing FROM c
UNION ALL SELECT exported_users, current_users, CASE WHEN current_users = 0 THEN 'NO_USERS' ELSE 'OK' END,
  true FROM c
UNION ALL SELECT exported_users, 0, 'NO_USERS', true FROM c"""

TABLE_NAMES = """SELECT CASE WHEN p_partkey % 17 = 0 THEN 'db' || (p_partkey % 20) || '.t' || p_partkey || '.x'
  ELSE 'db' || (p_partkey % 20) || '.t' || p_partkey END AS "table", p_size FROM part"""
FAILED = f"SELECT \"table\" FROM ({TABLE_NAMES}) WHERE p_size % 3 = 0"
ATTEMPTS = """SELECT 'db' || (l_partkey % 20) || '.t' || l_partkey AS "table", 'arn:role/R' || n_regionkey AS role,
  n_regionkey AS ord, (l_orderkey + l_linenumber) % 29 = 0 AS ok
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
FIRST_OK = f"""SELECT "table", arg_min(role, ord) AS role FROM ({ATTEMPTS}) WHERE ok GROUP BY "table" """
RETRY = f"""
SELECT f."table", CASE WHEN NOT regexp_matches(f."table", '^[^.]+\\.[^.]+$') THEN 'invalid'
  WHEN r.role IS NOT NULL THEN 'resolved' ELSE 'remaining' END AS outcome,
  CASE WHEN regexp_matches(f."table", '^[^.]+\\.[^.]+$') THEN r.role END AS role
FROM ({FAILED}) f LEFT JOIN ({FIRST_OK}) r ON f."table" = r."table" """
ORACLE["jn11_retry_matrix"] = RETRY
ORACLE["ag7_failure_summary"] = f"""
WITH r AS ({RETRY}),
d AS (SELECT 'db' || (p_partkey % 20) AS db FROM part
      UNION ALL SELECT split_part("table", '.', 1) FROM r WHERE outcome IN ('resolved', 'remaining'))
SELECT (SELECT count(DISTINCT db) FROM d) AS attempted_databases,
  (SELECT count(*) FROM ({FAILED})) AS failed_before,
  (SELECT count(*) FROM r WHERE outcome = 'remaining') AS failed_after"""
ORACLE["wn1_assign_batches"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month,
  CAST((row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) - 1) // 100 AS BIGINT)
    AS batch FROM orders"""
ROLES = ("SELECT DISTINCT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS \"user\", "
         "o_orderpriority AS role FROM orders WHERE o_orderkey % 2 = {r}")
ORACLE["so1_role_delta"] = f"{ROLES.format(r=0)} EXCEPT {ROLES.format(r=1)}"
ORACLE["so3_unexpected_fields"] = """
SELECT field, count(*) AS n FROM (
  SELECT 'user_id' AS field FROM events WHERE user_id IS NOT NULL
  UNION ALL SELECT 'big' FROM events WHERE value > 50
  UNION ALL SELECT 'props' FROM events WHERE props IS NOT NULL) GROUP BY field"""
ORACLE["ag1_row_count"] = "SELECT count(*) AS n FROM events"
VERSIONS = """SELECT p_size || '.' || (p_partkey % 10) || '.x-' || CASE WHEN p_partkey % 3 = 0 THEN 'cpu-ml-'
  ELSE '' END || 'scala2.12' AS key, p_partkey AS ord FROM part"""
ORACLE["st1_latest_version"] = f"""
WITH v AS ({VERSIONS}), c AS (SELECT * FROM v WHERE substr(split_part(key, '-', 2), 1, 5) = 'scala')
SELECT * FROM (SELECT key, ord, 'string' AS mode FROM c ORDER BY key DESC, ord LIMIT 1)
UNION ALL
SELECT * FROM (SELECT key, ord, 'numeric' AS mode FROM c
  ORDER BY TRY_CAST(split_part(key, '.', 1) AS INTEGER) DESC, TRY_CAST(split_part(key, '.', 2) AS INTEGER) DESC,
  key DESC, ord LIMIT 1)"""
ORACLE["jn10_cluster_libraries"] = """
SELECT s_suppkey AS cluster_id, coalesce(n, 0) AS n_libraries FROM supplier
LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_suppkey) l
  ON s_suppkey = l_suppkey"""

# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------
WS_PARTS = f"SELECT *, {PARTS.format(p='path')} AS parts FROM ({WS_ITEMS})"
ORACLE["sc1_archive_path"] = f"""
SELECT path, regexp_replace(path, '^(/*)Users', '\\1Archive') AS archive_path FROM ({WS_PARTS})
WHERE len(parts) >= 2 AND parts[1] = 'Users'"""
ORACLE["sc2_dir_base"] = f"""
SELECT path, CASE WHEN regexp_matches(regexp_extract(path, '^(.*/)', 1), '^/+$') THEN regexp_extract(path, '^(.*/)', 1)
  ELSE regexp_replace(regexp_extract(path, '^(.*/)', 1), '/+$', '') END AS dir_name,
  regexp_extract(path, '([^/]*)$', 1) AS base_name FROM ({WS_ITEMS})"""
ORACLE["sc3_strip_ext"] = f"SELECT path || '.dbc' AS artifact, path FROM ({WS_ITEMS})"
ORACLE["sc4_split_qualified"] = f"""
SELECT "table", split_part("table", '.', 1) AS db, split_part("table", '.', 2) AS table_name,
  coalesce(regexp_matches("table", '^[^.]+\\.[^.]+$'), false) AS ok FROM ({TABLE_NAMES})"""
ORACLE["sc5_base64"] = """
SELECT doc_id, md5(to_base64(encode(text))) AS b64_md5, CAST(length(to_base64(encode(text))) AS INTEGER) AS b64_len,
  decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok FROM documents"""
ORACLE["sc6_to_from_doc"] = """
SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
  AS doc, event_type AS parsed_type, user_id AS parsed_user FROM events"""
ORACLE["sc7_parse_name_list"] = ("SELECT c_custkey, CAST(2 AS INTEGER) AS n, c_mktsegment AS first, "
                                 "c_name AS second FROM customer")
ORACLE["sc8_upsert_tag"] = f"""
SELECT cluster_id, CASE WHEN team IS NOT NULL THEN '{{"team":"' || team || '","OriginalCreator":"' || creator || '"}}'
  ELSE '{{"OriginalCreator":"' || creator || '"}}' END AS tags FROM ({CLUSTERS})"""
ORACLE["sc9_major_version"] = f"""
SELECT key, ord, TRY_CAST(split_part(key, '.', 1) AS INTEGER) AS major,
  coalesce(TRY_CAST(split_part(key, '.', 1) AS INTEGER) >= 7, false) AS at_least_7 FROM ({VERSIONS})"""
ORACLE["sc10_route_payload"] = """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes,
  CASE WHEN length(text) IS NULL OR length(text) <= 0 THEN 'error' WHEN length(text) > 2048 THEN 'file'
       ELSE 'inline' END AS export_route,
  CASE WHEN octet_length(encode(text)) IS NULL OR octet_length(encode(text)) <= 0 THEN 'error'
       WHEN octet_length(encode(text)) > 1024 THEN 'upload' ELSE 'inline' END AS import_route
FROM documents"""
ORACLE["sc11_clean_pool_cluster"] = f"""
SELECT c.cluster_id, m.new_id AS instance_pool_id,
  CASE WHEN m.new_id IS NULL THEN 'unresolved' ELSE 'mapped' END AS pool_status,
  NULL::VARCHAR AS node_type_id, NULL::BOOLEAN AS enable_elastic_disk,
  CASE WHEN c.arn IS NOT NULL THEN '{{"instance_profile_arn":"' || c.arn || '"}}' END AS aws_attributes,
  c.creator AS original_creator
FROM ({CLUSTERS}) c LEFT JOIN ({POOL_MAP}) m ON c.instance_pool_id = m.old_id
WHERE c.instance_pool_id IS NOT NULL"""
ROLE_DELTA = f"{ROLES.format(r=0)} EXCEPT {ROLES.format(r=1)}"
ROLE_PATCHES = f"""
SELECT "user", CAST(0 AS BIGINT) AS batch, CAST(count(*) AS INTEGER) AS n_roles,
  '{{"schemas":["{PATCH_URN}"],"Operations":[{{"op":"add","path":"roles","value":['
  || string_agg('{{"value":"' || role || '"}}', ',' ORDER BY role) || ']}}]}}' AS patch
FROM ({ROLE_DELTA}) GROUP BY "user" """
ORACLE["sc12_patch_payload"] = ROLE_PATCHES
AZURE_DEFAULT_JSON = ('{"spark_version":"6.2.x-scala2.11","node_type_id":"Standard_DS3_v2",'
                      '"num_workers":8,"spark_env_vars":{"PYSPARK_PYTHON":"/usr/bin/python3"}}')
ORACLE["sc13_default_cluster"] = f"""
WITH m AS ({CLUSTER_MAP}), j AS ({JOBS}),
r AS (SELECT j.job_id FROM j LEFT JOIN m ON j.ecid = m.old_id WHERE j.ecid IS NOT NULL AND m.new_id IS NULL)
SELECT job_id, 'aws' AS cloud, '{AWS_DEFAULT_JSON}' AS new_cluster FROM r
UNION ALL SELECT job_id, 'azure', '{AZURE_DEFAULT_JSON}' FROM r"""
ORACLE["sc14_wrap_values"] = f"""
SELECT "user", '[' || string_agg('{{"value":"' || role || '"}}', ',' ORDER BY role) || ']' AS roles_json
FROM ({ROLES.replace(' WHERE o_orderkey % 2 = {r}', '')}) GROUP BY "user" """
ORACLE["sc15_object_ref"] = f"""
WITH k AS (SELECT CASE WHEN object_type = 'NOTEBOOK' THEN 'notebooks' ELSE 'directories' END AS kind, object_id
           FROM ({WS_ITEMS}) WHERE object_type IN ('NOTEBOOK', 'DIRECTORY'))
SELECT '/' || kind || '/' || object_id AS ref, '/permissions/' || kind || '/' || object_id AS permissions_path,
  kind, CAST(object_id AS VARCHAR) AS id FROM k"""
TABLE_DEFS = """
SELECT 'db' || (p_partkey % 20) AS db, 't' || p_partkey AS "table", p_size % 20 + 1 AS cols,
  CASE WHEN p_size % 3 = 0 THEN 'CSV' WHEN p_size % 3 = 1 THEN 'PARQUET' ELSE 'JSON' END AS prov,
  CASE WHEN p_partkey % 2 = 0 THEN '/data/' || p_partkey ELSE '' END AS loc,
  'CREATE TABLE `db' || (p_partkey % 20) || '`.`t' || p_partkey || '` ('
  || array_to_string(list_transform(range(1, p_size % 20 + 2), lambda i:
       CASE WHEN p_partkey % 2 = 0 THEN '`' ELSE '' END || 'c' || i
       || CASE WHEN p_partkey % 2 = 0 THEN '`' ELSE '' END || ' '
       || CASE i % 5 WHEN 0 THEN 'INT' WHEN 1 THEN 'STRING COMMENT ' || chr(39) || 'a, `x` INT) COMMENT' || chr(39)
          WHEN 2 THEN 'DECIMAL(10,2) COMMENT ' || chr(39) || 'x' || chr(39) WHEN 3 THEN 'STRUCT<a:INT,b:ARRAY<STRING>>'
          ELSE 'MAP<STRING,DECIMAL(5,1)>' END), ', ')
  || ')' || chr(10) || 'USING ' || CASE WHEN p_size % 3 = 0 THEN 'CSV' WHEN p_size % 3 = 1 THEN 'PARQUET'
       ELSE 'JSON' END
  || CASE WHEN p_partkey % 2 = 0 THEN chr(10) || 'OPTIONS (' || chr(10) || '  `header` ''true'',' || chr(10)
       || '  path ' || chr(39) || '/data/' || p_partkey || chr(39) || chr(10) || ')' ELSE '' END
  || chr(10) || 'COMMENT ' || chr(39) || repeat(p_name, p_size) || chr(39) AS ddl
FROM part"""
# The facts are known from how the definitions were made; nothing is parsed.
DDL_FACTS = "prov AS provider, loc AS location, CAST(cols AS INTEGER) AS n_columns"
ORACLE["sc16_ddl_facts"] = f"SELECT db, \"table\", {DDL_FACTS} FROM ({TABLE_DEFS})"
ORACLE["sc16_ddl_columns"] = f"""
SELECT db, "table", i, 'c' || (i + 1) AS name, CASE (i + 1) % 5 WHEN 0 THEN 'INT' WHEN 1 THEN 'STRING'
  WHEN 2 THEN 'DECIMAL(10,2)' WHEN 3 THEN 'STRUCT<a:INT,b:ARRAY<STRING>>' ELSE 'MAP<STRING,DECIMAL(5,1)>' END AS type
FROM (SELECT db, "table", unnest(range(cols)) AS i FROM ({TABLE_DEFS}))"""
ORACLE["sc17_clean_key"] = "SELECT c_custkey, c_name AS \"user\", 'db' || c_nationkey AS db FROM customer"

# ---------------------------------------------------------------------------
# Composite plans
# ---------------------------------------------------------------------------
def _plan(kind, key, action, target_id="NULL::VARCHAR", n_items="0", payload="NULL::VARCHAR",
          stage=0, target_ref="NULL::VARCHAR"):
    return (f"'{kind}' AS kind, CAST({key} AS VARCHAR) AS key, {action} AS action, "
            f"CAST({target_id} AS VARCHAR) AS target_id, CAST({target_ref} AS VARCHAR) AS target_ref, "
            f"CAST({n_items} AS BIGINT) AS n_items, "
            f"CAST({payload} AS VARCHAR) AS payload, {stage} AS stage")


# Users missing on the target are created first, so their roles follow.
ORACLE["pl1_plan_users"] = f"""
SELECT {_plan('user', 's.userName', "CASE WHEN t.userName IS NULL THEN 'create' ELSE 'skip_existing' END",
              payload="""CASE WHEN t.userName IS NULL THEN '{"userName":"' || s.userName || '"}' END""",
              stage=2)}
FROM ({SRC_USERS}) s LEFT JOIN (SELECT DISTINCT userName FROM ({TGT_USERS})) t ON s.userName = t.userName
WHERE s.userName IS NOT NULL
UNION ALL
SELECT {_plan('user_roles', 'p."user"', """CASE WHEN t.id IS NOT NULL THEN 'add_roles'
                WHEN s.userName IS NOT NULL THEN 'add_roles_after_create' ELSE 'unknown_user' END""",
              't.id', 'p.n_roles', 'p.patch', 5,
              """CASE WHEN t.id IS NULL AND s.userName IS NOT NULL THEN 'user:' || p."user" END""")}
FROM ({ROLE_PATCHES}) p LEFT JOIN ({TGT_USERS}) t ON p."user" = t.userName
LEFT JOIN (SELECT DISTINCT userName FROM ({SRC_USERS})) s ON p."user" = s.userName"""

GROUP_PATCHES = ORACLE["ag6_regroup_members"]
GROUPS_SRC = """SELECT DISTINCT 'seg-' || c_mktsegment AS id, c_mktsegment AS displayName FROM customer
  UNION ALL SELECT 'nat-' || n_nationkey, n_name FROM nation"""
GROUP_ROLES = """SELECT DISTINCT c_mktsegment AS group_name, o_orderpriority AS role
  FROM orders JOIN customer ON o_custkey = c_custkey"""
# Members of groups, or in groups, that are created first: references by name.
LATER = f"""
WITH l AS (SELECT DISTINCT e.group_name, g.id AS gid,
    coalesce(tu.id, tg.id, CASE WHEN e.type = 'user' THEN 'user:' || e.userName ELSE 'group:' || e.display END)
      AS token, g.id IS NULL OR coalesce(tu.id, tg.id) IS NULL AS later
  FROM ({ENRICHED}) e
  LEFT JOIN ({TGT_USERS}) tu ON e.type = 'user' AND e.userName = tu.userName
  LEFT JOIN ({GROUPS_TGT}) tg ON e.type = 'group' AND e.display = tg.displayName
  LEFT JOIN ({GROUPS_TGT}) g ON e.group_name = g.displayName
  WHERE e.status = 'ok'),
b AS (SELECT *, (row_number() OVER (PARTITION BY group_name ORDER BY token) - 1) // 100 AS batch
      FROM l WHERE later)
SELECT group_name, gid, CAST(batch AS BIGINT) AS batch, count(*) AS n,
  '{{"schemas":["{PATCH_URN}"],"Operations":[{{"op":"add","value":{{"members":['
  || string_agg('{{"value":"' || token || '"}}', ',' ORDER BY token) || ']}}}}]}}' AS patch
FROM b GROUP BY group_name, gid, batch"""
ORACLE["pl2_plan_groups"] = f"""
SELECT {_plan('group', 'g.displayName', "CASE WHEN t.id IS NULL THEN 'create' ELSE 'skip_existing' END",
              stage=3)}
FROM ({GROUPS_SRC}) g LEFT JOIN ({GROUPS_TGT}) t ON g.displayName = t.displayName
UNION ALL
SELECT {_plan('group_members', "target_group_id || '#' || batch", "'add_members'", 'target_group_id',
              'n_members', 'patch', 3)}
FROM ({GROUP_PATCHES})
UNION ALL
SELECT {_plan('group_members', "group_name || '#' || batch", "'add_members_after_create'", 'gid', 'n', 'patch', 3,
              "CASE WHEN gid IS NULL THEN 'group:' || group_name END")}
FROM ({LATER})
UNION ALL
SELECT {_plan('group_members', "group_name || '#' || value", 'status', stage=3)}
FROM ({ENRICHED}) WHERE status <> 'ok'
UNION ALL
SELECT {_plan('group_roles', 'r.group_name', """CASE WHEN t.id IS NULL THEN 'add_roles_after_create'
                ELSE 'add_roles' END""", 't.id', 'r.n', 'r.patch', 4,
              "CASE WHEN t.id IS NULL THEN 'group:' || r.group_name END")}
FROM (SELECT group_name, count(*) AS n,
        '{{"schemas":["{PATCH_URN}"],"Operations":[{{"op":"add","path":"roles","value":['
        || string_agg('{{"value":"' || role || '"}}', ',' ORDER BY role) || ']}}]}}' AS patch
      FROM ({GROUP_ROLES}) GROUP BY group_name) r
LEFT JOIN ({GROUPS_TGT}) t ON r.group_name = t.displayName"""

CLUSTER_REST = (',"init_scripts":[{"dbfs":{"destination":"dbfs:/i.sh","n":1.10,"n":2}}],"cluster_log_conf":'
                '{"dbfs":{"destination":"dbfs:/logs"}}')
# A pool that is missing on the target is created first when it was exported.
DECIDED = f"""
SELECT c.*, m.new_id, s.instance_pool_name AS pool_name,
  CASE WHEN automated THEN 'skip_automated' WHEN exists_tgt THEN 'skip_existing'
       WHEN c.instance_pool_id IS NOT NULL AND s.instance_pool_id IS NULL THEN 'unresolved_pool'
       WHEN pinned THEN 'create_and_pin' ELSE 'create' END AS action,
  NOT automated AND NOT exists_tgt AS work
FROM (SELECT c.*, coalesce(regexp_matches(cluster_name, '^job-[0-9]+-run-[0-9]+$')
        OR starts_with(cluster_name, 'mlflow-model-'), false) AS automated,
        CASE WHEN arn IN (SELECT arn FROM ({REGISTERED})) THEN arn END AS kept_arn,
        cluster_name IN (SELECT cluster_name FROM ({TGT_CLUSTERS})) AS exists_tgt
      FROM ({CLUSTERS}) c) c
LEFT JOIN ({POOL_MAP}) m ON c.instance_pool_id = m.old_id
LEFT JOIN ({POOLS_SRC}) s ON c.instance_pool_id = s.instance_pool_id"""
# Allow-listed keys in their order and as written; rewritten keys move to the end.
CLUSTER_PAYLOAD = f"""'{{"cluster_name":"' || cluster_name || '","spark_version":"' || (c_nationkey % 12 + 1) || '.'
  || (c_custkey % 4) || '.x-scala2.12"'
  || CASE WHEN instance_pool_id IS NULL THEN ',"node_type_id":"i3.xlarge","driver_node_type_id":"i3.xlarge"' ELSE '' END
  || ',"num_workers":' || c_nationkey || ',"autotermination_minutes":60'
  || CASE WHEN instance_pool_id IS NULL THEN ',"enable_elastic_disk":' || (c_custkey % 2 = 1) ELSE '' END
  || CASE WHEN pinned THEN ',"pinned_by_user_name":"admin"' ELSE '' END || '{CLUSTER_REST}'
  || ',"custom_tags":{{' || coalesce('"team":"' || team || '",', '') || '"OriginalCreator":"' || creator || '"}}'
  || CASE WHEN instance_pool_id IS NULL
       THEN ',"aws_attributes":{{"availability":"SPOT_WITH_FALLBACK","ebs_volume_size":100,'
         || '"ebs_volume_type":"GENERAL_PURPOSE_SSD","first_on_demand":1'
         || coalesce(',"instance_profile_arn":"' || kept_arn || '"', '') || ',"zone_id":"us-east-1a"}}'
       ELSE coalesce(',"aws_attributes":{{"instance_profile_arn":"' || kept_arn || '"}}', '')
         || coalesce(',"instance_pool_id":"' || new_id || '"', '') END || '}}'"""
ORACLE["pl3_plan_clusters"] = f"""
SELECT {_plan('cluster', 'cluster_id', 'action', 'CASE WHEN work THEN new_id END',
              payload=f'CASE WHEN work THEN {CLUSTER_PAYLOAD} END', stage=7,
              target_ref="CASE WHEN work AND new_id IS NULL THEN 'pool:' || pool_name END")}
FROM ({DECIDED})"""

# Jobs: an exported cluster that the plan creates is rewired after that.
SETTINGS_REST = ""","libraries":[{"jar":"dbfs:/x.jar"},{"pypi":{"package":"p"}}],"email_notifications":""" \
    """{"on_failure":["a@example.com"]},"max_retries":null,"spark_jar_task":""" \
    """{"main_class_name":"m.M","parameters":["1",2,1.50]},"twice":{"k":1,"k":{"k":2}},""" \
    """"big":12345678901234567890123456789012345678901234567890, "sp" : [ 1.10 ,"}{\\"" ]"""
PLANNED_JOBS = f"""
SELECT j.job_id, j.name, j.ecid, m.new_id, d.cluster_name AS later_name,
  CASE WHEN j.ecid IS NULL THEN 'new_cluster' WHEN m.new_id IS NOT NULL THEN 'rewired'
       WHEN d.cluster_id IS NOT NULL THEN 'rewire_after_create' ELSE 'reset_default' END AS outcome,
  '{{"name":"' || j.name || '",' AS head,
  '"schedule":{{"quartz_cron_expression":"0 0 ' || (j.job_id % 24)
    || ' * * ?","timezone_id":"UTC"}}{SETTINGS_REST}}}' AS body
FROM ({JOBS}) j
LEFT JOIN (SELECT c.cluster_id AS old_id, t.cluster_id AS new_id FROM ({CLUSTERS}) c
           JOIN ({TGT_CLUSTERS}) t ON c.cluster_name = t.cluster_name) m ON j.ecid = m.old_id
LEFT JOIN (SELECT cluster_id, cluster_name FROM ({DECIDED}) WHERE action IN ('create', 'create_and_pin')) d
  ON j.ecid = d.cluster_id"""
ORACLE["pl4_plan_jobs"] = f"""
SELECT job_id, name AS job_name, CASE WHEN job_id % 1024 = 7 THEN 'malformed_document' ELSE 'create' END AS action,
  outcome, ecid AS old_cluster_id,
  CASE WHEN outcome = 'rewired' THEN new_id END AS new_cluster_id,
  CASE WHEN outcome = 'rewire_after_create' THEN 'cluster:' || later_name END AS target_ref,
  CASE WHEN outcome = 'reset_default' THEN '6.1.x-scala2.11' END AS new_cluster_version,
  CASE WHEN job_id % 1024 <> 7 THEN
    head || CASE outcome WHEN 'rewired' THEN '"existing_cluster_id":"' || new_id || '",'
                 WHEN 'reset_default' THEN '"new_cluster":{AWS_DEFAULT_JSON},' ELSE '' END || body END AS settings_json,
  8 AS stage
FROM ({PLANNED_JOBS})"""

# Folders are tested by the path they get, so archive folders are created.
USER_ROOT = f"({{p}} IN ('/Users/', '/Users') OR (len({PARTS}) = 2 AND {PARTS}[1] = 'Users'))"
WS_HOME_ROUTE = f"""
WITH listed AS (SELECT *, {PARTS.format(p='path')} AS parts FROM ({WS_ITEMS}) WHERE {{scope}} AND {TRASH_KEEP}),
work AS (SELECT *, CASE WHEN len(parts) >= 2 AND parts[1] = 'Users' THEN parts[2] END AS u FROM listed
         WHERE object_type IN ('NOTEBOOK', 'DIRECTORY')),
r AS (SELECT w.*, w.u IS NOT NULL AND h.home IS NULL AS missing FROM work w LEFT JOIN ({HOMES}) h ON w.u = h.home),
o AS (SELECT path, object_type,
  CASE WHEN object_type = 'DIRECTORY' THEN CASE WHEN missing AND NOT {{arch}} THEN 'blocked' ELSE 'mkdir' END
       WHEN NOT missing THEN 'upload' WHEN {{arch}} THEN 'archive' ELSE 'blocked' END AS action,
  CASE WHEN missing AND {{arch}} THEN regexp_replace(path, '^(/*)Users', '\\1Archive') ELSE path END
    AS upload_path, 9 AS stage
FROM r)
SELECT * FROM o WHERE NOT (object_type = 'DIRECTORY' AND {USER_ROOT.format(p='upload_path')})"""
ORACLE["pl5_plan_workspace"] = WS_HOME_ROUTE.replace("{scope}", "path <> '/'").replace("{arch}", "true")
ORACLE["pl9_plan_home"] = " UNION ALL ".join(
    "SELECT * FROM (" + WS_HOME_ROUTE.replace("{scope}", f"starts_with(path, '/Users/{u}/')")
    .replace("{arch}", arch) + ")" for u, arch in (("u1", "false"), ("u4", "true")))
PROFILES_SRC = "SELECT 'arn:aws:iam::profile/' || n_nationkey AS arn FROM nation"
ORACLE["pl6_plan_profiles_pools"] = f"""
SELECT {_plan('instance_profile', 's.arn', "CASE WHEN r.arn IS NULL THEN 'create' ELSE 'skip_existing' END",
              stage=1)}
FROM ({PROFILES_SRC}) s LEFT JOIN ({REGISTERED}) r ON s.arn = r.arn
UNION ALL
SELECT {_plan('instance_pool', 's.instance_pool_name',
              "CASE WHEN t.instance_pool_name IS NULL THEN 'create' ELSE 'skip_existing' END",
              payload="""CASE WHEN t.instance_pool_name IS NULL THEN '{"instance_pool_id":"' || s.instance_pool_id
                || '","instance_pool_name":"' || s.instance_pool_name || '","min_idle_instances":'
                || s.n_regionkey || ',"custom":{"b":[1,null],"a":1.0}}' END""", stage=6)}
FROM ({POOLS_SRC}) s LEFT JOIN ({POOLS_TGT}) t ON s.instance_pool_name = t.instance_pool_name"""
ORACLE["pl7_plan_acls"] = f"""
SELECT '/' || k.kind || '/' || i.object_id AS ref, '/permissions/' || k.kind || '/' || i.object_id
  AS permissions_path, a.access_control_list, a.ord AS acl_order, k.ord AS apply_order,
  t.object_id AS target_object_id, '/permissions/' || k.kind || '/' || t.object_id AS target_permissions_path,
  10 AS stage
FROM ({WS_ITEMS}) i
JOIN (VALUES ('NOTEBOOK', 'notebooks', 1), ('DIRECTORY', 'directories', 2)) k(t, kind, ord) ON i.object_type = k.t
LEFT JOIN ({ACLS}) a ON a.object_id = '/' || k.kind || '/' || i.object_id
LEFT JOIN ({WS_TARGET}) t ON t.path = i.path AND t.object_type = i.object_type"""
ORACLE["pl8_plan_tables"] = f"""
SELECT NULL::VARCHAR AS "table", db, 'create_if_absent' AS action, NULL::VARCHAR AS import_route,
  NULL::VARCHAR AS role, NULL::VARCHAR AS payload, NULL::BIGINT AS n_parts, NULL::VARCHAR AS payload_md5, 11 AS stage
FROM (SELECT db FROM ({TABLE_DEFS}) UNION SELECT split_part("table", '.', 1) FROM ({RETRY})
      WHERE outcome = 'resolved')
UNION ALL
SELECT db || '.' || "table" AS "table", db,
  CASE WHEN ddl IS NULL OR length(ddl) <= 0 THEN 'failed' ELSE 'create' END AS action,
  CASE WHEN octet_length(encode(ddl)) IS NULL OR octet_length(encode(ddl)) <= 0 THEN 'error'
       WHEN octet_length(encode(ddl)) > 1024 THEN 'upload' ELSE 'inline' END AS import_route,
  NULL::VARCHAR AS role, CASE WHEN octet_length(encode(ddl)) <= 1024 THEN ddl END,
  CASE WHEN octet_length(encode(ddl)) > 1024 THEN CAST(ceil(octet_length(encode(ddl)) / 750000.0) AS BIGINT) END,
  md5(ddl), 12 AS stage
FROM ({TABLE_DEFS})
UNION ALL
SELECT "table", CASE WHEN outcome <> 'invalid' THEN split_part("table", '.', 1) END AS db,
  CASE outcome WHEN 'resolved' THEN 'create_after_retry' WHEN 'remaining' THEN 'failed' ELSE 'invalid_name' END,
  NULL::VARCHAR, role, NULL::VARCHAR, NULL::BIGINT, NULL::VARCHAR, 12
FROM ({RETRY})"""
# The definitions are plain ASCII, so their bytes are their characters.
ORACLE["pl8_upload_parts"] = f"""
SELECT "table", db, part, n_parts, to_base64(encode(substring(ddl, part * 1000 + 1, 1000))) AS content,
  CAST(length(substring(ddl, part * 1000 + 1, 1000)) AS BIGINT) AS n_bytes, md5(ddl) AS md5
FROM (SELECT db || '.' || "table" AS "table", db, ddl, n_parts, unnest(range(n_parts)) AS part
      FROM (SELECT *, CAST(ceil(length(ddl) / 1000.0) AS BIGINT) AS n_parts FROM ({TABLE_DEFS}) WHERE length(ddl) > 1024))"""
ORACLE["pl10_plan_cleanup"] = f"""
SELECT 'cluster' AS kind, cluster_id AS key, 'unpin' AS action, 101 AS stage FROM ({TGT_CLUSTERS})
UNION ALL SELECT 'cluster', cluster_id, 'permanent_delete', 102 FROM ({TGT_CLUSTERS})
UNION ALL SELECT 'job', CAST(o_orderkey AS VARCHAR), 'delete', 103 FROM orders"""

# ---------------------------------------------------------------------------
# Sources and sinks (the oracle reads the tables the round trip started from)
# ---------------------------------------------------------------------------
ORACLE["src1_read_jsonl"] = """
SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id,
  CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
  CASE WHEN event_id % 97 <> 0 THEN event_type END AS event_type, event_id % 97 = 0 AS is_corrupt
FROM events"""
ORACLE["snk5_artifact_tree"] = """
SELECT '/Users/u' || c_custkey || '/d/n %20' || (c_custkey % 3) AS path, CAST(length(c_name) AS BIGINT) AS n_bytes,
  md5(c_name) AS content_md5
FROM customer"""
ORACLE["src2_read_json_docs"] = f"""
SELECT target_group_id AS "group", CAST(sum(n_members) AS BIGINT) AS n_members, count(*) AS n_docs
FROM ({GROUP_PATCHES}) GROUP BY target_group_id"""
ORACLE["src3_read_definition_tree"] = f"""
SELECT db, "table", CAST(length(ddl) AS INTEGER) AS n_chars, md5(ddl) AS ddl_md5 FROM ({TABLE_DEFS})"""
ORACLE["src5_unwrap_listing"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'objects' AS listing
FROM events, (VALUES (1), (2)) t(x) WHERE event_type = 'click'
UNION ALL
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT), 'elements' FROM events WHERE event_type = 'view'"""
ORACLE["snk1_write_jsonl"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLE["snk2_append_jsonl"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN user_id + 1000 ELSE user_id END AS user_id, event_type
FROM events"""
ORACLE["snk3_write_by_key"] = f"""
SELECT db, "table", CAST(length(ddl) AS INTEGER) AS n_chars FROM ({TABLE_DEFS})"""
ORACLE["flt11_scope_database"] = f"""
SELECT db, "table", CAST(length(ddl) AS INTEGER) AS n_chars FROM ({TABLE_DEFS}) WHERE db = 'db7'"""
ORACLE["snk4_split_write"] = f"""
SELECT "table", role, CASE WHEN coalesce(ok, false) THEN 'good' ELSE 'bad' END AS side FROM ({ATTEMPTS})"""
ORACLE["snk5_write_artifacts"] = """
SELECT '/Shared/doc' || doc_id AS path, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes,
  md5(text) AS md5 FROM documents"""

ORACLE["stream_ingest_logs"] = """
SELECT event_id, CASE event_type WHEN 'error' THEN user_id + 1000 WHEN 'view' THEN user_id + 2000 ELSE user_id
  END AS user_id, event_type
FROM events"""
ORACLE["src4_read_artifact_tree"] = """
SELECT '/artifact=s' || s_suppkey || '%2520x' AS path, CAST(length(s_name || ' ' || s_nationkey) + 1 AS BIGINT) AS n_bytes,
  md5(s_name || ' ' || s_nationkey || chr(10)) AS content_md5 FROM supplier"""

IMPORT_FILES = f"""SELECT path || '.dbc' AS file FROM ({WS_ITEMS}) WHERE object_type = 'NOTEBOOK' AND path <> '/'
  AND {TRASH_KEEP}"""
ORACLE["pl5_plan_import"] = f"""
WITH np AS (SELECT {PARTS.format(p="substr(file, 1, length(file) - 4)")} AS parts FROM ({IMPORT_FILES})),
nb AS (SELECT '/' || array_to_string(parts, '/') AS path, parts, 'NOTEBOOK' AS object_type FROM np
       WHERE len(parts) >= 1),
fo AS (SELECT DISTINCT '/' || array_to_string(parts[1:i], '/') AS path
       FROM (SELECT parts, unnest(range(1, len(parts))) AS i FROM np WHERE len(parts) >= 2)),
items AS (SELECT path, parts, object_type FROM nb
          UNION ALL SELECT path, {PARTS.format(p='path')}, 'DIRECTORY' FROM fo),
work AS (SELECT *, CASE WHEN len(parts) >= 2 AND parts[1] = 'Users' THEN parts[2] END AS u FROM items),
r AS (SELECT w.*, w.u IS NOT NULL AND h.home IS NULL AS missing FROM work w LEFT JOIN ({HOMES}) h ON w.u = h.home),
o AS (SELECT path, object_type,
  CASE WHEN object_type = 'DIRECTORY' THEN 'mkdir' WHEN NOT missing THEN 'upload' ELSE 'archive' END AS action,
  CASE WHEN missing THEN regexp_replace(path, '^(/*)Users', '\\1Archive') ELSE path END AS upload_path,
  9 AS stage
FROM r)
SELECT * FROM o WHERE NOT (object_type = 'DIRECTORY' AND {USER_ROOT.format(p='upload_path')})"""

ORACLE["pl4_outcome_counts"] = f"""
SELECT outcome, count(*) AS n_jobs FROM ({ORACLE["jn3_remap_clusters"]}) GROUP BY outcome"""
ORACLE["so1_delta_count"] = f"SELECT count(*) AS n_role_rows FROM ({ROLE_DELTA})"
ORACLE["sc10_route_counts"] = """
SELECT count(*) FILTER (WHERE length(text) > 2048) AS n_export_file,
  count(*) FILTER (WHERE octet_length(encode(text)) > 1024) AS n_import_upload, count(*) AS n_docs
FROM documents"""

ORACLE["hr1_orphans"] = f"""
WITH w AS (SELECT path, object_id, object_type, {PARTS.format(p='path')} AS parts FROM ({WS_ITEMS})
           WHERE starts_with(path, '/Users/')),
dirs AS (SELECT DISTINCT '/' || array_to_string(parts, '/') AS anc FROM w WHERE object_type = 'DIRECTORY'),
anc AS (SELECT path, object_id, '/' || array_to_string(parts[1:i], '/') AS anc
        FROM (SELECT path, object_id, parts, unnest(range(2, len(parts))) AS i FROM w WHERE len(parts) > 2))
SELECT DISTINCT path, object_id FROM anc WHERE anc NOT IN (SELECT anc FROM dirs)"""
ORACLE["jn10_library_status"] = """
SELECT l.library_id, '{"status":"INSTALLED","brand":"' || p.p_brand || '"}' AS status
FROM (SELECT DISTINCT l_partkey AS library_id FROM lineitem) l
LEFT JOIN part p ON p.p_partkey = l.library_id AND p.p_size % 2 = 0"""

# Switching over: the same plans, restated on the tables the exports came from
TGT_ROLE_PAIRS = (f"SELECT DISTINCT r.\"user\", r.role FROM ({ROLES.format(r=1)}) r "
                  f"JOIN ({TGT_USERS}) t ON t.userName = r.\"user\"")
SRC_ROLE_PAIRS = (f"SELECT DISTINCT r.\"user\", r.role FROM ({ROLES.format(r=0)}) r "
                  f"JOIN ({SRC_USERS}) s ON s.userName = r.\"user\"")
TGT_PROFILES = "SELECT 'arn:aws:iam::profile/' || n_nationkey AS arn FROM nation WHERE n_regionkey IN (0, 1)"
def _row(kind, key, action, target_id="NULL", target_ref="NULL", n_items="0", stage="0"):
    return (f"SELECT {kind} AS kind, CAST({key} AS VARCHAR) AS key, CAST({action} AS VARCHAR) AS action, "
            f"CAST({target_id} AS VARCHAR) AS target_id, CAST({target_ref} AS VARCHAR) AS target_ref, "
            f"CAST({n_items} AS BIGINT) AS n_items, {stage} AS stage")


# Twenty-five notebooks /Users/u<k>/d/x <k>%20.dbc and definitions db<k % 3>.t<k>.
N_HOMES = f"SELECT n_nationkey AS k, 'u' || n_nationkey IN (SELECT home FROM ({HOMES})) AS home FROM nation"
N_UP = "'/' || CASE WHEN home THEN 'Users' ELSE 'Archive' END || '/u' || k"
EXPORT_ROLES = """SELECT "table", arg_min(nk, nk) AS first FROM (
  SELECT 'db' || (l_partkey % 20) || '.t' || l_partkey AS "table", n_regionkey AS nk,
    (l_orderkey + l_linenumber) % 29 = 0 AS ok
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
  WHERE ok AND nk IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2) GROUP BY "table" """
EXPORT_FAILED = f"""SELECT DISTINCT f."table", r.first, regexp_matches(f."table", '^[^.]+\\.[^.]+$') AS ok
  FROM ({FAILED}) f LEFT JOIN ({EXPORT_ROLES}) r ON f."table" = r."table" """
ORACLE["pl_all_from_exports"] = f"""
{_row("'job'", 'job_id', 'outcome', "CASE WHEN outcome = 'rewired' THEN new_id END",
      "CASE WHEN outcome = 'rewire_after_create' THEN 'cluster:' || later_name END", stage="8")}
FROM ({PLANNED_JOBS})
UNION ALL
{_row("'user'", 's.userName', "CASE WHEN t.userName IS NULL THEN 'create' ELSE 'skip_existing' END", stage="2")}
FROM ({SRC_USERS}) s LEFT JOIN ({TGT_USERS}) t ON s.userName = t.userName
UNION ALL
{_row("'user_roles'", 'd."user"', "CASE WHEN t.id IS NULL THEN 'add_roles_after_create' ELSE 'add_roles' END", 't.id',
      """CASE WHEN t.id IS NULL THEN 'user:' || d."user" END""", 'd.n', '5')}
FROM (SELECT "user", count(*) AS n FROM ({SRC_ROLE_PAIRS} EXCEPT {TGT_ROLE_PAIRS}) GROUP BY "user") d
LEFT JOIN ({TGT_USERS}) t ON d."user" = t.userName
UNION ALL
{_row("'instance_profile'", 's.arn', "CASE WHEN t.arn IS NULL THEN 'create' ELSE 'skip_existing' END", stage="1")}
FROM ({REGISTERED}) s LEFT JOIN ({TGT_PROFILES}) t ON s.arn = t.arn
UNION ALL
SELECT kind, key, action, target_id, target_ref, n_items, stage FROM ({ORACLE["pl6_plan_profiles_pools"]})
WHERE kind = 'instance_pool'
UNION ALL
SELECT kind, key, action, target_id, target_ref, n_items, stage
FROM ({ORACLE["pl2_plan_groups"].replace("// 100", "// 1000")})
UNION ALL
SELECT kind, key, action, target_id, target_ref, n_items, stage FROM ({ORACLE["pl3_plan_clusters"]})
UNION ALL
{_row("split_part(ref, '/', 2)", 'ref', "CASE WHEN access_control_list IS NOT NULL THEN 'set_acl' ELSE 'no_acl' END",
      'access_control_list', 'target_permissions_path', 'apply_order', 'stage')}
FROM (SELECT p.* REPLACE (CASE WHEN p.ref LIKE '/directories/%' THEN p.target_permissions_path END
        AS target_permissions_path) FROM ({ORACLE["pl7_plan_acls"]}) p)
UNION ALL
{_row("'table'", '"table"', "CASE WHEN NOT ok THEN 'invalid_name' WHEN first IS NULL THEN 'failed' ELSE 'create_after_retry' END",
      "CASE WHEN ok THEN 'arn:aws:iam::profile/' || first END", stage="12")} FROM ({EXPORT_FAILED})
UNION ALL
{_row("'table'", "'db' || (n_nationkey % 3) || '.t' || n_nationkey", "'create'", stage="12")} FROM nation
UNION ALL
{_row("'table'", 'db', "'create_if_absent'", stage="11")}
FROM (SELECT 'db' || (n_nationkey % 3) AS db FROM nation
      UNION SELECT split_part("table", '.', 1) FROM ({EXPORT_FAILED}) WHERE ok AND first IS NOT NULL)
UNION ALL
{_row("'workspace'", N_UP + " || '/d/x ' || k || '%20'", "CASE WHEN home THEN 'upload' ELSE 'archive' END", stage="9")}
FROM ({N_HOMES})
UNION ALL
{_row("'workspace'", N_UP + " || '/d'", "'mkdir'", stage="9")} FROM ({N_HOMES})
UNION ALL
{_row("'workspace'", N_UP, "'mkdir'", stage="9")} FROM ({N_HOMES}) WHERE NOT home
UNION ALL
{_row("'gate'", f"(SELECT count(*) FROM ({HOMES}))", "'OK'", n_items="(SELECT count(*) FROM nation)")}
UNION ALL
{_row("'artifact'", 'path', "'missing'")}
FROM (SELECT DISTINCT rtrim(path) AS path FROM ({WS_ITEMS}) WHERE object_type = 'NOTEBOOK')
UNION ALL
{_row("'library'", 'path', "CASE WHEN object_id % 2 = 0 THEN 'INSTALLED' ELSE 'unknown' END")}
FROM ({WS_ITEMS}) WHERE object_type = 'LIBRARY'
UNION ALL
{_row("'cluster_libraries'", 'c.cluster_id', "'attached'", n_items='coalesce(l.n, 0)')}
FROM (SELECT cluster_id FROM ({CLUSTERS}) UNION ALL SELECT 'old-' || c_custkey FROM customer WHERE c_custkey % 20 = 7)
  c LEFT JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS id, count(DISTINCT l_partkey) AS n
  FROM lineitem GROUP BY l_suppkey) l ON l.id = c.cluster_id
UNION ALL
{_row("'cluster'", "'old-' || cluster_id", "'skip_duplicate'", target_ref="'cluster:' || cluster_id", stage="7")}
FROM ({CLUSTERS}) WHERE c_custkey % 20 = 7
UNION ALL
{_row("'ambiguous'", 'cluster_name', "'clusters'", "'source'", n_items='2')} FROM ({CLUSTERS}) WHERE c_custkey % 20 = 7
UNION ALL
{_row("'instance_pool'", "'old-' || instance_pool_id", "'skip_duplicate'",
      target_ref="'instance_pool:' || instance_pool_id", stage="6")}
FROM ({POOLS_SRC}) WHERE CAST(split_part(instance_pool_id, '-', 2) AS INTEGER) % 20 = 7
UNION ALL
{_row("'ambiguous'", 'instance_pool_name', "'instance_pools'", "'source'", n_items='2')}
FROM ({POOLS_SRC}) WHERE CAST(split_part(instance_pool_id, '-', 2) AS INTEGER) % 20 = 7
UNION ALL
{_row("'user'", "'old-' || id", "'skip_duplicate'", target_ref="'user:' || id", stage="2")}
FROM ({SRC_USERS}) WHERE ord % 300 = 11
UNION ALL
{_row("'ambiguous'", 'userName', "'users'", "'source'", n_items='2')} FROM ({SRC_USERS}) WHERE ord % 300 = 11
UNION ALL
{_row("'mount'", "'/mnt/' || s_name", "'s3a://b-' || s_nationkey")} FROM supplier
UNION ALL
{_row("'dropped_field'", 'f', "'clusters'", n_items='(SELECT count(*) + count_if(c_custkey % 20 = 7) FROM customer)')}
FROM (VALUES ('state'), ('undeclared')) v(f)
UNION ALL
{_row("'dropped_field'", "'id'", "'users'", n_items='(SELECT count(*) + count_if(c_custkey % 300 = 11) FROM customer)')}
UNION ALL
{_row("'malformed'", 'l', 's')}
FROM (VALUES ('users.log', 'source'), ('users.log', 'target'), ('groups/broken', 'source')) v(l, s)
UNION ALL
{_row("'ambiguous'", 'instance_pool_name', "'instance_pools'", "'target'", n_items='n')}
FROM (SELECT instance_pool_name, count(*) AS n FROM ({POOLS_LISTED}) GROUP BY 1 HAVING count(*) > 1)
UNION ALL
{_row("'ambiguous'", 'displayName', "'groups'", "'target'", n_items='n')}
FROM (SELECT displayName, count(*) AS n FROM ({GROUPS_LISTED}) GROUP BY 1 HAVING count(*) > 1)"""
