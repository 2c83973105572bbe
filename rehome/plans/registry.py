"""Registered queries: one per operator of the inventory, over driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are scalars (arrays, maps and structs are rendered as JSON text) so
the DuckDB oracle in ``rehome.plans.oracle`` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from rehome.functions import paths as P
from rehome.functions import payload as PL
from rehome.operators import filters as FL
from rehome.operators import mapping as MP
from rehome.operators import members as MB
from rehome.operators import retry as RT
from rehome.operators import setops as SO
from rehome.operators import workspace as WS
from rehome.operators.batches import assign_batches
from rehome.operators.clusters import clean_pool_cluster
from rehome.plans import bindings as B
from rehome.plans.compute import (decide_clusters, plan_cleanup, plan_clusters, plan_pools,
                                  plan_profiles, planned_clusters)
from rehome.plans.identity import plan_groups, plan_users
from rehome.plans.jobs import plan_jobs
from rehome.plans.tables import plan_tables, upload_parts
from rehome.plans.workspace import plan_acls, plan_home, plan_import, plan_workspace
from rehome.session import scratch_path
from rehome.sources import readers as RD
from rehome.sources.exact_files import write_exact_files
from rehome.sources import sinks as SK

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@query("pl4_plan_jobs")
def q_pl4(spark, sf):
    """Clusters that the cluster plan creates count as present."""
    clusters = B.clusters_full(spark, sf).withColumn("ord", F.col("cluster_id").cast("long"))
    decided = decide_clusters(clusters, B.tgt_clusters(spark, sf), B.profiles_registered(spark, sf),
                              B.pools_src(spark, sf), B.pools_tgt(spark, sf), ord_col="ord")
    return plan_jobs(B.jobs(spark, sf), clusters, B.tgt_clusters(spark, sf),
                     planned_clusters=planned_clusters(decided))


# ---------------------------------------------------------------------------
# Id maps, lookups, filters, projections
# ---------------------------------------------------------------------------


@query("jn1_id_map")
def q_jn1(spark, sf):
    return MP.id_map(B.src_users(spark, sf), B.tgt_users(spark, sf), "userName", "id", "ord")


@query("jn2_remap_pools")
def q_jn2(spark, sf):
    pm = MP.id_map(B.pools_src(spark, sf), B.pools_tgt(spark, sf), "instance_pool_name",
                   "instance_pool_id", "ord")
    cl = B.clusters_full(spark, sf).select("cluster_id", "instance_pool_id")
    return MP.remap_pools(cl, pm).select("cluster_id", F.col("instance_pool_id").alias("old_pool_id"),
                                         "new_pool_id", "pool_status")


@query("jn3_remap_clusters")
def q_jn3(spark, sf):
    cm = MP.id_map(B.src_clusters(spark, sf), B.tgt_clusters(spark, sf), "cluster_name",
                   "cluster_id", "ord")
    out = MP.remap_clusters(B.jobs(spark, sf), cm)
    return out.select("job_id", "outcome", "old_cluster_id",
                      F.col("settings.existing_cluster_id").alias("new_cluster_id"))


@query("jn4_skip_existing")
def q_jn4(spark, sf):
    src = B.clusters_full(spark, sf).select("cluster_id", "cluster_name")
    create, skipped, invalid = MP.skip_existing(src, B.tgt_clusters(spark, sf), "cluster_name")
    return (create.withColumn("decision", F.lit("create"))
            .unionByName(skipped.withColumn("decision", F.lit("skip_existing")))
            .unionByName(invalid.withColumn("decision", F.lit("invalid_key"))))


@query("jn5_null_unregistered_profile")
def q_jn5(spark, sf):
    out = MP.null_unregistered_profile(B.supplier_clusters(spark, sf),
                                       B.profiles_registered(spark, sf))
    return out.select("cluster_id", F.col("aws_attributes.instance_profile_arn").alias("profile_arn"),
                      F.col("aws_attributes.zone_id").alias("zone_id"), "profile_dropped")


@query("ag3_distinct_keys")
def q_ag3(spark, sf):
    from rehome.operators.setops import distinct_keys
    return distinct_keys(B.table(spark, sf, "part"), "p_name")


@query("ag4_last_wins")
def q_ag4(spark, sf):
    p = B.table(spark, sf, "part").select("p_name", "p_partkey", "p_brand")
    return MP.last_wins(p, "p_name", "p_partkey")


@query("ag5_first_match")
def q_ag5(spark, sf):
    p = B.table(spark, sf, "part").select("p_name", "p_partkey", "p_brand")
    return MP.first_match(p, "p_name", "p_partkey")


@query("prj1_keep_known_fields")
def q_prj1(spark, sf):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    e = B.table(spark, sf, "events")
    docs = e.select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type", "props"))
                    .alias("doc"))
    sch = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                      StructField("event_type", StringType()), StructField("props", StringType())])
    return docs.select("event_id", FL.keep_known_json("doc", sch, ["event_id", "event_type"])
                       .alias("doc"))


@query("prj2_project_items")
def q_prj2(spark, sf):
    return FL.project_items(B.ws_items(spark, sf))


@query("prj3_drop_fields")
def q_prj3(spark, sf):
    j = FL.drop_fields(B.jobs(spark, sf), "settings.new_cluster", "settings.existing_cluster_id")
    return j.select("job_id", F.to_json("settings").alias("settings_json"))


@query("prj4_project_mounts")
def q_prj4(spark, sf):
    s = B.table(spark, sf, "supplier")
    raw = s.select(F.concat(F.lit("/mnt/"), F.col("s_name")).alias("mountPoint"),
                   F.concat(F.lit("s3a://bucket-"), F.col("s_nationkey").cast("string")).alias("source"),
                   F.when(F.col("s_suppkey") % 2 == 0, F.lit("sse-s3")).otherwise(F.lit(""))
                   .alias("encryptionType"))
    return FL.project_mounts(raw)


@query("flt1_running")
def q_flt1(spark, sf):
    e = B.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit("TERMINATED"))
        .otherwise(F.lit("RUNNING")).alias("state"))
    return FL.running(e).select("event_id")


@query("flt2_split_automated")
def q_flt2(spark, sf):
    kept, skipped = FL.split_automated(B.cluster_names(spark, sf))
    return (kept.withColumn("automated", F.lit(False))
            .unionByName(skipped.withColumn("automated", F.lit(True))))


@query("flt3_drop_builtin_admin")
def q_flt3(spark, sf):
    c = B.table(spark, sf, "customer")
    k = F.col("c_custkey")
    users = c.select(
        k.cast("string").alias("id"),
        F.when(k % 5 == 0, F.lit("admin")).otherwise(F.col("c_name")).alias("userName"),
        F.when(k % 3 == 0, F.lit(None).cast("struct<givenName:string>"))
        .otherwise(F.struct(F.when(k % 2 == 0, F.lit("Administrator")).otherwise(F.lit("Someone"))
                            .alias("givenName"))).alias("name"))
    return FL.drop_builtin_admin(users).select("id", "userName")


@query("flt4_filter_item_type")
def q_flt4(spark, sf):
    return FL.filter_item_type(B.ws_items(spark, sf), "NOTEBOOK").select("path", "object_id")


@query("flt5_prune_trash")
def q_flt5(spark, sf):
    return FL.prune_trash(B.ws_items(spark, sf), "/")


@query("flt6_classify_path")
def q_flt6(spark, sf):
    return FL.classify_path(B.ws_items(spark, sf).select("path", "object_id"))


@query("flt8_drop_null_elements")
def q_flt8(spark, sf):
    c = B.table(spark, sf, "customer")
    arr = F.array(F.col("c_name"),
                  F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
                  F.when(F.col("c_nationkey") % 2 == 0, F.lit("")).otherwise(F.lit("x")))
    return c.select("c_custkey", F.to_json(PL.drop_null_elements(arr)).alias("names"))


@query("flt9_files_only")
def q_flt9(spark, sf):
    it = B.ws_items(spark, sf).select("path", (F.col("object_type") == "DIRECTORY").alias("is_dir"))
    return FL.files_only(it).select("path")


@query("flt10_scope_subtree")
def q_flt10(spark, sf):
    it = B.ws_items(spark, sf)
    return (FL.scope_subtree(it, "/Users/u1").withColumn("root", F.lit("/Users/u1"))
            .unionByName(FL.scope_subtree(it, "/").withColumn("root", F.lit("/"))))


# ---------------------------------------------------------------------------
# Groups, workspace, retries, batches, set operations
# ---------------------------------------------------------------------------


def _enriched(spark, sf):
    return MB.enrich_members(B.group_members(spark, sf), B.src_users(spark, sf), ord_col="ord")


def _resolved(spark, sf):
    e = _enriched(spark, sf).where(F.col("status") == "ok")
    return MB.resolve_members(e, B.tgt_users(spark, sf), B.groups_tgt(spark, sf), ord_col="ord")


@query("flt7_member_kind")
def q_flt7(spark, sf):
    m = B.group_members(spark, sf)
    return m.select("group_name", "value", "ref", PL.member_kind("ref").alias("kind"))


@query("jn6_enrich_members")
def q_jn6(spark, sf):
    return _enriched(spark, sf).select("group_name", "value", "type", "userName", "status")


@query("jn7_resolve_members")
def q_jn7(spark, sf):
    return _resolved(spark, sf).select("group_name", "value", "type", "target_member_id",
                                       "target_group_id", "status")


@query("ag6_regroup_members")
def q_ag6(spark, sf):
    r = _resolved(spark, sf).where(F.col("status") == "resolved")
    return MB.regroup_members(r, max_members=100)


@query("hr1_reachable")
def q_hr1(spark, sf):
    return WS.reachable(B.ws_items(spark, sf), "/").select("path", "object_id", "depth")


@query("hr1_reachable_by_parent")
def q_hr1_parent(spark, sf):
    return WS.reachable_by_parent(B.tree_items(spark, sf), stop_col="trash").select(
        "object_id", "parent_id", "depth", "status")


@query("jn8_attach_acls")
def q_jn8(spark, sf):
    nb = FL.filter_item_type(B.ws_items(spark, sf), "NOTEBOOK")
    return WS.attach_acls(nb, B.acl_docs(spark, sf), "notebooks", ord_col="ord").select(
        "object_id", "kind", "ref", "permissions_path", "access_control_list", "acl_order", "has_acl")


@query("so2_union_acls")
def q_so2(spark, sf):
    it, acls = B.ws_items(spark, sf), B.acl_docs(spark, sf)
    nb = WS.attach_acls(FL.filter_item_type(it, "NOTEBOOK"), acls, "notebooks")
    dr = WS.attach_acls(FL.filter_item_type(it, "DIRECTORY"), acls, "directories")
    return WS.union_acls(nb, dr).select("ref", "kind", "has_acl", "apply_order")


@query("jn9_route_missing_users")
def q_jn9(spark, sf):
    nb = FL.filter_item_type(B.ws_items(spark, sf), "NOTEBOOK")
    out = WS.route_missing_users(nb, B.ws_target(spark, sf), archive_missing=False)
    arch = WS.route_missing_users(nb, B.ws_target(spark, sf), archive_missing=True)
    cols = ["path", "user", "action", "upload_path"]
    return (out.select(*cols).withColumn("archive_missing", F.lit(False))
            .unionByName(arch.select(*cols).withColumn("archive_missing", F.lit(True))))


def _ws_outcomes(spark, sf):
    o = B.table(spark, sf, "orders").where(F.col("o_orderkey") % 3 == 1)
    path = B.ws_path()
    arts = o.where(F.col("o_orderstatus") == "F").select(
        path.alias("path"), F.floor("o_totalprice").cast("long").alias("n_bytes"))
    fails = o.where(F.col("o_orderstatus") == "P").select(
        path.alias("path"), F.lit("RESOURCE_DOES_NOT_EXIST").alias("error_code"))
    return arts, fails


@query("jn12_reconcile_artifacts")
def q_jn12(spark, sf):
    manifest = FL.filter_item_type(B.ws_items(spark, sf), "NOTEBOOK").select("path")
    arts, fails = _ws_outcomes(spark, sf)
    return WS.reconcile_artifacts(manifest, arts, fails)


@query("jn13_home_exists")
def q_jn13(spark, sf):
    users = (FL.classify_path(B.ws_items(spark, sf)).where("is_user_item")
             .select("user").distinct())
    present, missing = WS.home_exists(users, B.ws_target(spark, sf))
    return (present.withColumn("home_exists", F.lit(True))
            .unionByName(missing.withColumn("home_exists", F.lit(False))))


@query("ag2_count_user_homes")
def q_ag2(spark, sf):
    return WS.count_user_homes(B.ws_items(spark, sf), B.ws_target(spark, sf))


@query("ag8_readiness_gate")
def q_ag8(spark, sf):
    it, tg = B.ws_items(spark, sf), B.ws_target(spark, sf)
    empty = tg.where(F.col("object_type") == "NONE")
    return (WS.readiness_gate(it, tg, False).withColumn("archive_missing", F.lit(False))
            .unionByName(WS.readiness_gate(it, tg, True).withColumn("archive_missing", F.lit(True)))
            .unionByName(WS.readiness_gate(it, empty, True)
                         .withColumn("archive_missing", F.lit(True))))


def _retry(spark, sf):
    return RT.retry_matrix(B.failed_tables(spark, sf), B.retry_roles(spark, sf),
                           B.retry_attempts(spark, sf))


@query("jn11_retry_matrix")
def q_jn11(spark, sf):
    resolved, remaining, invalid = _retry(spark, sf)
    return (resolved.select("table", F.lit("resolved").alias("outcome"),
                            F.col("resolved_role").alias("role"))
            .unionByName(remaining.select("table", F.lit("remaining").alias("outcome"),
                                          F.lit(None).cast("string").alias("role")))
            .unionByName(invalid.select("table", F.lit("invalid").alias("outcome"),
                                        F.lit(None).cast("string").alias("role"))))


@query("ag7_failure_summary")
def q_ag7(spark, sf):
    resolved, remaining, _ = _retry(spark, sf)
    failed = B.failed_tables(spark, sf)
    dbs = B.table_defs(spark, sf).select("db")
    return RT.failure_summary(dbs, failed, remaining)


@query("wn1_assign_batches")
def q_wn1(spark, sf):
    o = B.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return assign_batches(o, ["month"], ["o_orderkey"], size=100)


@query("so1_role_delta")
def q_so1(spark, sf):
    return SO.role_delta(B.role_pairs(spark, sf, True), B.role_pairs(spark, sf, False))


@query("so3_unexpected_fields")
def q_so3(spark, sf):
    e = B.table(spark, sf, "events")
    docs = e.select(F.to_json(F.struct("event_id", "user_id", "event_type",
                                       F.when(F.col("value") > 50, F.col("event_id")).alias("big"),
                                       "props")).alias("doc"))
    return SO.unexpected_fields(docs, "doc", ["event_id", "event_type"])


@query("ag1_row_count")
def q_ag1(spark, sf):
    return SO.row_count(B.table(spark, sf, "events"))


@query("st1_latest_version")
def q_st1(spark, sf):
    v = B.versions(spark, sf)
    return (SO.latest_version(v, "key", ord_col="ord").withColumn("mode", F.lit("string"))
            .unionByName(SO.latest_version(v, "key", numeric=True, ord_col="ord")
                         .withColumn("mode", F.lit("numeric"))))


@query("jn10_cluster_libraries")
def q_jn10(spark, sf):
    clusters = B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cluster_id"))
    libs = B.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cluster_id"),
                                                 F.col("l_partkey").alias("library_id"))
    return SO.cluster_libraries(clusters, libs)


# ---------------------------------------------------------------------------
# Scalar column functions
# ---------------------------------------------------------------------------


@query("sc1_archive_path")
def q_sc1(spark, sf):
    it = B.ws_items(spark, sf).where(P.is_user_item("path"))
    return it.select("path", P.archive_path("path").alias("archive_path"))


@query("sc2_dir_base")
def q_sc2(spark, sf):
    it = B.ws_items(spark, sf)
    return it.select("path", P.dir_name("path").alias("dir_name"), P.base_name("path").alias("base_name"))


@query("sc3_strip_ext")
def q_sc3(spark, sf):
    it = B.ws_items(spark, sf).select(P.artifact_name("path").alias("artifact"))
    return it.select("artifact", P.strip_ext("artifact").alias("path"))


@query("sc4_split_qualified")
def q_sc4(spark, sf):
    t = B.table_names(spark, sf)
    db, tb = PL.split_qualified("table")
    return t.select("table", db.alias("db"), tb.alias("table_name"), PL.qualified_ok("table").alias("ok"))


@query("sc5_base64")
def q_sc5(spark, sf):
    d = B.table(spark, sf, "documents")
    b64 = PL.encode_b64(F.encode("text", "UTF-8"))
    return d.select("doc_id", F.md5(b64).alias("b64_md5"), F.length(b64).alias("b64_len"),
                    (PL.decode_b64(b64) == F.col("text")).alias("roundtrip_ok"))


@query("sc6_to_from_doc")
def q_sc6(spark, sf):
    e = B.table(spark, sf, "events")
    doc = PL.to_doc(F.col("event_id"), F.col("user_id"), F.col("event_type"))
    parsed = PL.from_doc(doc, "event_id bigint, user_id bigint, event_type string")
    return e.select("event_id", doc.alias("doc"), parsed["event_type"].alias("parsed_type"),
                    parsed["user_id"].alias("parsed_user"))


@query("sc7_parse_name_list")
def q_sc7(spark, sf):
    c = B.table(spark, sf, "customer")
    txt = F.concat(F.lit("['"), F.col("c_mktsegment"), F.lit("', '"), F.col("c_name"), F.lit("']"))
    arr = PL.parse_name_list(txt)
    return c.select("c_custkey", F.size(arr).alias("n"), F.get(arr, 0).alias("first"),
                    F.get(arr, 1).alias("second"))


@query("sc8_upsert_tag")
def q_sc8(spark, sf):
    c = B.clusters_full(spark, sf)
    return c.select("cluster_id", F.to_json(PL.upsert_tag("custom_tags", "OriginalCreator",
                                                          F.col("creator_user_name"))).alias("tags"))


@query("sc9_major_version")
def q_sc9(spark, sf):
    v = B.versions(spark, sf)
    return v.select("key", "ord", PL.major_version("key").alias("major"),
                    PL.major_version_at_least("key", 7).alias("at_least_7"))


@query("sc10_route_payload")
def q_sc10(spark, sf):
    d = B.table(spark, sf, "documents")
    return d.select("doc_id", F.length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"),
                    PL.route_export("text").alias("export_route"),
                    PL.route_import("text").alias("import_route"))


@query("sc11_clean_pool_cluster")
def q_sc11(spark, sf):
    c = B.clusters_full(spark, sf).where(F.col("instance_pool_id").isNotNull())
    pm = MP.id_map(B.pools_src(spark, sf), B.pools_tgt(spark, sf), "instance_pool_name",
                   "instance_pool_id", "ord")
    out = clean_pool_cluster(c, pm)
    return out.select("cluster_id", "instance_pool_id", "pool_status", "node_type_id",
                      "enable_elastic_disk",
                      F.to_json("aws_attributes").alias("aws_attributes"),
                      F.col("custom_tags")["OriginalCreator"].alias("original_creator"))


@query("sc12_patch_payload")
def q_sc12(spark, sf):
    d = SO.role_delta(B.role_pairs(spark, sf, True), B.role_pairs(spark, sf, False))
    return SO.role_patches(d)


@query("sc13_default_cluster")
def q_sc13(spark, sf):
    cm = MP.id_map(B.src_clusters(spark, sf), B.tgt_clusters(spark, sf), "cluster_name",
                   "cluster_id", "ord")
    out = None
    for cloud in ("aws", "azure"):
        r = (MP.remap_clusters(B.jobs(spark, sf), cm, cloud=cloud)
             .where(F.col("outcome") == "reset_default")
             .select("job_id", F.lit(cloud).alias("cloud"),
                     F.to_json("settings.new_cluster").alias("new_cluster")))
        out = r if out is None else out.unionByName(r)
    return out


@query("sc14_wrap_values")
def q_sc14(spark, sf):
    r = B.role_pairs(spark, sf, None).groupBy("user").agg(
        F.sort_array(F.collect_set("role")).alias("roles"))
    return r.select("user", F.to_json(PL.wrap_values("roles")).alias("roles_json"))


@query("sc15_object_ref")
def q_sc15(spark, sf):
    it = B.ws_items(spark, sf).where(F.col("object_type").isin("NOTEBOOK", "DIRECTORY"))
    kind = F.when(F.col("object_type") == "NOTEBOOK", F.lit("notebooks")).otherwise(F.lit("directories"))
    ref = PL.object_ref(kind, F.col("object_id"))
    return it.select(ref.alias("ref"), PL.permissions_path(ref).alias("permissions_path"),
                     PL.ref_kind(ref).alias("kind"), PL.ref_id(ref).alias("id"))


@query("sc16_ddl_facts")
def q_sc16(spark, sf):
    d = B.table_defs(spark, sf)
    return d.select("db", "table", PL.ddl_provider("ddl").alias("provider"),
                    PL.ddl_location("ddl").alias("location"), PL.ddl_n_columns("ddl").alias("n_columns"))


@query("sc17_clean_key")
def q_sc17(spark, sf):
    c = B.table(spark, sf, "customer")
    return c.select("c_custkey",
                    P.clean_user_name(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("user"),
                    P.clean_db_name(F.concat(F.lit("db"), F.col("c_nationkey").cast("string"), F.lit("\n")))
                    .alias("db"))


# ---------------------------------------------------------------------------
# Composite plans
# ---------------------------------------------------------------------------


@query("pl1_plan_users")
def q_pl1(spark, sf):
    return plan_users(B.src_users(spark, sf), B.tgt_users(spark, sf), B.role_pairs(spark, sf, True),
                      B.role_pairs(spark, sf, False))


@query("pl2_plan_groups")
def q_pl2(spark, sf):
    return plan_groups(B.groups_src(spark, sf), B.group_members(spark, sf), B.src_users(spark, sf),
                       B.tgt_users(spark, sf), B.groups_tgt(spark, sf), B.group_roles(spark, sf),
                       max_members=100, ord_col="ord")


@query("pl3_plan_clusters")
def q_pl3(spark, sf):
    return plan_clusters(B.clusters_full(spark, sf), B.tgt_clusters(spark, sf),
                         B.profiles_registered(spark, sf), B.pools_src(spark, sf),
                         B.pools_tgt(spark, sf), ord_col="ord")


@query("pl5_plan_workspace")
def q_pl5(spark, sf):
    plan, _gate = plan_workspace(B.ws_items(spark, sf), B.ws_target(spark, sf), archive_missing=True)
    return plan.select("path", "object_type", "action", "upload_path", "stage")


@query("pl5_plan_import")
def q_pl5_import(spark, sf):
    """Import side: the artifact files the export downloaded (reachable
    notebooks), replayed onto the target with missing homes archived."""
    nb = FL.filter_item_type(WS.reachable(B.ws_items(spark, sf), "/"), "NOTEBOOK")
    files = nb.select(P.artifact_name("path").alias("file"))
    plan, _gate = plan_import(files, B.ws_target(spark, sf), archive_missing=True)
    return plan.select("path", "object_type", "action", "upload_path", "stage")


@query("pl6_plan_profiles_pools")
def q_pl6(spark, sf):
    return (plan_profiles(B.profiles_src(spark, sf), B.profiles_registered(spark, sf))
            .unionByName(plan_pools(B.pools_src(spark, sf), B.pools_tgt(spark, sf))))


@query("pl7_plan_acls")
def q_pl7(spark, sf):
    it = B.ws_items(spark, sf)
    p = plan_acls(FL.filter_item_type(it, "NOTEBOOK"), FL.filter_item_type(it, "DIRECTORY"),
                  B.acl_docs(spark, sf), B.ws_target(spark, sf), ord_col="ord")
    return p.select("ref", "permissions_path", "access_control_list", "acl_order", "apply_order",
                    "target_object_id", "target_permissions_path", "stage")


@query("pl8_plan_tables")
def q_pl8(spark, sf):
    plan, _summary = plan_tables(B.table_defs(spark, sf), B.failed_tables(spark, sf),
                                 B.retry_roles(spark, sf), B.retry_attempts(spark, sf))
    return plan


@query("pl8_upload_parts")
def q_pl8_parts(spark, sf):
    """Definitions above the inline limit in parts of 1,000 bytes."""
    return upload_parts(B.table_defs(spark, sf), part_bytes=1000)


@query("sc16_ddl_columns")
def q_sc16_columns(spark, sf):
    """A row per column of every definition."""
    cols = B.table_defs(spark, sf).select("db", "table", F.posexplode(PL.ddl_columns("ddl")).alias("i", "c"))
    return cols.select("db", "table", F.col("i").cast("long").alias("i"), "c.name", "c.type")


@query("pl9_plan_home")
def q_pl9(spark, sf):
    """One home that exists on the target and one that is archived."""
    out = None
    for user, archive in (("u1", False), ("u4", True)):
        plan, _gate = plan_home(B.ws_items(spark, sf), B.ws_target(spark, sf), user,
                                archive_missing=archive)
        plan = plan.select("path", "object_type", "action", "upload_path", "stage")
        out = plan if out is None else out.unionByName(plan)
    return out


@query("pl10_plan_cleanup")
def q_pl10(spark, sf):
    jobs = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"))
    return plan_cleanup(B.tgt_clusters(spark, sf), jobs).select("kind", "key", "action", "stage")


# ---------------------------------------------------------------------------
# Sources and sinks: round trips through the shared scratch space
# ---------------------------------------------------------------------------


EVENT_SCHEMA = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                           StructField("event_type", StringType())])
PATCH_DOC = StructType([
    StructField("schemas", ArrayType(StringType())),
    StructField("Operations", ArrayType(StructType([
        StructField("op", StringType()),
        StructField("value", StructType([StructField("members", ArrayType(
            StructType([StructField("value", StringType())])))]))])))])


@query("src1_read_jsonl")
def q_src1(spark, sf):
    """Every 97th line is cut short (malformed) and must land in the
    corrupt-record column, not vanish."""
    e = B.table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    line = F.when(F.col("event_id") % 97 == 0, F.expr("substring(to_json(struct(event_id, user_id, "
                                                        "event_type)), 1, 10)")).otherwise(line)
    path = scratch_path(spark, "src1")
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    df = RD.read_jsonl(spark, path, EVENT_SCHEMA)
    bad = F.col(RD.CORRUPT).isNotNull()
    return df.select(*[F.when(~bad, F.col(c)).alias(c) for c in ("event_id", "user_id", "event_type")],
                     bad.alias("is_corrupt"))


@query("src2_read_json_docs")
def q_src2(spark, sf):
    """Member patch documents written one folder per group, read back with
    the group name taken from the folder."""
    r = _resolved(spark, sf).where(F.col("status") == "resolved")
    docs = MB.regroup_members(r, max_members=100)
    path = scratch_path(spark, "src2")
    SK.write_by_key(docs.select("target_group_id", F.col("patch").alias("value")), path,
                    ["target_group_id"], fmt="text")
    back = RD.read_json_docs(spark, path, PATCH_DOC, "group", layout="partition")
    n = F.aggregate(F.transform("Operations", lambda o: F.size(o["value"]["members"])), F.lit(0),
                    lambda a, b: a + b)
    return back.groupBy("group").agg(F.sum(n).cast("long").alias("n_members"),
                                     F.count(F.lit(1)).alias("n_docs"))


@query("src3_read_definition_tree")
def q_src3(spark, sf):
    """One file per definition, under the names of the export layout."""
    path = scratch_path(spark, "src3")
    SK.write_definition_tree(B.table_defs(spark, sf), path, layout="tree")
    back = RD.read_definition_tree(spark, path)
    return back.select("db", "table", F.length("ddl").alias("n_chars"), F.md5("ddl").alias("ddl_md5"))


@query("src4_read_artifact_tree")
def q_src4(spark, sf):
    """One small text artifact per supplier, read back as binary files.  A
    literal ``%20`` in a name must survive.  Laid out as the text writer lays
    out folders per key, with its escaping (``%`` is ``%25`` on disk) and one
    part for each input partition, but written by ``write_exact_files``: the
    text writer took about 21 ms a folder, in one task."""
    path = scratch_path(spark, "src4")
    p = B.table(spark, sf, "supplier")
    artifact = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit("%2520x"))
    value = F.concat(F.col("s_name"), F.lit(" "), F.col("s_nationkey").cast("string"))
    write_exact_files(p.select(
        F.concat(F.lit("artifact="), F.coalesce(artifact, F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit("/part-"),
                 F.lpad(F.spark_partition_id().cast("string"), 5, "0"), F.lit(".txt")).alias("path"),
        F.concat(F.coalesce(value, F.lit("")), F.lit("\n")).alias("content"),
        F.monotonically_increasing_id().alias("line")), path, order="line")
    a = RD.read_artifact_tree(spark, path, ext=".txt")
    return a.select(F.regexp_replace("path", "/[^/]*$", "").alias("path"), "n_bytes",
                    F.md5("content").alias("content_md5"))


@query("snk5_artifact_tree")
def q_snk5_tree(spark, sf):
    """One artifact per customer under its workspace path, read back; a literal
    ``%20``, a blank and a double slash must survive the round trip."""
    c = B.table(spark, sf, "customer")
    path = scratch_path(spark, "snk5-tree")
    name = F.concat(F.lit("/Users/u"), F.col("c_custkey").cast("string"), F.lit("//d/n %20"),
                    (F.col("c_custkey") % 3).cast("string"))
    SK.write_artifact_tree(c.select(name.alias("path"), PL.encode_b64(
        F.encode("c_name", "UTF-8")).alias("content")), path)
    a = RD.read_artifact_tree(spark, path)
    return a.select("path", "n_bytes", F.md5("content").alias("content_md5"))


@query("src5_unwrap_listing")
def q_src5(spark, sf):
    e = B.table(spark, sf, "events")
    doc = (F.when(F.col("event_type") == "click",
                  F.concat(F.lit('{"objects": ['), F.col("props"), F.lit(", "), F.col("props"), F.lit("]}")))
           .when(F.col("event_type") == "view", F.concat(F.lit("["), F.col("props"), F.lit("]")))
           .otherwise(F.lit("{}")))
    resp = e.select("event_id", doc.alias("resp"))
    el = StructType([StructField("k", LongType())])
    return (RD.unwrap_listing(resp, "resp", "objects", el).withColumn("listing", F.lit("objects"))
            .unionByName(RD.unwrap_listing(resp, "resp", "elements", el)
                         .withColumn("listing", F.lit("elements"))))


@query("snk1_write_jsonl")
def q_snk1(spark, sf):
    path = scratch_path(spark, "snk1")
    SK.write_jsonl(B.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path)
    sch = StructType(list(EVENT_SCHEMA.fields) + [StructField("value", DoubleType())])
    return RD.read_jsonl(spark, path, sch, keep_corrupt=False)


@query("snk2_append_jsonl")
def q_snk2(spark, sf):
    """A full run, then a rerun that appends the error events again."""
    e = B.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    path = scratch_path(spark, "snk2")
    SK.append_jsonl(e, path, reset=True)
    SK.append_jsonl(e.where(F.col("event_type") == "error")
                    .withColumn("user_id", F.col("user_id") + 1000), path)
    log = RD.read_jsonl(spark, path, EVENT_SCHEMA, keep_corrupt=False, ordered=True)
    return SK.dedupe_log(log, "event_id")


def _written_defs(spark, sf):
    d = B.table_defs(spark, sf).select("db", "table", F.length("ddl").alias("n_chars"))
    path = scratch_path(spark, "defs")
    SK.write_by_key(d, path, ["db"])
    return spark.read.parquet(path)


@query("snk3_write_by_key")
def q_snk3(spark, sf):
    return _written_defs(spark, sf).select("db", "table", "n_chars")


@query("flt11_scope_database")
def q_flt11(spark, sf):
    return FL.scope_database(_written_defs(spark, sf), "db7").select("db", "table", "n_chars")


@query("snk4_split_write")
def q_snk4(spark, sf):
    path = scratch_path(spark, "snk4")
    good, bad = SK.split_write(B.retry_attempts(spark, sf), F.col("ok"), path)
    return (spark.read.parquet(good).select("table", "role", F.lit("good").alias("side"))
            .unionByName(spark.read.parquet(bad).select("table", "role", F.lit("bad").alias("side"))))


@query("snk5_write_artifacts")
def q_snk5(spark, sf):
    d = B.table(spark, sf, "documents").select(
        F.concat(F.lit("/Shared/doc"), F.col("doc_id").cast("string")).alias("path"),
        PL.encode_b64(F.encode("text", "UTF-8")).alias("content"))
    path = scratch_path(spark, "snk5")
    SK.write_artifacts(d, path)
    back = spark.read.parquet(path)
    return back.select("path", F.octet_length("content").alias("n_bytes"), F.md5("content").alias("md5"))


# ---------------------------------------------------------------------------
# Incremental ingestion (Structured Streaming)
# ---------------------------------------------------------------------------
@query("stream_ingest_logs")
def q_stream(spark, sf):
    """Export runs land as log files (the second re-exports the error events
    with a changed user and one truncated line, the third the views); the
    stream ingests them and the snapshot keeps the latest version of each
    event."""
    from rehome.streaming import ingest_logs, latest_snapshot
    e = B.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    landing = scratch_path(spark, "landing")
    e.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value")) \
        .write.mode("overwrite").text(landing)
    rerun = e.where(F.col("event_type") == "error").withColumn("user_id", F.col("user_id") + 1000)
    rerun_lines = rerun.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value")) \
        .unionByName(spark.range(1).select(F.lit('{"event_id": 1, "user_').alias("value")))
    table_dir, ckpt = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-ckpt")
    # Both runs are there before the stream starts, in one batch; a third
    # run's files then land in the same folder and only they are picked up.
    rerun_lines.coalesce(1).write.mode("append").text(landing)
    ingest_logs(spark, landing, EVENT_SCHEMA, table_dir, checkpoint=ckpt)
    third = e.where(F.col("event_type") == "view").withColumn("user_id", F.col("user_id") + 2000)
    third.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value")) \
        .write.mode("append").text(landing)
    ingest_logs(spark, landing, EVENT_SCHEMA, table_dir, checkpoint=ckpt)
    return latest_snapshot(spark, table_dir, "event_id").select("event_id", "user_id", "event_type")


# ---------------------------------------------------------------------------
# Acceptance summaries
# ---------------------------------------------------------------------------
@query("pl4_outcome_counts")
def q_pl4_counts(spark, sf):
    p = q_jn3(spark, sf)
    return p.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_jobs"))


@query("so1_delta_count")
def q_so1_count(spark, sf):
    return SO.row_count(q_so1(spark, sf), "n_role_rows")


@query("sc10_route_counts")
def q_sc10_counts(spark, sf):
    r = q_sc10(spark, sf)
    return r.agg(F.count_if(F.col("export_route") == "file").alias("n_export_file"),
                 F.count_if(F.col("import_route") == "upload").alias("n_import_upload"),
                 F.count(F.lit(1)).alias("n_docs"))


@query("hr1_orphans")
def q_hr1_orphans(spark, sf):
    """Items below ``/Users`` whose ancestor folders (below ``/Users``) are
    missing from the snapshot: order items sit in ``d`` folders that were
    never listed, trash items mostly in ``Trash`` folders that were not."""
    return WS.orphans(B.ws_items(spark, sf), "/Users")


@query("jn10_library_status")
def q_jn10_status(spark, sf):
    """Per library (parts used by line items): its logged status, if any."""
    libs = B.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("library_id")).distinct()
    status = B.table(spark, sf, "part").where(F.col("p_size") % 2 == 0).select(
        F.col("p_partkey").alias("library_id"),
        F.concat(F.lit('{"status":"INSTALLED","brand":"'), F.col("p_brand"), F.lit('"}')).alias("status"))
    return SO.attach_library_status(libs, status)


# ---------------------------------------------------------------------------
# Switching over: export folders in the reference layout -> plan_all
# ---------------------------------------------------------------------------
def _write_export(spark, root, users, clusters, pools, profiles, jobs, dirs, notebooks, libraries):
    broken = spark.range(1).select(F.lit('{"id": "cut", "userNa').alias("doc"))
    SK.write_docs(users.select(F.to_json(F.struct("*")).alias("doc")).unionByName(broken),
                  f"{root}/users.log", compressed=True)
    for df, name in ((clusters, "clusters"), (pools, "instance_pools"), (jobs, "jobs")):
        docs = df if "doc" in df.columns else df.select(F.to_json(F.struct("*")).alias("doc"))
        SK.write_docs(docs, f"{root}/{name}.log", compressed=True)
    for df, name in ((profiles, "instance_profiles"), (dirs, "user_dirs"),
                     (notebooks, "user_workspace"), (libraries, "libraries")):
        SK.write_jsonl(df, f"{root}/{name}.log", compressed=True)


def _users_with_roles(users, pairs):
    roles = pairs.groupBy("user").agg(F.sort_array(F.collect_set("role")).alias("_r"))
    j = users.join(roles, users["userName"] == roles["user"], "left")
    return j.select("id", "userName", F.transform("_r", lambda r: F.struct(r.alias("value"))).alias("roles"))


def _write_group_docs(spark, sf, path):
    """Group documents in the reference shape, at most 1,000 members each
    (a group with more members is written as several documents)."""
    m = B.group_members(spark, sf)
    batched = assign_batches(m, ["group_id"], ["value"], size=1000)
    member = F.struct("display", "value", F.col("ref").alias("$ref"))
    docs = batched.groupBy("group_id", "group_name", "batch").agg(
        F.sort_array(F.collect_list(member)).alias("members"))
    roles = B.group_roles(spark, sf).groupBy("group_name").agg(
        F.sort_array(F.collect_set("role")).alias("_r"))
    docs = docs.join(roles, "group_name", "left").select(
        F.col("group_id").alias("id"), F.col("group_name").alias("displayName"), "members",
        F.transform("_r", lambda r: F.struct(r.alias("value"))).alias("roles"))
    SK.write_jsonl(docs, path)


def export_workspaces(spark, sf, empty_target=False):
    """Both workspaces in the reference layout, from the driver tables; with
    ``empty_target`` the target holds home folders only.  Logs are compressed:
    as plain text they are many times the tables.  Returns both roots."""
    src_dir, tgt_dir = scratch_path(spark, "export-src"), scratch_path(spark, "export-tgt")
    nation = B.table(spark, sf, "nation")
    items = B.ws_items(spark, sf)

    def listed(rows, kind):
        return rows.where(F.col("object_type") == kind).select("path", "object_id")
    # Objects listed before under the name of another one.
    users = B.src_users(spark, sf).select("id", "userName")
    old_users = users.where(F.col("id").cast("long") % 300 == 11).withColumn(
        "id", F.concat(F.lit("old-"), "id"))
    clusters, pools = B.clusters_full(spark, sf).select("doc"), B.pools_src(spark, sf).select("doc")

    def older(docs, key, rest):
        """Earlier listings of some objects, under ids of their own."""
        i = F.regexp_extract("doc", f'"{key}":"{rest}([0-9]+)"', 1).cast("long")
        return docs.where(i % 20 == 7).withColumn("doc", F.regexp_replace(
            "doc", f'"{key}":"', f'"{key}":"old-')).unionByName(docs)
    _write_export(spark, src_dir, old_users.select("id", "userName", F.lit(None).cast(
        "array<struct<value:string>>").alias("roles")).unionByName(
        _users_with_roles(users, B.role_pairs(spark, sf, True))),
        older(clusters, "cluster_id", ""), older(pools, "instance_pool_id", "pool-"), B.profiles_registered(spark, sf),
        B.jobs(spark, sf), listed(items, "DIRECTORY"), listed(items, "NOTEBOOK"),
        listed(items, "LIBRARY"))
    _write_group_docs(spark, sf, f"{src_dir}/groups")
    SK.write_jsonl(B.failed_tables(spark, sf).withColumn("resultType", F.lit("error")),
                   f"{src_dir}/failed_metastore.log", compressed=True)
    acls = B.acl_docs(spark, sf).drop("ord")
    first, again = ~F.col("access_control_list").contains("CAN_READ"), \
        F.col("access_control_list").contains("CAN_READ")
    for kind in ("notebooks", "directories"):
        log, mine = f"{src_dir}/acl_{kind}.log", acls.where(
            F.col("object_id").startswith(f"/{kind}/"))
        SK.write_jsonl(mine.where(first), log, compressed=True)
        SK.append_jsonl(mine.where(again), log, compressed=True)
    libs = B.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("cluster_id"), F.col("l_partkey").alias("library_id"))
    SK.write_jsonl(libs.distinct(), f"{src_dir}/attached_cluster_libs.log", compressed=True)
    SK.write_jsonl(items.where("object_type = 'LIBRARY' and object_id % 2 = 0").select(
        F.col("object_id").alias("library_id"), F.lit("INSTALLED").alias("status")),
        f"{src_dir}/lib_details.log", compressed=True)
    sup = B.table(spark, sf, "supplier")
    SK.write_jsonl(sup.select(F.concat(F.lit("/mnt/"), "s_name").alias("path"),
                              F.concat(F.lit("s3a://b-"), F.col("s_nationkey").cast("string"))
                              .alias("source"), F.lit("").alias("encryptionType")),
                   f"{src_dir}/dbfs_mounts.log", compressed=True)
    k = F.col("n_nationkey")
    key, db = k.cast("string"), F.concat(F.lit("db"), (k % 3).cast("string"))
    SK.write_artifact_tree(nation.select(
        F.concat(F.lit("/Users/u"), key, F.lit("/d/x "), key, F.lit("%20")).alias("path"),
        PL.encode_b64(F.encode(F.concat(F.lit("n"), key), "UTF-8")).alias("content")), f"{src_dir}/artifacts")
    SK.write_definition_tree(nation.select(
        db.alias("db"), F.concat(F.lit("t"), key).alias("table"),
        F.concat(F.lit("CREATE TABLE `"), db, F.lit("`.`t"), key, F.lit("` (`a` INT)\nUSING CSV")).alias("ddl")),
        f"{src_dir}/metastore", layout="tree")
    write_exact_files(spark.range(1).select(F.lit("broken").alias("path"), F.lit(
        '{"id": "x", "members": [').alias("content")), f"{src_dir}/groups")

    none = F.lit(not empty_target)
    tgt_profiles = nation.where(F.col("n_regionkey").isin(0, 1)).select(
        F.concat(F.lit(B.ARN_PREFIX), F.col("n_nationkey").cast("string")).alias("instance_profile_arn"))
    tgt_jobs = B.table(spark, sf, "orders").where(F.col("o_orderkey") % 5 == 0).select(
        (F.col("o_orderkey") + 1_000_000).alias("job_id"),
        F.struct(F.concat(F.lit("old-"), F.col("o_orderkey").cast("string")).alias("name")).alias("settings"))
    homes = B.ws_target(spark, sf)
    nothing = items.where(F.lit(False))
    _write_export(spark, tgt_dir, _users_with_roles(
        B.tgt_users(spark, sf).where(none).select("id", "userName"), B.role_pairs(spark, sf, False)),
        B.tgt_clusters(spark, sf).where(none).select("cluster_id", "cluster_name"),
        B.pools_tgt(spark, sf).where(none).drop("ord"), tgt_profiles.where(none),
        tgt_jobs.where(none), listed(homes, "DIRECTORY"), listed(nothing, "NOTEBOOK"),
        listed(nothing, "LIBRARY"))
    SK.write_jsonl(B.groups_tgt(spark, sf).where(none).drop("ord"), f"{tgt_dir}/groups")
    return src_dir, tgt_dir


def all_plan_rows(plans):
    """Every result of ``plan_all`` in one shape (kind, key, action, target_id,
    target_ref, n_items, stage)."""
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")

    def rows(df, kind, key, action, target_id=none, target_ref=none, n_items=zero, stage=F.lit(0)):
        return df.select(kind.alias("kind"), key.cast("string").alias("key"),
                         action.cast("string").alias("action"),
                         target_id.cast("string").alias("target_id"), target_ref.alias("target_ref"),
                         n_items.cast("bigint").alias("n_items"), stage.alias("stage"))
    c, lit = F.col, F.lit
    out = [rows(plans["jobs"], lit("job"), c("job_id"), c("outcome"), c("new_cluster_id"),
                c("target_ref"), stage=c("stage"))]
    for k in ("users", "groups", "instance_profiles", "instance_pools", "clusters", "cleanup"):
        if k in plans:
            out.append(rows(plans[k], c("kind"), c("key"), c("action"), c("target_id"),
                            c("target_ref"), c("n_items"), c("stage")))
    out += [
        rows(plans["acls"], c("kind"), c("ref"),
             F.when(c("has_acl"), lit("set_acl")).otherwise(lit("no_acl")), c("access_control_list"),
             c("target_permissions_path"), c("apply_order"), c("stage")),
        rows(plans["tables"], lit("table"), F.coalesce("table", "db"), c("action"), c("role"),
             stage=c("stage")),
        rows(plans["workspace"], lit("workspace"), c("upload_path"), c("action"), stage=c("stage")),
        rows(plans["workspace_gate"], lit("gate"), c("current_users"), c("status"),
             n_items=c("exported_users")),
        rows(plans["artifacts"], lit("artifact"), c("path"), c("status"), n_items=F.coalesce(
            "n_bytes", lit(0))),
        rows(plans["libraries"], lit("library"), c("path"), F.coalesce("status", lit("unknown"))),
        rows(plans["cluster_libraries"], lit("cluster_libraries"), c("cluster_id"), lit("attached"),
             n_items=c("n_libraries")),
        rows(plans["mounts"], lit("mount"), c("path"), c("source")),
        rows(plans["dropped_fields"], lit("dropped_field"), c("field"), c("kind"), n_items=c("n")),
        rows(plans["malformed"], lit("malformed"), c("log"), c("side")),
        rows(plans["ambiguous"], lit("ambiguous"), c("key"), c("kind"), c("side"), n_items=c("n")),
    ]
    all_rows = out[0]
    for o in out[1:]:
        all_rows = all_rows.unionByName(o)
    return all_rows


@query("pl_all_from_exports")
def q_pl_all(spark, sf):
    """Both workspaces exported in the reference layout, then every plan and
    report computed from the two folders, logged retries included."""
    from rehome.plans.migrate import plan_all
    src_dir, tgt_dir = export_workspaces(spark, sf)
    attempts = B.retry_attempts(spark, sf).withColumn(
        "role", F.regexp_replace("role", "^arn:role/R", B.ARN_PREFIX))
    return all_plan_rows(plan_all(spark, src_dir, tgt_dir, archive_missing=True, attempts=attempts))
