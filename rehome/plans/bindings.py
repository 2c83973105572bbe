"""Snapshot views derived from the driver's tables.

The driver only ships TPC-H-like tables, so each snapshot kind is a view
over them in the declared schema of ``rehome.schemas``.  A view reads its
whole table; where a *target* snapshot must differ from the *source*, the
difference is a deterministic rule on the key (e.g. every fourth customer
is missing on the target), so the work always grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rehome.session import bounded_broadcast, fits_many, side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# -- B-src / B-tgt: clusters or users, old and new ----------------------------
def src_clusters(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(_s("c_custkey").alias("cluster_id"), F.col("c_name").alias("cluster_name"),
                    F.col("c_custkey").alias("ord"))


def tgt_clusters(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").where(F.col("c_custkey") % 4 != 0)
    return c.select(_s(F.col("c_custkey") + 500000).alias("cluster_id"),
                    F.col("c_name").alias("cluster_name"), F.col("c_custkey").alias("ord"))


def src_users(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(_s("c_custkey").alias("id"), F.col("c_name").alias("userName"),
                    F.col("c_custkey").alias("ord"))


def tgt_users(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").where(F.col("c_custkey") % 4 != 0)
    return c.select(_s(F.col("c_custkey") + 500000).alias("id"),
                    F.col("c_name").alias("userName"), F.col("c_custkey").alias("ord"))


# Undeclared and nested keys that a payload must keep as they are.
JOB_REST = (',"libraries":[{"jar":"dbfs:/x.jar"},{"pypi":{"package":"p"}}],"email_notifications":'
            '{"on_failure":["a@example.com"]},"max_retries":null,"spark_jar_task":'
            '{"main_class_name":"m.M","parameters":["1",2,1.50]},"twice":{"k":1,"k":{"k":2}},'
            '"big":12345678901234567890123456789012345678901234567890, "sp" : [ 1.10 ,"}{\\"" ]')
CLUSTER_REST = (',"init_scripts":[{"dbfs":{"destination":"dbfs:/i.sh","n":1.10,"n":2}}],"cluster_log_conf":'
                '{"dbfs":{"destination":"dbfs:/logs"}}')


# A document nested too deeply to be edited, in one job of 1,024.
TOO_DEEP = ',"deep":' + "[" * 40 + "]" * 40


# -- B-job: jobs ----------------------------------------------------------------
def jobs(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    settings = F.struct(
        F.concat(F.lit("order-"), _s("o_orderkey")).alias("name"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(_s("o_custkey")).alias("existing_cluster_id"),
        F.lit(None).cast("struct<spark_version:string,node_type_id:string,num_workers:bigint,"
                         "enable_elastic_disk:boolean,spark_env_vars:map<string,string>,"
                         "aws_attributes:struct<zone_id:string,first_on_demand:bigint,"
                         "availability:string>>").alias("new_cluster"),
    )
    return o.select(F.col("o_orderkey").alias("job_id"), settings.alias("settings"),
                    F.concat(F.lit('{"job_id":'), _s("o_orderkey"), F.lit(',"settings":{"name":"order-'),
                             _s("o_orderkey"), F.lit('"'),
                             F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.concat(
                                 F.lit(',"existing_cluster_id":"'), _s("o_custkey"), F.lit('"'))),
                             F.lit(',"schedule":{"quartz_cron_expression":"0 0 '),
                             _s(F.col("o_orderkey") % 24),
                             F.lit(' * * ?","timezone_id":"UTC"}'), F.lit(JOB_REST),
                             F.when(F.col("o_orderkey") % 1024 == 7, F.lit(TOO_DEEP)).otherwise(F.lit("")),
                             F.lit("}}")).alias("doc"))


def user_name(custkey) -> Column:
    """``Customer#000000042`` (equal to ``c_name`` for the same key)."""
    return F.concat(F.lit("Customer#"), F.lpad(_s(custkey), 9, "0"))


# -- B-ws: workspace items (source) and homes (target) ----------------------------
def ws_type() -> Column:
    k = F.col("o_orderkey") % 3
    return (F.when(k == 0, F.lit("DIRECTORY")).when(k == 1, F.lit("NOTEBOOK"))
            .otherwise(F.lit("LIBRARY")))


def ws_path() -> Column:
    return F.concat(F.lit("/Users/u"), _s("o_custkey"),
                    F.when(F.col("o_orderkey") % 10 == 0, F.lit("/Trash/")).otherwise(F.lit("//d/")),
                    F.lit("n"), _s("o_orderkey"))


def ws_items(spark, sf) -> DataFrame:
    """Order items below user homes (every tenth in Trash), one home folder
    per customer, and a ``Trash`` entry for every seventh customer (a
    folder for even keys, a notebook called Trash for odd keys)."""
    o = table(spark, sf, "orders").select(
        ws_path().alias("path"), F.col("o_orderkey").alias("object_id"), ws_type().alias("object_type"))
    c = table(spark, sf, "customer")
    homes = c.select(F.concat(F.lit("/Users/u"), _s("c_custkey")).alias("path"),
                     (F.col("c_custkey") + 1_000_000_000).alias("object_id"),
                     F.lit("DIRECTORY").alias("object_type"))
    trash = c.where(F.col("c_custkey") % 7 == 0).select(
        F.concat(F.lit("/Users/u"), _s("c_custkey"), F.lit("/Trash")).alias("path"),
        (F.col("c_custkey") + 2_000_000_000).alias("object_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("DIRECTORY")).otherwise(F.lit("NOTEBOOK"))
        .alias("object_type"))
    return o.unionByName(homes).unionByName(trash)


def tree_items(spark, sf) -> DataFrame:
    """(object_id, parent_id, trash): customers are folders in chains of 30;
    some chains hang from a folder that was never listed, some bite their own
    tail, some folders are trash.  Orders are items in the folder of their
    customer."""
    k = F.col("c_custkey")
    chain = F.floor(k / 30)
    head = (F.when(chain % 7 == 3, k + 1_000_000_000_000)
            .when(chain % 7 == 5, k + 29 - k % 30))
    folders = table(spark, sf, "customer").select(k.alias("object_id"), F.when((k % 30 == 0) | (k == 1), head).otherwise(k - 1)
                       .alias("parent_id"), (k % 41 == 9).alias("trash"))
    return folders.unionByName(table(spark, sf, "orders").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("object_id"), F.col("o_custkey").alias("parent_id"),
        F.lit(False).alias("trash")))


def ws_target(spark, sf) -> DataFrame:
    """Target homes: a folder for customers kept on the target; a notebook
    squatting on the home path for every eighth customer."""
    c = table(spark, sf, "customer")
    t = (F.when(F.col("c_custkey") % 4 != 0, F.lit("DIRECTORY"))
         .when(F.col("c_custkey") % 8 == 0, F.lit("NOTEBOOK")))
    return c.select(F.concat(F.lit("/Users/u"), _s("c_custkey")).alias("path"),
                    (F.col("c_custkey") + 3_000_000_000).alias("object_id"),
                    t.alias("object_type")).where(F.col("object_type").isNotNull())


def acl_docs(spark, sf) -> DataFrame:
    """ACLs logged for items with an even id, keyed ``/<kind>/<id>``; every
    twelfth id was logged again later (``ord`` 2) with other rights."""
    it = ws_items(spark, sf).where((F.col("object_id") % 2 == 0)
                                   & F.col("object_type").isin("NOTEBOOK", "DIRECTORY"))
    kind = F.when(F.col("object_type") == "NOTEBOOK", F.lit("notebooks")).otherwise(
        F.lit("directories"))

    def logged(items, ord_, right):
        acl = F.concat(F.lit('[{"user_name":"'), F.regexp_extract("path", r"^/Users/([^/]*)", 1),
                       F.lit(f'","permission_level":"{right}"}}]'))
        return items.select(F.concat(F.lit("/"), kind, F.lit("/"), _s("object_id")).alias("object_id"),
                            acl.alias("access_control_list"), F.lit(ord_).cast("long").alias("ord"))
    return logged(it, 1, "CAN_MANAGE").unionByName(
        logged(it.where(F.col("object_id") % 12 == 0), 2, "CAN_READ"))


# -- B-role ---------------------------------------------------------------------
def role_pairs(spark, sf, saved: bool | None) -> DataFrame:
    """(user, role): saved or current roles by the key's parity, all for None."""
    o = table(spark, sf, "orders")
    if saved is not None:
        o = o.where(F.col("o_orderkey") % 2 == (0 if saved else 1))
    return o.select(user_name("o_custkey").alias("user"),
                    F.col("o_orderpriority").alias("role")).distinct()


# -- B-pool / clusters with pools, profiles ---------------------------------------
def pools_src(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation")
    doc = F.concat(F.lit('{"instance_pool_id":"pool-'), _s("n_nationkey"),
                   F.lit('","instance_pool_name":"'), F.col("n_name"),
                   F.lit('","min_idle_instances":'), _s("n_regionkey"),
                   F.lit(',"custom":{"b":[1,null],"a":1.0}}'))
    return n.select(F.concat(F.lit("pool-"), _s("n_nationkey")).alias("instance_pool_id"),
                    F.col("n_name").alias("instance_pool_name"),
                    F.lit(1).cast("long").alias("ord"), doc.alias("doc"))


def pools_tgt(spark, sf) -> DataFrame:
    """Four of five pools; every third name is listed again later under
    another id, which counts."""
    n = table(spark, sf, "nation").where(F.col("n_nationkey") % 5 != 0)

    def listed(rows, shift, ord_):
        return rows.select(F.concat(F.lit("pool-"), _s(F.col("n_nationkey") + shift))
                           .alias("instance_pool_id"), F.col("n_name").alias("instance_pool_name"),
                           F.lit(ord_).cast("long").alias("ord"))
    return listed(n, 1000, 1).unionByName(listed(n.where(F.col("n_nationkey") % 3 == 0), 2000, 2))


ARN_PREFIX = "arn:aws:iam::profile/"


def profiles_src(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.concat(F.lit(ARN_PREFIX), _s("n_nationkey")).alias("instance_profile_arn"))


def profiles_registered(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation").where(F.col("n_regionkey") != 2)
    return n.select(F.concat(F.lit(ARN_PREFIX), _s("n_nationkey")).alias("instance_profile_arn"))


def clusters_full(spark, sf) -> DataFrame:
    """Source clusters in the CLUSTERS schema, derived from customer."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    name = (F.when(k % 50 == 0, F.concat(F.lit("job-"), _s(k), F.lit("-run-"), _s("c_nationkey")))
            .when(k % 70 == 0, F.concat(F.lit("mlflow-model-"), _s(k)))
            .otherwise(F.col("c_name")))
    aws = F.struct(F.lit("us-east-1a").alias("zone_id"), F.lit(1).cast("long").alias("first_on_demand"),
                   F.lit("SPOT_WITH_FALLBACK").alias("availability"),
                   F.lit(None).cast("long").alias("spot_bid_price_percent"),
                   F.lit(None).cast("long").alias("ebs_volume_count"),
                   F.when(k % 2 == 0, F.concat(F.lit(ARN_PREFIX), _s("c_nationkey")))
                   .alias("instance_profile_arn"))
    return c.select(
        _s(k).alias("cluster_id"), name.alias("cluster_name"),
        F.concat(_s(F.col("c_nationkey") % 12 + 1), F.lit("."), _s(k % 4), F.lit(".x-scala2.12"))
        .alias("spark_version"),
        F.lit("i3.xlarge").alias("node_type_id"), F.lit("i3.xlarge").alias("driver_node_type_id"),
        F.col("c_nationkey").cast("long").alias("num_workers"),
        F.lit(None).cast("struct<min_workers:bigint,max_workers:bigint>").alias("autoscale"),
        F.lit(60).cast("long").alias("autotermination_minutes"),
        (k % 2 == 1).alias("enable_elastic_disk"),
        F.concat(F.lit("u"), _s(k)).alias("creator_user_name"),
        F.lit(None).cast("map<string,string>").alias("spark_env_vars"),
        aws.alias("aws_attributes"),
        F.when(k % 3 == 0, F.create_map(F.lit("team"), F.col("c_mktsegment"))).alias("custom_tags"),
        F.lit(None).cast("map<string,string>").alias("spark_conf"),
        F.when(k % 45 == 0, F.lit("pool-gone"))
        .when(k % 5 == 0, F.concat(F.lit("pool-"), _s("c_nationkey"))).alias("instance_pool_id"),
        F.when(F.col("c_acctbal") > 9000, F.lit("admin")).alias("pinned_by_user_name"),
        F.col("c_mktsegment").alias("state"),
    ).withColumn("doc", cluster_doc())


def _opt(col: str, before: str, after: str = '"') -> Column:
    """A key of a JSON text that is left out for null."""
    return F.coalesce(F.concat(F.lit(before), F.col(col).cast("string"), F.lit(after)), F.lit(""))


def cluster_doc() -> Column:
    """The whole document of a ``clusters_full`` row, undeclared keys included."""
    return F.concat(
        F.lit('{"cluster_id":"'), F.col("cluster_id"), F.lit('","cluster_name":"'),
        F.col("cluster_name"), F.lit('","spark_version":"'), F.col("spark_version"),
        F.lit('","node_type_id":"i3.xlarge","driver_node_type_id":"i3.xlarge","num_workers":'),
        _s("num_workers"), F.lit(',"autotermination_minutes":60,"enable_elastic_disk":'),
        _s("enable_elastic_disk"), F.lit(',"creator_user_name":"'), F.col("creator_user_name"),
        F.lit('","aws_attributes":{"availability":"SPOT_WITH_FALLBACK","ebs_volume_size":100,'
              '"ebs_volume_type":"GENERAL_PURPOSE_SSD","first_on_demand":1'),
        F.coalesce(F.concat(F.lit(',"instance_profile_arn":"'),
                            F.col("aws_attributes.instance_profile_arn"), F.lit('"')), F.lit("")),
        F.lit(',"zone_id":"us-east-1a"}'),
        F.coalesce(F.concat(F.lit(',"custom_tags":{"team":"'), F.col("custom_tags")["team"],
                            F.lit('"}')), F.lit("")),
        _opt("instance_pool_id", ',"instance_pool_id":"'),
        _opt("pinned_by_user_name", ',"pinned_by_user_name":"'),
        F.lit(CLUSTER_REST), F.lit(',"state":"RUNNING","undeclared":{"a":[1,null]}}'))


def supplier_clusters(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(_s("s_suppkey").alias("cluster_id"), F.col("s_name").alias("cluster_name"),
                    F.struct(F.lit("us-east-1a").alias("zone_id"),
                             F.concat(F.lit(ARN_PREFIX), _s("s_nationkey"))
                             .alias("instance_profile_arn")).alias("aws_attributes"))


# -- B-grp: groups, exploded members, users ------------------------------------------
USER_REF = "scim/v2/Users/"
GROUP_REF = "scim/v2/Groups/"


def groups_src(spark, sf) -> DataFrame:
    seg = table(spark, sf, "customer").select(
        F.concat(F.lit("seg-"), F.col("c_mktsegment")).alias("id"),
        F.col("c_mktsegment").alias("displayName")).distinct()
    nat = table(spark, sf, "nation").select(
        F.concat(F.lit("nat-"), _s("n_nationkey")).alias("id"), F.col("n_name").alias("displayName"))
    return seg.unionByName(nat)


def groups_tgt(spark, sf) -> DataFrame:
    """Target groups; the first region's nation groups are listed again later
    under another id, which counts."""
    seg = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("displayName")).distinct()
    n = table(spark, sf, "nation")
    nat = n.where(F.col("n_regionkey") != 2).select(F.col("n_name").alias("displayName"))
    again = n.where(F.col("n_regionkey") == 0).select(F.col("n_name").alias("displayName"))
    return (seg.unionByName(nat).select(F.concat(F.lit("T-"), "displayName").alias("id"),
                                        "displayName", F.lit(1).cast("long").alias("ord"))
            .unionByName(again.select(F.concat(F.lit("T2-"), "displayName").alias("id"),
                                      "displayName", F.lit(2).cast("long").alias("ord"))))


def group_members(spark, sf) -> DataFrame:
    """Exploded member rows: users in their segment group and their nation
    group, and each nation group inside the segment groups it occurs in.
    Every 97th customer's segment membership has no ``$ref``."""
    c = table(spark, sf, "customer")
    n = bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    cols = ["group_id", "group_name", "value", "display", "ref", "userName", "type"]
    none = F.lit(None).cast("string")
    seg_users = c.select(
        F.concat(F.lit("seg-"), F.col("c_mktsegment")).alias("group_id"),
        F.col("c_mktsegment").alias("group_name"), _s("c_custkey").alias("value"),
        F.col("c_name").alias("display"),
        F.when(F.col("c_custkey") % 97 == 0, none)
        .otherwise(F.concat(F.lit(USER_REF), _s("c_custkey"))).alias("ref"),
        none.alias("userName"), none.alias("type"))
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    nat_users = cn.select(
        F.concat(F.lit("nat-"), _s("c_nationkey")).alias("group_id"),
        F.col("n_name").alias("group_name"), _s("c_custkey").alias("value"),
        F.col("c_name").alias("display"), F.concat(F.lit(USER_REF), _s("c_custkey")).alias("ref"),
        none.alias("userName"), none.alias("type"))
    nat_in_seg = cn.select("c_mktsegment", "c_nationkey", "n_name").distinct().select(
        F.concat(F.lit("seg-"), F.col("c_mktsegment")).alias("group_id"),
        F.col("c_mktsegment").alias("group_name"),
        F.concat(F.lit("nat-"), _s("c_nationkey")).alias("value"),
        F.col("n_name").alias("display"),
        F.concat(F.lit(GROUP_REF), F.lit("nat-"), _s("c_nationkey")).alias("ref"),
        none.alias("userName"), none.alias("type"))
    return seg_users.select(cols).unionByName(nat_users.select(cols)).unionByName(nat_in_seg.select(cols))


def group_roles(spark, sf) -> DataFrame:
    """Segment groups carry the priorities their customers ordered with."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(F.col("c_mktsegment").alias("group_name"),
                    F.col("o_orderpriority").alias("role")).distinct()


# -- B-att: failed tables, roles, attempts; B-ddl definitions -----------------------
def _tbl_name(k) -> Column:
    return F.concat(F.lit("db"), _s(k % 20), F.lit(".t"), _s(k))


def table_names(spark, sf) -> DataFrame:
    """A qualified name per part; every seventeenth has a third part."""
    p = table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 17 == 0, F.concat(_tbl_name(F.col("p_partkey")), F.lit(".x"))) \
        .otherwise(_tbl_name(F.col("p_partkey")))
    return p.select(name.alias("table"), "p_size")


def failed_tables(spark, sf) -> DataFrame:
    return table_names(spark, sf).where(F.col("p_size") % 3 == 0).select("table")


def retry_roles(spark, sf) -> DataFrame:
    r = table(spark, sf, "region")
    return r.select(F.concat(F.lit("arn:role/R"), _s("r_regionkey")).alias("role"),
                    F.col("r_regionkey").alias("ord"))


def retry_attempts(spark, sf) -> DataFrame:
    """Each line item is an attempt to export its part's table under the
    role of its supplier's region."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    # supplier grows with the scale factor: broadcast only below the checked bound
    ok = fits_many({"s": table(spark, sf, "supplier"), "n": table(spark, sf, "nation")})
    s = side(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), ok["s"])
    n = side(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), ok["n"])
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(n, F.col("s_nationkey") == n["n_nationkey"])
    return j.select(_tbl_name(F.col("l_partkey")).alias("table"),
                    F.concat(F.lit("arn:role/R"), _s("n_regionkey")).alias("role"),
                    ((F.col("l_orderkey") + F.col("l_linenumber")) % 29 == 0).alias("ok"))


DDL_TYPES = ("INT", "STRING COMMENT 'a, `x` INT) COMMENT'", "DECIMAL(10,2) COMMENT 'x'",
             "STRUCT<a:INT,b:ARRAY<STRING>>", "MAP<STRING,DECIMAL(5,1)>")


def table_defs(spark, sf) -> DataFrame:
    """(db, table, ddl): a CREATE TABLE text per part."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    db = F.concat(F.lit("db"), _s(k % 20))
    tb = F.concat(F.lit("t"), _s(k))
    # Quoted and plain names; types and comments with commas, brackets and
    # parentheses of their own.
    tick = F.when(k % 2 == 0, F.lit("`")).otherwise(F.lit(""))
    cols = F.array_join(F.transform(
        F.sequence(F.lit(1), F.col("p_size") % 20 + 1),
        lambda i: F.concat(tick, F.lit("c"), i.cast("string"), tick, F.lit(" "),
                           F.when(i % 5 == 0, F.lit(DDL_TYPES[0])).when(i % 5 == 1, F.lit(DDL_TYPES[1]))
                           .when(i % 5 == 2, F.lit(DDL_TYPES[2])).when(i % 5 == 3, F.lit(DDL_TYPES[3]))
                           .otherwise(F.lit(DDL_TYPES[4])))), ", ")
    provider = F.when(F.col("p_size") % 3 == 0, F.lit("CSV")).when(
        F.col("p_size") % 3 == 1, F.lit("PARQUET")).otherwise(F.lit("JSON"))
    opts = F.when(k % 2 == 0, F.concat(F.lit("\nOPTIONS (\n  `header` 'true',\n  path '/data/"),
                                       _s(k), F.lit("'\n)"))).otherwise(F.lit(""))
    ddl = F.concat(F.lit("CREATE TABLE `"), db, F.lit("`.`"), tb, F.lit("` ("), cols,
                   F.lit(")\nUSING "), provider, opts,
                   F.lit("\nCOMMENT '"), F.repeat(F.col("p_name"), F.col("p_size")), F.lit("'"))
    return p.select(db.alias("db"), tb.alias("table"), ddl.alias("ddl"))


# -- B-name, B-ver, B-dup ---------------------------------------------------------------
def cluster_names(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    base = F.concat(F.lit("job-"), _s("event_id"), F.lit("-run-"), _s("user_id"))
    name = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("mlflow-model-"), base)) \
        .when(F.col("event_id") % 7 == 0, F.concat(base, F.lit("x"))).otherwise(base)
    return e.select("event_id", name.alias("cluster_name"))


def versions(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    key = F.concat(_s("p_size"), F.lit("."), _s(F.col("p_partkey") % 10), F.lit(".x-"),
                   F.when(F.col("p_partkey") % 3 == 0, F.lit("cpu-ml-")).otherwise(F.lit("")),
                   F.lit("scala2.12"))
    return p.select(key.alias("key"), F.col("p_partkey").alias("ord"))
