"""Path expressions against plain-Python statements of the reference rules."""

import os


from rehome.functions import paths as P

PATHS = ["/Users/a@x.com/nb", "/Users", "/Users/", "/Users/a", "/Users//a/b", "/Shared/x",
         "/", "", "/Users/a/Trash", "/Users/a/Trash/x", "/Users/a/b/Trash", "/Users/a/Trashy",
         "/Users/a/", "//Users/a/b", "/Users/Users/x", "a/Users/b/Trash"]


def parts(p):
    return [x for x in p.split("/") if x]


def ref_user_item(p):
    pl = parts(p)
    return len(pl) >= 2 and pl[0] == "Users"


def ref_user_root(p):
    if p in ("/Users/", "/Users"):
        return True
    pl = parts(p)
    return len(pl) == 2 and pl[0] == "Users"


def ref_trash(p):
    pl = p.split("/")
    return len(pl) == 4 and pl[1] == "Users" and pl[3] == "Trash"


def test_path_predicates_match_rules(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    rows = df.select("path", P.is_user_item("path").alias("item"), P.is_user_root("path").alias("root"),
                     P.path_user("path").alias("user"), P.is_trash_dir("path").alias("trash"),
                     P.dir_name("path").alias("d"), P.base_name("path").alias("b"),
                     P.archive_path("path").alias("arch"), P.path_depth("path").alias("depth")).collect()
    for r in rows:
        p = r["path"]
        assert r["item"] == ref_user_item(p), p
        assert r["root"] == ref_user_root(p), p
        pl = parts(p)
        assert r["user"] == (pl[1] if len(pl) >= 2 else None), p
        assert r["trash"] == ref_trash(p), p
        assert r["d"] == os.path.dirname(p), p
        assert r["b"] == os.path.basename(p), p
        assert r["depth"] == len(pl)
        if ref_user_item(p):
            assert r["arch"] == p.replace("Users", "Archive", 1), p


def test_strip_ext_and_subtree(spark):
    df = spark.createDataFrame([("/a/b.dbc",), ("abc",), ("",), (None,)], "p string")
    got = [r[0] for r in df.select(P.strip_ext("p")).collect()]
    assert got == ["/a/b", "", "", None]
    items = spark.createDataFrame([("/Users/a",), ("/Users/a/x",), ("/Users/ab/x",), ("/",)], "path string")
    sub = sorted(r[0] for r in items.where(P.in_subtree("path", "/Users/a")).collect())
    assert sub == ["/Users/a/x"]
    assert items.where(P.in_subtree("path", "/")).count() == 3


def test_clean_keys(spark):
    df = spark.createDataFrame([("  bob ", "db\nname")], "u string, d string")
    r = df.select(P.clean_user_name("u").alias("u"), P.clean_db_name("d").alias("d")).first()
    assert (r.u, r.d) == ("bob", "dbname")
