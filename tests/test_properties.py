"""Property tests: operators against brute-force Python on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rehome.operators.mapping import last_wins
from rehome.operators.retry import retry_matrix

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9)), min_size=1,
                max_size=30))
def test_last_wins_equals_dict_build(spark, rows):
    listed = [(k, i, f"v{i}-{x}") for i, (k, x) in enumerate(rows)]  # ord = listing position
    df = spark.createDataFrame(listed, "k string, ord long, v string")
    want = {}
    for k, _i, v in listed:
        want[k] = v  # a later duplicate overwrites, as a dict build does
    got = {r.k: r.v for r in last_wins(df, "k", "ord").collect()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["d.t1", "d.t2", "e.t3", "x.y.z"]),
                          st.sampled_from(["r1", "r2", "r3", "r9"]), st.booleans()), max_size=25),
       st.permutations(["r1", "r2", "r3"]))
def test_retry_matrix_equals_nested_retry_loop(spark, attempts, role_order):
    failed = ["d.t1", "d.t2", "e.t3", "x.y.z"]
    roles = [(r, i) for i, r in enumerate(role_order)]
    f = spark.createDataFrame([(t,) for t in failed], "table string")
    r = spark.createDataFrame(roles, "role string, ord int")
    a = spark.createDataFrame(attempts or [("d.t1", "r1", False)], "table string, role string, ok boolean")
    ok = {(t, ro) for t, ro, o in (attempts or []) if o}
    remaining = [t for t in failed if t.count(".") == 1]
    resolved = {}
    for role, _ in roles:  # each role in order, every still-failed table retried
        for t in list(remaining):
            if (t, role) in ok:
                resolved[t] = role
                remaining.remove(t)
    res, rem, inv = retry_matrix(f, r, a)
    assert {x.table: x.resolved_role for x in res.collect()} == resolved
    assert sorted(x.table for x in rem.collect()) == sorted(remaining)
    assert [x.table for x in inv.collect()] == ["x.y.z"]


SEGS = st.sampled_from(["Users", "u", "v", "Trash", "d"])


def _walk(items, root):
    """Reference-style listing: list a folder, recurse into sub-folders that
    are not ``<x>/Users/<u>/Trash``; the root itself is never tested."""
    import os
    kinds = dict(items)
    out = []

    def is_trash(p):
        s = p.split("/")
        return len(s) == 4 and s[1] == "Users" and s[3] == "Trash"

    def ls(d):
        for p in sorted(kinds):
            if os.path.dirname(p) == d:
                if kinds[p] != "DIRECTORY":
                    out.append(p)
                elif not is_trash(p):
                    out.append(p)
                    ls(p)
    ls(root)
    return sorted(out)


@SETTINGS
@given(st.lists(st.tuples(st.lists(SEGS, min_size=1, max_size=4),
                          st.sampled_from(["DIRECTORY", "NOTEBOOK", "LIBRARY"])), min_size=1, max_size=25))
def test_reachable_equals_walk_on_random_trees(spark, entries):
    from rehome.operators.workspace import reachable
    kinds = {}
    for segs, kind in entries:
        path = "/" + "/".join(segs)
        for i in range(1, len(segs)):  # complete tree: every ancestor is a folder
            kinds["/" + "/".join(segs[:i])] = "DIRECTORY"
        kinds.setdefault(path, kind)
    # a path that is an ancestor of another must be a folder
    for p in list(kinds):
        if any(q.startswith(p + "/") for q in kinds):
            kinds[p] = "DIRECTORY"
    items = spark.createDataFrame([(p, i, t) for i, (p, t) in enumerate(sorted(kinds.items()))],
                                  "path string, object_id long, object_type string")
    for root in ["/", "/Users", "/Users/u", "/Users/u/Trash"]:
        got = sorted(r.path for r in reachable(items, root).collect())
        assert got == _walk(kinds.items(), root), root


ROLES = st.one_of(st.none(), st.lists(st.sampled_from(["r1", "r2", "r3"]), max_size=3))


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "b", "c"]), ROLES), st.dictionaries(st.sampled_from(["a", "b", "d"]), ROLES))
def test_role_delta_equals_set_difference(spark, saved, current):
    from rehome.operators.setops import role_delta, role_pairs
    sch = "userName string, roles array<struct<value:string>>"

    def frame(d):
        rows = [(u, None if rs is None else [{"value": r} for r in rs]) for u, rs in d.items()]
        return spark.createDataFrame(rows or [("zz", None)], sch)
    got = sorted(tuple(r) for r in role_delta(role_pairs(frame(saved)), role_pairs(frame(current))).collect())
    want = sorted((u, r) for u, rs in saved.items()
                  for r in set(rs or []) - set(current.get(u) or []))
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=12),
       st.lists(st.sampled_from(["a", "c", "e", None]), max_size=6))
def test_skip_existing_partitions_its_input(spark, cands, target):
    from rehome.operators.mapping import skip_existing
    c = spark.createDataFrame([(i, k) for i, k in enumerate(cands)] or [(0, None)], "i long, name string")
    t = spark.createDataFrame([(k,) for k in target] or [(None,)], "name string")
    create, skipped, invalid = skip_existing(c, t, "name")
    ids = [sorted(r.i for r in df.collect()) for df in (create, skipped, invalid)]
    assert sorted(ids[0] + ids[1] + ids[2]) == sorted(r.i for r in c.collect())
    names = {r.name for r in c.collect()}
    tset = {k for k in target if k is not None}
    assert {r.name for r in create.collect()} == {n for n in names if n is not None and n not in tset}
    assert all(r.name is None for r in invalid.collect())


@SETTINGS
@given(st.lists(st.one_of(st.dictionaries(st.sampled_from(["id", "name", "x", "y", "z"]),
                                          st.one_of(st.none(), st.integers(0, 9), st.just([]))),
                          st.just("not json")), max_size=12))
def test_unexpected_fields_equals_python_json(spark, docs):
    import json
    from collections import Counter

    from rehome.operators.setops import unexpected_fields
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    df = spark.createDataFrame([(t,) for t in texts] or [(None,)], "doc string")
    got = {r.field: r.n for r in unexpected_fields(df, "doc", ["id", "name"]).collect()}
    want = Counter(k for d in docs if isinstance(d, dict) for k in d if k not in ("id", "name"))
    assert got == dict(want)
