"""Brute-force comparisons and edge cases of operators 1 to 5 and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rehome.llm import ann, minhash, mixing, suffix, urlrules
from rehome.llm.components import connected

WORDS = [f"w{i}" for i in range(400)]


def near_sets(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x)
         for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_groups(docs, percent=85):
    sets = {i: near_sets(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def near_corpus(seed):
    """Copies, chains of ever more edited copies and groups around a base."""
    rng = random.Random(seed)
    docs = ["", None, "a b", "A  b", "one", " \n ", "x"]
    for _ in range(25):
        docs.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 80))))
    for _ in range(4):
        base = [rng.choice(WORDS) for _ in range(rng.randint(60, 160))]
        for _ in range(12):
            base = edited(rng, base, 1) if rng.random() < 0.5 else base
            docs.append(" ".join(edited(rng, base, rng.randint(0, 2))))
    rng.shuffle(docs)
    return list(enumerate(docs, 100))


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_equal_brute_force(spark, seed):
    docs = near_corpus(seed)
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_groups(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=80)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {
        i: c for i, (_, c) in brute_groups(docs, 80).items()}


def test_near_duplicates_exact_rest_joins_what_stars_miss(spark, monkeypatch):
    """With only links to each bucket's first document the middle of a chain
    would be lost; small blocks make the comparison meet across them."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "CHUNK", 2)
    rng = random.Random(3)
    base = [rng.choice(WORDS) for _ in range(400)]
    docs = []
    for i in range(14):  # neighbours are similar, distant ones are not
        base = base[:i * 24] + edited(rng, base[i * 24:i * 24 + 24], 3) + base[i * 24 + 24:]
        docs.append((i, " ".join(base)))
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_groups(docs)


def test_near_duplicates_edge_rows(spark):
    rows = [(None, "a b c d e f", "z"), (5, "a b c d e f", "z"), (5, "a b c d e f", "z"),
            (7, "a b c d e f", "z"), (8, None, "z"), (9, "long " * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
           for r in minhash.near_duplicates(df).collect()]
    assert sorted(out, key=str) == sorted(
        [(None, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False),
         (8, 0, 8, True), (9, 1, 9, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.0, 0.5, 0.85):
        n = int(len(a) * share)
        got = []
        for _ in range(12):
            keep = rng.permutation(a)[:n]
            x = np.concatenate((keep, rng.integers(0, 1 << 63, len(a) - n, dtype=np.uint64)))
            y = np.concatenate((keep, rng.integers(0, 1 << 63, len(a) - n, dtype=np.uint64)))
            sx, sy = (np.array(minhash.signature(minhash.minima(s))[1]).view(np.uint64)
                      for s in (x, y))
            d = sx ^ sy
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            same = minhash.HASHES - int(np.bitwise_count(d & np.uint64(minhash._LOW_BITS)).sum())
            got.append(minhash.estimate(same))
        assert abs(np.mean(got) - n / (2 * len(a) - n)) < 0.06


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(1, 40)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in
           connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == components(nodes, [e for e in edges if e[0] != e[1]])


def brute_verdicts(urls, rules):
    out = []
    for i, u in urls:
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
               if None not in (h, p, v) and (host == h or host.endswith("." + h) or h == "")
               and path.startswith(p)]
        best = max(fit, default=None)
        out.append((i, host, path, best and best[3], best[4] if best else "allow"))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_url_rules_equal_brute_force(spark, parts):
    rng = random.Random(4)
    label = ["a", "b", "net", "x-y", "", "é", "org"]
    path = ["", "/", "/a", "/a/b", "/b", "/a/bc"]
    rules = [(".".join(rng.choice(label) for _ in range(rng.randint(1, 3))), rng.choice(path),
              rng.choice(["block", "allow"])) for _ in range(60)]
    rules += [(None, "/", "block"), ("net", "/", None), ("org", "/", "block"), ("org", "/", "allow")]
    urls = [(0, None), (1, ""), (2, "no-scheme/a"), (3, "http://"), (None, "http://a.net/"),
            (3, "http://"), (4, "s://A.NET/a?b#c"), (5, "s://net" + "/a" * 20_000)]
    urls += [(i, "http://" + ".".join(rng.choice(label) for _ in range(rng.randint(1, 4)))
              + rng.choice(path) + rng.choice(["", "?q://x.net/", "#f"])) for i in range(6, 400)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit(1))
        got = urlrules.judge_urls(df, spark.createDataFrame(
            rules, "host string, path string, verdict string")).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute_verdicts(urls, rules)
        none = spark.createDataFrame([], "host string, path string, verdict string")
        assert {(r["rule"], r["verdict"]) for r in
                urlrules.judge_urls(df, none, default="block").collect()} == {(None, "block")}
        assert urlrules.judge_urls(df.limit(0), none).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def exact_nearest(rows, k=10):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and any(v)
            and all(x is not None and np.isfinite(x) for x in v)}
    out = {}
    for q, v in good:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i)
                       for i, x in good if i != q and len(x) == len(v))
            out[q] = [i for _, i in d[:k]]
    return out


def test_nearest_recall_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 700)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).round(3)
    x[500:900] = x[0]  # many copies of a query
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] + [1.0] * 15),
             (9300, [None] + [1.0] * 15), (9400, []), (None, [1.0] * 16), (9500, [1.0, 2.0]),
             (9501, [1.0, 2.5]), (200, x[200].tolist()), (9600, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>") \
        .withColumn("rank", F.lit("r"))
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact_nearest(rows)
    assert set(got) == set(want)
    assert got[0] == list(range(500, 510)) and got[9500] == [9501]
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert ann.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_mixing_targets_and_bounds(spark):
    rng = random.Random(6)
    docs = [(i, " ".join("x" * rng.randint(0, 30)), rng.choice(["big"] * 5 + ["a", "é", None, "z"]))
            for i in range(500)]
    docs += [(1, None, "a"), (None, "x x", "z"), (None, "x x", "z"), (600, "x " * 5000, "é")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string") \
        .withColumn("taken", F.lit(0))
    rows = mixing.mix_sources(df).collect()
    assert len(rows) == len(docs)
    again = mixing.mix_sources(df.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        share = (left - sum(2 * sizes[s] for s in full)) / sum(
            weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and share * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 2 * sizes[s] if s in full else share * weight[s] for s in order}
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0)
        if r["position"] is not None:
            assert 0 <= r["position"] < 1
            assert r["repeat_position"] is None or r["repeat_position"] > r["position"]
        t = by.setdefault((r["source_size"], round(r["target"], 6)), 0)
        by[(r["source_size"], round(r["target"], 6))] = t + r["taken"]
    assert set(by) == {(sizes[s], round(target[s], 6)) for s in order}
    assert all(abs(t - taken) <= 0.5 for (_, t), taken in by.items())
    at = [r["position"] for r in rows if r["position"] is not None]
    assert at == sorted(at)


def shuffled(df):
    """(bytes written, largest partition) of each shuffle that ``df`` has run."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName() == "ShuffleQueryStageExec":
            sizes = list(p.mapStats().get().bytesByPartitionId())
            out.append((sum(sizes), max(sizes)))
            p = p.plan()
        elif p.getClass().getSimpleName().endswith("QueryStageExec"):
            p = p.plan()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_mixing_deals_out_rows_of_one_id(spark):
    docs = [(None, "x " * (i % 7), "a") for i in range(40_000)] + [(5, "x x", "a")] * 9000
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix_sources(df, max_passes=1, budget_share=0.5)
    large = [x for x in shuffled(out) if x[0] > 20_000]
    assert all(most < 0.6 * total for total, most in large)
    rows = sorted(((r["position"], r["size"], r["taken"]) for r in out.collect()
                   if r["taken"]))
    sizes = {None: sorted(i % 7 for i in range(40_000)), 5: [2] * 9000}
    order = sizes[5] + sizes[None] if hashlib.md5(b"5").hexdigest() < hashlib.md5(b"").hexdigest() \
        else sizes[None] + sizes[5]
    left, want = -(-sum(order) // 2), []
    for x in order:
        if min(x, left) > 0:
            want.append((x, min(x, left)))
            left -= min(x, left)
    assert [x[1:] for x in rows] == want and len({x[0] for x in rows}) == len(rows)


def test_mixing_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.mix_sources(df).collect()} \
        == {(0, 0.0, 0)}
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_schedule_inverse(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))
    grid = np.linspace(0, 0.999, 60)
    df = spark.createDataFrame([(float(u),) for u in grid], "u double")
    got = [r[0] for r in df.select(mixing.invert(F.col("u"), knots)).collect()]
    t = np.linspace(0, 1, 200_001)
    w = np.interp(t, *zip(*knots, strict=True))
    area = np.concatenate(([0], np.cumsum((w[1:] + w[:-1]) / 2))) / (len(t) - 1)
    assert abs(mixing.integral(knots) - area[-1]) < 1e-8
    assert np.abs(np.interp(np.array(got), t, area) / area[-1] - grid).max() < 1e-4


def brute_repeats(docs):
    seen = {}
    words = {i: [x.lower() for x in (t or "").split()] for i, t in docs if i is not None}
    for i, w in words.items():
        for s in range(len(w) - 49):
            seen.setdefault(tuple(w[s:s + 50]), set()).add(i)
    out = {}
    for i, w in words.items():
        hit = set()
        for s in range(len(w) - 49):
            if len(seen[tuple(w[s:s + 50])]) > 1:
                hit |= set(range(s, s + 50))
        if hit:
            out[i] = hit
    return out


@pytest.mark.parametrize("seed", range(2))
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice(WORDS) for _ in range(n)] for n in (49, 50, 51, 60, 90, 200)]
    docs = [(0, None), (1, ""), (None, " ".join(passages[3])), (2, "Q " * 30_000)]
    for i in range(3, 60):
        w = [rng.choice(WORDS) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, max(0, len(p) - 52))
            at = rng.randint(0, len(w))
            w[at:at] = p[a:a + rng.randint(45, 200)]
        docs.append((i, " ".join(w)))
    docs += [(100, docs[10][1]), (101, docs[10][1]), (102, " ".join(passages[5] * 2))]
    got = {r["doc_id"]: r for r in suffix.repeated_passages(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("pos", F.lit(1))).collect()}
    want = brute_repeats(docs)
    assert set(got) == set(want)
    for i, hit in want.items():
        s = got[i]["spans"]
        assert set().union(*(range(a, b) for a, b in zip(s[::2], s[1::2], strict=True))) == hit
        assert got[i]["n_repeated"] == len(hit)


def test_repeats_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert suffix.repeated_passages(df).count() == 0
    assert suffix.repeated_passages(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))
    item = prose(30)
    copy = prose(80)
    rows = [(1, copy, "en", "s"), (2, copy, "en", "s"), (3, copy + " extra", "en", "s"),
            (4, "1234 !!", "en", "s"), (5, None, None, None), (6, prose(20) + " " + item, "en", "t"),
            (7, prose(40) + " mail ab.cd@mail.example.com now", "de", None), (8, prose(50), "de", "t")]
    docs = spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1])) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    left, now = [{1, 2, 3, 6, 7, 8}, {1, 6, 7, 8}, {1, 7, 8}, {1, 7, 8}], docs
    for (name, stage), ids in zip(cp.STAGES, left, strict=False):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
        assert {r["doc_id"] for r in now.collect()} == ids, name
    masked = {r["doc_id"]: r for r in now.collect()}
    assert "[EMAIL]" in masked[7]["text"] and masked[7]["n_chars"] == len(masked[7]["text"])
    assert masked[1]["text"] == copy
    out = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {1, 7, 8}
    assert sum(r["taken"] for r in out) == pytest.approx(
        min(1.5, 2) * sum(r["size"] for r in out), abs=2)


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as cp
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_queries_match_duckdb(spark):
    import duckdb

    from rehome.llm.oracle import ORACLE
    from rehome.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, sf)
        want = con.sql(sql)
        cols = sorted(got.columns)
        assert cols == sorted(want.columns), name

        def norm(rows):
            return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r])
                          for r in rows)
        assert norm(map(tuple, got.select(*cols).collect())) == norm(
            want.select(*cols).fetchall()), name
