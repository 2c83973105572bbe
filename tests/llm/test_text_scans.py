"""Brute-force comparisons and edge cases of the text scans (6, 7, 8, 9, 10)."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rehome.llm import decontam, langid, licenses, pii, secrets

EXTRA = "doc_id bigint, text string, row string, hits string, n_words string, __text string"


def frame(spark, texts):
    """Texts with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "r", "h", "n", "x") for i, t in enumerate(texts)], EXTRA)


def naive(text, pattern, ok, flags=0):
    return [(m.start(), m.end()) for m in re.finditer(pattern, text, flags) if ok(m)]


def luhn(d):
    s = [int(c) for c in d][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(s)) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}
SECRETS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8, re.I | re.A),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16, 0),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32, 0),
}


def base_of(text, kinds):
    spans = []
    for k, (name, rule) in enumerate(kinds.items()):
        spans += [(s, k, f"{name}:{s}:{e}") for s, e in naive(text, *rule)]
    return ",".join(x for _, _, x in sorted(spans))


def noise(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_pii_base_equals_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(400):
        t = noise(rng, "a1.@+- ()5b@.é4", rng.randint(0, 60))
        _, base, spans = pii.find_spans(t.encode())
        assert pii.joined(base) == base_of(t, PII), t
        assert set(base) <= set(spans)


@pytest.mark.parametrize("seed", range(3))
def test_secret_base_equals_plain_patterns(seed):
    rng = random.Random(seed)
    parts = ["password", "Token", "api_key", "APIKEY", "ſecret", "toKen", "secret", "=", ":", " ", '"',
             "'", "abcd", "1234abcd", "AKIA", "ABCDEFGH12", "0123456789abcdef", "é", "\n", "-"]
    for _ in range(600):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        got = secrets.base_spans(t.encode(), t)
        assert secrets.joined(got) == base_of(t, SECRETS), t


def test_secret_lexer_propagates_constants():
    t = 'x1 = "kR9-tq!2ZvLm"\nlog_level: debug\nopts = {"db_pwd": x1}\nclient.private_key := "aB3$aB3$zz"\n'
    spans = secrets.scan(t.encode())[4].split(",")
    found = [t[int(s):int(e)] for s, e in (x.split(":")[1:] for x in spans)]
    assert found == ["kR9-tq!2ZvLm", "aB3$aB3$zz"]
    assert all(x.startswith("lexed:") for x in spans)
    assert secrets.scan(b'password = "${DB_PASSWORD}"')[4].startswith("lexed") is False


def lexed(text):
    spans = [x.split(":") for x in secrets.scan(text.encode())[4].split(",") if x]
    return [text[int(s):int(e)] for k, s, e in spans if k == "lexed"]


@pytest.mark.parametrize("text, want", [
    ('db_password: str = "Hunter2abcXYZ9"', "Hunter2abcXYZ9"),
    ('def f(user: str, pwd:str="Hunter2abcXYZ9"):', "Hunter2abcXYZ9"),
    ('db_pwd: Optional[Annotated[str, Doc["x"]]] | None = "Hunter2abcXYZ9"', "Hunter2abcXYZ9"),
    ('pwd: Final = x1\nx1: str = "Hunter2abcXYZ9"', "Hunter2abcXYZ9"),
    ('const apiSecret: string = "Zx81-kkq-92LmP"', "Zx81-kkq-92LmP"),
    ("readonly clientSecret?: string | undefined = 'Zx81-kkq-92LmP';", "Zx81-kkq-92LmP"),
    ('const signingKey: SecretString = "Zx81-kkq-92LmP"', "Zx81-kkq-92LmP"),
    ('val token: String = "Zx81kkq92LmP"', "Zx81kkq92LmP"),
    ('var token: String? = "Zx81kkq92LmP"', "Zx81kkq92LmP"),
    ("static AUTH_KEY: &'static str = \"Zx81kkq92LmP\";", "Zx81kkq92LmP"),
    ("db_pwd : string := 'Zx81kkq92LmP';", "Zx81kkq92LmP"),
    ("const dbPwd = `Zx81-kkq-92LmP`;", "Zx81-kkq-92LmP"),
    ("const dbPwd: string = `Zx81-kkq-92LmP`;", "Zx81-kkq-92LmP"),
    ('db_pwd =\n    "Zx81-kkq-92LmP"', "Zx81-kkq-92LmP"),
    ('db_pwd: str = (\r\n    "Zx81-kkq-92LmP")', "Zx81-kkq-92LmP"),
    ('db_pwd = \\\n    "Zx81-kkq-92LmP"', "Zx81-kkq-92LmP"),
    ('{"db_pwd":\n  "Zx81-kkq-92LmP"}', "Zx81-kkq-92LmP"),
    ('else: db_pwd = "Zx81-kkq-92LmP"', "Zx81-kkq-92LmP"),
    ('password = "correct horse battery staple"', "correct horse battery staple"),
    ("gpg_passphrase: 'correct horse battery staple'", "correct horse battery staple"),
    ("const passPhrase2 = `correct horse battery staple`", "correct horse battery staple"),
    ('w = "correct horse battery staple"\npassword = w', "correct horse battery staple"),
])
def test_secret_lexer_reads_each_syntax(text, want):
    assert lexed(text) == [want]
    assert lexed("a = 1\n" + text + "\n" + text) == [want, want]


@pytest.mark.parametrize("text, want", [
    ('pwds:\n  "db_pwd": "Zx81-kkq-92LmP"', ["Zx81-kkq-92LmP"]),  # a key is not a literal
    ("signing_key: Zx81kkq92LmPQa=\n'x': 1", ["Zx81kkq92LmPQa="]),  # padding is not an operator
    ("signing_key: Zx81kkq92LmPQa = b", ["Zx81kkq92LmPQa"]),
    ('x: f(db_pwd: "Zx81-kkq-92LmP") = 1', ["Zx81-kkq-92LmP"]),  # a call is not a type
    ('if db_pwd == "Zx81-kkq-92LmP": pass', []),
    ("DB_PWD=`cat /run/secrets/db | head`", []),
    ("dbPwd = `${user} and others`", []),
    ('password_hint = "the name of your cat"', []),
    ('secret_santa = "Ann and Bob"', []),
])
def test_secret_lexer_keeps_to_literals(text, want):
    assert lexed(text) == want


def test_secret_types_are_scanned_in_linear_time():
    for part in ("a:b<", "a:b[a:b[", "a:b[x]", "a: b|", "a=`", "a=\n'", "a:'b ", "a:b<c>|"):
        raw = (part * (400_000 // len(part))).encode()
        start = time.process_time()
        secrets.scan(raw)
        assert time.process_time() - start < 20, part


def test_secrets_edge_rows(spark):
    texts = [None, "", "token = '" + "a1" * 40_000 + "'", "token=abcdefgh", "token=abcdefgh"]
    rows = {r["doc_id"]: r for r in
            secrets.find_secrets(frame(spark, texts), keep=("doc_id",)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[0]["base_sha256"] == rows[1]["base_sha256"] == empty and rows[0]["spans"] == ""
    assert rows[2]["n_assign"] == 1 and rows[2]["n_hex"] == 1
    assert rows[3]["spans"] == rows[4]["spans"] == "assign:0:14"
    none = secrets.find_secrets(frame(spark, texts).limit(0), keep=("doc_id",))
    assert none.count() == 0


def test_scans_are_linear_on_long_runs():
    raw = ("a" * 300_000 + " " + "1" * 300_000 + "@" * 1000 + "=" * 1000 + '"' * 999).encode()
    assert pii.find_spans(raw)[1] == []
    assert secrets.scan(raw)[:2] == (0, 0)


def test_pii_bare_mailboxes_are_found_in_one_scan():
    rng = random.Random(1)
    for _ in range(300):
        t = " ".join(rng.choice(["ab.cde", "AB.CDE", "x-ab.cde", "ab.cde@x", "abcde", "no"])
                     + rng.choice(["", ".", ",", "@m.de", "é"]) for _ in range(12))
        base = pii.base_spans(t.encode(), t)
        got = {n[:2] for n in pii._nodes(t, t.encode(), base) if not n[4]}
        want = set()
        for box in {t[s:e].split("@")[0].lower() for s, _, e in base}:
            if len(box) >= 6:
                want |= {m.span() for m in re.finditer(
                    rf"(?<![A-Za-z0-9._%+@-]){re.escape(box)}(?![A-Za-z0-9._%+@-])", t, re.I | re.A)}
        assert got == want, t


def test_pii_is_linear_in_the_addresses():
    t = "".join(f"user{i:05d}@mail.example.com of user{i:05d}\n" for i in range(6_000))
    raw = t.encode()
    base = pii.base_spans(raw, t)
    start = time.process_time()
    assert len(pii._nodes(t, raw, base)) == 12_000
    assert time.process_time() - start < 3


def test_pii_skip_links_label_repeated_mentions():
    t = ("Call +1 (988) 555-2485 now. Later she wrote that 988 555 2485 is best, and "
         "the box hsr.29@mail5.example.com is hsr.29 for short; 12 345 678 is a count.")
    text, base, spans = pii.find_spans(t.encode())
    extra = {(pii.KINDS[k], text[s:e]) for s, k, e in spans if (s, k, e) not in base}
    assert extra == {("ctx_phone", "988 555 2485"), ("ctx_email", "hsr.29")}
    assert pii.masked(text, spans).count("[PHONE]") == 2
    assert "2485" not in pii.masked(text, spans)


@pytest.mark.parametrize("where", ["after", "before", "both"])
@pytest.mark.parametrize("n", [1, 2, 5, 50])
def test_pii_every_repeat_of_a_base_mention_is_labelled(n, where):
    weak, base = "then 988 555 2485 and 12 345 678 or ", "at +1 (988) 555-2485 or "
    t = {"after": base + weak * n, "before": weak * n + base,
         "both": weak * n + base + weak * n}[where]
    text, found, spans = pii.find_spans(t.encode())
    extra = [(pii.KINDS[k], text[s:e]) for s, k, e in spans if (s, k, e) not in found]
    assert extra == [("ctx_phone", "988 555 2485")] * (2 * n if where == "both" else n)
    assert "2485" not in pii.masked(text, spans)
    t = t.replace("+1 (988) 555-2485", "hsr.29@mail5.example.com").replace("988 555 2485", "hsr.29")
    text, found, spans = pii.find_spans(t.encode())
    assert "hsr" not in pii.masked(text, spans) and "12 345 678" in pii.masked(text, spans)


def test_belief_propagation_is_exact_on_a_chain():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    unary = rng.normal(size=(4, 5))
    edges, weight = np.array([(0, 1), (1, 2), (2, 3)]), np.array([0.5, 2.0, 1.0])
    want = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        p = np.exp(sum(unary[i, x] for i, x in enumerate(labels))
                   + sum(w for (a, b), w in zip(edges, weight, strict=True)
                         if labels[a] == labels[b]))
        for i, x in enumerate(labels):
            want[i, x] += p
    want /= want.sum(axis=1, keepdims=True)
    assert np.abs(pii.marginals(unary, edges, weight, 60) - want).max() < 1e-5


def test_pii_edge_rows(spark):
    texts = [None, "", "x@y.zz", "x@y.zz", "1.2.3.4 " * 20_000]
    rows = {r["doc_id"]: r for r in pii.find_pii(frame(spark, texts), keep=("doc_id",)).collect()}
    assert rows[0]["spans"] == rows[1]["spans"] == ""
    assert rows[2]["spans"] == rows[3]["spans"] == "email:0:6"
    assert rows[4]["n_ip"] == 20_000
    masked = {r["doc_id"]: r["masked"] for r in
              pii.mask_pii(frame(spark, texts), keep=("doc_id",)).collect()}
    assert masked[0] is None and masked[1] == "" and masked[2] == "[EMAIL]"


def brute_contamination(docs, items):
    pats = {}
    for i, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        for x in ([tuple(w)] if 0 < len(w) <= 10 else
                  [tuple(w[j:j + 10]) for j in range(len(w) - 9)]):
            pats.setdefault(x, set()).add(i)
    out = {}
    for d, t in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        hit, ids = set(), set()
        for p, names in pats.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit |= set(range(j, j + len(p)))
                    ids |= {str(x) for x in names if x is not None}
        out[d] = (len(w), len(hit), sorted(ids))
    return out


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination_equals_brute_force(spark, block):
    rng = random.Random(5)
    word = ["a", "B", "c", "Éa", "x1"]
    items = [(i, " ".join(rng.choice(word) for _ in range(n)))
             for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 30, 3])]
    items += [(None, "a b c d"), (77, None), (78, " .. "), (3, items[3][1])]
    docs = [(0, None), (1, "")]
    for d in range(2, 60):
        t = [rng.choice(word + ["zz", "q"]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            t += (items[rng.randrange(10)][1]).split()
        docs.append((d, "; ".join(t)))
    got = decontam.contamination(
        frame(spark, [t for _, t in docs]), spark.createDataFrame(items, "item_id long, text string"),
        keep=("doc_id",), block_bytes=block)
    got = {r["doc_id"]: (r[1], r["n_hit"], r["items"]) for r in got.collect()}
    assert got == brute_contamination(docs, items)


def test_decontamination_without_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontam.contamination(frame(spark, ["a b", None]), none, row=True)
    assert [(r["n_hit"], r["items"]) for r in out.collect()] == [(0, []), (0, [])]
    assert out.select("row.*").columns == frame(spark, []).columns


def test_licenses_edge_rows(spark):
    line = "Released under the MIT License."
    texts = [None, "", line, line, "mit license mit license", "x " * 30_000 + "apache license",
             "licensed under cc-by-nc 4.0", "mit\x00license", "MİT LICENSE mit liKense",
             "the under by to is in a of no be or and"]
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert rows[0]["labels"] == "" and rows[0]["score"] == 0.0 and rows[0]["first_word"] is None
    assert (rows[2]["n_base"], rows[2]["first_word"], rows[2]["labels"]) == (1, 3, "mit")
    assert rows[2].asDict() | {"doc_id": 3} == rows[3].asDict()
    assert (rows[4]["n_base"], rows[4]["first_word"], rows[4]["last_word"]) == (2, 0, 2)
    assert (rows[5]["first_word"], rows[5]["n_words"]) == (30_000, 30_002)
    assert rows[6]["labels"] == "cc-by-nc" and rows[6]["base_labels"] == ""
    assert rows[7]["n_base"] == 1 and rows[8]["n_base"] == 0 and rows[9]["labels"] == ""
    assert licenses.scan_licenses(frame(spark, texts).limit(0)).count() == 0


def test_language_identification_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = langid.train(docs, where=~fold)
    out = langid.predict(docs.where(fold), model, keep=("doc_id", "lang"))
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"),
                F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r["acc"] > 0.97 and 0 <= r["lo"] <= r["hi"] <= 1


def test_language_kernel_of_a_very_long_text_is_exact():
    rng = random.Random(3)
    marks = ["".join(chr(rng.randrange(lo, lo + 3000)) for _ in range(400)) for lo in (0x4E00, 0x6000)]
    long = "".join(chr(rng.randrange(0x4E00, 0x4E00 + 3000)) for _ in range(300_000))

    def grams(t):
        t = " " + t + " "
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    held = langid.Landmarks([langid.presence(t) for t in marks])
    k, ok = held.kernel([long, marks[1], "?"])
    for i, t in enumerate([long, marks[1]]):
        for j, m in enumerate(marks):
            a, b = grams(t), grams(m)
            assert k[i, j] == pytest.approx(len(a & b) / (len(a) * len(b)) ** 0.5, abs=1e-6)
    assert k[0, 0] > 3 * k[0, 1] and ok.tolist() == [True, True, False]


def test_language_with_many_labels_and_repeated_ids(spark):
    rng = random.Random(4)
    words = [[noise(rng, "abcdefghijklmnopqrstuvwxyz", 6) for _ in range(5)] for _ in range(230)]
    rows = [(None, " ".join(rng.choice(w) for _ in range(12)), f"l{j}")
            for j, w in enumerate(words) for _ in range(60 if j < 3 else 3)]
    rows += [(None, "ääbb ccöö düüd", "copies")] * 3000 + [(None, "1 2", "copies")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model["labels"]) == 231
    out = langid.predict(docs, model, keep=("text", "lang"))
    r = out.where("text != '1 2'").groupBy("lang").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("ok")).collect()
    assert sum(x["ok"] for x in r) / len(r) > 0.9
    assert {x["ok"] for x in r if x["lang"] in ("l0", "l1", "l2", "copies")} == {1.0}


def test_language_fit_equals_a_dense_solve(spark):
    """Where the sample takes every row: kernels from sets of n-grams, weighted
    kernel ridge regression by least squares, softmax of the margins."""
    rng = random.Random(8)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop"}
    rows = [(" ".join(noise(rng, letters[x], rng.randint(2, 5)) for _ in range(6)), x)
            for x, n in (("aa", 9), ("bb", 14), ("cc", 5)) for _ in range(n)]
    fresh = [" ".join(noise(rng, "abcdefghijklmnop", 4) for _ in range(6)) for _ in range(20)]
    model = langid.train(spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string"))
    got = {r["text"]: r for r in langid.predict(spark.createDataFrame(
        [(t,) for t in fresh], "text string"), model, keep=("text",)).collect()}

    def grams(t):
        t = f" {t} "
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    def kernel(some, others):
        return np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in map(grams, others)]
                         for a in map(grams, some)])
    texts, labels = [t for t, _ in rows] * 2, np.array([x for _, x in rows] * 2)
    names = sorted(letters)
    marks = [t for t, _ in rows]
    weight = np.array([len(labels) / (len(names) * (labels == x).sum()) for x in labels]) ** 0.5
    value, vector = np.linalg.eigh(kernel(marks, marks))
    root = (vector * np.sqrt(np.maximum(value, 0))).T
    left = np.vstack([weight[:, None] * kernel(texts, marks),
                      (langid.RIDGE * len(texts)) ** 0.5 * root, 1e-3 * np.eye(len(marks))])
    right = np.vstack([weight[:, None] * np.where(labels[:, None] == names, 1.0, -1.0),
                       np.zeros((2 * len(marks), len(names)))])
    alpha = np.linalg.lstsq(left, right, rcond=None)[0]
    p = np.exp(langid.TEMPERATURE * (kernel(fresh, marks) @ alpha))
    p /= p.sum(axis=1, keepdims=True)
    assert len({names[i] for i in p.argmax(axis=1)}) == 3
    for t, row in zip(fresh, p, strict=True):
        assert got[t]["score"] == pytest.approx(row.max(), abs=2e-3)
        if np.diff(np.sort(row)[-2:])[0] > 4e-3:
            assert got[t]["lang_pred"] == names[row.argmax()]


def test_scans_of_an_empty_table(spark):
    none = frame(spark, ["x"]).limit(0).withColumn("lang", F.lit("en"))
    items = spark.createDataFrame([("b1", "one two three")], "item_id string, text string")
    model, field = langid.train(none), pii.fit_field(none)
    assert model is None and field is pii.PRIOR
    for out in (langid.predict(none, model, keep=("doc_id",)), secrets.find_secrets(none, keep=("doc_id",)),
                pii.find_pii(none, keep=("doc_id",), field=field), pii.mask_pii(none, row=True, field=field),
                decontam.contamination(none, items, keep=("doc_id",))):
        assert out.collect() == []


def test_language_edge_rows(spark):
    texts = [None, "", "123 !!", "the and of the with that", "le la de les que", "the " * 20_000]
    docs = frame(spark, texts).withColumn(
        "lang", F.when(F.col("doc_id") == 4, "fr").when(F.col("doc_id") == 3, "en"))
    model = langid.train(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in
           langid.predict(docs, model, keep=("doc_id",)).collect()}
    assert got == {0: "und", 1: "und", 2: "und", 3: "en", 4: "fr", 5: "en"}
    assert langid.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None, keep=("doc_id",)).collect()} == {"und"}
