"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest
from brute import base_spans, link_components, simhash as simhash_of, substring, vector_links, words
from odd import CLASHES, ODD_ROWS, PASSAGE, no_docs, odd_docs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpanes.llm import bpe, common, exact_dedup, language, mixing, preference, quality, secret_scan, simhash, substring as repeats, vectors


@pytest.fixture(scope="module")
def odd(spark):
    return odd_docs(spark)


@pytest.fixture(scope="module")
def none(spark):
    return no_docs(spark)


TEXTS = [r[1] for r in ODD_ROWS]


def test_exact_dedup(odd, none):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    keep = {(r.id, r.keep_id, r.group_size, r.text_sha256) for r in rows}
    same = hashlib.sha256(b"thesametext").hexdigest()
    assert {(4, 5, 5, same), (5, 5, 5, same), (6, 5, 5, same), (None, 5, 5, same)} <= keep
    empty = hashlib.sha256(b"").hexdigest()
    assert {(1, 3, 4, empty), (None, 3, 4, empty)} <= keep
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    kept = exact_dedup.drop_exact_copies(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert exact_dedup.exact_groups(none).count() == 0 == exact_dedup.drop_exact_copies(none).count()


def test_exact_dedup_many_runs(spark):
    rows = spark.range(0, 3000, 1, 300).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id % 700)) AS text")
    got = exact_dedup.exact_groups(rows).collect()
    text = lambda i: "hot" if i % 3 == 0 else f"t{i % 700}"
    low, size = {}, Counter(text(i) for i in range(3000))
    for i in range(3000):
        low.setdefault(text(i), i)
    assert sorted((r.id, r.keep_id, r.group_size, r.kept) for r in got) == [
        (i, low[text(i)], size[text(i)], low[text(i)] == i) for i in range(3000)
    ]


def test_quality(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 1), (9, 0), (None, 1), (5, None)], "doc_id long, quality int")
    rows = quality.resample(odd, labels).collect()
    assert len(rows) == len(ODD_ROWS) and sum(r.kept for r in rows) >= round(len(ODD_ROWS) * 2 / 3)
    nolabel = labels.limit(0)
    assert all(r.kept and r.log_weight == 0 for r in quality.resample(odd, nolabel).collect())
    assert quality.resample(none, labels).count() == 0
    assert sorted(map(str, quality.resample(odd, labels).collect())) == sorted(map(str, rows))


def test_top_k_bound(spark, monkeypatch):
    monkeypatch.setattr(quality, "EXACT_ROWS", 10)
    monkeypatch.setattr(quality, "BINS", 16)
    values = [float(x) for x in np.random.default_rng(1).exponential(size=3000) ** 3] + [5.0] * 500
    rows = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 7, 400, 1700, 3500, 9999):
        assert quality.top_k_bound(rows, "key", k) == sorted(values, reverse=True)[min(k, 3500) - 1]
    assert quality.top_k_bound(rows.limit(0), "key", 3) is None


def test_language(odd, none):
    model = language.train(odd)
    found = language.predict(odd.drop("language"), model).select("text", "language.*").collect()
    assert len(found) == len(ODD_ROWS)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    kept = language.identified(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for t in TEXTS)
    assert language.train(none) is None and language.identified(none).count() == 0
    assert language.predict(odd.drop("language"), None).where("language.lang_pred <> 'und'").count() == 0

def test_language_sample_has_every_language(spark):
    """Texts longer than a language's part, rows without an id, and many rows equal in id and text."""
    rows = [(f"{i}", f"en{i} " * 30, "en") for i in range(300)] + [(f"L{i}", f"lang {i} " * 900, f"long{i}") for i in range(20)]
    rows += [(None, f"none{i} " * 30, "no_id") for i in range(300)] + [(None, "same text " * 9, "same")] * 500
    rows += [("s", "short", "short")]
    table = spark.createDataFrame(rows, "id string, text string, lang string").repartition(4)
    sample, count = language.training_sample(table, 24 * 3000)
    assert count == Counter(r[2] for r in rows)
    size = {r.lang: r.bytes for r in sample.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    assert size == {k: 5 if k == "short" else 90 if k == "same" else 3000 for k in count}
    docs = table.withColumnRenamed("id", "doc_id").where(~language.held_out(F.col("id")))
    model = language.train(docs, train_bytes=24 * 3000)
    assert model.languages == sorted(r.lang for r in docs.select("lang").distinct().collect()) and len(model.languages) > 15


def test_language_code_is_exact():
    """After any context the probabilities of all bytes add up to one."""
    rng = np.random.default_rng(3)
    counts = {}
    for lang, text in (("a", bytes(rng.integers(97, 103, 4000).astype(np.uint8))), ("b", b"the cat sat on the mat " * 20)):
        data = np.frombuffer(language.PAD * 4 + text, np.uint8).astype(np.uint64)
        top = language._grams(data, 4)[4:]
        counts[lang] = [np.unique(top & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(5)]
    model = language.build_model(counts, {"a": 0.5, "b": 0.5})
    model.score(["x"])
    for context in (b"abca", b"the ", b"zzzz", b"cat ", b"\n\n\n\n"):
        keys = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert np.allclose(np.exp(-model._lookup(keys, 4).astype(float)).sum(0), 1, atol=1e-4)
    long = "abc the cat " * 60_000
    once = model.score([long])[0]
    assert np.allclose(once, model.score(["x", long, None, ""])[1])


def test_simhash(odd, none):
    rows = simhash.near_groups(odd).collect()
    fps = [simhash_of(t) for t in TEXTS]
    group = link_components(fps)
    low = {}
    for r, k in zip(ODD_ROWS, group):
        if r[0] is not None:
            low[k] = min(low.get(k, r[0]), r[0])
    want = sorted(((r[0], fp, low.get(k)) for r, fp, k in zip(ODD_ROWS, fps, group)), key=str)
    assert sorted(((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in rows), key=str) == want
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low.values()))
    assert simhash.near_groups(none).count() == 0 == simhash.drop_near_copies(none).count()


def test_simhash_keeps_one_row_of_a_component(spark):
    """Near copies that share an id, and components without any."""
    base = [" ".join(f"{c}{k}" for k in range(300)) for c in "abcd"]
    rows = [(1, base[0]), (1, base[0] + " end"), (1, base[0] + " other end"), (2, base[0])]
    rows += [(None, base[1]), (None, base[1] + " end"), (None, base[1]), (1, base[2]), (1, base[2]), (None, base[3]), (7, base[3])]
    group = link_components([simhash_of(t) for _, t in rows])
    at = {(i, t): g for (i, t), g in zip(rows, group)}
    kept = [(r.doc_id, r.text) for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(set(group)) < len(set(rows)) and sorted(at[r] for r in kept) == sorted(set(group))
    assert all(r[0] == min((i for (i, _), g in zip(rows, group) if g == at[r] and i is not None), default=None) for r in kept)



def _fps_case(kind):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    out = list(map(int, base))
    if kind == "chains":  # paths of near values, and pairs at four bits
        for b in map(int, base):
            for _ in range(30):
                for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                    b ^= 1 << int(bit)
                out.append(b)
    else:  # many values in few free bits: large groups
        for _ in range(3000):
            x = int(base[0])
            for bit in rng.choice(14, int(rng.integers(0, 6)), replace=False):
                x ^= 1 << int(bit) * 4 + 3
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("kind,small,large", [("chains", 32, 4096), ("chains", 3, 6), ("dense", 32, 4096), ("dense", 4, 40)])
def test_simhash_links(spark, kind, small, large, monkeypatch):
    fps = _fps_case(kind)
    group = link_components(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    run = _linked_with(small, large)
    monkeypatch.setattr(simhash, "_linked", run)
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    at = {s: k for k, s in enumerate(signed)}
    parent = list(range(len(fps)))
    for a, b in links:
        i, j = sorted((at[a], at[b]))
        while parent[i] != i:
            i = parent[i]
        while parent[j] != j:
            j = parent[j]
        parent[max(i, j)] = min(i, j)
    root = lambda k: k if parent[k] == k else root(parent[k])
    assert [root(k) for k in range(len(fps))] == group


def _linked_with(small, large):
    linked = simhash._linked

    def run(batches, defer):
        import clickpanes.llm.simhash as module

        module.SMALL, module.LARGE = small, large
        try:
            yield from linked(batches, defer)
        finally:
            module.SMALL, module.LARGE = 32, 4096

    return run


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, 103), (103, 101), (500, 500)] + [(1000, 1001 + i) for i in range(200)]
    got = {r.v: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 103: 100, **{i: 1000 for i in range(1000, 1201)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring(odd, none):
    rows = repeats.remove_repeats(odd).collect()
    want = Counter((r[0], *w) for r, w in zip(ODD_ROWS, substring(TEXTS)))
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == want
    assert [r.kept for r in rows if r.id == 9] == ["one end"]
    assert repeats.remove_repeats(none).count() == 0


@pytest.mark.parametrize("shard_bytes", [500, 20_000, 1_500_000])
def test_substring_overlaps(spark, shard_bytes):
    """Shared passages of 30 to 90 words, near copies, repeats inside a text."""
    rng = np.random.default_rng(11)
    some = lambda n: [f"w{k}" for k in rng.integers(0, 400, n)]
    passages = [some(int(n)) for n in rng.integers(30, 90, 8)]
    texts = []
    for _ in range(120):
        w = some(int(rng.integers(0, 120)))
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(len(passages)))]
            a = int(rng.integers(0, 12))
            w = w + p[a : len(p) - int(rng.integers(0, 12))] + some(int(rng.integers(0, 40)))
        texts.append(" ".join(w))
    texts += texts[:5] + ["a b " * 60, "a b " * 60 + "c", "x " * 34, "x " * 35, "x " * 36]
    near = texts[0].split() + some(100)
    for _ in range(20):
        w = list(near)
        w[int(rng.integers(len(w)))] = "edit"
        texts.append("\t".join(w))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.remove_repeats(rows, shard_bytes=shard_bytes).collect()}
    assert got == dict(enumerate(substring(texts)))


def test_secrets(odd, none):
    rows = odd.select("text", secret_scan.secret_spans(odd).alias("found")).collect()
    for r in rows:
        base = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r.found if s["kind"] != "named"]
        assert base == base_spans(r.text)
    assert none.select(secret_scan.secret_spans(none)).count() == 0


@pytest.mark.parametrize(
    "text,found",
    [
        ('db_password = "hunter2Abc99"', ["hunter2Abc99"]),
        ('api_key: "x7Gk29fLq0Zt"', ["x7Gk29fLq0Zt"]),
        ('{"clientSecret": "q9ZtR4mX77aa"}', ["q9ZtR4mX77aa"]),
        ("base = 'k93hAq27xPz1'\nauth_token = base", ["k93hAq27xPz1"]),
        ("a = 'k93hAq27xPz1'\nsecret = a + 'Zt61mmQ0xY'", ["k93hAq27xPz1", "Zt61mmQ0xY"]),
        ('part="k93hAq27xPz1"\nTOKEN="${part}"', ["k93hAq27xPz1"]),
        ("<password>k93hAq27xPz1</password>", ["k93hAq27xPz1"]),
        ("'private_key' => 'k93hAq27xPz1'", ["k93hAq27xPz1"]),
        ("export STORAGE_KEY=k93hAq27xPz1==", ["k93hAq27xPz1=="]),
        ('password = "changeme123"', []),
        ("the author said: nothing secret here", []),
        ('colour = "k93hAq27xPz1"', []),
        ("secret: the thing", []),
        ("monkey = 'banana and more'", []),
        ('PREFIX="ghp_"\nTOKEN="${PREFIX}k93hAq27xPz1"', ["${PREFIX}k93hAq27xPz1"]),
        ('part="k93hAq27xPz1"\nTOKEN="${part}Zt61mmQ0xY"', ["k93hAq27xPz1", "${part}Zt61mmQ0xY"]),
        ('host="a"\nTOKEN="${host}/x"', []),
        ('password: str = "hunter22x9"', ["hunter22x9"]),
        ('def f(api_key: Optional[Dict[str, str]] = "x7Gk29fLq0Zt", user="k93hAq27xPz1")', ["x7Gk29fLq0Zt"]),
        ("const apiKey:string='x7Gk29fLq0Zt';", ["x7Gk29fLq0Zt"]),
        ('let api_key: &\'static str = "x7Gk29fLq0Zt";', ["x7Gk29fLq0Zt"]),
        ('password: str | None = "hunter22x9"', ["hunter22x9"]),
        ("password: str, user='k93hAq27xPz1'", []),
        ("token: k93hAq27xPz1=\nb: c", ["k93hAq27xPz1="]),
        ("token: k93hAq27xPz1 = old", ["k93hAq27xPz1"]),
        ('secretkey = "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ('myprivatekey = "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ('accesskey: "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ("dbpwd='k93hAq27xPz1'", ["k93hAq27xPz1"]),
        ("turkey = 'k93hAq27xPz1'", []),
        *[(f"password = {p}'k93hAq27xPz1'", ["k93hAq27xPz1"]) for p in ("f", "b", "r", "u", "Rb", "@", "$@", "L")],
        ('db_password = """k93hAq27xPz1"""', ["k93hAq27xPz1"]),
        ("db_password = r'''k93hAq27xPz1''' + 'Zt61mmQ0xY'", ["k93hAq27xPz1", "Zt61mmQ0xY"]),
        ('db_password = """', []),
        ('password = (\n    "k93hAq27xPz1"\n    "Zt61mmQ0xY"\n)', ["k93hAq27xPz1", "Zt61mmQ0xY"]),
        ('password = \\\n    "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ('"password": ["k93hAq27xPz1", "Zt61mmQ0xY"]', ["k93hAq27xPz1", "Zt61mmQ0xY"]),
        ('pwd, n = "k93hAq27xPz1", 3', ["k93hAq27xPz1"]),
        ('n, pwd = "Zt61mmQ0xY", "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ('f(\n  user, password="k93hAq27xPz1", port=3)', ["k93hAq27xPz1"]),
        ('#define DB_PWD "k93hAq27xPz1"', ["k93hAq27xPz1"]),
        ('#  define COLOUR "k93hAq27xPz1"', []),
        ('c.setPassword("k93hAq27xPz1")', ["k93hAq27xPz1"]),
        ("set_password('k93hAq27xPz1')", ["k93hAq27xPz1"]),
        ('c.setName("k93hAq27xPz1")', []),
        ('password = os.getenv("DB_PASSWORD_1", "k93hAq27xPz1")', ["k93hAq27xPz1"]),
        ('token = cfg.get("service_token_2")', []),
        ("password = getpass.getpass('Password for db1: ')", []),
        ("auth_token = self.client_token2", []),
        ("token = request.headers", []),
        ("token = request.headers['X-Token-99a']", []),
        ("secret = load_key_v2(path)", []),
        ("secret = keys_v2[0]", []),
        ("password = os.getenv", []),
        ("token: eyJhbGci1iJIUzI1.eyJzdWIi5iIx", ["eyJhbGci1iJIUzI1.eyJzdWIi5iIx"]),
        ('<token a="b">x</token><password>k93hAq27xPz1</password>', ["k93hAq27xPz1"]),
    ],
)
def test_named_literals(text, found):
    assert sorted(text[a:b] for a, b, _, _ in secret_scan.named_literals(text)) == sorted(found)

def test_long_constants_are_carried_on():
    parts = [f"k93hAq27xP{k:03d}z" for k in range(200)]
    text = 'x = "st4leKq27xPz"\nx = ' + " + ".join(f'"{p}"' for p in parts) + "\ny = x\npassword = y + x\nauth = y"
    assert sorted(text[a:b] for a, b, _, _ in secret_scan.named_literals(text)) == parts
    text = "".join(f'x = x + "k93hAq27xP{k:05d}z"\ntoken = x\npassword = x\n' for k in range(20_000))
    assert len(secret_scan.named_literals(text)) == 20_000


def test_secret_scan_is_linear():
    for text in ("password" * 40_000, "a=" * 100_000 + "token", "token" + " " * 300_000, "x" * 400_000 + "=secret", '"' * 20_001 + "auth:", "k=a+" * 30_000 + "secret", "a:b[" * 50_000 + "secret", "a: b|" * 50_000 + "secret"):
        secret_scan.scan(text)


@pytest.mark.parametrize(
    "piece",
    ["<a>b</a>", "</", "</a", "a = (", "a = [", 'a = """', "a, b = ", "a = x + ", "#define a ", "set_a('", 'a = f(', "a: b = ", "a = get('", "x = \\\n"],
)
def test_named_literals_grow_with_the_text(piece):
    """Ten times the text takes about ten times as long."""

    def seconds(size):
        text = piece * (size // len(piece)) + " token"
        begin = time.perf_counter()
        secret_scan.named_literals(text)
        return time.perf_counter() - begin

    seconds(10_000)
    small, large = min(seconds(100_000) for _ in range(3)), seconds(1_000_000)
    assert large < 25 * small + 0.2


VECTORS = [
    (1, [1.0, 0.0, 0.0], 1, "z"),
    (2, [1.0, 0.1, 0.0], 1, "z"),
    (3, [0.0, 1.0, 0.0], 1, "z"),
    (4, [2.0, 0.0, -0.0], 1, "z"),
    (4, [2.0, 0.0, 0.0], 1, "z"),
    (5, [1.0, 0.0, 0.0], 2, "z"),
    (6, [1.0, 0.0, 0.0], None, "z"),
    (7, None, 1, "z"),
    (8, [0.0, 0.0, 0.0], 1, "z"),
    (9, [1.0, None, 0.0], 1, "z"),
    (10, [float("nan"), 1.0, 0.0], 1, "z"),
    (11, [float("inf"), 1.0, 0.0], 1, "z"),
    (12, [], 1, "z"),
    (13, [1.0, 0.0], 1, "z"),
    (14, [1.0, 0.01], 1, "z"),
    (None, [1.0, 0.05, 0.0], 1, "z"),
    (None, None, None, "z"),
]


def test_vectors(spark):
    table = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int, root string")
    got = Counter((r.id, r.n_links, r.component_id) for r in vectors.near_vectors(table).collect())
    rows = [(i, None if v is None or not v else v, label) for i, v, label, _ in VECTORS]
    assert got == Counter(vector_links(rows))
    assert vectors.near_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("cell,block", [(40, 2048), (40, 16), (4000, 50)])
def test_vectors_recall(spark, cell, block):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((60, 32))
    near = centre[rng.integers(0, 60, 600)] + rng.standard_normal((600, 32)) * 0.27 * rng.random((600, 1))
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(np.concatenate([near, rng.standard_normal((300, 32)), near[:40]]))]
    want = vector_links([(i, np.float32(v).tolist(), label) for i, v, label in rows])
    got = {r.id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), cell=cell, block=block).collect()}
    assert all(got[i].n_links <= n for i, n, _ in want)
    total = sum(n for _, n, _ in want)
    assert total > 1000 and sum(r.n_links for r in got.values()) >= 0.97 * total
    if cell == 4000:
        assert all(got[i].n_links == n and got[i].component_id == c for i, n, c in want)


def test_vectors_shape():
    """Deeper labels have more trees, and no label's computed recall is below ``TREE_RECALL``."""
    level = vectors.level_recall(vectors.COSINE)
    assert 0.952 < level < 0.953
    for n in (300, 5_000, 524_288, 8_400_000, 134_000_000):
        for together in (0.0, 0.5, 0.75, 0.99):
            trees, depth = vectors.shape(n, together, level)
            assert 1 - (1 - level**depth) ** trees >= vectors.TREE_RECALL
            assert (depth > 0) == (trees > 1) and (n > 5_000 or depth == 0)
    assert vectors.shape(134_000_000, 0.0, level)[1] >= 12


@pytest.mark.parametrize("spread,lump", [(1.0, 0), (0.5, 0), (0.5, 300)])
def test_vectors_recall_of_deep_trees(spark, spread, lump):
    """Pairs just above the threshold in one label, about a common centre or in one lump of it."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(48)) * np.sqrt(1 - spread**2)
    base = unit(centre + unit(rng.standard_normal((400, 48))) * spread)
    if lump:  # most of the label within a small ball, which holds its mean
        base[:lump] = unit(base[0] + unit(rng.standard_normal((len(base[:lump]), 48))) * 0.34)
    off = rng.standard_normal((400, 48))
    off = unit(off - (off * base).sum(1, keepdims=True) * base)
    cosine = rng.uniform(0.9302, 0.94, (400, 1))
    x = np.concatenate([base, base * cosine + off * np.sqrt(1 - cosine**2)])
    want = (x @ x.T >= vectors.COSINE).sum(1) - 1
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    level, together = vectors.level_recall(vectors.COSINE), float((x.mean(0) ** 2).sum())
    if not lump:
        assert vectors.shape(len(x), together, level, cell=1)[1] >= 10
    got = {r.id: r.n_links for r in vectors.near_vectors(table, cell=1).collect()}
    assert all(got[i] <= n for i, n in enumerate(want.tolist()))
    assert want.sum() >= 800 and sum(got.values()) >= 0.97 * want.sum()


def test_vectors_labels_stay_off_the_driver(spark, monkeypatch):
    """Rows that come to the driver do not grow with the labels."""
    kind, got = type(spark.range(0)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: got.append(collect(self)) or got[-1])
    rows = [(i, [float(i % 7 + 1), float(i % 5), 1.0], i % 100) for i in range(1000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vectors.near_vectors(table, cell=1)
    assert 0 < sum(map(len, got)) < 20

def test_bpe(spark, odd, none):
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.decode_documents(bpe.encode_documents(odd, tokenizer, ids_col="ids"), tokenizer)
    rows = coded.select("text", "ids", "decoded", bpe.ids_array(F.col("ids")).alias("list")).collect()
    for r in rows:
        assert r.decoded == (r.text or "")
        assert r["list"] == np.frombuffer(r.ids, "<u4").tolist()
    assert set(CLASHES) < set(coded.columns)
    once = bpe.round_trip_documents(odd, tokenizer).select("text", "ids", "decoded").collect()
    assert sorted(map(str, once)) == sorted(str(r) for r in coded.select("text", "ids", "decoded").collect())
    assert bpe.encode_documents(none, tokenizer).count() == 0


def test_bpe_merges_short_parts_without_a_queue(monkeypatch):
    """The common case costs no heap; both ways give the same ids, ties and repeats included."""
    import random

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        model = bpe.Bpe(f.read())
    draw = random.Random(8)
    parts = [bytes(draw.choices(b"aeinrst", k=n)) for n in range(1, bpe.SHORT + 1) for _ in range(20)]
    parts += [b"a" * n for n in range(1, bpe.SHORT + 1)] + [draw.randbytes(n) for n in range(1, bpe.SHORT + 1)]
    slow = [model._merge_long(p) for p in parts]
    monkeypatch.setattr(bpe, "heapq", None)
    assert [model.merge(p) for p in parts] == slow


def test_bpe_forgets_the_oldest_parts(monkeypatch):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        model = bpe.Bpe(f.read())
    texts = [f" part{k % 7} of{k % 5} some{k}" for k in range(60)] * 2
    whole = [model.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 4)
    model.words.clear()
    assert [model.encode(t) for t in texts] == whole
    assert len(model.words) <= 4 and len(model.older) <= 4


def test_bpe_equals_library():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = bpe.Bpe(open(path, "rb").read()), Tokenizer.from_file(path)
    random.seed(4)
    texts = ["".join(random.choice(" \n\t'sabcé漢½_1<|>😀́²٣don't") for _ in range(random.randint(0, 80))) for _ in range(2000)]
    for t in [*texts, "<|endoftext|>a<|endoftext|><|endoftext|>", "ab" * 4000 + " " * 99, "\x1c\x1f\x85\xa0 _x_"]:
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(t), "<u4").tolist() == want
        assert own.decode(own.encode(t)) == library.decode(want, skip_special_tokens=False)


def test_mixing(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    assert Counter((r.id, r.size) for r in rows) == Counter((r[0], len(words(r[1]))) for r in ODD_ROWS)
    for r in rows:
        assert len(r.positions) <= 3 and list(r.positions) == sorted(r.positions) and r.target <= 3 * r.source_size + 1e-6
        assert all(0 <= p <= 1 for p in r.positions)
    again = mixing.mix(odd.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(len(r.positions) for r in rows)
    assert mixing.mix(none).count() == 0 == mixing.mixed_documents(none).count()


def test_mixing_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", 4)
    monkeypatch.setattr(mixing, "BINS_PER_BLOCK", 8)
    rows = [(i, "w " * (1 + i % 7), ["a", "b", "c", None][0 if i < 700 else i % 4]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    by = {}
    for r in got:
        source = rows[r.id][2]
        by.setdefault(source, [r.target, 0])[1] += len(r.positions) * r.size
    total = sum(r.size for r in got)
    assert abs(sum(t for t, _ in by.values()) - total) < 1e-6 * total
    assert all(abs(t - taken) <= 4 for t, taken in by.values())


def test_water_level(spark):
    sizes = [(False, f"s{k:02d}", n) for k, n in enumerate([5, 1000, 0, 7, 30, 2000, 1, 64, 300])] + [(True, "", 11)]
    rows = mixing.source_targets(spark.createDataFrame(sizes, "no_source boolean, source string, size long")).collect()
    n = [s[2] for s in sizes]
    w = [k % 3 + 1 for k in range(len(n))]
    full, target = set(), []
    while True:
        left, share = sum(n) - sum(3 * n[k] for k in full), sum(w[k] for k in range(len(n)) if k not in full)
        target = [3 * n[k] if k in full else left * w[k] / share for k in range(len(n))]
        more = {k for k in range(len(n)) if k not in full and target[k] > 3 * n[k]}
        if not more:
            break
        full |= more
    assert np.allclose([r.target for r in sorted(rows, key=lambda r: (r.no_source, r.source))], target)


CONV = "conv_id long, turn long, role string, text string, pair string, cut string"


def test_preference(spark):
    say = lambda c, *turns: [(c, k, r, t, "z", "z") for k, (r, t) in enumerate(turns)]
    rows = [
        *say(1, ("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "bye")),
        *say(2, ("user", "only")),
        *say(3, ("system", None), ("assistant", "é漢")),
        *say(3, ("system", None)),
        (4, 0, None, None, None, None),
        (None, 0, "user", "x", None, None),
        (5, None, "user", "x", None, None),
        (6, 0, "user", "b", "z", "z"),
        (6, 0, "user", "a", "z", "z"),
        *[(7, k, "assistant", f"t{k}", "z", "z") for k in range(300)],
        *[(8, k, r, f"{t}{k}", "z", "z") for k in (1, 2) for r, t in (("user", "q"), ("assistant", "x"))],
        (9, 0, "user", "q", "z", "z"),
        (9, 1, "assistant", "b", "z", "z"),
        (9, 1, "assistant", "a", "z", "z"),
        *say(10, ("assistant", "ok"), ("user", "more"), ("assistant", "ok")),
    ]
    conv = spark.createDataFrame(rows, CONV)
    chosen = preference.turns(conv)
    segments = preference.preference_segments(chosen, preference.stale_reply_rejections(chosen))
    text = {r.pair: (r.prompt, r.chosen, r.rejected) for r in preference.assemble(segments).collect()}
    turn = lambda r, t: f"<|im_start|>{r}\n{t}<|im_end|>\n"
    start = turn("user", "q1") + turn("assistant", "a1") + turn("user", "q2")
    assert text[1] == (start, turn("assistant", "a2") + turn("user", "bye"), turn("assistant", "a1"))
    assert text[2] == (turn("user", "only"), "", "")
    assert text[3] == (turn("system", ""), turn("assistant", "é漢"), "")
    assert text[4] == (turn("unknown", ""), "", "")
    assert text[6] == (turn("user", "a") + turn("user", "b"), "", "")
    # A turn number counts an exchange: every message stays.
    assert text[8] == (turn("assistant", "x1") + turn("user", "q1"), turn("assistant", "x2") + turn("user", "q2"), turn("assistant", "x1"))
    # Two replies in one turn, and a last reply equal to the one before.
    assert text[9] == (turn("user", "q") + turn("assistant", "a"), turn("assistant", "b"), "")
    assert text[10] == (turn("assistant", "ok") + turn("user", "more") + turn("assistant", "ok"), "", "")
    assert text[7][1:] == (turn("assistant", "t299"), turn("assistant", "t298")) and 5 not in text and None not in text
    for r in segments.collect():
        if r.part != "prompt" and r.role == "assistant":
            assert r.segment[r.mask_start : r.mask_end].endswith("<|im_end|>\n") and r.segment[: r.mask_start] == "<|im_start|>assistant\n"
        else:
            assert r.mask_start is None and r.mask_end is None
    assert preference.preference_segments(chosen.limit(0), chosen.limit(0)).count() == 0
    one = preference.preference_segments(chosen, chosen.limit(0))
    assert one.where("part <> 'chosen'").count() == 0 and one.count() == chosen.count()


def _two_sides(spark, hot):
    rng = np.random.default_rng(hot)
    rows = [(int(rng.integers(0, 9)), int(rng.integers(0, 4)), str(rng.choice(["user", "assistant", "tool"])), str(rng.choice(list("abc")))) for _ in range(400)]
    return rows, spark.createDataFrame([(*r, "z", "z") for r in rows], CONV)


@pytest.mark.parametrize("hot", [3, 1 << 16])
def test_preference_by_brute_force(spark, monkeypatch, hot):
    """Two sides with ties in turn numbers, and pairs that are dealt over salts."""
    monkeypatch.setattr(preference, "HOT_ROWS", hot)
    (a, chosen), (b, rejected) = _two_sides(spark, 1), _two_sides(spark, 2)
    want = Counter()
    for pair in range(9):
        x, y = (sorted({r[1:] for r in side if r[0] == pair}) for side in (a, b))
        n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        want.update((pair, part, *r) for part, rows in (("prompt", x[:n]), ("chosen", x[n:]), ("rejected", y[n:])) for r in rows)
    found = preference.preference_segments(preference.turns(chosen), preference.turns(rejected)).collect()
    got = Counter((r.pair, r.part, r.turn, r.role, r.segment[len(f"<|im_start|>{r.role}\n") : -len("<|im_end|>\n")]) for r in found)
    assert got == want
    conv = preference.turns(chosen)
    one = preference.stale_reply_segments(conv)
    two = preference.preference_segments(conv, preference.stale_reply_rejections(conv))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


def test_mixing_many_equal_rows(spark, monkeypatch):
    """A third of all rows are equal, without an id: their bin is cut, and no part holds many."""
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", 16)
    monkeypatch.setattr(mixing, "CUT_BITS", 6)
    rows = [(None, "the same five words here", "s")] * 4000 + [(i, "w " * (1 + i % 7), ["s", "t"][i % 2]) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        taken[r.target] += len(r.positions) * r.size
    assert all(abs(t - n) <= 7 for t, n in taken.items())
    # Copies of one round of a source lie in the order of their offsets, so no two middles are equal.
    firsts = [r.positions[0] for r in got if r.positions and r.id is None]
    assert len(set(firsts)) == len(firsts) > 1000
    mixed = mixing.mixed_documents(docs.checkpoint())
    assert mixed.count() == sum(len(r.positions) for r in got)
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_substring_many_equal_rows(spark, monkeypatch):
    """Rows that repeat id and text: one text of them goes to a shard."""
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(None, text + " tail")] * 3000 + [("a", "start " + text), ("b", "other words"), ("c", None), (None, "x " * 80)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    found = repeats.remove_repeats(docs).collect()
    want = Counter((i, *w) for (i, _), w in zip(rows, substring([t for _, t in rows])))
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == want
    packed = docs.select(F.lit(0).cast("long").alias("rid"), F.xxhash64("text").alias("text_hash"), "text").where("text IS NOT NULL")
    packed = packed.mapInArrow(repeats._packed(69), "rid long, text_hash long, packed binary")
    assert packed.count() <= 4 * 3
