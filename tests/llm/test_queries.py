"""Registered queries against DuckDB, or against brute force, on small tables."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from brute import Ppm, base_spans, gumbel_keys, link_components, simhash, substring, vector_links
from compare import compare, duck

from clickpanes.llm.oracle import ORACLE_SQL
from clickpanes.llm.queries import QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    found = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert found["match"], found


def test_language_held_out_accuracy(spark, documents):
    lang = {d: x for d, _, x in documents}
    rows = QUERIES["op3_language"](spark, SF_SMALL).collect()
    assert len(rows) == len(documents)
    tested = [r for r in rows if r.held_out and r.lang_pred != "und" and lang[r.doc_id]]
    assert len(tested) > 20
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) / len(tested) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_simhash(spark, documents):
    fps = [simhash(t) for _, t, _ in documents]
    low = link_components(fps)
    rows = QUERIES["op4_simhash"](spark, SF_SMALL).collect()
    assert {tuple(r) for r in rows} == {(d, f"{fp:016x}", documents[k][0]) for (d, _, _), fp, k in zip(documents, fps, low)}


def test_substring(spark, documents):
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_substring"](spark, SF_SMALL).collect()}
    want = substring([t for _, t, _ in documents])
    assert sum(w[1] > 0 for w in want) > 5
    assert rows == {d: w for (d, _, _), w in zip(documents, want)}


def test_secrets(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op6_secrets"](spark, SF_SMALL).collect()}
    assert len(rows) == len(documents)
    for d, text, _ in documents:
        want, r = base_spans(text), rows[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}


def test_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = vector_links(rows)
    got = sorted(tuple(r) for r in QUERIES["op7_vectors"](spark, SF_SMALL).collect())
    assert got == sorted((i, n, c, i == c) for i, n, c in want)


def test_bpe(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r.doc_id: r for r in QUERIES["op8_bpe"](spark, SF_SMALL).collect()}
    for d, text, _ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert rows[d].n_tokens == len(ids)
        assert rows[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_quality_separates_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, SF_SMALL).collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert sum(good) / len(good) > 0.85 > 0.5 > sum(bad) / len(bad)


def test_language_by_brute_force(spark, documents):
    """Every prediction equals that of a coder over dictionaries; scores agree to the precision of the tables."""
    learned = [(d, t, x) for d, t, x in documents if x is not None and t and zlib.crc32(str(d).encode()) % 4 != 2]
    names = sorted({x for *_, x in learned})
    assert sum(len(t.encode()) for _, t, _ in learned) < 6_000_000 / len(names)  # the sample is all of them
    coders = {x: Ppm([t for _, t, y in learned if y == x]) for x in names}
    prior = {x: -math.log(sum(y == x for *_, y in learned) / len(learned)) for x in names}
    rows = {r.doc_id: r for r in QUERIES["op3_language"](spark, SF_SMALL).collect()}
    for d, text, _ in documents:
        if not any(c.isalpha() for c in text or ""):
            assert (rows[d].lang_pred, rows[d].score) == ("und", 0.0)
        elif len(text) < 6000:
            nats = [coders[x].nats(text) + prior[x] for x in names]
            assert rows[d].lang_pred == names[nats.index(min(nats))], d
            want = 1 / sum(math.exp(min(nats) - v) for v in nats)
            assert abs(rows[d].score - want) < 1e-3, d


def test_quality_by_brute_force(spark, documents):
    """Weights, keys and choice, also of rows that share an id or have none."""
    from clickpanes.llm import quality

    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.doc_id is not None and r.quality == 1}
    share = [v for v in dict(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg({"quality": "max"}).collect()).values()]
    docs = [(d, t) for d, t, _ in documents] + [(None, "one of no id"), (None, "another of none"), (documents[0][0], "its id again")]
    number = lambda gram: int(quality.buckets_of(" ".join(gram), quality.BUCKETS)[-1])
    want = gumbel_keys(docs, good, quality.BUCKETS, number)
    rows = quality.resample(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()
    k = round(len(docs) * sum(v > 0 for v in share) / len(share))
    bound = sorted((key for _, key in want), reverse=True)[k - 1]
    by = lambda v: sorted(v, key=lambda r: (str(r[0]), r[2]))
    got = by((r.id, r.log_weight, r.key, r.kept) for r in rows)
    want = by((i, w, key, key >= bound) for (i, _), (w, key) in zip(docs, want))
    assert [(r[0], r[3]) for r in got] == [(r[0], r[3]) for r in want]
    assert np.allclose([r[1:3] for r in got], [r[1:3] for r in want], rtol=1e-9, atol=1e-6)
    assert len({r.key - r.log_weight for r in rows if r.id is None}) == 2
