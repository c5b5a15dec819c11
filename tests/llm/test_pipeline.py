"""The pipeline's rows against a brute-force version."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from brute import link_components, simhash, words
from odd import no_docs, odd_docs

from clickpanes.llm import language

SF_SMALL = "/root/testdata/sf0.001"


def brute(spark, docs):
    """Rows (doc_id, text, lang, source, n_chars) after each of the first four stages."""
    model = language.train(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"))
    nats = model.score([d[1] for d in docs]) + model.prior
    share = 1 / np.exp(nats.min(1, keepdims=True) - nats).sum(1)
    docs = [d for d, s in zip(docs, share) if any(c.isalpha() for c in d[1] or "") and s >= 0.5]
    groups = defaultdict(list)
    for d in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", d[1])].append(d)
    docs = sorted(min(g, key=lambda d: (-len(d[1]), d[0])) for g in groups.values())
    low = link_components([simhash(d[1]) for d in docs])
    docs = [d for k, d in enumerate(docs) if low[k] == k]
    size, total = {d[0]: len(words(d[1])) for d in docs}, Counter()
    for d in docs:
        total[d[3]] += size[d[0]]
    names = sorted(total)
    weight, full = {s: k % 3 + 1 for k, s in enumerate(names)}, set()
    while True:
        left, shares = sum(total.values()) - sum(3 * total[s] for s in full), sum(weight[s] for s in names if s not in full)
        target = {s: 3 * total[s] if s in full else left * weight[s] / shares for s in names}
        more = {s for s in names if target[s] > 3 * total[s]}
        if not more:
            break
        full |= more
    out, start = [], Counter()
    for d in sorted(docs, key=lambda d: (hashlib.md5(f"mix:{d[0]}:{hashlib.md5(d[1].encode()).hexdigest()}".encode()).hexdigest()[:15], d[0])):
        middle = start[d[3]] + size[d[0]] / 2
        start[d[3]] += size[d[0]]
        out += [d] * sum(middle + j * total[d[3]] < target[d[3]] for j in range(3) if size[d[0]])
    return out


def test_pipeline_equals_brute_force(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = Counter(brute(spark, docs))
    assert len(docs) > len(want) > len(docs) / 4
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows) == want
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows[:60]:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)


def test_stages_take_odd_tables(spark):
    for start in (odd_docs(spark), no_docs(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            if name != "BPE":
                assert out.columns == start.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert {"ids", "n_tokens"} <= set(docs.columns)
    assert docs.count() == 0
