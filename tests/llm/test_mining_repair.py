"""Toxicity, hard negatives and conversation repair against brute force, and on odd tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import no_docs, odd_docs
from pyspark.sql import functions as F

from clickpanes.llm import negatives, repair, toxicity
from clickpanes.llm.queries import QUERIES

SF_SMALL, SF_MID, SF_LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


# --- toxicity -----------------------------------------------------------------


def brute_segments(scores):
    """By definition: of all segments the one of largest sum (the shortest of equal ones), then the same to its left and right."""
    best = max(
        ((sum(scores[a:b]), -(b - a), -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    a, b = -best[2], best[3]
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [(a, b, best[0])] + right


def test_maximal_segments_by_definition():
    rng = random.Random(5)
    for n in [0, 1, *[rng.randrange(2, 22) for _ in range(250)]]:
        # Whole numbers plus distinct small parts: sums are exact enough, and no two are equal.
        scores = [rng.randrange(-4, 5) + rng.random() / 8 for _ in range(n)]
        got, want = toxicity.maximal_segments(scores), brute_segments(scores)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_segments_are_linear():
    scores = [1.0, -1.5, 0.75] * 200_000
    assert sum(b - a for a, b, _ in toxicity.maximal_segments(scores)) > 0


def test_rate_solves_its_equation():
    hist = np.zeros(toxicity.BINS)
    values = (np.arange(toxicity.BINS) - toxicity.BINS // 2) * toxicity.BIN
    hist[toxicity.BINS // 2 + np.array([-20, -4, 30])] = [50, 900, 50]
    rate = toxicity._fit_rate(hist)
    assert math.isclose((hist / hist.sum() * np.exp(rate * values)).sum(), 1, abs_tol=1e-6) and rate > 0


def test_calibrated_sums_of_clean_text():
    """Chance segments: of random clean texts about a share p has a p-value of at most p."""
    rng = np.random.default_rng(7)
    scores, share = np.array([-0.6, -0.1, 0.9]), [0.45, 0.4, 0.15]
    hist = np.zeros(toxicity.BINS)
    hist[np.rint(scores / toxicity.BIN).astype(int) + toxicity.BINS // 2] = share
    rate = toxicity._fit_rate(hist)
    texts = [rng.choice(scores, 200, p=share).tolist() for _ in range(1500)]
    segments = [toxicity.maximal_segments(t) for t in texts]
    log_k = np.mean([rate * max(s for *_, s in g) - math.log(200) for g in segments]) - np.euler_gamma
    p = np.exp([-toxicity.evidence(g, 200, rate, log_k)[0] for g in segments])
    for bound in (0.5, 0.1, 0.02):
        assert bound / 3 < (p <= bound).mean() < bound * 3


def test_token_scores_by_brute_force():
    docs = [("you idiot idiots", 1), ("an idiot here", 1), ("you here", 0), ("an island here", 0), ("you", 0)]
    toxic, clean = np.zeros(toxicity.BUCKETS, int), np.zeros(toxicity.BUCKETS, int)
    for text, y in docs:
        (toxic if y else clean)[sorted({k for w in toxicity.tokens(text) for k in toxicity.nodes(w)})] += 1
    scorer = toxicity.Scorer(toxic, clean)
    base = (toxic.sum() + 1) / (toxic.sum() + clean.sum() + 2)
    # idio: two toxic documents; idiot the word: two; idiots: its stems, then one.
    share = base
    for y, n in ((2, 2), (2, 2)):
        share = (y + 4 * share) / (n + 4)
    want = math.log(share / (1 - share)) - math.log(base / (1 - base)) - toxicity.DRIFT
    assert math.isclose(scorer.token("idiot"), want)
    assert scorer.token("idiot") > scorer.token("unseen") > scorer.token("island")
    assert math.isclose(scorer.token("unseen"), -toxicity.DRIFT)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").collect()}
    rows = QUERIES["op11_toxicity"](spark, SF_LARGE).collect()
    assert len(rows) == spark.read.parquet(f"{SF_LARGE}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    tested = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in tested if y == k] for k in (0, 1))
    auc = np.mean([(b > np.array(good)).mean() + (b == np.array(good)).mean() / 2 for b in bad])
    assert auc > 0.93 and np.mean(np.array(good) >= 0.5) < 0.03 and np.mean(np.array(bad) >= 0.5) > 0.5


def test_toxicity_passages_and_odd_tables(spark):
    odd, none = odd_docs(spark), no_docs(spark)
    labels = spark.createDataFrame([(4, 1), (7, 0), (9, 1), (9, 0), (11, None), (None, 1)], "doc_id long, toxic int")
    for docs, marks in ((odd, labels), (odd, labels.limit(0)), (none, labels)):
        model = toxicity.train(docs, marks)
        rows = docs.select("text", toxicity.toxicity(docs, model).alias("t")).collect()
        assert len(rows) == docs.count() and all(0 <= r.t.score <= 1 for r in rows)
        empty = {r.t.score for r in rows if not (r.text or "").strip()}
        assert len(empty) <= 1 and all(not r.t.passages for r in rows if not (r.text or "").strip())
    train = [(i, "one two three four five " * 6 + ("vile scum " * 2 if i % 3 == 0 else f"w{i % 9} "), int(i % 3 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in train], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    text = "one two four " * 30 + "Vile, SCUM! vile... scum! " + "five one " * 20
    score, found = model.judge(text)
    assert score > 0.5 and len(found) == 1 and text[found[0][0] : found[0][1]] == "Vile, SCUM! vile... scum"
    assert model.judge("one two four " * 50)[0] < 0.5


# --- hard negatives -----------------------------------------------------------


def brute_negatives(rows, is_anchor, positives=5, count=10):
    """rows: (id, vector, label) that take part -> the mined rows."""
    q = [[math.floor(256 * float(x)) for x in v] for _, v, _ in rows]
    key = lambda s, i: (-s, i is None, i or 0)
    out = []
    for a, (aid, _, label) in enumerate(rows):
        if not is_anchor(aid):
            continue
        score = {b: sum(x * y for x, y in zip(q[a], q[b])) for b in range(len(rows)) if b != a and len(q[a]) == len(q[b])}
        same = sorted((b for b in score if rows[b][2] == label), key=lambda b: key(score[b], rows[b][0]))
        other = sorted((b for b in score if rows[b][2] != label), key=lambda b: key(score[b], rows[b][0]))
        for p in same[:positives]:
            inside = [b for b in other if 30 * score[p] <= 100 * score[b] <= 90 * score[p]][:count]
            out += [(aid, rows[p][0], k + 1, rows[b][0], score[p], score[b]) for k, b in enumerate(inside)]
    return Counter(out)


def takes_part(v, label):
    return v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)


def test_hard_negatives_by_brute_force(spark):
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 else x) for i, v, x in table if takes_part(v, x)]
    got = Counter(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, SF_MID).collect())
    assert got == brute_negatives(rows, lambda i: i % 100 == 0) and len(got) > 100


def test_hard_negatives_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 7)
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 3)
    rng = random.Random(3)
    rows = []
    for i in range(160):
        v = [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]  # many ties, scores at and below zero
        rows.append((rng.choice([i, i, 20, None]), v, rng.choice([0, 0, 1, 2])))
    rows += [(40, [1.0, 0.5, 0.25], 0)] * 4 + [(60, [], 0), (61, [], 1), (80, [1.0, 2.0], 1), (81, [1.0, 1.0], 1), (82, [0.5, 0.5], 2)]
    rows += [(83, None, 1), (84, [1.0, None, 1.0], 1), (85, [float("nan"), 1.0, 1.0], 1), (86, [float("-inf"), 1.0, 1.0], 1), (87, [1.0, 1.0, 1.0], None)]
    rows += [(100, [2.0**40, 2.0**41, 1.0], 0), (101, [2.0**40, 2.0**40, 1.0], 0), (102, [2.0**40, 2.0**38, 0.0], 2)]
    schema = "vec_id long, embedding array<double>, label int, row string, q string, score string"
    df = spark.createDataFrame([(*r, "z", "z", "z") for r in rows], schema).repartition(5)
    parts = negatives.vector_rows(df)
    anchors = parts.where("id % 20 = 0")
    got = Counter(tuple(r) for r in negatives.hard_negatives(parts, anchors).collect())
    want = brute_negatives([r for r in rows if takes_part(r[1], r[2])], lambda i: i is not None and i % 20 == 0)
    hold = lambda s: max(-negatives.LONG, min(negatives.LONG, s))
    assert got == Counter({(*k[:4], hold(k[4]), hold(k[5])): n for k, n in want.items()}) or max(k[4] for k in want) > negatives.LONG
    small = lambda c: Counter({k: n for k, n in c.items() if k[0] != 100})
    assert {k for k in small(got) if k[4] < 1 << 40} == {k for k in small(want) if k[4] < 1 << 40}
    assert negatives.hard_negatives(parts.limit(0), anchors.limit(0)).count() == 0
    assert negatives.hard_negatives(parts, anchors.limit(0)).count() == 0


# --- conversation repair ------------------------------------------------------

LEGAL = re.compile(r"s|s?(ua)*u?")
DONE = re.compile(r"(s?(ua)+)?")


def brute_repair(symbols):
    """The least (cost, audit) of all edit sequences with up to three insertions at a place."""
    found = []

    def go(k, roles, cost, audit, inserted):
        if found and cost > found[0][0]:
            return
        if not LEGAL.fullmatch(roles):
            return
        if k == len(symbols) and DONE.fullmatch(roles):
            found.append((cost, audit))
            found.sort()
        if inserted < 3:
            for r in "ua":
                go(k, roles + r, cost + 2, audit + "I", inserted + 1)
        if k < len(symbols):
            s, cut = symbols[k].lower(), symbols[k].isupper()
            go(k + 1, roles, cost + 3, audit + "D", 0)
            if s != "-":
                if s in "sua":
                    go(k + 1, roles + s, cost + cut, audit + "K", 0)
                for r in "ua":
                    go(k + 1, roles + r, cost + 2 + cut, audit + "R", 0)

    go(0, "", 0, "", 0)
    return found[0]


def brute_conversation(rows):
    """rows (turn, role, text) in order -> counts, audit, repaired text."""
    seen, symbols, n = set(), "", Counter()
    for _, role, text in rows:
        said = text.strip(" \t\n\v\f\r")
        f = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        n[f] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "-" if f in ("blank", "duplicate") else initial.upper() if f else initial
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = brute_repair(symbols)
    out, at = [], 0
    for e in audit:
        nxt = "assistant" if out and out[-1][0][0] == "u" else "user"
        if e == "K":
            out.append(rows[at][1:])
        elif e != "D":
            out.append((nxt, rows[at][2] if e == "R" else ""))
        at += e != "I"
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def test_parse_is_cheapest_and_least():
    rng = random.Random(11)
    for symbols in ["", "s", "a", "u", *itertools.product("suaoU-", repeat=2)]:
        symbols = "".join(symbols)
        assert (repair.repair_rows(symbols) if symbols else (0, "")) == brute_repair(symbols)
    for _ in range(150):
        symbols = "".join(rng.choice("suuaaoSUAO-") for _ in range(rng.randrange(3, 7)))
        assert repair.repair_rows(symbols) == brute_repair(symbols), symbols


def test_parse_is_linear():
    cost, audit = repair.repair_rows("sua" + "uA-ouas" * 30_000)
    assert len(audit.replace("I", "")) == 3 + 7 * 30_000 and cost > 0


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_conversation_repair_query(spark):
    table = spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    rows = damage(table)
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SF_MID).collect()}
    assert len(got) == len({r.conv_id for r in table})
    for conv, found in got.items():
        assert found == brute_conversation(sorted(rows[conv], key=lambda r: r[0])), conv


@pytest.mark.parametrize("piece_rows", [1, 2, 3, 4096])
def test_repair_in_pieces(spark, piece_rows):
    """Conversations over several pieces and partitions, null ids, turns, roles and texts, repeated rows."""
    rng = random.Random(piece_rows)
    rows = []
    for conv in [None, 1, 2, 3, 4, 5]:
        for k in range(rng.randrange(1, 7)):
            turn, role = rng.choice([k, k + 9]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(["Yes.", "Yes.", "No", "", " \n", None, f"t{k}!"])))
            if rng.random() < 0.25:
                rows.append(rows[-1])
    rows.append((7, None, "user", "Hi."))
    # One text per turn number, so the order within a turn is known.
    first = {}
    rows = [first.setdefault((r[0], r[1]), r) for r in rows]
    table = spark.createDataFrame([(*r, "z", "z") for r in rows], "conv_id long, turn long, role string, text string, piece string, audit string").repartition(3)
    fixed = repair.repair(table, piece_rows=piece_rows)
    got = {r.conv: tuple(r)[1:] for r in repair.summaries(fixed).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: brute_conversation(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0))) for c, x in by.items()}
    assert got == want
    assert repair.summaries(repair.repair(table.limit(0), piece_rows=piece_rows)).count() == 0


def test_repair_takes_text_ids_and_one_hot_conversation(spark):
    rows = spark.range(0, 5000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('c', id div 9)) AS c", "id AS t", "IF(id % 2 = 0, 'user', 'assistant') AS r", "concat('text ', id, '.') AS x", "'z' AS conv"
    )
    fixed = repair.repair(rows, "c", "t", "r", "x", piece_rows=100)
    sizes = fixed.select("conv", F.size("repaired").alias("n")).collect()
    assert max(s.n for s in sizes) <= 200 and sum(s.conv == "hot" for s in sizes) >= 17
    got = {r.conv: r for r in repair.summaries(fixed).collect()}
    hot = [(i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(0, 5000, 3)]
    symbols = "".join(r[1][0] for r in hot)
    cost, audit = repair.repair_rows(symbols)
    assert (got["hot"].cost, got["hot"].audit) == (cost, audit)
    assert got["hot"].gaps == hot[-1][0] + 1 - len(hot) and got["hot"].duplicate == 0
