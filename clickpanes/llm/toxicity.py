"""Toxicity by maximum-scoring segments.

A token's score is its log-odds of standing in a toxic rather than a clean
document, less a small drift. The share of toxic documents among those that
hold a token has a Dirichlet prior (over the two classes) centred on the share of
the token's longest learned prefix, whose own prior is centred on the next shorter prefix's, up to
the share of all tokens; so a rare form is judged by its stem, and an unseen
token scores about zero. One linear scan finds every maximal scoring segment of a
text (no segment of a larger sum within or across it).

Scores of chance segments follow an extreme-value law: among clean text of ``m`` tokens,
``K m exp(-lambda S)`` segments reach the sum ``S``. ``lambda`` solves
``E exp(lambda score) = 1`` over the clean tokens, ``K`` comes from the mean of the
largest sums of clean documents. Segments below ``SIGNIFICANT`` expected
chance segments are passages; a document's passages give one p-value (sum
statistics), and a logistic curve turns its logarithm into the score.

Learned from at most about ``train_rows`` labelled documents (a hash sample where
there are more; their ids are broadcast). Counts are kept in ``BUCKETS``
hash buckets, by two folds: ``lambda``, ``K`` and the curve are fitted on
documents scored by the other fold's counts. Texts are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, column

BUCKETS = 1 << 20
TRAIN_ROWS = 30_000
PREFIXES = (4, 5, 6, 7)
STRENGTH = 4.0
DRIFT = 0.2
SIGNIFICANT = 0.05
BIN, BINS = 0.05, 1024  # of token scores; of evidence a bin is 0.25
FORMS_KEPT = 1 << 18  # token and stem scores a task remembers
NODES_KEPT = 1 << 16
_TOKEN = re.compile(r"[^\W_]+")


def held_out(id_: Column) -> Column:
    """Whether labels of this document are not learned from (null id: as empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def tokens(text: str | None) -> list[str]:
    """The lower-case runs of letters and digits of a text."""
    return _TOKEN.findall((text or "").lower())


def node(form: str) -> int:
    return xxhash.xxh64_intdigest(form.encode("utf-8", "replace")) % BUCKETS


@lru_cache(NODES_KEPT)
def nodes(token: str) -> tuple[int, ...]:
    """Buckets of a token's prefixes, shortest first, and of the token itself."""
    return tuple([node(f"{k}{token[:k]}") for k in PREFIXES if len(token) > k] + [node(f"w{token}")])


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """``(start, end, sum)`` of every maximal scoring segment, in order, in linear time.

    A candidate ``(start, end, sum before, sum at its end)`` is merged with earlier
    ones while the nearest that begins lower ends lower too. Candidates that begin
    lower are linked, so that those passed over are not met again."""
    found: list[tuple[int, int, float, float]] = []
    lower: list[int] = []  # the nearest candidate to the left that begins lower
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, low = at, before
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = lower[j]
            if j < 0 or found[j][3] >= total:
                break
            start, low = found[j][0], found[j][2]
            del found[j:], lower[j + 1 :]
            j = lower.pop()
        found.append((start, at + 1, low, total))
        lower.append(j)
    return [(a, b, high - low) for a, b, low, high in found]


class Scorer:
    """Token scores from counts ``toxic`` and ``clean`` by bucket (documents that hold a node)."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray):
        self.toxic, self.clean, self.known, self.stems = toxic, clean, {}, {}
        share = (toxic.sum() + 1.0) / (toxic.sum() + clean.sum() + 2.0)
        self.base = float(share)

    def _share(self, form: str, prior: float) -> float:
        k = node(form)
        y, n = self.toxic.item(k), self.clean.item(k)
        return (y + STRENGTH * prior) / (y + n + STRENGTH)

    def token(self, token: str) -> float:
        share, stems = self.base, self.stems
        for k in PREFIXES:
            if len(token) <= k:
                break
            stem = token[:k]
            found = stems.get(stem)
            if found is None:
                found = stems[stem] = self._share(f"{k}{stem}", share)
            share = found
        share = self._share(f"w{token}", share)
        return math.log(share / (1 - share)) - math.log(self.base / (1 - self.base)) - DRIFT

    def scores(self, words: list[str]) -> list[float]:
        known, out = self.known, []
        for w in words:
            s = known.get(w)
            if s is None:
                # Also within a text, which may be of any length.
                if len(known) >= FORMS_KEPT:
                    known.clear()
                if len(self.stems) >= FORMS_KEPT:
                    self.stems.clear()
                s = known[w] = self.token(w)
            out.append(s)
        return out


class Model:
    """Counts and the calibration. ``rate`` is lambda, ``log_k`` the logarithm of K;
    ``curve`` holds intercept and slope over the evidence."""

    def __init__(self, toxic, clean, rate: float = 1.0, log_k: float = 0.0, curve=(-2.0, 1.0)):
        self.toxic, self.clean, self.rate, self.log_k, self.curve = toxic, clean, rate, log_k, curve
        self._scorer = None

    def __getstate__(self):
        return self.__dict__ | {"_scorer": None}

    def scorer(self) -> Scorer:
        self._scorer = self._scorer or Scorer(self.toxic, self.clean)
        return self._scorer

    def passages(self, words: list[str]) -> tuple[float, list[tuple[int, int, float, float]]]:
        """Evidence (minus the logarithm of the document's p-value), and its passages
        ``(start, end, sum, expected)`` by token."""
        return evidence(maximal_segments(self.scorer().scores(words)), len(words), self.rate, self.log_k)

    def score(self, found: float) -> float:
        z = self.curve[0] + self.curve[1] * found
        return 1 / (1 + math.exp(-min(max(z, -40.0), 40.0)))

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """The score of a text, and its passages in code points."""
        words = tokens(text)
        found, passages = self.passages(words)
        if passages:
            low = (text or "").lower()
            # Lower case can be longer than the text; then spans are of the lower-case text.
            at = [m.span() for m in _TOKEN.finditer(low)]
            passages = [(at[a][0], at[b - 1][1], s, e) for a, b, s, e in passages]
        return self.score(found), passages


def evidence(segments: list[tuple[int, int, float]], m: int, rate: float, log_k: float):
    """Minus the logarithm of the p-value of a text of ``m`` tokens, and the segments
    with fewer than ``SIGNIFICANT`` chance segments expected.

    Of ``r`` such segments the normalised sums add up to ``s``, and by the law of
    sums p is ``exp(-s) s^(r-1) / (r! (r-1)!)``; else p is that of the largest segment."""
    if not segments:
        return 0.0, []
    log_e = lambda s: log_k + math.log(m) - rate * s
    good = [(a, b, s, math.exp(max(log_e(s), -700))) for a, b, s in segments if log_e(s) < math.log(SIGNIFICANT)]
    if not good:
        best = math.exp(min(log_e(max(s for *_, s in segments)), 30.0))
        return -math.log(-math.expm1(-best)) if best > 1e-12 else -math.log(best), []
    total, r = sum(-log_e(s) for _, _, s, _ in good), len(good)
    return total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r), good


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows (text, toxic, fold) to one row per bucket met, with the number of documents by fold and class."""
    sums = np.zeros((4, BUCKETS), np.int32)
    for batch in batches:
        for text, toxic, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            met = {k for w in set(tokens(text.as_py())) for k in nodes(w)}
            sums[2 * fold + toxic, list(met)] += 1
    met = np.flatnonzero(sums.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(met), *[pa.array(sums[k, met].astype(np.int64)) for k in range(4)]], ["bucket", "c0", "t0", "c1", "t1"])


def _fit_rate(counts: np.ndarray) -> float:
    """lambda: the positive solution of ``E exp(lambda score) = 1`` over a histogram of clean token scores."""
    values, share = (np.arange(BINS) - BINS // 2) * BIN, counts / max(counts.sum(), 1)
    if not counts.any() or not counts[BINS // 2 + 1 :].any() or (values * share).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    mean = lambda x: float((share * np.exp(np.minimum(x * values, 600))).sum())
    while mean(high) < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def _fit_curve(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below zero) of a logistic curve over evidence bins, with a weak pull of the slope to one."""
    n = toxic + clean

    def loss(a: float, b: float) -> float:
        z = a + b * x
        return float((n * np.logaddexp(0, z) - toxic * z).sum()) + 0.005 * a * a + 0.5 * (b - 1) ** 2

    a, b = math.log((toxic.sum() + 1) / (clean.sum() + 1)), 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        v, rest = n * p * (1 - p), toxic - n * p
        g = np.array([rest.sum() - 0.01 * a, (rest * x).sum() - (b - 1)])
        step = np.linalg.solve([[v.sum() + 0.01, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1]], g)
        while loss(a + step[0], b + step[1]) > loss(a, b) and np.abs(step).max() > 1e-9:
            step = step / 2
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() <= 1e-9:
            break
    return float(a), max(float(b), 0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on documents that ``labels`` marks and ``held_out`` does not exclude.

    Labels that are null, or without an id, count for nothing; of several labels of an id the
    largest counts. Without a document of either class every score is that of
    the share of toxic documents (one half without labels)."""
    marks = labels.select(column(labels, id_col).alias("id"), column(labels, label_col).alias("y"))
    marks = marks.where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
    marks = checkpointed(marks.groupBy("id").agg((F.max("y") > 0).cast("int").alias("toxic")))
    n = marks.count()
    if n > train_rows:
        turn = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 30))
        marks = marks.where(turn < int((1 << 30) * train_rows / n))
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    # About train_rows ids at most (a hash sample of that size).
    rows = rows.join(F.broadcast(marks), "id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(2)).cast("int")
    rows = checkpointed(rows.select("text", "toxic", fold.alias("fold")))
    counted = rows.mapInArrow(_count, "bucket long, c0 long, t0 long, c1 long, t1 long")
    found = counted.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")]).toArrow()
    sums = np.zeros((4, BUCKETS), np.int32)
    for k, name in enumerate(("c0", "t0", "c1", "t1")):
        sums[k, found["bucket"].to_numpy()] = found[name].to_numpy()
    model = Model(sums[1] + sums[3], sums[0] + sums[2])
    # Each fold is scored by the counts of the other.
    other = rows.sparkSession.sparkContext.broadcast([Model(sums[3], sums[2]), Model(sums[1], sums[0])])

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (toxic, m, sums of its segments) per document, and one with the histogram of clean token scores."""
        hist = np.zeros(BINS, np.int64)
        for batch in batches:
            marks, sizes, sums = batch.column(1), [], []
            for text, toxic, fold in zip(batch.column(0), marks.to_pylist(), batch.column(2).to_pylist()):
                s = other.value[fold].scorer().scores(tokens(text.as_py()))
                if not toxic:
                    at = np.clip(np.rint(np.array(s) / BIN) + BINS // 2, 0, BINS - 1).astype(int)
                    hist += np.bincount(at, minlength=BINS)
                sizes.append(len(s))
                sums.append([x for *_, x in maximal_segments(s)])
            none = pa.nulls(len(sizes), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([marks, pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.float64())), none], names)
        last = [pa.array([None], pa.int32()), pa.array([0], pa.int64()), pa.array([[]], pa.list_(pa.float64())), pa.array([hist.tolist()])]
        yield pa.RecordBatch.from_arrays(last, names)

    names = ["toxic", "m", "sums", "bins"]
    scored = checkpointed(rows.mapInArrow(score_rows, "toxic int, m long, sums array<double>, bins array<long>"))
    hist = np.zeros(BINS, np.int64)
    per_bin = scored.where("toxic IS NULL").select(F.posexplode("bins").alias("bin", "n"))
    for k, n in per_bin.groupBy("bin").agg(F.sum("n")).collect():  # BINS rows
        hist[k] = n
    model.rate = rate = _fit_rate(hist)
    # The mean of the largest normalised sum of a clean document is log K and Euler's constant.
    gumbel = F.array_max("sums") * rate - F.log("m")
    mean = scored.where("toxic = 0 AND size(sums) > 0").agg(F.avg(gumbel)).first()[0]
    model.log_k = log_k = 0.0 if mean is None else mean - float(np.euler_gamma)

    def evidence_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [min(int(evidence([(0, 0, x) for x in s], m, rate, log_k)[0] * 4), BINS - 1) for m, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), batch.column(0)], ["bin", "toxic"])

    pairs = np.zeros((2, BINS))
    met = scored.where("toxic IS NOT NULL").select("toxic", "m", "sums").mapInArrow(evidence_bins, "bin long, toxic int")
    for k, y, n in met.groupBy("bin", "toxic").count().collect():  # 2 x BINS rows at most
        pairs[y, k] = n
    x = np.minimum((np.arange(BINS) + 0.5) / 4, 30.0)
    model.curve = _fit_curve(x, pairs[1], pairs[0]) if pairs.sum(1).all() else (math.log((pairs[1].sum() + 1) / (pairs[0].sum() + 1)), 0.0)
    other.unpersist()
    return model


RESULT = "struct<score:double,passages:array<struct<start:int,end:int,sum:double,expected:double>>>"


def toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A column, ``RESULT``: the score of each whole text, and its toxic passages
    (code points, end exclusive; the number of chance segments expected).

    Null and empty texts, and those without a letter or digit, have the score of no
    evidence and no passage. A row's result depends on its text alone, so ties and
    repeated rows get the same; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sum", pa.float64()), ("expected", pa.float64())])))])

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            out = []
            for t in texts:
                score, passages = shared.value.judge(t.as_py())
                out.append({"score": score, "passages": [dict(zip(("start", "end", "sum", "expected"), p)) for p in passages]})
            yield pa.array(out, kind)

    return F.arrow_udf(run, RESULT)(column(docs, text_col).cast("string"))
