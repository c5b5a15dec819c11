"""Language identification by prediction by partial matching (PPM).

Every language has a variable-order byte context tree with escape
probabilities (method C): a byte seen ``c`` times after a context with ``n``
bytes, ``d`` of them distinct, has probability ``c / (n + d)`` there; what is left,
``d / (n + d)``, goes to the next shorter context, shared out among the bytes not
yet seen, down to a uniform order below zero. So the code lengths are those of
an exact code. Statistics are frozen after training. A text's language is the one whose
code for the text, plus the code of the language's own share, is shortest; the score is
that language's share of the probability.

Training counts come from a bounded, documented sample: of every language the texts
of smallest hash of id and text, until its equal part of ``train_bytes`` is reached; the
last one is cut there (all of them where there are fewer bytes). So no language
is left out, and no part is exceeded. The model is thereby bounded whatever the
table's size, and is broadcast. Counting runs on the executors. The costs of every
n-gram seen in any language are resolved for all languages beforehand, so that
scoring a byte is one vectorised table lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column

ORDER = 4
TRAIN_BYTES = 6_000_000
STEPS = 1 << 62  # values of the hash; BINS of them an octave
BINS = 8
UNDETERMINED = "und"
PAD = b"\n"  # stands before every text, so that each byte has a full context
_PIECE = 1 << 18


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """The last ``order + 1`` bytes at each place, packed; places before
    ``order`` see zeros."""
    key = data.copy()
    for back in range(1, order + 1):
        key[back:] |= data[:-back] << np.uint64(8 * back)
    return key


def _count_grams(order: int):
    """Task: rows (language, UTF-8 text) to rows (language, order, gram, count), added
    up within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(PAD * order + text)
            for lang, texts in by_lang.items():
                for k in range(order + 1):
                    found: dict[int, int] = {}
                    for text in _blocks(texts, order):
                        top = _grams(np.frombuffer(text, np.uint8).astype(np.uint64), order)[order:]
                        mask = np.uint64((1 << 8 * (k + 1)) - 1)
                        keys, counts = np.unique(top & mask, return_counts=True)
                        for a, b in zip(keys.view(np.int64).tolist(), counts.tolist()):
                            found[a] = found.get(a, 0) + b
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * n, pa.string()),
                            pa.array([k] * n, pa.int32()),
                            pa.array(list(found), pa.int64()),
                            pa.array(list(found.values()), pa.int64()),
                        ],
                        ["lang", "k", "gram", "n"],
                    )

    return run


def _blocks(texts: list[bytes], order: int) -> Iterator[bytes]:
    """Pieces of long texts, each with the ``order`` bytes before it."""
    for text in texts:
        for at in range(order, max(len(text), order + 1), _PIECE):
            yield text[at - order : at + _PIECE]


class Table:
    """Vectorised open-addressing lookup of distinct 64-bit keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys))).bit_length())
        self.row = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.row[slot] < 0
            self.row[slot[free]] = left[free]  # of several for one slot the last stays
            lost = self.row[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        out = self.row[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            row = self.row[slot]
            out[open_] = row
            again = (row >= 0) & (self.keys[row] != keys[open_])
            open_, slot = open_[again], slot[again]
        return out


@dataclass
class Model:
    """Code lengths in nats: of n-grams and of escapes from contexts, for every
    language. ``grams[k]`` has the grams of ``k + 1`` bytes seen in any."""

    languages: list[str]
    prior: np.ndarray
    order: int
    grams: list[np.ndarray]
    costs: list[np.ndarray]  # [k][gram, language]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]  # [k][context, language]

    def __post_init__(self):
        self._tables = None

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def _lookup(self, key: np.ndarray, k: int) -> np.ndarray:
        """Costs (place, language) of packed grams of order ``k``."""
        if k < 0:
            return np.zeros((len(key), len(self.languages)), np.float32)
        mask = np.uint64((1 << 8 * (k + 1)) - 1)
        key = key & mask
        row = self._tables[0][k].find(key)
        out = self.costs[k].take(np.maximum(row, 0), axis=0)
        lost = np.flatnonzero(row < 0)
        if len(lost):
            shorter = key[lost]
            out[lost] = self._lookup(shorter, k - 1)
            context = self._tables[1][k].find(shorter >> np.uint64(8))
            known = context >= 0
            out[lost[known]] += self.escapes[k][context[known]]
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Code lengths (text, language) in nats."""
        if self._tables is None:
            self._tables = [Table(g) for g in self.grams], [Table(c) for c in self.contexts]
        total = np.zeros((len(texts), len(self.languages)))
        pending, owner, size = [], [], 0

        def flush():
            data = np.frombuffer(b"".join(pending), np.uint8).astype(np.uint64)
            costs = self._lookup(_grams(data, self.order), self.order)
            ends = np.cumsum([len(p) for p in pending])
            for text, a, b in zip(owner, [0, *ends.tolist()], ends.tolist()):
                total[text] += costs[a + self.order : b].sum(0, dtype=np.float64)

        for t, text in enumerate(texts):
            for piece in _blocks([PAD * self.order + text.encode("utf-8", "replace")], self.order) if text else ():
                pending.append(piece)
                owner.append(t)
                size += len(piece)
                if size >= _PIECE:
                    flush()
                    pending, owner, size = [], [], 0
        if pending:
            flush()
        return total


def build_model(counts: dict[str, list[tuple[np.ndarray, np.ndarray]]], prior: dict[str, float], order: int = ORDER) -> Model:
    """A model of the sorted grams and counts of every language and order."""
    languages = sorted(counts)
    own = []  # per language: grams, cost, contexts, escape cost, by order
    for lang in languages:
        below, levels = None, []
        for k in range(order + 1):
            keys, n = counts[lang][k]
            n = n.astype(np.float64)
            contexts, at, distinct = np.unique(keys >> np.uint64(8), return_inverse=True, return_counts=True)
            total = np.bincount(at, n, len(contexts)) + distinct
            p = n / total[at]
            if below is None:
                lower = np.full(len(keys), 1 / 256)
            else:  # a gram's last bytes were seen with it
                lower = below[1][np.searchsorted(below[0], keys & np.uint64((1 << 8 * k) - 1))]
            left = 1 - np.bincount(at, lower, len(contexts))
            escape = (distinct / total) / np.maximum(left, 1e-9)
            if k == 0:
                escape = escape / 256
            levels.append((keys, -np.log(p), contexts, -np.log(escape)))
            below = keys, p
        own.append(levels)
    union = lambda k, part: np.unique(np.concatenate([levels[k][part] for levels in own]))
    grams = [union(k, 0) for k in range(order + 1)]
    contexts = [union(k, 2) for k in range(order + 1)]

    def spread(levels, k: int, keys: np.ndarray, value: int, sorted_by: int) -> tuple[np.ndarray, np.ndarray]:
        have = levels[k][sorted_by]
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        return hit, np.where(hit, levels[k][value][at], 0)

    def cost(levels, k: int, keys: np.ndarray) -> np.ndarray:
        if k < 0:
            return np.zeros(len(keys))
        hit, out = spread(levels, k, keys, 1, 0)
        lost = ~hit
        if lost.any():
            _, escape = spread(levels, k, keys[lost] >> np.uint64(8), 3, 2)
            out[lost] = escape + cost(levels, k - 1, keys[lost] & np.uint64((1 << 8 * k) - 1))
        return out

    return Model(
        languages,
        np.array([-np.log(prior[lang]) for lang in languages]),
        order,
        grams,
        [np.stack([cost(levels, k, grams[k]) for levels in own], 1).astype(np.float32) for k in range(order + 1)],
        contexts,
        [np.stack([spread(levels, k, contexts[k], 3, 2)[1] for levels in own], 1).astype(np.float32) for k in range(order + 1)],
    )


def held_out(id_: Column) -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 4 == 2


def training_sample(rows: DataFrame, train_bytes: int) -> tuple[DataFrame, dict[str, int]]:
    """``lang, text`` (UTF-8 bytes) to learn from ``rows`` (``lang, text, id``), and
    the number of rows by language.

    Bins of the hash, eight an octave, come to the driver with their bytes; bins
    that fit a language's part are taken whole. Of the one that does not, rows
    equal in id and text count once, and the texts of smallest hash fill the part.
    """
    turn = F.pmod(F.xxhash64(F.lit("ppm"), F.col("id"), F.col("text")), F.lit(STEPS))
    rows = rows.select("lang", "text", turn.alias("turn"))
    rows = rows.withColumn("bin", F.floor(F.log2(F.col("turn") + 1) * BINS).cast("int"))
    bins = rows.groupBy("lang", "bin").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).collect()
    count: dict[str, int] = {}
    for r in bins:
        count[r["lang"]] = count.get(r["lang"], 0) + r["n"]
    if not bins:
        return rows.select("lang", F.col("text").cast("binary").alias("text")), count
    part = train_bytes // len(count)
    edge, room = dict.fromkeys(count, STEPS.bit_length() * BINS), dict.fromkeys(count, part)
    for r in sorted(bins, key=lambda r: r["bin"]):
        lang = r["lang"]
        if edge[lang] > r["bin"]:
            if r["bytes"] > room[lang]:
                edge[lang] = r["bin"]
            else:
                room[lang] -= r["bytes"]
    by_lang = lambda values: F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("lang")]
    data = F.col("text").cast("binary").alias("text")
    whole = rows.where(F.col("bin") < by_lang(edge)).select("lang", data)
    last = rows.where(F.col("bin") == by_lang(edge)).groupBy("lang", "turn").agg(F.first("text").alias("text"))
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    left = (by_lang(room) - F.coalesce(before, F.lit(0))).cast("int")
    last = last.withColumn("left", left).where("left > 0")
    return whole.union(last.select("lang", F.substring(F.col("text").cast("binary"), F.lit(1), F.col("left")).alias("text"))), count


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_bytes: int = TRAIN_BYTES, order: int = ORDER) -> Model | None:
    """A model of ``docs`` outside the held-out part; None where no row has
    both a language and a text."""
    rows = docs.where(~held_out(column(docs, id_col))).select(
        column(docs, lang_col).cast("string").alias("lang"),
        column(docs, text_col).cast("string").alias("text"),
        column(docs, id_col).cast("string").alias("id"),
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    # The bins of each language came to the driver.
    sample, sizes = training_sample(rows, train_bytes)
    if not sizes:
        return None
    found = sample.mapInArrow(_count_grams(order), "lang string, k int, gram long, n long")
    got = found.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by train_bytes
    table: dict[str, list] = {}
    lang, k = np.array(got["lang"].to_pylist(), object), got["k"].to_numpy()
    gram, n = got["gram"].to_numpy().view(np.uint64), got["n"].to_numpy()
    for name in sorted({*lang.tolist()}):
        table[name] = []
        for level in range(order + 1):
            mine = (lang == name) & (k == level)
            by = np.argsort(gram[mine])
            table[name].append((gram[mine][by], n[mine][by]))
    if not table:
        return None
    count = {lang: sizes[lang] for lang in table}
    return build_model(table, {x: c / sum(count.values()) for x, c in count.items()}, order)


RESULT = "struct<lang_pred:string,score:double,bits_per_byte:double>"


def predictor(docs: DataFrame, model: Model | None):
    """A function from a text column to a ``RESULT`` column."""
    if model is None:
        return lambda text: F.lit(None).cast(RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in columns:
            texts = texts.to_pylist()
            nats = model.score(texts)
            whole = nats + model.prior
            odds = np.exp(whole.min(1, keepdims=True) - whole)
            best = whole.argmin(1)
            size = np.array([max(1, len((t or "").encode("utf-8", "replace"))) for t in texts])
            bits = nats[np.arange(len(texts)), best] / size / np.log(2)
            names = pa.array([model.languages[b] for b in best], pa.string())
            values = [names, pa.array(1 / odds.sum(1), pa.float64()), pa.array(bits, pa.float64())]
            yield pa.StructArray.from_arrays(values, ["lang_pred", "score", "bits_per_byte"])

    return F.arrow_udf(run, RESULT)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", to: str = "language") -> DataFrame:
    """``docs`` with a struct column ``to``: ``lang_pred``, ``score`` (0 to 1) and
    ``bits_per_byte`` of the best language's code.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned. Only the text is read; rows and other columns stay as they are.
    """
    text = column(docs, text_col).cast("string")
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    # Null instead of a text without letters, so that no task reads those twice.
    guess = predictor(docs, model)(F.when(has_letter, text))
    return docs.withColumn(to, F.when(has_letter & guess.isNotNull(), guess).otherwise(none))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or scores under
    ``min_score``, all columns kept."""
    model = train(docs, id_col, text_col, lang_col, **options)
    to = "language"
    while to.lower() in {c.lower() for c in docs.columns}:
        to += "_"
    found = predict(docs, model, text_col, to)
    keep = (F.col(f"{to}.lang_pred") != UNDETERMINED) & (F.col(f"{to}.score") >= min_score)
    return found.where(keep).select(*[column(found, c) for c in docs.columns])
