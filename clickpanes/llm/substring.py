"""Substring deduplication by repeated-phrase automata.

A window is ``window`` consecutive words of one document; a window recurs if its
word sequence starts anywhere else too. Every word a recurring window covers is removed.

1. Texts with one word sequence are one class; a class of several documents recurs as a
   whole, so one document per class goes on, with the class's size as its weight.
2. Anchors: of the 8-word grams inside each window the one with the smallest
   hash. Equal windows have equal anchors, and neighbours mostly share theirs, so
   this is about one gram in 14. Anchors are counted over all documents.
3. Documents with recurring anchors are dealt into shards by the smallest of these,
   which near copies mostly share; a cluster larger than a shard is split.
4. Confirm: a shard counts its windows that have a recurring anchor, by 128 bits (the
   window's hash and the anchor's). A window met twice in its shard, or in the
   sum over all shards, is a recurring passage.
5. Automata: each shard compiles its recurring passages (words spelled in symbols of its
   own) into Aho-Corasick automata of bounded size and streams all its
   documents through them, to locate every occurrence.

Counts are Spark aggregates with map-side sums, so a passage that a third of
all documents share is one row per shard. A shard is bounded by bytes of
text, whatever the table's size, and no text is paired with another. Texts
are compressed where they are shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, column
from .wordhash import gram_hashes, word_hashes

WINDOW = 35
GRAM = 8
SHARD_BYTES = 1_500_000
PATTERNS = 8_000  # windows in one automaton
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_PIECE = 1 << 17
_FIRST_SYMBOL = 0xE000  # beyond the surrogates


def _anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor gram's place for the window that starts at each word, and all gram hashes."""
    grams = gram_hashes(words, gram)
    inside = window - gram + 1
    places = [np.zeros(0, np.int64)]
    for at in range(0, len(words) - window + 1, _PIECE):
        part = np.lib.stride_tricks.sliding_window_view(grams[at : at + _PIECE + inside - 1], inside)
        part = part[: len(words) - window + 1 - at]
        places.append(part.argmin(1) + np.arange(at, at + len(part)))
    return np.concatenate(places), grams


def _profile(window: int, gram: int):
    """Task: rows (id, rid, text_hash, text) to one row per document: its words, a 128-bit key and
    SHA-256 of the joined words, and the hashes of its anchors (one per place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "n_bytes", "class_key", "sha", "anchors"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64())]
        for batch in batches:
            rows = [[] for _ in names]
            for text in batch.column(3):
                joined = b" ".join((text.as_py() or "").encode("utf-8", "replace").split())
                words = word_hashes(joined)
                digest = hashlib.sha256(joined)
                found = np.zeros(0, np.uint64)
                if len(words) >= window:
                    places, grams = _anchors(words, window, gram)
                    found = grams[np.unique(places)]
                values = (len(words), len(joined), digest.digest()[:16], digest.hexdigest(), found.view(np.int64))
                for row, value in zip(rows, values):
                    row.append(value)
            columns = [*batch.columns[:3], *(pa.array(r, k) for r, k in zip(rows, kinds))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "rid", "text_hash", *names])

    return run


def _windows(text: str, anchors: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, anchor hashes and window hashes of the windows whose anchor is in ``anchors``."""
    words = word_hashes(text.encode("utf-8", "replace"))
    places, grams = _anchors(words, window, gram)
    starts = np.flatnonzero(np.isin(grams, anchors)[places])
    return starts, grams[places[starts]], gram_hashes(words, window)[starts]


def _packed(least: int):
    """Task: rows (rid, text_hash, text) to rows with the text's compressed
    UTF-8; texts under ``least`` bytes have too few words and are left out, and rows that
    agree in id and text leave a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=3).compress, set()
        for batch in batches:
            raw = [t.as_py().encode("utf-8", "replace") for t in batch.column(2)]
            takes = []
            for r, key in zip(raw, zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                takes.append(len(r) >= least and key not in seen)
                seen.add(key)
            batch = batch.filter(pa.array(takes, pa.bool_()))
            packed = pa.array([pack(r) for r, take in zip(raw, takes) if take], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["rid", "text_hash", "packed"])

    return run


def _distinct(anchor: np.ndarray, hash_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (anchor, hash) pairs in order, and the place of each pair among them."""
    order = np.lexsort((hash_, anchor))
    a, h = anchor[order], hash_[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return a[new], h[new], at


@dataclass
class _Shard:
    """A shard's texts, the starts of their candidate windows, each one's place
    among the distinct windows (``at``, cut by text at ``ends``), and how often
    these are met, by weight."""

    texts: list[str]
    starts: list[np.ndarray]
    at: np.ndarray
    ends: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray
    n: np.ndarray


def _read_shard(docs: pa.Table, window: int, gram: int) -> _Shard:
    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(p.as_py()).decode("utf-8") for p in docs["packed"]]
    found = [
        _windows(text, anchors.values.to_numpy().view(np.uint64), window, gram)
        for text, anchors in zip(texts, docs["anchors"])
    ]
    starts, anchors, hashes = ([f[k] for f in found] for k in range(3))
    sizes = [len(s) for s in starts]
    anchor, hash_, at = _distinct(np.concatenate(anchors), np.concatenate(hashes))
    n = np.bincount(at, np.repeat(docs["weight"].to_numpy(), sizes), len(anchor)).astype(np.int64)
    return _Shard(texts, starts, at, np.cumsum(sizes), anchor, hash_, n)


def _count_shard(window: int, gram: int):
    """Task: a shard's documents to rows (anchor, hash, shard, n)."""

    def run(docs: pa.Table) -> pa.Table:
        shard = _read_shard(docs, window, gram)
        name = np.full(len(shard.n), docs["shard"][0].as_py())
        return pa.table({"anchor": shard.anchor.view(np.int64), "hash": shard.hash.view(np.int64), "shard": name, "n": shard.n})

    return run


def spell(texts: list[list[str]]) -> list[str]:
    """Every word as two symbols, of disjoint ranges so that a match starts at
    a word. Each range has about the square root of the number of distinct
    words: automata search a state's successors one by one."""
    number: dict[str, int] = {}
    coded = [[number.setdefault(w, len(number)) for w in words] for words in texts]
    base = max(1, math.isqrt(len(number)) + 1)
    symbols = [chr(_FIRST_SYMBOL + k // base) + chr(_FIRST_SYMBOL + base + k % base) for k in range(len(number))]
    return ["".join([symbols[k] for k in words]) for words in coded]


def locate(texts: list[str], phrases: list[str]) -> list[np.ndarray]:
    """For every spelled text, which of its words an occurrence of a phrase covers.
    All phrases have one length."""
    cover = [np.zeros(len(t) // 2 + 1, np.int32) for t in texts]
    window = len(phrases[0]) // 2 if phrases else 0
    for at in range(0, len(phrases), PATTERNS):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases[at : at + PATTERNS]:
            automaton.add_word(phrase)
        automaton.make_automaton()
        for text, marks in zip(texts, cover):
            ends = np.array([end for end, _ in automaton.iter(text)], np.int64) // 2
            marks += np.bincount(ends - window + 1, minlength=len(marks)).astype(np.int32)
            marks -= np.bincount(ends + 1, minlength=len(marks)).astype(np.int32)
    return [np.cumsum(marks[:-1]) > 0 for marks in cover]


def _clean_shard(window: int, gram: int):
    """Task, per shard: its documents and the passages that other shards have too,
    to one row per document of weight 1 that loses words: (rid, text_hash, n_removed, kept)."""

    def run(docs: pa.Table, elsewhere: pa.Table) -> pa.Table:
        names = ["rid", "text_hash", "n_removed", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if not docs.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        shard = _read_shard(docs, window, gram)
        recurs = shard.n > 1
        if elsewhere.num_rows:
            anchor, hash_ = (elsewhere[c].to_numpy().view(np.uint64) for c in ("anchor", "hash"))
            own = len(shard.n)
            _, _, at = _distinct(np.concatenate([shard.anchor, anchor]), np.concatenate([shard.hash, hash_]))
            recurs |= np.isin(at[:own], at[own:])
        split = [_WORD.findall(t) for t in shard.texts]
        coded = spell(split)
        # One place of each recurring window gives its phrase.
        wanted = recurs[shard.at]
        first = np.zeros(len(wanted), bool)
        first[np.unique(shard.at, return_index=True)[1]] = True
        phrases: list[str] = []
        for code, starts, chosen in zip(coded, shard.starts, np.split(wanted & first, shard.ends[:-1])):
            phrases += [code[2 * s : 2 * (s + window)] for s in starts[chosen].tolist()]
        alone = [k for k, w in enumerate(docs["weight"].to_pylist()) if w == 1]
        located = locate([coded[k] for k in alone], phrases)
        rows = []
        for k, gone in zip(alone, located):
            if gone.any():
                kept = " ".join([w for w, g in zip(split[k], gone.tolist()) if not g])
                rows.append((docs["rid"][k].as_py(), docs["text_hash"][k].as_py(), int(gone.sum()), kept))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, text_hash, n_words, n_removed, kept, kept_sha256``, one row per input row.

    ``kept`` (the kept words, joined by one space) is null where no word went;
    its text is then the input's. Ids are of any type, or null. Windows are judged on the input;
    two rows with one text (repeated rows too), and two places of one text, both count. Null texts have
    no words. Other columns are not read; an empty table gives an empty result.
    """
    id_ = column(docs, id_col)
    # Rows are joined by ``rid`` and ``text_hash``; rows that agree in both have one text.
    rows = docs.select(
        id_.alias("id"),
        F.coalesce(F.xxhash64(id_.cast("string")), F.lit(0)).alias("rid"),
        F.xxhash64(column(docs, text_col)).alias("text_hash"),
        column(docs, text_col).cast("string").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, rid long, text_hash long, n_words long, n_bytes long, class_key binary, sha string, anchors array<long>"
    profile = checkpointed(rows.mapInArrow(_profile(window, gram), schema))
    # One document of each class goes on: its smallest (rid, text_hash).
    classes = profile.where(F.col("n_words") >= window).groupBy("class_key").agg(
        F.min(F.struct("rid", "text_hash", "n_bytes", "anchors")).alias("first"), F.count("*").alias("weight")
    )
    classes = checkpointed(classes.select("class_key", "first.*", "weight", F.monotonically_increasing_id().alias("cid")))
    keyed = classes.select("cid", F.explode("anchors").alias("anchor"))
    # Written, so that the join below has plain shuffles on both sides, of which
    # adaptive execution can split the partition of a hot anchor.
    recurring = checkpointed(keyed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    # A document's own recurring anchors: bounded by its text.
    marks = keyed.join(recurring, "anchor").groupBy("cid").agg(F.collect_set("anchor").alias("marks"))
    marks = classes.drop("anchors").join(marks, "cid").withColumn("cluster", F.array_min("marks"))
    marks = checkpointed(marks.select("rid", "text_hash", "n_bytes", "weight", "cluster", F.col("marks").alias("anchors")))
    shards = int((marks.agg(F.sum("n_bytes")).first()[0] or 0) // shard_bytes) + 1
    clusters = marks.groupBy("cluster").agg(F.ceil(F.sum("n_bytes") / shard_bytes).cast("long").alias("parts"))
    clusters = checkpointed(clusters)  # for the same reason: a cluster may be hot
    part = F.pmod(F.xxhash64("rid", "text_hash"), F.col("parts"))
    marks = marks.join(clusters, "cluster").withColumn("shard", F.pmod(F.xxhash64("cluster", part), F.lit(shards)))
    marks = marks.select("rid", "text_hash", "shard", "weight", "anchors")
    packed = rows.where(F.octet_length("text") >= 2 * window - 1).select("rid", "text_hash", "text")
    packed = packed.mapInArrow(_packed(2 * window - 1), "rid long, text_hash long, packed binary")
    # A class's one document, once: its other rows may be any number.
    joined = checkpointed(packed.join(marks, ["rid", "text_hash"]).dropDuplicates(["rid", "text_hash"]))
    counts = joined.groupBy("shard").applyInArrow(_count_shard(window, gram), "anchor long, hash long, shard long, n long")
    recurs = counts.groupBy("anchor", "hash").agg(F.sum("n").alias("total")).where("total > 1")
    elsewhere = counts.where("n = 1").join(recurs, ["anchor", "hash"]).select("shard", "anchor", "hash")
    cleaned = joined.groupBy("shard").cogroup(elsewhere.groupBy("shard")).applyInArrow(
        _clean_shard(window, gram), "rid long, text_hash long, n_removed long, kept string"
    )
    cleaned = cleaned.withColumn("cleaned_sha", F.sha2("kept", 256))
    # Classes of several documents go as a whole.
    whole = classes.where("weight > 1").select("class_key", F.lit(True).alias("whole"))
    done = profile.drop("anchors").join(whole, "class_key", "left").join(cleaned, ["rid", "text_hash"], "left")
    return done.select(
        "id",
        "text_hash",
        "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("whole"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cleaned_sha", "sha")).alias("kept_sha256"),
    )
