"""Byte-level BPE encoding and decoding.

A short pre-token is merged in lists of its symbols and of their pairs' ranks, the least
rank first. A long one is merged with a priority queue of merge ranks over a doubly linked
list of symbols; an entry whose pair has changed since it was pushed is stale
and skipped. Decoding concatenates the vocabulary's byte strings.

The vocabulary file (the ``tokenizer.json`` format) is read once by the driver
and broadcast; its size is that of the file. Each Python worker keeps the merged
pre-tokens it has met in two generations of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, fresh

#: The pre-token pattern of byte-level BPE (fixed value), and the same for texts
#: whose characters Python's faster ``re`` classes alike. ``_OTHER`` finds the others:
#: beyond Latin letters, and digits that are not decimal.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GENERAL = regex.compile(PATTERN)
_OTHER = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def _kind(pattern: str) -> str:
    """A set of the characters of a kind that ``_OTHER`` leaves: ``re`` looks one up faster than a class such as ``\\w``."""
    return f"[{re.escape(''.join(c for c in map(chr, range(0x250)) if re.match(pattern, c) and not _OTHER.match(c)))}]"


# Words first, as the most frequent: no other part begins as they do.
_LATIN = re.compile(rf" ?{_kind(r'[^\W\d_]')}+|'s|'t|'re|'ve|'m|'ll|'d| ?{_kind(r'[^\s\w]|_')}+| ?[0-9]+|\s+(?!\S)|\s+")
_BITS = 21  # of an id
#: Pre-tokens up to so many bytes are merged by lists.
SHORT = 64
#: The rank of a pair that does not merge.
_NONE = 1 << 62
CACHE_WORDS = 150_000


def byte_characters() -> dict[int, str]:
    """The character byte-level vocabularies write for each byte: itself where
    printable and not a blank, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Words(dict):
    """Packed ids of pre-tokens; ``find`` gives those of one that is not there."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


class Bpe:
    """One vocabulary: ``encode`` to packed little-endian 32-bit ids, ``decode`` back."""

    def __init__(self, spec: bytes):
        data = json.loads(spec)
        model, pre = data["model"], data.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        odd = [k for k in ("unk_token", "dropout", "end_of_word_suffix", "ignore_merges", "continuing_subword_prefix") if model.get(k)]
        added = data.get("added_tokens") or []
        if model["type"] != "BPE" or not plain or data.get("normalizer") or odd:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens that strip or match single words are not supported")
        vocab: dict[str, int] = model["vocab"]
        chars = byte_characters()
        back = {ord(c): b for b, c in chars.items()}
        self.strings: dict[int, bytes] = {i: bytes(back[ord(c)] for c in s) for s, i in vocab.items()}
        self.strings |= {t["id"]: t["content"].encode() for t in added}
        self.byte_ids = [vocab[chars[b]] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {vocab[a] << _BITS | vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.words, self.older = _Words(self._word), {}

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        return self._merge_short(raw) if len(raw) <= SHORT else self._merge_long(raw)

    def _merge_short(self, raw: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in raw]
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << _BITS | b, _NONE) for a, b in zip(ids, ids[1:])]  # of each symbol and the next
        while ranks and (rank := min(ranks)) != _NONE:
            k = ranks.index(rank)
            new = ids[k] = merged[rank]
            del ids[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = get(new << _BITS | ids[k + 1], _NONE)
            if k:
                ranks[k - 1] = get(ids[k - 1] << _BITS | new, _NONE)
        return ids

    def _merge_long(self, raw: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in raw]
        n, ranks, merged = len(ids), self.ranks, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for k in range(n - 1):
            rank = ranks.get(ids[k] << _BITS | ids[k + 1])
            if rank is not None:
                queue.append(rank << 40 | k)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            rank, k = entry >> 40, entry & 0xFFFFFFFFFF
            j = after[k]
            if j >= n or ids[k] < 0 or ranks.get(ids[k] << _BITS | ids[j]) != rank:
                continue  # stale
            new = ids[k] = merged[rank]
            ids[j] = -1
            j = after[k] = after[j]
            if j < n:
                before[j] = k
                rank = ranks.get(new << _BITS | ids[j])
                if rank is not None:
                    heapq.heappush(queue, rank << 40 | k)
            i = before[k]
            if i >= 0:
                rank = ranks.get(ids[i] << _BITS | new)
                if rank is not None:
                    heapq.heappush(queue, rank << 40 | i)
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> bytes:
        """Packed ids of a pre-token that is not in ``words``."""
        packed = self.older.get(word)
        if packed is None:
            packed = array("I", self.merge(word.encode("utf-8"))).tobytes()
        if len(word) <= 64:  # long ones are rare and would make the bound one of number only
            if len(self.words) >= CACHE_WORDS:
                self.older = dict(self.words)
                self.words.clear()
            self.words[word] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = self.cut.split(text) if self.cut and any(a in text for a in self.added) else [text]
        out = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.added[piece])
                continue
            find = _GENERAL if _OTHER.search(piece) else _LATIN
            out += map(self.words.__getitem__, find.findall(piece))
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; bytes that are not UTF-8 become U+FFFD."""
        if not ids:
            return ""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_BUILT: dict[str, Bpe] = {}


def _built(key: str, spec) -> Bpe:
    """One model per worker process."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Bpe(spec.value)
    return _BUILT[key]


class Tokenizer:
    """Column functions for one vocabulary file."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        Bpe(raw)  # an unsupported file fails here, not in a task
        key, spec = hashlib.sha256(raw).hexdigest(), spark.sparkContext.broadcast(raw)

        def each(method: str, kind: pa.DataType):
            def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
                work = getattr(_built(key, spec), method)
                for values in columns:
                    yield pa.array([work(v.as_py()) for v in values], kind)

            return run

        def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = _built(key, spec)
            for values in columns:
                ids = [model.encode(v.as_py()) for v in values]
                texts = pa.array([model.decode(i) for i in ids], pa.string())
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), texts], ["ids", "decoded"])

        self._both = F.arrow_udf(both, "struct<ids:binary,decoded:string>")
        self._encode = F.arrow_udf(each("encode", pa.binary()), "binary")
        self._decode = F.arrow_udf(each("decode", pa.string()), "string")

    def encode(self, text: Column) -> Column:
        """Token ids as packed little-endian unsigned 32-bit integers; null and
        empty texts have none."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def round_trip(self, text: Column) -> Column:
        """``struct<ids, decoded>``: both in one pass and one Python worker."""
        return self._both(text)


def ids_array(ids: Column) -> Column:
    """Packed ids as ``array<long>``, in built-in functions."""
    byte = lambda at: F.conv(F.hex(F.substring(ids, at, 1)), 16, 10).cast("long")
    number = lambda k: byte(4 * k + 1) + byte(4 * k + 2) * 256 + byte(4 * k + 3) * 65536 + byte(4 * k + 4) * 16777216
    count = F.octet_length(ids).cast("int") / 4
    return F.when(count == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), count.cast("int") - 1), number)
    )


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with its texts' packed ids in ``ids_col`` (which replaces a column of that name).

    Null and empty texts have no ids. A row's ids depend on its text alone, so repeated rows have the
    same; an empty table gives an empty one. This holds for the functions below, too."""
    return docs.withColumn(ids_col, tokenizer.encode(column(docs, text_col).cast("string")))


def round_trip_documents(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text", ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``docs`` with packed ids in ``ids_col`` and the text decoded from them in ``to`` (both
    replace columns of these names)."""
    (both,) = fresh(docs, "round_trip")
    out = docs.withColumn(both, tokenizer.round_trip(column(docs, text_col).cast("string")))
    return out.withColumns({ids_col: F.col(f"{both}.ids"), to: F.col(f"{both}.decoded")}).drop(both)


def decode_documents(docs: DataFrame, tokenizer: Tokenizer, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the texts of packed ids in ``text_col`` (which replaces a column of that name)."""
    return docs.withColumn(text_col, tokenizer.decode(column(docs, ids_col)))
