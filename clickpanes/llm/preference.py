"""Preference formatting (built-in functions only).

A pair has a chosen and a rejected conversation. Their longest common turn
prefix is rendered once, as the prompt; what follows in each is its completion,
rendered with the mask of what the loss is taken on (assistant turns).

The turns of a conversation are its distinct rows in the order of turn number, role and
text. In that order the common prefix of two conversations is what lies before
the least turn that only one of them has, so it is found by a minimum, and no
conversation has to be put together. The result is long: one row per rendered turn.

Texts are dealt once, by pair. A pair with more than ``HOT_ROWS`` rows is dealt over as many
salts as it has such shares, so a conversation with any number of turns never meets in one task. All
else happens where the turns then lie; only for hot pairs, which go separately, are facts of a pair gathered
over its salts and copied to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column

#: Turn markers of the rendered text (fixed values).
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
HOT_ROWS = 1 << 16


def _salt() -> Column:
    return F.pmod(F.xxhash64("turn", "role", "text"), F.col("salts")).cast("int").alias("salt")


def turns(df: DataFrame, pair_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``pair, salts, salt, turn, role, text``; rows equal in pair, turn number, role and text
    count once, different rows of one turn number all stay. A null role is ``unknown``, a null text is empty. Rows without a pair id or
    a turn number have no place in a conversation and are left out. An empty table gives an empty one."""
    rows = df.select(
        column(df, pair_col).alias("pair"),
        column(df, turn_col).cast("long").alias("turn"),
        F.coalesce(column(df, role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(column(df, text_col).cast("string"), F.lit("")).alias("text"),
    ).where("pair IS NOT NULL AND turn IS NOT NULL")
    # At most one row for every HOT_ROWS rows of the table.
    hot = rows.groupBy(F.col("pair").alias("hot")).agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS)
    hot = F.broadcast(hot.select("hot", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("shares")))
    rows = rows.join(hot, F.col("pair") == F.col("hot"), "left").withColumn("salts", F.coalesce("shares", F.lit(1)))
    dealt = rows.select("pair", "salts", _salt(), "turn", "role", "text").repartition("pair", "salt")
    return dealt.distinct()


def _split(rows: DataFrame, work: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """``work(rows, keys)`` of the ordinary pairs, which lie together under ``keys``, and of the hot ones."""
    return work(rows.where("salts = 1"), ["pair", "salt"]).union(work(rows.where("salts > 1"), ["pair"]))


def _with_pair(rows: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Left join turns with one row per pair: by ``keys`` where a pair lies together, else
    the row is copied for each salt."""
    if keys == ["pair"]:
        pairs = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return rows.join(pairs.drop("salts"), ["pair", "salt"], "left")


def _place(*names: str) -> Column:
    return F.struct(*[F.col(c).alias(n) for c, n in zip(names, ("turn", "role", "text"))])


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), text, F.lit(TURN_END))


def preference_segments(chosen: DataFrame, rejected: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``pair, part, turn, role, segment, mask_start, mask_end``.

    ``chosen`` and ``rejected`` come from ``turns``. ``part`` is ``prompt``,
    ``chosen`` or ``rejected``; the segments of a part in the order of ``turn``, then of the segment,
    put together, are its text. ``mask_start`` and ``mask_end`` (code points of
    the segment, end exclusive) bound what is trained on: text and end marker
    of a completion's assistant turns, null elsewhere. Turn numbers need not be
    dense. A pair that only one side has is all completion after an empty
    prompt; equal conversations are all prompt; empty tables give no rows.
    """
    both = chosen.select("*", F.lit(True).alias("c"), F.lit(False).alias("r"))
    both = both.union(rejected.select(*chosen.columns, F.lit(False).alias("c"), F.lit(True).alias("r")))
    # A hot pair's sides may have been dealt over different numbers of salts.
    salts = both.groupBy("pair").agg(F.max("salts").alias("salts"))
    keys = ["pair", "turn", "role", "text"]
    marked = both.groupBy(*keys).agg(F.max("c").alias("c"), F.max("r").alias("r")).join(salts, "pair")
    marked = marked.select("pair", "salts", _salt(), "turn", "role", "text", "c", "r").repartition("pair", "salt")
    return _split(marked, lambda rows, by: _segments(rows, by, train_role))


def _segments(marked: DataFrame, keys: list[str], train_role: str) -> DataFrame:
    """``preference_segments`` of turns that are marked: ``pair, salts, salt, turn, role, text``, each once, and whether
    it is the chosen (``c``) and the rejected (``r``) conversation's."""
    place = _place("turn", "role", "text")
    cut = marked.where("c <> r").groupBy(*keys).agg(F.max("salts").alias("salts"), F.min(place).alias("cut"))
    rows = _with_pair(marked, cut, keys)
    shared = F.col("cut").isNull() | (place < F.col("cut"))
    of = lambda flag, name: F.when(F.col(flag), F.lit(name))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(F.array_compact(F.array(of("c", "chosen"), of("r", "rejected"))))
    rows = rows.select("pair", F.explode(parts).alias("part"), "turn", "role", "text")
    head = F.length(F.concat(F.lit(TURN_START), F.col("role"), F.lit("\n")))
    trained = (F.col("part") != "prompt") & (F.col("role") == train_role)
    segment = render_turn(F.col("role"), F.col("text"))
    return rows.select(
        "pair",
        "part",
        "turn",
        "role",
        segment.alias("segment"),
        F.when(trained, head).alias("mask_start"),
        F.when(trained, F.length(segment)).alias("mask_end"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """``pair, prompt, chosen, rejected``, one row per pair, for conversations
    that fit a row (any that fit a model's context do)."""
    part = lambda name: F.array_sort(
        F.collect_list(F.when(F.col("part") == name, F.struct("turn", "segment")))
    )
    text = lambda name: F.array_join(F.transform(part(name), lambda s: s["segment"]), "").alias(name)
    return segments.groupBy("pair").agg(text("prompt"), text("chosen"), text("rejected"))


def _stale(conv: DataFrame, keys: list[str], train_role: str) -> DataFrame:
    """Turns marked for ``_segments``: the chosen conversations ``conv``, and the rejected ones derived from them."""
    # Replies are ranked among all turns, so the dealt turns are read as they are, not dealt again without the rest.
    reply = F.col("role") == train_role
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(reply.desc(), F.desc("turn"), F.desc("text")))
    two = conv.withColumn("back", back).where((F.col("back") <= 2) & reply)
    nth = lambda k, c: F.max(F.when(F.col("back") == k, F.col(c)))
    facts = two.groupBy(*keys).agg(
        F.max("salts").alias("salts"), nth(1, "turn").alias("last"), nth(1, "text").alias("last_text"), nth(2, "turn").alias("before"), nth(2, "text").alias("stale")
    )
    rows = _with_pair(conv, facts.withColumn("reply", F.lit(train_role)), keys)
    place, end = _place("turn", "role", "text"), _place("last", "reply", "last_text")
    # A stale text equal to the last, or of the last turn itself, is a turn the conversation has.
    same = F.col("stale").isNotNull() & (F.col("stale") == F.col("last_text"))
    kept = F.coalesce(F.col("last").isNull() | (place < end) | (same & (place == end)), F.lit(False))
    source = (F.col("before") < F.col("last")) & ~same & (F.col("turn") == F.col("before")) & (F.col("role") == F.col("reply")) & (F.col("text") == F.col("stale"))
    own = F.struct(F.col("turn").alias("turn"), F.lit(True).alias("c"), kept.alias("r"))
    moved = F.when(F.coalesce(source, F.lit(False)), F.struct(F.col("last").alias("turn"), F.lit(False).alias("c"), F.lit(True).alias("r")))
    rows = rows.select("pair", "salts", "salt", "role", "text", F.inline(F.array_compact(F.array(own, moved))))
    # The moved turn stays where it was: a salt only has to be below the pair's number of them.
    return rows.select("pair", "salts", "salt", "turn", "role", "text", "c", "r")


def stale_reply_segments(conv: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``preference_segments`` of conversations (from ``turns``) that have no rejected side.

    A rejected conversation is the chosen one up to its last reply, with the text of the reply before in that place (a
    stale answer); with one reply only, it ends before it. Conversations without a reply stay as they are."""
    return _split(conv, lambda rows, keys: _segments(_stale(rows, keys, train_role), keys, train_role))


def stale_reply_rejections(conv: DataFrame, train_role: str = "assistant") -> DataFrame:
    """The rejected conversations of ``stale_reply_segments``, as a side of their own."""
    rejected = _split(conv, lambda rows, keys: _stale(rows, keys, train_role)).where("r")
    return rejected.select("pair", "salts", _salt(), "turn", "role", "text")
