"""Preference formatting of chosen and rejected conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.ranking import global_rank
from strataflow.llm.common import map_batches
from strataflow.session import materialize

TURNS = "array<struct<role:string,text:string>>"
# The turn template and the roles whose text is trained on.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)
BLOCK_BITS = 10  # ranks are counted over blocks of 2 ** BLOCK_BITS ids; the result does not depend on it

_MASK = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FIELDS = [T.StructField("n_common", T.IntegerType()), T.StructField("prompt", T.StringType()),
           T.StructField("chosen_completion", T.StringType()), T.StructField("chosen_mask", _MASK),
           T.StructField("rejected_completion", T.StringType()), T.StructField("rejected_mask", _MASK)]


def render(turns: list[dict]) -> tuple[str, list[dict]]:
    """The text of some turns, and the ranges (code points, end exclusive) that are trained on: what a trained role
    says, with the closing mark. A null role is ``user``, a null text empty; marks inside a text are broken up."""
    out, mask, at = [], [], 0
    for turn in turns:
        role = turn["role"] if turn["role"] is not None else "user"
        head = f"{OPEN}{role}\n"
        body = (turn["text"] or "").replace("<|", "< |") + CLOSE
        out.append(f"{head}{body}\n")
        if role in TRAINED:
            mask.append({"start": at + len(head), "end": at + len(head) + len(body)})
        at += len(out[-1])
    return "".join(out), mask


def format_pairs(pairs: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``pairs`` with the turns both conversations begin with rendered once as ``prompt`` (``n_common`` of them),
    and what follows in each as ``*_completion`` with ``*_mask``, the ranges of it that are trained on.

    The two columns are arrays of (role, text). Turns are equal if role and text are (null equals null). A
    conversation that is a prefix of the other has an empty completion; so have both if they are equal. A null
    conversation has no turns. Columns of the new names are replaced, and all others kept.
    """
    def start():
        def compute(batch):
            made = {f.name: [] for f in _FIELDS}
            for chosen, rejected in zip(*(batch.column(c).to_pylist() for c in (chosen_col, rejected_col)), strict=True):
                chosen, rejected = chosen or [], rejected or []
                n = next((i for i, (a, b) in enumerate(zip(chosen, rejected, strict=False)) if a != b),
                         min(len(chosen), len(rejected)))
                made["n_common"].append(n)
                made["prompt"].append(render(chosen[:n])[0])
                for name, turns in (("chosen", chosen), ("rejected", rejected)):
                    text, mask = render(turns[n:])
                    made[f"{name}_completion"].append(text)
                    made[f"{name}_mask"].append(mask)
            return made

        return compute

    return map_batches(pairs, start, _FIELDS)


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv_id`` and ``turns`` (array of role, text in order of turn, then role and text).

    A conversation is one training example and so one row. Repeated rows count once. A row with a null id is a
    conversation of its own, so that such rows never gather in one group.
    """
    rows = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).distinct()
    one = F.array(F.struct("role", "text")).cast(TURNS)
    alone = rows.where("conv_id is null").select("conv_id", one.alias("turns"))
    grouped = rows.where("conv_id is not null").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("text"))).cast(TURNS).alias("turns")).union(alone)


def rank_in_opening(convs: DataFrame) -> DataFrame:
    """``convs`` with ``opening`` (hash of the first turn) and ``rank``, the exact ``row_number()`` by id in the opening.

    Conversations with a null id come last. Rows are counted by opening and block of ``2 ** BLOCK_BITS`` ids, blocks by
    block of blocks, and so on up to the whole range; a block's offset is its parent's and the counts before it inside
    its parent. So no window holds more than ``2 ** BLOCK_BITS`` rows, however frequent an opening is.
    """
    keyed = materialize(convs.select(
        "conv_id", "turns", F.xxhash64(F.get("turns", F.lit(0))).alias("opening"), F.col("conv_id").isNull().alias("last"),
        F.coalesce(F.col("conv_id").cast("long"), F.monotonically_increasing_id()).alias("at"))
        .withColumn("block", F.shiftright("at", BLOCK_BITS)))
    span = keyed.agg(F.greatest(F.max("block"), F.lit(0)).alias("hi"), F.least(F.min("block"), F.lit(0)).alias("lo")).first()
    levels = [keyed.groupBy("opening", "last", "block").agg(F.count("*").alias("n"))]
    for _ in range(-(-max((span["hi"] or 0).bit_length(), (~(span["lo"] or 0)).bit_length()) // BLOCK_BITS)):
        levels.append(levels[-1].groupBy("opening", "last", F.shiftright("block", BLOCK_BITS).alias("block"))
                      .agg(F.sum("n").alias("n")))

    def before(w):
        return F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # the top blocks are 0 and, of negative ids, -1: four rows of an opening at most
    offsets = levels[-1].select("opening", "last", "block", before(
        Window.partitionBy("opening").orderBy("last", "block")).alias("offset"))
    for level in reversed(levels[:-1]):
        inside = level.withColumn("parent", F.shiftright("block", BLOCK_BITS))
        inside = inside.withColumn("before", before(Window.partitionBy("opening", "last", "parent").orderBy("block")))
        offsets = inside.join(offsets.withColumnRenamed("block", "parent"), ["opening", "last", "parent"]).select(
            "opening", "last", "block", (F.col("offset") + F.col("before")).alias("offset"))
    order = Window.partitionBy("opening", "last", "block").orderBy("at")
    return keyed.join(offsets, ["opening", "last", "block"]).select(
        "conv_id", "turns", "opening", (F.col("offset") + F.row_number().over(order)).alias("rank"))


def pair_by_opening(convs: DataFrame) -> DataFrame:
    """``chosen_id, chosen, rejected_id, rejected``: neighbours (by id) among all conversations with the same first turn,
    each in one pair; the one whose last turn is longer is chosen, of equals the first.

    Rank 2k - 1 of an opening goes with rank 2k, however far their ids lie apart, so at most one conversation of an
    opening has no partner. It is chosen, with a null rejected one. Null ids rank last.
    """
    ranked = rank_in_opening(convs).withColumn("pair", F.shiftright(F.col("rank") - 1, 1))
    order = Window.partitionBy("opening", "pair").orderBy("rank")
    me = F.struct("conv_id", "turns")
    paired = (ranked.select("*", F.lead(me).over(order).alias("other"))
              .where("rank % 2 = 1").select(me.alias("one"), "other"))

    def last(c):
        return F.coalesce(F.length(F.element_at(F.col(f"{c}.turns"), -1)["text"]), F.lit(0))

    swap = F.col("other").isNotNull() & (last("other") > last("one"))
    picked = paired.select(F.when(swap, F.col("other")).otherwise(F.col("one")).alias("c"),
                           F.when(swap, F.col("one")).otherwise(F.col("other")).alias("r"))
    return picked.select(F.col("c.conv_id").alias("chosen_id"), F.col("c.turns").alias("chosen"),
                         F.col("r.conv_id").alias("rejected_id"), F.col("r.turns").alias("rejected"))


def with_other_answers(pairs: DataFrame) -> DataFrame:
    """``pairs`` of ``pair_by_opening``, those without a rejected side completed by another conversation's answer.

    The rejected side has the same turns up to the last assistant turn of the chosen one and there the words of the
    last assistant turn of the next such conversation by id (after the last, the first), whose id is ``rejected_id``.
    Conversations without an assistant turn or without an id neither get nor give an answer, and one that is alone
    in that gets none. Equal words give two equal sides.
    """
    said = F.array_max(F.filter(F.transform("chosen", lambda t, i: F.when(t["role"].isin(*TRAINED), i)), lambda i: i.isNotNull()))
    open_side = F.col("rejected").isNull() & F.col("chosen_id").isNotNull()
    placed = global_rank(pairs.where(open_side).select("chosen_id", "chosen", said.alias("at")).where("at is not null"),
                         "chosen_id", out="place")
    many = placed.count()
    if many < 2:
        return pairs
    donors = placed.select((F.pmod(F.col("place") - 2, F.lit(many)) + 1).alias("place"), F.col("chosen_id").alias("rejected_id"),
                           F.get("chosen", F.col("at"))["text"].alias("answer"))
    other = F.array(F.struct(F.get("chosen", F.col("at"))["role"].alias("role"), F.col("answer").alias("text")))
    made = placed.join(donors, "place").select("chosen_id", F.col("rejected_id").alias("_id"), F.concat(
        F.slice("chosen", F.lit(1), F.col("at")), other).cast(TURNS).alias("_turns"))
    return pairs.join(made, "chosen_id", "left").select(
        "chosen_id", "chosen", F.coalesce("rejected_id", "_id").alias("rejected_id"), F.coalesce("rejected", "_turns").alias("rejected"))
