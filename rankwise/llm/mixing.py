"""Mixing sources to target weights: Pfair scheduling (native).

Documents of a source, in a seeded order, form blocks of ``BLOCK_DOCS``. Weights
are whole units of a period, shares in billionths at every size of the input: a source with ``a`` of ``P`` units gets its block
``k`` (from 1) of a period released at slot ``floor((k-1)P/a)`` and due before
slot ``ceil(kP/a)``, and earliest-deadline-first among the released blocks fills
one slot after the other. All windows are met, so after any number of slots a
source has had its share of units to within less than one block, and after a
period exactly its share. The schedule of one period, as far as there are blocks to place,
is the schedule of all: block ``k`` of a source goes to period ``(k-1) div a``, and
documents get their slots by a join.

The place of a document within its source comes from two levels: counts of
hash prefixes give each prefix its offset, and rows are numbered inside a
prefix. Prefixes are as long as it takes to keep each numbered group small, so
no group is a whole source, however large.

Sources are what someone weights, so there are thousands of them at most: the
fold over the slots is one task with a step for each slot and source. Slots are
blocks and not documents, but they grow with the input.

A source that runs out leaves its later slots unused; the others keep theirs,
and no document is dropped or repeated.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.tables import stored
from rankwise.llm.text import fresh

BLOCK_DOCS = 32
PERIOD = 1_000_000_000   # units of all sources: a billion blocks are off by half a block
LEAST_SHARE = 1000       # a source has one in so many units at least
SLOTS_AT_ONCE = 1000     # slots that the fold adds to the plan at once
GROUP_ROWS = 20_000      # aim for the rows numbered together
FAR = 1 << 60


def square_root_weights(counts: DataFrame) -> DataFrame:
    """Weights between equal and proportional: the square root of the number of
    documents, in whole millionths so that their sum is exact."""
    return counts.withColumn("weight", F.round(F.sqrt(F.col("n").cast("double")) * 1_000_000)
                             .cast("long"))


def given_weights(counts: DataFrame, weights: dict) -> DataFrame:
    """Weights of a dict by source; a source without one gets the least there is."""
    parts = [F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(round(w * 1_000_000)))
             for s, w in weights.items() if w > 0]
    return counts.withColumn("weight", F.coalesce(*parts, F.lit(0)).cast("long"))


def units(weighted: DataFrame, period: int) -> DataFrame:
    """(key, source, n, units): the weight as a share of the period, rounded to whole
    units, and one in ``LEAST_SHARE`` at least. Units of all sources add up to the
    period that is scheduled."""
    total = F.greatest(F.sum("weight").over(Window.partitionBy()), F.lit(1)).cast("double")
    share = F.round(F.col("weight") / total * F.lit(float(period))).cast("long")
    least = max(1, period // LEAST_SHARE)
    return weighted.withColumn("units", F.greatest(share, F.lit(least))) \
        .select("key", "source", "n", "units")


def _turns(blocks: Column, period: Column, share: Column, up: bool = False) -> Column:
    """The slots that so many blocks take, exactly, rounded down or up."""
    return F.call_function("div", blocks * period + (share - 1 if up else 0), share)


def schedule(sources: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One period: a row for each slot, with the source (key) whose block ``k``
    it holds, and that block's release, deadline and slot within the period. With
    the numbers of documents (n) it ends where they have slots.

    The sources and their units are one row, and earliest-deadline-first is one
    fold over the slots; its state is the number of blocks that each source has
    had. Equal deadlines go by the order of the keys.
    """
    blocks = F.least(F.ceil(F.col("n") / block_docs), F.col("units")) \
        if "n" in sources.columns else F.col("units")
    one = sources.withColumn("blocks", blocks.cast("long")).agg(
        F.sort_array(F.collect_list(F.struct("key", "units", "blocks"))).alias("all"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("period"))
    one = one.withColumn("slots", F.coalesce(F.array_max(F.transform("all", lambda s: _turns(
        s["blocks"], F.col("period"), s["units"], True))), F.lit(0)))
    no_blocks = F.transform("all", lambda s: F.lit(0).cast("long"))
    no_plan = F.array().cast("array<struct<i:int,k:bigint>>")

    def fill(state: Column, slot: Column) -> Column:
        def due(s: Column, i: Column) -> Column:
            had = F.get(state["had"], i)
            released = _turns(had, F.col("period"), s["units"]) <= slot
            deadline = _turns(had + 1, F.col("period"), s["units"], True)
            open_ = released & (had < s["units"])
            return F.struct(F.when(open_, deadline).otherwise(F.lit(FAR)).cast("long").alias("by"),
                            i.alias("i"))

        def given(first: Column) -> Column:
            return F.struct(
                F.transform(state["had"], lambda x, i: F.when(i == first, x + 1).otherwise(x))
                .alias("had"),
                F.concat(state["plan"], F.array(F.struct(
                    first.alias("i"), F.get(state["had"], first).alias("k")))).alias("plan"))
        # The lambda names the first source, so that it is found once a slot.
        return F.get(F.transform(F.array(F.array_min(F.transform("all", due))["i"]), given),
                     F.lit(0))

    def fill_some(state: Column, start: Column) -> Column:
        return F.aggregate(
            F.sequence(start, F.least(start + SLOTS_AT_ONCE, F.col("slots")) - 1),
            F.struct(state["had"].alias("had"), no_plan.alias("plan")), fill,
            lambda s: F.struct(s["had"].alias("had"),
                               F.concat(state["plan"], s["plan"]).alias("plan")))
    starts = F.when(F.col("slots") > 0, F.sequence(F.lit(0).cast("long"), F.col("slots") - 1,
                                                   F.lit(SLOTS_AT_ONCE).cast("long"))) \
        .otherwise(F.array().cast("array<long>"))
    plan = one.select("all", "period", F.aggregate(
        starts, F.struct(no_blocks.alias("had"), no_plan.alias("plan")), fill_some,
        lambda s: s["plan"]).alias("plan"))
    plan = plan.select("period", "all", F.posexplode("plan").alias("slot", "turn"))
    plan = plan.select("period", "slot", F.get("all", F.col("turn.i")).alias("s"), "turn.k") \
        .select("period", "slot", "s.key", "s.units", "k")
    p, a = F.col("period"), F.col("units")
    return plan.withColumn("release", _turns(F.col("k"), p, a)) \
        .withColumn("deadline", _turns(F.col("k") + 1, p, a, True))


def mix(docs: DataFrame, *, weights: dict | None = None, doc_id: str = "doc_id",
        source: str = "source", block_docs: int = BLOCK_DOCS, period: int = PERIOD,
        seed: str = "mix") -> DataFrame:
    """All rows and columns of ``docs`` with their place in the mixture (long):
    mix_units and mix_period (the weight), mix_block (of its source, from 0),
    mix_release, mix_deadline, mix_slot, mix_position (unique; reading in its
    order is reading the mixture).

    ``weights``: target weight by source; by default as the square root of the
    number of documents. A null source is a source. A null id is ordered by an
    empty hash text; repeated rows and rows with one id get places of their own,
    ordered by their whole content, and equal rows are interchangeable. A column
    that already has one of the names above keeps it and the new one gets a
    leading underscore. An empty table gives an empty result. Texts play no part.
    """
    spark = docs.sparkSession
    names = {n: fresh(docs, n) for n in ("mix_units", "mix_period", "mix_block", "mix_release",
                                         "mix_deadline", "mix_slot", "mix_position")}
    key = F.to_json(F.struct(F.col(f"`{source}`").alias("source")))
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("key"),
                       order.alias("order"))
    counts = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("key", F.to_json(F.struct("source")))
    weighted = given_weights(counts, weights) if weights else square_root_weights(counts)
    sources = stored(spark, units(weighted, period), "mix-sources")
    plan = stored(spark, schedule(sources, block_docs), "mix-schedule")
    largest = sources.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    digits = max(1, math.ceil(math.log(max(largest / GROUP_ROWS, 1), 16)))

    rows = rows.withColumn("prefix", F.substring("order", 1, digits))
    before = Window.partitionBy("key").orderBy("prefix") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("key", "prefix").agg(F.count(F.lit(1)).alias("n")) \
        .select("key", "prefix", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets, _ = sizes.hinted(stored(spark, offsets, "mix-offsets"))
    inside = Window.partitionBy("key", "prefix").orderBy("order", "content")
    ranked = rows.withColumn("content", F.xxhash64("row")) \
        .withColumn("place", F.row_number().over(inside).cast("long") - 1) \
        .join(offsets, ["key", "prefix"]) \
        .withColumn("place", F.col("place") + F.col("offset"))
    ranked = ranked.withColumn("block", F.floor(F.col("place") / block_docs)) \
        .join(sizes.hinted(sources.select("key", "units"))[0], "key") \
        .withColumn("round", F.floor(F.col("block") / F.col("units"))) \
        .withColumn("k", F.col("block") - F.col("round") * F.col("units")).drop("units")
    placed = ranked.join(sizes.hinted(plan)[0], ["key", "k"])
    start = F.col("round") * F.col("period")
    slot = start + F.col("slot")
    made = {"mix_units": F.col("units"), "mix_period": F.col("period"),
            "mix_block": F.col("block"), "mix_release": start + F.col("release"),
            "mix_deadline": start + F.col("deadline"), "mix_slot": slot,
            "mix_position": slot * block_docs + F.col("place") % block_docs}
    return placed.select("row.*", *(c.cast("long").alias(names[n]) for n, c in made.items()))
