"""Connected components of a graph given as edges."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.llm.tables import stored


def connected(edges: DataFrame, label: str) -> DataFrame:
    """(node, comp): every node of an edge (u, v) with the least node it reaches.

    Alternating stars (Kiveris et al., "Connected components in MapReduce and
    beyond", 2014): each round hooks the larger neighbours of a node, then the
    smaller ones, to the least node around it. Neighbours are never gathered:
    the least one is an aggregate that is joined back. Rounds are written to the
    shared folder and end when a round changes no edge; a logarithmic number of
    them is enough.
    """
    spark = edges.sparkSession

    def print_of(df: DataFrame):
        # Order-free and one row: enough to see that two rounds are equal.
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                      F.sum(F.xxhash64("v", "u") % 1_000_003)).first()

    now = stored(spark, edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(), label)
    seen = print_of(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        hooked = both.join(least, "u").filter(F.col("v") > F.col("u")) \
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct()
        hooked = stored(spark, hooked, label)
        down = hooked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("least"))
        met = down.join(least, "u")
        now = stored(spark, met.select(F.col("v").alias("u"), F.col("least").alias("v"))
                     .union(least.select("u", F.col("least").alias("v")))
                     .filter("u <> v").distinct(), label)
        found = print_of(now)
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")) \
        .union(roots.select("node", F.col("node").alias("comp")))
