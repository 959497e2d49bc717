"""Quality rules: base limits, then robust multivariate outliers (native).

The statistics of a document are taken from its whole text inside the row,
without a shuffle. They become a vector of five transformed statistics, and
each (language, source) group gets a minimum-covariance-determinant (MCD)
estimate of their centre and covariance. A document that passes the base limits
is rejected when its Mahalanobis distance from that centre is beyond a
chi-square limit.

MCD runs as concentration steps: a step ranks the documents of a group by the
distance under the current estimate and re-estimates from the nearest
``SUPPORT`` share. Ranking and re-estimating are one aggregation: per group and
distance bucket it keeps a count and the sums of the vector and its products,
and a running count over the buckets of a group tells which buckets belong to
the nearest share. No group is ever gathered or sorted, so a source with a
third of all rows costs what its rows cost.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.text import BLANKS, blank_words, lines, named
from rankwise.session import scratch_path

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SUPPORT = 0.75       # share of a group that an estimate is made from
STEPS = 3            # concentration steps after the start
MIN_GROUP = 50       # smaller groups are judged by their language's estimate
TAIL = 1e-6          # chance of a normal vector beyond the limit
BUCKETS_PER_UNIT = 64    # distance buckets per unit of ln(distance squared)
GRID = 128           # start: median and spread are read off a grid of 1/128

# Smallest standard deviation taken for each statistic, so that one that is
# zero nearly everywhere in a group rejects nothing for being slightly more.
FLOORS = {"x_words": 0.5, "x_length": 0.15, "x_variety": 0.15,
          "x_symbols": 0.5, "x_lines": 1.0, "x_repeats": 1.0}
VECTOR = list(FLOORS)
PAIRS = [(a, b) for i, a in enumerate(VECTOR) for b in VECTOR[:i + 1]]


def chi_square_cdf(x: float, k: float) -> float:
    """P(chi-square with k degrees of freedom <= x), by the gamma series."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a))) if z > 0 else 0.0


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


LIMIT = chi_square_quantile(1 - TAIL, len(VECTOR))
# The nearest SUPPORT share of a normal sample has too small a covariance.
CONSISTENCY = SUPPORT / chi_square_cdf(chi_square_quantile(SUPPORT, len(VECTOR)), len(VECTOR) + 2)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, n_distinct, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words (all long); columns of these names are replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = (df.withColumn("_words", blank_words(F.col(text)))
           .withColumn("_lines", F.filter(lines(F.col(text)),
                                          lambda x: x.rlike(r"[^\x09-\x0D\x20]")))
           .withColumn("_size", F.size("_words")))
    # A window of 8 words is known by a 64-bit hash within its own document:
    # hashes of words are joined to those of 2, of 4 and of 8 words.
    out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    step = 1
    while step < WINDOW:
        out = out.withColumn("_hashes", F.zip_with(
            "_hashes", F.slice("_hashes", step + 1, F.greatest(F.col("_size"), F.lit(1))),
            lambda a, b: F.xxhash64(a, b)))
        step *= 2
    out = out.withColumn("_hashes", F.slice(
        "_hashes", 1, F.greatest(F.col("_size") - (WINDOW - 1), F.lit(0))))
    unique = F.size(F.array_distinct("_hashes")) == F.size("_hashes")
    # Only for a document with a repeated window: sort windows by hash, keep
    # the starts of those that equal a neighbour, in text order.
    out = out.withColumn("_sorted", F.when(~unique, F.array_sort(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    def same(i, j):
        return F.get("_sorted", i)["h"] == F.get("_sorted", j)["h"]
    out = out.withColumn("_starts", F.sort_array(F.filter(F.transform(
        "_sorted", lambda x, i: F.when(
            F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)),
            x["i"])), lambda x: x.isNotNull())))
    # Each start covers WINDOW words, or as many as there are up to the next.
    repeat = F.aggregate(
        F.transform("_starts", lambda s, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    stats = {
        "n_words": F.col("_size"),
        "n_distinct": F.size(F.array_distinct("_words")),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.size(F.regexp_extract_all(t, F.lit(r"[#*$%&|<>]"), F.lit(0))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(repeat, F.lit(0)),
    }
    return (out.withColumns({k: v.cast("long") for k, v in stats.items()})
            .drop("_words", "_lines", "_size", "_hashes", "_sorted", "_starts"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) \
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> dict[str, Column]:
    """The transformed statistics; logarithms and logits pull long tails in."""
    def share(part: str, whole: str) -> Column:
        return F.ln(1 + 100 * F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    return {
        "x_words": F.ln(F.greatest(F.col("n_words"), F.lit(1)).cast("double")),
        "x_length": F.ln(F.greatest(F.col("word_chars"), F.lit(1))
                         / F.greatest(F.col("n_words"), F.lit(1))),
        "x_variety": F.ln(F.greatest(F.col("n_words"), F.lit(1))
                          / F.greatest(F.col("n_distinct"), F.lit(1))),
        "x_symbols": share("n_symbols", "n_words"),
        "x_lines": share("n_dup_lines", "n_lines"),
        "x_repeats": share("n_repeat_words", "n_words"),
    }


def _total(parts):
    return reduce(lambda a, b: a + b, parts)


def _with_distance(df: DataFrame, name: str) -> DataFrame:
    """Mahalanobis distance squared under the group's centre and Cholesky
    factor, by forward substitution; one column after the other, as each is
    used by all later ones."""
    for i, a in enumerate(VECTOR):
        rest = [F.col(f"l_{a}_{b}") * F.col(f"y_{b}") for b in VECTOR[:i]]
        df = df.withColumn(f"y_{a}", (F.col(a) - F.col(f"m_{a}") - (_total(rest) if rest else 0.0))
                           / F.col(f"l_{a}_{a}"))
    solved = [f"y_{a}" for a in VECTOR]
    return df.withColumn(name, _total([F.col(y) * F.col(y) for y in solved])).drop(*solved)


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _start(features: DataFrame) -> DataFrame:
    """Centre: median of each statistic; spread: from the quartiles."""
    values = features.select("group", F.explode(F.array(*(
        F.struct(F.lit(x).alias("name"), F.floor(F.col(x) * GRID).alias("cell"))
        for x in VECTOR))).alias("v")).select("group", "v.name", "v.cell")
    cells = values.groupBy("group", "name", "cell").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("group", "name")
    cells = cells.withColumn("upto", F.sum("n").over(
        of.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("all", F.sum("n").over(of))
    def at(x, q):
        return F.min(F.when((F.col("name") == x) & (F.col("upto") >= q * F.col("all")),
                            F.col("cell"))) / GRID
    start = cells.groupBy("group").agg(*(c for x in VECTOR for c in (
        at(x, 0.5).alias(f"m_{x}"),
        F.greatest((at(x, 0.75) - at(x, 0.25)) / 1.349, F.lit(FLOORS[x]))
        .alias(f"l_{x}_{x}"))))
    zeros = {f"l_{a}_{b}": F.lit(0.0) for a, b in PAIRS if a != b}
    return start.withColumns(zeros)


def _concentrate(features: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: centre and Cholesky factor from the nearest SUPPORT share."""
    near = _with_distance(features.join(sizes.hinted(estimate)[0], "group"), "_d")
    bucket = F.floor(F.ln(F.col("_d") + 1e-6) * BUCKETS_PER_UNIT)
    sums = [F.sum(x).alias(f"s_{x}") for x in VECTOR] \
        + [F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in PAIRS]
    cells = near.groupBy("group", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *sums)
    run = Window.partitionBy("group").orderBy("bucket")
    cells = (cells.withColumn("before", F.coalesce(F.sum("n").over(
                run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("all", F.sum("n").over(Window.partitionBy("group")))
             .filter(F.col("before") < SUPPORT * F.col("all")))
    names = ["n", *(f"s_{x}" for x in VECTOR), *(f"p_{a}_{b}" for a, b in PAIRS)]
    out = cells.groupBy("group").agg(*(F.sum(c).alias(c) for c in names),
                                     F.max("all").alias("n_group"))
    out = out.withColumns({f"m_{x}": F.col(f"s_{x}") / F.col("n") for x in VECTOR})
    out = out.withColumns({
        f"c_{a}_{b}": CONSISTENCY * (F.col(f"p_{a}_{b}") / F.col("n")
                                     - F.col(f"m_{a}") * F.col(f"m_{b}"))
        + (FLOORS[a] ** 2 if a == b else 0.0) for a, b in PAIRS})
    for i, a in enumerate(VECTOR):
        for j, b in enumerate(VECTOR[:i + 1]):
            known = [F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}") for k in VECTOR[:j]]
            left = F.col(f"c_{a}_{b}") - (_total(known) if known else 0.0)
            out = out.withColumn(f"l_{a}_{b}", F.sqrt(left) if a == b
                                 else left / F.col(f"l_{b}_{b}"))
    return out.select("group", "n_group", *(f"m_{x}" for x in VECTOR),
                      *(f"l_{a}_{b}" for a, b in PAIRS))


def _judged(docs: DataFrame, carry: list[str], text: str, lang: str,
            source: str) -> DataFrame:
    """``judge`` with the carried columns as one struct, ``row``."""
    spark = docs.sparkSession
    def key(*parts):
        return F.to_json(F.struct(*parts))
    slim = docs.select(
        F.struct(*(named(c) for c in carry)).alias("row"),
        key(named(lang).alias("lang"), F.struct(named(source).alias("source")).alias("in"))
        .alias("own_group"),
        key(named(lang).alias("lang")).alias("lang_group"), named(text).alias("_text"))
    slim = with_statistics(slim, "_text").drop("_text")
    slim = slim.withColumn("base_failed", base_failed()).withColumns(vector())
    slim = _stored(spark, slim, "quality-statistics")
    passing = slim.filter(~F.col("base_failed")).select(
        F.explode(F.array("own_group", "lang_group")).alias("group"), *VECTOR)
    estimate = _stored(spark, _start(passing), "quality-start")
    for _ in range(STEPS):
        estimate = _stored(spark, _concentrate(passing, estimate), "quality-estimate")
    large = estimate.filter(F.col("n_group") >= MIN_GROUP).drop("n_group")
    numbers = [c for c in large.columns if c != "group"]
    def known(key, prefix):
        return sizes.hinted(large.select(
            F.col("group").alias(key), *(F.col(c).alias(prefix + c) for c in numbers),
            F.lit(True).alias(prefix + "known")))[0]
    out = (slim.join(known("own_group", "own_"), "own_group", "left")
           .join(known("lang_group", "lang_"), "lang_group", "left"))
    out = out.withColumns({c: F.when(F.col("own_known"), F.col("own_" + c))
                           .otherwise(F.col("lang_" + c)) for c in numbers})
    out = _with_distance(out, "distance").withColumn(
        "distance", F.when(~F.col("base_failed"), F.col("distance")))
    return out.withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= LIMIT, F.lit(True)))


def judge(docs: DataFrame, *, text: str = "text", lang: str = "lang",
          source: str = "source", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``carry``, the statistics, base_failed, distance
    (Mahalanobis, squared; null without an estimate) and kept.

    Null text counts as empty and fails the base limits. A null language or
    source is a group of its own. Documents of a group that has fewer than
    ``MIN_GROUP`` passing the base limits are measured against the estimate of
    their language over all sources; where that has too few as well, there is
    no distance and they are kept. Repeated rows are judged alike, each on its
    own. An empty table gives an empty result; other columns are not read.

    Writes the statistics (not the texts) and the group estimates to the
    shared folder and reads them back, so a lost executor costs a re-read.
    """
    return _judged(docs, list(carry), text, lang, source).select(
        "row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "distance", "kept")


def keep(docs: DataFrame, *, text: str = "text", lang: str = "lang",
         source: str = "source") -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns and no others.

    Here whole rows are written beside their statistics, so that no join has to
    find the text of a verdict again.
    """
    return _judged(docs, docs.columns, text, lang, source).filter("kept").select("row.*")
