"""Benchmark decontamination: prefix-filtered set join (native).

A benchmark item is the set of its windows of ``WINDOW`` consecutive words (one
shorter window for a shorter item). A text that contains a window contains all
its words, so the prefix that a join needs is one word: the rarest of the
window, by its count over all documents. Document words are joined to these
prefix words alone. A match at word ``p`` fixes where the window would have to
begin; positional and length bounds drop windows that would stick out of the
text, and what is left is compared word by word.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.tables import stored
from rankwise.llm.text import alnum_words, ascii_lower, named

WINDOW = 10


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(phrase, tokens, item_id as string): every window of every item once."""
    tokens = F.transform(alnum_words(named(text)), ascii_lower)
    out = items.select(F.coalesce(named(item_id).cast("string"), F.lit("")).alias("item_id"),
                       tokens.alias("all")).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    out = out.select("item_id", F.explode(F.transform(
        starts, lambda i: F.slice("all", i, window))).alias("tokens"))
    return out.select("item_id", "tokens", F.array_join("tokens", " ").alias("phrase")).distinct()


def _doc_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Words of each row behind one empty word that stands for the row itself."""
    words = docs.select(named(doc_id).alias("doc_id"), F.xxhash64(named(text)).alias("row_key"),
                        alnum_words(named(text)).alias("words"))
    return words.withColumn("n_words", F.size("words"))


def prefixes(docs: DataFrame, windows: DataFrame, text: str, limit: int) -> DataFrame:
    """(phrase, span, rare, offset): the rarest word of each window and where it
    stands in it. Counts are over all words of all documents; of equally rare
    words the first in string order, then the leftmost."""
    placed = windows.select("phrase", "tokens").distinct() \
        .select("phrase", F.size("tokens").alias("span"), F.posexplode("tokens"))
    vocabulary, _ = sizes.hinted(placed.select(F.col("col").alias("token")).distinct(), limit)
    counts = (docs.select(F.explode(alnum_words(named(text))).alias("w"))
              .select(ascii_lower(F.col("w")).alias("token"))
              .join(vocabulary, "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = placed.join(counts, placed["col"] == counts["token"], "left")
    least = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "col", "pos"))
    return ranked.groupBy("phrase", "span").agg(least.alias("least")) \
        .select("phrase", "span", F.col("least.col").alias("rare"),
                F.col("least.pos").alias("offset"))


def _fits(pos: Column) -> Column:
    start = pos - F.col("offset")
    return (start >= 0) & (start + F.col("span") <= F.col("n_words"))


def _found(start: Column) -> Column:
    """The words from ``start`` (0 is the first) are those of the phrase."""
    return ascii_lower(F.array_join(F.slice("words", start + 1, F.col("span")), " ")) \
        == F.col("phrase")


def _hits_by_broadcast(docs: DataFrame, small: DataFrame) -> DataFrame:
    """One pass: the prefix words meet the document words where these are read.
    The empty word makes a row of its own for every document."""
    words = docs.select("*", F.posexplode(F.concat(F.array(F.lit("")), "words")))
    words = words.withColumn("token", ascii_lower(F.col("col"))) \
        .withColumn("at", F.col("pos") - 1)
    met = words.join(small, (words["token"] == small["rare"]) & _fits(F.col("at")), "left")
    met = met.filter((F.col("token") == "") | F.col("rare").isNotNull())
    start = F.col("at") - F.col("offset")
    hit = F.when(F.col("rare").isNotNull() & _found(start), start)
    return met.select("doc_id", "row_key", "n_words", (F.col("token") == "").alias("is_row"),
                      hit.alias("start"), "span", "phrase") \
        .filter(F.col("is_row") | F.col("start").isNotNull())


def _hits_by_shuffle(docs: DataFrame, large: DataFrame) -> DataFrame:
    """For a benchmark too large to broadcast: words without their texts meet
    the prefix words in a shuffled join, and candidates go back to the texts."""
    words = docs.select("doc_id", "row_key", "n_words", F.posexplode("words").alias("at", "col")) \
        .withColumn("token", ascii_lower(F.col("col"))).drop("col")
    met = words.join(large, (words["token"] == large["rare"]) & _fits(F.col("at")))
    candidates = met.select(F.col("doc_id").alias("c_doc"), F.col("row_key").alias("c_key"),
                            (F.col("at") - F.col("offset")).alias("start"), "span",
                            "phrase").distinct()
    texts = docs.dropDuplicates(["doc_id", "row_key"])
    hits = candidates.join(texts, texts["doc_id"].eqNullSafe(candidates["c_doc"])
                           & (texts["row_key"] == candidates["c_key"])) \
        .filter(_found(F.col("start")))
    columns = ["doc_id", "row_key", "n_words", "is_row", "start", "span", "phrase"]
    rows = docs.select("doc_id", "row_key", "n_words", F.lit(True).alias("is_row"),
                       F.lit(None).cast("int").alias("start"),
                       F.lit(None).cast("int").alias("span"),
                       F.lit(None).cast("string").alias("phrase"))
    return rows.unionByName(hits.withColumn("is_row", F.lit(False)).select(*columns))


def _judged(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str,
            item_text: str, window: int, limit: int) -> DataFrame:
    """One row per (doc_id, hash of the text): n_words, rows, spans, items."""
    spark = docs.sparkSession
    windows = stored(spark, item_windows(items, item_id, item_text, window), "windows")
    ahead = stored(spark, prefixes(docs, windows, text, limit), "window-prefixes")
    ahead, small = sizes.hinted(ahead, limit)
    words = _doc_words(docs, doc_id, text)
    hits = _hits_by_broadcast(words, ahead) if small else _hits_by_shuffle(words, ahead)
    by_item, _ = sizes.hinted(windows.select(F.col("phrase").alias("of"), "item_id"), limit)
    hits = hits.join(by_item, hits["phrase"] == by_item["of"], "left")
    place = F.when(F.col("start").isNotNull(), F.struct("start", "span"))
    # A row stands for itself once, by its empty word; sets hold the hits.
    out = hits.groupBy("doc_id", "row_key", "n_words").agg(
        F.sum(F.when(F.col("is_row"), 1).otherwise(0)).alias("rows"),
        F.sort_array(F.collect_set(place)).alias("spans"),
        F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.col("item_id"))))
        .alias("items"))
    return out


def occurrences(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id",
                text: str = "text", item_id: str = "item_id", item_text: str = "text",
                window: int = WINDOW, limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (sorted structs of
    start and span, in words from 0), items (sorted ids as strings).

    Null texts have no words: such a document has no hit, such an item no
    window. A null item id is the empty string. Items repeated under one id
    count once; repeated document rows each give a row, with equal results;
    rows of one doc_id with different texts are judged apart. Other columns of
    either table, whatever their names, are not read. An item table without
    words marks nothing.
    """
    out = _judged(docs, items, doc_id, text, item_id, item_text, window, limit)
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).cast("long").alias("n_hit"), "spans", "items",
        F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("col")


def covered(spans: Column) -> Column:
    """Words under the union of spans that are sorted by their start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(state: Column, x: Column) -> Column:
        end = x["start"] + x["span"]
        new = F.greatest(end - F.greatest(state["end"], x["start"]), F.lit(0))
        return F.struct(F.greatest(state["end"], end).alias("end"),
                        (state["total"] + new).alias("total"))
    return F.aggregate(spans, begin, add, lambda s: s["total"])


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``occurrences`` as digest columns: n_items, items_sha256, contaminated."""
    return occurrences(docs, items, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
          limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """The documents, all their columns, in which no window occurs.

    Contaminated rows are found first, as (doc_id, hash of the text), and
    written; an anti-join takes them out, broadcast only if they are measured
    to be few. Nulls and repeated rows as in ``occurrences``.
    """
    found = _judged(docs, items, doc_id, text, item_id, item_text, window, limit) \
        .filter(F.size("spans") > 0).select(F.col("doc_id").alias("c_doc"),
                                            F.col("row_key").alias("c_key"))
    found, _ = sizes.hinted(stored(docs.sparkSession, found, "contaminated"), limit)
    return docs.join(found, docs["`" + doc_id + "`"].eqNullSafe(found["c_doc"])
                     & (F.xxhash64(docs["`" + text + "`"]) == found["c_key"]), "left_anti")
