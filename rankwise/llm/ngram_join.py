"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A document is the set of its shingles of ``SHINGLE`` consecutive words. Documents
with the same set are one text, found by a digest of the set; everything after
that is about different texts.

Each of ``TREES`` trees of the forest orders texts by a sequence of minima
(MinHash), so texts under one prefix are a subtrie. Prefixes are as long as
they can be: from ``LONGEST`` they are shortened, one minimum at a time, until a
pair exactly at the threshold shares a prefix in some tree with the target
recall. Texts of one subtrie are linked to its first text, never to each other,
and the connected components of these links are the candidates: a pair that
shares any subtrie is in one component.

Verification is exact and whole: a text's shingles go to its component once, and
all pairs of a component are compared there. A large component is cut into
blocks, and each pair of blocks is a unit of work of its own, so no unit holds
more than two blocks whatever the size of a group of near copies. A unit returns
one row per text: its number of links and the first text it is connected to
there. Components of these are the classes.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.components import connected
from rankwise.llm.tables import stored
from rankwise.llm.text import named

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
LONGEST = 10
RECALL = 0.999
BLOCK_TEXTS = 1024          # texts of a block, and
BLOCK_SHINGLES = 2_000_000  # shingles of a block, on average
ROWS_AT_ONCE = 64           # texts that a Python task holds as objects
COLUMNS_AT_ONCE = 8192
U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)


def prefix_length(threshold: float, trees: int, recall: float, longest: int = LONGEST) -> int:
    """The longest prefix with which a pair at the threshold shares a prefix in
    one of the trees with a probability of ``recall``; 1 at least."""
    length = longest
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    Words are lower-cased runs of anything but white space. A text of fewer
    words, but not none, has one shingle: all of it.
    """
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, U64)
    for k in range(width):
        out = out * MULTIPLIER + hashes[k:len(words) - width + 1 + k]
    return np.unique(_mix(out))


def _parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = _mix(np.arange(1, 2 * count + 1, dtype=U64) * MULTIPLIER)
    return base[:count, None] | U64(1), base[count:, None]


def prefix_keys(found: np.ndarray, trees: int, length: int) -> np.ndarray:
    """One 64-bit key per tree: its first ``length`` minima."""
    times, plus = _parameters(trees * length)
    least = np.full(trees * length, ~U64(0), U64)
    for at in range(0, len(found), 4096):
        part = found[None, at:at + 4096] * times + plus
        np.minimum(least, _mix_rows(part).min(axis=1), out=least)
    keys = np.zeros(trees, U64)
    for column in least.reshape(trees, length).T:
        keys = _mix(keys * MULTIPLIER + column)
    return keys.view(np.int64)


def _mix_rows(x: np.ndarray) -> np.ndarray:
    """High bits are the good ones of a product: fold them down."""
    return x ^ (x >> U64(32))


def _signed(batches: Iterator[pa.RecordBatch], trees: int, length: int):
    """(id, row_key, text) to (id, row_key, node, size, keys)."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            nodes, counts, keys = [], [], []
            for text in part.column("text").to_pylist():
                found = shingles(text)
                nodes.append(digest(found) if len(found) else None)
                counts.append(len(found))
                keys.append(prefix_keys(found, trees, length) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("row_key"), pa.array(nodes, pa.binary()),
                 pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "row_key", "node", "size", "keys"])


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _shingled(batches: Iterator[pa.RecordBatch]):
    """(node, text) to (node, shingles)."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            found = [shingles(t).view(np.int64) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(found, pa.list_(pa.int64()))],
                names=["node", "shingles"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left set with every right set, as
    products of 0/1 matrices over the shingles that occur on both sides."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.int64)

    def cells(sets):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(both, flat)
        at[at == len(both)] = 0
        hit = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]
    (row_a, at_a), (row_b, at_b) = cells(left), cells(right)
    for start in range(0, len(both), COLUMNS_AT_ONCE):
        width = min(COLUMNS_AT_ONCE, len(both) - start)
        sides = []
        for n, row, at in ((len(left), row_a, at_a), (len(right), row_b, at_b)):
            low, high = np.searchsorted(at, [start, start + width])
            m = np.zeros((n, width), np.float32)
            m[row[low:high], at[low:high] - start] = 1
            sides.append(m)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of the threshold or more, exactly."""
    t = Fraction(str(threshold))
    common = common_counts(left, right)
    union = np.array([len(s) for s in left])[:, None] \
        + np.array([len(s) for s in right])[None, :] - common
    return common * t.denominator >= union * t.numerator


def _first_reached(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric relation, the least row of its component."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One unit: whole small components, or a pair of blocks of a large one."""
    out = []
    for _, group in pdf.groupby("comp", sort=False):
        group = group.drop_duplicates("node").sort_values(["side", "node"])
        nodes, side = group["node"].tolist(), group["side"].to_numpy()
        sets = [np.asarray(s, np.int64) for s in group["shingles"]]
        n_left = int((side == 0).sum())
        if not group["cross"].iloc[0]:
            links = linked(sets, sets, threshold)
            np.fill_diagonal(links, False)
        elif n_left in (0, len(sets)):
            continue               # no text has hashed to the other block
        else:
            links = np.zeros((len(sets), len(sets)), bool)
            cross = linked(sets[:n_left], sets[n_left:], threshold)
            links[:n_left, n_left:] = cross
            links[n_left:, :n_left] = cross.T
        first = _first_reached(links)
        out += [(nodes[i], int(n), nodes[first[i]])
                for i, n in enumerate(links.sum(axis=1)) if n]
    return pd.DataFrame(out, columns=["node", "links", "first"])


def _candidates(texts: DataFrame, limit: int) -> DataFrame:
    """(node, comp): texts that share a subtrie with another, by component."""
    spark = texts.sparkSession
    leaves = texts.select("node", F.posexplode("keys").alias("tree", "key"))
    subtries = leaves.groupBy("tree", "key").agg(F.min("node").alias("first"),
                                                 F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    subtries, _ = sizes.hinted(stored(spark, subtries, "subtries"), limit)
    edges = leaves.join(subtries, ["tree", "key"]).filter(F.col("node") != F.col("first")) \
        .select(F.col("node").alias("u"), F.col("first").alias("v")).distinct()
    return connected(edges, "candidates")


def _units(members: DataFrame, block_texts: int, block_shingles: int) -> DataFrame:
    """(node, comp, unit, side, cross): every pair of texts of a component meets in
    exactly one unit, one of two blocks if ``cross``, though one of these may be
    empty. Components of one block share units by hash."""
    sized = members.groupBy("comp").agg(F.count(F.lit(1)).alias("texts"),
                                        F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("texts") / block_texts),
                        F.ceil(F.col("total") / block_shingles), F.lit(1))
    sized = sized.withColumn("blocks", F.least(blocks, F.col("texts")).cast("int"))
    total = sized.filter("blocks = 1").agg(
        F.coalesce(F.sum("texts"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    shared = max(1, -(-total[0] // block_texts), -(-total[1] // block_shingles))
    out = members.join(sized.select("comp", "blocks"), "comp") \
        .withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    low, high = (F.least("b", "other"), F.greatest("b", "other"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.when(F.col("blocks") == 1, F.concat(F.lit("u"), F.pmod(F.xxhash64("comp"), shared))) \
        .otherwise(F.concat_ws("-", F.hex("comp"), low, high))
    return out.select("node", "comp", unit.alias("unit"),
                      F.when(F.col("b") > F.col("other"), 1).otherwise(0).alias("side"),
                      (F.col("b") != F.col("other")).alias("cross"))


def _verified(spark: SparkSession, docs: DataFrame, texts: DataFrame, comps: DataFrame,
              threshold: float, block_texts: int, block_shingles: int,
              limit: int) -> DataFrame:
    """(node, links, first) as units give them."""
    members = stored(spark, texts.join(comps, "node").select("node", "comp", "size", "rep"),
                      "candidate-texts")
    units = stored(spark, _units(members, block_texts, block_shingles), "verify-units")
    wanted, _ = sizes.hinted(members.select("node", "rep"), limit)
    found = docs.join(wanted, docs["row_key"].eqNullSafe(wanted["rep"]["key"])
                      & docs["id"].eqNullSafe(wanted["rep"]["id"])).select("node", "text")
    found = stored(spark, found.mapInArrow(_shingled, "node binary, shingles array<long>"),
                    "candidate-shingles")
    return found.join(units, "node").groupBy("unit").applyInPandas(
        lambda pdf: _verify(pdf, threshold), "node binary, links long, first binary")


def _classed(docs: DataFrame, doc_id: str, text: str, threshold: float, trees: int,
             recall: float, block_texts: int, block_shingles: int,
             limit: int) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, row_key, node), and per text that is not alone (node,
    n_links, n_copies, first: struct of id and key of its class's first row)."""
    spark = docs.sparkSession
    length = prefix_length(threshold, trees, recall)
    rows = docs.select(named(doc_id).alias("id"), F.xxhash64(named(text)).alias("row_key"),
                       named(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = stored(spark, rows.mapInArrow(
        lambda batches: _signed(batches, trees, length),
        f"id {id_type}, row_key long, node binary, size long, keys array<long>"), "signatures")
    texts = signed.filter("node is not null").groupBy("node").agg(
        F.min(F.struct("id", F.col("row_key").alias("key"))).alias("rep"),
        F.first("size").alias("size"), F.first("keys").alias("keys"),
        F.count(F.lit(1)).alias("rows"))
    texts = stored(spark, texts, "texts")
    comps = _candidates(texts, limit)
    links = stored(spark, _verified(spark, rows, texts, comps, threshold, block_texts,
                                     block_shingles, limit), "links")
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = connected(links.filter(F.col("node") != F.col("first"))
                        .select(F.col("node").alias("u"), F.col("first").alias("v")), "classes")
    known = texts.select("node", "rep", "rows").join(classes, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    firsts = known.groupBy("comp").agg(F.min("rep").alias("first"))
    known = known.join(counts, "node", "left").join(firsts, "comp") \
        .filter((F.col("rows") > 1) | F.col("n_links").isNotNull()) \
        .select("node", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                (F.col("rows") - 1).alias("n_copies"), "first")
    return signed.select("id", "row_key", "node"), stored(spark, known, "text-classes")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL,
            block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES,
            limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class), n_links
    (other texts within the threshold) and n_copies (other rows of its text).

    A class is a connected component of links. A null or blank text has no
    shingles: it is a class of its own, with its own id. Rows of one doc_id with
    different texts are different documents; a repeated row is a copy. A null
    id counts as the least. Other columns are not read. An empty table gives an
    empty result.
    """
    rows, known = _classed(docs, doc_id, text, threshold, trees, recall, block_texts,
                           block_shingles, limit)
    known, _ = sizes.hinted(known, limit)
    out = rows.join(known, "node", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"))


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL,
               block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES,
               limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """One row of each class with all its columns, that of the least id (of equal
    ids, the least hash of the text; of repeated rows, any). Nulls as in
    ``classes``; texts without words all stay."""
    spark = docs.sparkSession
    rows, known = _classed(docs, doc_id, text, threshold, trees, recall, block_texts,
                           block_shingles, limit)
    met = rows.join(sizes.hinted(known.select("node", "first"), limit)[0], "node")
    others = met.filter(~(F.col("first.id").eqNullSafe(F.col("id"))
                          & F.col("first.key").eqNullSafe(F.col("row_key")))) \
        .select(F.col("id").alias("o_id"), F.col("row_key").alias("o_key")).distinct()
    others, _ = sizes.hinted(stored(spark, others, "other-rows"), limit)
    again = rows.filter("node is not null").groupBy("id", "row_key").count() \
        .filter("count > 1").select(F.col("id").alias("a_id"), F.col("row_key").alias("a_key"))
    again, _ = sizes.hinted(stored(spark, again, "repeated-rows"), limit)
    key = F.xxhash64(docs["`" + text + "`"])

    def same(other, i, k):
        return docs["`" + doc_id + "`"].eqNullSafe(other[i]) & key.eqNullSafe(other[k])
    kept = docs.join(others, same(others, "o_id", "o_key"), "left_anti")
    once = kept.join(again, same(again, "a_id", "a_key"), "left_anti")
    # Repeated rows of a class's first: one of each, without moving other texts.
    repeated = kept.join(again, same(again, "a_id", "a_key"), "left_semi")
    return once.unionByName(repeated.dropDuplicates([doc_id, text]))
