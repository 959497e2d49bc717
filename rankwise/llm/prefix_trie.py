"""The trie of shared conversation beginnings, as a burst trie.

A node stands for the first d turns of some conversations. Shards hold containers
of suffixes under the heads of the trie: at first one container, under the root,
holds every distinct conversation. A container with more than ``CONTAINER_TURNS``
turns bursts: its node becomes a head, and its suffixes, less their next turn, go
to one new container for each id of that turn. So levels of heads are written,
until no container is too large. Every other container is then sorted and swept in
one task, which holds one at a time, into the nodes below it; what the nodes of a
subtree sum to goes up through the heads, level by level.

Turns are known by 128 bits of a digest of role and text, so texts never move. A
conversation is rows and not an array, and equal conversations are one suffix with
a count, so neither a long one nor one of many copies is held whole. A container
left with one suffix that is longer than the limit needs no sweep: its nodes are a
chain, made by window functions. Levels, and with them jobs, are as many as the
turns that an oversized group shares.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwise.llm.tables import stored
from rankwise.operators.ranking import rank_all
from rankwise.session import scratch_path

CONTAINER_TURNS = 50_000       # turns that one task sorts and sweeps at a time
FAMILY, BORROWED = 5, 9        # c takes crc32(c) % 9 turns from conversation c - c % 5
ID_BITS = 16                   # ids that differ in no higher bit are gathered together
RUN_BITS = 14                  # places of a chain summed together
ROWS_AT_ONCE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

SWEPT = ("conv long, depth long, parent_conv long, n_convs long, n_children long, "
         "n_leaves long, saved long, ends string, parent binary")
_TYPES = [*[pa.int64()] * 7, pa.string(), pa.binary()]
_NAMES = [c.split()[0] for c in SWEPT.split(", ")]


class _Levels:
    """A table in the shared folder, written level by level and read as a whole."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.schema = spark, scratch_path(spark, label), None

    def put(self, df: DataFrame, depth: int):
        self.schema = df.schema
        df.write.option("compression", "zstd").parquet(f"{self.root}/depth={depth}")

    def at(self, depth: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/depth={depth}") \
            .withColumn("depth", F.lit(depth).cast("long"))

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema.add("depth", "long")).parquet(self.root)


def _short_digest(whole: Column) -> Column:
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def turns(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, tid, n_bytes): turns in order, from 0; null role or text is empty."""
    who, said = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        _short_digest(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said))
        .alias("tid"), F.octet_length(said).alias("n_bytes")).filter("conv IS NOT NULL")
    placed = rank_all(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("tid").asc()], "place")
    return placed.select("conv", (F.col("place") - 1).alias("pos"), "tid", "n_bytes")


def rebuilt(placed: DataFrame, every: DataFrame) -> DataFrame:
    """Turns of every conversation c whose beginning is taken from c - c % 5: its
    first crc32(c) % 9 turns, or as many as it has, then c's own after as many."""
    family = every.select(
        "conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
        (F.crc32(F.col("conv").cast("string")) % BORROWED).cast("int").alias("h"))
    first = placed.filter(F.col("pos") < BORROWED - 1)
    lengths = first.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    family = family.join(lengths, "base", "left") \
        .withColumn("taken", F.least("h", F.coalesce("n", F.lit(0))).cast("int"))
    begin = first.withColumnRenamed("conv", "base").join(family, "base") \
        .filter("pos < h").select("conv", "pos", "tid", "n_bytes")
    own = placed.join(family, "conv").filter("pos >= h") \
        .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tid", "n_bytes")
    return begin.union(own)


def _digested(batches: Iterator[pa.RecordBatch]):
    """(len, a, b, first, n, ids), by conversation text and id range, to one row per
    distinct conversation: (rep, w, len, ends)."""
    key, now, rows = None, None, []

    def close():
        rep, w, sha = now
        rows.append((rep, w, key[0], sha.hexdigest()))

    def batch():
        out = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                              [*[pa.int64()] * 3, pa.string()], strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(out, names=["rep", "w", "len", "ends"])
    for b in batches:
        for start in range(0, b.num_rows, 64):
            for length, x, y, first, n, ids in zip(
                    *(c.to_pylist() for c in b.slice(start, 64).columns), strict=True):
                if (length, x, y) != key:
                    if now:
                        close()
                        if len(rows) >= ROWS_AT_ONCE:
                            yield batch()
                    key, now = (length, x, y), [first, 0, hashlib.sha256()]
                else:
                    now[2].update(b",")
                now[1] += n
                now[2].update(ids.encode())
    if now:
        close()
        yield batch()


def distinct_conversations(rows: DataFrame, every: DataFrame) -> DataFrame:
    """(rep, w, len, ends): distinct conversations with their least id, the number
    and the digest of all their ids. Ids are sorted and written down by ranges of
    2^16, so that one row of a conversation with many copies stands for as many."""
    # Sums of hashes of (place, turn): the same for equal conversations alone.
    prints = rows.groupBy("conv").agg(
        F.count(F.lit(1)).alias("len"), F.bit_xor(F.xxhash64("pos", "tid")).alias("a"),
        F.bit_xor(F.xxhash64("tid", F.lit("second"), "pos")).alias("b"))
    told = every.join(prints, "conv", "left").fillna(0, ["len", "a", "b"])
    ranges = told.groupBy("len", "a", "b", F.shiftright("conv", ID_BITS).alias("range")).agg(
        F.min("conv").alias("first"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
    keys = ["len", "a", "b"]
    return ranges.repartition(*keys).sortWithinPartitions(*keys, "range") \
        .select(*keys, "first", "n", "ids") \
        .mapInArrow(_digested, "rep long, w long, len long, ends string")


def sweep(suffixes: list[tuple], depth: int, parent, parent_conv, top_bytes: int) -> list[tuple]:
    """The nodes of a container from its distinct suffixes, (turn ids, their bytes,
    rep, w, ends): sorted, every suffix shares a stack of open nodes with the one
    before it. A node is closed when a suffix leaves it."""
    suffixes.sort(key=lambda x: x[0])
    # conv, above, n_convs, n_children, n_leaves, saved, ends, bytes of the last text
    nodes = [[suffixes[0][2], None, 0, 0, 0, 0, NO_ENDS, top_bytes]]
    stack, before = [0], []

    def close():
        me = nodes[stack.pop()]
        me[4] = me[4] or 1
        me[5] += (me[2] - 1) * me[7]
        if stack:
            up = nodes[stack[-1]]
            up[0] = min(up[0], me[0])
            up[2] += me[2]
            up[3] += 1
            up[4] += me[4]
            up[5] += me[5]
    depths = [depth]
    for ids, sizes, rep, w, ends in suffixes:
        shared = 0
        for x, y in zip(ids, before):
            if x != y:
                break
            shared += 1
        while len(stack) > shared + 1:
            close()
        for size in sizes[shared:]:
            nodes.append([rep, stack[-1], 0, 0, 0, 0, NO_ENDS, size])
            depths.append(depth + len(stack))
            stack.append(len(nodes) - 1)
        me = nodes[stack[-1]]
        me[0], me[2], me[6] = min(me[0], rep), me[2] + w, ends
        before = ids
    while stack:
        close()
    return [(n[0], d, parent_conv if n[1] is None else nodes[n[1]][0], n[2], n[3], n[4], n[5], n[6],
             parent if n[1] is None else None) for n, d in zip(nodes, depths, strict=True)]


def _swept(batches: Iterator[pa.RecordBatch]):
    """Rows of containers, by node, suffix and place, to nodes. A suffix ends with a
    row that has its count; the other rows are its turns."""
    node, suffixes, ids, sizes, rows, top = None, [], [], [], [], None

    def batch():
        out = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(out, names=_NAMES)
    for b in batches:
        for at, rep, tid, n_bytes, w, ends, depth, parent, parent_conv in zip(
                *(c.to_pylist() for c in b.columns), strict=True):
            if at != node:
                if suffixes:
                    rows += sweep(suffixes, *top)
                    suffixes = []
                    if len(rows) >= ROWS_AT_ONCE:
                        yield batch()
                node = at
            if w is None:
                ids.append(tid)
                sizes.append(n_bytes)
            else:
                suffixes.append((ids, sizes, rep, w, ends))
                top = depth, parent, parent_conv, n_bytes
                ids, sizes = [], []
    if suffixes:
        rows += sweep(suffixes, *top)
        yield batch()


def _chains(members: DataFrame, body: DataFrame) -> DataFrame:
    """Nodes of containers with one long suffix: a chain, one node a turn."""
    m = members.withColumnRenamed("n_bytes", "top_bytes")
    below = body.join(m, "rep").filter(F.col("pos") >= F.col("depth")) \
        .withColumn("is_top", F.lit(False))
    top = m.withColumn("pos", (F.col("depth") - 1).cast("int")) \
        .withColumn("n_bytes", F.col("top_bytes")).withColumn("is_top", F.lit(True))
    keep = ["rep", "pos", "n_bytes", "w", "len", "ends", "parent", "parent_conv", "is_top"]
    rows = below.select(keep).union(top.select(keep)) \
        .withColumn("run", F.shiftright("pos", RUN_BITS))
    later = Window.partitionBy("rep").orderBy("run").rowsBetween(1, Window.unboundedFollowing)
    runs = rows.groupBy("rep", "run").agg(F.sum("n_bytes").alias("after")) \
        .withColumn("after", F.coalesce(F.sum("after").over(later), F.lit(0)))
    inside = Window.partitionBy("rep", "run").orderBy("pos") \
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.sum("n_bytes").over(inside) + F.col("after")
    depth = (F.col("pos") + 1).cast("long")
    last = depth == F.col("len")
    return rows.join(runs, ["rep", "run"]).select(
        F.col("rep").alias("conv"), depth.alias("depth"),
        F.when(F.col("is_top"), F.col("parent_conv")).otherwise(F.col("rep")).alias("parent_conv"),
        F.col("w").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("w") - 1) * rest).alias("saved"),
        F.when(last, F.col("ends")).otherwise(NO_ENDS).alias("ends"),
        F.when(F.col("is_top"), F.col("parent")).alias("parent"))


def trie(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
         role: str = "role", text: str = "text",
         container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``): one row per node,
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (long) and ends_sha256.

    Turns are ordered by ``turn``, null first, and turns of one number by the digest
    of role and text; repeated rows are as many turns. A null role or text is empty.
    Rows without an id are of no conversation and give no node. Columns beside the
    four are not read. An empty table has no conversation, and so not even a root.
    """
    every = conversations.select(F.col(f"`{conv_id}`").cast("long").alias("conv")) \
        .filter("conv IS NOT NULL").distinct()
    spark = conversations.sparkSession
    placed = stored(spark, turns(conversations, conv_id=conv_id, turn=turn, role=role, text=text),
                    "trie-turns")
    return prefix_nodes(stored(spark, rebuilt(placed, every), "trie-rebuilt"), every,
                        container_turns)


def prefix_nodes(rows: DataFrame, every: DataFrame, container_turns: int) -> DataFrame:
    """The trie of conversations given as (conv, pos, tid, n_bytes) and their ids."""
    spark = rows.sparkSession
    seqs = stored(spark, distinct_conversations(rows, every), "trie-distinct")
    # Sorted by place, so that a level reads little of it.
    body = stored(spark, rows.join(seqs.select("rep"), rows["conv"] == F.col("rep"))
                  .select("rep", "pos", "tid", "n_bytes").sortWithinPartitions("pos"), "trie-body")
    nothing = F.lit(None)
    members = seqs.select("rep", "w", "len", "ends", F.lit(b"").alias("node"),
                          nothing.cast("binary").alias("parent"),
                          nothing.cast("long").alias("parent_conv"), F.lit(0).alias("n_bytes"))
    frozen, heads, depth = _Levels(spark, "trie-frozen"), _Levels(spark, "trie-heads"), 0
    while True:
        members = stored(spark, members, "trie-members")
        ends_here = F.when(F.col("len") == depth, F.col("ends"))
        boxes = stored(spark, members.groupBy("node").agg(
            F.min("rep").alias("conv"), F.sum("w").alias("n_convs"),
            F.count(F.lit(1)).alias("n_suffixes"), F.sum(F.col("len") - depth).alias("n_turns"),
            F.coalesce(F.max(ends_here), F.lit(NO_ENDS)).alias("ends"),
            F.first("parent").alias("parent"), F.first("parent_conv").alias("parent_conv"),
            F.first("n_bytes").alias("n_bytes")), "trie-boxes")
        large = F.col("n_turns") > container_turns
        bursts = boxes.filter(large & (F.col("n_suffixes") > 1))
        told = members.join(boxes.select(
            F.col("node").alias("of"), F.col("conv"), (large & (F.col("n_suffixes") > 1)).alias("burst"),
            (large & (F.col("n_suffixes") == 1)).alias("chain")).hint("merge"),
            F.col("node") == F.col("of")).drop("of")
        frozen.put(told.filter(~F.col("burst")).drop("burst", "conv"), depth)
        if bursts.isEmpty():
            break
        heads.put(bursts, depth)
        turn = body.filter(F.col("pos") == depth).select("rep", "tid", F.col("n_bytes").alias("size"))
        members = told.filter(F.col("burst") & (F.col("len") > depth)).join(turn.hint("merge"), "rep") \
            .select("rep", "w", "len", "ends",
                    _short_digest(F.concat(F.hex("node"), F.hex("tid"))).alias("node"),
                    F.col("node").alias("parent"), F.col("conv").alias("parent_conv"),
                    F.col("size").alias("n_bytes"))
        depth += 1
    still = frozen.all()
    nodes = stored(spark, _sweeps(still.filter(~F.col("chain")), body), "trie-swept")
    chains = still.filter("chain")
    if not chains.isEmpty():
        nodes = nodes.union(stored(spark, _chains(chains, body), "trie-chains"))
    done = _Levels(spark, "trie-done")
    for level in range(depth - 1, -1, -1):
        below = nodes.filter(F.col("parent").isNotNull() & (F.col("depth") == level + 1))
        if level + 1 < depth:
            below = below.select(_NAMES).union(done.at(level + 1).select(_NAMES))
        sums = below.groupBy(F.col("parent").alias("of")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved").alias("below"))
        own = (F.col("n_convs") - 1) * F.col("n_bytes")
        done.put(heads.at(level).join(sums, F.col("node") == F.col("of")).select(
            "conv", "parent_conv", "n_convs", "n_children", "n_leaves",
            (F.col("below") + own).alias("saved"), "ends", "parent"), level)
    if depth:
        nodes = nodes.select(_NAMES).union(done.all().select(_NAMES))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))


def _sweeps(members: DataFrame, body: DataFrame) -> DataFrame:
    """Containers dealt to tasks by their node, their suffixes' turns in order."""
    nothing = F.lit(None)
    m = members.select("node", "rep", "w", "len", "ends", "depth", "parent", "parent_conv", "n_bytes")
    said = body.join(m.select("node", "rep", "depth").hint("merge"), "rep") \
        .filter(F.col("pos") >= F.col("depth")).select(
            "node", "rep", "pos", "tid", "n_bytes", nothing.cast("long").alias("w"),
            nothing.cast("string").alias("ends"), nothing.cast("long").alias("depth"),
            nothing.cast("binary").alias("parent"), nothing.cast("long").alias("parent_conv"))
    ended = m.select("node", "rep", F.col("len").cast("int").alias("pos"),
                     nothing.cast("binary").alias("tid"), "n_bytes", "w", "ends", "depth", "parent",
                     "parent_conv")
    return said.union(ended).repartition("node").sortWithinPartitions("node", "rep", "pos") \
        .drop("pos").mapInArrow(_swept, SWEPT)
