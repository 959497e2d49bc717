"""Language-model scoring: a weighted backoff automaton over smoothed bigrams.

States are histories: the start of a text, every training token, and the empty
history at the root. A state has an arc for each token seen after it, weighted

    log10((c(h, w) + PRIOR * p(w)) / (c(h) + PRIOR)),   p(w) = (c(w)+1) / (N+V+1)

and a failure arc to the root, weighted log10(PRIOR / (c(h) + PRIOR)); the root
has the arcs log10 p(w), unknown tokens included. These are the Dirichlet-prior
bigrams, so the weights of a state sum to one. A text is scored by one
left-to-right traversal that carries its state and adds up the weights.

The counts of the whole training part would be too large for a task, so the
automaton is never held whole. Texts are written once as *blocks* of about
``BLOCK_TOKENS`` tokens, and each block is traversed with the part of the
automaton that it can reach: the counts of its own distinct tokens and bigrams.
To get them, a block sends hashes of these with their training counts to
``shards``, ranges of the hashes; a shard sums what all blocks sent and answers
with the totals in the order in which the hashes came. So a frequent token or
bigram costs one key per block and never one per occurrence. Tokens are told
apart by 64 bits. Bigrams are by their shard and 48 bits: with a million keys a
shard, however many shards there are, one bigram in 10^8 shares a count.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankwise.llm.tables import stored
from rankwise.llm.text import named


FOLDS, HELD_OUT = 7, 2      # crc32(id as text) mod 7 = 2 is held out
PRIOR = 300.0
BLOCK_TOKENS = 1_000_000
SHARD_KEYS = 1_000_000      # keys that a shard gets, about
ROWS_AT_ONCE = 256
# No word holds white space, so these two cannot be words.
END, START = b"\n", b"\t"
U64 = np.uint64
PAIR_BYTES = 6


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased, without the end token: ``lower``
    and ``split`` of bytes know ASCII letters and white space alone."""
    return (text or b"").lower().split()


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit hashes of bigrams, given hashes of their tokens."""
    x = first * U64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


class _Block:
    """Texts under construction: their ids, folds, lengths and token numbers."""

    def __init__(self):
        self.number = {START: 0, END: 1}
        self.ids, self.held, self.lengths, self.at = [], [], [], []

    def add(self, doc_id, held, text):
        number = self.number
        # Every token gets the number of its first appearance in the block.
        at = [number.setdefault(w, len(number)) for w in tokens(text)]
        at.append(1)
        self.ids.append(doc_id)
        self.held.append(held)
        self.lengths.append(len(at))
        self.at += at

    def rows(self, block_id: int, id_type: pa.DataType) -> pa.RecordBatch:
        at = np.array(self.at, np.int32)
        # Frequent tokens get small numbers: these compress well.
        counts = np.bincount(at, minlength=len(self.number))
        order = np.concatenate([[0, 1], 2 + np.argsort(-counts[2:], kind="stable")])
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words = list(self.number)
        training = sum(n for n, h in zip(self.lengths, self.held, strict=True) if not h)
        pack = zstandard.ZstdCompressor(level=3).compress
        return pa.RecordBatch.from_arrays(
            [pa.array([block_id], pa.int64()), pa.array([len(at)], pa.int64()),
             pa.array([training], pa.int64()), pa.array([self.ids], pa.list_(id_type)),
             pa.array([self.held], pa.list_(pa.bool_())),
             pa.array([self.lengths], pa.list_(pa.int32())),
             pa.array([pack(rank[at].tobytes())], pa.binary()),
             pa.array([pack(b"\n".join(words[i] for i in order[2:]))], pa.binary())],
            names=["block", "tokens", "training", "ids", "held", "lengths", "at", "words"])


def _blocks(batches: Iterator[pa.RecordBatch], id_type: pa.DataType, size: int):
    """(id, held, text) to blocks; the blocks of a task are numbered after its partition."""
    base, made, now = TaskContext.get().partitionId() << 32, 0, _Block()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            for row in zip(*(part.column(c).to_pylist() for c in ("id", "held", "text")),
                           strict=True):
                now.add(*row)
                if len(now.at) >= size:
                    yield now.rows(base + made, id_type)
                    made, now = made + 1, _Block()
    if now.ids:
        yield now.rows(base + made, id_type)


class _Keys:
    """What a block asks for: its tokens and bigrams, in the order of their hashes."""

    def __init__(self, row: dict):
        unpack = zstandard.ZstdDecompressor().decompress
        self.at = np.frombuffer(unpack(row["at"]), np.int32).astype(np.int64)
        words = unpack(row["words"])
        hashes = word_hashes([START, END, *(words.split(b"\n") if words else [])])
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        held = np.asarray(row["held"], bool)
        training = np.repeat(~held, self.lengths)
        self.word_order = np.argsort(hashes, kind="stable")
        self.words = hashes[self.word_order]
        counts = np.bincount(self.at[training], minlength=len(hashes))
        counts[0] = (~held).sum()          # texts begin once
        self.word_counts = counts[self.word_order]
        # Equal pairs of token numbers first: most pairs of a block repeat in it.
        self.before = np.empty_like(self.at)
        self.before[1:] = self.at[:-1]
        self.before[self.starts] = 0
        distinct, place = np.unique(self.before * len(hashes) + self.at, return_inverse=True)
        self.ends = distinct // len(hashes), distinct % len(hashes)
        keys = bigram_keys(hashes[self.ends[0]], hashes[self.ends[1]])
        self.pair_order = np.argsort(keys, kind="stable")
        self.pairs = keys[self.pair_order]
        self.pair_counts = np.bincount(place[training], minlength=len(keys))[self.pair_order]


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin: shards are equal ranges of the keys."""
    step = ((1 << 64) - 1) // shards
    return np.append(np.searchsorted(keys, np.arange(shards, dtype=U64) * U64(step)), len(keys))


def _low_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES].tobytes()


def _from_low_bytes(data: bytes) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(-1, PAIR_BYTES)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :PAIR_BYTES] = part
    return out.reshape(-1).view(U64)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (r for batch in batches for i in range(batch.num_rows)
            for r in batch.slice(i, 1).to_pylist())


def _requests(batches: Iterator[pa.RecordBatch], shards: int):
    """Blocks to (block, shard, words, word_counts, pairs, pair_counts)."""
    for row in _one_by_one(batches):
        k = _Keys(row)
        words, pairs = _cuts(k.words, shards), _cuts(k.pairs, shards)
        spans = [(s, slice(*words[s:s + 2]), slice(*pairs[s:s + 2])) for s in range(shards)]

        def counts(all_counts, part):
            return all_counts[part].astype(np.int32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["block"]] * shards, pa.int64()), pa.array(range(shards), pa.int64()),
             pa.array([k.words[w].tobytes() for _, w, _ in spans], pa.binary()),
             pa.array([counts(k.word_counts, w) for _, w, _ in spans], pa.binary()),
             pa.array([_low_bytes(k.pairs[p]) for _, _, p in spans], pa.binary()),
             pa.array([counts(k.pair_counts, p) for _, _, p in spans], pa.binary())],
            names=["block", "shard", "words", "word_counts", "pairs", "pair_counts"])


def _summed(keys: list[np.ndarray], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
    """Distinct keys, their sums, and the sums in the order of each part's keys."""
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    flat = np.concatenate([np.frombuffer(c, np.int32) for c in counts])
    total = np.bincount(place, weights=flat, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    return distinct, total, [total[p].tobytes() for p in np.split(place, ends[:-1])]


def _totals(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: for each block the training totals of the keys it sent; the
    first row also has the number of distinct training tokens of the shard."""
    words, total, word_totals = _summed([np.frombuffer(k, U64) for k in pdf["words"]],
                                        list(pdf["word_counts"]))
    known = int(((total > 0) & (words != word_hashes([START])[0])).sum())
    _, _, pair_totals = _summed([_from_low_bytes(k) for k in pdf["pairs"]],
                                list(pdf["pair_counts"]))
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "shard": pdf["shard"].to_numpy(),
                         "words": word_totals, "pairs": pair_totals,
                         "distinct": [known] + [0] * (len(pdf) - 1)})


def traverse(at: list[int], lengths: list[int], arcs: dict[int, float], fail: list[float],
             root: list[float]) -> list[float]:
    """Scores of texts. ``at`` are token numbers, texts end to end; state 0 is the
    start of a text, and reading token ``w`` leads to state ``w``. ``arcs`` finds
    the weight of (state, token) under ``state * len(root) + token``."""
    out, here, size = [], 0, len(root)
    for length in lengths:
        state, score = 0, 0.0
        for w in at[here:here + length]:
            weight = arcs.get(state * size + w)
            # No arc: the failure arc leads to the root, which has one for any token.
            score += fail[state] + root[w] if weight is None else weight
            state = w
        out.append(score)
        here += length
    return out


def _scored(batches: Iterator[pa.RecordBatch], total: int, distinct: int, prior: float,
            id_type: pa.DataType):
    """Blocks with the totals of their tokens and bigrams to one row per text."""
    for row in _one_by_one(batches):
        k = _Keys(row)
        known = np.empty(len(k.words), np.int64)
        known[k.word_order] = np.concatenate(
            [np.frombuffer(x["words"], np.int64) for x in row["answers"]])
        seen = np.concatenate([np.frombuffer(x["pairs"], np.int64) for x in row["answers"]])
        lower = np.log10((known + 1) / (total + distinct + 1))
        fail = np.log10(prior / (known + prior))
        # Arcs of the states that this block can be in, for tokens it has.
        there = k.pair_order[seen > 0]
        h, w = k.ends[0][there], k.ends[1][there]
        weight = np.log10((seen[seen > 0] + prior * 10.0 ** lower[w]) / (known[h] + prior))
        arcs = dict(zip((h * len(known) + w).tolist(), weight.tolist(), strict=True))
        scores = traverse(k.at.tolist(), k.lengths.tolist(), arcs, fail.tolist(), lower.tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], id_type), pa.array(row["held"], pa.bool_()),
             pa.array(k.lengths, pa.int64()),
             pa.array(np.add.reduceat(known[k.at] > 0, k.starts, dtype=np.int64)),
             pa.array(np.full(len(k.lengths), total, np.int64)),
             pa.array(np.add.reduceat(lower[k.at], k.starts)), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                   "base_score", "score"])


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", prior: float = PRIOR,
          block_tokens: int = BLOCK_TOKENS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens (long),
    base_score and score (log10 probabilities).

    Learns from all documents whose crc32(id as text) mod 7 is not 2 and scores
    every document. A null text is empty and has the end token alone; a null id
    counts as the empty text. Repeated rows and ids count and are scored as often
    as they stand there. An id may have any type that casts to text. Other columns are
    not read. Without a training document
    every token is unknown. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(named(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select(named(doc_id).alias("id"), (fold == HELD_OUT).alias("held"),
                       named(text).cast("binary").alias("text"))
    ids = rows.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["id"].dataType)
    blocks = stored(spark, rows.mapInArrow(
        lambda batches: _blocks(batches, id_type, block_tokens),
        f"block long, tokens long, training long, ids array<{ids}>, held array<boolean>, "
        "lengths array<int>, at binary, words binary"), "lm-blocks")
    amount, total = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)),
                               F.coalesce(F.sum("training"), F.lit(0))).first()
    shards = max(1, math.ceil(amount / shard_keys))
    asked = blocks.select("block", "held", "lengths", "at", "words").mapInArrow(
        lambda batches: _requests(batches, shards),
        "block long, shard long, words binary, word_counts binary, pairs binary, "
        "pair_counts binary")
    answers = stored(spark, asked.groupBy("shard").applyInPandas(
        _totals, "block long, shard long, words binary, pairs binary, distinct long"), "lm-totals")
    distinct = answers.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    told = answers.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("shard", "words", "pairs"))).alias("answers"))
    whole = blocks.select("block", "ids", "held", "lengths", "at", "words").join(told, "block")
    return whole.mapInArrow(
        lambda batches: _scored(batches, total, distinct, prior, id_type),
        f"doc_id {ids}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
