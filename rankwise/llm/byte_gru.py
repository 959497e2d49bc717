"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into windows of ``WINDOW`` bytes. One recurrent layer reads a window
from the left, another from the right; at every byte both states together give
probabilities of the languages, and a text's probabilities are the mean over all
its bytes. With x the byte and h the state, a layer does

    r, z = sigmoid(E_r[x] + U_r h), sigmoid(E_z[x] + U_z h)
    n    = tanh(E_n[x] + r * (U_n h + b));     h = z * h + (1 - z) * n

The network is trained on the driver, in numpy, by backpropagation through time
over a bounded sample (``SAMPLE_TEXTS`` texts, at most ``SAMPLE_CHARS`` characters
of each, cut at a place that the text's hash chooses). It has some 13,000
weights, which go to the tasks with the code. Tasks label texts in
Arrow batches, ``BATCH`` windows at a time, so a long text only means more windows.

States are kept as (units, windows): every gate is then one contiguous block.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2       # crc32(id as text) mod 4 = 2 is held out
UNKNOWN = "und"
UNITS = 8                    # of each direction
WINDOW = 128                 # bytes that a state is carried over
BATCH = 2048                 # windows in a step
TEXT_BYTES = 8 << 20         # texts labelled together, about
SAMPLE_TEXTS = 2400          # texts in the training sample, over all languages
SAMPLE_CHARS = 1024          # characters of each
SHARES = 1_000_000           # hashes are cut at so many places
EPOCH_WINDOWS, TRAIN_WINDOW = 256, 48
ROUNDS, RATE, SEED = 260, 0.02, 7


@dataclass
class Layer:
    """One direction. Gates are stacked in the order r, z, n."""
    embed: np.ndarray        # (3 units, 256)
    inner: np.ndarray        # (3 units, units)
    bias: np.ndarray         # (units, 1), inside the reset

    def names(self):
        return ("embed", "inner", "bias")


@dataclass
class Network:
    layers: tuple[Layer, Layer]      # from the left, from the right
    out: np.ndarray                  # (languages, 2 units)
    offset: np.ndarray               # (languages, 1)
    languages: list[str]

    def weights(self) -> list[np.ndarray]:
        return [getattr(x, n) for x in self.layers for n in x.names()] + [self.out, self.offset]


def fresh_network(languages: list[str], units: int, rng: np.random.Generator) -> Network:
    def layer():
        return Layer((rng.standard_normal((3 * units, 256)) * 0.3).astype(np.float32),
                     (rng.standard_normal((3 * units, units)) / np.sqrt(units)).astype(np.float32),
                     np.zeros((units, 1), np.float32))
    return Network((layer(), layer()),
                   (rng.standard_normal((len(languages), 2 * units)) * 0.2).astype(np.float32),
                   np.zeros((len(languages), 1), np.float32), languages)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=0))
    return e / e.sum(axis=0)


def loss_and_gradients(net: Network, data: np.ndarray, there: np.ndarray,
                       label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over the bytes of windows and its gradients, in the
    order of ``weights``. ``data``: (steps, windows) bytes, ``there``: which of
    them are bytes of a text, ``label``: the language of each window."""
    steps, windows = data.shape
    units = net.out.shape[1] // 2
    dtype = net.out.dtype
    mask = there.astype(dtype)[:, None, :]
    states, kept = [], []
    for way, layer in enumerate(net.layers):
        order = range(steps) if way == 0 else range(steps - 1, -1, -1)
        h = np.zeros((units, windows), dtype)
        all_h, parts = np.empty((steps, units, windows), dtype), {}
        for t in order:
            x = layer.embed[:, data[t]]
            u = layer.inner @ h
            gates = _sigmoid(x[:2 * units] + u[:2 * units])
            r, z = gates[:units], gates[units:]
            inside = u[2 * units:] + layer.bias
            n = np.tanh(x[2 * units:] + r * inside)
            parts[t] = (h, r, z, inside, n)
            h = (z * h + (1 - z) * n) * mask[t]
            all_h[t] = h
        states.append(all_h)
        kept.append(parts)
    both = np.concatenate(states, axis=1)                     # (steps, 2 units, windows)
    total = mask.sum()
    loss, d_out, d_offset = 0.0, np.zeros_like(net.out), np.zeros_like(net.offset)
    d_states = np.empty_like(both)
    at = np.arange(windows)
    for t in range(steps):
        p = _softmax(net.out @ both[t] + net.offset)
        loss -= float((np.log(p[label, at] + 1e-12) * mask[t, 0]).sum())
        p[label, at] -= 1
        p *= mask[t] / total
        d_out += p @ both[t].T
        d_offset += p.sum(axis=1, keepdims=True)
        d_states[t] = net.out.T @ p
    gradients = []
    for way, layer in enumerate(net.layers):
        # The way back through time is the other way than the states went.
        order = range(steps - 1, -1, -1) if way == 0 else range(steps)
        d_embed, row = np.zeros((3 * units, 256)), 256 * np.arange(3 * units)[:, None]
        d_inner, d_bias = np.zeros_like(layer.inner), np.zeros_like(layer.bias)
        d_next = np.zeros((units, windows), dtype)
        for t in order:
            h, r, z, inside, n = kept[way][t]
            d_h = (d_states[t, way * units:(way + 1) * units] + d_next) * mask[t]
            d_n = d_h * (1 - z) * (1 - n * n)
            d_r = d_n * inside * r * (1 - r)
            d_z = d_h * (h - n) * z * (1 - z)
            d_x = np.concatenate([d_r, d_z, d_n])
            d_u = np.concatenate([d_r, d_z, d_n * r])
            d_embed += np.bincount((data[t] + row).ravel(), d_x.ravel(), d_embed.size) \
                .reshape(d_embed.shape)
            d_inner += d_u @ h.T
            d_bias += d_u[2 * units:].sum(axis=1, keepdims=True)
            d_next = d_h * z + layer.inner.T @ d_u
        gradients += [d_embed.astype(dtype), d_inner, d_bias]
    return loss / float(total), [*gradients, d_out, d_offset]


def train(texts: list[bytes], labels: list[str], *, units: int = UNITS, rounds: int = ROUNDS,
          seed: int = SEED) -> Network:
    """A network fitted to (text, language) pairs by Adam steps, each on windows
    drawn from the languages in equal parts. The same pairs in the same order
    give the same network."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    net = fresh_network(languages, units, rng)
    of = [[np.frombuffer(t, np.uint8) for t, x in zip(texts, labels, strict=True) if x == name]
          for name in languages]
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for k in range(1, rounds + 1):
        label = rng.integers(len(languages), size=EPOCH_WINDOWS)
        data = np.zeros((TRAIN_WINDOW, EPOCH_WINDOWS), np.uint8)
        there = np.zeros((TRAIN_WINDOW, EPOCH_WINDOWS), bool)
        for i, x in enumerate(label):
            text = of[x][rng.integers(len(of[x]))]
            start = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
            piece = text[start:start + TRAIN_WINDOW]
            data[:len(piece), i], there[:len(piece), i] = piece, True
        _, gradients = loss_and_gradients(net, data, there, label)
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * k / rounds)) * min(1.0, 1.0 / (size + 1e-9))
        for w, g, a, b in zip(weights, gradients, first, second, strict=True):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            w -= (rate * (a / (1 - 0.9 ** k)) / (np.sqrt(b / (1 - 0.99 ** k)) + 1e-8)).astype(w.dtype)
    return net


class _Reader:
    """The network's forward pass over batches of windows, in reused buffers.

    The sigmoids are taken as 0.5 tanh(x / 2) + 0.5, with the halves put into the
    weights, so that a step has one tanh over two gates and one over the third.
    """

    def __init__(self, net: Network):
        self.units = u = net.out.shape[1] // 2
        half = np.concatenate([np.full(2 * u, 0.5), np.ones(u)]).astype(np.float32)[:, None]
        self.layers = [(np.ascontiguousarray(x.embed * half), x.inner * half, x.bias)
                       for x in net.layers]
        self.out, self.offset = net.out, net.offset
        self.room = {}

    def _rooms(self, windows: int):
        if windows not in self.room:
            self.room = {windows: [np.empty((3 * self.units, windows), np.float32)
                                   for _ in range(2)]}
        return self.room[windows]

    def step(self, way: int, column: np.ndarray, h: np.ndarray, new: np.ndarray) -> np.ndarray:
        """The state after reading ``column``, put into ``new``, which may be ``h``."""
        embed, inner, bias = self.layers[way]
        u = self.units
        x, g = self._rooms(len(column))
        # "clip" is the fast way to take; bytes are never out of range.
        np.take(embed, column, axis=1, out=x, mode="clip")
        np.matmul(inner, h, out=g)
        gates, n = x[:2 * u], g[2 * u:]
        gates += g[:2 * u]
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5
        n += bias
        n *= gates[:u]
        n += x[2 * u:]
        np.tanh(n, out=n)
        # z * h + (1 - z) * n
        np.subtract(h, n, out=new)
        new *= gates[u:]
        new += n
        return new

    def sums(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each window of the languages' probabilities:
        (languages, windows). ``data`` is (steps, windows)."""
        steps, windows = data.shape
        whole = int(lengths.min())
        h = np.zeros((self.units, windows), np.float32)
        left = np.empty((steps, self.units, windows), np.float32)
        for t in range(steps):
            # What lies after the end of a window is never read again on this way.
            h = self.step(0, data[t], h, left[t])
        h = np.zeros((self.units, windows), np.float32)
        total = np.zeros((len(self.out), windows), np.float32)
        from_left, from_right = (np.ascontiguousarray(x) for x in np.split(self.out, 2, axis=1))
        for t in range(steps - 1, -1, -1):
            self.step(1, data[t], h, h)
            if t >= whole:
                h *= lengths > t
            p = from_left @ left[t]
            p += from_right @ h
            p += self.offset
            p -= p.max(axis=0)
            np.exp(p, out=p)
            weight = 1.0 / p.sum(axis=0)
            if t >= whole:
                weight *= lengths > t
            p *= weight
            total += p
        return total


def _windows(offsets: np.ndarray, size: int):
    """Windows of texts that lie end to end: their starts, lengths and texts."""
    length = np.diff(offsets)
    count = -(-length // size)
    text = np.repeat(np.arange(len(length)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][text] + place * size
    return start, np.minimum(size, offsets[1:][text] - start), text


def probabilities(reader: _Reader, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW,
                  batch: int = BATCH) -> np.ndarray:
    """(texts, languages): the mean over all bytes of each text; 0 for an empty one."""
    start, length, text = _windows(offsets, window)
    # Windows of one length side by side; whole windows, nearly all, come last.
    order = np.argsort(length, kind="stable")
    out = np.zeros((len(offsets) - 1, len(reader.out)))
    for i in range(0, len(order), batch):
        part = order[i:i + batch]
        steps = int(length[part].max())
        at = np.minimum(start[part] + np.arange(steps)[:, None], len(data) - 1)
        sums = reader.sums(data[at].astype(np.intp), length[part])
        for x in range(len(sums)):
            out[:, x] += np.bincount(text[part], weights=sums[x], minlength=len(out))
    return out / np.maximum(np.diff(offsets), 1)[:, None]


def _parts(batch: pa.RecordBatch, size: int):
    """Slices of a batch with about ``size`` bytes of text each, or one text."""
    lengths = pc.coalesce(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    return (batch.slice(i, j - i) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if j > i)


def _labelled(batches: Iterator[pa.RecordBatch], net: Network):
    """(id, held, letters, text) to (doc_id, held_out, lang_pred, score)."""
    reader = _Reader(net)
    names = np.array([*net.languages, UNKNOWN], object)
    for rows in (part for batch in batches for part in _parts(batch, TEXT_BYTES)):
        texts = [x or b"" for x in rows.column("text").to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        found = probabilities(reader, np.frombuffer(b"".join(texts), np.uint8), offsets)
        letters = rows.column("letters").to_numpy(zero_copy_only=False)
        best = np.where(letters, found.argmax(axis=1), len(net.languages))
        score = np.where(letters, np.clip(found.max(axis=1), 0.0, 1.0), 0.0)
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), rows.column("held"), pa.array(names[best], pa.string()),
             pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def training_sample(rows: DataFrame, *, sample_texts: int = SAMPLE_TEXTS,
                    sample_chars: int = SAMPLE_CHARS) -> list[tuple[bytes, str]]:
    """At most ``sample_texts`` (text, language) pairs of rows (held, letters, text,
    lang), in equal parts by language and chosen by a hash of the text, so that
    the pairs depend on the rows alone; copies of a text count once. A longer text gives the ``sample_chars``
    characters from a place that the hash chooses."""
    learn = rows.filter(~F.col("held") & F.col("letters") & F.col("lang").isNotNull()) \
        .select("lang", "text", F.xxhash64("text").alias("hash"))
    # One sketch a language tells how many texts there are, so that hashes below a
    # bound leave about twice the texts wanted, however many tasks read the table.
    many = learn.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()
    each = max(1, sample_texts // max(1, len(many)))
    if not many:
        return []
    share = F.create_map(*[F.lit(x) for r in many for x in (r["lang"], min(1.0, 2 * each / max(1, r["n"])))])
    learn = learn.filter(F.pmod("hash", F.lit(SHARES)) <= share[F.col("lang")] * SHARES)
    spare = F.greatest(F.char_length("text") - sample_chars, F.lit(0))
    pieces = learn.select("lang", "hash", F.substring(
        "text", F.pmod(F.xxhash64("text", F.lit(1)), spare + 1).cast("int") + 1,
        F.lit(sample_chars)).alias("piece")).groupBy("lang", "hash").agg(F.min("piece").alias("piece"))
    first = Window.partitionBy("lang").orderBy("hash")
    taken = pieces.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= each)
    pairs = [(r["piece"].encode(), r["lang"]) for r in taken.select("piece", "lang").collect()]
    return sorted(pairs, key=lambda x: (x[1], x[0]))


def detect(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from text and language of documents whose crc32(id as text) mod 4 is
    not 2 and labels every document from its text alone. ``lang_pred`` is a
    language learned, or ``und`` with score 0 for a text that is null or has no
    letter, or where no labelled text is there to learn from. A null id counts as
    the empty text; a null language is not learned from. Equal rows are labelled
    alike and each gives its row. Other columns are not read. An empty table gives
    an empty result.
    """
    key = F.col(f"`{doc_id}`")
    rows = docs.select(
        key.alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"),
        (F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == HELD_OUT).alias("held"),
        F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    pairs = training_sample(rows, sample_texts=sample_texts)
    if not pairs:
        return rows.select(F.col("id").alias("doc_id"), F.col("held").alias("held_out"),
                           F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    net = train([t for t, _ in pairs], [x for _, x in pairs])
    ids = rows.schema["id"].dataType.simpleString()

    return rows.select("id", "held", "letters", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(lambda batches: _labelled(batches, net),
                    f"doc_id {ids}, held_out boolean, lang_pred string, score double")
