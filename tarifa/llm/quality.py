"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are covered wholly by chunks of ``CHUNK`` bytes that overlap by a
quarter or more, evenly spaced so that the last one is as long as the others. In
each chunk the bytes are embedded, ``FILTERS`` learned filters of eight bytes
run over it at every second byte, and each is max-pooled over the chunk. A
small hidden layer turns the maxima (and the chunk's length) into a number for
the chunk; the least and the mean number of all chunks are combined into one probability.

Training is on the driver, with Adam, from a bounded sample: ``SAMPLE`` labelled
rows of each class, those with the smallest hashes of their ids, whole texts, and a short piece of each
from anywhere in it, by the same rule for both classes. Settings were chosen on rows that labels may
be learned from and that were not in the sample, not on held-out ones. Seeds are fixed. Scoring is one pass over all documents without a
shuffle, and reads every byte.

Defined cases: a null text counts as empty; an empty text is one chunk of length
zero and has a score; without labelled rows every score is 0.5; a label counts
once for its id, the smallest if there are several, null labels not at all; a null
id is never held out; an empty table gives an empty table; rows that repeat an id are
rows of their own; further columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import as_bytes, by_bytes, type_of

CHUNK = 128
STEP = 96
EMBED = 8
FILTERS = 32
TAPS = 4  # of two bytes each
HIDDEN = 16
PAD = 256
SAMPLE = 2500
EPOCHS = 4
STEPS = 500  # at least; a small sample is seen more often
BATCH = 64  # texts
BLOCK = 64  # chunks that stay in the cache
THRESHOLD = 0.3
Model = dict[str, np.ndarray]


def chunk_starts(n: int) -> np.ndarray:
    if n <= CHUNK:
        return np.zeros(1, np.int64)
    number = -(-(n - CHUNK) // STEP) + 1
    return np.arange(number, dtype=np.int64) * (n - CHUNK) // (number - 1)


def chunks_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(chunks by CHUNK, uint16, padded; their lengths)."""
    data, starts = np.frombuffer(text, np.uint8), chunk_starts(len(text))
    if len(text) >= CHUNK:
        return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts].astype(np.uint16), np.full(len(starts), CHUNK)
    out = np.full((1, CHUNK), PAD, np.uint16)
    out[0, : len(text)] = data
    return out, np.array([len(text)])


def fresh(seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    return {
        "embed": normal(PAD + 1, EMBED) * np.float32(0.5),
        "filters": normal(2 * EMBED, TAPS, FILTERS) / np.float32(np.sqrt(2 * EMBED * TAPS)),
        "bias": np.zeros(FILTERS, np.float32),
        "in": normal(FILTERS + 1, HIDDEN) / np.float32(np.sqrt(FILTERS + 1)),
        "in_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN) / np.float32(np.sqrt(HIDDEN)),
        "mix": np.array([0.5, 0.5, 0.0], np.float32),  # of the least, of the mean, bias
    }


def pooled(model: Model, chunks: np.ndarray, lengths: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(maxima, positions of the maxima if asked for) by chunk and filter, in blocks that stay in the cache."""
    units, maxima, at = CHUNK // 2, [], []
    table = model["filters"].reshape(2 * EMBED, -1)
    for b in range(0, len(chunks), BLOCK):
        x = model["embed"][chunks[b : b + BLOCK]].reshape(-1, 2 * EMBED)
        taps = (x @ table).reshape(-1, units, TAPS, FILTERS)
        y = taps[:, : units - TAPS + 1, 0]
        for j in range(1, TAPS):
            y = y + taps[:, j : units - TAPS + 1 + j, j]
        valid = np.maximum(1, -(-lengths[b : b + BLOCK] // 2) - TAPS + 1)
        for i in np.flatnonzero(valid < y.shape[1]):
            y[i, valid[i] :] = -np.inf
        if places:
            by_filter = np.ascontiguousarray(y.transpose(0, 2, 1))
            at.append(by_filter.argmax(axis=2))
            maxima.append(np.take_along_axis(by_filter, at[-1][:, :, None], axis=2)[:, :, 0])
        else:
            maxima.append(y.max(axis=1))
    return np.concatenate(maxima) + model["bias"], np.concatenate(at) if places else np.zeros(0, np.int64)


def _head(model: Model, maxima: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = np.concatenate([np.tanh(maxima), (np.log1p(lengths) / 4)[:, None].astype(np.float32)], axis=1)
    hidden = np.tanh(m @ model["in"] + model["in_bias"])
    return m, hidden, hidden @ model["out"]


def _combine(model: Model, number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logits of texts from the numbers of their chunks."""
    size = np.diff(np.append(first, len(number)))
    least, mean = np.minimum.reduceat(number, first), np.add.reduceat(number, first) / size
    return least * model["mix"][0] + mean * model["mix"][1] + model["mix"][2]


def probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    """Scores of whole texts."""
    numbers, first, at = [], [], 0
    for text in texts:
        first.append(at)
        starts = chunk_starts(len(text))
        at += len(starts)
    held, lengths = [], []
    for text in texts:
        c, n = chunks_of(text)
        held.append(c)
        lengths.append(n)
        if sum(map(len, lengths)) >= 4096:
            numbers.append(_head(model, pooled(model, np.concatenate(held), np.concatenate(lengths), False)[0], np.concatenate(lengths))[2])
            held, lengths = [], []
    if held:
        numbers.append(_head(model, pooled(model, np.concatenate(held), np.concatenate(lengths), False)[0], np.concatenate(lengths))[2])
    logits = _combine(model, np.concatenate(numbers), np.array(first))
    return 1 / (1 + np.exp(-logits.astype(np.float64)))


def gradients(model: Model, chunks: np.ndarray, lengths: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, Model]:
    maxima, at = pooled(model, chunks, lengths)
    m, hidden, number = _head(model, maxima, lengths)
    size = np.diff(np.append(first, len(number)))
    owner = np.repeat(np.arange(len(first)), size)
    least, mean = np.minimum.reduceat(number, first), np.add.reduceat(number, first) / size
    logit = least * model["mix"][0] + mean * model["mix"][1] + model["mix"][2]
    p = 1 / (1 + np.exp(-logit))
    loss = float(-(weights * (labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))).sum())
    d = (weights * (p - labels)).astype(np.float32)
    g = {"mix": np.array([(d * least).sum(), (d * mean).sum(), d.sum()], np.float32)}
    is_least = number == least[owner]
    d_number = d[owner] * (model["mix"][0] * is_least + model["mix"][1] / size[owner])
    g["out"] = d_number @ hidden
    d_hidden = d_number[:, None] * model["out"] * (1 - hidden**2)
    g["in"], g["in_bias"] = m.T @ d_hidden, d_hidden.sum(axis=0)
    d_max = (d_hidden @ model["in"].T)[:, :FILTERS] * (1 - m[:, :FILTERS] ** 2)
    g["bias"] = d_max.sum(axis=0)
    pairs = chunks.reshape(len(chunks), -1, 2)
    g["filters"], g["embed"] = np.zeros_like(model["filters"]), np.zeros_like(model["embed"])
    rows, columns, weight = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :], d_max.ravel()
    for j in range(TAPS):
        for half in (0, 1):
            own = slice(half * EMBED, (half + 1) * EMBED)
            seen = pairs[rows, at + j, half].astype(np.int64)  # the byte that each chunk's maximum has at this place
            by_byte = np.bincount((seen * FILTERS + columns).ravel(), weight, (PAD + 1) * FILTERS).reshape(PAD + 1, FILTERS)
            g["filters"][own, j] = model["embed"].T @ by_byte
            g["embed"] += (by_byte @ model["filters"][own, j].T).astype(g["embed"].dtype)
    return loss, {k: v.astype(np.float32) for k, v in g.items()}


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 5) -> Model:
    """Adam on batches of whole texts, which are cut into chunks as they come up. Classes weigh the same."""
    model, rng = fresh(), np.random.default_rng(seed)
    share = np.array([max(1, (labels == c).sum()) for c in (0, 1)]) * 2 / max(1, len(labels))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    rounds = -(-len(texts) // BATCH)
    epochs = max(epochs, -(-STEPS // rounds))
    step, steps = 0, epochs * rounds
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for b in range(0, len(order), BATCH):
            own = order[b : b + BATCH]
            parts = [chunks_of(texts[i]) for i in own]
            chunks, lengths = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            first = np.cumsum([0, *(len(p[1]) for p in parts[:-1])])
            weights = (1 / share[labels[own]] / len(own)).astype(np.float32)
            _, g = gradients(model, chunks, lengths, first, labels[own], weights)
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for k, v in g.items():
                a, s = moments[k]
                a += 0.1 * (v - a)
                s += 0.01 * (v * v - s)
                model[k] -= now * (a / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def with_pieces(texts: list[bytes], labels: np.ndarray, seed: int = 11) -> tuple[list[bytes], np.ndarray]:
    """The texts and a short piece of each, from anywhere in it, so that short texts are not rare."""
    rng, out = np.random.default_rng(seed), list(texts)
    for text in texts:
        n = int(min(len(text), rng.integers(4, CHUNK)))
        at = int(rng.integers(0, len(text) - n + 1))
        out.append(text[at : at + n])
    return out, np.concatenate([labels, labels])


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", label_id: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """A model of ``label_col`` from rows that are not held out; None without any."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("label").alias("label")).withColumn("order", F.xxhash64("id"))
    few = known.where("label = 0").orderBy("order", "id").limit(sample).unionByName(known.where("label = 1").orderBy("order", "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(few), "id").select("order", "label", "text")  # 2 * sample rows
    first = texts.groupBy("order").agg(F.min(F.struct("text", "label")).alias("r")).select("order", "r.*").orderBy("order").collect()  # a repeated id counts once
    if not first:
        return None
    return fit(*with_pieces([(r["text"] or "").encode() for r in first], np.array([r["label"] for r in first])))


def _score(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text", 4 << 20):
        texts = as_bytes(batch.column("text"))
        p = probabilities(model, texts) if model else np.full(len(texts), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p)], names=["row", "score"])


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``'s columns (all unless given) in a struct ``row``, and ``score``."""
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    source = docs.select(row, F.col(text_col).alias("text"))
    return source.mapInArrow(partial(_score, model=model), f"row {type_of(source, 'row')}, score double")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: id, held_out, score, predicted."""
    out = scored(docs, train(docs, labels, id_col, text_col), text_col, [id_col])
    id_ = F.col(f"row.`{id_col}`")
    return out.select(id_.alias(id_col), held_out(id_).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept_rows(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return scored(docs, model, text_col).where(F.col("score") >= threshold).select("row.*")
