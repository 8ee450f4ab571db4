"""Quality classifier: a byte-level convolutional network in numpy.

Filters over four bytes run along the whole document. Their largest responses per chunk (chunks of
two blocks, each overlapping the next by one block) are averaged and maximised over the chunks, and
one logistic unit turns them into a probability. The network is trained in one Spark task on a
bounded sample of labelled documents; scoring runs over all rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import least_hashed

#: Bytes under one filter; filters; positions per block, half a chunk.
WIDTH, FILTERS, BLOCK = 4, 8, 256
#: Bytes laid out at a time, which bounds a task's memory, and positions looked up at a time.
SLAB, STEP = 1 << 22, 1 << 15
#: Bound of the training sample: labelled documents of each class.
TRAIN_PER_CLASS = 1000
#: Rows that are kept or dropped at a time.
PART = 256
THRESHOLD = 0.3


@dataclass(frozen=True)
class Network:
    """``taps``: a weight for each offset, byte value and filter."""

    taps: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @staticmethod
    def start(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        taps = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        taps[:, 0] = 0  # padding
        return Network(taps, np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, 2 * FILTERS), 0.0)

    def pack(self) -> bytes:
        parts = (self.taps, self.bias, self.weights, np.array([self.offset]))
        return b"".join(p.astype("<f4").tobytes() for p in parts)

    @staticmethod
    def unpack(data: bytes) -> Network:
        flat = np.frombuffer(data, "<f4").copy()
        n = WIDTH * 256 * FILTERS
        return Network(
            flat[:n].reshape(WIDTH, 256, FILTERS), flat[n : n + FILTERS], flat[n + FILTERS : -1].astype(float), float(flat[-1])
        )


def _lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the byte pairs at each position and two positions on, and blocks per document.

    Each document is padded with zeros to whole blocks, so no filter sees two documents.
    """
    blocks = np.array([(len(t) + WIDTH - 2) // BLOCK + 1 for t in texts], np.int64)
    data = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    ends = np.cumsum(blocks) * BLOCK
    for t, end, n in zip(texts, ends, blocks):
        start = end - n * BLOCK
        data[start : start + len(t)] = np.frombuffer(t, np.uint8)
    near = data.astype(np.int32) << 8
    near[:-1] |= data[1:]
    near[ends - 1] = 0
    far = np.zeros_like(near)
    far[:-2] = near[2:]
    far[ends - 1] = far[ends - 2] = 0
    return near, far, blocks


def _tables(taps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Responses of the first and the last two taps to every byte pair: two lookups per position."""
    pair = [(taps[i][:, None, :] + taps[i + 1][None, :, :]).reshape(65536, FILTERS) for i in (0, 2)]
    return np.ascontiguousarray(pair[0]), np.ascontiguousarray(pair[1])


def _pool(peaks: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest response per chunk, whether it is the second block's, and the chunks' starts.

    Chunk i joins blocks i and i + 1; a document's last block closes its last chunk.
    """
    starts = np.cumsum(blocks) - blocks
    later = np.minimum(np.arange(len(peaks)) + 1, np.repeat(starts + blocks - 1, blocks))
    second = peaks[later] > peaks
    return np.where(second, peaks[later], peaks), second, starts


def score_texts(net: Network, texts: list[bytes], tables: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Probability of each whole text. Texts are laid out a slab at a time, so memory is a few times
    the larger of a slab and the longest text."""
    first, last = tables or _tables(net.taps)
    peaks, blocks = [], []
    group: list[bytes] = []
    size = 0

    def run(group: list[bytes]) -> None:
        near, far, n = _lay_out(group)
        for at in range(0, len(near), STEP):
            response = first.take(near[at : at + STEP], axis=0)
            response += last.take(far[at : at + STEP], axis=0)
            response = response.reshape(-1, BLOCK * FILTERS)
            while (half := response.shape[1] // 2) >= FILTERS:
                response = np.maximum(response[:, :half], response[:, half:])
            peaks.append(response)
        blocks.append(n)

    for t in texts:
        group.append(t)
        size += len(t) + BLOCK
        if size >= SLAB:
            run(group)
            group, size = [], 0
    if group:
        run(group)
    if not blocks:
        return np.zeros(0)
    n = np.concatenate(blocks)
    chunk, _, starts = _pool(np.concatenate(peaks), n)
    active = np.maximum(chunk + net.bias, 0).astype(np.float64)
    mean = np.add.reduceat(active, starts) / n[:, None]
    top = np.maximum.reduceat(active, starts)
    return 1 / (1 + np.exp(-np.clip(np.hstack([mean, top]) @ net.weights + net.offset, -30, 30)))


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    near, far, n = _lay_out(texts)
    first, last = _tables(net.taps)
    response = (first[near] + last[far]).reshape(-1, BLOCK, FILTERS)
    where = response.argmax(axis=1)
    peaks = np.take_along_axis(response, where[:, None, :], 1)[:, 0]
    chunk, second, starts = _pool(peaks, n)
    active = np.maximum(chunk + net.bias, 0).astype(np.float64)
    mean = np.add.reduceat(active, starts) / n[:, None]
    top = np.maximum.reduceat(active, starts)
    features = np.hstack([mean, top])
    error = (1 / (1 + np.exp(-np.clip(features @ net.weights + net.offset, -30, 30))) - labels) / len(labels)
    doc = np.repeat(np.arange(len(n)), n)
    back = (error / n)[doc, None] * net.weights[:FILTERS]
    back = back + error[doc, None] * net.weights[FILTERS:] * (active == top[doc])
    back *= active > 0
    # a response belongs to one window of WIDTH bytes: only those taps move
    rows, filters = np.nonzero(back)
    block = rows + second[rows, filters]
    at = block * BLOCK + where[block, filters]
    d_taps = np.zeros(net.taps.shape)
    values = back[rows, filters]
    for offset, code in enumerate((near[at] >> 8, near[at] & 255, far[at] >> 8, far[at] & 255)):
        np.add.at(d_taps[offset], (code, filters), values)
    d_taps[:, 0] = 0
    return [d_taps, back.sum(axis=0), features.T @ error, np.array(error.sum())]


def train(
    texts: list[bytes], labels: np.ndarray, odds: float, epochs: int = 8, batch: int = 32, rate: float = 0.02, seed: int = 7
) -> Network:
    """Adam over mini-batches, reproducible for the same rows in the same order.

    ``odds``: of label 1 among all labelled documents; the sample's own are corrected to them.
    """
    net = Network.start(seed)
    params = [net.taps.astype(np.float64), net.bias.astype(np.float64), net.weights.copy(), np.array(net.offset)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick, step = order[at : at + batch], step + 1
            now = Network(params[0].astype(np.float32), params[1].astype(np.float32), params[2], float(params[3]))
            for i, g in enumerate(_gradients(now, [texts[j] for j in pick], labels[pick])):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    shift = float(np.log(odds * (labels == 0).sum() / (labels == 1).sum()))
    return Network(params[0].astype(np.float32), params[1].astype(np.float32), params[2], float(params[3]) + shift)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def held_out(key: str = "doc_id") -> Column:
    """One fifth of the ids, by CRC-32 of the id as text; never used for training."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """Label by id, without held-out ids, null ids or labels, and ids whose labels disagree."""
    return (
        labels.select("doc_id", "quality")
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .filter("label = _most")
        .select(F.col("doc_id").alias("_id"), "label", F.xxhash64("doc_id").alias("_order"))
    )


def training_sample(docs: DataFrame, agreed: DataFrame, counts: tuple[int, int], per_class: int) -> DataFrame:
    """At most ``per_class`` labelled documents of each class (of which there are ``counts``), by the hash
    of their ids; of documents that share an id the least text is taken."""
    picked = [least_hashed(agreed.filter(F.col("label") == c), "_order", counts[c], per_class, "_id") for c in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    found = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
    return found.groupBy("_order", "_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Network | None:
    """Train in one task on the bounded sample; the driver receives the weights only. None without both classes."""

    agreed = training_labels(labels)
    ones, zeros = agreed.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["_order", "_id"])
        if rows["label"].nunique() < 2:
            return
        net = train([_bytes(t) for t in rows["text"]], rows["label"].to_numpy(float), ones / zeros)
        yield pd.DataFrame({"net": [net.pack()]})

    sample = training_sample(docs, agreed, (zeros, ones), per_class).coalesce(1)
    got = sample.mapInPandas(run, "net binary").collect()
    return Network.unpack(bytes(got[0].net)) if got else None


def kept(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least the threshold.

    Rows are judged where they are, without a shuffle. Nulls and a missing network count as in ``score``.
    """
    packed, at = net.pack() if net else None, docs.columns.index(text)
    return docs.mapInArrow(lambda batches: _kept(batches, Network.unpack(packed) if packed else None, at), docs.schema)


def _kept(batches: Iterator[pa.RecordBatch], net: Network | None, at: int) -> Iterator[pa.RecordBatch]:
    """What ``net`` keeps, judged and given back PART rows at a time, which bounds what whole texts take besides their batch."""
    tables = _tables(net.taps) if net else None
    for batch in batches:
        for start in range(0, batch.num_rows, PART):
            part = batch.slice(start, PART)
            if net:
                part = part.filter(pa.array(score_texts(net, [_bytes(t.as_py()) for t in part.column(at)], tables) >= THRESHOLD))
            yield part


def score(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score from 0 to 1 and predicted (score >= 0.3).

    The whole text counts. A null text is an empty one, which has a score like any other; a null key
    stays and is not held out; repeated rows are scored alike; without a network, as on empty
    labels, every score is 0.5. Only ``key`` and ``text`` are read, so other columns may have any name.
    """
    packed = net.pack() if net else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.unpack(packed) if packed else None
        tables = _tables(net.taps) if net else None
        for batch in batches:
            texts = [_bytes(t.as_py()) for t in batch.column(1)]
            scores = score_texts(net, texts, tables) if net else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [batch.schema.names[0], "score"])

    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
