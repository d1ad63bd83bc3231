"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters run over overlapping chunks that cover the whole document. Each chunk keeps the
maximum of every filter; mean, maximum and minimum over the document's chunks go through a small
hidden layer into one probability.

Defined results: a NULL text counts as empty; an empty text has one chunk of zero bytes, so it gets a
score like any other. Without labelled rows every score is 0.5; with labels of one kind only, all
scores are that kind's smoothed share. Labels that are NULL or other than 0 and 1 are left out, and a
document labelled twice counts as the smaller label. Repeated rows are scored alike, row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.byteconv import Adam, Filters, chunk_bytes, chunk_starts, fresh_taps
from sluicework.llm.texts import blocks, widened

LENGTH, STRIDE = 512, 480
WIDTHS = {2: 8, 4: 12, 6: 4}
HIDDEN = 16
#: At most so many labelled documents of each kind are learned from, and so many chunks of each.
SAMPLE, SAMPLE_CHUNKS = 1500, 6
EPOCHS, GROUP, RATE = 8, 48, 0.01
#: A small sample is gone through more often, up to so many steps.
STEPS = 400
THRESHOLD = 0.7
SPAN = LENGTH + max(WIDTHS) - 1


def labelled_sample(labels: DataFrame, label: str, per_kind: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """At most ``per_kind`` documents of each kind, the same ones every time: (doc_id, kind).

    The rows are bounded by the parameter, so they may be broadcast. The second table is one row, the
    share of kind 1 among all labelled documents.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("kind"))
    )
    share = known.agg(F.avg("kind").alias("share"))
    kinds = [
        known.filter(F.col("kind") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_kind)
        for k in (0, 1)
    ]
    return kinds[0].unionByName(kinds[1]), share


def _chunks_of(length: int, stride: int, span: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches):
            starts, rows = chunk_starts(at, length, stride)
            counts = np.bincount(rows, minlength=batch.num_rows)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            # evenly spread over the document, first and last among them
            n = counts[rows]
            chosen = (n <= most) | ((nth * (most - 1)) // np.maximum(n - 1, 1) != ((nth - 1) * (most - 1)) // np.maximum(n - 1, 1))
            starts, rows, nth = starts[chosen], rows[chosen], nth[chosen]
            chunks = chunk_bytes(data, at, starts, rows, length, span)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(rows)),
                batch.column("kind").take(pa.array(rows)),
                pa.array(nth.astype(np.int64)),
                pa.array([c.tobytes() for c in chunks], type=pa.binary()),
            ], names=["doc_id", "kind", "nth", "chunk"])

    return run


def sample_chunks(
    docs: DataFrame, sample: DataFrame, kind_type: str, length: int, stride: int, span: int, most: int
) -> tuple[np.ndarray, list, np.ndarray]:
    """Chunks of the sampled documents on the driver: bytes, kinds by document, first chunk of each.

    Bounded by the sample's size times ``most`` chunks of ``span`` bytes.
    """
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = (
        texts.select("doc_id", "kind", "text")
        .mapInArrow(_chunks_of(length, stride, span, most), f"doc_id long, kind {kind_type}, nth long, chunk binary")
        .groupBy("doc_id", "nth").agg(F.min("kind").alias("kind"), F.min("chunk").alias("chunk"))
        .toArrow()
    ).sort_by([("doc_id", "ascending"), ("nth", "ascending")])
    ids = found["doc_id"].to_numpy()
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
    chunks = np.frombuffer(b"".join(found["chunk"].to_pylist()), dtype=np.uint8).reshape(-1, span)
    kinds = found["kind"].to_pylist()
    return chunks, [kinds[i] for i in first], first


def _summed(z: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(np.r_[first, len(z)])
    return np.concatenate([
        np.add.reduceat(z, first) / counts[:, None], np.maximum.reduceat(z, first), np.minimum.reduceat(z, first),
    ], axis=1), counts


class Model:
    """Weights of a fitted network; ``constant`` is set where nothing could be learned."""

    def __init__(self, arrays: list[np.ndarray] | None = None, offset: float = 0.0, constant: float | None = None):
        self.arrays, self.offset, self.constant = arrays, offset, constant
        self._filters: Filters | None = None

    def __getstate__(self):
        return {"arrays": self.arrays, "offset": self.offset, "constant": self.constant, "_filters": None}

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The probability of every row of a block."""
        if self.constant is not None:
            return np.full(len(at) - 1, self.constant)
        if self._filters is None:
            self._filters = Filters(self.arrays[:len(WIDTHS)])
        bias, w1, c1, w2, c2 = self.arrays[len(WIDTHS):]
        starts, rows = chunk_starts(at, LENGTH, STRIDE)
        # a long document is worked off in slices of its chunks
        step = 1 << 12
        pooled = [
            self._filters.pooled(chunk_bytes(data, at, starts[i:i + step], rows[i:i + step], LENGTH, SPAN), LENGTH)
            for i in range(0, len(starts), step)
        ]
        z = np.maximum(np.concatenate(pooled) + bias, 0)
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        feats, _ = _summed(z, first)
        logit = (np.tanh(feats @ w1 + c1) @ w2 + c2)[:, 0].astype(np.float64) + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train(chunks: np.ndarray, kinds: np.ndarray, first: np.ndarray, share: float, seed: int = 7) -> Model:
    """Fits the network; the balanced sample's odds are set back to those of all labels."""
    n1, n = int(kinds.sum()), len(kinds)
    if n == 0:
        return Model(constant=0.5)
    if n1 in (0, n):
        return Model(constant=(n1 + 1) / (n + 2))
    rng = np.random.default_rng(seed)
    total = sum(WIDTHS.values())
    arrays = fresh_taps(WIDTHS, seed) + [
        np.zeros(total, dtype=np.float32),
        rng.normal(0, (3 * total) ** -0.5, (3 * total, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, dtype=np.float32),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)).astype(np.float32), np.zeros(1, dtype=np.float32),
    ]
    steps, k = Adam(arrays, RATE), len(WIDTHS)
    ends = np.r_[first[1:], len(chunks)]
    epochs = max(EPOCHS, min(10 * EPOCHS, STEPS * GROUP // n))
    for epoch in range(epochs):
        steps.rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(n)
        for i in range(0, n, GROUP):
            docs = order[i:i + GROUP]
            take = np.concatenate([np.arange(first[d], ends[d]) for d in docs])
            sizes = ends[docs] - first[docs]
            starts = np.cumsum(sizes) - sizes
            filters, x, y = Filters(arrays[:k]), chunks[take], kinds[docs].astype(np.float32)
            bias, w1, c1, w2, c2 = arrays[k:]
            pooled, where = filters.pooled(x, LENGTH, places=True)
            z = np.maximum(pooled + bias, 0)
            feats, counts = _summed(z, starts)
            hidden = np.tanh(feats @ w1 + c1)
            p = 1 / (1 + np.exp(-np.clip((hidden @ w2 + c2)[:, 0], -30, 30)))
            slope = ((p - y) / len(docs))[:, None].astype(np.float32)
            back = (slope @ w2.T) * (1 - hidden**2)
            spread = back @ w1.T
            of = np.repeat(np.arange(len(docs)), sizes)
            dz = spread[:, :total][of] / counts[of][:, None]
            for part, extreme in ((1, feats[:, total:2 * total]), (2, feats[:, 2 * total:])):
                hit = (z == extreme[of]).astype(np.float32)
                dz += spread[:, part * total:(part + 1) * total][of] * hit / np.add.reduceat(hit, starts)[of]
            dz *= z > 0
            steps.step([
                *(g + 1e-5 * t for g, t in zip(filters.gradients(x, where, dz), arrays[:k], strict=True)),
                dz.sum(axis=0), feats.T @ back, back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0),
            ])
    odds = np.log(n1 / (n - n1))
    whole = np.log(min(max(share, 1e-3), 1 - 1e-3) / (1 - min(max(share, 1e-3), 1 - 1e-3)))
    return Model(arrays, offset=float(whole - odds))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None) -> Model:
    """A network for the labelled documents, learned from a bounded sample (``SAMPLE`` of each kind)."""
    if usable is not None:
        labels = labels.filter(usable)
    sample, share = labelled_sample(labels, label)
    chunks, kinds, first = sample_chunks(docs, sample, "int", LENGTH, STRIDE, SPAN, SAMPLE_CHUNKS)
    return train(chunks, np.array(kinds, dtype=np.int64), first, share.first()["share"] or 0.5)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every row with its probability; a column of that name must not exist yet."""
    schema = widened(docs.schema, **{name: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.scores(data, at))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose probability reaches the threshold, in their own columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches):
            yield batch.filter(pa.array(model.scores(data, at) >= threshold))

    return docs.mapInArrow(run, docs.schema)
