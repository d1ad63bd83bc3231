"""Language identification: a byte convolutional network in numpy.

Filters of several widths run over fixed-length windows of bytes, each window keeps their maxima, and
a softmax gives its language. A document's probabilities are the mean over all its windows.

Defined results: ``und`` with score 0 for a NULL text and one without letters, and for every text if
no labelled row was given. Ties go to the language that sorts first. Labels that are NULL are left
out; a document labelled twice counts as the smaller label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.byteconv import Adam, Filters, chunk_bytes, chunk_starts, fresh_taps
from sluicework.llm.quality_cnn import sample_chunks
from sluicework.llm.texts import blocks, widened

LENGTH = STRIDE = 256
WIDTHS = {2: 8, 3: 8, 4: 8}
SPAN = LENGTH + max(WIDTHS) - 1
#: At most so many documents are learned from, and so many windows of each.
SAMPLE, SAMPLE_WINDOWS = 1000, 4
EPOCHS, GROUP, RATE = 6, 128, 0.01
#: A small sample is gone through more often, up to so many steps.
STEPS = 300
UNKNOWN = "und"


class Model:
    def __init__(self, languages: list[str], arrays: list[np.ndarray]) -> None:
        self.languages, self.arrays = languages, arrays
        self._filters: Filters | None = None

    def __getstate__(self):
        return {"languages": self.languages, "arrays": self.arrays, "_filters": None}

    def probabilities(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The mean over each row's windows of the softmax: (rows, languages)."""
        if self._filters is None:
            self._filters = Filters(self.arrays[:len(WIDTHS)])
        bias, weights, constant = self.arrays[len(WIDTHS):]
        starts, rows = chunk_starts(at, LENGTH, STRIDE)
        total, step = np.zeros((len(at) - 1, len(self.languages))), 1 << 13
        for i in range(0, len(starts), step):
            of = rows[i:i + step]
            pooled = self._filters.pooled(chunk_bytes(data, at, starts[i:i + step], of, LENGTH, SPAN), LENGTH)
            p = _softmax(np.maximum(pooled + bias, 0) @ weights + constant)
            for k in range(p.shape[1]):
                total[:, k] += np.bincount(of, weights=p[:, k], minlength=len(total))
        return total / np.bincount(rows, minlength=len(total))[:, None]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(chunks: np.ndarray, kinds: list[str], first: np.ndarray, seed: int = 11) -> Model:
    languages = sorted(set(kinds))
    rng = np.random.default_rng(seed)
    total, k = sum(WIDTHS.values()), len(WIDTHS)
    arrays = fresh_taps(WIDTHS, seed) + [
        np.zeros(total, dtype=np.float32),
        rng.normal(0, total**-0.5, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    ]
    code = {name: i for i, name in enumerate(languages)}
    target = np.repeat([code[x] for x in kinds], np.diff(np.r_[first, len(chunks)])) if languages else np.zeros(0)
    steps = Adam(arrays, RATE)
    epochs = max(EPOCHS, min(10 * EPOCHS, STEPS * GROUP // max(len(chunks), 1))) if len(languages) > 1 else 0
    for epoch in range(epochs):
        steps.rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(chunks))
        for i in range(0, len(order), GROUP):
            take = order[i:i + GROUP]
            filters, x = Filters(arrays[:k]), chunks[take]
            bias, weights, constant = arrays[k:]
            pooled, where = filters.pooled(x, LENGTH, places=True)
            z = np.maximum(pooled + bias, 0)
            slope = _softmax(z @ weights + constant)
            slope[np.arange(len(take)), target[take]] -= 1
            slope = (slope / len(take)).astype(np.float32)
            dz = (slope @ weights.T) * (z > 0)
            steps.step([
                *(g + 1e-5 * t for g, t in zip(filters.gradients(x, where, dz), arrays[:k], strict=True)),
                dz.sum(axis=0), z.T @ slope, slope.sum(axis=0),
            ])
    return Model(languages, arrays)


def fit(docs: DataFrame, label: str = "lang", usable: Column | None = None, most: int = SAMPLE) -> Model:
    """A network learned from at most ``most`` labelled documents of each language, chosen by the hash of their id.

    So a language with few documents is learned from all of them, however many the others have.
    """
    rows = docs if usable is None else docs.filter(usable)
    known = (
        rows.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("kind"))
    )
    # Spark keeps the first rows of a language in every task before they meet
    order = Window.partitionBy("kind").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = known.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth")
    chunks, kinds, first = sample_chunks(docs, sample, "string", LENGTH, STRIDE, SPAN, SAMPLE_WINDOWS)
    return train(chunks, kinds, first)


def predicted(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row with its language and that language's probability."""
    schema = widened(docs.schema, **{names[0]: "string", names[1]: "double"})
    letters = "_has_letters"
    while letters in docs.columns:
        letters += "_"
    languages = np.array([*model.languages, UNKNOWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches):
            known = batch.column(letters).to_numpy(zero_copy_only=False).astype(bool) & (len(languages) > 1)
            best, score = np.full(len(known), len(languages) - 1), np.zeros(len(known))
            if known.any():
                p = model.probabilities(data, at)
                best = np.where(known, p.argmax(axis=1), best)
                score = np.where(known, p.max(axis=1), score)
            own = batch.drop_columns([letters])
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(languages[best]), pa.array(score)], names=[*own.schema.names, *names])

    has_letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(letters, has_letters).mapInArrow(run, schema)
