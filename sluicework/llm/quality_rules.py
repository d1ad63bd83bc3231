"""Quality rules: plain counts, then a hashed n-gram logistic regression with calibrated probabilities.

The features are word 1- and 2-grams and character (code point) 3- and 5-grams, hashed into one table of
weights. A document's log-odds are the mean weight of each of the four kinds, scaled, so length does not count.

Defined results: a NULL text has no words. A document without an n-gram of some kind gets nothing from
that kind. Without labelled rows, or with labels of one kind only, every document's probability is the
smoothed share of label 1 (0.5 without labels). Repeated rows are judged alike, row by row; scores are
compared with fixed thresholds, so ties need no rule. An empty table gives an empty table. Very long texts
are scored whole, alone in their block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.quality_cnn import labelled_sample, sample_chunks
from sluicework.llm.texts import IS_SPACE, blocks, mixed, span_hashes, widened, window_hashes, words_of
from sluicework.llm.texts import _unaligned as eight_bytes

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30

BITS = 18
CHARACTER_GRAMS = (3, 5)
SCALE = 20.0
#: At most so many labelled documents of each kind are learned from, by so many spans of so many bytes.
SAMPLE, SPANS, SPAN = 1000, 6, 512
EPOCHS, RATE = 60, 0.1
THRESHOLD = 0.5

IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(SYMBOLS)] = True
ROW = np.uint64(0xD1342543DE82EF95)


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] - total[at[:-1]]


def _distinct_per_row(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(mixed(hashes + rows.astype(np.uint64) * ROW), return_index=True)
    return np.bincount(rows[first], minlength=n)


def base_counts(data: np.ndarray, at: np.ndarray, words=None) -> dict[str, np.ndarray]:
    """The counts of the base rules for every row of a block."""
    n = len(at) - 1
    starts, ends, rows = words_of(data, at) if words is None else words[:3]
    hashes = span_hashes(data, starts, ends) if words is None else words[3]
    inside = ~IS_SPACE[data]
    feeds = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([at[:-1], feeds + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([at[1:], feeds]), kind="stable")
    filled = np.concatenate([[0], np.cumsum(inside)])
    used = filled[line_ends] > filled[line_starts]
    line_starts, line_ends = line_starts[used], line_ends[used]
    line_rows = np.searchsorted(at, line_starts, side="right") - 1
    lines = span_hashes(data, line_starts, line_ends, seed=1)
    windows, places = window_hashes(hashes, rows, REPEAT_WINDOW)
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(windows):
        _, inverse, counts = np.unique(
            mixed(windows + rows[places].astype(np.uint64) * ROW), return_inverse=True, return_counts=True)
        again = places[counts[inverse] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + REPEAT_WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": _per_row(inside & ((data & 0xC0) != 0x80), at),
        "n_symbols": _per_row(IS_SYMBOL[data], at),
        "n_dup_lines": np.bincount(line_rows, minlength=n) - _distinct_per_row(lines, line_rows, n),
        "n_repeat_words": np.bincount(rows[repeated], minlength=n),
    }


def characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every code point, of its UTF-8 bytes, and its row. Bytes of a cut code point at a row's
    start belong to none."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    rows = np.searchsorted(at, lead, side="right") - 1
    size = np.minimum(np.minimum(np.r_[lead[1:], len(data)], at[rows + 1]) - lead, 4)
    eight = eight_bytes(np.concatenate([data, np.zeros(8, dtype=np.uint8)]), len(data))
    return eight[lead] & ((np.uint64(1) << (8 * size).astype(np.uint64)) - np.uint64(1)), rows


def features(data: np.ndarray, at: np.ndarray, words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram its slots in the weight table and the rows they belong to."""
    _, _, rows, hashes = words
    shift = np.uint64(64 - BITS)
    found = [(hashes >> shift, rows)]
    pairs, first = window_hashes(hashes, rows, 2)
    found.append((pairs >> shift, rows[first]))
    chars, of = characters(data, at)
    for n in CHARACTER_GRAMS:
        grams, first = window_hashes(chars, of, n)
        found.append((grams >> shift, of[first]))
    return [(slots.astype(np.int32), of) for slots, of in found]


def _hashed_words(data: np.ndarray, at: np.ndarray):
    starts, ends, rows = words_of(data, at)
    return starts, ends, rows, span_hashes(data, starts, ends)


class Model:
    """Weights, intercept and the calibration (slope, offset) of the log-odds."""

    def __init__(self, weights=None, intercept=0.0, slope=1.0, offset=0.0, constant=None) -> None:
        self.weights, self.intercept, self.slope, self.offset = weights, intercept, slope, offset
        self.constant = constant

    def log_odds(self, n: int, found) -> np.ndarray:
        z = np.full(n, self.intercept)
        for slots, rows in found:
            total = np.bincount(rows, weights=self.weights[slots], minlength=n)
            z += SCALE * total / np.maximum(np.bincount(rows, minlength=n), 1)
        return z

    def probabilities(self, data: np.ndarray, at: np.ndarray, words) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(at) - 1, self.constant)
        z = self.slope * self.log_odds(len(at) - 1, features(data, at, words)) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[bytes], kinds: np.ndarray, share: float) -> Model:
    """Logistic regression by Adam on four fifths of the texts, calibrated on the last fifth."""
    n, n1 = len(kinds), int(kinds.sum())
    if n == 0:
        return Model(constant=0.5)
    if n1 in (0, n):
        return Model(constant=(n1 + 1) / (n + 2))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = features(data, at, _hashed_words(data, at))
    scale = [SCALE / np.maximum(np.bincount(rows, minlength=n), 1) for _, rows in found]
    held = np.arange(n) % 5 == 4
    if len(set(kinds[held])) < 2 or len(set(kinds[~held])) < 2:
        held = np.zeros(n, dtype=bool)
    model = Model(np.zeros(1 << BITS), 0.0)
    m, v = np.zeros(len(model.weights) + 1), np.zeros(len(model.weights) + 1)
    for step in range(1, EPOCHS + 1):
        z = model.log_odds(n, found)
        slope = np.where(held, 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - kinds) / (~held).sum()
        grad = 1e-7 * np.r_[model.weights, 0]
        for (slots, rows), s in zip(found, scale, strict=True):
            grad[:-1] += np.bincount(slots, weights=(slope * s)[rows], minlength=len(model.weights))
        grad[-1] = slope.sum()
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        model.weights -= move[:-1]
        model.intercept -= move[-1]
    use = held if held.any() else np.ones(n, dtype=bool)
    z, y = model.log_odds(n, found)[use], kinds[use]
    # Platt's method: targets drawn in a little, a few Newton steps
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - goal) * z).sum(), (p - goal).sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    share = min(max(share, 1e-3), 1 - 1e-3)
    model.slope, model.offset = float(a), float(b + np.log(share / (1 - share)) - np.log(n1 / (n - n1)))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None) -> Model:
    """A model for the labelled documents, learned from a bounded sample (``SAMPLE`` of each kind)."""
    if usable is not None:
        labels = labels.filter(usable)
    sample, share = labelled_sample(labels, label, SAMPLE)
    chunks, kinds, first = sample_chunks(docs, sample, "int", SPAN, SPAN, SPAN, SPANS)
    ends = np.r_[first[1:], len(chunks)] if len(first) else first
    texts = [b"\n".join(c.tobytes().rstrip(b"\0") for c in chunks[a:b]) for a, b in zip(first, ends, strict=True)]
    return train(texts, np.array(kinds, dtype=np.int64), share.first()["share"] or 0.5)


def judged(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with the counts, ``base_failed``, the probability ``rule_score`` and ``kept``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = [*counts, "base_failed", "rule_score", "kept"]
    schema = widened(docs.schema, **dict.fromkeys(counts, "long"), base_failed="boolean", rule_score="double", kept="boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches):
            words = _hashed_words(data, at)
            found = base_counts(data, at, words)
            n = found["n_words"]
            failed = (n < MIN_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * n)
            p = model.probabilities(data, at, words)
            columns = [pa.array(found[c].astype(np.int64)) for c in counts]
            columns += [pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
