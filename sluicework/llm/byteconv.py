"""Byte-level convolution with max pooling in numpy, shared by the classifiers that read raw bytes.

A filter of width ``w`` gives every byte value a weight at each of its ``w`` taps. Two taps together
are one lookup by a pair of bytes, so a text costs a few table lookups per filter and byte.
"""

from __future__ import annotations

import numpy as np


def chunk_starts(at: np.ndarray, length: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the overlapping chunks of every row start, and their rows.

    The chunks cover the whole row; the last one ends where the row ends. An empty row has one chunk.
    """
    sizes = np.diff(at)
    counts = 1 + np.maximum(0, -(-(sizes - length) // stride))
    rows = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = np.maximum(0, sizes - length)[rows]
    return at[:-1][rows] + np.minimum(nth * stride, last), rows


def chunk_bytes(
    data: np.ndarray, at: np.ndarray, starts: np.ndarray, rows: np.ndarray, length: int, span: int
) -> np.ndarray:
    """A matrix with the bytes of each chunk and ``span - length`` more; zeros beyond the row's end."""
    padded = np.concatenate([data, np.zeros(span, dtype=np.uint8)])
    chunks = np.lib.stride_tricks.sliding_window_view(padded, span)[starts].copy()
    left = at[1:][rows] - starts
    short = np.flatnonzero(left < span)
    if len(short):
        beyond = np.arange(span)[None, :] >= left[short][:, None]
        chunks[short] = np.where(beyond, 0, chunks[short])
    return chunks


class Filters:
    """Filters of several widths. ``taps[k]`` has the shape (width, 256, filters)."""

    def __init__(self, taps: list[np.ndarray]) -> None:
        self.taps = taps
        self.reach = max(t.shape[0] for t in taps)
        self._tables: list[list[tuple[int, np.ndarray]]] = []
        for t in taps:
            tables = []
            for k in range(0, t.shape[0] - 1, 2):
                pair = t[k].T[:, :, None] + t[k + 1].T[:, None, :]
                tables.append((k, np.ascontiguousarray(pair.reshape(t.shape[2], 65536), dtype=np.float32)))
            if t.shape[0] % 2:
                last = np.repeat(t[-1].T[:, :, None], 256, axis=2)
                tables.append((t.shape[0] - 1, np.ascontiguousarray(last.reshape(-1, 65536), dtype=np.float32)))
            self._tables.append(tables)

    def pooled(self, chunks: np.ndarray, length: int, places: bool = False):
        """The maximum of every filter over each chunk; with ``places`` also where it is."""
        n, span = chunks.shape
        cells = n * span
        flat = np.zeros(cells + self.reach + 1, dtype=np.intp)
        flat[:cells] = chunks.ravel()
        pairs = flat[:-1] * 256
        pairs += flat[1:]
        total = sum(t.shape[2] for t in self.taps)
        best = np.empty((n, total), dtype=np.float32)
        where = np.empty((n, total), dtype=np.int32) if places else None
        out, part, column = np.empty(cells, dtype=np.float32), np.empty(cells, dtype=np.float32), 0
        for tables in self._tables:
            for f in range(tables[0][1].shape[0]):
                for k, (offset, table) in enumerate(tables):
                    into = out if k == 0 else part
                    np.take(table[f], pairs[offset:offset + cells], out=into, mode="clip")
                    if k:
                        out += part
                grid = out.reshape(n, span)[:, :length]
                if places:
                    where[:, column] = grid.argmax(axis=1)
                    best[:, column] = grid[np.arange(n), where[:, column]]
                else:
                    grid.max(axis=1, out=best[:, column])
                column += 1
        return (best, where) if places else best

    def gradients(self, chunks: np.ndarray, where: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """What ``slope`` (by chunk and filter) means for the taps: only the maxima pass it on."""
        result, column, rows = [], 0, np.arange(len(chunks))[:, None]
        for t in self.taps:
            width, _, filters = t.shape
            grad = np.zeros_like(t)
            at, s = where[:, column:column + filters], slope[:, column:column + filters]
            names = np.broadcast_to(np.arange(filters), at.shape).ravel()
            for k in range(width):
                cell = chunks[rows, at + k].astype(np.int64).ravel() * filters + names
                grad[k] = np.bincount(cell, weights=s.ravel(), minlength=256 * filters).reshape(256, filters)
            result.append(grad)
            column += filters
        return result


def fresh_taps(widths: dict[int, int], seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [rng.normal(0, 0.15, (w, 256, n)).astype(np.float32) for w, n in widths.items()]


class Adam:
    """Adam steps over a list of arrays, in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float) -> None:
        self.arrays, self.rate, self.steps = arrays, rate, 0
        self.first = [np.zeros_like(a) for a in arrays]
        self.second = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        for a, g, m, v in zip(self.arrays, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)
