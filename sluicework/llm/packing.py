"""Packing documents into windows by the online sum-of-squares rule.

A document is its token ids and an end id. Full windows are cut off its front; the rest goes whole into the
window whose fill level makes the sum of the squared numbers of partly filled windows, level by level,
smallest (a new window is level 0). The numbers are kept in an array over the levels, so a placement
looks at the levels in use and at nothing else. Every task packs the documents of its partition in their
order; nothing is shuffled.

Pieces of open windows are held until the window is full. When ``OPEN`` windows are open, and at the end,
they are settled: the emptiest ones are cut to fill the fullest, until less than one window is left. What is
left at the end fills windows of a power of two each, which need no padding, so nothing is padded.

Defined results: a NULL text is empty, an empty document has the end id alone. Repeated rows and rows with
a NULL id are documents of their own. A very long text is cut into many windows. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sluicework.llm.texts import blocks
from sluicework.llm.token_files import worker_encoder

WINDOW, END = 4096, 2
#: Windows open at once in a task, at most 16 KiB each.
OPEN = 2048
BLOCK = 4 << 20
NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


class Piece:
    """Ids ``start`` to ``start + len(ids)`` of a document; ``doc`` is whatever tells the document."""

    __slots__ = ("doc", "start", "ids")

    def __init__(self, doc: object, start: int, ids: np.ndarray) -> None:
        self.doc, self.start, self.ids = doc, start, ids

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:length]), Piece(self.doc, self.start + length, self.ids[length:])


class Packer:
    """Windows of one task; ``place`` and ``finish`` give the windows that are done, as lists of pieces."""

    def __init__(self, window: int = WINDOW, limit: int = OPEN) -> None:
        self.window, self.limit, self.open = window, limit, 0
        self.level = np.zeros(window + 1, dtype=np.int64)
        self.stacks: dict[int, list[list[Piece]]] = {}

    def choose(self, size: int) -> int:
        """The level whose window takes ``size`` more; 0 is a new window. Of equal ones the fullest."""
        used = np.flatnonzero(self.level[1:self.window - size + 1]) + 1
        best, cost = 0, 2 * int(self.level[size]) + 1
        if len(used):
            after = np.where(used + size < self.window, 2 * self.level[used + size] + 1, 0)
            costs = 1 - 2 * self.level[used] + after
            at = len(costs) - 1 - int(np.argmin(costs[::-1]))
            if costs[at] <= cost:
                best = int(used[at])
        return best

    def _take(self, level: int) -> list[Piece]:
        self.level[level] -= 1
        self.open -= 1
        return self.stacks[level].pop()

    def _put(self, level: int, pieces: list[Piece]) -> None:
        self.level[level] += 1
        self.open += 1
        self.stacks.setdefault(level, []).append(pieces)

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.window:
            full, piece = piece.cut(self.window)
            yield [full]
        if size := len(piece.ids):
            level = self.choose(size)
            pieces = self._take(level) if level else []
            # Held longer than its block, so it has its own memory
            pieces.append(Piece(piece.doc, piece.start, piece.ids.copy()))
            if level + size == self.window:
                yield pieces
            else:
                self._put(level + size, pieces)
        if self.open > self.limit:
            yield from self._settle()

    def _settle(self) -> Iterator[list[Piece]]:
        """Cuts the emptiest windows to fill the fullest until one is left."""
        windows = [(level, self._take(level)) for level in sorted(self.stacks) for _ in range(len(self.stacks[level]))]
        low = 0
        while low < len(windows) - 1:
            level, pieces = windows.pop()
            while level < self.window and low < len(windows):
                left, spare = windows[low]
                part = spare.pop()
                if len(part.ids) > self.window - level:
                    part, rest = part.cut(self.window - level)
                    spare.append(rest)
                pieces.append(part)
                level += len(part.ids)
                windows[low] = (left - len(part.ids), spare)
                if not spare:
                    low += 1
            if level == self.window:
                yield pieces
            else:
                self._put(level, pieces)
        for level, pieces in windows[low:]:
            self._put(level, pieces)

    def finish(self) -> Iterator[list[Piece]]:
        while self.open > 1:
            yield from self._settle()
        if self.open:
            level = next(n for n, stack in self.stacks.items() if stack)
            pieces = self._take(level)
            for bit in range(level.bit_length() - 1, -1, -1):
                if level >> bit & 1:
                    done, missing = [], 1 << bit
                    while missing:
                        part = pieces.pop(0)
                        if len(part.ids) > missing:
                            part, rest = part.cut(missing)
                            pieces.insert(0, rest)
                        done.append(part)
                        missing -= len(part.ids)
                    yield done


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """The pieces of every document: ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``.

    ``start`` counts the document's ids before the piece, ``offset`` the window's ids before it; ``ids`` is
    binary, little-endian unsigned 32-bit numbers. A sequence is known by its task and its number there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = worker_encoder(path), Packer(window)
        sequence = TaskContext.get().partitionId() << 32

        def rows(windows: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            columns: list[list] = [[] for _ in NAMES]
            for pieces in windows:
                offset = 0
                for p in pieces:
                    doc, total = p.doc
                    row = (doc, p.start, len(p.ids), total, sequence, offset, p.ids.astype("<u4").tobytes())
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += len(p.ids)
                sequence += 1
            types = [doc_type, *[pa.int64()] * 5, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

        for batch, data, at in blocks(batches, limit=BLOCK):
            ids, starts = encoder.encode(data, at)
            done: list[list[Piece]] = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[starts[i]:starts[i + 1]], np.uint32(end))
                done.extend(packer.place(Piece((doc, len(own)), 0, own)))
            yield from rows(done)
        yield from rows(list(packer.finish()))

    kind = docs.schema["doc_id"].dataType
    doc_type = to_arrow_type(kind)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
