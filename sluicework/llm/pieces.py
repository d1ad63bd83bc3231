"""SentencePiece encoding and decoding with the N best segmentations.

The piece lattice of a text falls into units: no piece crosses the place before a word's space mark,
nor a line feed. Within a unit, forward Viterbi scores are exact heuristics for a backward A* search:
it expands only what lies on the best paths, and paths come out in order of their score. For all
different units of a block the forward and backward scores are computed together in numpy; they tell
by how much each unit's second path falls behind. A document's N best segmentations differ from the
best one only in units with the N - 1 smallest such gaps, so only those are searched and merged, by
the same best-first rule.

A path's score is the sum of its pieces' scores in the model. A character without a piece is spelled
in byte pieces, each ``PENALTY`` below the lowest score. Ties go to the path whose last differing piece
is shorter.

Defined results: NULL counts as empty; an empty text has no pieces, score 0 and one segmentation.
Decoding gives the text back, but for U+2581, which the model itself writes for a space. A unit longer
than ``LONG`` characters is handled alone, whatever its length.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from sluicework.llm.texts import blocks, widened

MARK = "▁"
PENALTY = 10.0
LONG = 32
N_BEST = 3
NAMES = ("piece_ids", "n_best_scores", "decoded")
#: Units kept per worker; beyond, the table starts anew.
UNITS_KEPT = 200_000
#: Units whose lattices are laid out together.
TOGETHER = 2_000
BLOCK = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a model with their scores, for single units and for many at once."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.raw: list[bytes] = [b""] * n
        self.ids: dict[str, int] = {}
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.scores = np.zeros(n)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.raw[i] = bytes([int(piece[3:5], 16)])
                self.byte_ids[self.raw[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.raw[i] = piece.replace(MARK, " ").encode()
                self.ids[piece] = i
                self.scores[i] = model.get_score(i)
        usual = [self.scores[i] for i in self.ids.values() if self.scores[i] > -1e8]
        self.spelled = min(usual, default=0.0) - PENALTY
        self.longest = max(map(len, self.ids), default=1)
        hashes = [self._hashes(p) for p in self.ids]
        keys = np.array([h[-1] for h in hashes], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.ids.values()), dtype=np.int64)[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        # What no piece starts with need not be read on
        self.begun = np.zeros(1 << 20, dtype=bool)
        self.begun[(np.array([x for h in hashes for x in h[:-1]], dtype=np.uint64) >> np.uint64(44)).astype(np.int64)] = True
        self.sizes = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)

    @staticmethod
    def _hashes(piece: str) -> list[int]:
        """The hashes of all beginnings of a piece, the whole piece last."""
        h, found = 0, []
        for c in piece:
            h = (h ^ (ord(c) + 1)) * int(MIX) % 2**64
            h ^= h >> 29
            found.append(h)
        return found

    def arcs(self, unit: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end the arcs into it: (start, ids, score), shortest first."""
        result: list[list[tuple[int, tuple[int, ...], float]]] = [[]]
        for end in range(1, len(unit) + 1):
            into = []
            for length in range(1, min(self.longest, end) + 1):
                i = self.ids.get(unit[end - length:end])
                if i is not None:
                    into.append((end - length, (i,), self.scores[i]))
                elif length == 1:
                    spelled = unit[end - 1].encode(errors="surrogatepass")
                    into.append((end - 1, tuple(int(self.byte_ids[b]) for b in spelled), self.spelled * len(spelled)))
            result.append(into)
        return result

    def n_best(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths of a unit: forward Viterbi, then A* from the end."""
        arcs = self.arcs(unit)
        ahead = [0.0] + [-np.inf] * len(unit)
        for end in range(1, len(unit) + 1):
            ahead[end] = max(ahead[start] + score for start, _, score in arcs[end])
        found, order = [], itertools.count()
        # (minus the best score of any path through it, minus its age, place, score of what is behind,
        # pieces behind): among ties the newest first, so that equal paths are not all opened side by side
        heap = [(-ahead[len(unit)], -next(order), len(unit), 0.0, None)]
        while heap and len(found) < n:
            _, _, place, behind, tail = heapq.heappop(heap)
            if place == 0:
                ids: list[int] = []
                while tail is not None:
                    ids.extend(tail[0])
                    tail = tail[1]
                found.append((behind, tuple(ids)))
                continue
            for start, ids_, score in reversed(arcs[place]):
                heapq.heappush(heap, (-(ahead[start] + score + behind), -next(order), start, score + behind, (ids_, tail)))
        return found

    def _arcs_of_many(self, codes: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """For units of one length, as rows of characters: (start, end) to each unit's piece (or -1) and its score."""
        m, n = codes.shape
        # All places of all units are read on together, one character a step
        flat = np.ascontiguousarray(codes.T).ravel()
        open_, h = np.arange(m * n), np.zeros(m * n, dtype=np.uint64)
        arcs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for length in range(1, min(self.longest, n) + 1):
            fits = (n - length + 1) * m
            inside = int(np.searchsorted(open_, fits))
            open_ = open_[:inside]
            h = (h[:inside] ^ (flat[open_ + (length - 1) * m] + np.uint64(1))) * MIX
            h ^= h >> np.uint64(29)
            spot = (h >> np.uint64(44)).astype(np.int64)
            hit = np.flatnonzero(self.maybe[spot])
            at = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
            same = self.keys[at] == h[hit]
            found, where = self.key_ids[at[same]], open_[hit[same]]
            if length == 1 or len(found):
                ids, score = np.full(fits, -1, dtype=np.int32), np.full(fits, -np.inf)
                ids[where], score[where] = found, self.scores[found]
                if length == 1:
                    score = np.where(ids < 0, self.spelled * _width(flat), score)
                ids, score = ids.reshape(-1, m), score.reshape(-1, m)
                for start in range(n) if length == 1 else np.unique(where // m).tolist():
                    arcs[start, start + length] = (ids[start], score[start])
            on = self.begun[spot]
            h, open_ = h[on], open_[on]
            if not len(open_):
                break
        return arcs

    def paths_of_many(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For units of one length: the best paths' ids one after the other, how many each has, and the
        scores of the best and the second path."""
        m, n = len(units), len(units[0])
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(m, n).astype(np.uint64)
        arcs = self._arcs_of_many(codes)
        ahead, step = np.full((n + 1, m), -np.inf), np.zeros((n + 1, m), dtype=np.int32)
        taken = np.full((n + 1, m), -1, dtype=np.int32)
        ahead[0] = 0
        for end in range(1, n + 1):
            for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
                if (start, end) in arcs:
                    ids, score = arcs[start, end]
                    total = ahead[start] + score
                    better = total > ahead[end]
                    ahead[end][better], step[end][better], taken[end][better] = total[better], start, ids[better]
        after = np.full((n + 1, m), -np.inf)
        after[n] = 0
        for start, end in sorted(arcs, reverse=True):
            np.maximum(after[start], arcs[start, end][1] + after[end], out=after[start])
        on_best = np.zeros((n + 1, m), dtype=bool)
        on_best[n] = True
        for end in range(n, 0, -1):
            rows = np.flatnonzero(on_best[end])
            on_best[step[end][rows], rows] = True
        # The second path has an arc that the best one lacks
        second = np.full(m, -np.inf)
        for (start, end), (_, score) in arcs.items():
            through = ahead[start] + score + after[end]
            used = on_best[end] & (step[end] == start)
            np.maximum(second, np.where(used, -np.inf, through), out=second)
        on = on_best[1:].T
        rows, ends = np.nonzero(on)
        path = taken[1:].T[on].astype(np.int64)
        # A character without a piece is spelled in bytes
        sizes = np.where(path < 0, _width(codes[rows, ends]), 1)
        spelled = np.flatnonzero(path < 0)
        path = np.repeat(path, sizes)
        places = np.cumsum(sizes) - sizes
        for i in spelled.tolist():
            raw = units[rows[i]][ends[i]].encode(errors="surrogatepass")
            path[places[i]:places[i] + len(raw)] = self.byte_ids[list(raw)]
        return path, np.bincount(rows, weights=sizes, minlength=m).astype(np.int64), ahead[n], second

    def best_of_many(self, units: list[str]) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
        """For units of one length: the best path's ids, its score, and the second path's score."""
        path, sizes, best, second = self.paths_of_many(units)
        cuts = np.r_[0, np.cumsum(sizes)].tolist()
        return [tuple(path[a:b].tolist()) for a, b in itertools.pairwise(cuts)], best, second

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The text of every run of ids, without the space that encoding puts before a text."""
        sizes = self.sizes[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.bytes[np.repeat(self.begins[ids] - total[:-1], sizes) + np.arange(total[-1])]
        return [flat[total[a]:total[b]].tobytes()[1:] for a, b in itertools.pairwise(starts)]


class Segmenter:
    """Best segmentation, second scores and N best lists of whole texts."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.flat, self.used = np.zeros(0, dtype=np.int32), 0
        self.starts = self.sizes = np.zeros(0, dtype=np.int64)
        self.best = self.gap = np.zeros(0)
        self.lists: dict[tuple[int, int], list] = {}

    def _learn(self, raw: list[bytes]) -> None:
        by_length: dict[int, list[int]] = {}
        units = [r.decode(errors="surrogatepass").replace(" ", MARK) for r in raw]
        order: list[int] = []
        parts: list[tuple] = [(self.flat[:self.used], self.sizes, self.best, self.gap)]
        for i, unit in enumerate(units):
            if len(unit) > LONG:
                two = self.pieces.n_best(unit, 2)
                best, path = two[0]
                gap = best - two[1][0] if len(two) > 1 else np.inf
                parts.append((np.array(path, dtype=np.int64), np.array([len(path)]), np.array([best]), np.array([gap])))
                order.append(i)
            else:
                by_length.setdefault(len(unit), []).append(i)
        for places in by_length.values():
            for a in range(0, len(places), TOGETHER):
                part = places[a:a + TOGETHER]
                path, sizes, best, second = self.pieces.paths_of_many([units[i] for i in part])
                parts.append((path, sizes, best, best - second))
                order.extend(part)
        flat, self.sizes, self.best, self.gap = map(np.concatenate, zip(*parts, strict=True))
        self.starts, self.used = np.cumsum(self.sizes) - self.sizes, len(flat)
        self.flat = flat.astype(np.int32)
        for i in order:
            self.slots[raw[i]] = len(self.slots)
            self.names.append(raw[i])

    def encode(self, data: np.ndarray, at: np.ndarray):
        """Ids of all rows, where each row's start, and the units (slots) of all rows, likewise."""
        if len(self.slots) > UNITS_KEPT:
            self._forget()
        filled = np.flatnonzero(at[1:] > at[:-1])
        data = np.insert(data, at[:-1][filled], 32)
        at = at + np.concatenate([[0], np.cumsum(at[1:] > at[:-1])])
        none = np.zeros(len(at), dtype=np.int64)
        if not len(data):
            return np.zeros(0, dtype=np.int32), none, np.zeros(0, dtype=np.int64), none
        space, feed = data == 32, data == 10
        cut = feed.copy()
        cut[1:] |= feed[:-1]
        cut[1:] |= space[1:] & ~space[:-1]
        cut[at[:-1][filled]] = True
        cuts = np.flatnonzero(cut)
        ends = np.r_[cuts, len(data)].astype(np.int32)
        units = pa.Array.from_buffers(
            pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        raw = units.dictionary.to_pylist()
        if missing := [r for r in raw if r not in self.slots]:
            self._learn(missing)
        slots = np.array([self.slots[r] for r in raw], dtype=np.int64)[units.indices.to_numpy()]
        lengths = self.sizes[slots]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[slots] - total[:-1], lengths) + np.arange(total[-1])]
        rows = np.searchsorted(cuts, at)
        return ids, total[rows], slots, rows

    def path(self, slot: int) -> tuple[int, ...]:
        """The ids of a unit's best path."""
        return tuple(self.flat[self.starts[slot]:self.starts[slot] + self.sizes[slot]].tolist())

    def _list(self, slot: int, n: int) -> list[tuple[float, tuple[int, ...]]]:
        if (slot, n) not in self.lists:
            unit = self.names[slot].decode(errors="surrogatepass").replace(" ", MARK)
            self.lists[slot, n] = self.pieces.n_best(unit, n)
        return self.lists[slot, n]

    def n_best(self, slots: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, int]]]]:
        """The ``n`` best segmentations of the text of these units: total score and the changes.

        A change is (place of the unit, rank of its path); the best segmentation has none.
        """
        gaps, best = self.gap[slots], float(self.best[slots].sum())
        few = np.lexsort((np.arange(len(gaps)), gaps))[:n - 1] if len(gaps) <= n - 1 else _smallest(gaps, n - 1)
        few = [int(i) for i in few if np.isfinite(gaps[i])]
        lists = [self._list(int(slots[i]), n) for i in few]
        start = (0,) * len(few)
        heap, seen, found = [(0.0, start)], {start}, []
        while heap and len(found) < n:
            behind, ranks = heapq.heappop(heap)
            found.append((best - behind, [(few[k], r) for k, r in enumerate(ranks) if r]))
            for k, r in enumerate(ranks):
                after = (*ranks[:k], r + 1, *ranks[k + 1:])
                if r + 1 < len(lists[k]) and after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (behind + lists[k][r][0] - lists[k][r + 1][0], after))
        return found

    def ids_with(self, slots: np.ndarray, changes: list[tuple[int, int]], n: int) -> list[int]:
        """The ids of a segmentation that :meth:`n_best` gave."""
        ranks = dict(changes)
        ids: list[int] = []
        for place, slot in enumerate(slots):
            ids.extend(self._list(int(slot), n)[ranks[place]][1] if place in ranks else self.path(slot))
        return ids


def _width(codes: np.ndarray) -> np.ndarray:
    """How many bytes of UTF-8 each character has."""
    return 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)


@functools.lru_cache(maxsize=1)
def worker_segmenter(path: str) -> Segmenter:
    """One segmenter per Python worker, so that its tasks share the units."""
    return Segmenter(path)


def _smallest(gaps: np.ndarray, k: int) -> np.ndarray:
    edge = np.partition(gaps, k - 1)[k - 1]
    chosen = np.flatnonzero(gaps <= edge)
    return chosen[np.lexsort((chosen, gaps[chosen]))][:k]


def encoded(docs: DataFrame, path: str, n: int = N_BEST, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Every row with ``piece_ids`` (the best segmentation), ``n_best_scores`` and ``decoded``.

    Their names must be new among the columns.
    """
    schema = widened(docs.schema, **dict(zip(names, ("array<int>", "array<double>", "string"), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = worker_segmenter(path)
        for batch, data, at in blocks(batches, limit=BLOCK):
            ids, starts, slots, rows = segmenter.encode(data, at)
            scores = [[s for s, _ in segmenter.n_best(slots[a:b], n)] for a, b in itertools.pairwise(rows)]
            back = [x.decode(errors="replace") for x in segmenter.pieces.decode(ids, starts)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))),
                pa.array(scores, pa.list_(pa.float64())), pa.array(back, pa.string()),
            ], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, path: str, n: int = N_BEST) -> DataFrame:
    """Per document: pieces, checksum of the best ids, the N best scores, and whether decoding gives the text back."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = worker_segmenter(path)
        for batch, data, at in blocks(batches, limit=BLOCK):
            ids, starts, slots, rows = segmenter.encode(data, at)
            wide = ids.astype("<u4")
            back = segmenter.pieces.decode(ids, starts)
            scores = [[s for s, _ in segmenter.n_best(slots[a:b], n)] for a, b in itertools.pairwise(rows)]
            crc = [zlib.crc32(wide[a:b].tobytes()) for a, b in itertools.pairwise(starts)]
            same = [t == data[a:b].tobytes() for t, (a, b) in zip(back, itertools.pairwise(at), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(starts)), pa.array(crc, pa.int64()),
                pa.array(scores, pa.list_(pa.float64())), pa.array(same, pa.bool_()),
            ], names=["doc_id", "n_pieces", "ids_crc32", "n_best_scores", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces long, ids_crc32 long, n_best_scores array<double>, round_trip boolean")
