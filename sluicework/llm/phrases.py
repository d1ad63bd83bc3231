"""Phrase collocations by Rabin-Karp fingerprints.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words. Within a
block of texts numpy builds prefix polynomials over the words' hashes, so the fingerprint of every run of
1 to 5 words is a difference of two prefixes times an inverse power.

1. Runs of 1 and 2 words are counted by the high bits of their fingerprint, their cell: every block sends
   its cells, packed by chunk, and the chunks are added up. A run found ``least`` times lies in a cell of
   at least that. The number of cells follows the bytes of text, and a task holds one chunk at a time.
2. The same for runs of 3 to 5 words, of which only those count whose pairs' cells are all that high.
3. Fingerprints with such cells are counted per block and shuffled as (language, words, fingerprint, count,
   pointer to the first occurrence). What is frequent then is known by fingerprint.
4. Occurrences of those are verified against the text: within a block equal fingerprints must have equal
   words (others are counted apart), and across blocks the words themselves are the key. Only here, and
   only for these, phrases become strings. So the counts are exact, whatever collides.

What is frequent goes back to the tasks as bits, about 16 per entry and 16 MiB at most. Beyond that
more falls through to the shuffles of steps 3 and 4, never out of the result.

Defined results: a NULL text is empty, a NULL language is ``und``. Repeated rows count as often as they
are there. A NULL id matters only to the pointer. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.components import bounded, written
from sluicework.llm.texts import blocks, mixed, span_hashes
from sluicework.operators.matching import join_per_key

LONGEST, LEAST, FIRST = 5, 100, 2000
BLOCK = 2 << 20
#: Languages up to this many are broadcast with their numbers of words.
MANY_LANGUAGES = 10_000
#: Cells: about one for so many bytes of text; the least and greatest power of two, and of a chunk's.
BYTES_A_CELL, FEWEST, MOST, SMALL_CHUNK, CHUNKS = 4, 20, 38, 18, 16
#: The power of two of the bits that go to every task, at least and at most.
LEAST_BITS, MOST_BITS = 16, 27
#: Fixed value: the bits of one of Spark's bitmaps.
BITMAP = 1 << 15
# What separates words, and pieces.
WORD_ENDS, PIECE_ENDS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, dtype=np.uint8)
KIND[list(WORD_ENDS)], KIND[list(PIECE_ENDS)] = 1, 2

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Words:
    """The words of a block of texts: an exact number and a hash of each, its piece, row and place."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        data = LOWER[data]
        kind = KIND[data]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = at[1:-1][at[1:-1] < len(data)]
        first[cuts] |= inside[cuts]
        starts = np.flatnonzero(first)
        # Without what separates them the words lie side by side
        ends = np.r_[np.cumsum(inside)[starts] - 1, np.count_nonzero(inside)].astype(np.int32)
        packed = np.ascontiguousarray(data[inside])
        found = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(packed)]).dictionary_encode()
        self.ids = found.indices.to_numpy()
        self.dictionary = found.dictionary
        _, offsets, known = found.dictionary.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int32)[:len(found.dictionary) + 1].astype(np.int64) if len(starts) else np.zeros(1, np.int64)
        known = np.frombuffer(known, dtype=np.uint8) if known is not None else np.zeros(0, np.uint8)
        self.hashes = span_hashes(known, offsets[:-1], offsets[1:])
        self.rows = np.searchsorted(at, starts, side="right") - 1
        self.places = starts - at[self.rows]
        # Both only grow, so their sum tells the pieces apart
        self.pieces = np.cumsum(kind == 2)[starts] + self.rows

    def fingerprints(self, salts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length: where its runs start, and their fingerprints; ``salts`` has one number a row."""
        n = len(self.ids)
        steps = np.full(n, BASE, dtype=np.uint64)
        steps[:1] = 1
        back = np.full(n, INVERSE, dtype=np.uint64)
        back[:1] = 1
        prefix = np.r_[np.uint64(0), np.cumsum(self.hashes[self.ids] * np.cumprod(steps))]
        back = np.cumprod(back)
        own = salts[self.rows]
        for length in range(1, LONGEST + 1):
            last = n - length + 1
            if last <= 0:
                return
            whole = np.flatnonzero(self.pieces[:last] == self.pieces[length - 1:])
            value = (prefix[whole + length] - prefix[whole]) * back[whole]
            yield length, whole, mixed((value ^ own[whole]) + np.uint64(length))

    def texts(self, places: np.ndarray, length: int) -> pa.Array:
        """The runs of words from these places on, joined by single spaces."""
        ids = self.ids[places[:, None] + np.arange(length)].ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(places) + 1) * length, pa.int32()), self.dictionary.take(pa.array(ids)))
        return pc.binary_join(lists, b" ").cast(pa.string())


def _salts(batch: pa.RecordBatch) -> np.ndarray:
    names = batch.column("lang").dictionary_encode()
    known = [x.encode() for x in names.dictionary.to_pylist()]
    offsets = np.cumsum([0, *map(len, known)])
    data = np.frombuffer(b"".join(known), dtype=np.uint8)
    return span_hashes(data, offsets[:-1], offsets[1:], seed=7)[names.indices.to_numpy()]


class Marks:
    """Frequent cells or fingerprints as bits. What has no bit is not frequent."""

    def __init__(self, bits: np.ndarray, shift: int) -> None:
        self.bits, self.shift, self.mask = bits, np.uint64(shift), np.uint64(8 * len(bits) - 1)

    def has(self, prints: np.ndarray) -> np.ndarray:
        spot = (prints >> self.shift & self.mask).astype(np.int64)
        return (self.bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def passed(words: Words, salts: np.ndarray, marks: dict[int, Marks]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The runs that may be frequent: they are marked, as far as there are marks, and so are both shorter runs in them."""
    before = None
    for length, whole, prints in words.fingerprints(salts):
        alive = marks[length].has(prints) if length in marks else np.ones(len(whole), dtype=bool)
        if before is not None:
            alive &= before[whole] & before[whole + 1]
        before = np.zeros(len(words.ids) + 1, dtype=bool)
        before[whole[alive]] = True
        yield length, whole[alive], prints[alive]


def _sizes(text_bytes: int) -> tuple[int, int]:
    """The powers of two of the cells, and of the cells in a chunk."""
    cells = min(max((text_bytes // BYTES_A_CELL).bit_length(), FEWEST), MOST)
    return cells, max(SMALL_CHUNK, cells - CHUNKS)


def _cells(cells: int, chunk: int, marks: dict[int, Marks], lengths: tuple[int, ...], least: int):
    """Per block the cells in use, as (chunk, places and counts in it)."""
    down, inside = np.uint64(64 - cells), np.uint64((1 << chunk) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches, limit=BLOCK):
            words = Words(data, at)
            found = [prints >> down for length, _, prints in passed(words, _salts(batch), marks) if length in lengths]
            used, counts = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            counts = np.minimum(counts, least).astype(np.uint8)
            of = (used >> np.uint64(chunk)).astype(np.int64)
            places = (used & inside).astype("<u4")
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
            ends = np.r_[cuts, len(of)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(of[cuts]), _spans(places, ends, 4), _spans(counts, ends, 1)], names=["chunk", "places", "counts"])

    return run


def _spans(values: np.ndarray, ends: np.ndarray, width: int) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends * np.int32(width)), pa.py_buffer(np.ascontiguousarray(values))])


def _added(chunk: int, least: int):
    """The cells whose added counts reach ``least``; a chunk's rows come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(1 << chunk, dtype=np.uint8)

        def close() -> pa.RecordBatch:
            full = np.flatnonzero(sums >= least) + (now << chunk)
            sums[:] = 0
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64))], names=["cell"])

        for batch in batches:
            for i, of in enumerate(batch.column("chunk").to_pylist()):
                if of != now:
                    if now is not None:
                        yield close()
                    now = of
                places = np.frombuffer(batch.column("places")[i].as_buffer(), dtype="<u4")
                counts = np.frombuffer(batch.column("counts")[i].as_buffer(), dtype=np.uint8)
                # Places are different within a row
                sums[places] = np.minimum(sums[places].astype(np.uint16) + counts, least)
        if now is not None:
            yield close()

    return run


def _marks(values: DataFrame, shift: int) -> Marks:
    """The marks of a column ``cell``: at most ``2**MOST_BITS`` bits."""
    power = min(max((16 * values.count()).bit_length(), LEAST_BITS), MOST_BITS)
    spot = F.col("cell").bitwiseAND(F.lit((1 << power) - 1)) + 1
    maps = values.select(F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit"))
    bits = np.zeros((1 << power) // 8, dtype=np.uint8)
    for row in maps.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        start = (row["bucket"] - 1) * BITMAP // 8
        bits[start:start + BITMAP // 8] = np.frombuffer(row["bits"], dtype=np.uint8)[:len(bits) - start]
    return Marks(bits, shift)


def _frequent_cells(texts: DataFrame, sizes: tuple[int, int], marks: dict[int, Marks], lengths: tuple[int, ...], least: int) -> dict[int, Marks]:
    cells, chunk = sizes
    sent = texts.mapInArrow(_cells(cells, chunk, marks, lengths, least), "chunk long, places binary, counts binary")
    full = written(
        sent.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_added(chunk, least), "cell long"), "cells")
    return dict.fromkeys(lengths, _marks(full, 64 - cells))


def _pointed(marks: dict[int, Marks], names: list[str]):
    """Per block and fingerprint: its count, and its first occurrence as document and byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches, limit=BLOCK):
            words = Words(data, at)
            for length, whole, prints in passed(words, _salts(batch), marks):
                found, first, counts = np.unique(prints, return_index=True, return_counts=True)
                spots = whole[first]
                rows = pa.array(words.rows[spots])
                yield pa.RecordBatch.from_arrays([
                    batch.column("lang").take(rows), pa.array(np.full(len(found), length, dtype=np.int32)),
                    pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64)),
                    batch.column("doc_id").take(rows), pa.array(words.places[spots]),
                ], names=names)

    return run


def _verified(marks: dict[int, Marks], names: list[str]):
    """Per block: the words of the passed runs and their counts, and as length 0 all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in blocks(batches, limit=BLOCK):
            words, salts = Words(data, at), _salts(batch)
            per_row = np.bincount(words.rows, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), pa.array(np.zeros(len(per_row), dtype=np.int32)),
                pa.array([""] * len(per_row), pa.string()), pa.array(per_row)], names=names)
            for length, whole, prints in passed(words, salts, marks):
                _, first, group = np.unique(prints, return_index=True, return_inverse=True)
                head = whole[first][group]
                same = np.ones(len(whole), dtype=bool)
                for j in range(length):
                    same &= words.ids[whole + j] == words.ids[head + j]
                same &= salts[words.rows[whole]] == salts[words.rows[head]]
                counts = np.bincount(group[same], minlength=len(first)).astype(np.int64)
                # What shares a fingerprint with other words counts by itself
                spots = np.r_[whole[first], whole[~same]]
                counts = np.r_[counts, np.ones(np.count_nonzero(~same), dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("lang").take(pa.array(words.rows[spots])), pa.array(np.full(len(spots), length, dtype=np.int32)),
                    words.texts(spots, length), pa.array(counts),
                ], names=names)

    return run


def frequent(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, length, phrase, f)``: every run of 1 to 5 words found ``least`` times or more in its language.

    Rows of length 0 have the number of all words of a language. docs: ``(doc_id, text, lang)``; ``least``
    is 255 at most.
    """
    texts = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    sizes = _sizes(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    marks = _frequent_cells(texts, sizes, {}, (1, 2), least)
    marks |= _frequent_cells(texts, sizes, marks, (3, 4, 5), least)
    names = ["lang", "length", "print", "n", "doc_id", "at"]
    kind = texts.schema["doc_id"].dataType.simpleString()
    pointed = texts.mapInArrow(
        _pointed(marks, names), f"lang string, length int, print long, n long, doc_id {kind}, at long")
    prints = written(
        pointed.groupBy("lang", "length", "print").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "at")).alias("first"))
        .filter(F.col("n") >= least), "prints")
    marks = dict.fromkeys(range(1, LONGEST + 1), _marks(prints.select(F.col("print").alias("cell")), 0))
    names = ["lang", "length", "phrase", "f"]
    found = texts.mapInArrow(_verified(marks, names), "lang string, length int, phrase string, f long")
    return written(
        found.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f"))
        .filter((F.col("f") >= least) | (F.col("length") == 0)), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the phrases of several words that no longer one covers."""
    several = phrases.filter("length >= 2").select("lang", "length", "phrase", F.col("f").alias("a"))
    # A longer phrase as frequent as one in it is at every step between them: one word more is enough
    words = F.split("phrase", " ")
    parts = several.filter("length >= 3").select("lang", F.col("a").alias("by"), F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("length") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("length") - 1), " "))).alias("phrase"))
    covers = parts.groupBy("lang", "phrase").agg(F.max("by").alias("by"))
    kept = written(join_per_key(several, covers, ["lang", "phrase"]).filter("by is null or by < a").drop("by"), "kept")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("rest"))
    known = phrases.filter("length > 0").select("lang", "phrase", "f")
    totals = bounded(phrases.filter("length = 0").select("lang", F.col("f").alias("n")), MANY_LANGUAGES)
    cuts = (
        cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
    )
    # 38 digits hold both products; the quotient is below 1000 times n
    value = F.expr("(cast(1000 * a as decimal(18, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(19, 0)))")
    lowest = cuts.withColumn("score", value).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """Each language's ``first`` phrases of 2 to 5 words by score, count and phrase.

    Columns ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (its count), ``l`` and ``r`` (the counts of the
    two parts of its lowest-scoring cut), ``n`` (the words of the language), ``score``.
    """
    by = [F.desc("score"), F.desc("a"), "phrase"]
    found = scored(frequent(docs, least)).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    # First within parts of a language, so that none is ranked whole in one task
    for keys in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= first)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
