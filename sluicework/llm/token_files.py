"""Token ids of documents in binary files: one zstandard frame per document, one shared dictionary.

The dictionary is trained on the serialized ids of a bounded sample of documents. A folder holds
``dictionary`` (its bytes), ``data/part-*.tok`` (frames of little-endian unsigned 32-bit ids, one after
the other) and ``index`` (Parquet: document, file, offset and length of its frame, number of ids, ids
before it in the file, hash of the dictionary). A short document is one small read by its index row;
a file is bound to its dictionary by the hash.

Encoding goes by word: the tokenizer drops white space and never looks across it, nor from an ASCII
letter to a stop after it, so each different word is encoded once per worker and the ids are gathered.
Words of ASCII alone are the same in either case, which the tokenizer folds, unless they may hold a
special token.

Defined results: a NULL text is empty; an empty document holds the end id alone. Documents are in
ascending order of id (NULL first), repeated rows side by side by text. An empty table gives an empty
index. A sample too small for training gives files without a dictionary and an empty hash.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicework.llm.texts import IS_SPACE, blocks

END = 1
LEVEL = 3
#: The dictionary's size, and the sample it is trained on: documents, and characters of each.
DICTIONARY, SAMPLE, SAMPLE_CHARS = 32_768, 600, 6_000
#: Words kept per worker; beyond, the table starts anew. New words are encoded so many at a time.
WORDS_KEPT, TOGETHER = 600_000, 512
BLOCK = 4 << 20
#: A word also ends where one of these follows a letter (all ASCII: no special token has the like).
STOPS = b".,;:!?)"

IS_LETTER, IS_STOP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
IS_STOP[list(STOPS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of words that stay as they are: what is not ASCII, and what every special token holds
KEEPS_CASE = np.arange(256) >= 128
KEEPS_CASE[ord("|")] = True

# What the tokenizer takes as one run, in ASCII, and how the last token of a run ends.
RUN, RUN_END = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"), "</w>"


class Encoder:
    """The ids of texts, word by word, with a table of the words seen."""

    def __init__(self, path: str) -> None:
        # Spark's tasks are the parallelism
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_run = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_run[[i for token, i in vocabulary.items() if token.endswith(RUN_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.binary())
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts, self.used = [np.zeros(0, dtype=np.int64)], 0
        self.lengths = [np.zeros(0, dtype=np.int64)]

    def _ids_of_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of ASCII words, and how many each word has; None if that can't be told from the ids."""
        # Without offsets encoding is faster. A run of letters, a digit, or a run of other signs ends in a
        # token that says so; their number in a word is known from its characters
        joined = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids
        fresh = np.array(joined, dtype=np.uint32)
        last = np.flatnonzero(self.ends_run[fresh])
        runs = np.cumsum(np.fromiter((len(RUN.findall(t)) for t in texts), dtype=np.int64, count=len(texts)))
        if len(last) != runs[-1] or last[-1] != len(fresh) - 1:
            return None
        return fresh, np.diff(last[runs - 1], prepend=-1)

    def _ids_of_any(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: a token's first character tells its word."""
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        fresh = np.array(found.ids, dtype=np.uint32)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(fresh))[::2]
        return fresh, np.bincount(np.searchsorted(first, at, side="right") - 1, minlength=len(texts))

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Adds the words to the table and gives their places in it."""
        texts = [w.decode() for w in words.to_pylist()]
        plain = np.fromiter((t.isascii() and "|" not in t for t in texts), dtype=bool, count=len(texts))
        order = []
        for kind in (True, False):
            places = np.flatnonzero(plain == kind)
            for i in range(0, len(places), TOGETHER):
                some = places[i:i + TOGETHER]
                chosen = [texts[j] for j in some.tolist()]
                found = self._ids_of_plain(chosen) if kind else None
                fresh, lengths = found or self._ids_of_any(chosen)
                while self.used + len(fresh) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
                self.flat[self.used:self.used + len(fresh)] = fresh
                self.starts.append(self.used + np.cumsum(lengths) - lengths)
                self.lengths.append(lengths)
                self.used += len(fresh)
                order.append(some)
        learned = np.concatenate(order)
        slots = np.empty(len(learned), dtype=np.int64)
        slots[learned] = len(self.words) + np.arange(len(learned))
        self.words = pa.concat_arrays([self.words, words.take(pa.array(learned))])
        self.starts, self.lengths = [np.concatenate(self.starts)], [np.concatenate(self.lengths)]
        return slots

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of a block, and where each row's ids start."""
        if len(self.words) > WORDS_KEPT:
            self._forget()
        inside = ~IS_SPACE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[1:] |= IS_LETTER[data[:-1]] & IS_STOP[data[1:]]
        edges = at[:-1][at[:-1] < len(data)]
        first[edges] |= inside[edges]
        cuts = np.flatnonzero(first)
        if not len(cuts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(at), dtype=np.int64)
        # Without white space the words lie side by side
        packed = data[inside]
        ends = np.r_[np.cumsum(inside)[cuts] - 1, len(packed)].astype(np.int32)
        folded = ~np.logical_or.reduceat(KEEPS_CASE[packed], ends[:-1])
        packed = np.where(np.repeat(folded, np.diff(ends)), LOWER[packed], packed)
        units = pa.Array.from_buffers(
            pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(packed)]).dictionary_encode()
        slots = pc.index_in(units.dictionary, value_set=self.words)
        missing = slots.is_null()
        slots = slots.fill_null(0).to_numpy().astype(np.int64)
        if missing.true_count:
            slots[missing.to_numpy(zero_copy_only=False)] = self._learn(units.dictionary.filter(missing))
        slot = slots[units.indices.to_numpy()]
        lengths = self.lengths[0][slot]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[0][slot] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[np.searchsorted(cuts, at)]


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder per Python worker, so that its tasks share the words."""
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary from the ids of the sampled documents; empty if they are too few."""
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int") + 1
    # The ids are chosen first: the texts of every task's candidates would all go to the driver
    found = docs.filter("text is not null")
    chosen = found.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct()
    rows = (
        found.select("doc_id", F.col("text").substr(start, F.lit(SAMPLE_CHARS)).alias("text"))
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    )
    encoder, samples = Tokenizer.from_file(path), []
    for row in rows:
        samples.append(np.array(encoder.encode(row["text"], add_special_tokens=False).ids + [END], dtype="<u4").tobytes())
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest() if dictionary else ""


def _files(folder: str):
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    return files, path


def write(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Writes the files and gives their index as read from the folder."""
    spark: SparkSession = docs.sparkSession
    dictionary = train_dictionary(docs, path)
    files, root = _files(folder)
    files.create_dir(f"{root}/data", recursive=True)
    with files.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    digest = _hash(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(path), TaskContext.get().partitionId()
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frame = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        # Each attempt has its own file; the index of the attempt that counts names it
        name = f"part-{part:05d}-{uuid.uuid4().hex}.tok"
        out, offset, before = None, 0, 0
        for batch, data, at in blocks(batches, limit=BLOCK):
            if out is None:
                own, path_of = _files(folder)
                out = own.open_output_stream(f"{path_of}/data/{name}")
            ids, starts = encoder.encode(data, at)
            n = len(starts) - 1
            offsets, lengths, counts, befores = (np.zeros(n, dtype=np.int64) for _ in range(4))
            for i in range(n):
                packed = frame.compress(np.append(ids[starts[i]:starts[i + 1]], END).astype("<u4").tobytes())
                out.write(packed)
                offsets[i], lengths[i], counts[i], befores[i] = offset, len(packed), starts[i + 1] - starts[i] + 1, before
                offset += len(packed)
                before += counts[i]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([part] * n, pa.int32()), pa.array([name] * n, pa.string()),
                pa.array(offsets), pa.array(lengths), pa.array(counts), pa.array(befores), pa.array([digest] * n, pa.string()),
            ], names=["doc_id", "part", "file", "offset", "length", "n_tokens", "before", "dictionary"])
        if out is not None:
            out.close()

    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part int, file string, offset long, length long, "
        "n_tokens long, before long, dictionary string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every document of the index: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids``.

    ``ids`` is binary, little-endian unsigned 32-bit numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = name = source = frame = digest = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "offset", "length", "dictionary")]
            found = []
            for file, offset, length, wanted in zip(*columns, strict=True):
                if files is None:
                    files, root = _files(folder)
                if wanted != digest:
                    with files.open_input_stream(f"{root}/dictionary") as stored:
                        dictionary = stored.read()
                    if (digest := _hash(dictionary)) != wanted:
                        raise ValueError(f"{file} was written with another dictionary")
                    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
                    frame = zstandard.ZstdDecompressor(dict_data=known)
                if file != name:
                    source, name = files.open_input_file(f"{root}/data/{file}"), file
                found.append(frame.decompress(source.read_at(length, offset)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(found, pa.binary()),
            ], names=["doc_id", "start", "n_tokens", "ids"])

    # One row per file is ordered here
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("earlier"))
    rows = index.join(files, "part").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "file", "offset", "length", "dictionary")
    kind = index.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
