"""N-gram Jaccard join of documents by a MinHash LSH forest and exact verification.

A document is the set of its five-word shingles (with fewer words: all its words as one shingle). Its
signature gives one label of ``DEPTH`` minima per tree. The sorted labels of a tree are a prefix trie:
documents below one node share a prefix. Matched prefixes are shortened, deepest first, until the
length at which a pair at the threshold shares a prefix in some tree with at least the target recall
(``stop_depth``). Candidates are then verified exactly on the shingle sets.

Work and output stay linear in the documents wherever copies abound: documents with equal shingle sets
are one class from the start; below a trie node only the links that hold its members together are
written; groups of candidates are verified in pairs of blocks of bounded size, which give counts and
spanning links, not pairs. No link between classes of one candidate group is lost.

Defined results: an empty or NULL text has no shingles, its own class (its id) and no links. Repeated
rows and equal texts are one class. A NULL id sorts before all others as the name of a class, so a
class's id is NULL only if all its ids are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.components import bounded, components, written
from sluicework.llm.texts import blocks, mixed, span_hashes, window_hashes, words_of
from sluicework.operators.matching import join_per_key

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH = 12, 6
RECALL = 0.995
#: Pairs below a trie node whose signatures agree in fewer places than this share are not linked yet.
LIKELY = 0.55
#: More documents than this below one node are taken as linked, verification decides.
NODE = 768
#: Bytes of text whose shingles are hashed at once.
TEXT = 1 << 18
#: Documents, and bytes of their texts, in a block of the verification (on average; a longer text is whole).
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Candidates up to this many are broadcast to fetch their texts (about 150 bytes each).
FEW_MEMBERS = 200_000
#: Dropped ids up to this many are broadcast (8 bytes each).
FEW_IDS = 1_000_000

ROW = np.uint64(0xD1342543DE82EF95)
_rng = np.random.default_rng(2024)
FACTORS = (_rng.integers(1, 2**32, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
SHIFTS = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def stop_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that still finds a pair at the threshold with the target recall."""
    for d in range(depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def shingles(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every row and the rows they belong to, row by row."""
    starts, ends, rows = words_of(data, at)
    hashes = span_hashes(data, starts, ends)
    found, first = window_hashes(hashes, rows, words)
    of = rows[first]
    counts = np.bincount(rows, minlength=len(at) - 1)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        begins = np.searchsorted(rows, short)
        extra = np.zeros(len(short), dtype=np.uint64)
        for k in range(words - 1):
            has = counts[short] > k
            extra[has] = extra[has] * np.uint64(0x9E3779B97F4A7C15) + hashes[begins[has] + k]
        found = np.concatenate([found, mixed(extra + counts[short].astype(np.uint64))])
        of = np.concatenate([of, short])
    _, keep = np.unique(mixed(found + of.astype(np.uint64) * ROW), return_index=True)
    keep = keep[np.lexsort((found[keep], of[keep]))]
    return found[keep], of[keep]


def _keys(found: np.ndarray, first: np.ndarray) -> list[str]:
    """128 bits of every shingle set that starts at ``first``, the same whatever the order."""
    both = np.stack([
        np.add.reduceat(mixed(found ^ np.uint64(0x5851F42D4C957F2D)), first),
        np.bitwise_xor.reduceat(mixed(found + np.uint64(0x14057B7EF767814F)), first),
    ], axis=1)
    return [row.tobytes().hex() for row in both]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in blocks(batches, limit=TEXT):
        n = batch.num_rows
        found, of = shingles(data, at)
        counts = np.bincount(of, minlength=n)
        full = np.flatnonzero(counts)
        keys, labels = [None] * n, [None] * n
        if len(full):
            first = np.searchsorted(of, full)
            key = _keys(found, first)
            half = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
            signature = np.empty((len(full), TREES * DEPTH), dtype=np.uint32)
            for k, (a, b) in enumerate(zip(FACTORS, SHIFTS, strict=True)):
                h = half * a + b
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h ^= h >> np.uint32(13)
                signature[:, k] = np.minimum.reduceat(h, first)
            for i, row in enumerate(full):
                keys[row] = key[i]
                labels[row] = signature[i].tobytes()
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(keys, pa.string()), pa.array(counts.astype(np.int64)),
            pa.array(np.diff(at)), pa.array(labels, pa.binary()),
        ], names=["doc_id", "key", "n_shingles", "n_bytes", "signature"])


def encode(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, n_shingles, n_bytes, signature)``: the class key of the shingle set and the MinHashes."""
    return docs.select("doc_id", "text").mapInArrow(
        _encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key string, n_shingles long, n_bytes long, signature binary")


class _Sets:
    """Union-find over the places of a small list."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins the ends of all the links; labels spread until nothing changes."""
        while True:
            low = np.minimum(self.up[a], self.up[b])
            before = self.up.copy()
            np.minimum.at(self.up, self.up[a], low)
            np.minimum.at(self.up, self.up[b], low)
            while True:
                shorter = self.up[self.up]
                if np.array_equal(shorter, self.up):
                    break
                self.up = shorter
            if np.array_equal(before, self.up):
                return


def _below_node(signatures: np.ndarray, tree: int, stop: int) -> np.ndarray:
    """The representative of every document below a node, by likely links; longest prefixes first."""
    n = len(signatures)
    sets = _Sets(n)
    labels = signatures[:, tree * DEPTH:(tree + 1) * DEPTH]
    for depth in range(DEPTH, stop - 1, -1):
        # sorted by label: a change within the first ``depth`` values starts another node
        new = np.r_[True, (labels[1:, :depth] != labels[:-1, :depth]).any(axis=1)]
        starts = np.flatnonzero(new)
        for a, b in zip(starts, np.r_[starts[1:], n], strict=True):
            if b - a < 2 or (sets.up[a:b] == sets.up[a]).all():
                continue
            part = signatures[a:b]
            for i in range(len(part) - 1):
                open_ = np.flatnonzero(sets.up[a + i + 1:b] != sets.up[a + i]) + i + 1
                if len(open_):
                    near = open_[(part[open_] == part[i]).mean(axis=1) >= LIKELY]
                    if len(near):
                        sets.join(np.full(len(near), a + i), a + near)
    return sets.up


def _walk(stop: int):
    """Links that hold likely partners together, from sorted labels of tree after tree."""

    def flush(keys: list, signatures: list, tree: int, out: tuple[list, list]) -> None:
        if len(keys) > 1:
            up = _below_node(np.frombuffer(b"".join(signatures), dtype=np.uint32).reshape(len(keys), -1), tree, stop)
            for i in np.flatnonzero(up != np.arange(len(keys))):
                out[0].append(keys[i])
                out[1].append(keys[up[i]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, tree, keys, signatures, whole = None, 0, [], [], False
        out: tuple[list, list] = ([], [])
        for batch in batches:
            names = ("tree", "node", "key", "signature")
            for t, at, key, signature in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if (t, at) != node:
                    if not whole:
                        flush(keys, signatures, tree, out)
                    node, tree, keys, signatures, whole = (t, at), t, [], [], False
                if whole:
                    out[0].append(key)
                    out[1].append(keys[0])
                    continue
                keys.append(key)
                signatures.append(signature)
                if len(keys) > NODE:
                    out[0].extend(keys[1:])
                    out[1].extend([keys[0]] * (len(keys) - 1))
                    signatures, whole = [], True
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["a", "b"])
                out = ([], [])
        if not whole:
            flush(keys, signatures, tree, out)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["a", "b"])

    return run


def candidates(classes: DataFrame, stop: int) -> DataFrame:
    """Links ``(a, b)`` between class keys whose signatures match below some trie node."""
    width = 4 * DEPTH
    rows = classes.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.xxhash64(t, F.expr("signature").substr(t * width + 1, F.lit(4 * stop))))).alias("tree", "node"))
    # Who is alone below a node need not travel with its signature
    nodes = rows.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node")
    shared = rows.join(nodes, "node", "left_semi").join(classes.select("key", "signature"), "key")
    return (
        shared.withColumn("label", F.expr(f"substring(signature, tree * {width} + 1, {width})"))
        .repartition(F.col("node")).sortWithinPartitions("node", "tree", "label", "key")
        .select("tree", "node", "key", "signature").mapInArrow(_walk(stop), "a string, b string")
    )


def _verify(threshold: float):
    """Counts and spanning links of the verified pairs within each pair of blocks."""

    def settle(rows: list[tuple], two: bool, out: list[tuple]) -> None:
        """rows: (side, key, weight, text); with two blocks only links between the sides count."""
        found, of = shingles(*_joined([r[3] for r in rows]))
        # An id may carry several texts or come twice: each class once, by its own text
        full = np.unique(of)
        own = dict.fromkeys(r[1] for r in rows)
        for i, key in zip(full, _keys(found, np.searchsorted(of, full)) if len(full) else [], strict=True):
            if rows[i][1] == key and own[key] is None:
                own[key] = i
        kept = np.array(sorted(i for i in own.values() if i is not None), dtype=np.int64)
        if len(kept) < 2:
            return
        place = np.full(len(rows), -1)
        place[kept] = np.arange(len(kept))
        rows, found, of = [rows[i] for i in kept], found[place[of] >= 0], place[of[place[of] >= 0]]
        n = len(rows)
        sizes = np.bincount(of, minlength=n)
        weights = np.array([r[2] for r in rows], dtype=np.int64)
        sides = np.array([r[0] for r in rows])
        _, column, counts = np.unique(found, return_inverse=True, return_counts=True)
        shared = counts[column] > 1
        ids, column = np.unique(column[shared], return_inverse=True)
        of, common = of[shared], np.zeros((n, n), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        column, of = column[order], of[order]
        step = max(64, (1 << 21) // n)
        for c in range(0, len(ids), step):
            a, b = np.searchsorted(column, [c, c + step])
            grid = np.zeros((n, min(step, len(ids) - c)), dtype=np.float32)
            grid[of[a:b], column[a:b] - c] = 1
            common += grid @ grid.T
        common = common.astype(np.float64)
        linked = (common > 0) & (common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9)
        np.fill_diagonal(linked, False)
        if two:
            linked &= sides[:, None] != sides[None, :]
        links = linked.astype(np.int64) @ weights
        sets = _Sets(n)
        a, b = np.nonzero(linked)
        if len(a):
            sets.join(a, b)
        for i in range(n):
            if links[i]:
                out.append((rows[i][1], int(links[i]), rows[sets.up[i]][1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []
        for batch in batches:
            names = ("comp", "i", "j", "side", "key", "weight", "text")
            for comp, i, j, *row in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if (comp, i, j) != group:
                    if len(rows) > 1:
                        settle(rows, group[1] != group[2], out)
                    group, rows = (comp, i, j), []
                rows.append(row)
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        if len(rows) > 1:
            settle(rows, group[1] != group[2], out)
        yield _batch(out)

    return run


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def _batch(out: list[tuple]) -> pa.RecordBatch:
    key, links, root = zip(*out, strict=True) if out else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.string()), pa.array(links, pa.int64()), pa.array(root, pa.string())], names=["a", "links", "b"])


def verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, links, b)``: documents linked to class ``a`` and a class that holds ``a`` in its place.

    ``classes`` has one document each (``rep``); ``groups`` maps class keys to candidate groups.
    """
    members = groups.select("node", "root").unionByName(
        groups.select(F.col("root").alias("node"), "root").distinct())
    joined = classes.join(members, F.col("key") == F.col("node")).select(
        "key", "rep", "weight", "n_bytes", F.col("root").alias("comp"))
    sizes = joined.groupBy("comp").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = join_per_key(joined, sizes, ["comp"], "inner").drop("n_bytes").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    texts = docs.select("doc_id", "text")
    placed = bounded(written(placed, "placed"), FEW_MEMBERS)
    with_text = texts.join(placed, texts["doc_id"].eqNullSafe(placed["rep"]))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = with_text.select("comp", "key", "weight", "text", "block", others).select(
        "comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "key", "weight", "text")
    return (
        spread.repartition(F.col("comp"), F.col("i"), F.col("j"))
        .sortWithinPartitions("comp", "i", "j", "side", "key")
        .mapInArrow(_verify(threshold), "a string, links long, b string")
    )


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its class and links: ``(doc_id, class_id, n_links, n_copies)``.

    ``class_id`` is the smallest id of all documents connected by links of at least ``threshold``,
    ``n_links`` the other documents at that similarity (copies included), ``n_copies`` those of them
    with the same shingles.
    """
    stop = stop_depth(threshold)
    encoded = written(encode(docs), "signatures")
    classes = written(
        encoded.filter("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.max("n_bytes").alias("n_bytes"),
            F.min("signature").alias("signature")),
        "classes")
    groups = components(candidates(classes, stop))
    found = written(verified(docs, classes.drop("signature"), groups, threshold), "verified")
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "rep", "weight")
        .join(links, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    smallest = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    per_class = join_per_key(named, smallest, ["root"], "inner").select(
        "key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        (F.col("weight") - 1).alias("n_copies"))
    return join_per_key(encoded.select("doc_id", "key"), per_class, ["key"]).select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"))


def one_per_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every group: the one with the smallest id (NULL first), then the hash of its text and its row.

    An id with several texts loses only the rows that have a partner elsewhere; of equal rows one stays.
    Rows without a shingle are dropped only as repeats of an equal row.
    """
    # All columns of a row travel in one struct, so that no name can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    row = F.col("row")
    rest = [row.getField(c) for c in docs.columns if c not in ("doc_id", "text")]
    names = {
        "doc_id": row.getField("doc_id"), "v": F.xxhash64(row.getField("text")),
        "v2": F.xxhash64(F.lit(1), row.getField("text")), "empty": row.getField("text").isNull(),
        "other": F.xxhash64(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(rest)))) if rest else F.lit("")),
    }
    # The rows are told apart by a struct, which is never NULL and sorts a NULL id first
    rows = whole.select(F.struct(*(c.alias(n) for n, c in names.items())).alias("doc_id"), row.getField("text").alias("text"))
    found = written(join(rows, threshold).select("doc_id", "class_id"), "grouped")
    stays = F.col("doc_id") == F.col("class_id")
    marks = found.groupBy("doc_id").agg(F.first(stays).alias("stays"), F.count("*").alias("n"))
    marks = written(marks.filter("not stays or n > 1").select("doc_id.*", "stays"), "dropped")

    def same(right: DataFrame, how: str) -> DataFrame:
        on = F.lit(True)
        for n, c in names.items():
            on = on & c.eqNullSafe(F.col(n))
        return whole.join(bounded(right, FEW_IDS), on, how)

    single = same(marks, "left_anti").select("row")
    several = same(marks.filter("stays"), "inner").dropDuplicates(list(names)).select("row")
    return single.unionByName(several).select(*(row.getField(c).alias(c) for c in docs.columns))
