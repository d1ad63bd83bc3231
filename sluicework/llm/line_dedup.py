"""Fuzzy line dedup by MinHash, in DataFrame functions only.

A line is the set of its character shingles: ``SHINGLE`` consecutive bytes of its UTF-8 form at every
offset (a shorter line is one shingle). One hash per shingle fills ``2 * BANDS`` bins with their
minima; two bins make a band. Lines that share a band are compared with that band's smallest and
largest line: first by their bins, then by the exact Jaccard similarity of the shingle sets. Verified
links go to the distributed union-find. Where that leaves the members of a band in several components,
the others are compared too, in pairs of blocks of bounded size and without their texts: first by a few
bits of every bin, then those with a likely partner by the parity of their shingles in 1024 bins, which
bounds the similarity from above. A few pivots of each band come first, then all the pairs that are left
in different components; what neither bound excludes is compared by its texts. The links between
components found there are joined to the first. So every pair that shares a band and agrees in ``AGREE``
bins is verified, excluded by a bound on its similarity, or already connected. Of every component the first line stays.

A long line draws its minima from the shingles whose hash is below a limit set by the line's length,
at most about ``DRAWN`` of them: the minimum of a bin that drew one is the same with or without the
others. A line with a bin that drew none uses all its shingles, as repetitive lines do. So a sketch
depends on nothing but the set of shingles. Verification uses all of them always.

Equal lines are one node from the start, so a line with a third of all copies is one row. A band gives
two candidate links per line as rows, and what the bounds leave of the others.

Defined results: lines without a word are left alone and never dropped; NULL and empty texts have no
lines. "First" is by document id (NULL first), then the text's hash, then the line's place, so rows
with one id and one text are the same document and keep the same lines. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.components import Scratch, bounded, components
from sluicework.operators.matching import join_per_key

SHINGLE, BANDS, DRAWN, THRESHOLD = 8, 7, 84, 0.8
#: Candidates must agree in so many of the bins before their texts are compared.
AGREE = 6
#: Line keys up to this many are broadcast to fetch their texts (8 bytes each).
FEW_KEYS = 1_000_000
#: Lines in a block of the search for likely partners, and of that for possible pairs (on average). None travels with its text.
MARKS_BLOCK = BLOCK = 2048
#: Lines of a band that its members are compared with before all pairs are searched.
PIVOTS = 16
SPAN = 2**31
HAS_WORD = r"[^\x20\x09-\x0D]"


def lines_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, line_no, line, k, k2)`` of every line with a word."""
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.filter(F.col("line").rlike(HAS_WORD)).select(
        "*", F.xxhash64("line").alias("k"), F.xxhash64(F.lit(1), "line").alias("k2"))


def _places(binary: str) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(binary) - (SHINGLE - 1)))


def _shingles(text: str) -> Column:
    """The hash of the shingle at every place of a text."""
    return F.transform(_places(text), lambda at: F.xxhash64(F.col(text).substr(at, F.lit(SHINGLE))))


def _minima(lines: DataFrame, limit: Column) -> DataFrame:
    """``(k, limit, m0, m1, …)``: the minima below the limit; a line has its row even if it draws none."""
    # Generated code computes what the sequence refers to once per line, and any other column again in
    # every step of the explode. The limit is never negative; naming it and ``k`` makes them once too.
    first = F.when((F.col("limit") < 0) & (F.col("k") == 0), 2).otherwise(1)
    places = F.sequence(first, F.greatest(F.lit(1), F.length("b") - (SHINGLE - 1)))
    drawn = (
        lines.select("k", F.col("line").cast("binary").alias("b"), limit.alias("limit"))
        .select("k", "b", "limit", F.explode(places).alias("at"))
        .select("k", "limit", "at", F.hash(F.expr(f"substring(b, at, {SHINGLE})")).bitwiseAND(F.lit(SPAN - 1)).cast("int").alias("h"))
        .filter((F.col("h") < F.col("limit")) | (F.col("at") == 1))
        .select("k", "limit", "h", F.when(F.col("h") < F.col("limit"), F.col("h") % (2 * BANDS)).alias("bin"))
    )
    return drawn.groupBy("k", "limit").agg(
        *(F.min(F.when(F.col("bin") == i, F.col("h"))).alias(f"m{i}") for i in range(2 * BANDS)))


def sketches(lines: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """``(k, m0, m1, …)``: the minima of the bins of every different line, over all its shingles."""
    tables = tables or Scratch(lines.sparkSession)
    n = F.octet_length("line") - (SHINGLE - 1)
    limit = F.when(n > DRAWN, (F.lit(SPAN * DRAWN) / n).cast("long")).otherwise(F.lit(SPAN).cast("long"))
    drawn = tables.written(_minima(lines, limit), "drawn")
    empty = sum(F.col(f"m{i}").isNull().cast("int") for i in range(2 * BANDS)) > 0
    short = (F.col("limit") < SPAN) & empty
    keys = bounded(tables.written(drawn.filter(short).select("k"), "short"), FEW_KEYS)
    whole = tables.written(_minima(lines.join(keys, "k", "left_semi"), F.lit(SPAN).cast("long")), "whole")
    return drawn.filter(~short).unionByName(whole).drop("limit")


def _bands() -> Column:
    return F.array(*(
        F.when(F.coalesce(f"m{2 * i}", f"m{2 * i + 1}").isNotNull(),
               F.xxhash64(F.lit(i), F.coalesce(f"m{2 * i}", F.lit(-1)), F.coalesce(f"m{2 * i + 1}", F.lit(-1))))
        for i in range(BANDS)))


def shared_bands(sketch: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """``(band, k, bits, low, high, n)``: the bands of several lines, with their two ends and how many they are.

    Of two lines both are ends, so their band is a row of ``low`` without ``bits``, which only lines between ends need.
    """
    tables = tables or Scratch(sketch.sparkSession)
    rows = sketch.select("k", F.explode(_bands()).alias("band")).filter("band is not null")
    ends = tables.written(rows.groupBy("band").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n")).filter("low < high"), "ends")
    several = ends.filter("n > 2")
    # Most bands have one or two lines: the others' lines go alone to their ends, by a few keys if that is what they are
    rows = sketch.select("k", _bits().alias("bits"), F.explode(_bands()).alias("band")).join(
        bounded(several.select("band"), FEW_KEYS), "band", "left_semi")
    # A band may be that of a third of all lines
    between = join_per_key(rows, several, ["band"], "inner").select("band", "k", "bits", "low", "high", "n")
    two = ends.filter("n = 2").select("band", F.col("low").alias("k"), F.lit(None).cast("long").alias("bits"), "low", "high", "n")
    return between.unionByName(two)


def candidate_links(sketch: DataFrame, shared: DataFrame) -> DataFrame:
    """``(a, b)``: lines that share a band with one of its two ends and agree in ``AGREE`` bins."""
    pairs = shared.select("k", F.explode(F.array("low", "high")).alias("end"))
    pairs = pairs.filter("k <> end").select(F.least("k", "end").alias("a"), F.greatest("k", "end").alias("b")).distinct()
    bins = [f"m{i}" for i in range(2 * BANDS)]
    left = sketch.select(F.col("k").alias("a"), *(F.col(m).alias(f"a{m}") for m in bins))
    right = sketch.select(F.col("k").alias("b"), *(F.col(m).alias(f"b{m}") for m in bins))
    # Bins that are empty on both sides agree: short lines have many of them
    agree = sum((F.col(f"a{m}").eqNullSafe(F.col(f"b{m}"))).cast("int") for m in bins)
    return pairs.join(left, "a").join(right, "b").filter(agree >= AGREE).select("a", "b")


def _texts(lines: DataFrame, keys: DataFrame, tables: Scratch) -> DataFrame:
    """``(k, b)``: the bytes of the lines with these keys."""
    keys = tables.written(keys.distinct(), "keys")
    return tables.written(
        lines.select("k", "line").join(bounded(keys, FEW_KEYS), "k")
        .groupBy("k").agg(F.min("line").alias("line")).select("k", F.col("line").cast("binary").alias("b")), "texts")


def verified_links(
    lines: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD, tables: Scratch | None = None) -> DataFrame:
    """The pairs whose shingle sets have at least the Jaccard similarity."""
    texts = _texts(lines, pairs.select(F.explode(F.array("a", "b")).alias("k")), tables or Scratch(lines.sparkSession))
    return _verified(pairs, texts, threshold).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    # The texts travel, their shingles (eight times as long) are made where they are compared
    both = pairs.join(texts.select(F.col("k").alias("a"), F.col("b").alias("ta")), "a").join(
        texts.select(F.col("k").alias("b"), F.col("b").alias("tb")), "b")
    # As a generator's columns the shingles are made once per pair, not again wherever the filter names them
    sets = both.select(*pairs.columns, F.inline(F.array(F.struct(_shingles("ta").alias("sa"), _shingles("tb").alias("sb")))))
    shared, all_ = F.size(F.array_intersect("sa", "sb")), F.size(F.array_union("sa", "sb"))
    return sets.filter(shared >= threshold * all_ - 1e-9).select(*pairs.columns)


def open_members(shared: DataFrame, roots: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """``(band, k, bits, c)``: the lines between the ends of a band, where they lie in several components."""
    tables = tables or Scratch(shared.sparkSession)
    # Of up to three lines every pair has an end in it
    rows = shared.filter("n > 3 and k <> low and k <> high").select("band", "k", "bits")
    rows = rows.join(roots.withColumnRenamed("node", "k"), "k", "left").select("band", "k", "bits", F.coalesce("root", "k").alias("c"))
    rows = tables.written(rows, "between")
    open_ = rows.groupBy("band").agg(F.min("c").alias("c_low"), F.max("c").alias("c_high")).filter("c_low < c_high")
    return join_per_key(rows, open_, ["band"], "inner").select("band", "k", "bits", "c")


BIN_BITS = 64 // (2 * BANDS)


def _bits() -> Column:
    """A few bits of every bin; bins that agree have equal bits, so they miss no candidate."""
    bits = F.lit(0).cast("long")
    for i in range(2 * BANDS):
        bits = F.shiftleft(bits, BIN_BITS).bitwiseOR(
            F.pmod(F.xxhash64(F.coalesce(f"m{i}", F.lit(-1))), F.lit(2**BIN_BITS)))
    return bits


def _met(members: DataFrame, block: int, fields: tuple[str, ...], tables: Scratch) -> tuple[DataFrame, DataFrame, Column]:
    """The members of a band on two sides, ``x`` and ``y``, and what says that two of them may be compared.

    Those of another component meet, each pair of blocks of a band on its own.
    """
    parts = members.groupBy("band").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = tables.written(join_per_key(members, parts, ["band"], "inner").select(
        "band", "c", *fields, "blocks", F.pmod(F.xxhash64("k", "band"), F.col("blocks")).cast("int").alias("block")), "placed")
    spread = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))

    def side(name: str, i: str, j: str) -> DataFrame:
        named = {"band": "band", i: "i", j: "j", "c": "c", **{f: f for f in fields}}
        return spread.select(*(F.col(c).alias(f"{name}_{to}") for c, to in named.items()))

    on = F.col("x_c") != F.col("y_c")
    for key in ("band", "i", "j"):
        on = (F.col(f"x_{key}") == F.col(f"y_{key}")) & on
    # Without the hint a side of a few MB would go through the driver
    return side("x", "block", "other"), side("y", "other", "block").hint("merge"), on


def _may_agree(x: Column, y: Column) -> Column:
    """The bits of two lines that may agree in ``AGREE`` bins."""
    ones = sum(1 << (BIN_BITS * i) for i in range(2 * BANDS))
    apart = x.bitwiseXOR(y)
    for step in (1, 2):
        apart = apart.bitwiseOR(F.shiftrightunsigned(apart, step))
    return F.bit_count(apart.bitwiseAND(F.lit(ones))) <= 2 * BANDS - AGREE


def likely_members(sketch: DataFrame, members: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """``(band, k, c, bits)``: the members with a likely partner in their band.

    What travels here has no text, however long the lines are.
    """
    tables = tables or Scratch(members.sparkSession)
    if "bits" not in members.columns:
        members = members.join(sketch.select("k", _bits().alias("bits")), "k")
    x, y, on = _met(members, MARKS_BLOCK, ("k", "bits"), tables)
    likely = x.join(y, on & _may_agree(F.col("x_bits"), F.col("y_bits")), "left_semi")
    return likely.select(*(F.col(f"x_{c}").alias(c) for c in ("band", "k", "c", "bits"))).distinct()


ODD = tuple(f"o{i}" for i in range(16))


def odd_sketches(texts: DataFrame) -> DataFrame:
    """``(k, n, o0, o1, …)``: how many shingles a line has, and for each of 1024 bins whether it drew an odd number of them.

    A shingle that only one of two lines has makes one bin differ, or evens out another, so at least as
    many shingles differ as bins do.
    """
    # As a generator's column the shingles are an array of plain numbers, where generated code tells the different ones
    hashes = texts.select("k", F.inline(F.array(F.struct(_shingles("b").alias("hashes")))))
    rows = hashes.select("k", F.array_distinct("hashes").alias("hashes")).select("k", F.explode("hashes").alias("h")).withColumn(
        "bit", F.expr("shiftleft(1L, cast(h & 63 as int))")).withColumn("word", F.expr(f"shiftrightunsigned(h, 6) & {len(ODD) - 1}"))
    return rows.groupBy("k").agg(F.count("*").alias("n"), *(
        F.bit_xor(F.when(F.col("word") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(o) for i, o in enumerate(ODD)))


def _possible(on: Column, threshold: float) -> Column:
    """Likely pairs of two sides whose odd bins leave room for the similarity."""
    apart = sum(F.bit_count(F.col(f"x_{o}").bitwiseXOR(F.col(f"y_{o}"))) for o in ODD)
    # Of S shingles in two sets at most S * (1 - t) / (1 + t) are in one of them alone
    room = (F.col("x_n") + F.col("y_n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    return on & _may_agree(F.col("x_bits"), F.col("y_bits")) & (apart <= room)


def _pairs(x: DataFrame, y: DataFrame, on: Column) -> DataFrame:
    """``(a, b, ca, cb)``: the two sides' lines that go together, with their components."""
    ends = [F.struct(F.col(f"{side}_k").alias("k"), F.col(f"{side}_c").alias("c")) for side in "xy"]
    both = x.join(y, on).select(F.least(*ends).alias("low"), F.greatest(*ends).alias("high"))
    return both.select(
        F.col("low.k").alias("a"), F.col("high.k").alias("b"), F.col("low.c").alias("ca"), F.col("high.c").alias("cb"))


def pivot_pairs(members: DataFrame, threshold: float, tables: Scratch) -> DataFrame:
    """The possible pairs of every member with some lines of its band."""
    slot = F.pmod(F.xxhash64("k", "band"), F.lit(PIVOTS))
    chosen = members.groupBy("band", slot.alias("slot")).agg(F.min("k").alias("k")).select("band", "k")
    pivots = tables.written(members.join(chosen, ["band", "k"], "left_semi"), "pivots")
    x, y = (df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns)) for side, df in (("x", members), ("y", pivots)))
    on = (F.col("x_band") == F.col("y_band")) & (F.col("x_c") != F.col("y_c"))
    return _pairs(x, y.hint("merge"), _possible(on, threshold)).distinct()


def possible_pairs(members: DataFrame, threshold: float, tables: Scratch) -> DataFrame:
    """The possible pairs of all members."""
    x, y, on = _met(members, BLOCK, ("k", "bits", "n", "bands", *ODD), tables)
    # Lines that share several bands meet in one of them
    here = F.array_min(F.array_intersect("x_bands", "y_bands")) == F.col("x_band")
    return _pairs(x, y, _possible(on & (F.col("x_k") < F.col("y_k")), threshold) & here)


def links_within(
    lines: DataFrame, sketch: DataFrame, members: DataFrame, threshold: float = THRESHOLD, tables: Scratch | None = None,
) -> DataFrame:
    """``(a, b)``: components joined by a verified pair of lines of one band.

    Pairs with a few pivots of a band come first. Near copies of one line are one component then, so
    that the pairs left for the second search don't grow with the square of their number.
    """
    tables = tables or Scratch(lines.sparkSession)
    members = tables.written(likely_members(sketch, members, tables), "likely_members")
    texts = _texts(lines, members.select("k"), tables)
    bands = members.groupBy("k").agg(F.collect_list("band").alias("bands"))
    members = tables.written(members.join(odd_sketches(texts).join(bands, "k"), "k"), "odd")
    tried = tables.written(pivot_pairs(members, threshold, tables), "tried")
    ends = (F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
    first = tables.written(_verified(tried, texts, threshold).select(*ends).distinct(), "first")
    to = components(first).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    members = members.join(to, F.col("c") == F.col("_node"), "left").withColumn("c", F.coalesce("_root", "c")).drop("_node", "_root")
    pairs = possible_pairs(members, threshold, tables).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    pairs = tables.written(pairs, "possible")
    return first.unionByName(_verified(pairs, texts, threshold).select(*ends).distinct())


def line_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every line with a word, the first line of its class, and whether it is that line.

    Columns ``doc_id``, ``version`` (hash of the text), ``line_no`` (from 0), ``first`` (a struct of
    the three), ``n_class`` (lines in the class), ``kept``.
    """
    tables, last = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    lines = lines_of(docs)
    sketch = sketches(lines, tables)
    shared = tables.written(shared_bands(sketch, tables), "shared")
    tables.drop("ends")
    pairs = tables.written(candidate_links(sketch, shared), "pairs")
    roots = components(verified_links(lines, pairs, threshold, tables))
    tables.drop("pairs", "keys", "texts")
    # Links between components name them by their roots
    members = last.written(open_members(shared, roots, tables), "open_members")
    tables.drop("shared", "between")
    more = roots.limit(0) if members.isEmpty() else components(links_within(lines, sketch, members, threshold, tables))
    tables.drop_all()
    last.drop("open_members")
    to = more.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    roots = last.written(
        roots.join(to, F.col("root") == F.col("_node"), "left")
        .select("node", F.coalesce("_root", "root").alias("root")).unionByName(more), "roots")
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    place = F.struct("doc_id", "version", "line_no")
    # Equal lines are told by 128 bits; lines in a fuzzy class by their node
    placed = lines.drop("line").join(nodes, F.col("k") == F.col("node"), "left").select(
        "doc_id", "version", "line_no", F.coalesce("root", "k").alias("c"),
        F.when(F.col("root").isNull(), F.col("k2")).otherwise(F.lit(0)).alias("c2"))
    placed = last.written(placed, "placed")
    firsts = placed.groupBy("c", "c2").agg(F.min(place).alias("first"), F.count("*").alias("n_class"))
    return join_per_key(placed, firsts, ["c", "c2"], "inner").select(
        "doc_id", "version", "line_no", "first", "n_class", place.eqNullSafe(F.col("first")).alias("kept"))


def without_repeats(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without the lines that repeat one kept elsewhere.

    A document that loses all its lines with words goes; one that had none stays as it is.
    """
    dropped = (
        line_classes(docs, threshold).filter(~F.col("kept"))
        .groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("gone"))
    )
    # All columns of a row travel in one struct, so that no name can clash
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    whole = docs.select(row, F.xxhash64("text").alias("own"))
    joined = whole.join(
        dropped, F.col("row").getField("doc_id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("version")), "left")
    text = F.col("row").getField("text")
    parts = joined.select("row", "gone", F.split(text, "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    cleaned = parts.select("row", "gone", F.when(F.col("gone").isNull(), text).otherwise(rest).alias("new"))
    stays = F.col("gone").isNull() | F.col("new").rlike(HAS_WORD)
    return cleaned.filter(stays).select(
        *((F.col("new") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))
