"""The operators against brute force, exact round trips and held-out accuracy, and on odd rows."""

import collections
import itertools
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from conftest import duck_rows, spark_rows
from pyspark.sql import functions as F
from sluicework.llm import (
    components, curve_neighbours, extendible_shards, language_cnn, line_dedup, ngram_join, pieces, quality_cnn,
    quality_rules, source_mix, token_files,
)
from sluicework.llm.queries import ORACLES, QUERIES
from sluicework.llm.shipping import ship
from tokenizers import Tokenizer

FOLDER, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES, IDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")

ODD = [
    (1, "The cat sat on the mat and then the dog ran far away from the old house today.\nA second line here, all alone.", "en", "a", "x"),
    (2, "The cat sat on the mat and then the dog ran far away from the old house today.\nAnother line that is different.", "en", "a", "y"),
    (2, "The cat sat on the mat and then the dog ran far away from the old house today.\nAnother line that is different.", "en", "a", "y"),
    (3, None, None, None, None),
    (4, "", "de", "b", "z"),
    (None, "no id here", None, None, "q"),
    (5, " \n\t \n", "fr", "b", "z"),
    (6, "word " * 40_000 + "é日本\U0001F600", "en", "c", "z"),
    (7, "x" * 50_000, "en", "c", "z"),
    (8, "one", "de", "c", "z"),
]
SCHEMA = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and a column named like a result."""
    ship(spark)
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def union(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(SMALL, ORACLES[name])


def test_components(spark):
    pairs = [(9, 8), (8, 7), (1, 2), (2, 5), (5, 9), (20, 21), (30, 30), (21, 22), (25, 22)]
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = union(pairs, {x for p in pairs for x in p})
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in want.items() if n != r}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classifiers_hold_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_quality_cnn"](spark, FOLDER).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.93
    languages = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op10_language_cnn"](spark, FOLDER).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == languages[r["doc_id"]] for r in rows]) > 0.95
    rows = [r for r in QUERIES["op8_ngram_rules"](spark, FOLDER).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    kept = {q: np.mean([r["kept"] for r in rows if labels.get(r["doc_id"]) == q]) for q in (0, 1)}
    assert kept[1] > 0.85 and kept[0] < 0.3


def test_models_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (8, 0), (2, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    plain = odd.drop("score")
    for docs, known in ((odd, labels), (odd, labels.limit(0)), (none, labels)):
        model = quality_cnn.fit(docs, known)
        assert quality_cnn.scored(docs.drop("score"), model).filter("score between 0 and 1").count() == docs.count()
        rules = quality_rules.judged(docs, quality_rules.fit(docs, known))
        assert rules.filter("base_failed is not null and kept is not null").count() == docs.count()
    assert quality_cnn.kept(odd, quality_cnn.fit(odd, labels.limit(0)), 0.5).columns == odd.columns
    with pytest.raises(ValueError, match="already"):
        quality_cnn.scored(odd, quality_cnn.Model(constant=0.5))
    found = language_cnn.predicted(plain, language_cnn.fit(plain)).collect()
    assert {r["lang_pred"] for r in found if not re.search(r"[^\W\d_]", r["text"] or "")} == {"und"}
    assert language_cnn.predicted(none.drop("score"), language_cnn.fit(none)).count() == 0


def test_base_counts(spark):
    rows = QUERIES["op8_ngram_rules"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in rows:
        text = texts[r["doc_id"]]
        words = WORD.findall(text)
        grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        often = collections.Counter(grams)
        covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_pieces_are_the_best_paths():
    segmenter = pieces.Segmenter(PIECES)
    lattice = segmenter.pieces

    def all_paths(unit):
        arcs = lattice.arcs(unit)

        def into(end):
            if end == 0:
                yield 0.0, ()
            for start, ids, score in arcs[end]:
                for s, p in into(start):
                    yield s + score, p + ids

        return sorted((s for s, _ in into(len(unit))), reverse=True)

    units = ["▁the", "▁étre", "abab", "日x", "▁▁a", "\n", "tion"]
    for unit in units:
        want = all_paths(unit)[:4]
        got = lattice.n_best(unit, 4)
        assert [s for s, _ in got] == pytest.approx(want)
        ids, best, second = lattice.best_of_many([unit, unit])
        assert ids[1] == got[0][1] and best[0] == pytest.approx(want[0])
        assert second[0] == (pytest.approx(want[1]) if len(want) > 1 else -np.inf)
    text = " ".join(["the abab", "tion x"]).encode()
    _, _, slots, rows = segmenter.encode(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    lists = [[s for s, _ in lattice.n_best(segmenter.names[s].decode().replace(" ", "▁"), 5)] for s in slots]
    want = sorted((sum(c) for c in itertools.product(*lists)), reverse=True)[:5]
    assert [s for s, _ in segmenter.n_best(slots[rows[0]:rows[1]], 5)] == pytest.approx(want)


def test_pieces_round_trip(spark, odd, none):
    for r in pieces.encoded(odd, PIECES).collect():
        assert r["decoded"] == (r["text"] or "") and r["n_best_scores"] == sorted(r["n_best_scores"], reverse=True)
    assert pieces.encoded(none, PIECES).count() == 0
    assert QUERIES["op2_nbest_pieces"](spark, FOLDER).filter("not round_trip").count() == 0


def test_token_files(spark, odd, none, tmp_path):
    whole = Tokenizer.from_file(IDS)
    for name, docs in (("odd", odd), ("none", none), ("real", spark.read.parquet(f"{SMALL}/documents.parquet"))):
        folder = str(tmp_path / name)
        rows = token_files.read(token_files.write(docs, folder, IDS), folder).collect()
        texts = sorted(((r["doc_id"] is not None, r["doc_id"], r["text"] or "") for r in docs.collect()))
        start, rows = 0, sorted(rows, key=lambda r: r["start"])
        assert len(rows) == len(texts)
        for r, (_, doc_id, text) in zip(rows, texts, strict=True):
            ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
            assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc_id, start, len(ids))
            assert ids == whole.encode(text, add_special_tokens=False).ids + [1]
            start += len(ids)


def test_lines(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lines = {}
    for r in docs.collect():
        for n, line in enumerate(r["text"].split("\n")):
            if WORD.search(line):
                lines.setdefault(line, []).append((r["doc_id"], n))
    sets = [frozenset(x.encode()[k:k + 8] for k in range(max(1, len(x.encode()) - 7))) for x in lines]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if 0.8 * max(len(sets[i]), len(sets[j])) <= min(len(sets[i]), len(sets[j]))
             and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    roots, first = union(pairs, range(len(sets))), {}
    for i, places in enumerate(lines.values()):
        first[roots[i]] = min(first.get(roots[i], places[0]), min(places))
    want = {p: first[roots[i]] for i, places in enumerate(lines.values()) for p in places}
    got = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"])
           for r in QUERIES["op4_fuzzy_lines"](spark, SMALL).collect()}
    assert got == want
    cleaned = line_dedup.without_repeats(odd)
    assert cleaned.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in cleaned.collect()]
    assert collections.Counter(i for i, _ in rows) == {1: 1, 2: 2, 3: 1, 4: 1, None: 1, 5: 1, 6: 1, 7: 1, 8: 1}
    assert (2, "Another line that is different.") in rows
    assert line_dedup.without_repeats(none).count() == 0


def brute_line_classes(lines):
    """The number of classes of these different lines."""
    sets = [frozenset(x.encode()[k:k + 8] for k in range(max(1, len(x.encode()) - 7))) for x in lines]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return len(set(union(pairs, range(len(sets))).values()))


def found_line_classes(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return line_dedup.line_classes(docs).select("first").distinct().count()


@pytest.mark.parametrize("blocks", [64, 16])
def test_lines_near_one_but_not_each_other(spark, monkeypatch, blocks):
    monkeypatch.setattr(line_dedup, "BLOCK", blocks)
    rng = np.random.default_rng(11)
    lines = []
    for copies in (300, 20, 20, 5):
        original = "".join(map(chr, rng.integers(97, 123, 200)))
        lines.append(original)
        for _ in range(copies):
            copy = list(original)
            for at in (rng.integers(8, 90), rng.integers(110, 190)):
                copy[at] = "#%&$"[rng.integers(4)]
            lines.append("".join(copy))
    lines = list(dict.fromkeys(lines))
    assert brute_line_classes(lines) == 4
    assert found_line_classes(spark, lines) == 4


def test_a_pair_at_the_threshold_shares_a_band():
    """The search is not narrowed to save disk: at most one pair of a thousand at 0.8 shares no band."""
    assert (1 - line_dedup.THRESHOLD**2) ** line_dedup.BANDS < 1e-3
    assert line_dedup.DRAWN >= 4 * 2 * line_dedup.BANDS and line_dedup.AGREE <= 6


def test_long_lines_of_few_shingles(spark):
    """Equal shingle sets meet at any length, with or without spaces."""
    cells = ["=", "-", "日本", "ab\t", "1,2;", "na "]
    lines = [(cell * 200)[:n] for cell in cells for n in range(60, 137, 4)]
    lines = [x for x in dict.fromkeys(lines)]
    assert brute_line_classes(lines) == len(cells)
    assert found_line_classes(spark, lines) == len(cells)
    docs = spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")
    rows = line_dedup.sketches(line_dedup.lines_of(docs)).collect()
    assert len(rows) == len(lines) and all(any(x is not None for x in r[1:]) for r in rows)


def test_groups_of_documents(spark, odd, none):
    docs = {r["doc_id"]: WORD.findall(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in docs.items()}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    roots, links = union(pairs, sets), collections.Counter(x for p in pairs for x in p)
    for r in QUERIES["op9_forest_join"](spark, SMALL).collect():
        assert (r["class_id"], r["n_links"]) == (roots[r["doc_id"]], links[r["doc_id"]])
    rows = {(r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join(odd).collect()}
    assert {(3, 3, 0), (4, 4, 0), (2, 2, 1), (6, 6, 0), (8, 8, 0), (None, None, 0)} <= rows
    assert ngram_join.one_per_group(odd).columns == odd.columns and ngram_join.join(none).count() == 0


def test_one_row_of_each_group(spark, odd):
    ship(spark)
    words = [f"w{k}" for k in range(60)]
    near, plain, other = " ".join([*words, "x"]), " ".join(words), " ".join(f"u{k}" for k in range(30))
    third = " ".join(f"t{k}" for k in range(30))
    rows = [(1, plain, "a"), (5, near, "a"), (5, other, "a"), (7, third, "b"), (7, third, "b"), (None, third, "c"),
            (8, None, "a"), (8, None, "a"), (9, "", "a"), (9, None, "a"), (9, "", "b"), (10, other, "z"),
            (11, "solo here", "q"), (11, "solo here", "q"), (11, "solo here", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = collections.Counter(tuple(r) for r in ngram_join.one_per_group(docs).collect())
    assert set(got.values()) == {1}
    solo = {r for r in got if r[0] == 11}
    assert len(solo) == 1 and set(got) - solo == {
        (1, plain, "a"), (5, other, "a"), (None, third, "c"), (8, None, "a"), (9, "", "a"), (9, None, "a"), (9, "", "b")}


def test_a_group_over_several_blocks(spark, odd, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    words = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*words[:i * 2], f"n{i}", *words[i * 2 + 1:]])) for i in range(60)]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 59)}


def test_shards(spark, odd, none, tmp_path):
    docs = [(r["doc_id"], len((r["text"] or "").encode())) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    import hashlib

    bits = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i, _ in docs}

    def split(rows, depth):
        if sum(n for _, n in rows) <= 9_000 or len(rows) == 1:
            return {i: f"{depth}-{bits[i] >> (60 - depth)}" for i, _ in rows}
        halves = [[r for r in rows if bits[r[0]] >> (59 - depth) & 1 == b] for b in (0, 1)]
        return {k: v for h in halves if h for k, v in split(h, depth + 1).items()}

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, _ = extendible_shards.assigned(table, limit=9_000)
    assert {r["doc_id"]: r["shard"] for r in rows.collect()} == split(docs, 0)
    extendible_shards.write_shards(odd, str(tmp_path / "s"), limit=60_000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd.count()
    assert extendible_shards.assigned(none)[0].count() == 0


def test_mix(spark, odd, none):
    rows = source_mix.shares(odd, (5, 2, 1)).collect()
    size = {r["doc_id"]: r["size"] for r in rows}
    assert size[3] == size[4] == size[5] == 0 and size[6] == 40_001
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    mixed = source_mix.mixed_rows(odd, (5, 2, 1))
    assert mixed.columns == odd.columns
    taken = {i: sum(r["taken"] for r in rows if r["doc_id"] == i) for i in size}
    words = collections.Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    assert +words == +collections.Counter(taken)
    assert source_mix.shares(none, (5, 2, 1)).count() == 0


def test_neighbours(spark, none):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [1.0]), (9400, [None] * 16), rows[5]]
    table = spark.createDataFrame(rows, "vec_id long, vector array<float>")
    got = collections.defaultdict(list)
    for r in curve_neighbours.search(table, F.col("vec_id") % 100 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        want = [int(i) for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(s == d[i] for _, i, s in found)
        hits += len(set(want) & {i for _, i, _ in found})
    assert set(got) == set(range(0, 3000, 100)) and hits >= 0.9 * 300
    assert sorted(i for _, i, _ in got[300]) == list(range(100, 110))
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, vector array<float>")
    assert [r[:3] for r in curve_neighbours.search(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert curve_neighbours.search(table.limit(0), F.lit(True)).count() == 0


def test_vectors_of_doubles(spark):
    rows = [(i, [float(i), 1.0 / 3]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = curve_neighbours.search(table, F.col("vec_id") == 0, k=3).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_neighbours_in_parts_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 6)))], "vec_id long, vector array<double>")
    whole = sorted(map(tuple, curve_neighbours.search(table, F.col("vec_id") % 2 == 0).collect()))
    monkeypatch.setattr(curve_neighbours, "QUERIES", 7)
    assert sorted(map(tuple, curve_neighbours.search(table, F.col("vec_id") % 2 == 0).collect())) == whole


def test_a_rare_language_is_learned(spark):
    ship(spark)
    rows = [(i, f"the old house and the green tree {i}", "en") for i in range(300)] + [(1000 + i, "старый дом и зелёное дерево", "ru") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(language_cnn.fit(docs, most=20).languages) == ["en", "ru"]


def test_a_cut_row_is_a_beginning_of_its_text(spark):
    text = "\n one\ttwo \n\nthree  four\x0bfive \n"
    docs = spark.createDataFrame([(i, text, "a") for i in range(3)] + [(i, "x " * 40, "b") for i in range(9, 12)], "doc_id long, text string, source string")
    got = [r["text"] for r in source_mix.mixed_rows(docs, (1, 20)).filter("source = 'a'").collect()]
    cut = [x for x in got if x != text]
    assert cut and all(text.startswith(x) and x[-1].strip() for x in cut)


CLASHING = ("doc_id long, text string, source string, n_chars long, _text string, _lines string, _new string, _doc string, "
            "_v string, _row string, decoded string, piece_ids string, row string, own string, gone string, at string")


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    ship(spark)
    texts = ["one line here that is long enough to count\nanother of them, all different", None, "", "one line here that is long enough to count\nthird text"]
    rows = [(i, t, "s", 0, *"abcdefghijkl") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, CLASHING)
    for stage in (corpus_pipeline.drop_repeated_lines, corpus_pipeline.one_of_each_group, corpus_pipeline.mix_sources):
        out = stage(spark, docs, SMALL)
        assert out.schema.names == docs.columns
        assert {tuple(r)[4:] for r in out.collect()} == {tuple("abcdefghijkl")}
    out = corpus_pipeline.encode_pieces(spark, docs, SMALL)
    assert out.columns == [*docs.columns, "piece_ids_", "n_best_scores", "decoded_"]
    assert all(r["decoded_"] == (r["text"] or "") for r in out.collect())


def near(a, b, threshold=0.8):
    return len(a & b) >= threshold * len(a | b) - 1e-9 and bool(a & b)


def brute_lines(rows):
    """Stage 2 by comparing all lines: ``(doc_id, text, …)`` rows to those that stay, with their new texts."""
    places = sorted({(r[0], r[1], n, line) for r in rows for n, line in enumerate((r[1] or "").split("\n")) if WORD.search(line)},
                    key=lambda p: (p[0], p[2]))
    lines = list(dict.fromkeys(p[3] for p in places))
    sets = [frozenset(x.encode()[k:k + 8] for k in range(max(1, len(x.encode()) - 7))) for x in lines]
    roots = union([p for p in itertools.combinations(range(len(sets)), 2) if near(sets[p[0]], sets[p[1]])], range(len(sets)))
    first = {}
    for p in places:
        first.setdefault(roots[lines.index(p[3])], p)
    kept = {p[:3] for p in first.values()}
    out = []
    for r in rows:
        had = [(n, x) for n, x in enumerate((r[1] or "").split("\n"))]
        left = [x for n, x in had if not WORD.search(x) or (r[0], r[1], n) in kept]
        if len(left) == len(had):
            out.append(r)
        elif any(WORD.search(x) for x in left):
            out.append((r[0], "\n".join(left), *r[2:]))
    return out


def brute_groups(rows):
    """Stage 3 by comparing all documents."""
    rows = sorted(rows, key=lambda r: r[0])
    sets = []
    for r in rows:
        words = WORD.findall(r[1] or "")
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    roots = union([p for p in itertools.combinations(range(len(sets)), 2) if near(sets[p[0]], sets[p[1]])], range(len(sets)))
    return [r for i, r in enumerate(rows) if roots[i] == i and (i == 0 or r not in rows[:i])]


def test_stages_equal_brute_force(spark):
    """Stages 2, 3 and 5 row by row on documents with repeats; stage 4 by its totals."""
    import corpus_pipeline

    ship(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").filter("doc_id < 60")
    plain = [tuple(r) for r in docs.collect()]
    extra = [(200 + i, t + (" one more word" if i % 2 else ""), s) for i, (_, t, s) in enumerate(plain[:8])] + [(300, None, "src0"), (301, "", None)]
    rows = plain + extra + extra[:2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, SMALL)
    got = collections.Counter(tuple(r) for r in lines.collect())
    assert got == collections.Counter(brute_lines(rows))
    groups = collections.Counter(tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, SMALL).collect())
    assert groups == collections.Counter(brute_groups(rows))
    taken = {r["doc_id"]: r["taken"] for r in source_mix.shares(docs.dropDuplicates(), (5, 2, 1)).collect()}
    words = collections.Counter()
    for r in corpus_pipeline.mix_sources(spark, docs.dropDuplicates(), SMALL).collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    assert +words == +collections.Counter(taken)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in corpus_pipeline.encode_pieces(spark, docs, SMALL).collect():
        assert r["decoded"] == (r["text"] or "") and (bool(r["piece_ids"]) == bool(r["text"]))
        assert all(0 <= i < model.get_piece_size() for i in r["piece_ids"])


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    assert rows and set(docs.columns) < set(out.columns) and all(r["decoded"] == r["text"] for r in rows)


def test_scratch_keeps_only_the_last_table_of_a_name(spark):
    tables = components.Scratch(spark)
    once = tables.written(spark.range(5), "t")
    first = tables.paths["t"]
    twice = tables.written(once.selectExpr("id * 2 AS id"), "t")
    assert sorted(r["id"] for r in twice.collect()) == [0, 2, 4, 6, 8]
    assert not Path(first).exists() and Path(tables.paths["t"]).exists()
    last = tables.paths["t"]
    tables.drop_all()
    assert not Path(last).exists() and not tables.paths


@pytest.mark.parametrize("block", [2, 256])
def test_likely_members_are_those_with_a_partner_in_another_component(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "MARKS_BLOCK", block)
    bins = [f"m{i}" for i in range(2 * line_dedup.BANDS)]
    rng, rows = random.Random(3), []
    for k in range(40):
        rows.append([k, 7, 9] + [rng.choice([1, 2, None]) for _ in bins[2:]])
    sketch = spark.createDataFrame(rows, "k long, " + ", ".join(f"{m} int" for m in bins))
    component = {k: k // 3 for k in range(40)}
    members = spark.createDataFrame([(5, 0, k, c) for k, c in component.items()], "band long, at int, k long, c long")
    got = {r["k"] for r in line_dedup.likely_members(sketch, members).collect()}
    want = {a[0] for a in rows for b in rows if component[a[0]] != component[b[0]]
            and sum(x == y for x, y in zip(a[1:], b[1:])) >= line_dedup.AGREE}
    # The few bits of a bin may make more members likely, never fewer
    assert want and want <= got


@pytest.mark.parametrize("block", [7, 2048])
def test_possible_pairs_are_few_and_miss_no_near_pair(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng, texts = random.Random(5), []
    original = "".join(rng.choices("abcdefghij", k=200))
    for edits in [0, 1, 2, 3, 5, 8, 12, 20] * 5:
        copy = list(original)
        for at in rng.sample(range(200), edits):
            copy[at] = rng.choice("#%&$")
        texts.append("".join(copy))
    texts = list(dict.fromkeys(texts))
    sets = [{x[k:k + 8] for k in range(len(x) - 7)} for x in texts]
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(range(len(texts)), 2)}
    odd = line_dedup.odd_sketches(spark.createDataFrame([(k, x.encode()) for k, x in enumerate(texts)], "k long, b binary"))
    # All lines share two bands, and their bits exclude no pair
    members = spark.createDataFrame(
        [(band, k, k, 0, [3, 4]) for band in (3, 4) for k in range(len(texts))],
        "band long, k long, c long, bits long, bands array<long>").join(odd, "k")
    assert {r["k"]: r["n"] for r in odd.collect()} == {k: len(x) for k, x in enumerate(sets)}
    rows = [(r["a"], r["b"]) for r in line_dedup.possible_pairs(members, 0.8, components.Scratch(spark)).collect()]
    assert len(rows) == len(set(rows)) and {p for p, s in alike.items() if s >= 0.8} <= set(rows)
    assert all(alike[p] > 0.65 for p in rows) and len(rows) < len(alike) / 2
    pivots = [(r["a"], r["b"]) for r in line_dedup.pivot_pairs(members, 0.8, components.Scratch(spark)).collect()]
    assert len(pivots) == len(set(pivots)) and set(pivots) <= set(rows)


def test_components_shorten_long_chains_in_few_tables(spark, monkeypatch):
    names, written = [], components.Scratch.written
    monkeypatch.setattr(components.Scratch, "written", lambda self, df, name: names.append(name) or written(self, df, name))
    links = spark.createDataFrame([(k, k + 1) for k in range(64)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components.components(links).collect()} == {(k, 0) for k in range(1, 65)}
    # A table of hooks, and one for each two of the seven jumps
    assert names.count("roots") <= 5


def test_lines_without_open_bands_are_not_searched_again(spark, monkeypatch):
    def searched(*_):
        raise AssertionError("there is nothing to search")

    monkeypatch.setattr(line_dedup, "links_within", searched)
    one = "A line that is about as long as most lines are, number one."
    assert found_line_classes(spark, [one, one.replace("one.", "one!"), "Another line.", ""]) == 2
    assert found_line_classes(spark, [""]) == 0


def test_a_band_of_two_lines_is_one_row_and_larger_ones_are_whole(spark):
    bins = [f"m{i}" for i in range(2 * line_dedup.BANDS)]
    rng = random.Random(4)
    rows = [[k, *(rng.choice([1, 2, 3, None]) for _ in bins)] for k in range(60)]
    sketch = spark.createDataFrame(rows, "k long, " + ", ".join(f"{m} int" for m in bins))
    want = collections.defaultdict(set)
    for k, *m in rows:
        for i in range(line_dedup.BANDS):
            if (ends := (m[2 * i], m[2 * i + 1])) != (None, None):
                want[i, ends].add(k)
    got = collections.defaultdict(list)
    for r in line_dedup.shared_bands(sketch).collect():
        got[r["band"]].append((r["k"], r["low"], r["high"], r["n"], r["bits"] is None))
    assert sorted(sorted(x) for x in got.values()) == sorted(
        sorted((k, min(ks), max(ks), len(ks), len(ks) == 2) for k in (ks if len(ks) > 2 else [min(ks)]))
        for ks in want.values() if len(ks) > 1)


def test_the_shingles_of_a_pair_are_made_once(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    texts = spark.createDataFrame([(1, b"0123456789abcdefgh"), (2, b"0123456789abcdefghi"), (3, b"other text")], "k long, b binary")
    verified = line_dedup._verified(pairs, texts, 0.8)
    assert [tuple(r) for r in verified.collect()] == [(1, 2)]
    assert verified._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") == 2
