"""What the classifiers read, against plain loops over the texts."""

import collections
import random

import numpy as np
import pytest
from sluicework.llm import byteconv, quality_rules

ALPHABET = "ab \n.éßЖ日本語\U0001F600́"
TEXTS = ["", "a", "é", "日本", "ab日\U0001F600é", "x" * 700, *(
    "".join(random.Random(seed).choices(ALPHABET, k=size)) for seed, size in enumerate((3, 5, 40, 511, 600, 1300)))]


def joined(texts):
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])])


def test_grams_are_those_of_characters():
    data, at = joined(TEXTS)
    words = quality_rules._hashed_words(data, at)
    found = quality_rules.features(data, at, words)[2:]
    chars, rows = quality_rules.characters(data, at)
    assert [int(c).to_bytes(8, "little").rstrip(b"\0").decode() for c in chars] == list("".join(TEXTS))
    assert np.bincount(rows, minlength=len(TEXTS)).tolist() == [len(t) for t in TEXTS]
    for n, (slots, of) in zip(quality_rules.CHARACTER_GRAMS, found, strict=True):
        expected = [(row, t[i:i + n]) for row, t in enumerate(TEXTS) for i in range(len(t) - n + 1)]
        assert of.tolist() == [row for row, _ in expected]
        slot_of = {}
        for slot, (_, gram) in zip(slots.tolist(), expected, strict=True):
            assert slot_of.setdefault(gram, slot) == slot, "equal grams share a slot, in every row"
        assert len(set(slot_of.values())) > 0.98 * len(slot_of)


def test_a_cut_character_ends_with_its_row():
    data, at = joined(["ab日".encode()[:-1], "日本".encode()[1:], b"\xa5"])
    chars, rows = quality_rules.characters(data, at)
    assert rows.tolist() == [0, 0, 0, 1]
    assert int(chars[2]).to_bytes(8, "little").rstrip(b"\0") == "日".encode()[:2]
    assert int(chars[3]).to_bytes(8, "little").rstrip(b"\0").decode() == "本"


@pytest.mark.parametrize(("length", "stride"), [(16, 16), (16, 8), (512, 384)])
def test_chunks_cover_every_byte(length, stride):
    data, at = joined(TEXTS)
    starts, rows = byteconv.chunk_starts(at, length, stride)
    seen = collections.defaultdict(set)
    for start, row in zip(starts, rows, strict=True):
        assert start >= at[row]
        seen[row] |= set(range(start, min(start + length, at[row + 1])))
    assert all(seen[r] == set(range(at[r], at[r + 1])) for r in range(len(TEXTS)))
    span = length + 3
    chunks = byteconv.chunk_bytes(data, at, starts, rows, length, span)
    for chunk, start, row in zip(chunks, starts, rows, strict=True):
        inside = data[start:min(start + span, at[row + 1])]
        assert chunk.tobytes() == inside.tobytes().ljust(span, b"\0")


def test_pooling_is_the_greatest_sum_of_taps():
    taps = byteconv.fresh_taps({2: 3, 3: 2, 4: 2}, seed=3)
    length, span = 20, 23
    chunks = np.random.default_rng(1).integers(0, 256, (5, span), dtype=np.uint8)
    best, where = byteconv.Filters(taps).pooled(chunks, length, places=True)
    assert np.array_equal(best, byteconv.Filters(taps).pooled(chunks, length))
    column = 0
    for tap in taps:
        for f in range(tap.shape[2]):
            for n, chunk in enumerate(chunks):
                sums = [sum(float(tap[k, chunk[i + k], f]) for k in range(len(tap))) for i in range(length)]
                assert best[n, column] == pytest.approx(max(sums), abs=1e-5)
                assert sums[where[n, column]] == pytest.approx(max(sums), abs=1e-5)
            column += 1
    assert column == best.shape[1]
