import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunelake.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def filled(runs):
    """Lengths in each sequence by offset, from the runs."""
    found = {}
    for run in runs:
        for i in range(run.count):
            offset = run.offset + i % run.each * run.length
            found.setdefault(run.sequence + i // run.each, []).append((offset, run.length))
    return {sequence: sorted(places) for sequence, places in found.items()}


def fewest(lengths, capacity):
    """Exact number of sequences by search."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def search(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms) if room >= lengths[at]}.values():
            search(at + 1, [r - lengths[at] * (j == i) for j, r in enumerate(rooms)])
        search(at + 1, [*rooms, capacity - lengths[at]])

    search(0, [])
    return best[0]


def check_plan(counts, capacity):
    runs, sequences = packing.plan_packing(counts, capacity)
    found = filled(runs)
    assert sorted(found) == list(range(sequences))
    placed = {}
    for places in found.values():
        end = 0
        for offset, length in places:
            assert offset == end
            end += length
            placed[length] = placed.get(length, 0) + 1
        assert end <= capacity
    assert placed == {s: n for s, n in counts.items() if n}
    for length in counts:  # numbers of a length are gapless
        own = sorted((r.first, r.count) for r in runs if r.length == length)
        at = 0
        for first, count in own:
            assert first == at
            at += count
        assert at == counts[length]
    return sequences


def test_plans_are_valid_and_near_the_optimum():
    pick = random.Random(2)
    for _ in range(300):
        capacity = pick.choice([10, 17, 24])
        low = pick.choice([1, 3, capacity // 4 + 1])
        lengths = [pick.randint(low, capacity) for _ in range(pick.randint(1, 11))]
        counts = {s: lengths.count(s) for s in lengths}
        sequences = check_plan(counts, capacity)
        best = fewest(lengths, capacity)
        assert best <= sequences <= best + 1


def test_reduction_never_costs_a_sequence():
    pick = random.Random(4)
    for _ in range(300):
        capacity = pick.choice([12, 19, 30])
        low = pick.choice([1, capacity // 5, capacity // 3])
        lengths = [pick.randint(max(1, low), capacity) for _ in range(pick.randint(2, 11))]
        plan = packing._Plan({s: lengths.count(s) for s in lengths}, capacity)
        packing.reduce_by_dominance(plan)
        rest = [s for s, n in plan.left.items() for _ in range(n)]
        assert plan.sequences + fewest(rest, capacity) == fewest(lengths, capacity)


def test_large_counts_stay_a_short_plan():
    pick = random.Random(7)
    counts = {s: pick.randint(0, 10**7) for s in range(1, 4097)}
    runs, sequences = packing.plan_packing(counts, 4096)
    total = sum(s * n for s, n in counts.items())
    assert len(runs) < 60_000 and sequences >= -(-total // 4096)
    placed = {}
    for run in runs:
        placed[run.length] = placed.get(run.length, 0) + run.count
    assert placed == {s: n for s, n in counts.items() if n}


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_as_the_library(library):
    pick = random.Random(3)
    letters = " \t\n\r\x0b\x1c\x85\xa0 aAbBeÉé'stre019²Ⅷ.,!-_🙂漢́İΣςßẞ\x00"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 30))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|StartOfText|>", "x" * 5000, "Été's we'LL 'S 123 ½a", "’‘…€"]
    plain = "abzABZ éÉßøØ'st09²½.,!-_…“”€\n\t "
    texts += ["".join(pick.choice(plain) for _ in range(40)) for _ in range(3000)]
    got = packing.WordTokens(FILE).encode(texts)
    for text, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == library(text), repr(text)


def test_words_are_forgotten_and_learnt_again(library):
    tokens = packing.WordTokens(FILE, 5)
    for text in ["one two three four", "two five six seven", "eight two nine one one"] * 2:
        assert np.frombuffer(tokens.encode([text])[0], "<u4").tolist() == library(text)


def test_pack(make, library, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", 3)
    texts = ["alpha beta " * 30, "gamma", None, "", "some more words here", "gamma"] * 9
    given = [(i if i != 4 else None, t, "x") for i, t in enumerate(texts)] + [(7, "gamma", "x")]
    capacity = 16
    got = packing.pack(make(given, "doc_id long, text string, piece string"), capacity=capacity)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.collect()
    expected = []
    for key, text, _ in given:
        ids = [*library(text or ""), 1]
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            expected.append((key, at // capacity, at, len(part),
                             zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:5]) for r in got)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r.length for r in got)
    assert len(by_sequence) <= -(-total // capacity) + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
