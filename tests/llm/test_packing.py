import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailmark.llm import packing
from trailmark.llm.packing import Stream, best_cuts, candidates, pack, powers, tail_cost

PATH = public_tokenizers.path("word_bpe_49k.json")


def quadratic(places, costs, capacity, closing):
    """The least cost, over all ways to cut."""
    ends, price = [0, *places], [0.0, *costs]
    total = [0.0]
    for j in range(1, len(ends)):
        total.append(price[j] + min(total[i] + capacity - ends[j] + ends[i] for i in range(j) if ends[j] - ends[i] <= capacity))
    return min(t + closing(ends[-1] - e) for t, e in zip(total, ends) if ends[-1] - e <= capacity)


@pytest.mark.parametrize("seed", range(6))
def test_cuts_cost_as_little_as_the_quadratic_programme_finds(seed):
    chance = random.Random(seed)
    gaps = [chance.randrange(1, 12) for _ in range(150)]
    places, costs = np.cumsum(gaps), np.array([chance.choice([0.0, 4.0, 16.0]) for _ in gaps])
    for closing in (lambda n: 0.0, lambda n: tail_cost(n, 40)):
        cuts = best_cuts(places, costs, 40, closing)
        ends = [0, *places[cuts].tolist()]
        sizes = np.diff(ends)
        assert (sizes <= 40).all() and places[-1] - ends[-1] <= 40
        assert (40 - sizes).sum() + costs[cuts].sum() + closing(int(places[-1]) - ends[-1]) == pytest.approx(
            quadratic(places.tolist(), costs.tolist(), 40, closing)
        )


def test_candidates_lie_at_sentences_and_never_far_apart():
    places, costs = candidates(np.array([3, 10, 500]), 501)
    assert places[-1] == 501 and costs[-1] == 0 and np.diff(places, prepend=0).max() <= packing.STEP
    assert dict(zip(places.tolist(), costs.tolist()))[10] == packing.SENTENCE
    assert candidates(np.array([], int), 1)[0].tolist() == [1]


def test_a_stream_keeps_order_and_loses_nothing(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 300)
    chance = random.Random(2)
    documents = [np.array([chance.randrange(1000) for _ in range(chance.choice([1, 5, 40, 700]))]) for _ in range(120)]
    stream, pieces = Stream(64), []
    for row, ids in enumerate(documents):
        pieces += stream.add(row, ids, np.arange(7, len(ids), 9))
    pieces += stream.cut(last=True)
    assert np.concatenate([p[2] for p in pieces]).tolist() == np.concatenate(documents).tolist()
    sequences = {}
    for row, start, ids, whole, sequence, offset in pieces:
        assert whole == len(documents[row]) and documents[row][start : start + len(ids)].tolist() == ids.tolist()
        assert sequences.setdefault(sequence, 0) == offset
        sequences[sequence] += len(ids)
    sizes = np.array(list(sequences.values()))
    assert sizes.max() <= 64 and list(sequences) == list(range(len(sizes)))
    assert np.where(sizes & (sizes - 1), 64 - sizes, 0).sum() < 0.2 * sizes.sum()
    assert sum(powers(45)) == 45 and powers(64) == [64]


def test_pieces_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "One. Two three.", 4: "word. " * 9000, 5: "|" * 100}
    rows = [(i, t, "s", 1) for i, t in texts.items()] + [(None, "null id", "s", 1), (3, texts[3], "s", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int").coalesce(2)
    pieces = pack(frame, PATH).orderBy("sequence_id", "offset").collect()
    model = Tokenizer.from_file(PATH)
    size, ids = {}, {}
    for p in pieces:
        own = np.frombuffer(p.ids, "<u4")
        assert len(own) == p.length and size.setdefault(p.sequence_id, 0) == p.offset
        size[p.sequence_id] += p.length
        ids.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, own.tolist()))
    assert max(size.values()) <= 4096
    expected = {i: model.encode(t or "", add_special_tokens=False).ids + [2] for i, t in [*texts.items(), (None, "null id")]}
    for (i, n), parts in ids.items():
        assert n == len(expected[i])
        if i != 3:
            assert sum((x for _, x in sorted(parts)), []) == expected[i]
    assert sorted(ids[(3, len(expected[3]))]) == [(0, expected[3])] * 2
    assert {i for i, _ in ids} == set(expected)
    assert pack(frame.where(F.lit(False)), PATH).count() == 0
