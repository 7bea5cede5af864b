import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from trailmark.llm import tokens
from trailmark.llm.tokens import PieceCounter, WordEncoder, count_tokens, parts, slices

AWKWARD = [
    "", " ", "   ", "a", "a b", " a  b ", "a\nb c", "a \n b", "\t\ttab", "x ▁y", "▁", "▁▁ a", "<s> x </s> y", "<unk>",
    "don't they'll we've I'm 've", "ÉCOLE, Straße! naïve.", "Ǆ ŉ İstanbul ſ", "é ́x á, ",
    "<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|> x", "日本語 テキスト 한국어", "a b c　d",
    "\x01 x a\x01b \x00", "12 345 6,789.00", "wow!!! &&& %%% ### a*** b$$$", "emoji 😀😀 fin.", "x" * 5000, "a b " * 3000,
    "‍​ z", "Ünïcödé.,!?", "é.", "ª. º! ß?",
]


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(3)
    letters = list("abcdeé ßüñ  \n\t.,!?'&*%$#0123▁") + ["the ", "and ", " ́", "日"]
    return AWKWARD + ["".join(chance.choice(letters) for _ in range(chance.randrange(1, 300))) for _ in range(300)]


def test_slices_and_parts_cut_at_safe_spaces_only():
    assert list(slices("ab cd  ef gh", 3)) == ["ab cd  ef", "gh"]
    assert parts("a b") == ["a", "b"] and parts(" a  b c ") == [" a  b", "c "]
    assert [" ".join(slices(t, 5)) for t in AWKWARD] == AWKWARD


def test_counts_are_the_librarys(texts, monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = [len(model.encode(t)) for t in texts]
    assert [PieceCounter(path).count(t) for t in texts] == expected
    counter = PieceCounter(path)
    assert [counter.count(t) for t in texts] == expected == [counter.count(t) for t in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 5)  # forgets all the time
    assert [counter.count(t) for t in texts] == expected


def test_ids_are_the_librarys(texts, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    expected = [model.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = WordEncoder(path)
    for remembered in (10**6, 5):
        monkeypatch.setattr(WordEncoder, "REMEMBERED", remembered)
        for size in (1, 50, len(texts)):
            found = []
            for i in range(0, len(texts), size):
                found += list(encoder.batch_ids([t.encode() for t in texts[i : i + size]]))
            assert [ids.tolist() for ids, _ in found] == expected
    (ids, ends), (none, no_ends) = encoder.batch_ids([b"One two. Three!", b""])
    assert ends.tolist() == [len(model.encode("One two.").ids), len(ids)] and not len(none) and not len(no_ends)
    assert ids.dtype == np.int32


def test_odd_rows(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(1, None, "x", 7), (None, "", "x", 7), (2, "a b", None, 7), (2, "a b", None, 7), (3, "w " * 5000, "x", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, found int")
    got = count_tokens(frame, path)
    assert got.columns == ["doc_id", "text", "n_tokens", "found", "n_bytes", "over_limit"]
    found = sorted(tuple(r) for r in got.select(F.coalesce("doc_id", F.lit(0)), "n_bytes", "n_tokens", "over_limit", "found").collect())
    assert found == [(0, 0, 0, False, 7), (1, 0, 0, False, 7), (2, 3, 2, False, 7), (2, 3, 2, False, 7), (3, 10000, 5001, True, 7)]
    assert count_tokens(frame.limit(0), path).count() == 0


def test_ids_of_every_latin_letter_before_every_sign():
    """U+0130 lower-cases to a letter and a sign; so its run of signs is another."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model, encoder = Tokenizer.from_file(path), WordEncoder(path)
    letters = [chr(c) for c in range(0x21, ord(WordEncoder.LATIN)) if not chr(c).isspace()]
    words = ["TEDAVİSİ.", "İ!", "Aİ,", "ABİ?", "İstanbul", "İİ..", "iİ!?"]
    words += [a + s for a in letters for s in WordEncoder.SIGNS] + [f"x{a}{s}{s}" for a in letters for s in ".!"]
    found = [ids.tolist() for ids, _ in encoder.batch_ids([w.encode() for w in words])]
    wrong = [w for w, ids in zip(words, found, strict=True) if ids != model.encode(w, add_special_tokens=False).ids]
    assert wrong == []


def test_long_words_are_not_remembered():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model, encoder = Tokenizer.from_file(path), WordEncoder(path)
    chance = random.Random(8)
    long = ["".join(chance.choice("abcXYZ019+/") for _ in range(20_000)) for _ in range(30)]
    texts = [f"the {x} word. {x[:70]} end" for x in long]
    want = [model.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [ids.tolist() for ids, _ in encoder.batch_ids([t.encode() for t in texts])] == want
    assert set(encoder.place) == {b"the", b"word", b".", b"end"} and len(encoder.first) == 4 and encoder.used < 10


def test_batches_go_to_the_library_by_bytes(texts, monkeypatch):
    """Few calls for many texts, and none above the limit."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter, plain = PieceCounter(path), PieceCounter(path)
    want = [plain.count(t) for t in texts]
    calls = []

    class Model:
        def encode(self, batch, num_threads):
            calls.append(sum(len(x.encode()) for x in batch))
            return plain.model.encode(batch, num_threads=num_threads)

    counter.model = Model()
    monkeypatch.setattr(tokens, "BATCH_BYTES", 2000)
    monkeypatch.setattr(tokens.by_bytes, "__defaults__", (2000,))
    short = [t for t in texts if len(t) < 400]
    assert counter.counts(short) == [n for t, n in zip(texts, want, strict=True) if len(t) < 400]
    assert len(calls) < len(short) / 2 and max(calls) <= 2000 + 400


def test_a_text_of_several_slices():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    chance = random.Random(6)
    text = " ".join(chance.choice(["the", "Straße", "x  y", "日本語", "end.\n", "#", "0123456789" * 9]) for _ in range(90_000))
    assert len(text) > tokens.BATCH_BYTES // 4
    assert PieceCounter(path).counts([text, None, text[:10]])[0] == len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))


def test_an_encoder_remembers_a_bounded_number_of_words():
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(0, 600_000, 20_000):
        for _ in encoder.batch_ids([" ".join(f"q{i:x}" for i in range(k, k + 20_000)).encode()]):
            pass
        assert len(encoder.place) <= 520_000
        assert max(map(len, (encoder.first, encoder.size, encoder.ends))) <= 1 << 20
