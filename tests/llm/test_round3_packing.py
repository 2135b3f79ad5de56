"""What packing holds in a Python worker: no encoder tables that it does not use, few words, few bytes of rows."""

import gc
import tracemalloc
import weakref

import pytest
from public_tokenizers import path

from rtdw.llm import bpe, packing

TEXTS = [
    "don't 1234 a,b ,, 'S ''s x's, word word, word. Word",
    "é² ½ A!? ª ٣٤ 𝟘𝟙 <|endoftext|> 's's 're'",
    "Σας ΟΔΟΣ, \x1c a\x1d ⅷ, Ⓐ. ǅ! ﬁ; क्ष, हिन्दी, 中文。",
    "x" * 100 + " " + "y" * 63 + ",",
    "Yes. no, 12; 3,4: 'tis's! a_, a.. b.,\nc?\td! İ, क़. é, (x). A\x1c,\x1cb, e\u0301. e.\u0301 ,<|endoftext|>z.<|startoftext|>.",
    "",
    None,
]


@pytest.fixture(scope="module")
def content():
    with open(path("word_bpe_49k.json"), "rb") as file:
        return file.read()


def test_library_encoder_holds_no_tables(content):
    """Each worker held the automaton and the tables of merges of the other encoder, which it never asked."""
    tracemalloc.start()
    library = bpe.LibraryBpe(content)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert library.encode("a word") and held < 4 << 20


@pytest.mark.parametrize("cached", [3, 200_000])
def test_one_memory_for_words_and_runs(content, monkeypatch, cached):
    own, library = bpe.WordBpe(content), bpe.LibraryBpe(content)
    monkeypatch.setattr(bpe.LibraryBpe, "cached", cached)
    assert library.added == own.added
    for text in TEXTS * 2:
        assert library.encode(text) == own.encode(text)
        assert library.chunks is library.words and len(library.words) <= cached + 2


def test_rows_go_back_by_bytes():
    """Rows were counted only: 5,000 full windows are 80 MB of ids."""
    packer, sizes = packing._Packer(0, 1 << 20), []
    for doc in range(300):
        packer.add(doc, bytes(4 * 5 * packing.WINDOW))
        if packer.full():
            sizes.append(packer.take(True)["ids"].map(len).sum())
    sizes.append(packer.take(True)["ids"].map(len).sum())
    assert sum(sizes) == 300 * 4 * 5 * packing.WINDOW
    assert max(sizes) <= packing.ROW_BYTES + 4 * 5 * packing.WINDOW


def test_marks_behind_a_word_make_no_new_words(content):
    """Only one mark behind an ASCII letter was split off, so ``word,##`` was a run of its own, asked for and remembered."""
    library, own = bpe.LibraryBpe(content), bpe.WordBpe(content)
    text = "word word,## Word!!! word.\nreé, reé,*** reé (9) 9).."
    assert library.encode(text) == own.encode(text)
    assert set(library.words) == {"word", ",##", "!!!", ".", "reé", ",", ",***", "(9", "(", "9", ")", ").."}
    for text in ("a',## x×, µ.. é,! İ,, क़.. ª, ß.. a_' 's' b's,' <|endoftext|>, a<|x|>. a.́! a,\x1c,,b",):
        assert library.encode(text) == own.encode(text)


def test_words_of_a_task_are_asked_once(content, monkeypatch):
    """All words were forgotten at 200,000, and a task of 26 MB asked for half of them again."""
    library, asked = bpe.LibraryBpe(content), []
    monkeypatch.setattr(bpe, "pack_ids", lambda ids: asked.append(ids) or b"")
    letters = "abcdefghijklmnop"
    text = " ".join(a + b + c + d + e for a in letters for b in letters for c in letters for d in letters for e in letters[:4])
    library.encode(text)
    assert len(asked) == 16**4 * 4
    library.encode(text)
    assert len(asked) == 16**4 * 4


def test_encoder_goes_with_its_task(content):
    """Nothing that it holds refers to it, so its words go at once and do not wait for the collector."""
    library = bpe.LibraryBpe(content)
    library.encode("a word, or two")
    gone = weakref.ref(library.words)
    gc.disable()
    try:
        del library
        assert gone() is None
    finally:
        gc.enable()


def test_partition_that_does_not_fit_ends_early():
    assert packing.difference([3000, 3000, 3000], 2, 4096) is None
    assert sorted(packing.partition([3000, 3000, 3000, 1000]).tolist()) == [0, 0, 1, 2]
