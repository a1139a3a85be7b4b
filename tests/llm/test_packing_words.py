"""Words of many texts looked up once each; the ids stay the tokenizer's."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from ordermill.llm import packing
from ordermill.llm.queries import tokenizer_file

PATH = tokenizer_file(packing.TOKENIZER)


def test_each_different_word_is_looked_up_once():
    found, ends = packing.Words.words(["By the way, the\tway!\nthe", "", "way", " the<|way... "])
    words = found.dictionary.to_pylist()
    assert words == ["By", "the", "way", ",", "!", "", "the<|way..."]
    taken = [words[i] for i in found.indices.to_pylist()]
    assert [taken[a:b] for a, b in zip([0, *ends], ends)] == [
        ["By", "the", "way", ",", "the", "way", "!", "the"], [""], ["way"], ["", "the<|way...", ""]]


def test_ids_of_texts_are_the_tokenizers():
    words, rnd = packing.Words(PATH), random.Random(11)
    bits = ["eau", "Été,", "by", "BY!!", "İ.", "x<|endoftext|>.", "<|endoftext|>", "<", "|>", "漢字。", "é,", "3.14", "\x00", " ",
            "...", "don't", "a" * 50, "\x85", "\x1f", "\U0001f600!"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", " ", "  ", "\n", "\t", "\r\n"]) for _ in range(rnd.randint(0, 30)))
             for _ in range(500)]
    assert words.ids([]) == []
    for _ in range(2):                                      # the second time from memory
        got = [np.frombuffer(x, "<u2").tolist() for x in words.ids(texts)]
        assert got == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_parts_cover_every_row(monkeypatch):
    monkeypatch.setattr(packing, "PART", 10)
    for texts in [[], [""], ["x" * 25, "", "", "y" * 4, "z" * 9, "a"], ["q"] * 40]:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        parts = [p.column("text").to_pylist() for p in packing._parts(batch)]
        assert [t for p in parts for t in p] == texts and all(parts)


class OnlyFast:
    """The tokenizer without its encoding by places."""

    def __init__(self, tokenizer):
        self.encode_batch_fast = tokenizer.encode_batch_fast


def test_words_of_letters_are_told_apart_by_the_ids_that_end_them():
    words, rnd = packing.Words(PATH), random.Random(12)
    letters = [c for c in map(chr, range(0x250)) if c.isalpha() and c != "İ"] + list("漢字жЖαΣ")
    many = list({"".join(rnd.choices(letters, k=rnd.randint(1, 12))) for _ in range(3000)})
    want = {w: np.array(words.tokenizer.encode(w, add_special_tokens=False).ids, "<u2").tobytes() for w in many}
    tokenizer, words.tokenizer = words.tokenizer, OnlyFast(words.tokenizer)
    assert words.encoded(many) == want
    words.tokenizer = tokenizer                             # a line with a word of two pre-tokens: by places
    mixed = many[:100] + ["aİb", "İ"]
    assert words.encoded(mixed) == {w: np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u2").tobytes() for w in mixed}
    words.last = None                                       # a tokenizer that does not tell
    assert words.encoded(mixed) == {w: np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u2").tobytes() for w in mixed}


def test_words_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    words = packing.Words(PATH)
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)} other" for i in range(200)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u2").tolist() for x in words.ids(texts)]
        assert got == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(words.known) <= 50


def test_words_of_a_part_take_little_memory():
    rnd = random.Random(13)
    text = " ".join("".join(rnd.choices("abcdef", k=rnd.randint(2, 8))) + rnd.choice(["", "", ",", "!?"]) for _ in range(200_000))
    packing.Words.words([text[:1000]])
    tracemalloc.start()
    packing.Words.words([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(text)


def test_ids_of_arrow_arrays():
    words = packing.Words(PATH)
    texts = ["by the way", "", "Été, été", "<|endoftext|> x"]
    for kind in (pa.string(), pa.large_string()):
        sliced = pa.array(["left out", *texts, "too"], kind).slice(1, 4)
        assert words.ids(sliced) == words.ids(texts) and words.ids(sliced.slice(0, 0)) == []
