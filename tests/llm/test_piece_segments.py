"""Texts segmented side by side give the ids of one pass over the whole text."""

import random

import numpy as np

from ordermill.llm import piece_scan
from ordermill.llm.queries import tokenizer_file


def _plain(vocab, text):
    best, back = vocab.forward(text, {0: 0})
    return vocab.trace(text, back, len(text)), best[-1]


def test_segments_equal_one_pass():
    vocab, rnd = piece_scan.Vocabulary(tokenizer_file(piece_scan.MODEL)), random.Random(5)
    words = ["eau", "Été", "the", "tion", "naïve", "x²", "²", "co-op", "3.14", "\u0130", "漢字", "\U0001f600", "e\u0301", "%%%", "¿qué?", "\x00",
             "a" * 40, "\u2028", "don't", "\t"]
    texts = ["".join(rnd.choice(words) + rnd.choice(["", " ", "  ", "\n", ", ", ".", "\n\n "]) for _ in range(rnd.randint(0, 40)))
             for _ in range(400)] + ["", " ", "\n", "   \n  "]
    for _ in range(2):                                      # the second time from memory
        assert vocab.segments(texts) == [_plain(vocab, t) for t in texts]


def test_parts_and_a_full_memory(monkeypatch):
    monkeypatch.setattr(piece_scan, "PART", 64)
    monkeypatch.setattr(piece_scan, "CACHE", 3)
    vocab = piece_scan.Vocabulary(tokenizer_file(piece_scan.MODEL))
    texts = [f" word{i} and no. {i * 7919}, again" for i in range(50)]
    assert vocab.segments(texts) == [_plain(vocab, t) for t in texts]
    assert all(np.frombuffer(i, "<u2").size for i, _ in vocab.segments(texts))


def test_cuts_lie_between_characters_and_cross_no_piece():
    vocab = piece_scan.Vocabulary.of(tokenizer_file(piece_scan.MODEL))
    assert not vocab.apart[:, 0x80:0xC0].any()
    for p in vocab.weights:
        b = np.frombuffer(p.encode(), np.uint8)
        assert not vocab.apart[b[:-1], b[1:]].any()
