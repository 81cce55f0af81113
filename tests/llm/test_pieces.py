"""Words are encoded by way of their pieces, each once, with the ids that the library gives."""

import itertools
import random

import numpy as np

from tidemark.llm import common, token_files

SIGNS = ["a", "b", "Z", "É", "é", "ß", "ÿ", "×", "÷", "Þ", "0", "7", "'", "s", "'s", ".", ",", "$", "<|", "|>", "-", "_", "`", "\x7f", "\x85", "\xa0", "\xaa", "µ",
         "º", "J̌", "é", "İ", "ǰ", "日", "½", "²", "ﬁ", "\x1c", "\x00", "<|endoftext|>"]


def test_pieces_give_the_library_s_ids():
    r = random.Random(4)
    words = sorted({"".join(r.choice(SIGNS) for _ in range(r.randint(1, 6))) for _ in range(8000)} | set(SIGNS))
    texts = [w.encode() for w in words]
    ids, ends = token_files.WordEncoder().encode(texts, 2)
    got = [x.tolist() for x in np.split(ids, ends[:-1])]
    want = [e.ids + [2] for e in token_files.tokenizer().encode_batch(words, add_special_tokens=False)]
    assert got == want


def test_words_of_the_same_pieces_are_not_encoded_again(monkeypatch):
    sent = []
    if hasattr(token_files, "_encoded"):
        encoded = token_files._encoded
        monkeypatch.setattr(token_files, "_encoded", lambda tokenizer, texts: sent.extend(texts) or encoded(tokenizer, texts))
    own = token_files.WordEncoder()
    words = [a + b for a, b in itertools.product(("maison", "Maison", "MAISON", "été"), ("", ".", ",", "$$$", "7"))]
    own.encode([" ".join(words).encode()], 2)
    assert sorted(sent) == sorted({"maison", "été", ".", ",", "$$$", "7"})


def test_a_batch_s_words_are_looked_up_once_each(monkeypatch):
    asked, numbers = [], common.Words.numbers
    monkeypatch.setattr(common.Words, "numbers", lambda self, split: asked.extend(w for x in split for w in x) or numbers(self, split))
    own = token_files.WordEncoder()
    texts = [b" one two\x0bone \x1cthree", b"", b"\t\n", "été one\r\x0cété\x85".encode(), b"two"]
    ids, ends = own.encode(texts, 2)
    got = [x.tolist() for x in np.split(ids, ends[:-1])]
    assert got == [e.ids + [2] for e in token_files.tokenizer().encode_batch([t.decode() for t in texts], add_special_tokens=False)]
    assert sorted(asked) == sorted({w for t in texts for w in t.split()})
