"""Plain words are encoded without a pattern, and special texts found without one, as the library has them."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlake.llm.library_tokens import LibraryEncoder

WORDS = ["Hello", "wörld", "HELLO.", "it's", "a", ".", "!", "x9", "9", "don't!", "end?!", "tail)", "Straße,", "I", "KelvinK", "s:"]


class _Unused:
    def __getattr__(self, name):
        raise AssertionError(name)


def test_words_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, found = Tokenizer.from_file(path), LibraryEncoder(path)
    texts = [*WORDS, " ".join(WORDS), "a\x1cb", "a<|endoftext|>b", "a<|b", "<|start", ""]
    for text, ids in zip(texts, found.by_words(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_letters_and_a_mark_need_no_pattern():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, found = Tokenizer.from_file(path), LibraryEncoder(path)
    found.word_pattern = _Unused()
    text = "Plain Words, and more: nothing ELSE! is it? no; yes."
    assert np.frombuffer(found.by_words([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_texts(name):
    found = LibraryEncoder(public_tokenizers.path(name))
    assert all(found._special(text) for text in ("<|endoftext|>", "a \x1c b", "a\x1f", "x<|endoftext|>y"))
    assert not any(found._special(text) for text in ("", "<|", "endoftext", "a b\n\x1b"))
