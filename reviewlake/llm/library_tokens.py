"""Token ids by the tokenizers library, with the ids of text pieces that its rules keep apart cached.

A word between white space has the same ids wherever it stands if the file's pre-tokenizer drops white space. If it splits
by the byte-level pattern, so has a word with the blank before it, and so has what else of white space the pattern
leaves. On a miss a piece in Latin script is cut into the file's pre-tokens, which are cached too, and only a pre-token
never seen goes through the file's model, without the library's rules around it; any other piece goes through the library.
All this is checked against whole texts in the tests. The library takes an added token such as <|endoftext|> out of a
text before these rules, so a text with one is encoded as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

from reviewlake.llm.common import TwoGenerations

CACHE = 250_000
#: White space for Python alone.
_UNLIKE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Bytes that the byte-level alphabet writes as themselves; the others follow from code point 256 on, in order.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Letters that no normal form changes and whose small ones are single letters.
_SMALL = "a-z\u00df-\u00f6\u00f8-\u00ff"
_LATIN = f"A-Z\u00c0-\u00d6\u00d8-\u00de{_SMALL}"
_PLAIN = re.compile(f" ?[!-~{_LATIN}]+")
#: The pattern for plain words in lower case that cuts letters, and one mark after them, as ``_of_word`` does without it.
_LETTERS_APART = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_SMALL}]+|[0-9]|[^\s{_SMALL}0-9]+"
_MARKS = frozenset(".,;:!?")
#: A word with its blank, or white space as the byte-level pattern leaves it.
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: The byte-level pattern within a plain word.
_BYTE_LEVEL = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+")


def byte_alphabet() -> dict[int, int]:
    """The code point that the byte-level alphabet writes for a byte."""
    others = [byte for byte in range(256) if byte not in _PRINTED]
    return {byte: byte for byte in _PRINTED} | {byte: 256 + i for i, byte in enumerate(others)}


def _word_pattern(rules: dict) -> re.Pattern | None:
    """The pattern that cuts plain words in lower case, if the file normalises by NFC and case and knows no other rule."""
    normal, cutting = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
    kinds = [step["type"] for step in normal.get("normalizers", [])]
    steps = cutting.get("pretokenizers", [])
    if kinds != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"}:
        return None
    if [step["type"] for step in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
        return None
    if steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or "Regex" not in steps[0]["pattern"]:
        return None
    return re.compile(steps[0]["pattern"]["Regex"].replace(r"\p{L}", _SMALL).replace(r"\p{N}", "0-9"))


class LibraryEncoder:
    """Ids as little-endian 32-bit bytes, as the library gives them without the tokens it puts around a text."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        added = self.library.get_added_tokens_decoder().values()
        # Without normalisation a token is found as it is written; with it, other spellings may become one.
        # The empty string is in every text.
        self.added = [""] if any(token.normalized for token in added) else [token.content for token in added]
        # What all added tokens begin with: most texts have none of it, and are searched once.
        self.opening = os.path.commonprefix(self.added)
        self.word_pattern = _word_pattern(rules)
        self.letters_apart = self.word_pattern is not None and self.word_pattern.pattern == _LETTERS_APART
        cutting = rules["pre_tokenizer"] or {}
        byte_level = cutting.get("type") == "ByteLevel" and cutting["use_regex"] and not cutting["add_prefix_space"]
        self.piece_pattern = _BYTE_LEVEL if byte_level and rules["normalizer"] is None else None
        self.alphabet = byte_alphabet()
        self.parts = TwoGenerations(self._of_part, cache)
        self.words = TwoGenerations(self._of_word, cache)
        # A pre-token by the byte-level pattern is a piece of its own, so one cache has both.
        self.pieces = TwoGenerations(self._of_piece, cache)

    def forget(self) -> None:
        """Drops the cached ids: workers outlive tasks, and what they hold is there through later stages."""
        for cache in (self.parts, self.words, self.pieces):
            cache.forget()

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _of_part(self, part: str) -> bytes:
        """The ids of a pre-token."""
        written = part.encode("utf-8").decode("latin-1").translate(self.alphabet)
        ids = array("I", [token.id for token in self.library.model.tokenize(written)])
        return ids.tobytes() if ids.itemsize == 4 else np.array(ids, "<u4").tobytes()

    def _of_word(self, word: str) -> bytes:
        if self.letters_apart and word.isascii():
            if word.isalpha():
                return self.parts[word.lower()]
            if word[-1] in _MARKS and word[:-1].isalpha():
                return self.parts[word[:-1].lower()] + self.parts[word[-1]]
        if self.word_pattern is None or not _PLAIN.fullmatch(word):
            return self.whole(word)
        parts = self.parts
        return b"".join([parts[part] for part in self.word_pattern.findall(word.lower())])

    def _of_piece(self, piece: str) -> bytes:
        if self.piece_pattern is None or not _PLAIN.fullmatch(piece):
            return self.whole(piece)
        parts = self.piece_pattern.findall(piece)
        if len(parts) == 1:
            return self._of_part(piece)
        pieces = self.pieces
        return b"".join([pieces[part] for part in parts])

    def _special(self, text: str) -> bool:
        if self.opening in text and any(token in text for token in self.added):
            return True
        # A search for one string is much faster than a pattern that tries several at each place.
        return any(mark in text for mark in _UNLIKE)

    def by_words(self, texts: list[str]) -> list[bytes]:
        """For files that drop white space."""
        words = self.words
        return [
            self.whole(text) if self._special(text) else b"".join([words[word] for word in text.split()]) for text in texts
        ]

    def by_pieces(self, texts: list[str]) -> list[bytes]:
        """For files that split by the byte-level pattern and don't normalise."""
        pieces = self.pieces
        return [
            self.whole(text) if self._special(text) else b"".join([pieces[piece] for piece in _CHUNK.findall(text)])
            for text in texts
        ]


@lru_cache(maxsize=1)
def encoder(path: str, cache: int = CACHE) -> LibraryEncoder:
    return LibraryEncoder(path, cache)
