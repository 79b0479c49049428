"""The Porter stemmer, with the extensions of the common natural-language toolkit, one word at a time.

A word is a row of vowels and consonants; y is a consonant at the beginning and after a vowel. The measure of a stem
is how often vowels are followed by consonants in it, and most endings only go if what is left is long enough by
that measure. Five steps take endings off; in each the first ending that fits decides, also if its condition fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# Fixed values: (ending, replacement) of the second, third and fourth step.
SECOND = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
)
THIRD = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
FOURTH = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)

_SYLLABLE = re.compile("V+C+")


def sounds(word: str) -> str:
    """V or C for every letter."""
    out = ""
    for letter in word:
        if letter == "y":
            out += "V" if out.endswith("C") else "C"
        else:
            out += "V" if letter in "aeiou" else "C"
    return out


def measure(stem: str) -> int:
    return len(_SYLLABLE.findall(sounds(stem)))


def _short(stem: str) -> bool:
    """Whether the stem ends like hop, but not like how, box or boy; or is like at."""
    kinds = sounds(stem)
    return kinds == "VC" or (kinds.endswith("CVC") and stem[-1] not in "wxy")


def _replaced(word: str, rules: tuple[tuple[str, str], ...], fits: Callable[[str, str], bool]) -> str:
    for ending, by in rules:
        if word.endswith(ending):
            stem = word[: len(word) - len(ending)]
            return stem + by if fits(stem, ending) else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    for ending in ("ed", "ing"):
        stem = word[: len(word) - len(ending)]
        if word.endswith(ending) and "V" in sounds(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and sounds(stem)[-1] == "C":
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if measure(stem) == 1 and _short(stem) else stem
    return word


def _last_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and sounds(stem)[-1] == "C" else word


def _second(word: str) -> str:
    if word.endswith("alli") and measure(word[:-4]) > 0:
        return _second(word[:-2])
    # The l of logi counts with the stem.
    return _replaced(word, SECOND, lambda stem, ending: measure(stem + "l" * (ending == "logi")) > 0)


def _fourth(word: str) -> str:
    rules = tuple((ending, "") for ending in FOURTH)
    return _replaced(word, rules, lambda stem, end: measure(stem) > 1 and (end != "ion" or stem.endswith(("s", "t"))))


def _final(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        size = measure(stem)
        if size > 1 or (size == 1 and not _short(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and measure(word[:-1]) > 1 else word


# Words a worker keeps with their stems, so that it stems a frequent word once.
@lru_cache(maxsize=1 << 18)
def porter_stem(word: str) -> str:
    """The stem of a word in lower case; words of one or two letters stay as they are."""
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _second(_last_y(_past(_plural(word))))
    word = _replaced(word, THIRD, lambda stem, _: measure(stem) > 0)
    return _final(_fourth(word))
