"""Text cleaning, tokens and n-grams as column expressions.

Patterns name their character classes in full. ``\\s``, ``\\w`` and ``\\b`` mean different things in
different regex engines; the classes below mean the Unicode-aware sets review text needs everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
_SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE = f"[{_SPACE}]"
NON_SPACE = f"[^{_SPACE}]"
# Fixed value: the characters a word is made of.
_WORD = r"\p{L}\p{N}_"
# Fixed value: everything but a-z and white space, spelled out as ranges; a negated class of this size
# is many times slower in the JVM.
_NOT_LETTER = (
    r"\x{0}-\x{8}\x{e}-\x{1b}\x{21}-\x{60}\x{7b}-\x{84}\x{86}-\x{9f}\x{a1}-\x{167f}"
    r"\x{1681}-\x{1fff}\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}"
    r"\x{3001}-\x{10ffff}"
)
WORD_START = f"(?<![{_WORD}])"
WORD_END = f"(?![{_WORD}])"
# A token is a run of at least two word characters.
TOKEN = f"[{_WORD}]{{2,}}"

# Platform phrases dropped before topic modelling, in order; True = any letter case.
METADATA_PATTERNS: tuple[tuple[str, bool], ...] = (
    (r"Posted:[^\n]*", True),
    (rf"\p{{Nd}}+\.\p{{Nd}}+{SPACE}*hrs on record", False),
    (r"Product received for free", True),
    (r"Early Access Review", True),
)

# Domain terms that carry no topic, each matched between word boundaries. The list is
# applied in order elsewhere and ends with "not recommend"; by then "recommend" is gone and "not" stays,
# so that entry has no effect and is not listed.
DOMAIN_TERMS: tuple[str, ...] = (
    rf"\p{{Nd}}{{1,4}}{SPACE}?hrs?",
    rf"\p{{Nd}}{{1,4}}{SPACE}?hours?",
    r"play(ed|ing)?",
    r"update",
    r"patch",
    r"devs?",
    r"dev(eloper)?s?",
    r"early access",
    r"refund(ed|ing)?",
    r"recommend(ed|ing)?",
    r"worth it",
    r"price",
    r"performance",
    r"fps",
    r"lag",
    r"crash(es|ed)?",
)

# Words of the review domain removed before topic counts.
DOMAIN_STOP_WORDS: tuple[str, ...] = (
    "game", "play", "horror", "scary", "recommend", "best", "bad", "worth", "fun", "good", "great",
    "get", "like", "time", "youtube", "love", "hate", "awesome", "terrible", "awful", "steam",
    "steampowered", "alan", "wake", "silent", "hill", "redient", "evil", "dead",
)

# Words of the shop domain removed before word-frequency tables.
SHOP_STOP_WORDS: tuple[str, ...] = ("product", "review", "amazon", "bought", "buy", "purchased")


def _replace(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(_replace(text, f"{SPACE}+", " "))


def is_blank(text: Column) -> Column:
    """True for null and for text of white space only."""
    return text.isNull() | ~text.rlike(NON_SPACE)


def clean_text(text: Column, brackets: bool = False) -> Column:
    """Lower case without links, HTML tags and (optionally) ``[...]`` markup; null becomes ''."""
    out = F.lower(text)
    out = _replace(out, f"http{NON_SPACE}+|www{NON_SPACE}+")
    out = _replace(out, r"<[^\n]*?>")
    if brackets:
        out = _replace(out, r"\[[^\n]*?\]")
    return F.coalesce(squeeze(out), F.lit(""))


def clean_minimal(text: Column) -> Column:
    """Markup and links removed, letter case and punctuation kept: the input of an encoder."""
    out = _replace(text, r"<[^\n]*?>")
    out = _replace(out, r"\[[^\n]*?\]")
    out = _replace(out, f"http{NON_SPACE}+")
    return F.coalesce(squeeze(out), F.lit(""))


def letters_only(text: Column) -> Column:
    """Lower-case a-z words of at least two letters, single spaces."""
    out = _replace(F.lower(text), f"[{_NOT_LETTER}]+")
    out = _replace(out, r"\b[a-z]\b", " ")
    return F.coalesce(squeeze(out), F.lit(""))


def words_only(text: Column) -> Column:
    """Lower case without digits and punctuation; letters of every script stay."""
    out = _replace(F.lower(text), r"\p{Nd}+")
    return squeeze(_replace(out, f"[^{_WORD}{_SPACE}]+"))


def drop_metadata(text: Column) -> Column:
    """Remove the phrases a review platform prints around a review; null becomes ''."""
    out = text
    for pattern, any_case in METADATA_PATTERNS:
        out = _replace(out, f"(?iu){pattern}" if any_case else pattern)
    return F.coalesce(squeeze(out), F.lit(""))


def drop_domain_terms(text: Column) -> Column:
    """Replace the domain terms by spaces, keep lower-case words of three or more letters.

    No term shares a word with another one, so a single pass finds what one pass per term would.
    """
    terms = "|".join(DOMAIN_TERMS)
    out = _replace(text, f"(?iu){WORD_START}(?:{terms}){WORD_END}", " ")
    words = F.regexp_extract_all(
        F.lower(out), F.lit(f"{WORD_START}[a-z]{{3,}}{WORD_END}"), F.lit(0)
    )
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of white-space separated words; null counts as the empty text."""
    line = squeeze(F.coalesce(text, F.lit("")))
    gaps = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(gaps + 1).cast("long")


def char_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("long")


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    """Lower-case tokens of ``text`` in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def split_words(text: Column) -> Column:
    """White-space separated words in order."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")


def remove_stop_words(words: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words from an array of words. The list becomes one hash set in the plan."""
    if not stop_words:
        return words
    listed = [F.lit(word) for word in stop_words]
    return F.filter(words, lambda word: ~word.isin(*listed))


def remove_stop_words_text(text: Column, stop_words: Sequence[str]) -> Column:
    """Stop words removed from a text of words."""
    return F.array_join(remove_stop_words(split_words(text), stop_words), " ")


def english_stop_words(extra: Sequence[str] = ()) -> list[str]:
    """The English list Spark ML ships (it needs a running session) and ``extra`` words.

    ``extra`` is SHOP_STOP_WORDS for word-frequency tables and DOMAIN_STOP_WORDS for topics of words.
    """
    listed = StopWordsRemover.loadDefaultStopWords("english")
    return list(dict.fromkeys([*listed, *extra]))


# Fixed values: (ending, replacement) pairs of the suffix stemmer; the first that fits is used.
STEM_RULES: tuple[tuple[str, str], ...] = (
    ("sses$", "ss"),
    ("ies$", "i"),
    ("([^s])s$", "$1"),
    ("ing$", ""),
    ("ed$", ""),
)


def stem(word: Column) -> Column:
    """A light suffix stemmer: the first fitting rule applies if at least three letters remain."""
    out = F.lit(None).cast("string")
    for pattern, by in reversed(STEM_RULES):
        cut = _replace(word, pattern, by)
        out = F.when(word.rlike(pattern) & (F.length(cut) >= 3), cut).otherwise(
            F.coalesce(out, word)
        )
    return out


def ngrams(words: Column, shortest: int = 1, longest: int = 1) -> Column:
    """All runs of ``shortest`` to ``longest`` words, joined by a space, as one array.

    Each size is the previous one zipped with the words shifted by one more place; what runs over the
    end, or over a null word, is null and left out.
    """
    if (shortest, longest) == (1, 1):
        return F.filter(words, lambda word: word.isNotNull())
    sizes = [words]
    for size in range(2, longest + 1):
        shifted = F.slice(words, size, F.size(words))
        sizes.append(
            F.zip_with(sizes[-1], shifted, lambda gram, word: F.concat(gram, F.lit(" "), word))
        )
    wanted = sizes[shortest - 1 :]
    grams = wanted[0] if len(wanted) == 1 else F.concat(*wanted)
    return F.filter(grams, lambda gram: gram.isNotNull())


def only_words(words: Column, kept: Sequence[str]) -> Column:
    """The words with null in the place of every word not in ``kept``, one hash set in the plan."""
    if not kept:
        return F.transform(words, lambda word: F.lit(None).cast("string"))
    listed = [F.lit(word) for word in kept]
    return F.transform(words, lambda word: F.when(word.isin(*listed), word))


def shorten(text: Column, length: int, ellipsis: str = "") -> Column:
    """The first ``length`` characters, followed by ``ellipsis`` whatever the length was."""
    cut = F.substring(text, 1, length)
    return F.concat(cut, F.lit(ellipsis)) if ellipsis else cut


def last_segment(text: Column, separator: str = "_") -> Column:
    """What follows the last separator."""
    return F.element_at(F.split(text, F.lit(f"\\Q{separator}\\E"), -1), -1)


def token_estimate(text: Column) -> Column:
    """Four characters count as one model token."""
    return F.floor(F.length(text) / 4).cast("long")


# The sections a product summary must mention.
SUMMARY_SECTIONS: tuple[str, ...] = ("Highlights", "Pain Points", "Verdict")


def missing_sections(summary: Column, sections: Sequence[str] = SUMMARY_SECTIONS) -> Column:
    """Names of the sections the summary does not mention, joined by ', '; '' if complete."""
    lowered = F.lower(summary)
    found = [
        F.when(~lowered.contains(section.lower()), F.lit(section)) for section in sections
    ]
    return F.concat_ws(", ", *found)


def has_sections(summary: Column, sections: Sequence[str] = SUMMARY_SECTIONS) -> Column:
    return F.coalesce(missing_sections(summary, sections) == "", F.lit(False)) & summary.isNotNull()
