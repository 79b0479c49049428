"""SQL spellings of the text rules for the comparison engine."""

from __future__ import annotations

# White space, as in the text functions.
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}\p{N}_"


def replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def squeeze(text: str) -> str:
    return f"trim({replace(text, f'[{SPACE}]+', ' ')})"


def clean(text: str, brackets: bool = False) -> str:
    out = replace(f"lower({text})", f"(http|www)[^{SPACE}]+")
    out = replace(out, r"<[^\n]*?>")
    if brackets:
        out = replace(out, r"\[[^\n]*?\]")
    return f"coalesce({squeeze(out)}, '')"


def letters_only(text: str) -> str:
    out = replace(f"lower({text})", f"[^a-z{SPACE}]")
    return f"coalesce({squeeze(replace(out, chr(92) + 'b[a-z]' + chr(92) + 'b', ' '))}, '')"


def word_list(text: str) -> str:
    return f"regexp_extract_all({text}, '[^{SPACE}]+')"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[{WORD}]{{2,}}')"


def grams(words: str, shortest: int, longest: int) -> str:
    """List of n-grams of a list column."""
    parts = [
        f"CASE WHEN len({words}) >= {n} THEN list_transform(range(1, len({words}) - {n - 2}), "
        f"lambda i: array_to_string({words}[i:i + {n - 1}], ' ')) ELSE [] END"
        for n in range(shortest, longest + 1)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = f"list_concat({out}, {part})"
    return out
