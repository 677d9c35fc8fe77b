"""Text expressions with Unicode whitespace and word rules.

Spark's own ``\\w``, ``\\s`` and ``trim`` are narrower than what source-code
metrics need, so the character classes are spelled out once here. They use only
syntax that Java regular expressions and RE2 share.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode whitespace, as a class body and as a list of characters.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
INLINE_SPACE = r"\t\x0b-\r\x1c-\x20\x85\p{Z}"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ASCII is listed first only because it is tested faster.
WORD = r"[0-9A-Z_a-z\p{L}\p{N}]"

S = f"[{SPACE}]"
W = WORD


def whole_word(alternatives: str) -> str:
    """Pattern for any of ``alternatives`` standing alone as a word.

    The lookahead on first letters skips most positions cheaply.
    """
    first = "".join(sorted({word[0] for word in alternatives.split("|")}))
    return f"(?=[{first}])(?<!{W})(?:{alternatives})(?!{W})"


def line_start(pattern: str) -> str:
    """Pattern anchored at the start of a line, where only ``\\n`` ends lines."""
    return f"(?md)^(?:{pattern})"


def occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def count_char(text: Column, char: str) -> Column:
    """Occurrences of one character, without a regular expression."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def has(text: Column, *needles: str) -> Column:
    """True when any of the literal strings occurs."""
    found = text.contains(needles[0])
    for needle in needles[1:]:
        found = found | text.contains(needle)
    return found


def lines_of(text: Column) -> Column:
    """Lines by ``\\n`` only; a trailing newline yields a last empty line."""
    return F.split(text, "\n")


def universal_lines(text: Column) -> Column:
    """Lines by every line boundary, with no empty last line."""
    boundary = r"(?:\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\x{2028}\x{2029}])"
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(text, boundary + r"\z", ""), boundary)
    )


def first_code_block(markdown: Column) -> Column:
    """Body of the first fenced code block, stripped; empty when there is none."""
    return strip(F.regexp_extract(markdown, rf"(?s)```(?:{W}+)?\n(.*?)```", 1))


def snippet(lines: Column, max_lines: int = 80) -> Column:
    """The first lines, joined, with a note on how many more there are."""
    more = F.size(lines) - max_lines
    head = F.array_join(F.slice(lines, 1, max_lines), "\n")
    return F.when(
        more > 0, F.concat(head, F.lit("\n... ("), more.cast("string"), F.lit(" more lines)"))
    ).otherwise(head)
