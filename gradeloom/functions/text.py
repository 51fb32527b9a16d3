"""Text helpers with a Unicode-wide idea of whitespace."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last code point of every run of characters that the datasets' tools take
# for whitespace. Java's own Unicode \s lacks the separators U+001C to U+001F.
_SPACE_RUNS = (
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
SPACES = "".join(chr(c) for first, last in _SPACE_RUNS for c in range(first, last + 1))
_CLASS = "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in _SPACE_RUNS)
SPACE = f"[{_CLASS}]"


def strip(text: Column) -> Column:
    """Remove whitespace of every kind at both ends (plain `trim` knows only the space)."""
    return F.trim(text, F.lit(SPACES))


def last_line(text: Column) -> Column:
    return F.substring_index(text, "\n", -1)


def word_count(text: Column) -> Column:
    """Whitespace-separated words: the default length measure where no tokenizer is at hand."""
    return F.regexp_count(text, F.lit(f"[^{_CLASS}]+"))
