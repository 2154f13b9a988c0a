"""Per-document statistics used by the quality operators (one pass a text)."""

from __future__ import annotations

from collections import Counter
from math import log1p
from operator import eq

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>"
#: ASCII punctuation without the counted symbols.
MARKS = b"!\"'()+,-./:;=?@[\\]^_`{}~"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
          "digit_share", "mark_share", "shout_share", "pipe_share", "distinct_share", "echo_share",
          "line_words", "wide_share"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, end, total = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + 3 - max(end, i)
            end = i + 3
    return total


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """The COUNTS and SHARES of a text in UTF-8."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    size, per = max(1, len(joined)), max(1, n)
    less = lambda drop: (len(joined) - len(joined.translate(None, drop))) / size
    shares = [log1p(n), chars / per, symbols / per, dup_lines / max(1, len(lines)), repeats / per, less(UPPER),
              less(DIGITS), less(MARKS), text.count(b"!") / per, text.count(b"|") / per, len(set(words)) / per,
              sum(map(eq, words, words[1:])) / per, n / max(1, len(lines)), 1 - chars / size]
    return [n, chars, symbols, dup_lines, repeats], shares
