"""Text expressions with Python ``str`` / ``re`` semantics, evaluated JVM-side.

Java regexes differ from Python's on ``\\s``, ``\\w`` and ``str.strip``; the
character classes below are spelled out so the Column expressions give the
same answers as the Python rules they stand for, and stay inside whole-stage
codegen (no Python on the data path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal Python's definitions for identical results)
# ---------------------------------------------------------------------------
# Characters for which Python's str.isspace() is true (used by str.split(),
# str.strip() and re's \s):  U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_SPACE_CHARS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Line boundaries of Python's str.splitlines(): \r\n and these single chars.
PY_LINE_BREAK_CHARS = r"\r\x{0B}\x{0C}\x{1C}\x{1D}\x{1E}\x{85}\x{2028}\x{2029}"
# Python whitespace that is not a line boundary (after \r\n etc. became \n).
PY_INLINE_SPACE_CHARS = (
    r"\x{09}\x{1F}\x{20}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
)
# Word token: a maximal run of [\w'] with apostrophes at either end removed.
# Python's \w is [\p{L}\p{N}_] (no combining marks), unlike Java's (?U)\w.
TOKEN_PATTERN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_']*[\p{L}\p{N}_])?"

# The same whitespace set as single characters, for ``translate``.
PY_SPACE_LIST = "".join(
    chr(x) for x in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000])

WS = f"[{PY_SPACE_CHARS}]"
NON_WS = f"[^{PY_SPACE_CHARS}]"
WORD_PATTERN = NON_WS + "+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: remove Python whitespace at both ends (plain F.trim only
    drops U+0020).  A character-set trim works from the ends, not a regex scan."""
    return F.trim(_c(c), F.lit(PY_SPACE_LIST))


def py_rstrip(c: Column | str) -> Column:
    """``str.rstrip()``."""
    return F.rtrim(_c(c), F.lit(PY_SPACE_LIST))


def is_blank(c: Column | str) -> Column:
    """True for null, empty or whitespace-only strings."""
    return F.coalesce(py_strip(c), F.lit("")) == F.lit("")


def count_words(c: Column | str) -> Column:
    """Number of ``\\S+`` runs (Python whitespace).

    Every whitespace character becomes a space (``translate``, a character
    map), space runs collapse, and each space followed by a word starts one:
    no per-word objects (``regexp_count`` would build the array of matches).
    """
    t = F.translate(F.coalesce(_c(c), F.lit("")), PY_SPACE_LIST, " " * len(PY_SPACE_LIST))
    t = F.regexp_replace(F.concat(F.lit(" "), t), " {2,}", " ")
    spaces = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return (spaces - F.when(t.endswith(" "), 1).otherwise(0)).cast("long")


def approx_tokens(words: Column | str) -> Column:
    """``round(words * 4 / 3)``: thirds never tie, so HALF_UP equals Python's half-even."""
    return F.round(_c(words) * F.lit(4) / F.lit(3)).cast("long")


def normalize_tokens(c: Column | str) -> Column:
    """Lower-cased word tokens, the likeness alphabet (``\\b[\\w']+\\b`` on ``lower``)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def unwrap_text(c: Column | str) -> Column:
    """Paragraph unwrap with ``str.splitlines`` / ``str.split`` semantics.

    Blank lines separate paragraphs; the lines of a paragraph are joined with
    one space and inner whitespace runs collapse; paragraphs are joined by a
    blank line and a non-empty result ends with one newline.
    """
    t = F.coalesce(_c(c), F.lit(""))
    t = F.regexp_replace(t, f"\\r\\n|[{PY_LINE_BREAK_CHARS}]", "\n")
    t = F.regexp_replace(t, f"[{PY_INLINE_SPACE_CHARS}]+", " ")
    t = F.regexp_replace(t, " ?\\n ?", "\n")
    t = F.regexp_replace(t, "^[ \\n]+|[ \\n]+\\z", "")
    t = F.regexp_replace(t, "(?<!\\n)\\n(?!\\n)", " ")
    t = F.regexp_replace(t, "\\n{2,}", "\n\n")
    return F.when(t == "", t).otherwise(F.concat(t, F.lit("\n")))


def unwrap_text_ascii(c: Column | str) -> Column:
    """Unwrap variant of the line-oriented shell tool.

    Only ``\\n`` separates lines; a line of ``[ \\t\\v\\f\\r]`` is blank; only
    ``[ \\t\\r]`` are trimmed and ``[ \\t]`` runs collapsed.  Output ending in
    blank lines ends with a blank line, otherwise with one newline.
    """
    t = F.coalesce(_c(c), F.lit(""))
    t = F.regexp_replace(t, "\\n\\z", "")  # final record terminator
    t = F.regexp_replace(t, "(?md)^[ \\t\\x{0B}\\f\\r]*$", "")  # blank lines -> empty
    t = F.regexp_replace(t, "(?md)^[ \\t\\r]+|[ \\t\\r]+$", "")
    t = F.regexp_replace(t, "[ \\t]+", " ")
    t = F.regexp_replace(t, "^\\n+", "")
    t = F.regexp_replace(t, "(?<!\\n)\\n(?!\\n|\\z)", " ")
    t = F.regexp_replace(t, "\\n+", "\n\n")
    return (
        F.when(t == "", t)
        .when(t.endswith("\n\n"), t)
        .otherwise(F.concat(t, F.lit("\n")))
    )


def universal_newlines(c: Column | str) -> Column:
    """Python's text-mode reading: ``\\r\\n`` and ``\\r`` become ``\\n`` (other line
    breaks are kept)."""
    return F.regexp_replace(_c(c), "\\r\\n?", "\n")


def make_valid_utf8(c: Column | str) -> Column:
    """Invalid UTF-8 bytes become U+FFFD, as with ``errors="replace"``."""
    return F.make_valid_utf8(_c(c))
