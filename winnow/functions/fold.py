"""Compatibility decomposition without combining marks (NFKD), as native expressions.

The table comes from the Unicode data of the standard library when the module is
loaded. A letter with one base letter, and a mark that goes, is one entry of a
translation, which Spark does by a hash table. Characters that become several
are rare, so they are spelt out one by one only in texts that hold such a one: the j-th
letter of each comes from a translation of its own. Hangul syllables are split by arithmetic.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

HANGUL, SYLLABLES = 0xAC00, 11_172
_HANGUL_CLASS = f"\\x{{{HANGUL:x}}}-\\x{{{HANGUL + SYLLABLES - 1:x}}}"


def decomposed(text: str) -> str:
    """NFKD of the text without combining characters."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@cache
def _table() -> tuple[str, str, dict[str, str]]:
    """(from, to, several): translation of characters with at most one letter left, and those with more."""
    ones, gone, several = {}, [], {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(c) == "Cs" or HANGUL <= ord(c) < HANGUL + SYLLABLES:
            continue
        to = decomposed(c)
        if len(to) > 1:
            several[c] = to
        elif not to:
            gone.append(c)
        elif to != c:
            ones[c] = to
    return "".join([*ones, *gone]), "".join(ones.values()), several


def _ranges(chars: list[str]) -> str:
    """Inside of a regex class of the characters, runs of neighbours as ranges."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


def _spelt(ch: Column) -> Column:
    """The letters of one character that becomes several."""
    several = _table()[2]
    letters = []
    for j in range(max(map(len, several.values()))):
        held = [c for c in several if len(several[c]) > j]
        # characters without a j-th letter stand at the end, without a counterpart, and vanish
        letters.append(F.translate(ch, "".join([*held, *(c for c in several if len(several[c]) <= j)]), "".join(several[c][j] for c in held)))
    return F.concat(*letters)


def _jamo(ch: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    s = F.ascii(ch) - HANGUL
    code = lambda n: F.hex(n.cast("long"))
    lead, vowel, tail = F.lit(0x1100) + F.floor(s / 588), F.lit(0x1161) + F.floor(s % 588 / 28), s % 28
    both = F.concat(code(lead), code(vowel), F.when(tail > 0, code(tail + 0x11A7)).otherwise(""))
    return F.decode(F.unhex(both), "UTF-16BE")


def fold(text: Column) -> Column:
    """:func:`decomposed` of a column; a text of ASCII alone stays as it is."""
    source, target, several = _table()
    wide = _ranges(list(several))
    ones = F.translate(text, source, target)
    spelt = F.transform(
        F.split(ones, ""), lambda ch: F.when(ch.rlike(f"[{_HANGUL_CLASS}]"), _jamo(ch)).when(ch.rlike(f"[{wide}]"), _spelt(ch)).otherwise(ch)
    )
    other = F.when(ones.rlike(f"[{_HANGUL_CLASS}{wide}]"), F.array_join(spelt, "")).otherwise(ones)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(other)
