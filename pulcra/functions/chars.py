"""Character classes and folding tables shared by all text functions.

Java's ``\\s`` and ``\\d`` are ASCII-only. ``UNICODE`` turns ``\\s`` into the
Unicode White_Space property (much faster than a spelled-out class); digits are
always written as the Unicode class.
"""

from __future__ import annotations

import unicodedata
from functools import cache

UNICODE = "(?U)"
# Inside [...] of a UNICODE pattern: whitespace in the sense of "what stripping
# removes", controls 1C-1F included.
SPACE = r"\s\x1C-\x1F"
ALNUM = r"\p{L}\p{N}"
WORD = ALNUM + "_"
DIGIT = r"\p{Nd}"
ZERO_WIDTH = r"\x{200B}-\x{200D}\x{FEFF}"

# Letters that no decomposition splits. The usual ASCII
# spellings of Latin letters and common signs.
ASCII_SPELLING = {
    "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS",
    "©": "(c)", "«": "<<", "¬": "!", "®": "(r)", "°": "deg", "±": "+-",
    "¶": "P", "·": "*", "»": ">>", "¿": "?",
    "Æ": "AE", "Ð": "D", "×": "x", "Ø": "O", "Þ": "Th", "ß": "ss",
    "æ": "ae", "ð": "d", "÷": "/", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k", "Ł": "L",
    "ł": "l", "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t",
    "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "•": "*",
    "⁄": "/", "€": "EUR",
}


MARKS = "".join(map(chr, range(0x0300, 0x0370)))


@cache
def accent_table() -> tuple[str, str]:
    """(accented, plain) strings for ``translate``: every precomposed letter in
    the Latin blocks whose full decomposition is one base letter plus marks."""
    accented, plain = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base, *marks = unicodedata.normalize("NFKD", chr(code))
        if marks and all(unicodedata.combining(m) for m in marks):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)
