"""Texts whose UTF-8 bytes were read as another code, once or several times over, and the way back.

A stretch is undone only if it consists of whole UTF-8 sequences seen through one code page, and if what it then says is
plausible: characters that are assigned, and more than one of them where true text can look alike. So the undoing is exact:
reading the mended stretch's bytes by the same code page gives back the stretch.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmine.functions.arrow import mapped

#: Wrong readings that one text can have gone through.
MOST_READINGS = 4
CODES = ("cp1252", "cp1251")


def _as_read(code: str) -> str:
    """The character that each byte is read as; bytes that the code lacks are read as the control of that number."""
    found = []
    for b in range(256):
        try:
            found.append(bytes([b]).decode(code))
        except UnicodeDecodeError:
            found.append(chr(b))
    return "".join(found)


READ_AS = {code: _as_read(code) for code in CODES}
BYTE_OF = {code: {c: b for b, c in enumerate(chars)} for code, chars in READ_AS.items()}


def _class(code: str, low: int, high: int) -> str:
    return "[" + "".join(re.escape(READ_AS[code][b]) for b in range(low, high + 1)) + "]"


def _sequences(code: str) -> str:
    """UTF-8 sequences of two to four bytes as the code shows them."""
    rest = _class(code, 0x80, 0xBF)
    return f"(?:{_class(code, 0xC2, 0xDF)}{rest}|{_class(code, 0xE0, 0xEF)}{rest}{{2}}|{_class(code, 0xF0, 0xF4)}{rest}{{3}})"


STRETCH = {code: re.compile(_sequences(code) + "+") for code in CODES}
#: A first sieve that Spark applies, so that most texts need not leave it. All sequences begin beyond ASCII, which is asked first, as
#: trying all of them at each sign took most of the time of cleaning.
SIEVE = r"(?=[^\x00-\x7f])(?:" + "|".join(_sequences(code) for code in CODES) + ")"
#: Closing signs of true text that can follow a capital which looks like a first byte.
_CLOSING = "»”’“…"


def _meant(code: str, stretch: str) -> str | None:
    """What the stretch's bytes say as UTF-8, if that is text."""
    try:
        meant = bytes(BYTE_OF[code][c] for c in stretch).decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = (c for c in meant if unicodedata.category(c) in ("Cn", "Co", "Cs") or unicodedata.category(c) == "Cc" and not "\x80" <= c <= "\x9f")
    return None if any(odd) else meant


def _sure(code: str, stretch: str, meant: str) -> bool:
    """Whether the stretch alone tells: true Cyrillic words can look like one letter, as can a capital before a closing quote."""
    if len(meant) > 1 or "\u2000" <= meant <= "\u22ff":
        return True
    return code == "cp1252" and meant <= "ſ" and not (stretch[0] not in "ÂÃ" and stretch[-1] in _CLOSING)


def _undone(text: str, code: str) -> str:
    found = [(m, _meant(code, m.group())) for m in STRETCH[code].finditer(text)]
    # where several signs together were read wrongly and nothing else is beyond ASCII, single letters have gone the same way
    along = any(meant and len(meant) > 1 for _, meant in found) and STRETCH[code].sub("", text).isascii()
    parts, at = [], 0
    for m, meant in found:
        if meant and (along or _sure(code, m.group(), meant)):
            parts += [text[at : m.start()], meant]
            at = m.end()
    return "".join([*parts, text[at:]])


def mended(text: str) -> str:
    """Undoes one reading after the other until nothing changes; each makes the text shorter."""
    for _ in range(MOST_READINGS):
        after = text
        for code in CODES:
            after = _undone(after, code)
        if after == text:
            break
        text = after
    return text


@F.arrow_udf(StringType())
def _mended(texts: pa.Array) -> pa.Array:
    return mapped(texts, mended, pa.string())


def mend(c: Column) -> Column:
    """The text with wrong readings undone; null stays null. Texts that hold no such stretch don't leave the JVM."""
    return F.coalesce(_mended(F.when(c.rlike(SIEVE), c)), c)


def misread(c: Column, code: str) -> Column:
    """The text's UTF-8 bytes read as a code page: what mend() undoes."""
    latin = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(map(chr, range(0x80, 0x100))), READ_AS[code][0x80:])


#: Signs that plain text writes otherwise.
LIGATURES = {"ĳ": "ij", "Ĳ": "IJ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st"}
SINGLE_QUOTES, DOUBLE_QUOTES = "ʼ‘’‚‛", "“”„‟"


#: plain_signs() sign by sign.
PLAIN = str.maketrans(
    dict.fromkeys(SINGLE_QUOTES, "'") | dict.fromkeys(DOUBLE_QUOTES, '"') | {chr(k): chr(k - 0xFEE0) for k in range(0xFF01, 0xFF5F)}
    | {"\u3000": " ", "\u2028": "\n", "\u2029": "\n", "\x85": "\n", "\ufeff": ""} | LIGATURES
)


def plain_signs(c: Column) -> Column:
    """Ligatures as letters, straight quotes, full-width signs as plain ones, other line ends as line feeds, no byte order
    marks."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    c = F.translate(c, SINGLE_QUOTES + DOUBLE_QUOTES + wide + "\u3000\u2028\u2029\x85", "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + "".join(map(chr, range(0x21, 0x7F))) + " \n\n\n")
    c = F.translate(c, "\ufeff", "")
    for sign, letters in LIGATURES.items():
        c = F.replace(c, F.lit(sign), F.lit(letters))
    return c


def mend_text(c: Column) -> Column:
    """T2's whole first step."""
    return plain_signs(mend(c))
