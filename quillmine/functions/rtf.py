"""Text of RTF documents: control words, groups, code pages and escapes, no layout."""

from __future__ import annotations

import re
import time

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmine.functions.arrow import mapped

_TOKEN = re.compile(r"\\([a-zA-Z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-zA-Z])|([{}])|[\r\n]+|([^\\{}\r\n]+)")
#: Groups whose text is not the document's.
HIDDEN = frozenset("fonttbl colortbl stylesheet info pict header footer headerl headerr headerf footerl footerr footerf footnote themedata colorschememapping latentstyles datastore listtable listoverridetable rsidtbl generator xmlnstbl object fldinst bkmkstart bkmkend".split())
BREAKS = {"par": "\n", "line": "\n", "row": "\n", "sect": "\n", "page": "\n", "tab": "\t", "cell": "|", "emdash": "—", "endash": "–", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "bullet": "•"}


def rtf_text(data: bytes | None, code_page: str | None = None, errors: str = "replace", seconds: float | None = None) -> str | None:
    """data: RTF as bytes. code_page: of escaped bytes, else the document's own (\\ansicpg) or cp1252. A document that takes more
    than `seconds` raises TimeoutError."""
    if data is None:
        return None
    source = data.decode("latin-1")
    page, out, pending = code_page or "cp1252", [], bytearray()
    stack: list[tuple[bool, int]] = []
    hidden, skip_after_unicode, to_skip, star = False, 1, 0, False

    def flush():
        if pending:
            try:
                out.append(bytes(pending).decode(page, errors))
            except LookupError:
                out.append(bytes(pending).decode("cp1252", errors))
            pending.clear()

    ends = None if seconds is None else time.monotonic() + seconds
    for k, m in enumerate(_TOKEN.finditer(source)):
        if ends is not None and k % 4096 == 0 and time.monotonic() > ends:
            raise TimeoutError(f"more than {seconds} seconds")
        word, number, escaped, symbol, brace, plain = m.groups()
        if brace:
            flush()
            if brace == "{":
                stack.append((hidden, skip_after_unicode))
            elif stack:
                hidden, skip_after_unicode = stack.pop()
            star, to_skip = False, 0
        elif word:
            if word == "ansicpg" and not code_page and number:
                page = f"cp{number}"
            elif word in HIDDEN or star:
                hidden = True
            elif word == "uc":
                skip_after_unicode = int(number or 1)
            elif word == "u" and number and not hidden:
                flush()
                out.append(chr(int(number) % 65536))
                to_skip = skip_after_unicode
            elif word in BREAKS and not hidden:
                flush()
                out.append(BREAKS[word])
            elif word == "bin":
                hidden = True
            star = False
        elif escaped:
            if to_skip:
                to_skip -= 1
            elif not hidden:
                pending.append(int(escaped, 16))
        elif symbol:
            if symbol == "*":
                star = True
            elif not hidden:
                flush()
                out.append({"~": "\xa0", "_": "-", "-": "", "\n": "\n", "\r": "\n"}.get(symbol, symbol))
        elif plain and not hidden:
            cut = min(to_skip, len(plain))
            to_skip -= cut
            pending += plain[cut:].encode("latin-1")
    flush()
    # two halves of a character beyond the basic plane
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def text_of_rtf(content: Column, code_page: str | None = None, errors: str = "replace") -> Column:
    """T9 over a binary column."""

    @F.arrow_udf("string")
    def read(contents: pa.Array) -> pa.Array:
        return mapped(contents, lambda x: rtf_text(x, code_page, errors), pa.string())

    return read(content)


def converted(content: Column, seconds: float = 60.0, code_page: str | None = None) -> Column:
    """struct(text, error) of a binary column: a document that takes longer than `seconds` has an error and no text, and
    the batch goes on with the next. Null stays null in both."""

    kind = pa.struct([("text", pa.string()), ("error", pa.string())])

    def one(x: bytes | None) -> dict:
        try:
            return {"text": rtf_text(x, code_page, seconds=seconds), "error": None}
        except TimeoutError as late:
            return {"text": None, "error": str(late)}

    @F.arrow_udf("text string, error string")
    def read(contents: pa.Array) -> pa.Array:
        return mapped(contents, one, kind, nulls=True)

    return read(content)
