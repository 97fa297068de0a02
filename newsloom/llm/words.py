"""Words of a text, as the contracts of the word operators define them."""

from __future__ import annotations

import re

#: Everything that is not a digit, an ASCII letter or outside ASCII separates words.
_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEEP else 0x20 for b in (bytes([i]).lower()[0] for i in range(256)))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(0x41, 0x5B)}


def lower_ascii(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.translate(_LOWER)


def word_bytes(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes.

    UTF-8 bytes of non-ASCII characters are all above 0x7F, so mapping single
    bytes gives the same words as the pattern gives on characters.
    """
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def word_spans(text: str) -> list[tuple[int, int]]:
    """Code-point offsets of the same words."""
    return [m.span() for m in WORD.finditer(lower_ascii(text))]
