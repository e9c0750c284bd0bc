"""Pieces of DuckDB text for the operators' SQL."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of ``text`` (code points below U+0800)."""
    code = "unicode(ch)"
    two = f"[192 + ({code} >> 6), 128 + ({code} & 63)]"
    numbers = f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {code} < 128 THEN [{code}] ELSE {two} END))"
    # a byte goes into the register, then (-1) eight shifts follow
    steps = f"flatten(list_transform({numbers}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    reduced = (f"list_reduce(list_concat([4294967295::BIGINT], {steps}), "
               "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)")
    return f"xor({reduced}, 4294967295::BIGINT)"
