"""Pre-tokenizing with the standard library where it is provably the same as the tokenizer's own pattern."""

from __future__ import annotations

import re

#: Characters for which Python's \\w, \\d and \\s agree with the patterns' \\p{L}, \\p{N} and \\s, and which NFC
#: and lower-casing treat one by one. Any other character sends its text through the library's own splitter.
_OTHER = re.compile("[^\t\n\r -~¡-±´-¸º»¿-įı-ɏЀ-ҁ‐-‧‰-⁞€一-鿿]")


def is_plain(text: str) -> bool:
    return text.isascii() and text.isprintable() or not _OTHER.search(text)


#: ByteLevel's pattern, and the word-end vocabulary's.
BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
WORD_END = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies, by the published rule."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def special_splitter(tokens: list[str]) -> re.Pattern | None:
    """Cuts a text at added tokens, keeping them at the odd places."""
    return re.compile("(" + "|".join(map(re.escape, sorted(tokens, key=len, reverse=True))) + ")") if tokens else None
