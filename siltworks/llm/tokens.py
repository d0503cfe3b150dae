"""Encoding whole texts with a public tokenizer inside tasks.

Both public vocabularies merge within pieces cut by a pattern, so a text in a plain Latin
alphabet is cut at once and a piece's ids are remembered by the Python worker.  Other texts
are encoded by the chunks between white space, those outside the alphabet by the library;
texts with other white space or with the strings of special tokens go to the library as they
are.  The ids are the library's in every case.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

#: pieces (and chunks of texts that are not plain) remembered per worker and generation; two generations are held
REMEMBERED = 400_000

_ODD = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN = re.compile("[\x21-\x7e\xa1-ɏ \n]*")
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: letters of ``_PLAIN`` and, as some leave it, of its lower case
_LETTERS = "".join(sorted({c for p in map(chr, range(0x21, 0x250)) for c in p + p.lower() if c.isalpha()}))
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"


class Remembered(dict):
    """A mapping that computes what it lacks and forgets the older half when full."""

    def __init__(self, make: Callable, limit: int = REMEMBERED):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = self.copy()
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Fixed rule of the format: printable bytes stand for themselves, the others take the
    code points from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, merge_piece: Callable[[str], Iterable[int]] | None = None, remembered: int = REMEMBERED):
        import json

        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.letters = dict(enumerate(byte_letters()))
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.drops_space = rules["normalizer"] is not None
        # the patterns of the two public vocabularies, fixed values
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            if self.drops_space
            else r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        # the same for plain texts: they have no other letters and numbers, and no branches but those of ' overlap
        gap = "" if self.drops_space else " ?"
        spaces = "" if self.drops_space else r"|\s+(?!\S)|\s+"
        other = rf"[^\s{_LETTERS}{_NUMBERS}]+"
        number = f"[{_NUMBERS}]" + ("" if self.drops_space else "+")
        self.plain = re.compile(f"{gap}[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|{gap}{number}|{gap}{other}{spaces}")
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.merge_piece = merge_piece
        self.pieces = Remembered(self._piece, remembered)
        self.chunks = Remembered(self._chunk, remembered)
        self.spaced = Remembered(lambda item: self._chunk(" " + item), remembered)

    def _piece(self, piece: str) -> bytes:
        if self.merge_piece:
            return packed(self.merge_piece(piece))
        if piece.isascii() and piece.isalpha():
            letters = piece  # printable bytes stand for themselves
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return packed([token.id for token in self.library.model.tokenize(letters)])

    def _split(self, text: str) -> list[str]:
        """The library's own pieces of any text without special tokens."""
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def _chunk(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return self._whole(chunk)
        if self.drops_space:
            chunk = chunk.lower()
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk)))

    def _whole(self, text: str) -> bytes:
        if not self.merge_piece:
            return packed(self.library.encode(text, add_special_tokens=False).ids)
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text)
        return b"".join(
            packed([self.library.token_to_id(part)])
            if i % 2
            else b"".join(map(self.pieces.__getitem__, self._split(part)))
            for i, part in enumerate(parts)
        )

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self._whole(text)
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.pieces.__getitem__, self.plain.findall(text.lower() if self.drops_space else text)))
        if _ODD.search(text):
            return self._whole(text)
        if self.drops_space:
            return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))
        if "  " in text or " \n" in text or text[-1] == " ":  # runs of white space stay together
            return b"".join(map(self.chunks.__getitem__, _CHUNK.findall(text)))
        first, *rest = text.split(" ")
        return (self.chunks[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker and vocabulary, kept between tasks."""
    return TextEncoder(path)
