"""Byte-level BPE ids by the tokenizers library, with a memory for what recurs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from struct import Struct

import numpy as np

from terrane.llm.common import kept_by_worker, no_cycles

END_OF_DOCUMENT = 0

_MARKS = ".,!?;:#*$%&"
_PACKED = [Struct(f"<{n}I").pack for n in range(64)]
_PARTS = re.compile(rf"\n|[{_MARKS}]+|[^\n{_MARKS}]+")


def _byte_letters() -> dict[int, str]:
    """The letter byte-level vocabularies write for each byte: itself if it is printable in
    Latin-1, else the next letter from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {byte: chr(byte) for byte in printable} | {
        byte: chr(0x100 + k) for k, byte in enumerate(others)
    }


class UnsafeCut(ValueError):
    """A piece has white space beside the space it was cut at."""


class _Parts(dict):
    """Ids of parts, by the part without its `lead`."""

    def __init__(self, lead: str, bpe: ByteBpe):
        super().__init__()
        self.lead, self.bpe = lead, bpe
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.bpe._ids(self.lead + word, word, self)
        if len(word) <= self.bpe.longest:
            self.bpe.held += 200 + 2 * len(word) + len(found)
            self[word] = found
        return found

    def renew(self) -> None:
        self.older = dict(self)
        self.clear()


class ByteBpe:
    """Ids of whole texts as `Tokenizer.encode(text, add_special_tokens=False)` gives them.

    Byte-level pre-tokenization always ends a token where a word meets a mark, around a
    single line end between two characters that are not white space, and before a single
    space between two such: no alternative of its pattern runs over these places. So most
    texts can be cut there and the parts encoded by themselves. A part made of letters, with
    or without a space before it, is one such token, and goes straight to the library's
    model; other parts, and texts with other runs of white space, go through the whole
    tokenizer. Parts recur, so their ids are kept, those behind a space (`spaced`) and others
    (`bare`) apart: of the last `most` new parts, or `most_bytes`, at least, and of twice as
    many at most. Parts longer than `longest`, such as texts without spaces, are not kept.
    """

    def __init__(self, path: str, most: int = 160_000, most_bytes: int = 32 << 20, longest: int = 128):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.spaced, self.bare = _Parts(" ", self), _Parts("", self)
        self.most, self.most_bytes, self.longest = most, most_bytes, longest
        self.held = 0

    def __iter__(self) -> Iterator[str]:
        """The parts it keeps, without a space before them."""
        return chain(self.spaced, self.bare)

    def __len__(self) -> int:
        return len(self.spaced) + len(self.bare)

    def whole(self, text: str) -> bytes:
        """The library's ids of one text, as little-endian unsigned 32-bit integers."""
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _part(self, piece: str) -> bytes:
        return self.spaced[piece[1:]] if piece[0] == " " and len(piece) > 1 else self.bare[piece]

    def _ids(self, piece: str, word: str, alike: _Parts) -> bytes:
        """The ids of a piece, which is a word behind the lead of those alike."""
        if word.isalpha():
            if word.isascii():
                letters = self.space + word if alike.lead else word
            else:
                letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.tokenize(letters)]
            return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else np.array(ids, "<u4").tobytes()
        if word[-1] in _MARKS and word[:-1].isalpha():
            return alike[word[:-1]] + self.bare[word[-1]]
        if piece != "\n" and (piece[-1].isspace() or piece[1:2].isspace()):
            raise UnsafeCut
        left, line, right = word.partition("\n")
        if left and right and not (left[-1].isspace() or right[0].isspace()):
            return alike[left] + self.bare[line] + self.bare[right]
        parts = _PARTS.findall(piece)
        if len(parts) == 1:
            return self.whole(piece)
        for left, right in zip(parts, parts[1:]):
            if left == "\n":
                safe = not right[0].isspace()
            elif right == "\n":
                safe = not left[-1].isspace()
            else:
                safe = left[-1].isalnum() != right[0].isalnum()
            if not safe:
                return self.whole(piece)
        return b"".join([self._part(part) for part in parts])

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self) >= self.most or self.held >= self.most_bytes:
            self.spaced.renew()
            self.bare.renew()
            self.held = 0
        with no_cycles():
            return [self._text(text) for text in texts]

    def _text(self, text: str) -> bytes:
        pieces = text.split(" ")
        if "" in pieces:  # spaces in a row or at an end, or no text
            return self.whole(text)
        end = b""
        if pieces[-1][-1].isspace():
            end = self.whole(" " * (len(pieces) > 1) + pieces.pop())
        try:
            ids = [self.bare[piece] for piece in pieces[:1]]
            ids += map(self.spaced.__getitem__, pieces[1:])
        except UnsafeCut:
            return self.whole(text)
        return b"".join([*ids, end])


def byte_bpe(path: str) -> ByteBpe:
    """The encoder of a worker process; what it remembers serves the tasks that follow."""
    return kept_by_worker(ByteBpe, path)
