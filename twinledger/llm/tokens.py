"""Token ids of a public byte-level vocabulary, from the ``tokenizers`` library.

The vocabulary's pre-tokens never hold a space behind another character, so a text may be cut before any space that
follows a non-space and its parts encoded on their own.  Parts repeat: each worker asks the library's model
once per part, pre-token by pre-token, and keeps the answer, up to a bounded number of parts.
"""

from __future__ import annotations

import os
import re
from array import array

import regex
from public_tokenizers import PATTERN

#: A space between two white-space characters, or behind one at the end: here a cut would part a pre-token.
UNSAFE = re.compile(r" (?<=\s )(?!\S)")
# The byte-level alphabet gives printable Latin-1 bytes their own letter, all others one from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
LETTER_OF_BYTE = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}
SPACE = LETTER_OF_BYTE[32]
CUT = re.compile(r"(?<=\S)(?= )")


#: A line break beside other white space, or at the end: with it, it may be one pre-token.
BESIDE = re.compile(r"\n(?:(?<=\s\n)|(?=\s|\Z))")
#: A sign cut off from another sign, or from a space: they are one pre-token.
SIGNS = re.compile(r"\0(?<=[^\w\0]\0|_\0)[,.]\0")


def cut(text: str) -> list[str]:
    """Parts of a text that share no pre-token; joined they are the text.

    Texts are cut before spaces, around single line breaks, and before a comma or full stop that ends a part, so that
    a word is one part whatever follows it.
    """
    if "\0" in text or UNSAFE.search(text):
        return CUT.split(text)
    parts = text.replace(" ", "\0 ")
    if "\n" in text and not BESIDE.search(text):
        parts = parts.replace("\n", "\0\n\0")
    finer = parts.replace(",\0", "\0,\0").replace(".\0", "\0.\0")
    return (parts if SIGNS.search(finer) else finer).split("\0")


#: Parts kept for good, parts kept beside them until there are so many, and the longest part that is kept.
KEPT, KEPT_FOR_NOW, KEPT_LENGTH = 600_000, 300_000, 64


class PartEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        self.pattern = regex.compile(PATTERN)
        # What comes first is mostly what comes often, so it stays; the rest makes room for what comes later.
        self.known: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.looked_up = self.unknown = 0

    def _ask(self, part: str) -> bytes:
        """Ids of one part: the library's model on each pre-token.  A word with or without a space before it is one."""
        word = part[1:] if part[:1] == " " else part
        if word.isalpha():
            if word.isascii():
                piece = part if word is part else SPACE + word
            else:
                piece = part.encode().decode("latin-1").translate(LETTER_OF_BYTE)
            return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        pieces = self.pattern.findall(part)
        if len(pieces) == 1:
            piece = part.encode().decode("latin-1").translate(LETTER_OF_BYTE)
            return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        return b"".join([self.known.get(p) or self.later.get(p) or self._ask(p) for p in pieces])

    def _room(self) -> None:
        """Make room; where most parts have become unknown, the later ones take the place of the first."""
        if len(self.later) > KEPT_FOR_NOW:
            if 2 * self.unknown > self.looked_up:
                self.known = self.later
            self.later, self.looked_up, self.unknown = {}, 0, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        self._room()
        known, later = self.known, self.later
        done, waiting, new = [], [], set()
        for text in texts:
            parts = cut(text)
            found = list(map(known.get, parts))
            self.looked_up += len(parts)
            try:
                done.append(b"".join(found))  # fails where a part is not known
            except TypeError:
                at, places = -1, []
                try:
                    while True:
                        at = found.index(None, at + 1)
                        places.append(at)
                except ValueError:
                    pass
                self.unknown += len(places)
                missed = [parts[i] for i in places]
                new.update(missed)
                waiting.append((len(done), found, places, missed))
                done.append(None)
        asked = {}
        for part in sorted([p for p in new if p not in later], key=len):  # words come before words with signs behind them
            ids = asked[part] = self._ask(part)
            if len(part) <= KEPT_LENGTH:
                (known if len(known) < KEPT else later)[part] = ids
        for at, found, places, missed in waiting:
            for i, part in zip(places, missed):
                found[i] = asked[part] if part in asked else later[part]
            done[at] = b"".join(found)
        return done


_ENCODERS: dict[str, PartEncoder] = {}


def encoder(path: str) -> PartEncoder:
    """The one encoder of a file in this Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PartEncoder(path)
    return _ENCODERS[path]


def in_steps(texts: list[str], characters: int = 400_000):
    """Ranges of ``texts`` of about so many characters: bounds what is in memory at once."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
