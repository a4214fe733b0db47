"""Exact, cached encoding with the tokenizers library, for workers.

A byte-pair tokenizer works on one pre-token after the other, so a text's ids are those of its chunks between white
space. Which white space a chunk may be cut at is found out from the tokenizer; texts in which cutting might matter
are encoded whole. The ids of chunks seen are kept, in bounded memory.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

CACHE_CHUNKS = 150_000
#: A chunk of letters that have no other composed or lower-case form than their own, with marks after them that can't
#: be part of a contraction: letters and marks are pre-tokens of their own.
SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*#$%&|]*)").fullmatch
#: Byte-level vocabularies write a byte as itself where it is printable, else as the next character from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {b: b if b in _PRINTABLE else 256 + sum(x not in _PRINTABLE for x in range(b)) for b in range(256)}


class Chunks(dict):
    """Ids of chunks, found when they are first asked for."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.find(chunk)
        return ids


CONTROL = re.compile("[\x00-\x08\x0b-\x1f\x7f-\x9f]")


@lru_cache(4)
def encoder(path: str) -> Encoder:
    """The worker's encoder: loaded once, and its chunks kept from one partition to the next."""
    return Encoder(path)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Chunks at the start of a line or text, chunks after a space, and runs of letters.
        self.first, self.spaced = Chunks(lambda c: self._chunk("", c)), Chunks(lambda c: self._chunk(" ", c))
        self.letters: dict[str, bytes] = {}
        ids = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fold = ids("AbC") == ids("abc")
        self.newline = self.whole("\n")
        if ids("ab Cd,\nEf") == ids("ab") + ids("Cd,") + ids("Ef"):
            self.by_chunks = self._words
        elif ids("ab Cd,\nEf\n\ngh") == ids("ab") + ids(" Cd,") + ids("\n") + ids("Ef") + ids("\n") + ids("\n") + ids("gh"):
            self.by_chunks = self._lines
        else:
            self.by_chunks = lambda text: None

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.spaced) > CACHE_CHUNKS:
            self.first.clear()
            self.spaced.clear()
            self.letters.clear()
        out = []
        for t in texts:
            ids = self.by_chunks(t)
            out.append(self.whole(t) if ids is None else ids)
        return out

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def _words(self, text: str) -> bytes | None:
        """For a tokenizer that drops white space: chunk by chunk, unless a control character may be taken for some."""
        if self._has_special(text) or not text.replace("\n", " ").isprintable() and CONTROL.search(text):
            return None
        return b"".join(map(self.first.__getitem__, text.split()))

    def _lines(self, text: str) -> bytes | None:
        """For a tokenizer that joins a space to the word after it: single spaces and at most two line ends together,
        as a longer run of white space is divided otherwise."""
        if self._has_special(text) or not text.replace("\n", " ").isprintable():
            return None
        if "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n"):
            return None
        out: list[bytes] = []
        first, spaced = self.first, self.spaced.__getitem__
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.newline)
            if line:
                head, *rest = line.split(" ")
                out.append(first[head])
                out.extend(map(spaced, rest))
        return b"".join(out)

    def _chunk(self, space: str, chunk: str) -> bytes:
        simple = SIMPLE(chunk)
        if not simple:
            return self.whole(space + chunk) if space or chunk else b""
        word, marks = simple.groups()
        ids = self._letters(space, word.lower() if self.fold else word)
        return ids + self._marks(marks) if marks else ids

    def _letters(self, space: str, word: str) -> bytes:
        found = self.letters.get(space + word)
        if found is None:
            text = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARACTERS)
            found = self.letters[space + word] = array("I", [t.id for t in self.tokenizer.model.tokenize("\u0120" + text if space else text)]).tobytes()
        return found

    def _marks(self, marks: str) -> bytes:
        found = self.letters.get(marks)
        if found is None:
            found = self.letters[marks] = self.whole(marks)
        return found
