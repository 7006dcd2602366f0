"""Encoding with the tokenizers library, with the ids of seen words kept.

The library's work on a text is the concatenation of its work on the parts between
white space: its normalizer, pattern and merges never reach across. So each part is
encoded by the library once in a process and then looked up. A-Z may be lower-cased
first, as the tokenizer itself does, unless the text holds combining marks (then the
library gets the whole block). A part that holds the literal of an added token goes to
the library as it is, before lower-casing, and is never kept. ``encode_rows`` takes many texts
at once: their distinct parts, and in these words and marks, are found by Arrow, so that the
work in Python grows with the distinct words. Tests compare all ids with those of the
library's plain call on whole texts.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tokentally.llm.common import BLOCK_BYTES, blocks

#: Bytes of parts, ids and their keeping that a process holds, about. What was used in the time that half of them were
#: filled stays when the rest goes.
KEPT_BYTES = 80 << 20
#: Longer parts are never kept. Each kept part takes about so many bytes beside its own and its ids.
LONGEST_KEPT, KEEPING = 64, 150

#: Slots that remember, by hash, that a part was seen; most parts of a corpus are seen once and never kept.
SEEN = 1 << 22

#: Longer texts are encoded in pieces of about so many bytes.
PIECE_BYTES = 1 << 18
#: Bytes of texts whose distinct parts are looked up together.
WINDOW_BYTES = 8 << 20

_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")
#: Where letters or digits and marks meet, two matches of the pattern meet (it takes ' with what stands beside it).
_LETTER, _MARK = "[a-z0-9ß-öø-ÿ]", "[" + re.escape(_MARKS.decode()) + "]"
_LETTER_MARK, _MARK_LETTER = f"({_LETTER})({_MARK})", f"({_MARK})({_LETTER})"
_stores: dict[str, "WordEncoder"] = {}


def _byte_alphabet() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _bytes_of(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _split(texts: pa.Array) -> tuple[pa.Array, pa.DictionaryArray]:
    """The parts between white space as places among the distinct ones, and where each text's begin and end."""
    parts = pc.ascii_split_whitespace(texts)
    return parts.offsets, parts.flatten().dictionary_encode()


def _joined(offsets: pa.Array, ids: pa.Array) -> pa.Array:
    """The ids between offsets as one value each."""
    return pc.binary_join(pa.ListArray.from_arrays(offsets, ids), b"")


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, definition: str, kept_bytes: int = KEPT_BYTES):
        self.tokenizer = Tokenizer.from_str(definition)
        self.kept_bytes, self.held, self.store, self.older = kept_bytes, 0, {}, {}
        self.seen = bytearray(SEEN)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.literals = re.compile("|".join(map(re.escape, added)).encode(), re.IGNORECASE) if added else None

    def whole(self, text: str) -> bytes:
        return _bytes_of(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """A word of small letters is one match of the pattern: it goes to the merges directly."""
        shown = word if word.isascii() else "".join([self.alphabet[b] for b in word.encode()])
        return _bytes_of([t.id for t in self.model.tokenize(shown)])

    def _part(self, part: bytes) -> bytes:
        word = part.rstrip(_MARKS)
        if word.isalpha() or _LETTERS.fullmatch(word.decode()):
            if len(word) < len(part):  # a run of marks is a match of its own
                return self._found(word) + self._found(part[len(word) :])
            return self._letters(part.decode())
        return self.whole(part.decode())

    def _found(self, part: bytes) -> bytes:
        """The ids of a lower-cased part without white space; kept from the second time on."""
        ids = self.store.get(part)
        if ids is not None:
            return ids
        ids = self.older.get(part)
        if ids is None:
            ids = self._part(part)
            if len(part) > LONGEST_KEPT:
                return ids
            slot = hash(part) & (SEEN - 1)
            if not self.seen[slot]:
                self.seen[slot] = 1
                return ids
        self.held += len(part) + len(ids) + KEEPING
        self.store[part] = ids
        return ids

    def _make_room(self) -> None:
        if self.held > self.kept_bytes // 2:
            self.older, self.store, self.held = self.store, {}, 0
            self.seen = bytearray(SEEN)

    def encode(self, data: bytes) -> bytes:
        if len(data) > PIECE_BYTES:
            return b"".join([self._block(b) for b in blocks(data)])
        return self._block(data)

    def encode_rows(self, rows: Iterable[tuple[Any, bytes]], window_bytes: int = WINDOW_BYTES) -> Iterator[tuple[Any, bytes]]:
        """Each ``(key, text)`` as ``(key, ids)``, in order; the ids are those of ``encode``.

        Texts, or pieces of long ones, pass in windows of about ``window_bytes`` (a run without white
        space may be longer); a part is looked up once in a window, however often it stands there.
        """
        ends, pieces, size, begun = [], [], 0, []

        def close() -> Iterator[tuple[Any, bytes]]:
            for (key, last), ids in zip(ends, self._window(pieces)):
                begun.append(ids)
                if last:
                    yield key, b"".join(begun)
                    begun.clear()

        for key, text in rows:
            cut = list(blocks(text)) if len(text) > PIECE_BYTES else [text]
            for n, piece in enumerate(cut, 1):
                ends.append((key, n == len(cut)))
                pieces.append(piece)
                size += len(piece) + 100  # empty texts take memory too
                if size >= window_bytes:
                    yield from close()
                    ends, pieces, size = [], [], 0
        yield from close()

    def _window(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece; A-Z are lower-cased and parts told apart for all of them at once."""
        apart = {n: self._block(p) for n, p in enumerate(pieces) if len(p) > 2 * BLOCK_BYTES or self._needs_block(p)}
        texts = pa.array([b"" if n in apart else p for n, p in enumerate(pieces)], pa.string())
        ends, parts = _split(pc.ascii_lower(texts))
        spaced = pc.replace_substring_regex(parts.dictionary, _LETTER_MARK, r"\1 \2")
        inner_ends, words = _split(pc.replace_substring_regex(spaced, _MARK_LETTER, r"\1 \2"))
        known = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.store.get, known))
        for n, kept in enumerate(ids):
            if kept is None:
                self._make_room()
                ids[n] = self._found(known[n])
        of_parts = _joined(inner_ends, pa.array(ids, pa.binary()).take(words.indices))
        out = _joined(ends, of_parts.take(parts.indices)).to_pylist()
        for n, whole in apart.items():
            out[n] = whole
        return out

    def _needs_block(self, data: bytes) -> bool:
        """Whether parts of ``data`` may not be lower-cased and looked up: combining marks and literals."""
        return b"\xcc" in data or b"\xcd" in data or bool(self.literals and self.literals.search(data))

    def _block(self, data: bytes) -> bytes:
        if b"\xcc" in data or b"\xcd" in data:  # U+0300 to U+036F
            return self.whole(data.decode())
        self._make_room()
        if self.literals and self.literals.search(data):  # rare: literals count before lower-casing
            parts = data.split()
            return b"".join([self.whole(p.decode()) if self.literals.search(p) else self._found(p.lower()) for p in parts])
        parts = data.lower().split()
        ids = list(map(self.store.get, parts))
        if None in ids:
            ids = [self._found(p) if known is None else known for p, known in zip(parts, ids)]
        return b"".join(ids)


def encoder(definition: str) -> WordEncoder:
    """This process's encoder for a tokenizer definition (the text of its file)."""
    if definition not in _stores:
        _stores.clear()
        _stores[definition] = WordEncoder(definition)
    return _stores[definition]


def definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
