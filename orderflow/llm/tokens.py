"""Token ids of whole texts from a tokenizer file, fast on large blocks.

The ids are those of the ``tokenizers`` library without added special tokens.
A text is cut where no token can cross -- before the white space that follows
a word -- into chunks; each *distinct* chunk of a block is encoded once, and the
ids of the texts are put together with numpy.  A worker remembers chunks and ids
in Arrow and numpy arrays up to ``CACHE_BYTES``, then those of the last block only.
Chunks of plain characters are split by the tokenizer's own pattern and go
straight to the library's model; every other chunk (special-token strings,
characters whose class or case could differ between Unicode versions, unusual
spaces) is encoded whole by the library.
Tokenizers whose normaliser or pattern is not one of the two known shapes
are always encoded whole, document by document.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from orderflow.llm import words as wd

CACHE_BYTES, PARTS = 8 << 20, 100_000
# Characters whose class, case and composition are the same everywhere:
# printable ASCII, the five ASCII spaces, and U+00A1..U+024F.
_PLAIN = regex.compile("[\\t-\\r\\x20-\\x7e¡-ɏ]*")
# The two pre-tokenisation patterns understood here.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (chr(0x100 + i) for i in range(256))
    return [chr(b) if b in set(own) else next(rest) for b in range(256)]


class Encoder:
    """ids of whole texts for one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        self.kind = None
        if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self.kind, self.pattern = "byte", regex.compile(BYTE_PATTERN)
        elif ([x.get("type") for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                and len(pre.get("pretokenizers", [])) == 2
                and pre["pretokenizers"][0].get("pattern", {}).get("Regex") == WORD_PATTERN):
            self.kind, self.pattern = "word", regex.compile(WORD_PATTERN)
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.model = self.whole.model
        # the chunks encoded so far; chunk i has the ids at[i] to at[i + 1]
        self.known = pa.array([], pa.large_binary())
        self.ids, self.at = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Packed ids of one piece of the pattern, from the library's model."""
        raw = part if part.isascii() and part.isalpha() else \
            part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(raw)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        byte = self.kind == "byte"
        if text.isascii() and self.kind is not None:
            # a word of letters behind at most one space is one piece
            if text[0] == " " and text[1:].isalpha():
                return self._part(text if byte else text[1:].lower())
            if text.isalpha():
                return self._part(text if byte else text.lower())
        if self.kind is None or not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if not byte:
            text = text.lower()
        parts, out = self.parts, []
        for part in self.pattern.findall(text):
            got = parts.get(part)
            if got is None:
                if len(parts) >= PARTS:
                    parts.clear()
                got = parts[part] = self._part(part)
            out.append(got)
        return b"".join(out)

    def cuts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Row ends, and the ends of words before white space."""
        mark = np.zeros(len(data) + 1, dtype=bool)
        if self.kind is not None and len(data):
            ends = wd.words(data, offs)[2]
            last = data[ends - 1]
            # not behind a character that may itself be white space
            two, three = data[np.maximum(ends - 2, 0)], data[np.maximum(ends - 3, 0)]
            odd = ((last >= 0x1C) & (last <= 0x1F)) | ((last >= 0x80) & (
                (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))
            mark[ends[~odd]] = True
        mark[offs] = True
        return np.flatnonzero(mark)

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Where each of the block's chunks is among those known; new ones are encoded."""
        place = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            if self.known.nbytes + self.ids.nbytes > CACHE_BYTES:
                old = np.flatnonzero(place >= 0)
                self.ids, self.at = _gather(self.ids, self.at, place[old])
                self.known = distinct.take(pa.array(old))
                place[old] = np.arange(len(old))
            chunks = distinct.take(pa.array(new))
            packed = [self._chunk(c) for c in wd.byte_list(chunks)]
            place[new] = len(self.known) + np.arange(len(new))
            size = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
            self.known = pa.concat_arrays([self.known, chunks])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(size)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(packed), dtype=np.uint32)])
        return place

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the end)."""
        at = self.cuts(data, offs)
        if len(at) < 2:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offs), dtype=np.int64)
        codes, distinct = wd.encode(wd.as_binary(data, at))
        place = self._places(distinct)[codes]
        out, before = _gather(self.ids, self.at, place)
        # rows end at chunk ends
        return out, before[np.searchsorted(at, offs)]


def _gather(ids: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the chunks at these places, first id of each and the end)."""
    size = at[place + 1] - at[place]
    end = np.concatenate([[0], np.cumsum(size)])
    return ids[np.repeat(at[place] - end[:-1], size) + np.arange(end[-1])], end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file (kept between tasks of one worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
