"""Tokenizer ids of whole texts, exactly as the tokenizers library gives them, at a fraction of its cost.

A byte-level BPE never merges across its pre-tokenizer's cuts.  For the usual pattern a text may be cut
before each word together with one leading space, between an ASCII letter and a mark other than the apostrophe,
and inside runs of white space before the last character.
Each distinct unit is encoded once by the library and kept in a bounded cache; a batch is then assembled
from cached id runs with numpy.  Texts in which the cuts are not safe (white space outside ASCII, control
separators, the text of a special token) are encoded whole by the library.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textnp import Slice, slices

#: Bits of the table of recent units.
SLOTS = 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A run of letters ends before any of these marks, whatever follows; the apostrophe is left out for contractions.
_LETTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True
#: White space beyond ASCII, ASCII information separators, and the opening of a special token.
_UNSAFE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf|<\|")


class UnitTokenizer:
    """Encodes slices of texts.  ``cache_units`` bounds the number of distinct units that are kept."""

    def __init__(self, path: str, cache_units: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache_units = cache_units
        self.dtype = np.uint16 if self.tok.get_vocab_size() < 1 << 16 else np.uint32
        (self.line_feed,) = self.tok.encode("\n", add_special_tokens=False).ids
        self.resets = 0
        self._reset()

    def _reset(self) -> None:
        self.resets += 1
        self.slot_key = np.zeros(1 << SLOTS, np.uint64)
        self.slot_at = np.zeros(1 << SLOTS, np.int64)
        self.slot_size = np.zeros(1 << SLOTS, np.int32)
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.dtype)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and each unit's number of them.  Units are joined by line feeds, which stay tokens of their own."""
        flat, sizes = [], []
        for k in range(0, len(units), 4000):
            part = units[k : k + 4000]
            ids = np.array(self.tok.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            feed = ids == self.line_feed
            size = np.diff(np.flatnonzero(feed), prepend=-1, append=len(ids)) - 1
            if len(size) != len(part):
                raise ValueError("the pre-tokenizer does not cut at line feeds")
            flat.append(ids[~feed])
            sizes.append(size)
        return np.concatenate(flat), np.concatenate(sizes)

    def _units(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        n = len(s.buf)
        space, doc = _SPACE[s.buf], s.doc_starts()
        before = np.zeros(n, dtype=bool)
        before[1:] = space[:-1]
        before[doc[:n]] = False
        blank_before = np.zeros(n, dtype=bool)
        blank_before[1:] = s.buf[:-1] == 32
        after = np.zeros(n, dtype=bool)  # a character of the same text that is no white space follows
        after[:-1] = ~space[1:]
        after[doc[1:]] = False
        letter_before = np.zeros(n, dtype=bool)
        letter_before[1:] = _LETTER[s.buf[:-1]]
        cut = doc[:n] | (letter_before & _MARK[s.buf]) | (space & ~before) | (space & after) | (~space & before & ~blank_before)
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], n)

    def _lookup(self, s: Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length in the pool of each unit's ids: from the table of recent units, else found by sorting."""
        h = s.hash_spans(starts, ends)
        slot = (h >> np.uint64(64 - SLOTS)).astype(np.int64)
        place, size = self.slot_at[slot], self.slot_size[slot].astype(np.int64)
        miss = np.flatnonzero((self.slot_key[slot] != h) | (size == 0))
        if len(miss):
            before = self.resets
            found = self._find(s, h[miss], starts[miss], ends[miss])
            if self.resets != before:  # the pool was begun anew, so what the table said is void
                miss = np.arange(len(h))
                found = self._find(s, h, starts, ends)
            place[miss], size[miss] = found
            self.slot_key[slot[miss]], self.slot_at[slot[miss]], self.slot_size[slot[miss]] = h[miss], place[miss], size[miss]
        return place, size

    def _find(self, s: Slice, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.keys) + len(new) > self.cache_units:
                self._reset()
                new = np.arange(len(keys))
            raw = s.buf.tobytes()
            blank = _SPACE[s.buf[ends[first[new]] - 1]]
            plain, new_blank = new[~blank], new[blank]
            new = np.concatenate([plain, new_blank])
            units = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            ids = self._encode(units[len(plain) :])
            flat = np.fromiter((y for x in ids for y in x), self.dtype)
            size = np.fromiter((len(x) for x in ids), np.int64, len(ids))
            if len(plain):
                plain_flat, plain_size = self._encode_units(units[: len(plain)])
                flat, size = np.concatenate([plain_flat, flat]), np.concatenate([plain_size, size])
            place = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, flat])
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.at = np.concatenate([self.at, place])[order]
            self.size = np.concatenate([self.size, size])[order]
            at = np.searchsorted(self.keys, keys)
        return self.at[at][inverse], self.size[at][inverse]

    def encode_slice(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's texts, and the n + 1 bounds of each text's ids."""
        unsafe: dict[int, list[int]] = {}
        if m := [x.start() for x in _UNSAFE.finditer(s.buf.tobytes())]:
            docs = np.unique(s.doc_of(np.array(m)))
            raw = s.buf.tobytes()
            texts = [raw[s.offs[d] : s.offs[d + 1]].decode() for d in docs]
            unsafe = dict(zip(docs.tolist(), self._encode(texts), strict=True))
        if len(s.buf):
            starts, ends = self._units(s)
            doc = s.doc_of(starts)
            if unsafe:
                keep = ~np.isin(doc, list(unsafe))
                starts, ends, doc = starts[keep], ends[keep], doc[keep]
            place, size = self._lookup(s, starts, ends)
        else:
            doc = place = size = np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.pool[np.arange(upto[-1]) + np.repeat(place - upto[:-1], size)] if upto[-1] else np.zeros(0, self.dtype)
        bounds = upto[np.searchsorted(doc, np.arange(len(s) + 1))]
        if not unsafe:
            return flat, bounds
        parts = [np.array(unsafe[d], self.dtype) if d in unsafe else flat[bounds[d] : bounds[d + 1]] for d in range(len(s))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def encode(self, column: pa.Array) -> Iterator[tuple[Slice, np.ndarray, np.ndarray]]:
        for s in slices(column):
            yield (s, *self.encode_slice(s))


_tokenizers: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    """One per Python worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]
