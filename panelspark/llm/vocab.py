"""Encoding with the tokenizers library, one distinct piece of text at a time."""

from __future__ import annotations

import hashlib
import os
import unicodedata

import numpy as np
import pyarrow as pa

from panelspark.llm import words as W

#: Pieces remembered by one Python worker; beyond it those that came up once only are forgotten.
REMEMBERED = 1_000_000
#: New pieces encoded in one call.
GROUP = 256
WORD_END = "</w>"
_encoders: dict[tuple[str, bool], "PieceEncoder"] = {}


def vocabulary_size(definition: bytes) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition.decode()).get_vocab_size(with_added_tokens=True)


def encoder(definition: bytes, spaced: bool) -> "PieceEncoder":
    """This worker's encoder of a tokenizer file's content; ``spaced``: white space belongs to the pieces."""
    key = (hashlib.md5(definition).hexdigest(), spaced)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(definition, spaced)
    return _encoders[key]


class PieceEncoder:
    """Ids of whole texts, put together from those of their pieces.

    Both kinds of vocabulary treat the pieces of ``words.words`` or ``words.pieces`` independently,
    so a piece that occurs often is given to the library once. Special tokens' strings are ordinary text.
    """

    def __init__(self, definition: bytes, spaced: bool, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.decode())
        self.tokenizer.encode_special_tokens = True
        self.spaced, self.remembered = spaced, remembered
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        self.closes = np.ones(len(self.width), bool)
        for name, i in names.items():
            self.closes[i] = spaced or name.endswith(WORD_END)
            self.width[i] = len(name) - len(WORD_END) * (not spaced and name.endswith(WORD_END))
        self._forget()

    def _forget(self) -> None:
        # by ascending hash: about 40 bytes a piece, a quarter of what a dictionary of Python integers takes
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def _thin(self) -> None:
        """Keep the pieces that came up again since the last time, unless they are more than half."""
        kept = np.flatnonzero(self.again)
        hashes, first, length, flat = self.hashes[kept], self.first[kept], self.length[kept].astype(np.int64), self.flat
        self._forget()
        if len(kept) <= self.remembered // 2:
            self.hashes, self.length, self.again = hashes, length.astype(np.int32), np.zeros(len(kept), bool)
            self.first = np.cumsum(length) - length
            self._add(flat[np.repeat(first - self.first, length) + np.arange(int(length.sum()))])

    def _learn(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode new pieces, GROUP at a time in one text, and tell them apart by the bytes of their ids.

        Returns each piece's place among the ids remembered and its number of ids.
        """
        first, length = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int32)
        texts = [r.decode() for r in raw]
        if self.spaced:
            sizes = [len(r) for r in raw]
            alone = [r[0] not in b" \t\n\x0b\x0c\r" or t[-1].isspace() for r, t in zip(raw, texts)]
        else:
            sizes = [
                len(r) if r.isascii() else len(unicodedata.normalize("NFC", t).lower().encode())
                for r, t in zip(raw, texts)
            ]
            alone = [False] * len(raw)
        single = [i for i, x in enumerate(alone) if x]
        several = [i for i, x in enumerate(alone) if not x]
        groups = [several[lo : lo + GROUP] for lo in range(0, len(several), GROUP)]
        glue = "" if self.spaced else " "
        joined = self.tokenizer.encode_batch_fast(
            [glue.join([texts[i] for i in g]) for g in groups], add_special_tokens=False
        )
        for group, item in zip(groups, joined):
            ids = np.array(item.ids, np.uint32)
            ends = np.cumsum(self.width[ids])
            bounds = np.cumsum([sizes[i] for i in group])
            at = np.searchsorted(ends, bounds)
            if len(ends) and ends[-1] == bounds[-1] and (ends[at] == bounds).all() and self.closes[ids[at]].all():
                length[group] = np.diff(at, prepend=-1)
                first[group] = self._add(ids) + at + 1 - length[group]
            else:
                single += group
        for lo in range(0, len(single), 4096):
            some = single[lo : lo + 4096]
            for i, item in zip(some, self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)):
                length[i] = len(item.ids)
                first[i] = self._add(np.array(item.ids, np.uint32))
        return first, length

    def _add(self, ids: np.ndarray) -> int:
        """The place where ``ids`` are kept from now on."""
        at, need = self.used, self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, max(len(self.flat) * 3 // 2, need))
        self.flat[at:need] = ids
        self.used = need
        return at

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, number of ids of each row)."""
        data, offsets = W.column_bytes(column)
        out, counts = [], np.zeros(len(column), np.int64)
        for part in W.pieces(data, offsets) if self.spaced else W.words(data, offsets, lower=False):
            if not len(part.start):
                continue
            hashes, first, inverse = np.unique(part.hashes(), return_index=True, return_inverse=True)
            if len(self.hashes) > self.remembered:
                self._thin()
            at = np.searchsorted(self.hashes, hashes)
            known = np.zeros(len(hashes), bool)
            if len(self.hashes):
                known = self.hashes.take(at, mode="clip") == hashes
                self.again[at[known]] = True
            new = np.flatnonzero(~known)
            if len(new):
                raw, where = part.data.tobytes(), first[new]
                bounds = zip(part.start[where].tolist(), part.end[where].tolist())
                place, size = self._learn([raw[s:e] for s, e in bounds])
                self.hashes = np.insert(self.hashes, at[new], hashes[new])
                self.first, self.length = np.insert(self.first, at[new], place), np.insert(self.length, at[new], size)
                self.again = np.insert(self.again, at[new], False)
                at = np.searchsorted(self.hashes, hashes)
            length = self.length[at][inverse].astype(np.int64)
            total = int(length.sum())
            source = np.repeat(self.first[at][inverse] - (np.cumsum(length) - length), length) + np.arange(total)
            out.append(self.flat[source])
            np.add.at(counts, part.row, length)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), counts
