"""Whole texts encoded by their segments, each distinct segment once.

A segment is a run of spaces with what follows up to the next such run: a text
is cut before a space that comes after anything but white space. Byte-level
pre-tokenisation starts a new word at each such place, and no piece of the
sentencepiece vocabulary goes on from a letter to a space (checked when it is
loaded), so the ids of a text are those of its segments end to end. Byte-level
vocabularies also cut before a newline and before a punctuation mark after a letter. What a
library gives for a segment is kept for the life of a Python worker, up to
``KEEP`` segments unless a caller says how many.
"""

from __future__ import annotations

import itertools
import re
import sys
import types

import numpy as np
import pyarrow as pa

KEEP = 500_000
AT_ONCE = 1 << 10  # bytes of segments encoded as one text; the library is slower on longer ones


def _cuts(before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Whether a space after the bytes ``earlier, before`` begins a segment: not after white space.

    A few characters that end like white space of two or three bytes count as such.
    """
    wide = ((earlier == 0xC2) & ((before == 0x85) | (before == 0xA0))) | (
        ((earlier == 0x80) | (earlier == 0x81) | (earlier == 0x9A)) & (before >= 0x80) & (before <= 0xAF))
    return (before > 32) & (before != 127) & ~wide


_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK[list(b",.;:!?")] = True


def segments(data: np.ndarray, offsets: np.ndarray, fine: bool = False):
    """Distinct segments, each segment's number among them, and each text's first segment.

    ``offsets`` has the texts' first bytes and the end. An empty text has no segment.
    ``fine``: also cut before newlines and marks.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        inner, before = data[1:], data[:-1]
        gap = (inner == 32) | (inner == 10) if fine else inner == 32
        cut[1:n] = gap & _cuts(before, np.concatenate([data[:1], data[:-2]]))
        if fine:
            cut[1:n] |= _MARK[inner] & _LETTER[before]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    whole = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    found = whole.dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, offsets)


def for_worker(name: str, make):
    """One ``make()`` for each Python worker, which Spark uses again for other tasks."""
    held = sys.modules.setdefault("_riskloom_worker", types.ModuleType("_riskloom_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def forget() -> None:
    """Drop what ``for_worker`` keeps in this Python worker."""
    sys.modules.pop("_riskloom_worker", None)


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library."""

    def __init__(self, model: str, plain_specials: bool):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        if plain_specials:
            self.library.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        added = self.library.get_added_tokens_decoder()
        # special tokens that a finer cut would part
        self.fine = plain_specials or not any(re.search("[A-Za-z][,.;:!?]|\n", t.content) for t in added.values())
        self.table = [b""] * self.library.get_vocab_size(True)
        for token, i in self.library.get_vocab(True).items():
            self.table[i] = token.encode() if i in added else bytes(byte[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model with byte fallback, for texts that begin with a space of its own adding."""

    fine = False

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(re.search("[^▁]▁", x) for x in names):
            raise ValueError("pieces that go on over a space can't be cut before it")
        self.table = [bytes([int(x[3:-1], 16)]) if sp.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.space = sp.piece_to_id("▁")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which the library adds by itself."""
        found = self.library.encode([x[1:] for x in texts], num_threads=1)
        return [[self.space] if x == " " else ids for x, ids in zip(texts, found, strict=True)]


class Kept:
    """Ids of segments, from the library once for each; all are dropped when there are more than ``most`` (else ``KEEP``)."""

    def __init__(self, library, most: int | None = None):
        self.library, self.most = library, most
        self.size = np.fromiter(map(len, library.table), np.int64, len(library.table))
        self._clear()

    def _clear(self):
        self.known: dict[bytes, int] = {}
        self.flat, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.exact = np.zeros(0, bool)

    def _learn(self, new: list[bytes]) -> None:
        """Encodes segments; many as one text where that can't change them."""
        table = self.library.table
        last = np.frombuffer(b"".join([b"\0" + s if len(s) == 1 else s[-2:] for s in new]), np.uint8)
        begin = np.frombuffer(b"".join([s[:1] for s in new]), np.uint8)
        whole = _cuts(last[1::2], last[::2]) & ((begin == 32) | (begin == 10))
        one, joined = (list(itertools.compress(new, x)) for x in ((~whole).tolist(), whole.tolist()))
        after = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        edge = [*np.flatnonzero(np.diff(after // AT_ONCE, prepend=-1)).tolist(), len(joined)]
        groups = [joined[x:y] for x, y in itertools.pairwise(edge)]
        again = []
        got = self.library.encode([b"".join(g).decode() for g in groups])
        if b"".join([table[i] for ids in got for i in ids]) != b"".join([s for g in groups for s in g]):
            true = [b"".join([table[i] for i in ids]) == b"".join(g) for g, ids in zip(groups, got, strict=True)]
            again = [s for g, ok in zip(groups, true, strict=True) if not ok for s in g]
            groups = [g for g, ok in zip(groups, true, strict=True) if ok]
            got = [ids for ids, ok in zip(got, true, strict=True) if ok]
        if groups:
            group = [s for g in groups for s in g]
            ids = np.fromiter(itertools.chain.from_iterable(got), np.int32)
            stop = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(np.array(list(map(len, group))))) + 1
            self._add(group, ids, np.diff(stop, prepend=0), np.ones(len(group), bool))
        one += again
        got = self.library.encode([s.decode() for s in one])
        same = [b"".join([table[i] for i in ids]) == s for s, ids in zip(one, got, strict=True)]
        self._add(one, np.array([i for ids in got for i in ids], np.int32), np.fromiter(map(len, got), np.int64, len(got)), np.array(same, bool))

    def _add(self, group: list[bytes], ids: np.ndarray, count: np.ndarray, same: np.ndarray) -> None:
        self.known.update(zip(group, range(len(self.known), len(self.known) + len(group)), strict=True))
        self.ids.append(ids)
        self.count.append(count)
        self.same.append(same)

    def look_up(self, found: list[bytes]) -> np.ndarray:
        """Numbers under which ``flat``, ``first`` and ``exact`` have the segments, for this block only."""
        if len(self.known) > (KEEP if self.most is None else self.most):
            self._clear()
        new = [s for s in found if s not in self.known]
        if new:
            self.ids, self.count, self.same = [self.flat], [], [self.exact]
            self._learn(new)
            self.flat, self.exact = np.concatenate(self.ids), np.concatenate(self.same)
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(self.count))])
        return np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of texts laid end to end, each text's first id, and whether its bytes come back."""
        found, number, first = segments(data, offsets, self.library.fine)
        at = self.look_up(found)[number]
        start, count = self.first[at], self.first[at + 1] - self.first[at]
        stop = np.cumsum(count)
        ids = self.flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - (stop - count), count)].astype(np.int64)
        total = np.concatenate([[0], stop])
        wrong = np.concatenate([[0], np.cumsum(~self.exact[at])])
        return ids, total[first], wrong[first[1:]] == wrong[first[:-1]]
