"""Public tokenizer libraries over blocks of texts, each distinct unit encoded once.

A *unit* is a run of white space and the run of other characters after it.  A tokenizer that
never joins a character to white space after it gives a text the ids of its units one after
another, so only the distinct units of a worker go through the library; everything else is
array work.  Where the white space before a cut could be part of a longer run (a Unicode
space ends there) no cut is made, so a unit may hold several words.

``byte_level`` and ``pieces`` make the encoders of the two kinds of vocabulary files.  Equal
hashes are checked against the bytes, so ids never rest on a hash.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from . import textkit as tk

#: Units remembered by a worker; beyond them it starts afresh.
KEPT_UNITS = 500_000
#: New units that go through the library as one text.
JOINED_UNITS = 500


def _after_unicode_space(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position may be a white space of several bytes
    (all of U+2000 to U+207F count, and U+2581, a space to piece vocabularies)."""
    one, two, three = (buf[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return (((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
            | ((three == 0xE2) & ((two == 0x80) | (two == 0x81)))
            | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
            | ((three == 0xE2) & (two == 0x96) & (one == 0x81))
            | ((three == 0xE3) & (two == 0x80) & (one == 0x80)))


def unit_starts(buf: np.ndarray, off: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Positions where units begin: the first byte of every row that is not empty, and each
    byte of the table ``space`` after one that is no white space."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    cut = np.zeros(n, bool)
    at = np.flatnonzero(space[buf[1:]] & ~tk.IS_SPACE[buf[:-1]]) + 1
    cut[at[~_after_unicode_space(buf, at)]] = True
    cut[off[:-1][off[1:] > off[:-1]]] = True
    return np.flatnonzero(cut)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] ... starts[i] + lengths[i] - 1`` of all i in one array."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


class UnitEncoder:
    """Ids of whole blocks.  ``encode_many`` maps texts (bytes) to their ids, ``tokens`` are
    the bytes of every id.  New units go through the library joined to texts of some KB, as
    a call for each would cost more than its ids; the bytes of the ids tell where units end.
    Where they do not (a character that the library rewrites), units are encoded one by one."""

    def __init__(self, encode_many: Callable[[list[bytes]], list[list[int]]], space: bytes,
                 tokens: list[bytes]):
        self.encode_many = encode_many
        self.space = np.isin(np.arange(256), list(space))
        self.lead = tuple(bytes([b]) for b in space)
        self.token_length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def _encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after another, and how many each has."""
        joins = [u.startswith(self.lead) and not u.decode()[-1].isspace() for u in units]
        alone = [k for k, j in enumerate(joins) if not j]
        together = [k for k, j in enumerate(joins) if j]
        flat: list[np.ndarray] = []
        sizes = np.zeros(len(units), np.int64)
        order: list[int] = []
        for at in range(0, len(together), JOINED_UNITS):
            part = together[at:at + JOINED_UNITS]
            (ids,) = self.encode_many([b"".join([units[k] for k in part])])
            ids = np.array(ids, np.uint32)
            ends = np.cumsum([len(units[k]) for k in part])
            reached = np.cumsum(self.token_length[ids])
            cut = np.searchsorted(reached, ends)
            if len(ids) and reached[-1] == ends[-1] and np.array_equal(reached[cut], ends):
                sizes[part] = np.diff(cut + 1, prepend=0)
                flat.append(ids)
                order += part
            else:
                alone += part
        for k, ids in zip(alone, self.encode_many([units[k] for k in alone]), strict=True):
            sizes[k] = len(ids)
            flat.append(np.array(ids, np.uint32))
        order = np.array(order + alone, np.int64)
        starts = np.empty(len(units), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        pool = np.concatenate([np.zeros(0, np.uint32), *flat])
        return pool[spread(starts, sizes)], sizes

    def _units(self, found: list[bytes]) -> np.ndarray:
        """Numbers of units, the unknown ones encoded and remembered."""
        if len(self.number) > KEPT_UNITS:
            self._forget()
        number = self.number
        fresh = [u for u in found if u not in number]
        if fresh:
            flat, sizes = self._encode(fresh)
            number.update(zip(fresh, range(len(number), len(number) + len(fresh)), strict=True))
            self.pool = np.concatenate([self.pool, flat])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        return np.fromiter(map(number.__getitem__, found), np.int64, len(found))

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block's rows (``uint32``), and each row's bounds in them."""
        starts = unit_starts(buf, off, self.space)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        ends = np.append(starts[1:], len(buf))
        _, first, same = np.unique(tk.hash_spans(buf, starts, ends), return_index=True,
                                   return_inverse=True)
        raw = buf.tobytes()
        if (np.array_equal((ends - starts)[first][same], ends - starts)
                and np.array_equal(buf[spread(starts[first][same], ends - starts)], buf)):
            distinct = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(),
                                                 strict=True)]
            unit = self._units(distinct)[same]
        else:    # two units share a hash
            unit = self._units_by_bytes(raw, starts, ends)
        lengths = np.diff(self.bounds)[unit]
        bounds = np.r_[0, np.cumsum(lengths)]
        return (self.pool[spread(self.bounds[unit], lengths)],
                bounds[np.searchsorted(starts, off)])

    def _units_by_bytes(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        every = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        distinct = list(dict.fromkeys(every))
        place = {u: k for k, u in enumerate(distinct)}
        return self._units(distinct)[[place[u] for u in every]]


@lru_cache(maxsize=4)
def byte_level(definition: bytes, special_text: bool = False) -> UnitEncoder:
    """Encoder of the ``tokenizers`` library, without added special tokens.  With
    ``special_text`` the strings of special tokens inside texts are plain text; otherwise
    they are those tokens, as is the library's default."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition.decode())
    tokenizer.encode_special_tokens = special_text

    def encode_many(units: list[bytes]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([u.decode() for u in units],
                                                           add_special_tokens=False)]

    return UnitEncoder(encode_many, tk.SPACES, token_bytes_byte_level(definition))


@lru_cache(maxsize=2)
def pieces(model: bytes) -> UnitEncoder:
    """Encoder of the ``sentencepiece`` library for texts to which the space that the library
    puts in front has been added already."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    space = processor.piece_to_id("▁")

    def encode_many(units: list[bytes]) -> list[list[int]]:
        # the library adds one space in front; nothing but that space is no text for it
        return [ids or [space] for ids in processor.encode(
            [u[1:].decode() for u in units], num_threads=1)]

    return UnitEncoder(encode_many, b" ", token_bytes_pieces(model))


def token_bytes_byte_level(definition: bytes) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    import json

    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in printable}
    shown |= {chr(0x100 + k): b for k, b in
              enumerate(b for b in range(256) if b not in set(printable))}
    entries = json.loads(definition)
    special = {t["id"]: t["content"].encode() for t in entries["added_tokens"]}
    tokens = [b""] * (max([*entries["model"]["vocab"].values(), *special]) + 1)
    for token, i in entries["model"]["vocab"].items():
        tokens[i] = bytes(shown[c] for c in token)
    for i, content in special.items():
        tokens[i] = content
    return tokens


def token_bytes_pieces(model: bytes) -> list[bytes]:
    """Bytes of every id of a piece vocabulary: U+2581 is a space, <0xHH> the byte HH."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else
            p.replace("▁", " ").encode()
            for i, p in ((i, processor.id_to_piece(i)) for i in range(processor.get_piece_size()))]
