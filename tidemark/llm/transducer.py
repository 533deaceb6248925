"""Weighted acyclic automata over word sequences: count transducers.

A *trie* holds sorted sequences with a number each, a level per position: the nodes of a
level are sorted, ``parent`` is the node one level up, ``weight`` the number of the sequence
that ends there (0: it is only a prefix of others).  ``Automaton.build`` turns a trie into its
minimal automaton, from the last level up: a state is the list of its transitions (label,
weight, target), and equal states are registered once.  As the input is sorted, all states
of a level are closed when the level above is begun; that is the incremental construction
from sorted sequences, taken a level at a time.  ``expand`` undoes it, ``union`` adds
automata with different symbols, ``split`` cuts by ranges of sequences, and ``compose`` walks
two automata together, giving the weights that one has for the sequences of the other.

Level 0 has symbols of its own (``heads``: languages), the others share ``words``; both are
sorted by bytes.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from . import textkit as tk
from .units import spread

INT = np.int64


@dataclass
class Level:
    label: np.ndarray
    weight: np.ndarray
    parent: np.ndarray

    def children(self, n_parents: int) -> np.ndarray:
        """Bounds of each parent's nodes."""
        return np.searchsorted(self.parent, np.arange(n_parents + 1))


@dataclass
class Trie:
    heads: pa.Array
    words: pa.Array
    levels: list[Level]

    @property
    def size(self) -> int:
        return sum(len(x.label) for x in self.levels)

    def symbols(self, level: int) -> pa.Array:
        return self.words if level else self.heads

    def path(self, level: int, nodes: np.ndarray) -> list[np.ndarray]:
        """Labels on the way to nodes of a level, from level 0 on."""
        out = []
        for k in range(level, -1, -1):
            out.append(self.levels[k].label[nodes])
            nodes = self.levels[k].parent[nodes]
        return out[::-1]


def _bytes(values) -> pa.Array:
    return pa.array(values, pa.large_binary())


def sorted_symbols(col: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values in byte order, and the place of each value among them."""
    coded = col.cast(pa.large_binary()).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), INT)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()] if len(
        col) else np.zeros(0, INT)


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the place of each key among them."""
    return np.unique(key, return_inverse=True)


def _combined(place: np.ndarray, weight: np.ndarray, n: int, how) -> np.ndarray:
    """Weights of one place added, or their maximum taken, as exact integers."""
    out = np.zeros(n, INT)
    how.at(out, place, weight)
    return out


def sequences(columns: list[np.ndarray], lengths: np.ndarray, weight: np.ndarray,
              heads: pa.Array, words: pa.Array, how=np.add) -> tuple[Trie, np.ndarray]:
    """Trie of the sequences whose labels at level k are ``columns[k]`` (as far as
    ``lengths`` says), and the node, on its last level, of every sequence."""
    n_words = max(1, len(words))
    node = np.zeros(len(lengths), INT)
    levels = []
    for k, labels in enumerate(columns):
        rows = np.flatnonzero(lengths > k)
        key, place = _grouped(node[rows] * n_words + labels[rows] if k else labels[rows])
        node[rows] = place
        last = lengths[rows] == k + 1
        levels.append(Level(key % n_words if k else key,
                            _combined(place[last], weight[rows[last]], len(key), how),
                            key // n_words if k else np.zeros(len(key), INT)))
    return Trie(heads, words, levels), node


def union(tries: list[Trie], how=np.add) -> Trie:
    """All sequences of the tries, weights of equal ones added (or their maximum)."""
    heads, head_rank = sorted_symbols(pa.concat_arrays([t.heads for t in tries]))
    words, word_rank = sorted_symbols(pa.concat_arrays([t.words for t in tries]))
    n_words = max(1, len(words))
    head_at = np.cumsum([0, *(len(t.heads) for t in tries)])
    word_at = np.cumsum([0, *(len(t.words) for t in tries)])
    up = [np.zeros(1, INT)] * len(tries)
    levels = []
    for k in range(len(tries[0].levels)):
        rank, at = (word_rank, word_at) if k else (head_rank, head_at)
        keys = [up[i][t.levels[k].parent] * n_words * bool(k) + rank[at[i] + t.levels[k].label]
                for i, t in enumerate(tries)]
        key, place = _grouped(np.concatenate(keys))
        weight = np.concatenate([t.levels[k].weight for t in tries])
        levels.append(Level(key % n_words if k else key,
                            _combined(place, weight, len(key), how),
                            key // n_words if k else np.zeros(len(key), INT)))
        up = np.split(place, np.cumsum([len(x) for x in keys])[:-1])
    return Trie(heads, words, levels)


def pruned(trie: Trie, least: int) -> Trie:
    """The sequences with at least this weight, and the prefixes that lead to them."""
    keep = [x.weight >= least for x in trie.levels]
    for k in range(len(keep) - 1, 0, -1):
        keep[k - 1][trie.levels[k].parent[keep[k]]] = True
    levels = []
    for k, x in enumerate(trie.levels):
        place = np.cumsum(keep[k - 1]) - 1 if k else np.zeros(1, INT)
        weight = np.where(x.weight >= least, x.weight, 0)[keep[k]]
        levels.append(Level(x.label[keep[k]], weight, place[x.parent[keep[k]]]))
    return _own_symbols(trie.heads, trie.words, levels)


def _own_symbols(heads: pa.Array, words: pa.Array, levels: list[Level]) -> Trie:
    """Trie with only the symbols that its levels use."""
    used, place = _grouped(levels[0].label)
    used_words, at = _grouped(np.concatenate([np.zeros(0, INT), *(x.label for x in levels[1:])]))
    labels = [place, *np.split(at, np.cumsum([len(x.label) for x in levels[1:]])[:-1])]
    return Trie(heads.take(pa.array(used)), words.take(pa.array(used_words)),
                [Level(label, x.weight, x.parent)
                 for label, x in zip(labels, levels, strict=True)])


# --- ranges ----------------------------------------------------------------------

def _cuts(trie: Trie, bounds: list[tuple[bytes, ...]]) -> list[np.ndarray]:
    """Per level, the number of nodes that come before each bound (a bound is a sequence;
    prefixes come before what they lead to)."""
    heads, words = trie.heads.to_pylist(), trie.words.to_pylist()
    depth = len(trie.levels)
    kids = [trie.levels[k].children(len(trie.levels[k - 1].label)) for k in range(1, depth)]
    out = np.zeros((depth, len(bounds)), INT)
    for j, bound in enumerate(bounds):
        lo, hi, exact = 0, len(trie.levels[0].label), True
        for k in range(depth):
            at = lo
            if exact and k < len(bound):
                symbols = words if k else heads
                rank = bisect_left(symbols, bound[k])
                at = lo + int(np.searchsorted(trie.levels[k].label[lo:hi], rank))
                exact = (at < hi and rank < len(symbols) and symbols[rank] == bound[k]
                         and trie.levels[k].label[at] == rank)
                out[k, j] = at + (exact and len(bound) > k + 1)
            else:
                exact, out[k, j] = False, at
            if k + 1 < depth:
                lo = int(kids[k][at])
                hi = int(kids[k][at + 1]) if exact else lo
    return list(out)


def split(trie: Trie, bounds: list[tuple[bytes, ...]]):
    """Yield ``(range, trie)`` of the ranges between the sorted bounds that have sequences;
    prefixes from other ranges come along with weight 0."""
    if not trie.size:
        return
    depth = len(trie.levels)
    cuts = [np.r_[0, c, len(x.label)] for c, x in zip(_cuts(trie, bounds), trie.levels,
                                                      strict=True)]
    for r in np.flatnonzero(sum(np.diff(c) for c in cuts)).tolist():
        own = [(int(c[r]), int(c[r + 1])) for c in cuts]
        slices: list[tuple[int, int]] = [(0, 0)] * depth
        first, last = own[-1]
        slices[-1] = (first, last)
        for k in range(depth - 1, 0, -1):
            lo, hi = own[k - 1]
            if last > first:
                up = int(trie.levels[k].parent[first]), int(trie.levels[k].parent[last - 1]) + 1
                lo, hi = (min(lo, up[0]), max(hi, up[1])) if hi > lo else up
            first, last = slices[k - 1] = lo, hi
        levels = []
        for k, ((lo, hi), (a, b)) in enumerate(zip(slices, own, strict=True)):
            x = trie.levels[k]
            at = np.arange(lo, hi)
            levels.append(Level(x.label[lo:hi], np.where((at >= a) & (at < b), x.weight[lo:hi], 0),
                                x.parent[lo:hi] - (slices[k - 1][0] if k else 0)))
        yield r, _own_symbols(trie.heads, trie.words, levels)


# --- automata ----------------------------------------------------------------------

@dataclass
class Automaton:
    """Level k has states ``bounds[k]``; the transitions of a state are ``label``, ``weight``
    and ``target`` (a state of level k + 1) between its bounds.  Level 0 has one state."""

    heads: pa.Array
    words: pa.Array
    bounds: list[np.ndarray]
    label: list[np.ndarray]
    weight: list[np.ndarray]
    target: list[np.ndarray]

    @classmethod
    def build(cls, trie: Trie) -> Automaton:
        depth = len(trie.levels)
        made: list[tuple] = [()] * depth
        target = np.zeros(len(trie.levels[-1].label), INT)
        for k in range(depth - 1, 0, -1):
            x = trie.levels[k]
            kids = x.children(len(trie.levels[k - 1].label))
            state, chosen = _register(kids, x.label, x.weight, target)
            sizes = np.diff(kids)[chosen]
            at = spread(kids[chosen], sizes)
            made[k] = (np.r_[0, np.cumsum(sizes)], x.label[at], x.weight[at], target[at])
            target = state
        root = trie.levels[0]
        made[0] = (np.array([0, len(root.label)]), root.label, root.weight, target)
        return cls(trie.heads, trie.words, *(list(c) for c in zip(*made, strict=True)))

    def expand(self) -> Trie:
        levels, state, parent = [], np.zeros(1, INT), np.zeros(1, INT)
        for bounds, label, weight, target in zip(self.bounds, self.label, self.weight,
                                                 self.target, strict=True):
            sizes = bounds[state + 1] - bounds[state]
            at = spread(bounds[state], sizes)
            parent = np.repeat(np.arange(len(state)), sizes)
            levels.append(Level(label[at], weight[at], parent))
            state = target[at]
        return Trie(self.heads, self.words, levels)

    def dump(self) -> bytes:
        texts = [(b"".join(s.to_pylist()), np.array([len(v) for v in s.to_pylist()], INT))
                 for s in (self.heads, self.words)]
        arrays = [lengths for _, lengths in texts]
        for k in range(len(self.bounds)):
            arrays += [np.diff(self.bounds[k]), self.label[k], self.weight[k], self.target[k]]
        small = [a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays]
        head = struct.pack("<2q", len(texts[0][0]), len(self.bounds)) + b"".join(
            struct.pack("<qB", len(a), a.itemsize) for a in small)
        body = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()
                        for a in small)
        return zstandard.ZstdCompressor(level=1).compress(
            head + body + texts[0][0] + texts[1][0])

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n_heads, depth = struct.unpack_from("<2q", raw)
        at, sizes, arrays = 16, [], []
        for _ in range(2 + 4 * depth):
            sizes.append(struct.unpack_from("<qB", raw, at))
            at += 9
        for n, width in sizes:
            planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
            arrays.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n).astype(INT))
            at += n * width

        def symbols(lengths: np.ndarray, start: int) -> pa.Array:
            offsets = np.r_[0, np.cumsum(lengths)].astype(INT)
            return pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lengths),
                [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[start:])])

        rest = arrays[2:]
        return cls(symbols(arrays[0], at), symbols(arrays[1], at + n_heads),
                   [np.r_[0, np.cumsum(a)] for a in rest[0::4]], *(rest[i::4] for i in (1, 2, 3)))


def _register(kids: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """State of each node, equal lists of transitions sharing one, and the node that each
    state was taken from.  Hashes find the candidates, the lists themselves decide."""
    mixed = tk.mix(label.astype(tk.U64) + tk.mix(weight.astype(tk.U64)
                                                 + tk.mix(target.astype(tk.U64) + tk.U64(1))))
    digest = tk.hash_sequences(mixed, kids[:-1], kids[1:])
    _, chosen, state = np.unique(digest, return_index=True, return_inverse=True)
    sizes = np.diff(kids)
    model = chosen[state]
    same = sizes[model] == sizes
    at = np.where(same, kids[model], kids[:-1])
    mine = spread(at, sizes)
    equal = np.ones(len(label), bool)
    for values in (label, weight, target):
        equal &= values[mine] == values
    wrong = np.r_[0, np.cumsum(~equal)]
    same &= wrong[kids[1:]] == wrong[kids[:-1]]
    alone = np.flatnonzero(~same)    # one hash, different lists: states of their own
    state[alone] = len(chosen) + np.arange(len(alone))
    return state, np.r_[chosen, alone]


def _find(labels: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted label in its sorted slice, or -1."""
    lo, end = lo.copy(), hi
    hi = hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        less = open_ & (labels[np.minimum(mid, len(labels) - 1)] < wanted)
        lo = np.where(less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    at = np.minimum(lo, max(0, len(labels) - 1))
    hit = lo < end
    if len(labels):
        hit &= labels[at] == wanted
    return np.where(hit, lo, -1)


def compose(asked: Automaton, counts: Automaton) -> Trie:
    """The sequences of ``asked`` with the weights that ``counts`` gives them (0: none): both
    automata are walked together, a level at a time."""
    levels = []
    state_a, state_c = np.zeros(1, INT), np.zeros(1, INT)
    for k in range(len(asked.bounds)):
        theirs = pc.index_in(asked.words if k else asked.heads,
                             value_set=counts.words if k else counts.heads)
        theirs = pc.fill_null(theirs, -1).to_numpy().astype(INT)
        sizes = asked.bounds[k][state_a + 1] - asked.bounds[k][state_a]
        at = spread(asked.bounds[k][state_a], sizes)
        parent = np.repeat(np.arange(len(state_a)), sizes)
        label = asked.label[k][at]
        wanted = theirs[label] if len(theirs) else np.zeros(0, INT)
        open_ = (state_c[parent] >= 0) & (wanted >= 0)
        from_ = np.maximum(state_c[parent], 0)
        found = np.full(len(at), -1, INT)
        if open_.any():
            found[open_] = _find(counts.label[k], counts.bounds[k][from_[open_]],
                                 counts.bounds[k][from_[open_] + 1], wanted[open_])
        hit = found >= 0
        weight = np.zeros(len(at), INT)
        weight[hit] = counts.weight[k][found[hit]]
        state_a = asked.target[k][at]
        state_c = np.full(len(at), -1, INT)
        state_c[hit] = counts.target[k][found[hit]]
        levels.append(Level(label, weight, parent))
    return Trie(asked.heads, asked.words, levels)
