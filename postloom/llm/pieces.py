"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The pieces of a public model that match a text form a lattice; a path through it is a segmentation.
The model ranks its pieces, it gives them no probabilities: a piece of rank r gets the weight
(r + 2) ** -sharpness, as in Zipf's law, and a path the product of its weights. A character without a
piece is spelled in byte pieces, as the library does. No piece runs on from a letter into a space, so
the lattice falls into units, each a run of spaces and the characters up to the next space; equal
units are built once per batch, and backward sums give each piece its probability where it starts.

A perturbed A* search emits the k paths of the largest Gumbel-perturbed log-probabilities, which is
sampling k distinct segmentations without replacement. The root has the whole mass and a Gumbel
value. Popping a node, a prefix and the pieces that must not follow, draws one path from its mass; the
path takes the node's value. What the node leaves unexplored becomes new nodes: at each piece of the
path, the siblings of that piece, with a Gumbel value of their mass cut off at the parent's value. A
heap pops the node of the largest value next. The value left on top at the end is the threshold that
gives the inclusion probabilities. Noise is not drawn for places over 27 below the best place of a path:
the generator cannot reach that far.

Noise is a function of the row's key, the draw and the place, so a rerun gives the same samples.
Null texts have no samples, empty texts one without pieces; texts with fewer than k segmentations
give them all. Rows that repeat a key and text repeat its samples. Further columns do not matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from copy import copy
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import count, islice

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import mix64

DEFAULT_MODEL = public_tokenizers.path("piece_bpe_32k.model")
SAMPLES = 2
SHARPNESS = 1.0
# Bytes of text whose lattices are built together: a worker's memory grows with them, samples do not depend on them.
CHUNK_BYTES = 125_000
SPACE = "▁"
_BITS = 30  # probabilities are drawn in steps of 2 ** -_BITS
_REACH = 27.0  # more than the largest Gumbel value of 32 random bits lies above the smallest
_LOOK = 128  # pieces of a path that are searched for places in reach at first
# Each Python worker keeps the lattices of units that two or more of its first chunks have.
WARM_UP_CHUNKS = 8
KEPT_UNITS = 60_000
_UNITS = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """The pieces of a model file as a trie of characters, with weights."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = {}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.bytes_of: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = i
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self.byte_count = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.byte_start = np.cumsum(self.byte_count) - self.byte_count
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece runs on over a space")
        self.weight = np.array([-sharpness * np.log(2 - model.get_score(i)) for i in range(size)])
        self.byte_weight = -sharpness * np.log(2 + size)
        self.longest = max(map(len, pieces))
        alphabet = sorted(set("".join(pieces)))
        self.letter = np.zeros(0x110000, dtype=np.int32)
        for i, c in enumerate(alphabet, 1):
            self.letter[ord(c)] = i
        self.letters = len(alphabet) + 1
        # Trie nodes are numbered by first appearance; an edge is keyed by node and letter.
        children: dict[int, int] = {}
        piece_at = [-1]
        for piece, i in pieces.items():
            node = 0
            for c in piece:
                key = node * self.letters + int(self.letter[ord(c)])
                if key not in children:
                    children[key] = len(piece_at)
                    piece_at.append(-1)
                node = children[key]
            piece_at[node] = i
        self.piece_at = np.array(piece_at, dtype=np.int32)
        self._slots = np.full(1 << 20, -1, dtype=np.int64)
        self._child = np.zeros(1 << 20, dtype=np.int32)
        keys = np.fromiter(children, dtype=np.int64)
        nodes = np.fromiter(children.values(), dtype=np.int32)
        self.roots = np.zeros(self.letters, dtype=np.int32)  # the children of the root, by letter
        self.roots[keys[keys < self.letters]] = nodes[keys < self.letters]
        for key, node, slot in zip(keys.tolist(), nodes.tolist(), self._slot(keys).tolist()):
            while self._slots[slot] >= 0:
                slot = (slot + 1) & 0xFFFFF
            self._slots[slot], self._child[slot] = key, node

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _ODD) >> np.uint64(44)).astype(np.int64)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The child of each node by its letter; 0 where there is none."""
        keys = nodes.astype(np.int64) * self.letters + letters
        slots = self._slot(keys)
        held = self._slots[slots]
        out = np.where(held == keys, self._child[slots], 0)
        open_rows = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_rows):
            slots[open_rows] = (slots[open_rows] + 1) & 0xFFFFF
            held = self._slots[slots[open_rows]]
            hit = held == keys[open_rows]
            out[open_rows[hit]] = self._child[slots[open_rows[hit]]]
            open_rows = open_rows[~hit & (held >= 0)]
        return out

    def decode_many(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of several segmentations, with the space before the text."""
        flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
        sizes = self.byte_count[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # Byte j of a piece stands j places after the piece's first byte in `blob`.
        joined = self.blob[np.arange(total) + np.repeat(self.byte_start[flat] - (ends - sizes), sizes)].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, ids)])].tolist()
        return [joined[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids) -> str:
        """The text of a segmentation; the space put before every text is taken off again."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


# What a Python worker keeps, by model file and sharpness.
_vocabularies: dict[tuple[str, float], Vocabulary] = {}
_common: dict[tuple[str, float], Common] = {}


def vocabulary(path: str, sharpness: float) -> Vocabulary:
    if (path, sharpness) not in _vocabularies:
        _vocabularies[path, sharpness] = Vocabulary(path, sharpness)
    return _vocabularies[path, sharpness]


class Lattice:
    """The lattices of distinct units. A place is a character, or the end, of a unit; an edge is a piece
    from one place to another. Edges are sorted by the place they start at."""

    def __init__(self, vocab: Vocabulary, units: list[str]):
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        # Each unit has one place more than characters: its end.
        self.start = np.cumsum(lengths + 1) - lengths - 1
        self.end = self.start + lengths
        self.places = places = int(lengths.sum() + len(units))
        char_place = (np.arange(len(codes)) + np.repeat(np.arange(len(units)), lengths)).astype(np.int32)
        letter = np.zeros(places + 1, dtype=np.int32)
        letter[char_place] = vocab.letter[codes]
        self.code = np.zeros(places + 1, dtype=np.uint32)
        self.code[char_place] = codes
        to_end = (np.repeat(lengths + self.start, lengths + 1) - np.arange(places)).astype(np.int32)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []  # starts, length, pieces
        at, node = char_place, np.zeros(len(char_place), dtype=np.int32)
        spelled = char_place
        # The letter of an end is 0, which no trie edge has, so walks stop within their unit.
        for length in range(1, vocab.longest + 1):
            node = vocab.step(node, letter[at + length - 1]) if length > 1 else vocab.roots[letter[at]]
            alive = np.flatnonzero(node)
            at, node = at[alive], node[alive]
            if not len(at):
                break
            piece = vocab.piece_at[node]
            whole = np.flatnonzero(piece >= 0)
            found.append((at[whole], length, piece[whole]))
            if length == 1:
                single = np.zeros(places, dtype=bool)
                single[at[whole]] = True
                spelled = char_place[~single[char_place]]
            alive = np.flatnonzero(to_end[at] > length)
            at, node = at[alive], node[alive]
        found.insert(0, (spelled, 1, np.full(len(spelled), -1, dtype=np.int32)))
        # Edges of a place stand together, the longest first: it is the likeliest, so draws end soon.
        counts = np.zeros(places + 2, dtype=np.int64)
        for starts, _, _ in found:
            counts[starts + 1] += 1
        self.first = np.cumsum(counts)  # of the edges of a place
        size = int(self.first[-1])
        self.a, self.b = np.empty(size, dtype=np.int32), np.empty(size, dtype=np.int32)
        self.piece = np.empty(size, dtype=np.int32)
        free = self.first[:-1].copy()
        for starts, length, pieces in reversed(found):
            where = free[starts]
            self.a[where], self.b[where], self.piece[where] = starts, starts + length, pieces
            free[starts] += 1
        weight = vocab.weight[self.piece]
        by_bytes = np.flatnonzero(self.piece < 0)
        code = self.code[self.a[by_bytes]]
        weight[by_bytes] = vocab.byte_weight * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        # Characters of one byte are one byte piece; only longer ones keep -1 and are spelled in `ids`.
        self.piece[by_bytes] = np.where(code < 0x80, vocab.byte_ids[code & 0x7F], -1)
        # Backward sums: places in order of their distance to the end of their unit.
        mass = np.zeros(places + 1)
        distance = to_end[self.a]
        small = distance.max(initial=0) < 1 << 15
        by_distance = np.argsort(distance.astype(np.int16) if small else distance, kind="stable")
        bounds = np.cumsum(np.bincount(distance)) if len(distance) else np.zeros(1, dtype=np.int64)
        for begin, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if begin < stop:
                edges = by_distance[begin:stop]
                starts = self.a[edges]
                heads = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1]]))
                mass[starts[heads]] = np.logaddexp.reduceat(weight[edges] + mass[self.b[edges]], heads)
        self.log_p = np.minimum(weight + mass[self.b] - mass[self.a], 0.0)
        p = np.exp(self.log_p)
        # `cut` has the running sums per place in steps of 2 ** -_BITS, the last one whole, and `rest` the
        # mass of an edge's siblings. Sums run place by place, and do not depend on the rest of the batch.
        self.cut, self.rest = np.empty(size, dtype=np.int32), np.empty(size)
        counts = np.diff(self.first)
        by_count = np.argsort(-counts.astype(np.int16), kind="stable")
        heads, counts = self.first[by_count], counts[by_count]
        # How many places have more than j edges, for each j: they come first.
        longer = [int(n) for n in np.searchsorted(-counts, -np.arange(1, counts.max(initial=0) + 1), side="right")]
        total = np.zeros(len(heads))
        for j, n in enumerate(longer):
            edges = heads[:n] + j
            self.rest[edges] = total[:n]
            total[:n] += p[edges]
            self.cut[edges] = np.rint(np.minimum(total[:n], 1.0) * (1 << _BITS))
        self.cut[(heads + counts - 1)[: longer[0] if longer else 0]] = 1 << _BITS
        total[:] = 0
        for j, n in reversed(list(enumerate(longer))):
            edges = heads[:n] + j
            self.rest[edges] += total[:n]
            total[:n] += p[edges]

    def and_more(self, other: Lattice) -> Lattice:
        """The units of both, the other's after these."""
        both = copy(self)
        both.places = self.places + other.places
        edges = len(self.a)
        for name, shift in (("start", self.places), ("end", self.places), ("a", self.places), ("b", self.places), ("piece", 0), ("log_p", 0), ("rest", 0), ("cut", 0)):
            new = getattr(other, name)
            setattr(both, name, np.concatenate([getattr(self, name), new + new.dtype.type(shift) if shift else new]))
        both.first = np.concatenate([self.first[: self.places], other.first + edges])
        both.code = np.concatenate([self.code[: self.places], other.code])
        return both

    def draw(self, places: np.ndarray, noise: np.ndarray) -> np.ndarray:
        """An edge of each place by its probability."""
        target = (noise >> np.uint64(64 - _BITS)).astype(np.int32)
        edge = self.first[places]
        rows = np.flatnonzero(target >= self.cut[edge])
        while len(rows):
            edge[rows] += 1
            rows = rows[target[rows] >= self.cut[edge[rows]]]
        return edge


class Common:
    """The units that a worker meets again and again, with their lattices."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.number, self.lattice = vocab, {}, None
        self._chunks, self._seen = 0, Counter()

    def meet(self, units: Iterable[str]) -> None:
        """Learn from the units of a chunk, while there is something to learn."""
        if self.lattice is None:
            self._seen.update(units)
            self._chunks += 1
            if self._chunks == WARM_UP_CHUNKS:
                kept = [unit for unit, times in self._seen.most_common(KEPT_UNITS) if times > 1]
                self.number = {unit: i for i, unit in enumerate(kept)}
                self.lattice = Lattice(self.vocab, [SPACE + unit for unit in kept]) if kept else None
                self._seen.clear()


@dataclass
class Path:
    """A sampled segmentation: its edges, their units' numbers in the text, and its value."""

    edges: np.ndarray
    unit: np.ndarray
    value: float


def _gumbel(noise: np.ndarray) -> np.ndarray:
    chance = ((noise >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32
    return -np.log(-np.log(chance))


class Sampler:
    """Samples for the texts of one chunk, all together step by step."""

    def __init__(self, vocab: Vocabulary, texts: list[str], keys: np.ndarray, k: int, common: Common | None = None):
        self.vocab, self.k = vocab, k
        # Units by number; a unit without its space in front is known by the rest.
        known = common.number if common else {}
        number: dict[str, int] = defaultdict(count(len(known)).__next__, known)
        units, self.size = [], []
        for text in texts:
            cut = text.split(" ") if text else []
            if "" in cut or SPACE in text:
                cut = [unit.removeprefix(SPACE) for unit in _UNITS.findall(SPACE + text.replace(" ", SPACE))]
            units.append(np.fromiter(map(number.__getitem__, cut), dtype=np.int64, count=len(cut)))
            self.size.append(len(cut))
        self.units = np.concatenate(units)
        self.first_unit = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        # A seed for each text, draw and kind of noise.
        kinds = np.arange(4 * k, dtype=np.uint64).reshape(1, k, 4) * _ODD
        self.noise = mix64(mix64(keys.astype(np.int64).view(np.uint64))[:, None, None] + kinds)
        self.lattice = common.lattice if common else None
        new = list(islice(number, len(known), None))
        if new:
            own = Lattice(vocab, [SPACE + unit for unit in new])
            self.lattice = self.lattice.and_more(own) if self.lattice else own
        if common:
            common.meet(new)


    def _extend(self, texts: list[int], draw: int, begin: list[int], place: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the edges, and their units, of a path drawn from a unit on; `place` is where in that
        unit it goes on, or -1 at its start."""
        lattice = self.lattice
        counts = np.array([self.size[t] - b for t, b in zip(texts, begin)], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        local = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)  # number of a unit from `begin` on
        unit = local + np.repeat(np.array(begin, dtype=np.int64), counts)
        whole = self.units[unit + np.repeat(self.first_unit[texts], counts)]
        at, ends = lattice.start[whole], lattice.end[whole]
        for i, p in enumerate(place):
            if p >= 0:
                at[offsets[i]] = p
        seeds = self.noise[texts, draw, 1]
        seeds = mix64(np.repeat(seeds, counts) + unit.astype(np.uint64) * _ODD)
        rows = np.flatnonzero(at < ends)
        taken, steps = [], []
        step = 0
        length = np.zeros(len(at), dtype=np.int64)
        at, ends, seeds = at[rows], ends[rows], seeds[rows]
        while len(rows):
            edge = lattice.draw(at, mix64(seeds + np.uint64(step)))
            taken.append(edge)
            steps.append(rows)
            length[rows] += 1
            at = lattice.b[edge]
            on = at < ends
            rows, at, ends, seeds = rows[on], at[on], ends[on], seeds[on]
            step += 1
        where = np.cumsum(length) - length
        edges = np.empty(int(length.sum()), dtype=np.int64)
        for step, (edge, rows) in enumerate(zip(taken, steps)):
            edges[where[rows] + step] = edge
        of = np.repeat(unit, length)
        bounds = np.concatenate([where, [len(edges)]])[offsets]
        return [(edges[s:e], of[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]

    def _leave(self, texts: list[int], draw: int, paths: list[Path], heaps: list[list], fixed: list[int], excluded: list[tuple[int, ...]]) -> None:
        """Nodes for what new paths leave: siblings at a path's pieces from `fixed` on; at the first of
        them the pieces in `excluded` are out as well."""
        lattice, rows, look = self.lattice, list(range(len(texts))), _LOOK
        before = np.array([lattice.log_p[p.edges[:f]].sum() for p, f in zip(paths, fixed)])
        first_rest = {
            r: self._siblings(int(lattice.a[paths[r].edges[fixed[r]]]), (*excluded[r], int(paths[r].edges[fixed[r]])))[1].sum()
            for r in rows if excluded[r]
        }
        while rows:
            # The next pieces of all paths side by side; an edge that is not there leaves nothing.
            edges = np.full((len(rows), look), -1, dtype=np.int64)
            for i, r in enumerate(rows):
                part = paths[r].edges[fixed[r] : fixed[r] + look]
                edges[i, : len(part)] = part
            there = edges >= 0
            log_p = np.where(there, lattice.log_p[edges], 0.0)
            rest = np.where(there, lattice.rest[edges], 0.0)
            for i, r in enumerate(rows):
                if r in first_rest:
                    rest[i, 0] = first_rest[r]
            phi = before[rows][:, None] + np.cumsum(log_p, axis=1)  # after each piece
            with np.errstate(divide="ignore"):
                mass = phi - log_p + np.log(rest)
            best = mass.max(axis=1)
            # Later siblings have less mass than the path has left here.
            done = ~there[:, -1] | (phi[:, -1] < best - _REACH)
            at_row, at = np.nonzero((mass >= (best - _REACH)[:, None]) & (mass > -np.inf) & done[:, None])
            owner = np.array(rows, dtype=np.int64)[at_row]
            seeds = self.noise[np.array(texts, dtype=np.int64)[owner], draw, 2]
            noise = _gumbel(mix64(seeds + at.astype(np.uint64)))
            limit = np.array([p.value for p in paths])[owner]
            values = -np.logaddexp(-limit, -(mass[at_row, at] + noise))
            order = np.lexsort((-values, at_row))
            place = np.arange(len(order)) - np.searchsorted(at_row[order], at_row[order])
            # More than k nodes of one path can never be popped.
            for i in order[place < self.k].tolist():
                r, piece = int(owner[i]), int(at[i])
                out = (*(excluded[r] if piece == 0 else ()), int(edges[at_row[i], piece]))
                heappush(heaps[texts[r]], (-float(values[i]), draw, fixed[r] + piece, out))
            rows = [r for r, d in zip(rows, done) if not d]
            look *= 4

    def run(self) -> list[list[tuple[Path, float]]]:
        """Per text its samples, best first, with the threshold of its search."""
        n = len(self.size)
        if self.lattice is None:
            return [[(Path(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), 0.0), -np.inf)] for _ in range(n)]
        found: list[list[Path]] = [[] for _ in range(n)]
        heaps: list[list] = [[] for _ in range(n)]
        texts = list(range(n))
        roots = _gumbel(self.noise[:, 0, 0]).tolist()
        for t, (edges, unit) in enumerate(self._extend(texts, 0, [0] * n, [-1] * n)):
            found[t].append(Path(edges, unit, roots[t]))
        self._leave(texts, 0, [f[0] for f in found], heaps, [0] * n, [()] * n)
        for draw in range(1, self.k):
            texts = [t for t in range(n) if heaps[t]]
            picks, begin, place = [], [], []
            for t in texts:
                value, number, at, excluded = heappop(heaps[t])
                parent = found[t][number]
                start = int(self.lattice.a[parent.edges[at]])
                edge = self._sibling(start, excluded, self.noise[t, draw, 3])
                picks.append((-value, number, at, excluded, edge))
                begin.append(int(parent.unit[at]))
                place.append(int(self.lattice.b[edge]))
            for t, (value, number, at, excluded, edge), (edges, unit) in zip(texts, picks, self._extend(texts, draw, begin, place) if texts else []):
                parent = found[t][number]
                units = np.concatenate([parent.unit[:at], [parent.unit[at]], unit])
                found[t].append(Path(np.concatenate([parent.edges[:at], [edge], edges]), units, value))
            new = [found[t][-1] for t in texts]
            self._leave(texts, draw, new, heaps, [p[2] for p in picks], [p[3] for p in picks])
        return [[(path, -heap[0][0] if heap else -np.inf) for path in paths] for paths, heap in zip(found, heaps)]

    def _siblings(self, place: int, excluded: tuple[int, ...]) -> tuple[list[int], np.ndarray]:
        """The edges of a place without the excluded ones, and their probabilities."""
        edges = [e for e in range(int(self.lattice.first[place]), int(self.lattice.first[place + 1])) if e not in excluded]
        return edges, np.exp(self.lattice.log_p[edges])

    def _sibling(self, place: int, excluded: tuple[int, ...], noise: np.uint64) -> int:
        """An edge of a place by its probability, none of the excluded ones."""
        edges, p = self._siblings(place, excluded)
        total = np.cumsum(p)
        target = (int(noise) >> 11) * 2.0**-53 * total[-1]
        return edges[min(int(np.searchsorted(total, target, side="right")), len(edges) - 1)]

    def ids(self, path: Path) -> np.ndarray:
        """Piece ids, with spelled characters as byte pieces."""
        pieces = self.lattice.piece[path.edges] if self.lattice else np.empty(0, dtype=np.int32)
        if len(pieces) and pieces.min() < 0:
            parts, at = [], 0
            for i in np.flatnonzero(pieces < 0).tolist():
                char = chr(self.lattice.code[self.lattice.a[path.edges[i]]]).encode("utf-8", "surrogatepass")
                parts += [pieces[at:i], self.vocab.byte_ids[list(char)]]
                at = i + 1
            pieces = np.concatenate([*parts, pieces[at:]])
        return pieces


def log_inclusion(log_prob: float, threshold: float) -> float:
    """Log of 1 - exp(-exp(log_prob - threshold)), the chance that a path beats the threshold."""
    gap = log_prob - threshold
    if gap > 30:
        return 0.0
    return float(gap if gap < -30 else np.log(-np.expm1(-np.exp(gap))))



def sample_texts(
    vocab: Vocabulary, texts: list[str], keys: np.ndarray, k: int, common: Common | None = None
) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(number of the text, sample, ids, log-probability, perturbed value, log inclusion probability)."""
    sampler = Sampler(vocab, texts, keys, k, common)
    for t, samples in enumerate(sampler.run()):
        for number, (path, threshold) in enumerate(samples, 1):
            log_prob = float(sampler.lattice.log_p[path.edges].sum()) if len(path.edges) else 0.0
            yield t, number, sampler.ids(path), log_prob, path.value, log_inclusion(log_prob, threshold)


def decode(path: str = DEFAULT_MODEL) -> Callable[[Column], Column]:
    """A function from piece ids to text; null for null."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        vocab = vocabulary(path, SHARPNESS)
        return ids.map(lambda pieces: None if pieces is None else vocab.decode(list(pieces)))

    return run


_ENCODED = "doc_id long, sample int, ids array<int>, log_prob double, value double, log_inclusion double, round_trip boolean"


def _encoder(k: int, path: str, sharpness: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = _common.setdefault((path, sharpness), Common(vocabulary(path, sharpness)))
        for batch in batches:
            batch = batch.filter(batch.column("text").is_valid())
            keys = batch.column("doc_id")
            seeds = keys.fill_null(0).to_numpy(zero_copy_only=False)
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            begin = 0
            while begin < batch.num_rows:
                # As many texts as make a chunk, at least one.
                end, size = begin, 0
                while end < batch.num_rows and (end == begin or size + sizes[end] <= CHUNK_BYTES):
                    size += sizes[end]
                    end += 1
                part = batch.slice(begin, end - begin)
                yield _encoded(common, part.column("doc_id"), part.column("text").to_pylist(), seeds[begin:end], k)
                begin = end

    return run


def _encoded(common: Common, keys: pa.Array, texts: list[str], seeds: np.ndarray, k: int) -> pa.RecordBatch:
    of, numbers, ids, log_probs, values, inclusions = [], [], [], [], [], []
    for t, number, pieces, log_prob, value, inclusion in sample_texts(common.vocab, texts, seeds, k, common):
        of.append(t)
        numbers.append(number)
        ids.append(pieces)
        log_probs.append(log_prob)
        values.append(value)
        inclusions.append(inclusion)
    given = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
    same = [decoded == given[t] for decoded, t in zip(common.vocab.decode_many(ids), of)]
    flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.empty(0, dtype=np.int32))
    ends = np.concatenate([[0], np.cumsum([len(p) for p in ids])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            keys.take(pa.array(of, pa.int64())), pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), flat),
            pa.array(log_probs, pa.float64()), pa.array(values, pa.float64()), pa.array(inclusions, pa.float64()), pa.array(same, pa.bool_()),
        ],
        names=["doc_id", "sample", "ids", "log_prob", "value", "log_inclusion", "round_trip"],
    )


def encode(
    docs: DataFrame, k: int = SAMPLES, path: str = DEFAULT_MODEL, text: str = "text", key: str = "doc_id", sharpness: float = SHARPNESS
) -> DataFrame:
    """doc_id, sample (from 1), ids, log_prob, value, log_inclusion and round_trip: whether decoding the ids
    gives the text again."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_encoder(k, path, sharpness), _ENCODED)
