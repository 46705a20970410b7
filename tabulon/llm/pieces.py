"""Piece lattices over a fixed public SentencePiece vocabulary.

Texts are split into units that no piece crosses: runs of word marks with what follows them, and line ends. Long units
and those with characters outside the vocabulary are cut further, wherever no piece reaches across, so that their
segmentations are those of their parts, one after another; a character outside the vocabulary is a part of its own and
falls back to byte pieces. All work on lattices is done once for each distinct part. Parts of equal length are handled
together, span by span, in numpy; what is still long then, such as a run of one character, goes one by one.
"""

from __future__ import annotations

import heapq
import re
from array import array
from itertools import count

import numpy as np

#: The mark that stands for a space, and a stand-in for that mark where a text itself has it.
MARK, LITERAL = "▁", "\udc81"
#: Units of more characters than this are cut, and parts of more go one by one.
TOGETHER = 48
#: Bytes of a long unit that are looked at together, and the grain of weights in sums that have to tie exactly.
WINDOW, GRAIN = 1 << 18, 1 << 32
UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, rank, byte) of each id of a SentencePiece model: byte is its value for byte pieces, else -1.

    Control and unknown pieces are empty and never used. The rank is the model's merge order.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            out.append(("", float(model.get_piece_size()), int(piece[1:-1], 16)))
        elif model.is_control(k) or model.is_unknown(k):
            out.append(("", float(model.get_piece_size()), -1))
        else:
            out.append((piece, -model.get_score(k), -1))
    if any(MARK in p.lstrip(MARK) or "\n" in p for p, _, _ in out):
        raise ValueError("pieces cross words in this vocabulary")
    if sum(b >= 0 for _, _, b in out) != 256:
        raise ValueError("this vocabulary has no byte pieces")
    return out


def marked(text: str) -> str:
    """A text with its spaces as marks and one more in front; empty stays empty."""
    if not text:
        return ""
    return MARK + text.replace(MARK, LITERAL).replace(" ", MARK)


class Vocabulary:
    """Look-up of pieces by a trie of their bytes."""

    def __init__(self, model: list[tuple[str, float, int]]):
        self.size = len(model)
        self.known = {p for p, _, _ in model if len(p) == 1}
        #: A piece with a character that is none itself could stand beside no other; it is left out.
        self.ids = {p: k for k, (p, _, _) in enumerate(model) if p and self.known.issuperset(p)}
        self.blank = next(c for c in map(chr, range(32)) if c not in self.known)
        self.byte_ids = np.full(256, -1, np.int64)
        for k, (_, _, b) in enumerate(model):
            if b >= 0:
                self.byte_ids[b] = k
        self.text = [p.replace(MARK, " ").encode() if b < 0 else bytes([b]) for p, _, b in model]
        #: Log weight by Zipf's law over the merge order.
        self.weight = -np.log1p(np.array([r for _, r, _ in model]))
        coded = [p.encode() for p in self.ids]
        self.longest = max(map(len, coded))
        self.longest_chars = max(map(len, self.ids))
        self._trie(coded)

    def _trie(self, coded: list[bytes]) -> None:
        """A state for each beginning of a piece, those that go on before those that don't; the last one is none at all.

        ``next`` has a row for each state that goes on and a column for each kind of byte; ``kind`` has a byte's.
        """
        child: dict[int, int] = {}
        ends: dict[int, int] = {}
        for code, k in zip(coded, self.ids.values()):
            at = 0
            for b in code:
                at = child.setdefault(at << 8 | b, len(child) + 1)
            ends[at] = k
        edges = np.array(list(child), np.int64)
        above, byte, size = edges >> 8, edges & 255, len(edges) + 1
        on = np.zeros(size, bool)
        on[0] = True
        on[above] = True
        number = np.empty(size, np.int64)
        self.inner = int(on.sum())
        number[on], number[~on] = np.arange(self.inner), np.arange(self.inner, size)
        used = np.unique(byte)
        self.kind = np.full(256, len(used), np.int32)
        self.kind[used] = np.arange(len(used))
        self.kinds = len(used) + 1
        self.next = np.full(self.inner * self.kinds, size, np.int32)
        self.next[number[above] * self.kinds + self.kind[byte]] = number[1:]
        self.piece = np.full(size + 1, -1, np.int32)
        self.piece[number[list(ends)]] = list(ends.values())

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The states that follow ``state``, all below ``inner``, by bytes of these kinds."""
        return self.next.take(state * self.kinds + kind)

    def simple(self, unit: str) -> bool:
        """Whether a unit's characters are all pieces, and it is short."""
        return len(unit) <= TOGETHER and self.known.issuperset(unit)

    def spans(self, units: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, ids) of all pieces in units of one length, by start, then end."""
        n, length = len(units), len(units[0])
        data = np.ascontiguousarray(np.frombuffer(b"".join(units), np.uint8).reshape(n, length).T)
        kinds, out = self.kind[data], []
        for i in range(length):
            rows = np.flatnonzero((data[i] < 128) | (data[i] >= 192))  # characters start here
            state = np.zeros(len(rows), np.int32)
            for j in range(i, length):
                if not len(rows):
                    break
                state = self.step(state, kinds[j] if len(rows) == n else kinds[j].take(rows))
                ids = self.piece.take(state)
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    out.append((i, j + 1, rows.take(hit), ids.take(hit)))
                on = np.flatnonzero(state < self.inner)
                if len(on) < len(rows):
                    rows, state = rows.take(on), state.take(on)
        return out

    def matches(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, id) of all pieces in UTF-8 ``data``, by end, then start. Made for long ones, window by window."""
        out = []
        for at in range(0, len(data), WINDOW):
            part = np.frombuffer(data[at : at + WINDOW + self.longest], np.uint8)
            kinds, n = self.kind[part], len(part)
            starts = np.flatnonzero((part[:WINDOW] < 128) | (part[:WINDOW] >= 192))
            state = np.zeros(len(starts), np.int32)
            for length in range(1, min(self.longest, n) + 1):
                on = np.flatnonzero((state < self.inner) & (starts + length <= n))
                if not len(on):
                    break
                starts = starts[on]
                state = self.step(state[on], kinds[starts + (length - 1)])
                ids = self.piece[state]
                hit = np.flatnonzero(ids >= 0)
                out.append((starts[hit] + at, starts[hit] + at + length, ids[hit]))
        start, end, ids = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((start, end))
        return start[order], end[order], ids[order]

    def parts(self, unit: str) -> list[str]:
        """A unit cut at every character that no piece reaches across; a short one of known characters stays whole."""
        if self.simple(unit) or len(unit) == 1:
            return [unit]
        plain = unit.replace(LITERAL, self.blank)
        data = plain.encode()
        start, end, _ = self.matches(data)
        steps = np.bincount(start + 1, minlength=len(data) + 2) - np.bincount(end, minlength=len(data) + 2)
        code = np.frombuffer(data, np.uint8)
        open_ = np.cumsum(steps)[: len(data)][(code < 128) | (code >= 192)] == 0
        cuts = [*np.flatnonzero(open_).tolist(), len(unit)]  # the first character is always open
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]

    def in_parts(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct parts, numbers of the parts of all units in a row, where each unit's begin)."""
        place: dict[str, int] = {}
        flat, begin = [], []
        for u in units:
            begin.append(len(flat))
            flat += [place.setdefault(x, len(place)) for x in self.parts(u)]
        return list(place), np.array(flat, np.int64), np.array(begin, np.int64)

    def lattice(self, part: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """(length in bytes, starts, ends, ids) of a part's pieces by end: byte pieces for a character that is none."""
        if len(part) == 1 and part not in self.known:
            data = (MARK if part == LITERAL else part).encode()
            at = np.arange(len(data))
            return len(data), at, at + 1, self.byte_ids[np.frombuffer(data, np.uint8)]
        if self.simple(part):
            edges = self.edges(part)
            return len(edges), *by_end(edges)
        data = part.encode()
        return len(data), *self.matches(data)

    def edges(self, unit: str) -> list[list[tuple[int, int]]]:
        """(end, id) of the pieces that start at each byte of a unit, byte pieces for characters that are none."""
        at, offsets = 0, []
        for c in unit:
            offsets.append(at)
            at += 3 if c == LITERAL else len(c.encode())
        offsets.append(at)
        out: list[list[tuple[int, int]]] = [[] for _ in range(at)]
        for i, c in enumerate(unit):
            if c not in self.known:
                for k, b in enumerate(MARK.encode() if c == LITERAL else c.encode()):
                    out[offsets[i] + k].append((offsets[i] + k + 1, int(self.byte_ids[b])))
                continue
            for j in range(i + 1, min(len(unit), i + self.longest_chars) + 1):
                found = self.ids.get(unit[i:j])
                if found is not None:
                    out[offsets[i]].append((offsets[j], found))
        return out


def by_end(edges: list[list[tuple[int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id) by end, then start, of the (end, id) of the pieces that start at each byte."""
    rows = sorted((j, i, k) for i, own in enumerate(edges) for j, k in own)
    end, start, piece = np.array(rows, np.int64).reshape(-1, 3).T
    return start, end, piece


def n_best(edges: list[list[tuple[int, int]]], weight: np.ndarray, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """``best_paths`` of a lattice given as the (end, id) of the pieces that start at each byte."""
    return best_paths(len(edges), *by_end(edges), weight, n)


def best_paths(size: int, start: np.ndarray, end: np.ndarray, piece: np.ndarray, weight: np.ndarray, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations (score, ids) of a lattice, best first; its pieces come by end.

    A forward Viterbi pass gives the best score up to every byte. The A-star search then runs backward from the end:
    a partial segmentation's priority is its own score and the forward score of where it starts, which is exactly
    what its best completion reaches, so segmentations come out in order and little else is looked at. Of equal
    priorities the one nearer to the start goes first. No place is left more than n times, as the n best pass through
    it by the n best ways to the end, so the work is bounded by n times the pieces, however many segmentations tie.
    Weights are whole numbers of 1 / ``GRAIN`` here: equal scores are equal whatever the order of their sums.
    """
    cost, none = np.rint(-weight[piece] * GRAIN).astype(np.int64), 1 << 62
    least = array("q", [none]) * (size + 1)
    least[0] = 0
    for at in range(0, len(end), WINDOW):
        part = slice(at, at + WINDOW)
        for i, j, c in zip(start[part].tolist(), end[part].tolist(), cost[part].tolist()):
            c += least[i]
            if c < least[j]:
                least[j] = c
    into = np.searchsorted(end, np.arange(size + 2))
    heap, left, turn, out = [(least[size], size, 0, 0, None)], bytearray(size + 1), count(1), []
    while heap and len(out) < n:
        _, at, _, own, rest = heapq.heappop(heap)
        if at == 0:
            ids = []
            while rest is not None:
                k, rest = rest
                ids.append(k)
            out.append((-own / GRAIN, tuple(ids)))
            continue
        if left[at] == n:
            continue
        left[at] += 1
        part = slice(into[at], into[at + 1])
        for i, k, c in zip(start[part].tolist(), piece[part].tolist(), cost[part].tolist()):
            if least[i] < none and left[i] < n:
                heapq.heappush(heap, (own + c + least[i], i, next(turn), own + c, (k, rest)))
    return out


def by_length(units: list[str]) -> list[tuple[list[int], list[bytes]]]:
    """(positions, bytes) of units, those of one length in bytes together."""
    groups: dict[int, tuple[list[int], list[bytes]]] = {}
    for n, u in enumerate(units):
        code = u.encode()
        own = groups.setdefault(len(code), ([], []))
        own[0].append(n)
        own[1].append(code)
    return list(groups.values())
