"""SentencePiece pieces: sampled segmentations without replacement, and decoding.

A text's segmentations into pieces form a lattice with a probability for each path.  The
``k`` segmentations are those with the largest Gumbel-perturbed log-probabilities, found by
a perturbed A-star search, top down: an agenda entry is a set of paths that share all
decisions before one place and differ from a found path there; its key is the largest
perturbed value in it, drawn from a Gumbel law truncated by that of the path it left.
Popping the best entry fixes a deviating piece there, and the rest of the path is drawn by
its probabilities; entries for its later places join the agenda.  No path comes twice.

Two things make this an array computation over many texts at once:

* no piece crosses the start of a run of blanks, or a line feed, so the lattice is a chain
  of short lattices, and equal stretches (*chunks*) of a batch are built once;
* with t = exp(-value), a truncated Gumbel is t + Exp(1) / mass, so all entries of a path
  are one vector.

The random numbers are hashes of row key, sample and place: they depend neither on batches
nor on tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.text_arrays import bytes_of, mixed, pieces, prefix_sums, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 8
IDS = 500_000  # ids decoded at once
PIECE = 600_000  # bytes of text whose lattices are held at once
BLANK, BREAK = 0x20, 0x0A
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a SentencePiece model with log-weights for sampling.

    A pair-merge model has ranks, not probabilities; the piece of rank r weighs
    -log(r + 2) (Zipf's law), a byte of an unknown character as the last rank.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.surface: list[bytes] = []
        self.byte_ids = np.zeros(256, dtype=np.int64)
        known: dict[bytes, tuple[int, float]] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                raw = piece.replace("▁", " ").encode()
                self.surface.append(raw)
                known[raw] = (i, -float(np.log(2 - model.get_score(i))))
        self.byte_weight = -float(np.log(size + 2))
        crossing = [p for p in known if bytes([BREAK]) in p or bytes([BLANK]) in p.lstrip(bytes([BLANK]))]
        if crossing:
            raise ValueError(f"pieces across blanks: {crossing[:3]}")
        # A trie over characters: states are prefixes of pieces, a step is (state, character).
        states: dict[str, int] = {"": 0}
        for raw in known:
            text = raw.decode()
            for k in range(1, len(text) + 1):
                states.setdefault(text[:k], len(states))
        alphabet = sorted({c for text in states for c in text[-1:]})
        self.letter = np.zeros(0x110000, dtype=np.int32)  # number of each character, 0: in no piece
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.letters = len(alphabet) + 1
        self.ids = np.full(len(states), -1, dtype=np.int64)
        self.weights = np.zeros(len(states))
        for raw, (i, weight) in known.items():
            self.ids[states[raw.decode()]], self.weights[states[raw.decode()]] = i, weight
        steps = {states[text[:-1]] * self.letters + int(self.letter[ord(text[-1])]): at for text, at in states.items() if text}
        # Steps in a table with open places: the next state is found in one or two looks.
        self.bits = max(4, (4 * len(steps)).bit_length())
        self.slots = np.full((1 << self.bits) + 1, -1, dtype=np.int64)
        self.following = np.zeros(len(self.slots), dtype=np.int32)
        waiting, goal = np.array(list(steps), dtype=np.int64), np.array(list(steps.values()), dtype=np.int32)
        slot = self._slot(waiting)
        while len(waiting):
            free = self.slots[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.slots[slot[won]], self.following[slot[won]] = waiting[won], goal[won]
            left = np.ones(len(waiting), dtype=bool)
            left[won] = False
            waiting, goal, slot = waiting[left], goal[left], (slot[left] + 1) & ((1 << self.bits) - 1)
        self.longest = max(len(r.decode()) for r in known)
        self.data = np.frombuffer(b"".join(self.surface), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in self.surface])]).astype(np.int32)


    def _slot(self, step: np.ndarray) -> np.ndarray:
        return ((step.astype(np.uint64) * _STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def walk(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The state after a letter, -1 where no piece goes on so."""
        step = state.astype(np.int64) * self.letters + letter
        slot = self._slot(step)
        seen = self.slots[slot]
        out = np.where(seen == step, self.following[slot], -1)
        on = np.flatnonzero((seen != step) & (seen >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) & ((1 << self.bits) - 1)
            seen = self.slots[slot[on]]
            hit = seen == step[on]
            out[on[hit]] = self.following[slot[on[hit]]]
            on = on[~hit & (seen >= 0)]
        return out


def code_points(data: np.ndarray, lead: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Code points of the characters that begin at ``lead`` and are ``width`` bytes long."""
    out = data[lead].astype(np.int32)
    for size, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        which = np.flatnonzero(width == size)
        if len(which):
            value = out[which] & mask
            for k in range(1, size):
                value = (value << 6) | (data[lead[which] + k] & 0x3F)
            out[which] = value
    return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Lattices of the distinct chunks of a buffer.  Arcs are sorted by their end node, so
    the arcs into a node are one run, from ``head`` to ``tail``; ``chance`` is an arc's
    probability given its end node."""

    def __init__(self, words: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # character starts
        first, last = np.searchsorted(lead, starts), np.searchsorted(lead, ends)
        length = last - first
        base = (np.cumsum(length + 1) - (length + 1)).astype(np.int32)  # node before each chunk's first character
        self.first_node, self.last_node = base, base + length.astype(np.int32)
        limit = np.append(lead, len(data)).astype(np.int32)
        letter = words.letter[code_points(data, lead, np.diff(limit))]
        total = int(length.sum())
        place = (np.arange(total) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
        char = np.repeat(first.astype(np.int32), length) + place
        node = np.repeat(base, length) + place
        room = np.repeat(length.astype(np.int32), length) - place
        source, target, piece, weight = [], [], [], []
        single = np.zeros(total, dtype=bool)
        active, state = np.arange(total, dtype=np.int32), np.zeros(total, dtype=np.int32)
        for size in range(1, words.longest + 1):
            on = room[active] >= size
            active, state = active[on], state[on]
            if not len(active):
                break
            state = words.walk(state, letter[char[active] + (size - 1)])
            on = state >= 0
            active, state = active[on], state[on]
            ids = words.ids[state]
            real = np.flatnonzero(ids >= 0)
            source.append(node[active[real]])
            target.append(node[active[real]] + size)
            piece.append(ids[real])
            weight.append(words.weights[state[real]])
            if size == 1:
                single[active[real]] = True
        odd = np.flatnonzero(~single)  # characters of bytes: one arc, expanded when emitted
        source.append(node[odd])
        target.append(node[odd] + 1)
        piece.append(-1 - limit[char[odd]])
        weight.append(words.byte_weight * (limit[char[odd] + 1] - limit[char[odd]]))
        self.limit, self.lead = limit, lead
        depth = np.zeros(int(self.last_node[-1]) + 1 if len(base) else 1, dtype=np.int32)
        depth[node] = place
        depth[self.last_node] = length
        # By depth, end, and length, long pieces first: mostly the likeliest.  Arcs of one
        # length end at different nodes, so their places follow from counts.
        into = np.zeros(len(depth), dtype=np.int32)
        for ends_at in target:
            into[ends_at] += 1
        by_depth = np.argsort(depth.astype(np.uint16) if depth.max(initial=0) < 1 << 16 else depth, kind="stable")
        begin = np.empty(len(depth), dtype=np.int64)
        begin[by_depth] = np.cumsum(into[by_depth]) - into[by_depth]
        count = int(into.sum())
        self.source, self.piece, self.weight = np.empty(count, np.int32), np.empty(count, np.int64), np.empty(count)
        # Bytes of a character that is no piece count as its length of one.
        bytes_arc, sized = (source.pop(), target.pop(), piece.pop(), weight.pop()), list(zip(source, target, piece, weight, strict=True))
        place_of = begin.copy()
        for start, ends_at, ids, log in [*reversed(sized), bytes_arc]:
            at = place_of[ends_at]
            self.source[at], self.piece[at], self.weight[at] = start, ids, log
            place_of[ends_at] += 1
        ended = by_depth[into[by_depth] > 0]
        head = begin[ended]
        level = depth[ended]
        self.alpha = np.zeros(len(depth))
        self.chance = np.empty(count)
        step = np.searchsorted(level, np.arange(1, (int(level[-1]) if len(level) else 0) + 2))
        tail = np.append(head, count)
        for lo, hi in zip(step[:-1], step[1:], strict=True):
            if lo == hi:
                continue
            a, b = tail[lo], tail[hi]
            value = self.alpha[self.source[a:b]] + self.weight[a:b]
            runs = head[lo:hi] - a
            sizes = np.diff(np.append(runs, b - a))
            top = np.maximum.reduceat(value, runs)
            scaled = np.exp(value - np.repeat(top, sizes))
            mass = np.add.reduceat(scaled, runs)
            self.alpha[ended[lo:hi]] = top + np.log(mass)
            self.chance[a:b] = scaled / np.repeat(mass, sizes)
        self.run = np.zeros(len(depth), dtype=np.int64)
        self.run[ended] = np.arange(len(head))
        self.head, self.tail = head, tail[1:]
        self.log_chance = np.log(self.chance)

    def draw(self, nodes: np.ndarray, stop: np.ndarray, seeds: np.ndarray):
        """Paths back from ``nodes`` to ``stop``: which of the nodes, step, and arc of each decision."""
        live = np.flatnonzero(nodes != stop)
        at, which, arcs, step = nodes[live], [], [], 0
        while len(live):
            run = self.run[at]
            arc, last = self.head[run], self.tail[run] - 1
            left = _uniform(seeds[live], step)
            over = np.arange(len(arc))
            while True:
                left[over] -= self.chance[arc[over]]
                over = over[(left[over] >= 0) & (arc[over] < last[over])]
                if not len(over):
                    break
                arc[over] += 1
            which.append(live)
            arcs.append(arc)
            at = self.source[arc]
            on = at != stop[live]
            live, at, step = live[on], at[on], step + 1
        if not which:
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        # Each step lists its nodes in order, so a decision's place follows from counts.
        count = np.bincount(np.concatenate(which), minlength=len(nodes))
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int64)
        for step, (live, arc) in enumerate(zip(which, arcs, strict=True)):
            out[begin[live] + step] = arc
        which = np.repeat(np.arange(len(nodes)), count)
        return which, np.arange(len(which)) - begin[which], out


def _seeds(keys: np.ndarray, *numbers) -> np.ndarray:
    h = keys.astype(np.uint64)
    for n in numbers:
        h = mixed(h * _STEP + np.asarray(n).astype(np.uint64) + np.uint64(1))
    return h


def _uniform(seeds: np.ndarray, number) -> np.ndarray:
    """In (0, 1), from a hash."""
    return ((_seeds(seeds, number) >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks, and the row of each."""
    blank, line = data == BLANK, data == BREAK
    start = (blank & ~np.concatenate([[False], blank[:-1]])) | line | np.concatenate([[False], line[:-1]])
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1


def sample(words: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, k: int):
    """Yield (row, number, ids, log-probability, perturbed value, log-inclusion) of each sample."""
    rows = len(offsets) - 1
    begin, length = offsets[:-1], np.diff(offsets)
    filled = length > 0
    # A blank before each text that is not empty.
    shift = np.cumsum(filled)
    bounds = np.concatenate([[0], offsets[1:] + shift])
    buffer = np.empty(len(data) + int(shift[-1]) if rows else 0, dtype=np.uint8)
    body = np.ones(len(buffer), dtype=bool)
    body[bounds[:-1][filled]] = False
    buffer[~body] = BLANK
    buffer[body] = data
    if not len(buffer):
        return
    starts, ends, row = _chunks(buffer, bounds)
    hashes = span_hashes(prefix_sums(buffer), starts, ends)
    kind, distinct = pd.factorize(hashes)
    sole = np.empty(len(distinct), dtype=np.int64)
    sole[kind[::-1]] = np.arange(len(kind))[::-1]  # the first of each kind is written last
    lattice = Lattice(words, buffer, starts[sole], ends[sole])
    top, low = lattice.last_node[kind], lattice.first_node[kind]
    first_chunk = np.searchsorted(row, np.arange(rows + 1))
    number = np.arange(len(starts)) - first_chunk[row]  # of the chunk in its text
    clock = -np.log(_uniform(_seeds(keys, 0), 7))
    which, _, arcs = lattice.draw(top, low, _seeds(keys[row], 1, number))
    pending = _by_row(row[which], which, arcs, rows)
    todo = {r: (*pending[r], 0, 0.0, clock[r], []) for r in range(rows) if filled[r]}
    agenda: dict[int, list[_Path]] = {r: [] for r in todo}
    found: list[tuple] = []
    nxt: dict[int, float] = {}
    for turn in range(1, k + 1):
        seeds = _seeds(keys[list(todo)], turn, 3)
        waits = -np.log(_uniform(seeds[:, None], np.arange(2 * STEP + 1) + 11))
        for n, (r, (chunk, arc, place, base, now, left)) in enumerate(todo.items()):
            path = _Path(lattice, chunk, arc, place, base, now, left, seeds[n : n + 1], waits[n])
            agenda[r].append(path)
            found.append((r, turn, path, now))
        deviations = []
        spread = _seeds(keys[list(todo)], turn, 4)
        drawn = _uniform(_seeds(keys[list(todo)], turn, 5), 1)
        for n, r in enumerate(todo):
            path = min(agenda[r], key=lambda q: q.best)
            now = nxt[r] = path.best
            if turn == k or not np.isfinite(now):
                continue
            place = path.pop(spread[n : n + 1])
            # An arc into the same node, other than those taken there.
            out = [*(path.left if place == path.place else []), int(path.arc[place])]
            run = lattice.run[_end(lattice, top, path.chunk, path.arc, place)]
            choices = np.array([x for x in range(lattice.head[run], lattice.tail[run]) if x not in out])
            share = np.cumsum(lattice.chance[choices])
            u = float(drawn[n]) * share[-1]
            pick = int(choices[min(int(np.searchsorted(share, u)), len(choices) - 1)])
            deviations.append((r, path, place, path.log_before(place), now, out, pick))
        if not deviations:
            break
        # The rest of each new path: of its chunk from the new piece on, and of later chunks.
        begin_at = [np.arange(int(d[1].chunk[d[2]]), first_chunk[d[0] + 1]) for d in deviations]
        size = [len(b) for b in begin_at]
        chunk_at = np.concatenate(begin_at)
        nodes = top[chunk_at].copy()
        nodes[np.cumsum([0, *size[:-1]])] = lattice.source[[d[6] for d in deviations]]
        which, _, arcs = lattice.draw(nodes, low[chunk_at], _seeds(keys[row[chunk_at]], turn + 1, number[chunk_at]))
        rest = _by_row(np.repeat(np.arange(len(size)), size)[which], chunk_at[which], arcs, len(size))
        todo = {}
        for (r, path, place, base, now, out, pick), (more_chunk, more_arc) in zip(deviations, rest, strict=True):
            chunk = np.concatenate([path.chunk[: place + 1], more_chunk])
            arc = np.concatenate([path.arc[:place], [pick], more_arc])
            todo[r] = (chunk, arc, place, base, now, out)
    flat, cut = _ids(words, lattice, buffer, [(path.chunk, path.arc) for _, _, path, _ in found])
    for n, (r, turn, path, now) in enumerate(found):
        inclusion = 0.0
        if np.isfinite(nxt[r]):
            rate = np.exp(path.log_p) * nxt[r]
            inclusion = path.log_p + np.log(nxt[r]) if rate < 1e-12 else float(np.log(-np.expm1(-rate)))
        yield r, turn, flat[cut[n] : cut[n + 1]], path.log_p, -np.log(now), inclusion


NEAR = -40.0  # log-probability after which a path's later places share one agenda entry
STEP = 48


class _Path:
    """A found path and its agenda entries: one for each place from ``place`` on, where
    another arc could be taken, until the path's probability has fallen by e^NEAR; one for
    all later places together, told apart only if it is ever the best.

    ``base`` is the log-probability of the decisions before ``place``, ``left`` the arcs
    already taken there by other paths, ``now`` the clock at which the path was found.
    """

    def __init__(self, lattice, chunk, arc, place: int, base: float, now: float, left: list[int], seed, waits):
        self.chunk, self.arc, self.place, self.left = chunk, arc, place, left
        size = STEP
        while True:
            before = np.concatenate([[0.0], np.cumsum(lattice.log_chance[arc[place : place + size]])])
            if before[-1] < NEAR or place + size >= len(arc):
                break
            size *= 2
        self.log_p = base + float(lattice.log_chance[arc[place:]].sum())
        self.before = base + before
        self.lattice = lattice
        self.cut = min(int(np.searchsorted(-before, -NEAR)) + 1, len(before) - 1)
        chance = lattice.chance[arc[place : place + self.cut]]
        with np.errstate(divide="ignore", under="ignore", invalid="ignore", over="ignore"):
            others = 1 - chance
            if left:
                others[0] = max(0.0, 1 - lattice.chance[left].sum() - chance[0])
            mass = np.exp(self.before[: self.cut]) * np.where(chance >= 1, 0.0, others)
            rest = 0.0
            if place + self.cut < len(arc):
                rest = np.exp(self.before[self.cut]) * -np.expm1(min(0.0, self.log_p - self.before[self.cut]))
            mass = np.append(mass, rest)
            wait = waits[: self.cut + 1] if self.cut < len(waits) else -np.log(_uniform(seed, np.arange(self.cut + 1) + 11))
            self.times = np.where(mass > 0, now + wait / mass, np.inf)
        self.best = float(self.times.min())

    def log_before(self, place: int) -> float:
        return float(self.before[place - self.place])

    def pop(self, seed) -> int:
        """Place of the best entry, which leaves the agenda."""
        at = int(self.times.argmin())
        if at == self.cut and self.place + self.cut < len(self.arc):
            at = self._spread(seed)
        self.times[at] = np.inf
        self.best = float(self.times.min())
        return self.place + at

    def _spread(self, seed) -> int:
        """Tell the later places apart: one of them has the shared entry's clock, the
        others wait from there."""
        now, first = self.times[self.cut], self.cut
        arc = self.arc[self.place + first :]
        logs = self.lattice.log_chance[arc]
        self.before = np.concatenate([self.before[: first + 1], self.before[first] + np.cumsum(logs)])
        with np.errstate(divide="ignore", under="ignore", invalid="ignore", over="ignore"):
            mass = np.exp(self.before[first:-1]) * np.where(logs >= 0, 0.0, 1 - self.lattice.chance[arc])
            wait = -np.log(_uniform(seed, np.arange(len(arc)) + 11))
            times = np.where(mass > 0, now + wait / mass, np.inf)
        share = np.cumsum(mass)
        hit = min(int(np.searchsorted(share, float(_uniform(seed, 7)[0]) * share[-1], "right")), len(arc) - 1)
        times[hit] = now
        self.times = np.concatenate([self.times[:first], times, [np.inf]])
        self.cut = len(self.times) - 1
        return first + hit


def _by_row(row: np.ndarray, chunk: np.ndarray, arcs: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    cut = np.searchsorted(row, np.arange(rows + 1))
    return [(chunk[a:b], arcs[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _end(lattice: Lattice, top: np.ndarray, chunk: np.ndarray, arc: np.ndarray, place: int) -> int:
    """End node of a decision: its chunk's last node, or the start of the decision before."""
    same = place > 0 and chunk[place - 1] == chunk[place]
    return int(lattice.source[arc[place - 1]]) if same else int(top[chunk[place]])


def _ids(words: Vocabulary, lattice: Lattice, buffer: np.ndarray, paths: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the paths in text order, and where each path's begin; decisions run
    backwards within their chunk."""
    sizes = np.array([len(c) for c, _ in paths], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    if not len(paths):
        return np.zeros(0, dtype=np.int64), bounds
    chunk, arc = (np.concatenate([p[k] for p in paths]) for k in (0, 1))
    n = len(chunk)
    fresh = np.concatenate([[True], chunk[1:] != chunk[:-1]])
    fresh[bounds[:-1]] = True
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, n))
    ids = lattice.piece[arc[np.repeat(2 * head + count - 1, count) - np.arange(n)]]
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids, bounds
    at = -1 - ids[odd]
    size = lattice.limit[np.searchsorted(lattice.lead, at) + 1] - at
    widths = np.ones(n, dtype=np.int64)
    widths[odd] = size
    starts = np.concatenate([[0], np.cumsum(widths)])
    out = np.repeat(ids, widths)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(starts[odd], size) + step] = words.byte_ids[buffer[np.repeat(at, size) + step]]
    return out, starts[bounds]


def _texts(words: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Texts of runs of ids, without the blank put before each."""
    width = words.offsets[ids + 1] - words.offsets[ids]
    place = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
    data = words.data[np.repeat(words.offsets[ids] - place[:-1], width) + np.arange(int(place[-1]), dtype=np.int32)]
    cut = place[ends]
    return [data[a + 1 : b].tobytes() if b > a else b"" for a, b in zip(cut[:-1], cut[1:], strict=True)]


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, model: str = MODEL, seed: int = SEED,
    decoded: bool = False,
) -> DataFrame:
    """Up to ``samples`` rows per document: ``<id>, sample, ids, log_prob, perturbed, log_inclusion``.

    ``sample`` counts from 1 by falling perturbed value, ``ids`` are piece ids, ``log_prob``
    the segmentation's log-probability, and ``log_inclusion`` the log-probability of being
    among the samples given the next best perturbed value (0 if nothing is left out).
    ``decoded`` adds the text that :func:`decode` makes of the ids, in the same pass.

    * A text with fewer segmentations than asked gives as many as there are.
    * A null or empty text gives one row without ids and log-probability 0.
    * Rows that repeat an id and text get the same samples; null ids share one seed.
    * An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            keys = batch.column(1).to_numpy().view(np.uint64)
            for first, last, data, offsets in pieces(*bytes_of(batch.column(2)), PIECE):
                got = list(sample(words, data, offsets, keys[first:last], samples))
                empty = np.flatnonzero(np.diff(offsets) == 0).tolist()
                got += [(r, 1, np.zeros(0, np.int64), 0.0, 0.0, 0.0) for r in empty]
                flat = np.concatenate([*[g[2] for g in got], np.zeros(0, np.int64)]).astype(np.int32)
                ends = np.cumsum([0, *[len(g[2]) for g in got]]).astype(np.int32)
                texts = [pa.array(_texts(words, flat, ends), pa.binary()).cast(pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([first + g[0] for g in got], pa.int64())),
                        pa.array([g[1] for g in got], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        *[pa.array([float(g[i]) for g in got], pa.float64()) for i in (3, 4, 5)],
                        *texts,
                    ],
                    names,
                )

    schema = f"id {kind}, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double" + ", decoded string" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ids, without the blank put before it.
    Null or empty ids give an empty text; ids outside the vocabulary fail.  A text that
    itself holds U+2581 decodes with a blank in its place, as in every such model."""
    rest = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in rest], F.col(ids_col).alias("__ids"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            lists = batch.column(len(rest))
            ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
            ids = np.asarray(lists.flatten())
            first = 0
            while first < batch.num_rows:
                last = max(int(np.searchsorted(ends, ends[first] + IDS, "right")) - 1, first + 1)
                own = ids[ends[first] : ends[last]]
                texts = _texts(words, own, ends[first : last + 1] - ends[first])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.binary()).cast(pa.string())], [*rest, "decoded"]
                )
                first = last

    return rows.mapInArrow(run, schema)
