"""Regular expressions over bytes as one minimised deterministic automaton.

Patterns know literals, ``[...]`` classes, ``(...)``, ``(?i:...)``, ``|``, ``?``, ``*``,
``+`` and ``{m}``, ``{m,}``, ``{m,n}``, all over ASCII.  They are compiled to a Thompson
automaton, determinised by subset construction over byte classes, and minimised by
partition refinement into a transition array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL_BYTES = frozenset(range(256))


class _Parser:
    """Recursive descent into tuples ('set', bytes), ('cat', ...), ('alt', ...), ('rep', node, lo, hi)."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def parse(self):
        node = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.peek()!r} at {self.at} of {self.text!r}")
        return node

    def alternatives(self):
        branches = [self.sequence()]
        while self.peek() == "|":
            self.take()
            branches.append(self.sequence())
        return branches[0] if len(branches) == 1 else ("alt", *branches)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("cat", *parts)

    def repeated(self, node):
        while self.peek() and self.peek() in "?*+{":
            mark = self.take()
            if mark == "{":
                bounds = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(bounds) + 1
                low, comma, high = bounds.partition(",")
                lo, hi = int(low), (int(high) if high else None if comma else int(low))
            else:
                lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            node = ("rep", node, lo, hi)
        return node

    def atom(self):
        char = self.take()
        if char == "(":
            outer = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"missing ) in {self.text!r}")
            self.fold = outer
            return node
        if char == "[":
            return ("set", self.klass())
        if char == ".":
            return ("set", ALL_BYTES - {10})
        return ("set", self.cased({self.escaped() if char == "\\" else ord(char)}))

    def escaped(self) -> int:
        char = self.take()
        if char == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(char, ord(char))

    def klass(self) -> frozenset:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            char = self.take()
            low = self.escaped() if char == "\\" else ord(char)
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.take()
                char = self.take()
                found |= set(range(low, (self.escaped() if char == "\\" else ord(char)) + 1))
            else:
                found.add(low)
        self.take()
        found = self.cased(found)
        return frozenset(ALL_BYTES - found) if negated else found

    def cased(self, found) -> frozenset:
        if self.fold:
            text = bytes(sorted(found))
            found = set(text.lower()) | set(text.upper())
        return frozenset(found)


def _mirrored(node):
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", _mirrored(node[1]), *node[2:])
    parts = tuple(map(_mirrored, node[1:]))
    return (node[0], *(parts[::-1] if node[0] == "cat" else parts))


class _Graph:
    """Thompson automaton: empty steps, and one step on a set of bytes per state at most."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Build a node from ``start``; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            middle = self.state()
            self.empty[start].append(middle)
            self.step[middle] = (node[1], end)
            return end
        if kind == "cat":
            for part in node[1:]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1:]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        _, inner, lo, hi = node
        for _ in range(lo):
            start = self.add(inner, start)
        if hi is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(hi - lo):
            start = self.add(inner, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state, classes[byte]]`` is the next state; state 0 is the start; bit k of
    ``accepts[state]`` says that pattern k ends here; ``dead`` has no way on, or is -1."""

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    dead: int


def _determinise(graph: _Graph, start: frozenset, ends: dict[int, int], again: frozenset) -> Automaton:
    sets = list({s[0] for s in graph.step if s})
    signature = [tuple(byte in s for s in sets) for byte in range(256)]
    order = {s: k for k, s in enumerate(dict.fromkeys(signature))}
    classes = np.array([order[s] for s in signature], dtype=np.uint8)
    member = [int(np.flatnonzero(classes == k)[0]) for k in range(len(order))]
    after = {s[1]: graph.closure([s[1]]) for s in graph.step if s}
    number, todo, rows, accepts = {start: 0}, [start], [], []
    for state in todo:
        accepts.append(sum({1 << ends[s] for s in state if s in ends}))
        moves, row = [graph.step[s] for s in state if graph.step[s]], []
        for byte in member:
            to = again.union(*(after[s[1]] for s in moves if byte in s[0]))
            if to not in number:
                number[to] = len(todo)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    table, accepts = np.array(rows, dtype=np.int64), np.array(accepts, dtype=np.int64)
    # Minimise: split the blocks of equal acceptance until successors agree.
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        refined = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    names = {b: k for k, b in enumerate(dict.fromkeys(block.tolist()))}  # the start's block comes first
    block = np.array([names[b] for b in block.tolist()])
    first = np.array([np.flatnonzero(block == k)[0] for k in range(len(names))])
    table, accepts = block[table[first]], accepts[first]
    stuck = [k for k in range(len(table)) if (table[k] == k).all() and not accepts[k]]
    return Automaton(classes, table, accepts, stuck[0] if stuck else -1)


def compile_all(patterns: list[str]) -> Automaton:
    """All patterns at once, each starting anywhere."""
    graph = _Graph()
    start, ends = graph.state(), {}
    for k, pattern in enumerate(patterns):
        ends[graph.add(_Parser(pattern).parse(), start)] = k
    entry = graph.closure([start])
    return _determinise(graph, entry, ends, entry)


def compile_one(pattern: str, mirrored: bool = False) -> Automaton:
    """One pattern from a fixed place, forwards, or backwards from its end."""
    graph = _Graph()
    node = _Parser(pattern).parse()
    start = graph.state()
    end = graph.add(_mirrored(node) if mirrored else node, start)
    return _determinise(graph, graph.closure([start]), {end: 0}, frozenset())


class Scanner:
    """Spans of all patterns in texts, found in one pass of the combined automaton.

    A buffer of many texts is cut into lanes that numpy advances together, one byte of each
    lane per step.  A lane starts in the start state; where the lane before it ended in
    another state, the lane is run again from that state until both runs agree, so cuts do
    not show.  A text begins in the start state.

    Per pattern, spans do not overlap; the earliest end fixes a span, its start is the
    leftmost that reaches this end, and from there it is as long as possible.  For patterns
    in which no match begins before and ends after another's end (those below) this is
    leftmost-longest.
    """

    LANE = 2048

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        whole = compile_all(patterns)
        self.reset = whole.table.shape[1]
        self.classes = whole.classes
        kind = np.uint16 if len(whole.table) < 1 << 16 else np.uint32
        # One more column, for the first byte after a break between texts.
        self.table = np.column_stack([whole.table, np.zeros(len(whole.table), dtype=np.int64)]).astype(kind)
        self.accepts = whole.accepts
        self.forward = [self._lists(compile_one(p)) for p in patterns]
        self.backward = [self._lists(compile_one(p, mirrored=True)) for p in patterns]

    @staticmethod
    def _lists(a: Automaton):
        return a.table[:, a.classes].tolist(), a.accepts.tolist(), a.dead

    def states(self, data: np.ndarray) -> np.ndarray:
        """State after each class number of ``data``."""
        n = len(data)
        lanes = max(1, n // self.LANE)
        size = -(-n // lanes)
        grid = np.full(lanes * size, self.reset, dtype=np.uint8)
        grid[:n] = data
        grid = np.ascontiguousarray(grid.reshape(lanes, size).T)
        out = np.empty((size, lanes), dtype=self.table.dtype)
        flat, width = self.table.ravel(), self.table.shape[1]
        state = np.zeros(lanes, dtype=np.int64)
        for k in range(size):
            out[k] = state = flat[state * width + grid[k]]
            state = state.astype(np.int64)
        assumed = np.zeros(lanes, dtype=np.int64)
        while True:
            true = np.concatenate([[0], out[-1, :-1]]).astype(np.int64)
            lane = np.flatnonzero(true != assumed)
            if not len(lane):
                return out.T.ravel()[:n]
            assumed[lane] = state = true[lane]
            for k in range(size):
                state = flat[state * width + grid[k, lane]].astype(np.int64)
                differs = state != out[k, lane]
                lane, state = lane[differs], state[differs]
                if not len(lane):
                    break
                out[k, lane] = state

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Per text that has any: (pattern, start, end) in bytes of the text."""
        count = len(offsets) - 1
        begin, length = offsets[:-1] - offsets[0], np.diff(offsets)
        data = data[offsets[0] : offsets[-1]]
        classes = np.empty(len(data) + count, dtype=np.uint8)
        at = np.arange(count) + begin + length  # one break after each text
        body = np.ones(len(classes), dtype=bool)
        body[at] = False
        classes[body] = self.classes[data]
        classes[at] = self.reset
        hits = self.accepts[self.states(classes)]
        where = np.flatnonzero(hits)
        text = np.searchsorted(at, where)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k in range(len(self.patterns)):
            mine = (hits[where] >> k) & 1 == 1
            own, of = where[mine], text[mine]
            for t in np.unique(of).tolist():
                lo, hi = np.searchsorted(of, [t, t + 1])
                base = int(begin[t])
                ends = own[lo:hi] - (base + t) + 1
                raw = data[base : base + int(length[t])].tobytes()
                found.setdefault(t, []).extend((k, s, e) for s, e in self._of_text(k, raw, ends))
        return found

    def _of_text(self, k: int, raw: bytes, ends: np.ndarray):
        back, stops, gone = self.backward[k]
        ahead, final, stuck = self.forward[k]
        done, i = 0, 0
        while i < len(ends):
            state, start = 0, None
            for at in range(int(ends[i]) - 1, done - 1, -1):
                state = back[state][raw[at]]
                if state == gone:
                    break
                if stops[state]:
                    start = at
            if start is None:
                i += 1
                continue
            state, end = 0, int(ends[i])
            for at in range(start, len(raw)):
                state = ahead[state][raw[at]]
                if state == stuck:
                    break
                if final[state]:
                    end = at + 1
            yield start, end
            done = end
            i = int(np.searchsorted(ends, end, "right"))
