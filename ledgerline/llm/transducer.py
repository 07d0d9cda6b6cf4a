"""Minimal acyclic transducer of a sorted vocabulary: reads a word and gives its lexicographic ordinal.

Built from sorted terms: states that no later term can change are frozen, and a frozen state equal to
an earlier one is that one, so the automaton is minimal at any time. Every transition carries the number of
terms that come before all terms through it; the ordinal is the sum along a word's way. Many words
are read at once: one step moves all of them by one byte, and words that have left the automaton take no
further part, however long they are.
"""

import numpy as np


class Transducer:
    """States are numbered from the ends of words to the root, which is the last."""

    def __init__(self, first: np.ndarray, labels: np.ndarray, targets: np.ndarray, final: np.ndarray):
        """Transitions in order of state and label; ``first`` has one more entry than there are states."""
        self.first, self.labels, self.targets, self.final = first, labels, targets, final
        self._table = None

    @staticmethod
    def build(terms) -> "Transducer":
        """From distinct byte strings in ascending order."""
        known: dict[tuple, int] = {}
        open_: list[list] = [[False, []]]  # of the last term's states: whether final, and the transitions so far
        way = b""

        def freeze(depth: int) -> None:
            while len(open_) > depth + 1:
                final, moves = open_.pop()
                open_[-1][1].append((way[len(open_) - 1], known.setdefault((final, tuple(moves)), len(known))))

        for term in terms:
            if way and term <= way or not term:
                raise ValueError("terms have to be distinct, not empty and in ascending order")
            shared = next((k for k, (a, b) in enumerate(zip(way, term)) if a != b), min(len(way), len(term)))
            freeze(shared)
            open_.extend([False, []] for _ in term[shared:])
            open_[-1][0] = True
            way = term
        freeze(0)
        states = [*known, (open_[0][0], tuple(open_[0][1]))]
        sizes = [len(moves) for _, moves in states]
        moves = [move for _, own in states for move in own]
        return Transducer(
            np.concatenate(([0], np.cumsum(sizes))).astype(np.int32),
            np.array([label for label, _ in moves], np.uint8),
            np.array([target for _, target in moves], np.int32),
            np.array([final for final, _ in states], bool),
        )

    def __len__(self) -> int:
        """How many terms it holds."""
        return int(self._counts()[-1])

    def _counts(self) -> np.ndarray:
        """Terms that end at a state or beyond; targets have smaller numbers than the states they are reached from."""
        found = self.final.astype(np.int64)
        for state in range(len(found)):
            found[state] += found[self.targets[self.first[state] : self.first[state + 1]]].sum()
        return found

    def pack(self) -> bytes:
        head = np.array([len(self.final), len(self.labels)], "<i4")
        return b"".join([head.tobytes(), self.first.astype("<i4").tobytes(), self.targets.astype("<i4").tobytes(), self.labels.tobytes(), self.final.tobytes()])

    @staticmethod
    def unpack(packed: bytes) -> "Transducer":
        states, moves = np.frombuffer(packed, "<i4", 2)
        at = 8
        first = np.frombuffer(packed, "<i4", states + 1, at)
        targets = np.frombuffer(packed, "<i4", moves, at := at + 4 * (states + 1))
        labels = np.frombuffer(packed, np.uint8, moves, at := at + 4 * moves)
        return Transducer(first, labels, targets, np.frombuffer(packed, bool, states, at + moves))

    @property
    def table_bytes(self) -> int:
        """Memory that reading takes."""
        return 12 * len(self.final) * (1 + len(np.unique(self.labels)))

    def _ready(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each byte its class (0: in no term), and for each state and class the target (-1: none) and the terms before."""
        if self._table is None:
            used = np.unique(self.labels)
            kind = np.zeros(256, np.intp)
            kind[used] = np.arange(1, len(used) + 1)
            target = np.full((len(self.final), len(used) + 1), -1, np.int32)
            before = np.zeros(target.shape, np.int64)
            counts = self._counts()
            state = np.repeat(np.arange(len(self.final)), np.diff(self.first))
            target[state, kind[self.labels]] = self.targets
            through = counts[self.targets]
            upto = np.cumsum(through) - through
            ahead = np.zeros(len(self.final), np.int64)
            some = self.first[:-1] < self.first[1:]
            ahead[some] = upto[self.first[:-1][some]]
            before[state, kind[self.labels]] = upto - ahead[state] + self.final[state]
            self._table = kind, target, before
        return self._table

    def ordinals(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinals of the words ``body[start:end]``, -1 for words that are no terms."""
        kind, target, before = self._ready()
        found = np.full(len(starts), -1, np.int64)
        which = np.flatnonzero(ends > starts)
        at, left = starts[which], (ends - starts)[which]
        state, sum_ = np.full(len(which), len(self.final) - 1), np.zeros(len(which), np.int64)
        while len(which):
            byte = kind[body[at]]
            sum_ += before[state, byte]
            state = target[state, byte]
            alive = state >= 0
            ended = alive & (left == 1)
            whole = ended & self.final[state]
            found[which[whole]] = sum_[whole]
            on = alive & ~ended
            which, at, left, state, sum_ = which[on], at[on] + 1, left[on] - 1, state[on], sum_[on]
        return found

    def terms(self):
        """All terms, by ordinal."""
        stack = [(len(self.final) - 1, b"")]
        while stack:
            state, way = stack.pop()
            if self.final[state]:
                yield way
            for k in range(self.first[state + 1] - 1, self.first[state] - 1, -1):
                stack.append((int(self.targets[k]), way + bytes([self.labels[k]])))
