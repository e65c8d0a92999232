"""A minimal acyclic transducer: words in, number sequences out, with shared suffixes.

``build`` takes words in sorted order and keeps one unfinished path, that of the last word. When the next word leaves
that path, the states beyond the common prefix are final: a state with the same arcs and outputs as a known one is replaced
by it, so that equal suffixes are stored once. Outputs stand on arcs, as far forward as the words that share an arc
allow; what is left over after the last byte stands on the state.

The automaton is one file of flat arrays. ``Lexicon`` maps it into memory, so the Python workers of a machine share its
pages, and looks up many words at once: step by step, all words that are still on a path go on by one byte.
"""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

import numpy as np

from claimloom.llm import pretokens

#: The arrays of a file in their order: of each arc its state and byte, where it leads and its output; of each state the output after
#: the last byte (-1: no word ends here); of each output where it begins and what it holds.
_ARRAYS = {"keys": "<u8", "lasts": "<i8", "targets": "<i8", "outputs": "<i8", "starts": "<i8", "numbers": "<u4"}


class _State:
    __slots__ = ("arcs", "last")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte: [state or its number, output]
        self.last: tuple[int, ...] | None = None


def _common(a: tuple, b: tuple) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


class _Builder:
    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.path, self.before = [_State()], b""

    def _number(self, state: _State) -> int:
        """The number of a final state, whose arcs all lead to numbered states."""
        form = (state.last, *((byte, to, out) for byte, (to, out) in sorted(state.arcs.items())))
        if form not in self.known:
            self.known[form] = len(self.states)
            self.states.append(form)
        return self.known[form]

    def _settle(self, depth: int) -> None:
        """Numbers the states of the last word's path that lie deeper than ``depth``."""
        while len(self.path) > depth + 1:
            number = self._number(self.path.pop())
            self.path[-1].arcs[self.before[len(self.path) - 1]][0] = number

    def add(self, word: bytes, output: tuple[int, ...]) -> None:
        shared = 0
        while shared < min(len(word), len(self.before)) and word[shared] == self.before[shared]:
            shared += 1
        self._settle(shared)
        for byte, parent, state in zip(word[:shared], self.path, self.path[1:], strict=False):
            arc = parent.arcs[byte]
            keep = _common(arc[1], output)
            rest, arc[1], output = arc[1][keep:], arc[1][:keep], output[keep:]
            if rest:  # what the arc no longer says is said behind it
                for onward in state.arcs.values():
                    onward[1] = rest + onward[1]
                if state.last is not None:
                    state.last = rest + state.last
        for byte in word[shared:]:
            state = _State()
            self.path[-1].arcs[byte] = [state, output]
            self.path.append(state)
            output = ()
        self.path[-1].last = output
        self.before = word

    def finished(self) -> int:
        self._settle(0)
        return self._number(self.path[0])


def build(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The file of a transducer for distinct, sorted, non-empty words and their outputs."""
    builder = _Builder()
    for word, output in entries:
        builder.add(word, tuple(output))
    builder.finished()
    places: dict[tuple, int] = {(): 0}
    place = lambda output: -1 if output is None else places.setdefault(output, len(places))
    arcs = [(number << 8 | byte, to, place(out)) for number, (_, *arcs) in enumerate(builder.states) for byte, to, out in arcs]
    lasts = [place(last) for last, *_ in builder.states]
    held = [np.array(column, _ARRAYS["keys"]) for column in zip(*arcs, strict=True)] or [np.zeros(0)] * 3
    arrays = {
        "keys": held[0],
        "lasts": lasts,
        "targets": held[1],
        "outputs": held[2],
        "starts": np.append(0, np.cumsum([len(o) for o in places])),
        "numbers": [n for output in places for n in output],
    }
    arrays = {name: np.asarray(arrays[name]).astype(kind) for name, kind in _ARRAYS.items()}
    head = np.array([len(x) for x in arrays.values()], "<i8")
    return head.tobytes() + b"".join(x.tobytes() for x in arrays.values())


class Lexicon:
    """A file of ``build``, mapped into memory."""

    def __init__(self, path: str | Path):
        at = 8 * len(_ARRAYS)
        for (name, kind), n in zip(_ARRAYS.items(), np.fromfile(path, "<i8", len(_ARRAYS)).tolist(), strict=True):
            array = np.memmap(path, kind, "r", at, n) if n else np.zeros(0, kind)
            setattr(self, name, array)
            at += array.nbytes

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words the lexicon holds, how many numbers each has (0 if not held), and the numbers of all, in their order."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, heads = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        state = np.full(len(words), len(self.lasts) - 1, np.uint64)
        held, said, on, step = np.zeros(len(words), bool), [], np.arange(len(words)), 0
        while len(on):
            ends = on[sizes[on] == step]
            last = self.lasts[state[ends]]
            held[ends[last >= 0]] = True
            said.append((ends[last >= 0], last[last >= 0]))
            on = on[sizes[on] > step]
            keys = state[on] << np.uint64(8) | data[heads[on] + step]
            at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            goes = self.keys[at] == keys if len(self.keys) else np.zeros(len(on), bool)
            on, at = on[goes], at[goes]
            state[on] = self.targets[at]
            said.append((on, self.outputs[at]))
            step += 1
        word, output = (np.concatenate(x) if said else np.zeros(0, np.int64) for x in (zip(*said, strict=True) if said else ((), ())))
        word, output = word[held[word]], output[held[word]]
        order = np.argsort(word, kind="stable")
        lengths = self.starts[output + 1] - self.starts[output]
        numbers = pretokens.gather(self.numbers, self.starts[output], lengths, order)
        return held, np.bincount(word, lengths, len(words)).astype(np.int64), numbers
