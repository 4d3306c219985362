"""Probabilistic automata from examples: state merging on a prefix tree (ALERGIA)."""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass, field

END = "$"


def symbols(token: str) -> str:
    """Characters by class: d digit, h a-f, l other lower case, U upper case, else itself."""
    return "".join(
        "d" if "0" <= c <= "9" else "h" if "a" <= c <= "f" else "l" if "a" <= c <= "z"
        else "U" if "A" <= c <= "Z" else c
        for c in token
    )


@dataclass
class _State:
    arrivals: int = 0
    ends: int = 0
    out: dict[str, int] = field(default_factory=dict)  # symbol -> state
    taken: dict[str, int] = field(default_factory=dict)  # symbol -> times


class Automaton:
    """A deterministic automaton whose edges and ends carry counts."""

    def __init__(self, states: list[_State], alphabet: int):
        self.states, self.alphabet = states, alphabet

    def log_likelihood(self, word: str) -> float:
        """Mean natural log probability per symbol, the end included.

        Probabilities are smoothed by one count spread over the alphabet and the end; a
        symbol without an edge leads back to the first state.
        """
        at, sum_, unit = 0, 0.0, 1 / (self.alphabet + 1)
        for c in word:
            state = self.states[at]
            sum_ += math.log((state.taken.get(c, 0) + unit) / (state.arrivals + 1))
            at = state.out.get(c, 0)
        state = self.states[at]
        sum_ += math.log((state.ends + unit) / (state.arrivals + 1))
        return sum_ / (len(word) + 1)


def prefix_tree(words: list[str]) -> list[_State]:
    states = [_State()]
    for word in words:
        at = 0
        states[0].arrivals += 1
        for c in word:
            state = states[at]
            state.taken[c] = state.taken.get(c, 0) + 1
            if c not in state.out:
                state.out[c] = len(states)
                states.append(_State())
            at = state.out[c]
            states[at].arrivals += 1
        states[at].ends += 1
    return states


def learn_automaton(words: list[str], alpha: float = 0.05, alphabet: int = 12) -> Automaton:
    """Merge states of the words' prefix tree whose futures are statistically alike.

    States are taken in breadth-first order; each is merged into the first settled
    state that passes Hoeffding's test on all continuations, or settled itself.
    """
    states = prefix_tree(words)
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(n1: int, of1: int, n2: int, of2: int) -> bool:
        return abs(n1 / of1 - n2 / of2) > bound * (1 / math.sqrt(of1) + 1 / math.sqrt(of2))

    def alike(a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            i, j = pairs.pop()
            p, q = states[i], states[j]
            if not p.arrivals or not q.arrivals:
                continue
            if differ(p.ends, p.arrivals, q.ends, q.arrivals):
                return False
            for c in p.taken.keys() | q.taken.keys():
                if differ(p.taken.get(c, 0), p.arrivals, q.taken.get(c, 0), q.arrivals):
                    return False
                if c in p.out and c in q.out and p.out[c] != i:
                    pairs.append((p.out[c], q.out[c]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below ``b`` to the automaton at ``a``."""
        pairs = [(a, b)]
        while pairs:
            i, j = pairs.pop()
            p, q = states[i], states[j]
            p.arrivals += q.arrivals
            p.ends += q.ends
            for c, n in q.taken.items():
                p.taken[c] = p.taken.get(c, 0) + n
                if c in p.out:
                    pairs.append((p.out[c], q.out[c]))
                else:
                    p.out[c] = q.out[c]

    settled, waiting = [0], deque((0, c) for c in sorted(states[0].out))
    while waiting:
        source, c = waiting.popleft()
        target = states[source].out[c]
        if target in settled:
            continue
        for kept in settled:
            if alike(kept, target):
                states[source].out[c] = kept
                before = {s: set(states[s].out) for s in settled}
                fold(kept, target)
                waiting.extend(
                    (s, x)
                    for s in settled
                    for x in sorted(states[s].out.keys() - before[s])
                )
                break
        else:
            settled.append(target)
            waiting.extend((target, x) for x in sorted(states[target].out))
    number = {s: i for i, s in enumerate(settled)}
    final = []
    for s in settled:
        state = states[s]
        out = {c: number[t] for c, t in state.out.items() if t in number}
        final.append(_State(state.arrivals, state.ends, out, state.taken))
    return Automaton(final, alphabet)
