"""Cheapest edits that give a conversation a valid structure, as audits.

An audit is one initial per edit (Delete, Insert, Keep, Rerole); of the cheapest ones the least in
ASCII order counts.  ``solve`` is a dynamic program over rows whose states are places in the role
pattern ``(s?(ua)+)?``; each state holds its cheapest audit as a node of a persistent store, where
audits share their prefixes.  Of two audits with the same cost the one is less whose first differing
initial is less: that place is searched for by binary lifting over rolling hashes, and what the hashes
call equal is verified.

No audit compared with another is a proper prefix of it: the longer one would have more inserts, and
so another cost.

Long conversations are solved in pieces of rows, from every state that a piece may be entered in;
``Chain`` puts the pieces together.
"""

from __future__ import annotations

from typing import NamedTuple

# places in the pattern: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)

# kinds of roles by their initials
ROLES = ("s", "u", "a")
OTHER = len(ROLES)

# faults of rows
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
#: What a truncated row adds if it stays.
TRUNCATED_COST = 5

#: Where a role of each kind leads to; None where it may not stand.
_AFTER = {
    START: (SYSTEM, USER, None, None),
    SYSTEM: (None, USER, None, None),
    USER: (None, None, ASSISTANT, None),
    ASSISTANT: (None, USER, None, None),
}
#: Where a user or an assistant, whichever may follow, leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Audits as linked nodes: each extends another one by an initial, node 0 is the empty one.

    A node knows its ancestors 1, 2, 4, ... steps back and the hash of its whole audit.
    """

    def __init__(self, modulus: int = _MODULUS) -> None:
        self.modulus = modulus
        self.initial = [""]
        self.length = [0]
        self.hash = [0]
        self.ancestors: list[list[int]] = [[]]

    def extended(self, node: int, initial: str) -> int:
        up, at = [node], 0
        while at < len(self.ancestors[up[-1]]):
            up.append(self.ancestors[up[-1]][at])
            at += 1
        self.initial.append(initial)
        self.length.append(self.length[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(initial)) % self.modulus)
        self.ancestors.append(up)
        return len(self.initial) - 1

    def cut(self, node: int, length: int) -> int:
        """The first ``length`` initials of an audit."""
        while self.length[node] > length:
            step = (self.length[node] - length).bit_length() - 1
            node = self.ancestors[node][step]
        return node

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        short = min(self.length[a], self.length[b])
        a, b = self.cut(a, short), self.cut(b, short)
        if self.hash[a] == self.hash[b]:
            return self._verified(a, b)
        for step in reversed(range(len(self.ancestors[a]))):
            if step < len(self.ancestors[a]):
                above_a, above_b = self.ancestors[a][step], self.ancestors[b][step]
                if self.hash[above_a] != self.hash[above_b]:
                    a, b = above_a, above_b
        return self._verified(self.ancestors[a][0], self.ancestors[b][0])

    def _verified(self, a: int, b: int) -> int:
        """The longest common prefix of two audits with the same hash and length."""
        same = self.length[a]
        while a != b:
            if self.initial[a] != self.initial[b]:
                same = self.length[a] - 1
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        return same

    def less(self, a: int, b: int) -> bool:
        """Whether an audit comes before another one in ASCII order."""
        same = self.common(a, b)
        if same == self.length[a] or same == self.length[b]:
            return self.length[a] < self.length[b]
        return self.initial[self.cut(a, same + 1)] < self.initial[self.cut(b, same + 1)]

    def text(self, node: int) -> str:
        found = []
        while node:
            found.append(self.initial[node])
            node = self.ancestors[node][0]
        return "".join(reversed(found))


class Best(NamedTuple):
    cost: int
    audit: int


def _offer(audits: Audits, held: dict[int, Best], state: int, cost: int, parent: int, initial: str) -> None:
    """Hold an extended audit if it is cheaper than the state's, or as cheap and less."""
    known = held.get(state)
    if known is None or cost < known.cost:
        held[state] = Best(cost, audits.extended(parent, initial))
    elif cost == known.cost:
        node = audits.extended(parent, initial)
        if audits.less(node, known.audit):
            held[state] = Best(cost, node)


def _with_inserts(audits: Audits, held: dict[int, Best]) -> dict[int, Best]:
    """States that inserts lead to.  Two in a row at most are of use: more come back to a state."""
    before = dict(held)
    for state in (START, SYSTEM, ASSISTANT):
        if state in before:
            _offer(audits, held, USER, before[state].cost + COST[INSERT], before[state].audit, INSERT)
    if USER in held:
        _offer(audits, held, ASSISTANT, held[USER].cost + COST[INSERT], held[USER].audit, INSERT)
    return held


def solve(kinds: bytes, faults: bytes, entered: int, modulus: int = _MODULUS) -> dict[int, tuple[int, str]]:
    """Cost and audit of the cheapest edits of some rows, for each state they may end in."""
    audits = Audits(modulus)
    held = _with_inserts(audits, {entered: Best(0, 0)})
    for kind, fault in zip(kinds, faults, strict=True):
        after: dict[int, Best] = {}
        for state, (cost, node) in held.items():
            _offer(audits, after, state, cost + COST[DELETE], node, DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            kept = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
            to = _AFTER[state][kind]
            if to is not None:
                _offer(audits, after, to, kept + COST[KEEP], node, KEEP)
            _offer(audits, after, NEXT[state], kept + COST[REROLE], node, REROLE)
        held = _with_inserts(audits, after)
    return {state: (cost, audits.text(node)) for state, (cost, node) in held.items()}


class Chain:
    """Pieces of one conversation put together, in order.

    Of the audits that lead to the states so far it keeps costs and how they compare: a rank, equal for
    audits of which one extends the other, and what the longer ones have more (inserts only).  The
    pieces' parts are kept for the end: a byte for each edit, as the audit itself has.
    """

    def __init__(self) -> None:
        self.held: dict[int, tuple[int, int, str]] = {START: (0, 0, "")}
        self.parts: list[dict[int, tuple[int, str]]] = []

    def add(self, piece: dict[int, dict[int, tuple[int, str]]]) -> None:
        """``piece[entered][ended]`` is a cost and a part of the audit."""
        best: dict[int, tuple[int, int, str]] = {}
        came: dict[int, tuple[int, str]] = {}
        for entered, (cost, rank, more) in self.held.items():
            for ended, (added, part) in piece[entered].items():
                offer = (cost + added, rank, more + part)
                if ended not in best or offer < best[ended]:
                    best[ended], came[ended] = offer, (entered, part)
        self.parts.append(came)
        self.held, rank, base = {}, -1, None
        for ended, (cost, old, audit) in sorted(best.items(), key=lambda x: x[1][1:]):
            if base is None or old != base[0] or not audit.startswith(base[1]):
                base, rank = (old, audit), rank + 1
            self.held[ended] = (cost, rank, audit[len(base[1]) :])

    def ended(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        cost, _, _, state = min((*self.held[state], state) for state in ACCEPTED if state in self.held)
        found = []
        for came in reversed(self.parts):
            state, part = came[state]
            found.append(part)
        return cost, "".join(reversed(found))
