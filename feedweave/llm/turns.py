"""Alignment of turns with the alternating grammar ``(s?(ua)+)?`` of role initials.

Wagner and Fischer's table, filled from the end: the strings of the grammar's feasible lengths that
end alike are suffixes of one another, so the row of a turn holds the cost against each length at
once. An incumbent's cost bounds how far a cheaper alignment's remaining length can be from the
number of remaining turns (Ukkonen's band: five a letter inserted, two a turn deleted), and only that
much of a row is filled. The audits of all lengths of least cost are traced back and compared.

A long conversation is aligned in blocks: for each state of the grammar before and after a block, the
cheapest edits. An insertion stands before a turn of its block, or behind the last block's, so the
audits of one block all end with a turn and none is the beginning of another; the least audit of the
whole is then made of least audits of its parts.
"""

from __future__ import annotations

import numpy as np

#: States of the grammar: nothing yet, behind s, behind u, behind a. It may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A turn's code: which of s, u, a its role begins with (3: none), and what is wrong with it.
OTHER, MUST_GO, CUT_OFF = 3, 4, 8
FAR = 1 << 29


def successor(state: int) -> int:
    """The state behind the next letter other than s."""
    return ASSISTANT if state == USER else USER


def greedy_cost(codes: list[int]) -> int:
    """The cost of going through the turns once: an alignment of a whole conversation, so an upper bound."""
    state, cost = START, 0
    for code in codes:
        fits = code & 3 == 0 and state == START or code & 3 == successor(state) - 1
        if code & (MUST_GO | CUT_OFF):
            cost += DELETE
        elif fits:
            state = SYSTEM if code & 3 == 0 else successor(state)
        else:
            cost, state = cost + REROLE, successor(state)
    return min(cost + INSERT * {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state], DELETE * len(codes))


class Table:
    """Costs of aligning the turns from each one on with the last letters of strings that end in ``end``."""

    def __init__(self, codes: list[int], end: int, last: bool, incumbent: int):
        self.codes, self.end, self.last = codes, end, last
        self.rows: list[np.ndarray] = []
        self.lows: list[int] = []
        n = len(codes)
        self.above, self.below = incumbent // INSERT, incumbent // DELETE
        row = INSERT * np.arange(self.above + 1) if last else np.append(0, np.full(self.above, FAR))
        self.rows, self.lows = [row], [0]
        for i in range(n - 1, -1, -1):
            self._add(codes[i], n - i)
        self.rows.reverse()
        self.lows.reverse()

    def _add(self, code: int, left: int) -> None:
        low, high = max(0, left - self.below), left + self.above
        behind, at = self.rows[-1], self.lows[-1]
        padded = np.full(high - low + 2, FAR, np.int64)  # lengths low - 1 to high of the row behind
        a, b = max(at, low - 1), min(at + len(behind), high + 1)
        padded[a - low + 1:b - low + 1] = behind[a - at:b - at]
        row = padded[1:] + DELETE
        if not code & MUST_GO:
            row = np.minimum(row, padded[:-1] + self._match(code)[np.arange(low, high + 1) % 2])
        steps = INSERT * np.arange(len(row))
        self.rows.append(np.minimum.accumulate(row - steps) + steps)
        self.lows.append(low)

    def _match(self, code: int) -> np.ndarray:
        """The cost of taking a turn for the next letter, for an even and an odd number of letters left."""
        odd = self.end  # the letter that is last, and third last, ...
        even = USER + ASSISTANT - odd
        kept = TRUNCATED if code & CUT_OFF else 0
        return np.array([kept + (REROLE if code & 3 != letter - 1 else 0) for letter in (even, odd)])

    def cost(self, i: int, left: int) -> int:
        at = left - self.lows[i]
        return int(self.rows[i][at]) if 0 <= at < len(self.rows[i]) else FAR

    def audit(self, i: int, left: int) -> str:
        """The least string of edits of the least cost from turn ``i`` with ``left`` letters on."""
        edits, n = [], len(self.codes)
        while i < n or left:
            cost = self.cost(i, left)
            if i < n and self.cost(i + 1, left) + DELETE == cost:
                edits.append("D")
                i += 1
            elif left and (i < n or self.last) and self.cost(i, left - 1) + INSERT == cost:
                edits.append("I")
                left -= 1
            else:
                letter = self.end if left % 2 else USER + ASSISTANT - self.end
                edits.append("K" if self.codes[i] & 3 == letter - 1 else "R")
                i, left = i + 1, left - 1
        return "".join(edits)


def _least(found: list[tuple[int, str]]) -> tuple[int, str] | None:
    return min((x for x in found if x[0] < FAR), default=None)


def _through(table: Table, before: int) -> tuple[int, str] | None:
    """The least cost and audit from state ``before`` to the table's end, over every feasible length."""
    n, end = len(table.codes), table.end
    first_is_end = successor(before) == end
    low = 0 if before == end else 1
    lengths = [m for m in range(max(table.lows[0], low), table.lows[0] + len(table.rows[0])) if (m % 2 == 1) == first_is_end]
    costs = [(table.cost(0, m), m, -1) for m in lengths]
    if before == START:  # or s first, on a turn whose predecessors go: the later, the less its audit
        for i in range(n - 1, -1, -1):
            code = table.codes[i]
            if code & 3 == 0 and not code & MUST_GO:
                head = DELETE * i + (TRUNCATED if code & CUT_OFF else 0)
                at = table.lows[i + 1]
                costs += [(head + int(c), m, i) for m, c in enumerate(table.rows[i + 1], at) if m and (m % 2 == 1) == first_is_end]
    best = min((c for c, _, _ in costs), default=FAR)
    seen: set[int] = set()
    audits = []
    for cost, m, i in costs:
        if cost == best and not (i >= 0 and m in seen):
            audits.append((cost, table.audit(0, m) if i < 0 else "D" * i + "K" + table.audit(i + 1, m)))
            if i >= 0:
                seen.add(m)
    return _least(audits)


def align(codes: list[int], first: bool = True, last: bool = True) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state behind): the least cost, and of the audits of that cost the least, of a block of turns."""
    n, result = len(codes), {}
    befores = [START] if first else [START, SYSTEM, USER, ASSISTANT]
    ends = [ASSISTANT] if last else [USER, ASSISTANT]
    incumbent = greedy_cost(codes) if first and last else DELETE * n + 2 * INSERT
    for end in ends:
        table = Table(codes, end, last, incumbent)
        for before in befores:
            result[before, end] = _through(table, before)
    for state in befores:
        if state in (START, SYSTEM) and not (last and state == SYSTEM):
            result[state, state] = (DELETE * n, "D" * n)
    if not last:
        single = [
            (DELETE * (n - 1) + (TRUNCATED if code & CUT_OFF else 0), "D" * i + "K" + "D" * (n - 1 - i))
            for i, code in enumerate(codes) if code & 3 == 0 and not code & MUST_GO
        ]
        result[START, SYSTEM] = _least(single)
    return {states: found for states, found in result.items() if found is not None}


def compose(blocks: list[dict[tuple[int, int], tuple[int, str]]]) -> list[tuple[int, int, str]]:
    """(state before, cost, audit) for each block of a conversation, of the least cost and then the least audit.

    Audits that lead to different states differ, and none is the beginning of another, so their
    order is that of the first block in which they differ: a rank stands for the whole.
    """
    reached = {START: (0, 0)}  # state: cost, rank of its audit
    steps: list[dict[int, tuple[int, int, str]]] = []
    for block in blocks:
        best: dict[int, tuple] = {}
        for (before, behind), (cost, audit) in block.items():
            if before in reached:
                offer = (reached[before][0] + cost, reached[before][1], audit, before, cost)
                if behind not in best or offer < best[behind]:
                    best[behind] = offer
        order = sorted(best, key=lambda state: best[state][1:3])
        reached = {state: (best[state][0], order.index(state)) for state in best}
        steps.append({state: (offer[3], offer[4], offer[2]) for state, offer in best.items()})
    state = min((s for s in reached if s in (START, ASSISTANT)), key=lambda s: reached[s])
    path = []
    for step in reversed(steps):
        before, cost, audit = step[state]
        path.append((before, cost, audit))
        state = before
    return path[::-1]


def edits(codes: list[int], before: int, audit: str) -> list[tuple[str, int | None, str | None]]:
    """(edit, the turn it takes, its new role) of each edit of a block: a new role for R and I only."""
    state, at, result = before, 0, []
    for edit in audit:
        role = None
        if edit in "KRI":
            state = SYSTEM if edit == "K" and codes[at] & 3 == 0 and state == START else successor(state)
            if edit != "K":
                role = "user" if state == USER else "assistant"
        result.append((edit, None if edit == "I" else at, role))
        at += edit != "I"
    return result
