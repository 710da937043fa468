"""Least-cost edits that make a sequence of roles alternate: cost vectors, their fix-up, and least audits.

States of the repaired roles so far: 0 none, 1 a system turn, 2 ended by a user turn, 3 ended by an
assistant turn. A cost vector holds the least cost still to come from each state.
A row's code is its role's initial (0 s, 1 u, 2 a, 3 other), plus 4 if its text is truncated.
"""

from __future__ import annotations

#: Costs of inserting or changing a role, of deleting, and one beyond all others.
CHANGE, DELETE, FAR = 2, 3, 1 << 40
#: State after a turn of the role that may follow in each state, which is user but after a user turn.
FOLLOWS = (2, 2, 3, 2)
#: State after keeping a row of each initial in each state; -1 where it may not stand.
KEEPS = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
#: Code of a row that must go.
GONE = 8

Vector = tuple[int, int, int, int]


def with_insertions(v: Vector) -> Vector:
    """The vector where turns may be inserted first."""
    a, b, c, d = v
    c, d = min(c, d + CHANGE), min(d, c + CHANGE)
    return min(a, c + CHANGE), min(b, c + CHANGE), c, d


#: Costs at the end of a conversation, which is empty or ends with an assistant turn.
END: Vector = with_insertions((0, FAR, FAR, 0))


def before(code: int, v: Vector) -> Vector:
    """The vector before a row, given that after it: the row is kept, changed or deleted."""
    keeps, more = KEEPS[code & 3], code >> 2
    return with_insertions(tuple(min(DELETE + v[s], CHANGE + more + v[FOLLOWS[s]], more + v[keeps[s]] if keeps[s] >= 0 else FAR) for s in range(4)))


def level(v: Vector) -> Vector:
    """The vector less a constant; vectors that differ only by one become equal."""
    return tuple(x - v[3] for x in v)


#: Levelled vectors are few, so each is computed once a code.
_STEPS: dict[tuple[int, Vector], Vector] = {}


def _step(code: int, v: Vector) -> Vector:
    found = _STEPS.get((code, v))
    if found is None:
        found = _STEPS[code, v] = level(before(code, v))
    return found


def backward(codes: bytes, v: Vector) -> Vector:
    """The levelled vector before a chunk of rows, given the levelled one after it."""
    for code in reversed(codes):
        v = _step(code, v)
    return v


def fixed_up(codes: bytes, new: Vector, old: Vector, old_out: Vector) -> Vector:
    """``backward(codes, new)``, given that ``old`` led to ``old_out``: ends where both differ only by a constant."""
    for code in reversed(codes):
        if new == old:
            return old_out
        new, old = _step(code, new), _step(code, old)
    return new


def matrix(codes: bytes) -> list[int]:
    """Least cost from each state before a chunk to each after it, row by row."""
    columns = []
    for j in range(4):
        v = with_insertions(tuple(0 if s == j else FAR for s in range(4)))
        for code in reversed(codes):
            v = before(code, v)
        columns.append(v)
    return [min(columns[j][s], FAR) for s in range(4) for j in range(4)]


def trace(codes: bytes, v: Vector, state: int) -> tuple[list[str], int]:
    """The ASCII-least cheapest edits of each row from a state, and the state after them; ``v`` is the vector after the chunk.

    A letter and a state give the next state, and a letter's cost is the row's, so the least
    letter that stays cheapest at every place gives the least audit.
    """
    vectors = [v]
    for code in reversed(codes):
        vectors.append(_step(code, vectors[-1]))
    out = []
    for i, code in enumerate(codes):
        after = vectors[len(codes) - 1 - i]
        keeps, more, letters = KEEPS[code & 3], code >> 2, ""
        here = before(code, after)
        while True:
            if DELETE + after[state] == here[state]:
                letters += "D"
            elif CHANGE + here[FOLLOWS[state]] == here[state]:
                letters, state = letters + "I", FOLLOWS[state]
                continue
            elif keeps[state] >= 0 and more + after[keeps[state]] == here[state]:
                letters, state = letters + "K", keeps[state]
            else:
                letters, state = letters + "R", FOLLOWS[state]
            break
        out.append(letters)
    return out, state


def ending(state: int) -> str:
    """Insertions after the last row."""
    return ("", "II", "I", "")[state]
