"""The repair grammar of dialogues in Chomsky normal form, and its weighted interval parsing.

A repaired dialogue has role initials ``(s?(ua)+)?``. The grammar has one symbol for every two states
of that pattern's automaton, "these rows, edited, lead from p to q":

    pq -> pr rq        two spans side by side
    pq -> row          keep, rerole or delete one row
    pq -> (nothing)    insertions alone; the insertion closure folds them into the rows beside them

A cell is the least (cost, audit) of a symbol over a span, audits compared as text. Two different
audits of one span and one cost are never one the beginning of the other (what is left over would be
insertions, which cost), so the least of a whole is put together from the least of its parts. Every
split of a span gives the same cells, so each span is made from its two halves: spans of one row,
then two, four, and so on.
"""

from __future__ import annotations

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after the instruction, after a user, after an assistant; ends are 0 and 3.
STATES, ENDS = range(4), (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}
Cells = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cells, right: Cells) -> Cells:
    out: Cells = {}
    for (p, r), (c1, a1) in left.items():
        for q in STATES:
            found = right.get((r, q))
            if found is not None:
                cell = (c1 + found[0], a1 + found[1])
                if (p, q) not in out or cell < out[p, q]:
                    out[p, q] = cell
    return out


def _insertions() -> Cells:
    once: Cells = {(p, q): (INSERT, "I") for (p, role), q in STEPS.items() if role in NAMES}
    closure: Cells = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for key, cell in combine(closure, once).items():
            closure[key] = min(cell, closure.get(key, cell))
    return closure


CLOSURE = _insertions()
_ROWS: dict[tuple, Cells] = {}


def row_cells(initial: str, must_go: bool, truncated: bool) -> Cells:
    """Cells of one row, closed under insertions before and after it."""
    key = (initial if initial in ("s", "u", "a") else "", must_go, truncated)
    if key not in _ROWS:
        cells: Cells = {(p, p): (DELETE, "D") for p in STATES}
        if not must_go:
            extra = TRUNCATED if truncated else 0
            for (p, role), q in STEPS.items():
                if role == initial:
                    cells[p, q] = (KEEP + extra, "K")
                elif role in NAMES:
                    cells[p, q] = (REROLE + extra, "R")
        _ROWS[key] = combine(combine(CLOSURE, cells), CLOSURE)
    return _ROWS[key]


def fold(spans: list[Cells]) -> Cells:
    """Cells of neighbouring spans to those of their union, by spans of growing length."""
    if not spans:
        return dict(CLOSURE)
    while len(spans) > 1:
        spans = [combine(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def best(cells: Cells) -> tuple[int, str]:
    return min(cells[0, q] for q in ENDS if (0, q) in cells)


def apply(audit: str, rows: list[tuple[str, str]], state: int) -> tuple[list[tuple[str, str]], int]:
    """The repaired (role, text) of a slice of edits over its rows, and the state behind it."""
    out, at = [], 0
    for edit in audit:
        if edit == "I":
            role, text = NAMES[_next(state)], ""
        else:
            role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = NAMES[_next(state)]
        state = STEPS[state, role[:1]]
        out.append((role, text))
    return out, state


def _next(state: int) -> str:
    return "a" if state == 2 else "u"


def slices(audit: str, lengths: list[int]) -> list[tuple[str, int]]:
    """The edits of consecutive spans of so many rows, each with the number of outputs before it; insertions go left."""
    out, at, made = [], 0, 0
    for i, n in enumerate(lengths):
        begin, before = at, made
        while at < len(audit) and (n > 0 or audit[at] == "I" or i == len(lengths) - 1):
            n -= audit[at] != "I"
            made += audit[at] != "D"
            at += 1
        out.append((audit[begin:at], before))
    return out
