"""Cheapest edits of role sequences: min-plus matrices over a four-state machine, and grammars that share them.

A row is a symbol: the class of its role (system, user, assistant, other) and its fault. The machine reads what a
repaired conversation may look like, ``(s?(ua)+)?``: nothing yet, after system, after user, after assistant. The matrix of a symbol
holds, for every two states, the least cost of getting from one to the other over that row (inserted rows first, then one
edit of the row), and the ASCII-least audit of that cost. As every audit of a stretch ends in the edit of its last row and holds
one such edit for each row, none is a prefix of another of the same stretch: so the least of two stays least whatever is put before or behind
both, and matrices may be multiplied in any grouping.

Audits are ropes: a node is a letter or two nodes, with its length and a hash, so that equal parts are skipped in a
comparison and a rule's audits are shared by all that use it.

A grammar is a list of Re-Pair rules; each stands for two symbols, earlier rules among them. Its matrices are evaluated
from the first rule on. Sequences are strings, so a rule is applied by ``str.replace``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

CLASSES = "sua"  # initials of roles that may be kept; any other is class 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
FIRST = ord("A")
RULES_FROM = 0x100
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
STATES = range(4)  # nothing yet, after system, after user, after assistant
ACCEPTED = (0, 3)
#: State after a role of class 0, 1, 2 from each state; None where it may not follow.
NEXT = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def symbol(role: str, fault: int) -> str:
    """The symbol of a row."""
    kind = CLASSES.find(role[:1]) if role else 3
    return chr(FIRST + 4 * (kind if kind >= 0 else 3) + fault)


def class_of(sign: str) -> int:
    return (ord(sign) - FIRST) >> 2


def fault_of(sign: str) -> int:
    return (ord(sign) - FIRST) & 3


class Ropes:
    """Strings as trees in flat lists; node 0 is the empty string."""

    def __init__(self):
        self.left, self.right, self.size, self.hash, self.letter = [0], [0], [0], [0], [""]

    def leaf(self, letter: str) -> int:
        return self._add(0, 0, 1, ord(letter), letter)

    def _add(self, left: int, right: int, size: int, code: int, letter: str) -> int:
        for column, value in zip((self.left, self.right, self.size, self.hash, self.letter), (left, right, size, code, letter)):
            column.append(value)
        return len(self.size) - 1

    def join(self, a: int, b: int) -> int:
        if not a or not b:
            return a or b
        code = (self.hash[a] * pow(_BASE, self.size[b], _PRIME) + self.hash[b]) % _PRIME
        return self._add(a, b, self.size[a] + self.size[b], code, "")

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        mine, other = [a], [b]
        while mine and other:
            x, y = mine.pop(), other.pop()
            if x == y or (self.size[x] == self.size[y] and self.hash[x] == self.hash[y]):
                continue
            if self.size[x] >= self.size[y] and self.size[x] > 1:
                mine += (self.right[x], self.left[x])
                other.append(y)
            elif self.size[y] > 1:
                other += (self.right[y], self.left[y])
                mine.append(x)
            else:
                return self.letter[x] < self.letter[y]
        return bool(other)

    def text(self, node: int) -> str:
        out, rest = [], [node]
        while rest:
            x = rest.pop()
            if self.letter[x]:
                out.append(self.letter[x])
            elif x:
                rest += (self.right[x], self.left[x])
        return "".join(out)

    def cut(self, size: int) -> None:
        """Forget the nodes from ``size`` on."""
        for column in (self.left, self.right, self.size, self.hash, self.letter):
            del column[size:]

    def __len__(self) -> int:
        return len(self.size)


class Algebra:
    """Matrices of symbols and rules; an entry is (cost, rope) or None."""

    def __init__(self, rules: list[str] = ()):
        self.ropes = Ropes()
        letters = {c: self.ropes.leaf(c) for c in COSTS}
        inserts = [0, letters["I"], self.ropes.join(letters["I"], letters["I"])]
        self.closing = [[None] * 4 for _ in STATES]
        for p in STATES:
            for n, q in self._inserted(p):
                self.closing[p][q] = (n * COSTS["I"], inserts[n])
        self.of: dict[str, list] = {}
        for kind in range(4):
            for fault in range(4):
                edits = self._edits(kind, fault, letters)
                self.of[chr(FIRST + 4 * kind + fault)] = self.times(self.closing, edits)
        self.rules = list(rules)
        for i, (a, b) in enumerate(self.rules):
            self.of[chr(RULES_FROM + i)] = self.times(self.of[a], self.of[b])
        self.kept = len(self.ropes)

    @staticmethod
    def _inserted(p: int) -> list[tuple[int, int]]:
        """(rows, state): states that inserted users and assistants lead to, by the fewest."""
        return [(0, 0), (1, 2), (2, 3)] if p == 0 else [(0, 1), (1, 2), (2, 3)] if p == 1 else [(0, p), (1, 5 - p)]

    def _edits(self, kind: int, fault: int, letters: dict[str, int]) -> list:
        out = [[None] * 4 for _ in STATES]
        for p in STATES:
            choices = [(p, "D", COSTS["D"])]
            if fault in (FINE, TRUNCATED):
                late = int(fault == TRUNCATED)
                if kind < 3:
                    choices.append((NEXT[p][kind], "K", COSTS["K"] + late))
                choices += [(NEXT[p][new], "R", COSTS["R"] + late) for new in (1, 2)]
            for q, letter, cost in choices:
                if q is not None:
                    out[p][q] = self._least(out[p][q], (cost, letters[letter]))
        return out

    def _least(self, a, b):
        if a is None or b is None:
            return a or b
        if a[0] != b[0]:
            return a if a[0] < b[0] else b
        return b if self.ropes.less(b[1], a[1]) else a

    def _row(self, row: list, m: list) -> list:
        """A row of a product: the least over the states between."""
        out = []
        for q in STATES:
            paths = [(row[r][0] + m[r][q][0], r) for r in STATES if row[r] and m[r][q]]
            if not paths:
                out.append(None)
                continue
            cost = min(paths)[0]
            best = None
            for c, r in paths:
                if c == cost:
                    best = self._least(best, (c, self.ropes.join(row[r][1], m[r][q][1])))
            out.append(best)
        return out

    def times(self, a: list, b: list) -> list:
        return [self._row(row, b) for row in a]

    def shorten(self, symbols: str) -> str:
        """Symbols with the rules applied, first to last."""
        for i, pair in enumerate(self.rules):
            if pair in symbols:
                symbols = symbols.replace(pair, chr(RULES_FROM + i))
        return symbols

    def cheapest(self, symbols: str) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits that make a conversation of these rows legal."""
        row: list = [(0, 0), None, None, None]
        for sign in self.shorten(symbols):
            row = self._row(row, self.of[sign])
        return self._finished(self.close(row))

    def close(self, row: list):
        """The best end: what is left open is closed by inserted rows."""
        best = None
        closed = self._row(row, self.closing)
        for q in ACCEPTED:
            best = self._least(best, closed[q])
        return best

    def _finished(self, entry) -> tuple[int, str]:
        cost, text = entry[0], self.ropes.text(entry[1])
        self.ropes.cut(self.kept)
        return cost, text

    def matrix(self, symbols: str) -> tuple[list[int | None], list[str | None]]:
        """(costs, audits), state by state: the matrix of a part of a conversation."""
        short = self.shorten(symbols)
        m = self.of[short[0]]
        for sign in short[1:]:
            m = self.times(m, self.of[sign])
        flat = [e for row in m for e in row]
        out = [e and e[0] for e in flat], [None if e is None else self.ropes.text(e[1]) for e in flat]
        self.ropes.cut(self.kept)
        return out


Matrix = tuple[list, list]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    """Product of two matrices whose audits are spelled out."""
    costs, audits = [], []
    for p in STATES:
        for q in STATES:
            paths = [
                (a[0][4 * p + r] + b[0][4 * r + q], r) for r in STATES if a[0][4 * p + r] is not None and b[0][4 * r + q] is not None
            ]
            least = min(paths)[0] if paths else None
            costs.append(least)
            audits.append(min((a[1][4 * p + r] + b[1][4 * r + q] for c, r in paths if c == least), default=None))
    return costs, audits


def product(parts: list[Matrix]) -> Matrix:
    """Product of matrices in order, by halves, so that long audits are copied few times."""
    while len(parts) > 1:
        parts = [multiply(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def finish(m: Matrix) -> tuple[int, str]:
    """(cost, audit) of a whole conversation from the product of its parts."""
    algebra = Algebra()
    best = []
    for q in STATES:
        for end in ACCEPTED:
            close = algebra.closing[q][end]
            if m[0][q] is not None and close:
                best.append((m[0][q] + close[0], m[1][q] + algebra.ropes.text(close[1])))
    return min(best)


def pair_counts(algebra: Algebra, sequences: Iterable[tuple[str, int]]) -> Counter:
    """Weighted counts of adjacent symbols in shortened sequences."""
    counts: Counter = Counter()
    for symbols, n in sequences:
        short = algebra.shorten(symbols)
        for pair in map("".join, zip(short, short[1:])):
            counts[pair] += n
    return counts
