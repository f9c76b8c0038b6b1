"""How many tables the customers of a dish sit at, drawn for all of them at once.

Given the rest of its restaurant, a dish of ``c`` customers sits at ``t`` tables in proportion to ``m**t * S(c, t)``, where m is
the weight of a new table and S counts the seatings of c customers at t tables, a table of n weighing (1-d)(2-d)..(n-1-d).
So one draw takes all customers of the dish from their tables and seats them anew, which one customer after the other would
do only after many rounds of the dish.

For up to ``LISTED`` customers the ratios of S are listed and the draw is exact: terms are added up for all dishes at once, t by t,
until those that are left no longer change a sum. For more, S is an integral: d**t * S(c, t) * t! / c! is the
coefficient of z**c in (1 - (1-z)**d)**t, taken along a curve through the saddle point, and t takes ``STEPS`` Metropolis steps;
its cost does not grow with c.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

LISTED = 1_500
STEPS = 4
#: Nodes of the integral on one half of its curve; how far they reach.
NODES, REACH = 64, 4.0
#: Numbers held at once.
CELLS = 2_000_000
#: Weights up to this, times the discount, keep sums within the range of doubles. ``LISTED`` terms of this share of a sum leave it as it is.
PLAIN, NOTHING = 600.0, 2.0**-64


@lru_cache(maxsize=2)
def ratios(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """S(c, t) / S(c, t - 1) in row t and column c, for 2 <= t <= c <= ``LISTED``, zero beyond; the largest beyond row 8 k in row k.

    From S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t), divided by S(c, t - 1): only sums and quotients of positive numbers.
    """
    out = np.zeros((LISTED + 1, LISTED + 1))
    row, t = np.zeros(LISTED + 2), np.arange(LISTED + 2)  # of one c, by t
    for c in range(1, LISTED):
        part = t[2 : c + 2]
        above = 1 + (c - discount * part) * row[2 : c + 2]
        below = c - discount * (part - 1)
        below[1:] += 1 / row[2 : c + 1]
        row[2 : c + 2] = above / below
        out[2 : c + 2, c + 1] = row[2 : c + 2]
    largest = np.maximum.reduceat(out, np.arange(1, LISTED + 1, 8), axis=0)
    return out, np.maximum.accumulate(largest[::-1], axis=0)[::-1]


def _solved(rising, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where a rising function of each row crosses zero, between two positive bounds."""
    low, high = np.log(low), np.log(high)
    for _ in range(40):
        middle = (low + high) / 2
        over = rising(np.exp(middle)) > 0
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    return np.exp((low + high) / 2)


def log_coefficient(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log of the coefficient of z**c in (1 - (1-z)**d)**t, for 1 <= t <= c and large c.

    With z = exp(-s) the curve of s is a parabola around the cut, or a line where the saddle is far from it.
    """
    out = np.empty(len(c))
    for at in range(0, len(c), max(1, CELLS // (4 * NODES))):
        part = slice(at, at + max(1, CELLS // (4 * NODES)))
        out[part] = _log_coefficient(c[part].astype(float), t[part].astype(float), discount)
    return out


def _log_coefficient(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    def falls(s):  # minus the derivative of t log f(exp(-s)), per customer
        z, w = np.exp(-s), -np.expm1(-s)
        return t * d * w ** (d - 1) * z / -np.expm1(d * np.log(w))

    saddle = _solved(lambda s: c - falls(s), np.full(len(c), 1e-12), np.full(len(c), 40.0))
    s0 = np.maximum(saddle, 3.0 / c)
    round_cut = s0 <= 1
    step = 1e-4 * s0
    bend = np.maximum((falls(s0 - step) - falls(s0 + step)) / (2 * step), 1e-12)  # the second derivative
    wide = np.where(round_cut, 1 / np.sqrt(c * s0), 1 / np.sqrt(bend))[:, None]
    h = REACH / NODES
    x = np.arange(NODES) * h
    y, dy = wide * np.sinh(x), wide * np.cosh(x)
    flat = (~round_cut & (9 * wide[:, 0] > np.pi))[:, None]  # nearly all customers alone: once around the circle, evenly
    y, dy = np.where(flat, np.pi * np.arange(NODES) / (NODES - 1), y), np.where(flat, np.pi / (NODES - 1) / h, dy)
    parabola, at0 = round_cut[:, None], s0[:, None]
    s = np.where(parabola, at0 * (1 + 1j * y) ** 2, at0 + 1j * y)
    ds = np.where(parabola, 2 * at0 * (1 + 1j * y), 1.0) * dy
    ds[:, 0] /= 2
    ds[:, -1] /= 2
    inside = s.imag <= np.pi * (1 + 1e-12)
    inside &= (t < c)[:, None]
    grown = t[:, None] * np.log(-np.expm1(d * np.log(-np.expm1(-s)))) + c[:, None] * s
    top = grown[:, 0].real
    value = np.exp(np.where(inside, grown - top[:, None], -np.inf)) * ds
    alone = t == c  # each at a table of its own: one way only
    total = np.where(alone, 1.0, value.real.sum(axis=1) * h / np.pi)
    return np.where(alone, c * np.log(d), top + np.log(total))


def _drawn_plainly(c: np.ndarray, m: np.ndarray, drawn: np.ndarray, discount: float) -> np.ndarray:
    """t in proportion to m**t * S(c, t), at the share ``drawn`` of the sum of all t; c never rises.

    Terms are taken relative to the first. Once one is below ``NOTHING`` of the sum and no later one rises above the one before it,
    all that are left are together below half a unit in the sum's last place. A sum is at most exp(m / d) * c! / (m * S(c, 1)).
    """
    ratio, later = ratios(discount)
    total = np.ones(len(c))
    rows, cs, ms, term, add = slice(None), c, m, np.ones(len(c)), np.ones(len(c))
    t = 1
    while n := len(cs) - int(np.searchsorted(cs[::-1], t + 1)):
        t += 1
        term[:n] *= ms[:n]
        term[:n] *= ratio[t].take(cs[:n])
        add[:n] += term[:n]
        if t % 8 == 0:
            total[rows] = add
            on = np.flatnonzero((term[:n] > NOTHING * add[:n]) | (ms[:n] * later[t // 8].take(cs[:n]) > 1))
            rows, cs, ms, term, add = (on if t == 8 else rows[on]), cs[on], ms[on], term[on], add[on]
    total[rows] = add
    goal = np.minimum(drawn * total, np.nextafter(total, 0))
    out = np.ones(len(c), np.int64)
    rows = np.flatnonzero(goal >= 1)
    out[rows] = 2
    cs, ms, goal, term, add = c[rows], m[rows], goal[rows], np.ones(len(rows)), np.ones(len(rows))
    t = 1
    while len(rows):  # the same sums again, so each passes its goal
        t += 1
        term *= ms
        term *= ratio[t].take(cs)
        add += term
        below = add <= goal
        out[rows] += below
        if 4 * np.count_nonzero(below) <= 3 * len(rows):
            on = np.flatnonzero(below)
            rows, cs, ms, goal, term, add = rows[on], cs[on], ms[on], goal[on], term[on], add[on]
    return out


def _drawn_by_logs(c: np.ndarray, m: np.ndarray, drawn: np.ndarray, discount: float) -> np.ndarray:
    """The same for weights whose sums exceed the range of doubles."""
    ratio = ratios(discount)[0]
    out = np.empty(len(c), np.int64)
    edges = [*np.flatnonzero(np.diff(c, prepend=-1)).tolist(), len(c)]
    for first, stop in zip(edges, edges[1:]):
        customers = int(c[first])
        ways = np.concatenate([[0.0], np.cumsum(np.log(ratio[2 : customers + 1, customers]))])
        for at in range(first, stop, max(1, CELLS // customers)):
            rows = slice(at, min(stop, at + max(1, CELLS // customers)))
            mass = ways + np.log(m[rows])[:, None] * np.arange(customers)
            mass = np.exp(mass - mass.max(axis=1, keepdims=True)).cumsum(axis=1)
            out[rows] = 1 + (mass[:, :-1] <= (drawn[rows] * mass[:, -1])[:, None]).sum(axis=1)
    return out


class TableCounts:
    """Numbers of tables of dishes with ``c`` customers each, two or more."""

    def __init__(self, c: np.ndarray, discount: float, seed: int) -> None:
        self.c, self.discount, self.random = c, discount, np.random.default_rng(seed)
        order = np.argsort(-c, kind="stable")
        self.many, self.few = np.split(order, [int((c > LISTED).sum())])
        self.tables = np.ones(len(c), np.int64)
        self.held: np.ndarray | None = None  # of the many: log t! S(c, t) d**t / c!, for their t

    def begin(self, weight: np.ndarray) -> None:
        """A first state, near the expected one."""
        self.tables[self.many] = self._expected(weight[self.many])[0]
        self.held = log_coefficient(self.c[self.many], self.tables[self.many], self.discount)
        self._few(weight)

    def draw(self, weight: np.ndarray) -> None:
        """All customers of every dish are seated anew; ``weight``: of a new table, by dish."""
        self._few(weight)
        if len(self.many):
            self._many(weight[self.many])

    def _few(self, weight: np.ndarray) -> None:
        c, m = self.c[self.few], weight[self.few]
        drawn = self.random.random(len(c))
        large = m > PLAIN * self.discount
        if large.any():
            self.tables[self.few[large]] = _drawn_by_logs(c[large], m[large], drawn[large], self.discount)
            plain = ~large
            self.tables[self.few[plain]] = _drawn_plainly(c[plain], m[plain], drawn[plain], self.discount)
        else:
            self.tables[self.few] = _drawn_plainly(c, m, drawn, self.discount)

    def _expected(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """About the mean and the deviation of t: a Poisson number of tables whose sizes add up to c."""
        d, c, rate = self.discount, self.c[self.many].astype(float), np.maximum(weight, 1e-300) / self.discount
        w = _solved(lambda w: c - rate * d * (1 - w) * w ** (d - 1), np.full(len(c), 1e-300), np.full(len(c), 1 - 1e-12))
        mean = rate * -np.expm1(d * np.log(w))
        spread = np.sqrt(np.maximum(mean - c / (1 + (1 - d) * (1 - w) / w), 0.25))
        return np.clip(np.rint(mean), 1, c).astype(np.int64), spread

    def _many(self, weight: np.ndarray) -> None:
        c, t, held = self.c[self.many], self.tables[self.many], self.held
        rate = np.log(np.maximum(weight, 1e-300) / self.discount)
        spread = self._expected(weight)[1]
        for _ in range(STEPS):
            to = t + np.rint(self.random.normal(0, 2 * spread)).astype(np.int64)
            odds = -np.log(self.random.random(len(c)))
            tried = np.flatnonzero((to >= 1) & (to <= c) & (to != t))
            found = log_coefficient(c[tried], to[tried], self.discount)
            gain = (to - t)[tried] * rate[tried] + _log_factorial_ratio(t[tried], to[tried]) + found - held[tried]
            taken = tried[gain > -odds[tried]]
            held[taken] = found[gain > -odds[tried]]
            t[taken] = to[taken]
        self.tables[self.many] = t


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """log n!, by Stirling's series from 10 on."""
    n = n.astype(float)
    x = np.maximum(n + 1, 11.0)
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    small = np.cumsum(np.log(np.arange(1, 11)))
    return np.where(n >= 10, series, np.concatenate([[0.0], small])[np.minimum(n, 10).astype(int)])


def _log_factorial_ratio(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """log n! / m!"""
    return _log_factorial(n) - _log_factorial(m)
