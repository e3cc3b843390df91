"""Seating of a Chinese restaurant with discount, dish by dish, in numpy."""

from __future__ import annotations

import numpy as np

from stocktake.llm.hashing import mix

#: Customers seated one by one; for the others of a dish the next new table is drawn at once.
SINGLY = 24


def uniforms(keys: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Repeatable uniform numbers in (0, 1) by key, sweep and step, wherever they are drawn."""
    scrambled = mix(keys ^ mix(np.full(1, sweep * 1_000_003 + step, np.uint64), 21)[0], 22)
    return ((scrambled >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0: Stirling's series eight steps further up, and the steps back."""
    back = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(back)


def seat(customers: np.ndarray, new: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables that serve each dish after its customers sat down, one after the other.

    With k of the dish's customers at t tables, the next one opens a table with
    weight ``new`` (strength + discount * tables of the restaurant, times the
    parent's probability) and joins with weight k - discount * t. After
    ``SINGLY`` customers the place of the next new table is found by inverting
    the product of joining probabilities, a quotient of gamma functions.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    for k in range(1, SINGLY):
        if not len(at):
            break
        join = k - discount * tables[at]
        opens = uniforms(keys[at], sweep, k) * (join + new[at]) < new[at]
        tables[at[opens]] += 1
        at = at[customers[at] > k + 1]
    seated = np.full(len(at), SINGLY, np.int64)
    step = SINGLY
    while len(at):
        step += 1
        weight, drawn = new[at], np.log(uniforms(keys[at], sweep, step))
        taken = discount * tables[at]
        base = log_gamma(seated - taken) - log_gamma(seated - taken + weight)
        low, high = seated.copy(), customers[at].copy()

        def still(j: np.ndarray) -> np.ndarray:
            """Whether customers ``seated`` to j (j itself left out) all join."""
            return log_gamma(j - taken) - log_gamma(j - taken + weight) - base >= drawn

        # The first j for which customer j is the one that opens a table: all before join, j does not.
        ends = still(high)
        # It is close to where the same powers of the mean arguments are; where not, the whole range is searched.
        shift = (weight - 1) / 2 - taken
        near = (seated + shift) * np.exp(np.minimum(-drawn / weight, 300)) - shift
        below = np.clip(near - 2, low, high).astype(np.int64)
        above = np.clip(near + 3, low, high).astype(np.int64)
        low, high = np.where(still(below), below, low), np.where(still(above), high, above)
        while True:
            open_ = (high - low > 1) & ~ends
            if not open_.any():
                break
            middle = (low + high) // 2
            joins = still(middle)
            low = np.where(open_ & joins, middle, low)
            high = np.where(open_ & ~joins, middle, high)
        at, seated = at[~ends], high[~ends]
        tables[at] += 1
        more = seated < customers[at]
        at, seated = at[more], seated[more]
    return tables
