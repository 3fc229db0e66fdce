"""Restaurants of a hierarchical Pitman-Yor process: numbers of tables drawn by Gibbs sampling.

A restaurant seats ``c`` customers of a dish at ``t`` tables; each table sends one customer to the parent
restaurant. Given everything else, the number of tables of a dish has the weight

    S_d(c, t) * (theta + T d)(theta + (T + 1) d) ... (theta + (T + t - 1) d) * p^t

with the table count T of the restaurant's other dishes, the parent's probability p of the dish, and the
generalised Stirling number S_d, which sums over all seatings of c customers at t tables. Drawing t from it is one
Gibbs step for the whole dish.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Dishes with more customers are seated one after another by the Chinese-restaurant rule, in strides.
EXACT = 64
#: A stride is this part of the customers seated so far; within it the chance of a new table is held.
STRIDE = 16
LEAST = 1e-300


@lru_cache(maxsize=64)
def log_stirling(discount: float) -> np.ndarray:
    """Logarithms of S_d(c, t) for c and t up to ``EXACT``."""
    table = np.full((EXACT + 1, EXACT + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(EXACT):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = table[c, t] + np.log(np.maximum(c - t * discount, 0.0))
        table[c + 1, t] = np.logaddexp(table[c, t - 1], stay)
    return table


def draw_tables(
    customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float, rng
) -> np.ndarray:
    """Tables of each dish: ``others`` are the other dishes' tables in its restaurant."""
    tables = np.minimum(customers, 1).astype(np.int64)
    parent = np.maximum(parent, LEAST)
    others = np.maximum(others, 0)
    stirling = log_stirling(round(discount, 3))
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    order = small[np.argsort(customers[small], kind="stable")]
    sizes, starts = np.unique(customers[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, starts[1:])):
        for at in range(0, len(rows), 20_000):
            some = rows[at:at + 20_000]
            t = np.arange(1, size + 1)
            open_table = np.log(strength + discount * (others[some][:, None] + t - 1))
            weight = stirling[size, 1:size + 1] + np.cumsum(open_table, axis=1) + t * np.log(parent[some])[:, None]
            tables[some] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        goal, seated, t = customers[large], np.ones(len(large), dtype=np.int64), np.ones(len(large), dtype=np.int64)
        p, rest = parent[large], others[large]
        while (seated < goal).any():
            stride = np.minimum(np.maximum(seated // STRIDE, 1), goal - seated)
            fresh = (strength + discount * (rest + t)) * p
            t = t + rng.binomial(stride, fresh / (fresh + np.maximum(seated - discount * t, 1e-9)))
            seated = seated + stride
        tables[large] = t
    return tables


def predictive(customers, tables, all_customers, all_tables, parent, discount: float, strength: float):
    """The restaurant's probability of a dish."""
    kept = np.maximum(customers - discount * tables, 0.0)
    return (kept + (strength + discount * all_tables) * parent) / (strength + all_customers)
