"""Reliabilities of labelers that vote or abstain, by expectation-maximisation.

Votes are 1 (yes), -1 (no) and 0 (abstains). The rows are vote patterns with the number
of times each occurs, so the work depends on the number of patterns and not on the data;
the callers have a fixed number of labelers, which bounds it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Reliabilities:
    prior: float  # log-odds of yes
    when_yes: tuple[float, ...]  # what a labeler's yes adds to the log-odds
    when_no: tuple[float, ...]  # what its no adds

    def log_odds(self, votes: Sequence[int]) -> float:
        total = self.prior
        for k, vote in enumerate(votes):
            total += (0.0, self.when_yes[k], self.when_no[k])[vote]
        return total


def estimate(
    patterns: Sequence[tuple[tuple[int, ...], int]],
    labelers: int,
    prior: float = 0.5,
    right: float = 0.9,
    caught: float = 0.9,
    rounds: int = 50,
    strength: float = 0.05,
) -> Reliabilities:
    """How often each labeler says yes, no or nothing where the truth is yes and where it
    is no. The start has a labeler say no to 1 - `right` of what is yes and to `caught` of
    what is no, the rest of its votes being shared as observed: a low `caught` suits
    labelers that each know one fault and have nothing against the others. The start counts
    as `strength` times all rows (ten at least) in each round, so a labeler that hardly votes
    keeps it. Abstaining tells nothing. Without patterns the start is returned."""
    total = sum(n for _, n in patterns)
    strength = max(10.0, strength * total)

    def start(k: int, truth: int) -> dict[int, float]:
        yes = sum(n for v, n in patterns if v[k] == 1) + 1.0
        silent = sum(n for v, n in patterns if v[k] == 0) + 1.0
        no = 1 - right if truth == 1 else caught
        return {-1: no, 1: (1 - no) * yes / (yes + silent), 0: (1 - no) * silent / (yes + silent)}

    first = [(start(k, 1), start(k, -1)) for k in range(labelers)]
    table, base = first, prior
    for _ in range(rounds):
        now = _as_log_odds(table, base)
        yes = [1 / (1 + math.exp(-max(-500, min(500, now.log_odds(v))))) for v, _ in patterns]
        table = []
        for k in range(labelers):
            side = []
            for truth in (0, 1):
                mass = dict.fromkeys((-1, 0, 1), 0.0)
                for (v, n), p in zip(patterns, yes):
                    mass[v[k]] += n * (1 - p if truth else p)
                whole = sum(mass.values()) + strength
                side.append({s: (mass[s] + strength * first[k][truth][s]) / whole for s in mass})
            table.append(tuple(side))
        base = (sum(n * p for (_, n), p in zip(patterns, yes)) + strength * prior) / (total + strength)
    return _as_log_odds(table, base)


def _as_log_odds(table, base: float) -> Reliabilities:
    def ratios(vote: int) -> tuple[float, ...]:
        return tuple(math.log((yes[vote] + 1e-9) / (no[vote] + 1e-9)) for yes, no in table)

    return Reliabilities(math.log((base + 1e-9) / (1 - base + 1e-9)), ratios(1), ratios(-1))


def fit_logistic(
    rows: Sequence[tuple[Sequence[int], float, float]], width: int, rounds: int = 200, decay: float = 1e-3
) -> list[float]:
    """Weights (the last is the constant) of a logistic model fitted to soft labels.

    A row is (places of its features that are one, weight, probability of yes)."""
    w = [0.0] * (width + 1)
    whole = sum(n for _, n, _ in rows) or 1.0
    square = [1e-6] * (width + 1)
    for _ in range(rounds):
        grad = [decay * x for x in w]
        for places, n, y in rows:
            z = w[width] + sum(w[j] for j in places)
            error = n / whole * (1 / (1 + math.exp(-max(-500.0, min(500.0, z)))) - y)
            grad[width] += error
            for j in places:
                grad[j] += error
        for j, g in enumerate(grad):
            square[j] += g * g
            w[j] -= 0.5 * g / math.sqrt(square[j])
    return w
