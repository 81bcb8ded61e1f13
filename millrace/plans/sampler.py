"""Search spaces, and a sampler that draws where good trials are dense and bad ones are not."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from typing import Any

#: Trials drawn evenly before densities are estimated, and values tried per parameter after that.
STARTUP, CANDIDATES = 10, 24
#: Share of the trials that count as good, and their number at most.
GOOD_SHARE, MOST_GOOD = 0.15, 25


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    log_scale: bool = False
    whole: bool = False

    def draw(self, rng: random.Random) -> float | int:
        if self.whole and not self.log_scale:
            return rng.randint(int(self.low), int(self.high))
        return self.at(rng.random())

    def _ends(self) -> tuple[float, float]:
        return (math.log(self.low), math.log(self.high)) if self.log_scale else (self.low, self.high)

    def at(self, unit: float) -> float | int:
        """The value at a place between 0 and 1."""
        low, high = self._ends()
        x = low + unit * (high - low)
        x = min(self.high, max(self.low, math.exp(x) if self.log_scale else x))
        return round(x) if self.whole else x

    def place(self, value: float) -> float:
        """Where a value is between 0 and 1."""
        low, high = self._ends()
        return ((math.log(value) if self.log_scale else value) - low) / (high - low) if high > low else 0.5


@dataclass(frozen=True)
class Density:
    """Normal kernels cut off at 0 and 1, one per place, and one wide kernel for what was never tried.

    A kernel is as wide as the farther of its neighbours is away, but no narrower than the places are
    many.
    """

    kernels: tuple[tuple[float, float], ...]

    @classmethod
    def around(cls, places: list[float]) -> Density:
        ordered = sorted(places)
        fenced = [0.0, *ordered, 1.0]
        least = 1.0 / min(100, len(ordered) + 2)
        gaps = [max(b - a, c - b) for a, b, c in zip(fenced, fenced[1:], fenced[2:], strict=False)]
        return cls(((0.5, 1.0), *[(p, min(1.0, max(least, g))) for p, g in zip(ordered, gaps, strict=True)]))

    def draw(self, rng: random.Random) -> float:
        mean, width = rng.choice(self.kernels)
        while True:
            x = rng.gauss(mean, width)
            if 0 <= x <= 1:
                return x

    def log(self, x: float) -> float:
        total = 0.0
        for mean, width in self.kernels:
            inside = 0.5 * (math.erf((1 - mean) / (width * math.sqrt(2))) - math.erf(-mean / (width * math.sqrt(2))))
            total += math.exp(-0.5 * ((x - mean) / width) ** 2) / (width * inside)
        return math.log(total / len(self.kernels) + 1e-300)


class DensitySampler:
    """Proposes parameters from the trials so far; the same trials in the same order give the same proposal.

    The trials are cut into good and bad ones by score. Each parameter takes, of some values drawn
    from the density of the good trials, the one that is likeliest there and unlikeliest among the
    bad. Trials that still run count as bad as the worst one known, which keeps proposals for
    several at once apart.
    """

    def __init__(self, space: dict[str, Range], seed: int) -> None:
        self.space, self.seed = space, seed

    def propose(self, trials: list[tuple[dict[str, Any], float | None]]) -> dict[str, Any]:
        """Parameters for the next trial; a trial's score is None while it runs."""
        rng = random.Random(f"{self.seed}/{len(trials)}")
        known = [s for _, s in trials if s is not None]
        if len(trials) < STARTUP or not known:
            return {name: r.draw(rng) for name, r in self.space.items()}
        worst = min(known)
        ordered = sorted(((worst if s is None else s, s is not None, -i) for i, (_, s) in enumerate(trials)), reverse=True)
        n_good = min(MOST_GOOD, max(2, math.ceil(GOOD_SHARE * len(trials))))
        order = [-i for _, _, i in ordered]
        return {name: self._best(name, [trials[i][0] for i in order], n_good, rng) for name in self.space}

    def _best(self, name: str, ordered: list[dict[str, Any]], n_good: int, rng: random.Random) -> float | int:
        own = self.space[name]
        places = [own.place(p[name]) for p in ordered]
        good, bad = Density.around(places[:n_good]), Density.around(places[n_good:])
        drawn = [good.draw(rng) for _ in range(CANDIDATES)]
        return own.at(max(drawn, key=lambda x: good.log(x) - bad.log(x)))


# The search space of each model type.
SPACES: dict[str, dict[str, Range]] = {
    "xgb": {
        "n_estimators": Range(100, 1000, log_scale=True, whole=True),
        "max_depth": Range(3, 10, whole=True),
        "learning_rate": Range(0.01, 0.3, log_scale=True),
        "subsample": Range(0.6, 1.0),
        "colsample_bytree": Range(0.6, 1.0),
    },
    "lgbm": {
        "n_estimators": Range(100, 1000, log_scale=True, whole=True),
        "max_depth": Range(3, 12, whole=True),
        "learning_rate": Range(0.01, 0.3, log_scale=True),
        "num_leaves": Range(20, 300, log_scale=True, whole=True),
        "subsample": Range(0.6, 1.0),
        "colsample_bytree": Range(0.6, 1.0),
    },
    "random_forest": {
        "n_estimators": Range(50, 500, whole=True),
        "max_depth": Range(3, 20, whole=True),
        "min_samples_leaf": Range(1, 10, whole=True),
    },
}
