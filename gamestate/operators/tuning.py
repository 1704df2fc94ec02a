"""Adaptive search of parameters: a tree-structured Parzen sampler, median pruning and a time box.

The sampler splits the trials seen so far into a good part and the rest, models each parameter of either part as a mixture
of kernels around its values and one wide prior, draws candidates from the good part's mixture and takes the one that is
likeliest there relative to the rest. It knows nothing of models or Spark: `ask` gives parameters, `tell` takes a loss.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

import numpy as np

from gamestate.operators.boosting import Booster


@dataclass(frozen=True)
class Number:
    low: float
    high: float
    whole: bool = False
    log: bool = False

    def to(self, value: float) -> float:
        """Into the space of the kernels."""
        return math.log(value) if self.log else float(value)

    def back(self, x: float) -> float:
        v = math.exp(x) if self.log else x
        v = min(max(v, self.low), self.high)
        return int(round(v)) if self.whole else float(v)

    def bounds(self) -> tuple[float, float]:
        half = 0.5 if self.whole else 0.0
        return self.to(self.low - half), self.to(self.high + half)


@dataclass(frozen=True)
class Choice:
    options: tuple


Space = dict[str, Number | Choice]

#: The parameters of the trees that are searched at a fixed learning rate.
TREES: Space = {
    "coarse": Choice((False, True)),
    "depth": Number(3, 7, whole=True),
    "min_child_weight": Number(1, 10, whole=True),
    "max_delta_step": Number(1, 10, whole=True),
    "subsample": Number(0.6, 0.9),
    "colsample": Number(0.5, 0.95),
    "alpha": Number(0.001, 10, log=True),
}


class Sampler:
    def __init__(self, space: Space, seed: int = 71, first: int = 10, candidates: int = 24) -> None:
        self.space, self.first, self.candidates = space, first, candidates
        self.rng = np.random.default_rng(seed)
        self.seen: list[tuple[dict, float]] = []

    def tell(self, params: dict, loss: float) -> None:
        if not math.isnan(loss):
            self.seen.append((params, loss))

    def ask(self) -> dict:
        if len(self.seen) < self.first:
            return {k: self._any(p) for k, p in self.space.items()}
        ranked = sorted(self.seen, key=lambda s: s[1])
        n = max(1, min(25, math.ceil(0.1 * len(ranked))))
        good, rest = ranked[:n], ranked[n:]
        return {k: self._likeliest(p, [g[0][k] for g in good], [r[0][k] for r in rest]) for k, p in self.space.items()}

    def _any(self, p: Number | Choice) -> object:
        if isinstance(p, Choice):
            return p.options[self.rng.integers(len(p.options))]
        return p.back(self.rng.uniform(*p.bounds()))

    def _likeliest(self, p: Number | Choice, good: list, rest: list) -> object:
        if isinstance(p, Choice):
            share = lambda xs: np.array([1 + sum(x == o for x in xs) for o in p.options]) / (len(xs) + len(p.options))
            a, b = share(good), share(rest)
            drawn = self.rng.choice(len(p.options), self.candidates, p=a)
            return p.options[max(drawn, key=lambda i: a[i] / b[i])]
        a, b = self._mixture(p, good), self._mixture(p, rest)
        at = self.rng.integers(len(a[0]), size=self.candidates)
        low, high = p.bounds()
        drawn = np.clip(self.rng.normal(a[0][at], a[1][at]), low, high)
        return p.back(float(drawn[np.argmax(self._density(drawn, a, p) - self._density(drawn, b, p))]))

    @staticmethod
    def _mixture(p: Number, values: list) -> tuple[np.ndarray, np.ndarray]:
        """Centres and widths: each value's width is the larger distance to its neighbours, within bounds; one kernel spans all."""
        low, high = p.bounds()
        x = np.sort([p.to(v) for v in values])
        wide = high - low
        edges = np.concatenate([[low], x, [high]])
        width = np.clip(np.maximum(np.diff(edges)[:-1], np.diff(edges)[1:]), wide / min(100, len(x) + 2), wide)
        return np.append(x, (low + high) / 2), np.append(width, wide)

    @staticmethod
    def _density(x: np.ndarray, mixture: tuple[np.ndarray, np.ndarray], p: Number) -> np.ndarray:
        centre, width = mixture
        low, high = p.bounds()
        phi = np.vectorize(lambda t: 0.5 * (1 + math.erf(t / math.sqrt(2))))
        inside = phi((high - centre) / width) - phi((low - centre) / width)
        z = (x[:, None] - centre) / width
        return np.log((np.exp(-0.5 * z * z) / (width * inside)).sum(1) + 1e-300)


@dataclass
class Trial:
    number: int
    params: dict
    loss: float
    rounds: int
    state: str
    seconds: float


def search(train: Callable[[list[dict], Callable, float | None], list[Booster]], space: Space, trials: int, together: int = 4, seconds: float | None = None, seed: int = 71, warm: int = 5) -> tuple[Booster, list[Trial]]:
    """The model of least loss, and all trials. `together` of them are asked for and trained at once.

    A trial ends early ("pruned") when, after `warm` rounds, its best loss is above the median of what earlier trials had
    reached by that round. When the seconds are over, what is being trained ends ("timeout") and no new trial begins.
    """
    sampler, done, curves, began = Sampler(space, seed), [], [], time.time()
    best: Booster | None = None
    while len(done) < trials and (seconds is None or not done or time.time() - began < seconds):
        asked = [sampler.ask() for _ in range(min(together, trials - len(done)))]

        def late(m: int, curve: list[tuple], earlier: tuple = tuple(curves)) -> bool:
            now = len(curve) - 1
            reached = [min(c[: now + 1]) for c in earlier if len(c) > now]
            return now >= warm and len(reached) >= 3 and min(c[2] for c in curve) > median(reached)

        started = time.time()
        models = train(asked, late, None if seconds is None else max(seconds - (started - began), 0.0))
        for params, model in zip(asked, models, strict=True):
            losses = [c[2] for c in model.curve]
            loss = losses[min(model.best, len(losses) - 1)]
            sampler.tell(params, loss)
            curves.append(losses)
            done.append(Trial(len(done), params, loss, model.best, model.state, model.curve[-1][3]))
            if best is None or loss < min(t.loss for t in done[:-1]):
                best = model
    return best, done
