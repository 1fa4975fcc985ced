"""Arithmetic of encoding and weighting, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def noise_shift_scale(noise: Column) -> tuple[Column, Column]:
    """Shift and scale of a noise in [0, 1): tiny enough to keep order, enough to tell rows apart."""
    return noise * (2.0**-142), 1.0 + noise * (2.0**-17)


def sprinkle(x: Column, noise: Column) -> Column:
    shift, scale = noise_shift_scale(noise)
    return (x + shift) * scale


def centred(value: Column, width: Column | float = 2.0) -> Column:
    """A value in [0, 1] stretched to ``width`` round zero."""
    width = F.lit(width) if isinstance(width, (int, float)) else width
    return value * width - width / 2


def code_value(position: Column, n: Column) -> Column:
    """Code of position 0 (best) to n - 1 (worst): +1 down to -1; 1 if alone."""
    back = (n - 1 - position).cast("double")
    return F.when(n == 1, 1.0).otherwise(centred(back / F.nullif(n - 1, F.lit(0))))


def miss_width(n: Column) -> Column:
    return F.when(n <= 1, 1.0).otherwise(F.lit(2.0) / F.nullif(n - 1, F.lit(0)))


def miss_value(hashed: Column, width: Column) -> Column:
    """Value of a string outside its table: its hash's low 32 bits spread over ``width``."""
    return centred(hashed.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") * (2.0**-32), width)


def smoothed_mean(total_w: Column, total_wy: Column, n: Column, prior_mean: float, prior_count: float) -> Column:
    """Mean target pulled towards ``prior_mean`` by ``prior_count`` rows of average weight."""
    prior_w = F.lit(float(prior_count)) * total_w / n
    return (total_wy + F.lit(float(prior_mean)) * prior_w) / (total_w + prior_w)


def inverse_propensity(p: Column, mean_item_count: Column | float, floor: float = 1e-4) -> Column:
    return F.lit(1.0) / F.greatest(p, F.lit(floor)) / mean_item_count


def standardised(x: Column, mean: Column, std: Column) -> Column:
    """Z-score; a deviation that is 0 or undefined counts as 1."""
    return (x - mean) / F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))


def binary_reward(reward: Column) -> Column:
    return (reward > 0).cast("double")


def poisson_cuts(terms: int = 20, not_zero: bool = False) -> list[tuple[int, float]]:
    """(k, P(X <= k)) of a Poisson(1) X, or of one that isn't 0."""
    total, cuts = 0.0, []
    for k in range(1 if not_zero else 0, terms):
        total += math.exp(-1) / math.factorial(k) / ((1 - math.exp(-1)) if not_zero else 1.0)
        cuts.append((k, total))
    return cuts


def by_cuts(uniform: Column, cuts: list[tuple[int, float]]) -> Column:
    """The first number whose cut a uniform in [0, 1) is below."""
    found = F.lit(float(cuts[-1][0] + 1))
    for k, cut in reversed(cuts):
        found = F.when(uniform < cut, float(k)).otherwise(found)
    return found


def bootstrap_weight(uniform: Column) -> Column:
    """Poisson(1) given that it isn't 0, by inverse distribution of a uniform in [0, 1),
    which is drawn once however many cuts it is held against."""
    return F.get(F.transform(F.array(uniform), lambda u: by_cuts(u, poisson_cuts(not_zero=True))), F.lit(0))


def uniform_of(*columns: Column, seed: int) -> Column:
    """A reproducible uniform in [0, 1) of some columns: retries see the same draw."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 53)) / float(1 << 53)
