"""Arithmetic on ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.hashing import draw, normal, uniform


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def total(v: Column | str) -> Column:
    return F.aggregate(_doubles(v), F.lit(0.0), lambda acc, x: acc + x)


def mean(v: Column | str) -> Column:
    return F.try_divide(total(v), F.size(_col(v)))


def dot(a: Column | str, b: Column | str) -> Column:
    return total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(x)))


def argmax(v: Column | str) -> Column:
    """0-based place of the first largest element; null for an empty array."""
    v = _col(v)
    return F.when(F.size(v) > 0, F.array_position(v, F.array_max(v)).cast("int") - 1)


def nonzero(v: Column | str) -> Column:
    return F.transform(_col(v), lambda x: (x != 0).cast("int"))


def rescale(v: Column | str, by: float = 255.0) -> Column:
    return F.transform(_doubles(v), lambda x: x / F.lit(by))


def random_flip(v: Column | str, *key: Column | str, seed: int | str = 13) -> Column:
    """Reverse the vector for about half of the keys."""
    v = _col(v)
    return F.when(uniform(*key, seed=seed) < 0.5, F.reverse(v)).otherwise(v)


def random_contrast(v: Column | str, *key: Column | str, spread: float = 0.3, seed: int | str = 13) -> Column:
    """Stretch each element around the mean by a keyed factor in ``1 +/- spread``."""
    factor = F.lit(1.0 - spread) + uniform(*key, seed=seed) * F.lit(2.0 * spread)
    centre = mean(v)
    return F.transform(_doubles(v), lambda x: (x - centre) * factor + centre)


def mean_squared_gap(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return mean(gaps)


def mean_absolute_gap(a: Column | str, b: Column | str) -> Column:
    return mean(F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x - y)))


def halves(v: Column | str) -> tuple[Column, Column]:
    """First and second half; a vector of odd length raises, as an uneven split does."""
    v = _col(v)
    half = F.when(F.size(v) % 2 == 0, (F.size(v) / 2).cast("int")).otherwise(
        F.raise_error(F.lit("halves() needs an even number of elements")).cast("int")
    )
    return F.slice(v, F.lit(1), half), F.slice(v, half + 1, half)


def latent_penalty(mu: Column | str, log_var: Column | str) -> Column:
    """Half the sum of ``exp(s) + mu**2 - 1 - s``."""
    terms = F.zip_with(_doubles(mu), _doubles(log_var), lambda m, s: F.exp(s) + m * m - 1.0 - s)
    return 0.5 * total(terms)


def latent_loss(x, x_back, mu, log_var, penalty_weight: float = 0.0005) -> Column:
    """``penalty_weight`` x latent penalty + mean absolute reconstruction gap."""
    return F.lit(penalty_weight) * latent_penalty(mu, log_var) + mean_absolute_gap(x, x_back)


def normal_vector(length: int, *key: Column | str, seed: int | str = 13) -> Column:
    """Keyed standard-normal vector."""
    keys = [_col(k) for k in key]
    return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: normal(*keys, i, seed=seed))


def latent_draw(mu: Column | str, log_var: Column | str, noise: Column | str) -> Column:
    """``mu + exp(s/2) * noise``, element by element."""
    shift = F.zip_with(_doubles(log_var), _doubles(noise), lambda s, e: F.exp(s * 0.5) * e)
    return F.zip_with(_doubles(mu), shift, lambda m, d: m + d)


def logit_cross_entropy(logit: Column | str, target: Column | str) -> Column:
    """Binary cross-entropy of a raw score, in the form that does not overflow."""
    x, z = _col(logit), _col(target)
    return F.greatest(x, F.lit(0.0)) - x * z + F.log1p(F.exp(-F.abs(x)))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("Column", "F", "annotations", "draw")]
