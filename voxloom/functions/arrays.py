"""Arrays of positions, samples and features, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gaps_before(positions: Column) -> Column:
    """Free frames before each position, the first counted from 0; none is negative."""
    return F.transform(
        positions,
        lambda p, i: F.greatest(
            F.lit(0).cast("bigint"), F.when(i == 0, p).otherwise(p - F.element_at(positions, F.greatest(i, F.lit(1))) - 1)
        ),
    )


def gaps_after(positions: Column, total: Column) -> Column:
    """Free frames after each position, the last counted to the end; none is negative."""
    n = F.size(positions)
    following = lambda i: F.element_at(positions, F.least(i + 2, n))
    return F.transform(
        positions,
        lambda p, i: F.greatest(F.lit(0).cast("bigint"), F.when(i == n - 1, total - 1 - p).otherwise(following(i) - p - 1)),
    )


def steps(positions: Column) -> Column:
    """Differences of neighbours; empty for fewer than two positions."""
    n = F.size(positions)
    return F.when(n > 1, F.zip_with(F.slice(positions, 2, n - 1), F.slice(positions, 1, n - 1), lambda b, a: b - a)).otherwise(
        F.array().cast("array<bigint>")
    )


def has_run(positions: Column, most: int) -> Column:
    """More than `most` equal positions in a row, for ascending or any other order."""
    n = F.size(positions)
    same = lambda i: F.reduce(
        F.sequence(F.lit(1), F.lit(most)),
        F.lit(True),
        lambda acc, k: acc & (F.element_at(positions, i) == F.element_at(positions, i + k)),
    )
    return F.when(n > most, F.exists(F.sequence(F.lit(1), F.greatest(n - most, F.lit(1))), same)).otherwise(False)


def largest_step(positions: Column) -> Column:
    return F.array_max(steps(positions))


def trimmed(values: Column, length: Column) -> Column:
    """The first `length` values; all of them if the length is null."""
    return F.when(length.isNull(), values).otherwise(F.slice(values, F.lit(1), length.cast("int")))


def padded(values: Column, length: Column, filler: Column) -> Column:
    return F.concat(values, F.array_repeat(filler, F.greatest(F.lit(0), length - F.size(values)).cast("int")))


def channel_mean(channels: Column) -> Column:
    """The mean over channels, which are arrays of one length, sample by sample."""
    n = F.size(channels)
    total = F.reduce(
        F.slice(channels, 2, F.greatest(n - 1, F.lit(0))),
        F.transform(channels[0], lambda x: x.cast("double")),
        lambda acc, c: F.zip_with(acc, c, lambda a, b: a + b),
    )
    return F.transform(total, lambda x: x / n)


def snake(values: Column, alpha: Column) -> Column:
    """x + sin(alpha x)^2 / alpha, element by element, safe for alpha 0."""
    return F.transform(values, lambda x: x + F.pow(F.sin(alpha * x), F.lit(2.0)) / (alpha + F.lit(1e-9)))


def has_shape(features: Column, token_ids: Column, width: int) -> Column:
    """One row of `width` values for each token."""
    return (F.size(features) == F.size(token_ids)) & F.forall(features, lambda v: F.size(v) == width)


def missing_keys(names: tuple[str, ...]) -> Column:
    """Names of the columns that are null, in the given order."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))
