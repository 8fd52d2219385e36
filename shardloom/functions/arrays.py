"""Array expressions for logits and feature arrays (JVM-side higher-order
functions: ``transform``, ``aggregate``, ``array_max``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(a: str | Column) -> Column:
    """0-based position of the largest element; the first wins ties."""
    a = _c(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def logsumexp(a: str | Column) -> Column:
    """Stable ``log(sum(exp(x)))``: shifted by the maximum."""
    a = _c(a)
    m = F.array_max(a).cast("double")
    s = F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x.cast("double") - m))
    return m + F.log(s)


def softmax(a: str | Column) -> Column:
    """Stable softmax of a numeric array (as doubles)."""
    a = _c(a)
    m = F.array_max(a).cast("double")
    s = F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x.cast("double") - m))
    return F.transform(a, lambda x: F.exp(x.cast("double") - m) / s)


def log_softmax_at(a: str | Column, idx: str | Column) -> Column:
    """``log(softmax(a)[idx])`` for a 0-based index, via log-sum-exp."""
    a = _c(a)
    return F.get(a, _c(idx)).cast("double") - logsumexp(a)


def normalize_channels(a: str | Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """Per-channel ``(x - mean[c]) / std[c]`` over a flat interleaved array,
    channel ``c = i % len(mean)``."""
    k = len(mean)
    if k != len(std):
        raise ValueError("mean and std differ in length")
    mean_a = F.array(*[F.lit(float(m)) for m in mean])
    std_a = F.array(*[F.lit(float(s)) for s in std])
    return F.transform(_c(a), lambda x, i: (x.cast("double") - F.get(mean_a, i % k)) / F.get(std_a, i % k))
