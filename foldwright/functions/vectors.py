"""Row-wise arithmetic on ``array<double>`` columns and on sets of columns.

All of it is Spark's higher-order functions, so it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Inside a higher-order function an outer expression would be evaluated anew
    for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def normalised(values: Column) -> Column:
    return bind(values, lambda v: bind(total(v), lambda t: F.transform(v, lambda x: F.try_divide(x, t))))


def softmax(logits: Column) -> Column:
    return bind(
        logits,
        lambda z: normalised(bind(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top)))),
    )


def temperature_scale(vector: Column, temperature: float, kind: str = "probability") -> Column:
    """Soften (T > 1) or sharpen (T < 1). ``kind`` says what the input is."""
    if kind not in ("probability", "logit"):
        raise ValueError(f"kind must be 'probability' or 'logit', not {kind!r}")
    t = F.lit(float(temperature))
    if kind == "probability":
        return softmax(F.transform(vector, lambda p: F.ln(p + F.lit(1e-8)) / t))
    return softmax(F.transform(vector, lambda z: z / t))


def binary_temperature_scale(value: Column, temperature: float, kind: str = "probability") -> Column:
    """The two-class vector for one score: ``[1 - s, s]`` with s the scaled sigmoid."""
    logit = F.ln(value + F.lit(1e-8)) if kind == "probability" else value
    s = 1.0 / (1.0 + F.exp(-logit / F.lit(float(temperature))))
    return F.array(1.0 - s, s)


def power_scale(probabilities: Column, temperature: Column | float) -> Column:
    """``p ** (1/T)``, renormalised."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return normalised(F.transform(probabilities, lambda p: F.pow(p, F.lit(1.0) / t)))


def one_hot(label: Column, n_classes: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: F.when(i == label, 1.0).otherwise(0.0)
    )


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def binary_confidence(p: Column) -> Column:
    return F.greatest(p, 1.0 - p)


def argmax(probabilities: Column) -> Column:
    """0-based position of the first maximum."""
    return bind(probabilities, lambda p: (F.array_position(p, F.array_max(p)) - 1).cast("int"))


def argmax_label(probabilities: Column, labels: Sequence) -> Column:
    """The label value (not the position) of the first maximum."""
    return F.element_at(F.array(*[F.lit(v) for v in labels]), argmax(probabilities) + 1)


def entropy(probabilities: Column) -> Column:
    return total(F.transform(probabilities, lambda p: -p * F.ln(p + F.lit(1e-10))))


def kl_divergence(teacher: Column, student: Column) -> Column:
    """``sum t * ln(t / s)``; terms with t = 0 contribute nothing."""
    return total(
        F.zip_with(teacher, student, lambda t, s: F.when(t > 0, t * (F.ln(t) - F.ln(s + F.lit(1e-12)))).otherwise(0.0))
    )


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def row_mean(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols) / F.lit(float(len(cols)))


def row_median(cols: Sequence[Column]) -> Column:
    ordered = F.array_sort(F.array(*cols))
    n = len(cols)
    middle = F.element_at(ordered, n // 2 + 1)
    return middle if n % 2 else (F.element_at(ordered, n // 2) + middle) / 2.0


def row_geometric_mean(cols: Sequence[Column]) -> Column:
    """0 if any value is 0, null if any is negative."""
    logs = [F.when(c > 0, F.ln(c)) for c in cols]
    lowest = F.least(*cols) if len(cols) > 1 else cols[0]
    return F.when(lowest == 0, 0.0).otherwise(F.exp(row_mean(logs)))


def weighted_mean(cols: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weights are normalised; a zero total raises."""
    whole = float(sum(weights))
    if whole == 0:
        raise ValueError("weights sum to zero")
    return reduce(lambda a, b: a + b, [c * F.lit(w / whole) for c, w in zip(cols, weights)])


def mean_of_arrays(arrays: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Element-wise (weighted) mean of equally long arrays."""
    weights = list(weights) if weights is not None else [1.0] * len(arrays)
    whole = float(sum(weights))
    if whole == 0:
        raise ValueError("weights sum to zero")

    def share(array: Column, weight: float) -> Column:
        return F.transform(array, lambda x: x * F.lit(weight / whole))

    scaled = [share(a, w) for a, w in zip(arrays, weights)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), scaled)
