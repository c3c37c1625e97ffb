"""From logits to probabilities, classes and decisions; all plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from sensitext.constants import ID2LABEL, TEMPERATURE, THRESHOLD
from sensitext.functions.binding import bind


def linear_logits(vector: Column | str, heads: Sequence[Sequence[float]]) -> Column:
    """One dot product per class head over a vector column, computed in double."""
    # One parsed literal: a literal per weight would cost a call into the JVM each.
    rows = ("array(" + ", ".join(f"double('{float(w)!r}')" for w in head) + ")" for head in heads)
    heads_lit = F.expr("array(" + ", ".join(rows) + ")")

    def dot(v: Column, h: Column) -> Column:
        products = F.zip_with(v, h, lambda x, w: x * w)
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    return bind(
        _col(vector).cast("array<double>"), lambda v: F.transform(heads_lit, lambda h: dot(v, h))
    )


def softmax(logits: Column | str) -> Column:
    return softmax_t(logits, 1.0)


def softmax_t(logits: Column | str, temperature: float = TEMPERATURE) -> Column:
    """Softmax of ``logits / temperature``, shifted by the maximum against overflow."""
    return F.transform(log_softmax_t(logits, temperature), lambda x: F.exp(x))


def log_softmax(logits: Column | str) -> Column:
    return log_softmax_t(logits, 1.0)


def log_softmax_t(logits: Column | str, temperature: float = TEMPERATURE) -> Column:
    """``z - max - log(sum(exp(z - max)))`` for ``z = logits / temperature``."""
    z = _col(logits)
    if temperature != 1.0:
        z = F.transform(z, lambda x: x / F.lit(float(temperature)))

    def log_sum(shifted: Column) -> Column:
        return F.log(F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + F.exp(x)))

    def shift(a: Column, by: Column) -> Column:
        return F.transform(a, lambda x: x - by)

    centred = bind(z, lambda a: bind(F.array_max(a), lambda top: shift(a, top)))
    return bind(centred, lambda a: bind(log_sum(a), lambda total: shift(a, total)))


def argmax(values: Column | str) -> Column:
    """Zero-based place of the first maximum; NaN counts as the largest value."""
    a = _col(values)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def confidence(probs: Column | str, pred: Column | str) -> Column:
    """Probability of the predicted class."""
    return F.element_at(_col(probs), _col(pred) + F.lit(1))


def label_map_column(id2label: Mapping[int, str] = ID2LABEL) -> Column:
    """The map of class id to class name as a literal."""
    parts: list[Column] = []
    for key, name in sorted(id2label.items()):
        parts += [F.lit(int(key)), F.lit(name)]
    return F.create_map(*parts)


def label_name(pred: Column | str, label_map: Column | None = None) -> Column:
    """Class name of a class id; null for an id the map lacks."""
    return F.try_element_at(label_map_column() if label_map is None else label_map, _col(pred))


def prob_struct(probs: Column | str, names: Sequence[str] | None = None) -> Column:
    """Probabilities as a struct with one field per class name."""
    names = list(ID2LABEL.values()) if names is None else list(names)
    return F.struct(*[F.element_at(_col(probs), i + 1).alias(n) for i, n in enumerate(names)])


def prob_map(probs: Column | str, names: Column) -> Column:
    """Probabilities as a map, for class names that are themselves data."""
    return F.map_from_arrays(names, _col(probs))


def has_nan(logits: Column | str) -> Column:
    return F.exists(_col(logits), lambda x: F.isnan(x))


def decide(probs: Column | str, threshold: float = THRESHOLD) -> Column:
    """True where the probability of class 1 lies strictly above the threshold."""
    return F.element_at(_col(probs), 2) > F.lit(float(threshold))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
