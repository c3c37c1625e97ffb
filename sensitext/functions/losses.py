"""Per-row losses of distillation; a batch loss is the plain average of these."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sensitext.constants import HIDDEN_WEIGHT, KD_WEIGHT, TEMPERATURE
from sensitext.functions.binding import bind
from sensitext.functions.scoring import log_softmax, log_softmax_t, softmax, softmax_t


def ce_loss(logits: Column | str, label: Column | str) -> Column:
    """Cross-entropy against the hard label."""
    return -F.element_at(log_softmax(logits), _col(label).cast("int") + F.lit(1))


def kd_loss(
    s_logits: Column | str, t_logits: Column | str, temperature: float = TEMPERATURE
) -> Column:
    """``T^2 * KL(teacher || student)`` at temperature ``T``."""
    log_s = log_softmax_t(s_logits, temperature)
    log_t = log_softmax_t(t_logits, temperature)
    terms = F.zip_with(log_t, log_s, lambda t, s: F.exp(t) * (t - s))
    return F.lit(temperature * temperature) * _sum(terms)


def hidden_loss(s_layers: Column | str, t_layers: Column | str) -> Column:
    """Mean squared difference to the mapped teacher layer, summed over student layers.

    Student layer ``i`` is compared with teacher layer ``i * (n_teacher // n_student)``.
    Rows must have equal layer widths for the batch average to equal the tensor mean.
    """

    def difference(layer: Column, other: Column) -> Column:
        squares = F.zip_with(layer, other, lambda a, b: (a - b) * (a - b))
        return _sum(squares) / F.size(layer)

    def over_layers(s: Column, t: Column, factor: Column) -> Column:
        return _sum(
            F.transform(
                s, lambda layer, i: difference(layer, F.element_at(t, i * factor + F.lit(1)))
            )
        )

    def factor(s: Column, t: Column) -> Column:
        return F.floor(F.size(t) / F.size(s)).cast("int")

    return bind(
        _col(s_layers),
        lambda s: bind(
            _col(t_layers), lambda t: bind(factor(s, t), lambda k: over_layers(s, t, k))
        ),
    )


def total_loss(
    ce: Column,
    kd: Column,
    hidden: Column | None = None,
    kd_weight: float = KD_WEIGHT,
    hidden_weight: float = HIDDEN_WEIGHT,
) -> Column:
    """Weighted sum of the terms; a student without layers leaves ``hidden`` out."""
    loss = ce + F.lit(kd_weight) * kd
    return loss if hidden is None else loss + F.lit(hidden_weight) * hidden


def logit_gradient(
    s_logits: Column | str,
    t_logits: Column | str,
    label: Column | str,
    temperature: float = TEMPERATURE,
    kd_weight: float = KD_WEIGHT,
) -> Column:
    """Derivative of ``ce + kd_weight * kd`` by the student's logits."""
    y = _col(label).cast("int")
    ce_part = F.transform(
        softmax(s_logits), lambda p, i: p - F.when(i == y, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    kd_part = F.zip_with(
        softmax_t(s_logits, temperature),
        softmax_t(t_logits, temperature),
        lambda s, t: F.lit(kd_weight * temperature) * (s - t),
    )
    return F.zip_with(ce_part, kd_part, lambda a, b: a + b)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
