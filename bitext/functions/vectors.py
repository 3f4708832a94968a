"""Vector math on ``array<double>`` columns with built-in higher-order functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LEARNING_RATE = 3e-4
WARMUP_STEPS = 4000
LABEL_SMOOTHING = 0.1
LENGTH_PENALTY = 0.6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (Spark does not share common
    sub-expressions inside lambdas, so a value used per element would be recomputed)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def to_double(c) -> Column:
    return F.transform(_c(c), lambda x: x.cast("double"))


def scale(c, k: float) -> Column:
    return F.transform(_c(c), lambda x: x * F.lit(float(k)))


def vec_add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vsum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x)


def mean(a) -> Column:
    return vsum(a) / F.size(_c(a))


def relu(a) -> Column:
    return F.transform(_c(a), lambda x: F.greatest(x, F.lit(0.0)))


def layer_norm(a, alpha: float = 1.0, beta: float = 0.0, eps: float = 1e-6) -> Column:
    """``alpha * (x - mean) / (std_pop + eps) + beta`` (eps added to the std)."""
    v = _c(a)

    def with_mu(vm):
        var = F.aggregate(vm["v"], F.lit(0.0), lambda acc, x: acc + (x - vm["mu"]) * (x - vm["mu"])) / F.size(vm["v"])
        st = F.struct(vm["v"].alias("v"), vm["mu"].alias("mu"), F.sqrt(var).alias("sd"))
        return let(st, lambda s: F.transform(
            s["v"], lambda x: F.lit(alpha) * (x - s["mu"]) / (s["sd"] + F.lit(eps)) + F.lit(beta)))

    return let(F.struct(v.alias("v"), mean(v).alias("mu")), with_mu)


def softmax(a) -> Column:
    v = _c(a)

    def norm(e):
        return let(F.struct(e.alias("e"), vsum(e).alias("s")), lambda t: F.transform(t["e"], lambda x: x / t["s"]))

    shifted = let(F.struct(v.alias("v"), F.array_max(v).alias("m")),
                  lambda t: F.transform(t["v"], lambda x: F.exp(x - t["m"])))
    return let(shifted, norm)


def log_softmax(a) -> Column:
    v = _c(a)

    def lse(t):
        return F.log(F.aggregate(t["v"], F.lit(0.0), lambda acc, x: acc + F.exp(x - t["m"]))) + t["m"]

    with_lse = let(F.struct(v.alias("v"), F.array_max(v).alias("m")),
                   lambda t: F.struct(t["v"].alias("v"), lse(t).alias("l")))
    return let(with_lse, lambda t: F.transform(t["v"], lambda x: x - t["l"]))


def linear(x, weights: list, bias: list) -> Column:
    """``W·x + b`` with a small weight matrix inlined as literals (rows = outputs)."""
    def body(v):
        outs = []
        for w, b in zip(weights, bias):
            wl = F.array(*[F.lit(float(t)) for t in w])
            outs.append(dot(wl, v) + F.lit(float(b)))
        return F.array(*outs)

    return let(_c(x), body)


def split_heads(a, h: int) -> Column:
    """``d`` -> ``h`` slices of ``d/h`` (d must be divisible by h)."""
    v = _c(a)
    dk = F.size(v) / h
    return F.transform(F.sequence(F.lit(0), F.lit(h - 1)), lambda i: F.slice(v, (i * dk + 1).cast("int"), dk.cast("int")))


def positional(pos, d: int) -> Column:
    """Sinusoidal position features: sin on even, cos on odd dimensions."""
    p = _c(pos).cast("double")
    k = -math.log(10000.0) / d
    return F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.when(i % 2 == 0, F.sin(p * F.exp((i - i % 2).cast("double") * F.lit(k)))).otherwise(
            F.cos(p * F.exp((i - i % 2).cast("double") * F.lit(k)))
        ),
    )


def lr_schedule(step, lr: float = LEARNING_RATE, warmup: int = WARMUP_STEPS) -> Column:
    s1 = _c(step).cast("double") + 1
    return F.lit(lr) * F.least(s1 / F.lit(float(warmup)), F.sqrt(F.lit(float(warmup)) / s1))


def length_penalty(length, alpha: float = LENGTH_PENALTY) -> Column:
    return F.pow((F.lit(5.0) + _c(length).cast("double")) / F.lit(6.0), F.lit(float(alpha)))


def smoothed_ce_row(logp, label, eps: float = LABEL_SMOOTHING) -> Column:
    """Label-smoothed cross-entropy of one row of log-probabilities."""
    def body(lp):
        nll = -F.element_at(lp, _c(label) + 1)
        smooth = -vsum(lp) / F.size(lp)
        return F.lit(1 - eps) * nll + F.lit(eps) * smooth

    return let(_c(logp), body)
