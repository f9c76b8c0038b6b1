"""Training schedules and step metrics as column expressions on a telemetry table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Training budget in seconds, tokens per step, peak rate of the accelerator, and the schedules.
TIME_BUDGET_S = 300
TOKENS_PER_STEP = 2**19
PEAK_FLOPS = 989.5e12
UNTIMED_STEPS = 10
MOMENTUM_FROM, MOMENTUM_TO, MOMENTUM_STEPS = 0.85, 0.95, 300
DIVERGED_LOSS = 100.0
EMA_BETA = 0.9


def progress(trained: Column, budget: float = TIME_BUDGET_S) -> Column:
    return F.least(trained / F.lit(budget), F.lit(1.0))


def lr_multiplier(done: Column, warmup: float = 0.0, warmdown: float = 0.5, final: float = 0.0) -> Column:
    """Linear warm-up, flat middle, linear warm-down to ``final``; shares of the whole run."""
    left = (F.lit(1.0) - done) / F.lit(warmdown) if warmdown else F.lit(1.0)
    down = F.when(done < F.lit(1.0 - warmdown), F.lit(1.0)).otherwise(left + (F.lit(1.0) - left) * F.lit(final))
    return F.when(done < F.lit(warmup), done / F.lit(warmup)).otherwise(down) if warmup else down


def momentum(step: Column) -> Column:
    share = F.least(step / F.lit(MOMENTUM_STEPS), F.lit(1.0))
    return (F.lit(1.0) - share) * F.lit(MOMENTUM_FROM) + share * F.lit(MOMENTUM_TO)


def weight_decay(done: Column, start: float = 0.2) -> Column:
    return F.lit(start) * (F.lit(1.0) - done)


def tokens_per_second(dt: Column, tokens: int = TOKENS_PER_STEP) -> Column:
    return F.try_divide(F.lit(float(tokens)), dt).cast("bigint")


def utilisation(dt: Column, flops_per_token: Column, tokens: int = TOKENS_PER_STEP, peak: float = PEAK_FLOPS) -> Column:
    """Share of the peak rate in percent."""
    return F.try_divide(F.lit(100.0) * flops_per_token * F.lit(float(tokens)), dt) / F.lit(peak)


def remaining(trained: Column, budget: float = TIME_BUDGET_S) -> Column:
    return F.greatest(F.lit(0.0), F.lit(float(budget)) - trained)


def diverged(loss: Column) -> Column:
    return F.isnan(loss) | (loss > F.lit(DIVERGED_LOSS))
