"""Evaluation metrics: bits per byte and capped cross-entropy."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cap on logits, the label that is ignored, tokens and row length of the evaluation.
LOGIT_CAP = 15.0
IGNORED_LABEL = -1
EVAL_TOKENS = 40 * 524_288
MAX_SEQ_LEN = 2_048


def bits_per_byte(losses: DataFrame, nats: Column, n_bytes: Column, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Total nats over total bytes, in bits. Targets of no bytes are left out of both.

    ``weight`` is how many times a row counts, for losses that are already grouped.
    """
    times = F.lit(1) if weight is None else weight
    out = losses.groupBy(*by).agg(
        F.sum(F.when(n_bytes > 0, nats * times)).alias("nats"), F.sum(n_bytes * times).cast("bigint").alias("n_bytes")
    )
    return out.withColumn("bpb", F.try_divide(F.col("nats"), F.lit(math.log(2)) * F.col("n_bytes")))


def cross_entropy(logits: Column, target: Column, cap: float = LOGIT_CAP) -> Column:
    """Loss of one row of logits: capped, log-sum-exp less the target's logit; null for an ignored target."""
    capped = F.transform(logits, lambda x: F.lit(cap) * F.tanh(x.cast("double") / F.lit(cap)))
    top = F.array_max(capped)
    spread = F.aggregate(capped, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.when(target != IGNORED_LABEL, top + F.log(spread) - F.get(capped, target))


def mean_loss(rows: DataFrame, loss: Column, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(loss).alias("mean_loss"), F.count(loss).alias("n_targets"))


def scored(rows: DataFrame, model: Callable[[pd.Series, pd.Series], pd.Series], inputs: str, targets: str) -> DataFrame:
    """Losses from a caller's model, which receives batches of inputs and targets."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield model(x, y)

    return rows.withColumn("loss", score(F.col(inputs), F.col(targets)))


def eval_rows(batch_size: int, tokens: int = EVAL_TOKENS, length: int = MAX_SEQ_LEN) -> int:
    """Rows an evaluation reads: whole batches within the token budget."""
    return tokens // (batch_size * length) * batch_size
