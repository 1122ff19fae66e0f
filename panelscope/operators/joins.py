"""A join that builds its hash table on a named side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_building_on(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Shuffled hash join with the table on ``small``, whatever the optimizer
    estimates for ``big`` (a generator's output, for instance, is estimated
    from its much smaller input).  Both sides are shuffled, so neither has to
    fit in a task whole."""
    return big.join(small.hint("shuffle_hash"), list(on), how)
