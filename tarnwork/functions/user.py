"""User functions by name: scalar, aggregate and table functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.combine import combine_by_key


@dataclass(frozen=True)
class UserAggregate:
    """A user aggregate as start / add / merge / finish.

    Unlike a function over a whole group, it is combined on the map side, so
    a hot group costs one partial per input partition.
    """

    start: Callable
    add: Callable
    merge: Callable
    state_type: str
    finish: Callable = lambda state: state

    def by_key(self, df: DataFrame, key: str, value: str, name: str = "result") -> DataFrame:
        key_type = dict(df.dtypes)[key]
        states = combine_by_key(
            df, key, value, lambda v: self.add(self.start(), v), self.add, self.merge,
            f"{key} {key_type}, _state {self.state_type}",
        )
        return states.select(key, self.finish(F.col("_state")).alias(name))
