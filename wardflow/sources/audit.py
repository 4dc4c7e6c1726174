"""Load audit in the same pass as the write (no second ``count()``)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def audited(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Attach a row counter; read ``obs.get`` after the action that writes ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class RuleAudit:
    """How many values each rule of a load changed, counted by the load's own action.

    Give one to ``build_load`` (or ``run_load(audit_rules=True)``), run one action, then read ``counts``.
    A stage that is run again for a lost executor may count its values twice.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def watch(self, df: DataFrame, changes: dict[str, tuple[Column, Column]]) -> DataFrame:
        """Count the rows of ``df`` in which a rule's (before, after) differ."""
        if not changes:
            return df
        obs = Observation(f"rules_{uuid.uuid4().hex}")
        self._seen.append(obs)
        return df.observe(obs, *[F.count_if(~old.cast("string").eqNullSafe(new.cast("string"))).alias(name)
                                 for name, (old, new) in changes.items()])

    @property
    def counts(self) -> dict[str, int]:
        """``{"column kind": values changed}``; waits for the action."""
        return {name: n for obs in self._seen for name, n in obs.get.items()}
