"""Values for the contract columns that a load query's fixture does not spell out itself.

Every column is a SQL text over the form's base table that both engines read, made
from the row's key, so that no rule, cast or pass-through column of a load is NULL
on both sides of the check.  ``blank`` names the columns the job's text blanks;
``made`` gives a column's form text and the SQL of its rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.plans.spec import cols


class Feed:
    """Form columns of ``spec_name`` beside ``own`` (those the query's fixture and parents give)."""

    def __init__(self, spec_name: str, key: str, own: str, blank: str = "", made: dict | None = None,
                 spark: dict | None = None):
        from wardflow.plans.catalog import SPECS
        spec = SPECS[spec_name]
        blanks, made = cols(blank), made or {}
        taken = {c.lower() for c in (*cols(own), *spec.nulls)}
        self.form, self.rule, self.engine = {}, {}, spark or {}
        for c in spec.columns:
            if c.lower() in taken:
                continue
            n = sum(map(ord, c)) % 5 + 2
            text = f"'{c} ' || CAST(({key}) % {n} AS STRING)"
            self.form[c], self.rule[c] = made.get(c, (text, f'"{c}"'))
            if c in blanks:
                self.form[c] = f"CASE ({key}) % {n + 2} WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {text} END"
                self.rule[c] = f'''CASE WHEN "{c}" = '' THEN NULL ELSE "{c}" END'''
        unknown = {*blanks, *made} - set(self.form)
        if unknown:
            raise ValueError(f"{spec_name}: not fed here: {sorted(unknown)}")

    def columns(self) -> list:
        """The columns for the Spark form's select list (``spark`` texts where the engines differ)."""
        return [F.expr(self.engine.get(c, e)).alias(c) for c, e in self.form.items()]

    def extra(self) -> dict:
        return {c: F.expr(self.engine.get(c, e)) for c, e in self.form.items()}

    @property
    def form_sql(self) -> str:
        return ", ".join(f'{e} AS "{c}"' for c, e in self.form.items())

    def names(self, alias: str = "") -> str:
        return ", ".join(f'{alias}"{c}"' for c in self.form)

    @property
    def rule_sql(self) -> str:
        return ", ".join(f'{e} AS "{c}"' for c, e in self.rule.items())
