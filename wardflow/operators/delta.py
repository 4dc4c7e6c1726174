"""Incremental delta: source rows whose business key is not yet in the target.

``LEFT ANTI JOIN target ON s.k1 <=> t.k1 AND ...`` – null-safe keys treat
NULL = NULL as "already loaded"; plain ``=`` keys make any row with a NULL key
"always new".

Physical form.  ``<=>`` keys are planned as hash keys over
``coalesce(k, default), isnull(k)`` expressions – one hash-partitioned anti
join, the default.  Those expressions match no target layout and block
dynamic partition pruning and runtime filters, so with ``split_nulls=True``
the rows are split instead:

* source rows whose null-safe keys are all non-NULL: plain ``=`` anti join on
  the raw key columns against target rows with non-NULL keys – a target
  bucketed or partitioned on the keys is joined without a full shuffle, and
  the ``IS NOT NULL`` filters reach the scan;
* source rows with a NULL key: null-safe anti join against only the target
  rows that have a NULL key (``IS NULL`` pushed to the scan; Parquet null
  counts skip most row groups).

The split filters the source twice and Catalyst pushes both filters down, so
the source plan runs twice: use it when the source is cheap next to a large,
bucketed or partitioned target (streaming micro-batches), not when the source
is a full re-scan of the form.

Only the key columns of the target are read, de-duplicated with a map-side
combined aggregate first, so a business key repeated a million times in the
target costs one row per map task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expr(df: DataFrame, k) -> Column:
    if isinstance(k, str):
        return df[k]
    if callable(k):
        return k(df)
    return k


def _any(cols):
    return reduce(lambda a, b: a | b, cols)


def _all(cols):
    return reduce(lambda a, b: a & b, cols)


def new_records(source: DataFrame, target: DataFrame, keys, plain_keys=(),
                dedupe_target: bool = True, split_nulls: bool = False, prune_on=()) -> DataFrame:
    """Rows of ``source`` absent from ``target``.

    keys       – null-safe keys: names present on both sides, or
                 ``(source_expr, target_expr)`` pairs for keys cast on one side
                 (e.g. ``(F.to_date('VisitDate'), F.col('VisitDate'))``).
    plain_keys – keys compared with ``=`` (NULL never matches).
    prune_on   – key columns the target is partitioned by (with ``split_nulls``):
                 the plain-key part first restricts the target to the values
                 present in the source by a LEFT SEMI join, which Spark turns
                 into dynamic partition pruning of the target scan.
    """
    specs = [(k, True) for k in keys] + [(k, False) for k in plain_keys]
    tcols, src_cols = [], []
    for i, (k, ns) in enumerate(specs):
        s, t = (k, k) if isinstance(k, str) else k
        tcols.append(_expr(target, t).alias(f"__t{i}"))
        src_cols.append((_expr(source, s), f"__t{i}", ns))
    tk = target.select(*tcols)
    ns_names = [n for _, n, ns in src_cols if ns]

    def anti(src: DataFrame, tkeys: DataFrame, null_safe: bool) -> DataFrame:
        if dedupe_target:
            tkeys = tkeys.dropDuplicates()
        t = tkeys.alias("__tgt")
        conds = [(s.eqNullSafe(F.col(f"__tgt.{n}")) if (ns and null_safe) else (s == F.col(f"__tgt.{n}")))
                 for s, n, ns in src_cols]
        return src.join(t, _all(conds), "left_anti")

    if not split_nulls or not ns_names:
        return anti(source, tk, True)
    src_ns = [s for s, _, ns in src_cols if ns]
    no_null_src = _all([s.isNotNull() for s in src_ns])
    no_null_tgt = _all([F.col(n).isNotNull() for n in ns_names])
    src_nn = source.filter(no_null_src)
    tk_nn = tk.filter(no_null_tgt)
    if prune_on:
        idx = {k if isinstance(k, str) else None: i for i, (k, _) in enumerate(specs)}
        cols = [c for c in prune_on if c in idx]
        if cols:
            vals = src_nn.select(*[F.col(c).alias(f"__t{idx[c]}") for c in cols]).distinct()
            tk_nn = tk_nn.join(vals, [f"__t{idx[c]}" for c in cols], "left_semi")
    plain = anti(src_nn, tk_nn, False)
    with_null = anti(source.filter(~no_null_src), tk.filter(~no_null_tgt), True)
    return plain.unionByName(with_null)
