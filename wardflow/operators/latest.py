"""Latest-version selection (the 'joint maxima' rule and last-event-per-key).

``latest_joint_max`` keeps the rows of a key that hold *all* per-key maxima at
once (max id and max extraction day, say).  A key whose maxima sit on
different rows has no surviving row, ties on every maximum all survive, and a
NULL in an equality key drops the row – the exact semantics of the source
systems' ``INNER JOIN (SELECT keys, max(a), max(b) ... GROUP BY keys)``.

Physical plan (``strategy="aggregate"``, the default)::

    HashAggregate(partial) -> Exchange(keys) -> HashAggregate(final)   [one row per key]
    left-semi join on (join keys, measure == max) with the input

The aggregate is map-side combined, so a key holding a third of all rows is
reduced to one row per map task before the shuffle; the semi join hashes on
(keys + measure values), which spreads a hot key over many reducers, and AQE
may still split a skewed partition.  ``strategy="window"`` (max() OVER keys +
filter) is kept for comparison: it is one shuffle but sends every row of a key
to one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators._keys import named
from wardflow.session import scratch_path


def latest_joint_max(df: DataFrame, keys, maxes, join_keys=None,
                     null_safe_keys=(), strategy: str = "aggregate", over: DataFrame | None = None) -> DataFrame:
    """Rows holding every per-key maximum.

    keys      – grouping keys: names or ``(alias, Column)`` (e.g. a
                ``coalesce(EncounterId, -1)`` sentinel key).
    maxes     – measures: names, ``(alias, Column)`` pairs, or a list of such
                lists.  A list of lists means several independent latest
                rules ANDed (each computed over the unfiltered input).
    join_keys – subset of ``keys`` to join back on (the "coarser join" forms
                that group by more columns than they join on).
    null_safe_keys – key names compared with ``<=>`` instead of ``=``.
    over      – frame the maxima are computed over (default: ``df`` itself), for
                rules that look at more rows than they keep.
    """
    cols = df.columns
    ks = named(keys, "__k")
    if maxes and isinstance(maxes[0], list):
        ms = named([m for group in maxes for m in group], "__m")
    else:
        ms = named(maxes, "__m")
    seen: set[str] = set()
    ms = [m for m in ms if not (m[0] in seen or seen.add(m[0]))]   # same measure in two rules: once
    derived = {n: e for n, e, plain in ks + ms if not plain}
    base = df.withColumns(derived) if derived else df
    key_names = [n for n, _, _ in ks]
    jk = key_names if join_keys is None else [n for n, _, _ in named(join_keys, "__k")]
    # measures computed on derived columns keep the derived name
    mnames = [n for n, _, _ in ms]

    if strategy == "window":
        if over is not None:
            raise ValueError("window strategy computes the maxima over the rows it filters")
        if jk != key_names:
            raise ValueError("window strategy needs join_keys == keys")
        w = Window.partitionBy(*key_names)
        out = base.withColumns({f"__x_{m}": F.max(m).over(w) for m in mnames})
        conds = [F.col(m) == F.col(f"__x_{m}") for m in mnames]
        conds += [F.col(k).isNotNull() for k in key_names if k not in null_safe_keys]
        return out.filter(reduce(lambda a, b: a & b, conds)).select(*cols)

    wide = base if over is None else over.withColumns(derived) if derived else over
    agg = wide.groupBy(*key_names).agg(*[F.max(m).alias(f"__x_{m}") for m in mnames])
    agg = agg.select(*jk, *[f"__x_{m}" for m in mnames])
    a, b = base.alias("__l"), agg.alias("__r")
    conds = []
    for k in jk:
        lc, rc = F.col(f"__l.{k}"), F.col(f"__r.{k}")
        conds.append(lc.eqNullSafe(rc) if k in null_safe_keys else lc == rc)
    conds += [F.col(f"__l.{m}") == F.col(f"__r.__x_{m}") for m in mnames]
    return a.join(b, reduce(lambda x, y: x & y, conds), "left_semi").select(*cols)


def last_per_key(df: DataFrame, keys, order, strategy: str = "aggregate") -> DataFrame:
    """The rank-1 row per key under ``ORDER BY order DESC`` (row_number() = 1).

    ``order`` is a list of names / Columns, most significant first; put a
    tie-break last so the choice is deterministic.  NULL sorts lowest.

    ``aggregate`` computes ``max(struct(order..., row...))`` per key – a
    map-side combinable aggregate, so hot keys shrink before the shuffle.
    ``window`` uses ``row_number()`` (Catalyst adds a partial group limit).
    """
    cols = df.columns
    ks = named(keys, "__k")
    os_ = named(order, "__o")
    derived = {n: e for n, e, plain in ks + os_ if not plain}
    base = df.withColumns(derived) if derived else df
    key_names = [n for n, _, _ in ks]
    order_names = [n for n, _, _ in os_]
    if strategy == "window":
        w = Window.partitionBy(*key_names).orderBy(*[F.col(o).desc_nulls_last() for o in order_names])
        return (base.withColumn("__rn", F.row_number().over(w))
                .filter(F.col("__rn") == 1).select(*cols))
    payload = [c for c in cols if c not in key_names]
    packed = F.struct(*[F.col(o).alias(f"__s{i}") for i, o in enumerate(order_names)],
                      F.struct(*payload).alias("__row"))
    top = base.groupBy(*key_names).agg(F.max(packed).alias("__top"))
    return top.select(*[F.col(k) for k in key_names if k in cols],
                      *[F.col(f"__top.__row.{c}").alias(c) for c in payload]).select(*cols)


def row_number(df: DataFrame, keys, order, out: str = "rank") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order DESC)``; NULL keys are one group, NULLs rank last.

    ``order`` must be a total order within a key (add a tie-break).  The rows of a key are sorted,
    with spilling, in one task, as any numbering without gaps needs; to keep only the first
    rows of a key use ``last_per_key``, which is combined before the shuffle, and where one key may
    hold more rows than a task should sort, ``row_number_ranges``.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return df.withColumn(out, F.row_number().over(w))


def row_number_ranges(df: DataFrame, keys, order, out: str = "rank", ranges: int | None = None) -> DataFrame:
    """The numbers of ``row_number``, as long, with the rows of one key spread over many tasks.

    The rows are cut into ``ranges`` (default: the shuffle partitions) of the total order of keys and ``order``, once,
    in a written table.  Each range numbers its own rows; a key that goes on from earlier ranges adds the rows
    these hold of it.  At most one key goes on into a range, so these sums are at most as many rows as
    ranges.  Rows that tie in keys and ``order`` fall into one range and are numbered as ``row_number`` would, in
    any order.  NULL keys are one group; an empty table gives an empty one.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    down = [F.col(o).desc_nulls_last() for o in order]
    dealt = df.repartitionByRange(n, *[F.col(k).asc() for k in keys], *down).withColumn("__slot", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    held = dealt.groupBy(*keys, "__slot").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    before = (held.withColumn("__before", F.sum("__n").over(earlier)).where("__before > 0")
              .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__slot").alias("__in"), "__before"))
    own = dealt.withColumn("__own", F.row_number().over(Window.partitionBy("__slot", *keys).orderBy(*down)))
    conds = [own[k].eqNullSafe(before[f"__k{i}"]) for i, k in enumerate(keys)] + [own["__slot"] == before["__in"]]
    rank = F.col("__own") + F.coalesce("__before", F.lit(0).cast("long"))
    return (own.join(F.broadcast(before), reduce(lambda a, b: a & b, conds), "left")
            .select(*[own[c] for c in df.columns if c != out], rank.alias(out)))
