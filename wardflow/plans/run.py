"""Run a ``LoadSpec``: one function, DataFrames in, DataFrame (or a write) out."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.functions import rules as R
from wardflow.functions.hashing import hash_columns
from wardflow.operators.delta import new_records
from wardflow.operators.latest import latest_joint_max
from wardflow.operators.lookup import prepare_lookup, shared_lookup, standardise
from wardflow.plans.spec import LoadSpec, Rule
from wardflow.plans.contracts import contract
from wardflow.sources.audit import RuleAudit, audited
from wardflow.sources.conform import checked, fitting, rejected
from wardflow.sources.sinks import append, snapshot
from wardflow.sources.versions import VersionedTable

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None if nothing was ever written there; any other read error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class FrameIO:
    """Tables and targets held as DataFrames (tests, test-table queries)."""

    def __init__(self, tables: dict[str, DataFrame], targets: dict[str, DataFrame] | None = None):
        self.tables = tables
        self.targets = targets or {}

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def target(self, name: str) -> DataFrame | None:
        return self.targets.get(name)

    def write(self, df: DataFrame, name: str, partitions) -> None:
        df.write.format("noop").mode("overwrite").save()


class ParquetIO:
    """Sources under ``source_dir/<table>``, targets under ``target_dir/<target>``.

    Write parallelism: the source jobs fixed 50 writers (or a configured count)
    for database inserts.  For files that would make 2 TB tasks at 100 TB, so by
    default every write is an AQE ``REBALANCE`` sized from the data;
    ``fixed_partitions=True`` honours the spec's counts (``"config"`` ->
    ``default_partitions``).  ``partition_by`` lays targets out by a column
    (e.g. SiteCode) so later loads can prune them.
    """

    def __init__(self, spark: SparkSession, source_dir: str, target_dir: str,
                 default_partitions: int | None = None, fixed_partitions: bool = False,
                 partition_by: tuple = ()):
        self.spark, self.source_dir, self.target_dir = spark, source_dir, target_dir
        self.default_partitions = default_partitions
        self.fixed_partitions = fixed_partitions
        self.partition_by = tuple(partition_by)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.source_dir}/{name}")

    def target(self, name: str) -> DataFrame | None:
        return read_if_present(self.spark, f"{self.target_dir}/{name}")

    def write(self, df: DataFrame, name: str, partitions) -> None:
        n = None
        if self.fixed_partitions:
            n = self.default_partitions if partitions == "config" else partitions
        by = [c for c in self.partition_by if c in df.columns] or None
        append(df, f"{self.target_dir}/{name}", num_partitions=n, partition_by=by)


class VersionedIO(ParquetIO):
    """As ``ParquetIO``, but targets are tables with versions: a batch is seen whole or not at all, and once."""

    def target(self, name: str) -> DataFrame | None:
        return VersionedTable(self.spark, f"{self.target_dir}/{name}").read()

    def write(self, df: DataFrame, name: str, partitions, batch: str | None = None) -> bool:
        """False if the batch was committed before: nothing is run then."""
        table = VersionedTable(self.spark, f"{self.target_dir}/{name}")
        if batch and table.holds(batch):
            return False
        table.append(df, batch or uuid.uuid4().hex, [c for c in self.partition_by if c in df.columns])
        return True


class JdbcIO:
    """Sources and targets in relational databases, read and written over JDBC.

    ``sources`` maps a spec table name to a table name or a SQL text (read as a
    derived table, so filters in the text run in the database); ``partitioned``
    maps a table to ``(column, lower, upper, num_partitions)`` for split reads.
    Targets are read key-columns-only by the anti join (column pruning reaches
    the JDBC query) and appended with the spec's writer count – fixed counts
    make sense here: they bound concurrent database connections.  No
    connection is opened until an action runs.
    """

    def __init__(self, spark: SparkSession, source_url: str, target_url: str,
                 sources: dict[str, str] | None = None, partitioned: dict | None = None,
                 default_partitions: int | None = None, properties: dict | None = None):
        from wardflow.sources.readers import jdbc_options
        self._opts = jdbc_options
        self.spark, self.source_url, self.target_url = spark, source_url, target_url
        self.sources, self.partitioned = sources or {}, partitioned or {}
        self.default_partitions, self.properties = default_partitions, dict(properties or {})

    def _read(self, url: str, name: str) -> DataFrame:
        text = self.sources.get(name, name)
        is_query = text.strip().lower().startswith("select")
        part = self.partitioned.get(name)
        opts = self._opts(url, text=text if is_query else None, table=None if is_query else text,
                          partition_column=part[0] if part else None, lower=part[1] if part else None,
                          upper=part[2] if part else None, num_partitions=part[3] if part else None,
                          **self.properties)
        return self.spark.read.format("jdbc").options(**opts).load()

    def table(self, name: str) -> DataFrame:
        # forms and parents lie in the source database, lookup tables beside the targets
        url = self.target_url if name.lower().startswith("lkp_") else self.source_url
        return self._read(url, name)

    def target(self, name: str) -> DataFrame | None:
        return self._read(self.target_url, name)

    def write(self, df: DataFrame, name: str, partitions) -> None:
        n = self.default_partitions if partitions == "config" else partitions
        out = df.repartition(n) if n else df
        (out.write.format("jdbc").options(url=self.target_url, dbtable=name, **self.properties)
         .mode("append").save())


def _expr(e) -> Column:
    if isinstance(e, Column):
        return e
    return F.col(e) if _IDENT.match(e) else F.expr(e)


def _key(e, i: int, prefix: str):
    """Spec key -> operator key: plain names stay, expressions get an alias."""
    if isinstance(e, str) and _IDENT.match(e):
        return e
    return (f"{prefix}{i}", _expr(e))


def _rule_column(r: Rule, as_of: dt.date) -> Column:
    kw = r.kwargs()
    c = F.col(r.column)
    k = r.kind
    if k == "blank":
        return R.blank_to_null(c)
    if k == "sentinel":
        return R.sentinel_to_null(c, kw["tokens"])
    if k == "default":
        return R.null_default(c, kw["value"])
    if k == "date":
        hi = kw.get("hi", "today")
        if hi == "today":
            hi = as_of
        elif hi == "today+1y":
            hi = F.add_months(F.lit(as_of), 12)
        lo = kw.get("lo")
        return R.clamp_date(c, lo, hi, kw.get("fill", R.SENTINEL_DATE), kw.get("blank", False),
                            kw.get("text", False))
    if k == "number":
        return R.clamp_number(c, kw.get("lo"), kw.get("hi"), kw.get("fill", R.SENTINEL_NUMBER), kw.get("text", True),
                              lo_open=kw.get("lo_open", False))
    if k == "cap":
        return R.cap_to_null(c, kw.get("hi"), kw.get("lo"))
    if k == "recode":
        default = kw.get("default", "keep")
        return R.recode(c, dict(kw["mapping"]), R.KEEP if default == "keep" else default)
    if k == "present":
        return R.present_flag(c)
    if k == "negative":
        return R.negative_label(c, kw["label"])
    raise ValueError(f"unknown rule kind {k}")


def _apply_latest(df: DataFrame, lt, over: DataFrame | None = None) -> DataFrame:
    keys = [_key(k, i, "__lk") for i, k in enumerate(lt.keys)]
    groups = lt.maxes if lt.maxes and isinstance(lt.maxes[0], tuple) else (lt.maxes,)
    maxes = [[_key(m, 10 * g + i, "__lm") for i, m in enumerate(grp)] for g, grp in enumerate(groups)]
    jk = None
    if lt.join_keys is not None:
        jk = [k if isinstance(k, str) else k[0] for k, spec_k in zip(keys, lt.keys) if spec_k in lt.join_keys]
    return latest_joint_max(df, keys, maxes if len(maxes) > 1 else maxes[0], join_keys=jk, over=over)


def _apply_rules(df: DataFrame, rules, as_of: dt.date, audit: RuleAudit | None = None) -> DataFrame:
    """Rules on one column in order; different columns in one projection."""
    by_col: dict[str, list[Rule]] = {}
    for r in rules:
        by_col.setdefault(r.column, []).append(r)
    for level in range(max(map(len, by_col.values()), default=0)):
        due = {c: rs[level] for c, rs in by_col.items() if len(rs) > level}
        cleaned = {c: _rule_column(r, as_of) for c, r in due.items()}
        if audit is not None:
            again = {c: sum(r.kind == due[c].kind for r in by_col[c][:level]) for c in due}
            df = audit.watch(df, {f"{c} {r.kind}" + f" {again[c] + 1}" * bool(again[c]): (F.col(c), cleaned[c])
                                  for c, r in due.items()})
        df = df.withColumns(cleaned)
    return df


def _join_parent(df: DataFrame, p, io) -> DataFrame:
    parent = io.table(p.table)
    if p.where:
        parent = parent.filter(F.expr(p.where))
    outs = {out.lower() for _, out in p.columns}
    # a child join column spelled like a parent output column (PatientId vs
    # PatientID) is renamed first; names resolve case-insensitively; other child
    # columns of that name are replaced by the parent's value
    ren = {cc: f"__fk_{cc}" for cc, _ in p.on if cc.lower() in outs}
    if ren:
        df = df.withColumnsRenamed(ren)
    clash = [c for c in df.columns if c.lower() in outs]
    if clash:
        df = df.drop(*clash)
    keep = [F.col(pc).alias(f"__p_{pc}") for _, pc in p.on] + [F.col(pc).alias(out) for pc, out in p.columns]
    parent = parent.select(*keep)
    cond = None
    for cc, pc in p.on:
        e = df[ren.get(cc, cc)] == parent[f"__p_{pc}"]
        cond = e if cond is None else cond & e
    if p.kind == "semi":
        return df.join(parent.select(*[f"__p_{pc}" for _, pc in p.on]), cond, "left_semi")
    return df.join(parent, cond, "inner").drop(*[f"__p_{pc}" for _, pc in p.on])


def _mentions(e: str, names: set[str]) -> bool:
    """Whether an expression text uses one of these columns (lower case)."""
    return any(w.lower() in names for w in re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", e)))


def _made(parents) -> set[str]:
    """The columns that a chain of parents brings, in lower case."""
    return {out.lower() for p in parents for _, out in p.columns}


def _form_keys(parents) -> list[str]:
    """The form's columns that a chain of parents is joined by."""
    fks: list[str] = []
    outs: set[str] = set()
    for p in parents:
        fks += [cc for cc, _ in p.on if cc.lower() not in outs and cc not in fks]
        outs |= {out.lower() for _, out in p.columns}
    return fks


def _measures(lt) -> list[str]:
    grouped = lt.maxes and isinstance(lt.maxes[0], tuple)
    return list(dict.fromkeys(m for group in lt.maxes for m in group)) if grouped else list(lt.maxes)


def _latest_then_parents(form: DataFrame, spec: LoadSpec, io, as_of: dt.date, tgt: DataFrame | None = None) -> DataFrame | None:
    """The latest rule over joined rows, decided on narrow rows.

    The form is reduced to one row per (foreign keys, its own grouping keys) with
    the greatest measures; the parents' keys are joined to these rows, and each
    key's maxima are taken there (a window over as many rows as a key has foreign
    keys).  Only the rows that can hold the maxima, and that a target ``tgt`` does not know
    (see ``_narrow_delta``), are given the parents' other columns, and carry them to the form, which is
    joined once, on foreign keys, keys and measures.  None if a measure is not the form's own.
    """
    lt = spec.latest
    over = spec.parents if lt.over is None else lt.over
    made, maxes = _made(over), _measures(lt)
    if any(_mentions(m, made) for m in maxes):
        return None
    fks = list(dict.fromkeys([*_form_keys(over), *_form_keys(spec.parents)]))
    mine = [i for i, k in enumerate(lt.keys) if not _mentions(k, made)]
    keys = [f"__k{i}" for i in range(len(lt.keys))]
    joined = keys if lt.join_keys is None else [f"__k{i}" for i, k in enumerate(lt.keys) if k in lt.join_keys]
    marked = form.withColumns({f"__k{i}": _expr(lt.keys[i]) for i in mine} | {f"__m{j}": _expr(m) for j, m in enumerate(maxes)}
                              | {f"__f{i}": F.col(c) for i, c in enumerate(fks)})
    links = [f"__f{i}" for i in range(len(fks))]
    of_form = [f"__k{i}" for i in mine]
    best = [f"__m{j}" for j in range(len(maxes))]
    top = [f"__x{j}" for j in range(len(maxes))]

    narrow = marked.groupBy(*links, *of_form).agg(*[F.max(m).alias(m) for m in best])
    narrow = narrow.withColumns({c: F.col(f"__f{i}") for i, c in enumerate(fks)})
    for p in over:
        narrow = _join_parent(narrow, p, io)
    narrow = narrow.withColumns({f"__k{i}": _expr(k) for i, k in enumerate(lt.keys) if i not in mine})
    narrow = narrow.where(reduce(and_, [F.col(k).isNotNull() for k in joined]))
    keys = [*joined, *[k for k in keys if k not in joined]]
    if joined != keys:  # both windows and the de-duplication below in one shuffle
        narrow = narrow.repartition(*joined)
    narrow = narrow.withColumns({x: F.max(m).over(Window.partitionBy(*keys)) for x, m in zip(top, best, strict=True)})
    if joined == keys:
        narrow = narrow.where(reduce(and_, [F.col(x) == F.col(m) for x, m in zip(top, best, strict=True)]))
    else:  # maxima of any group that agrees in the coarser keys
        seen = F.collect_set(F.struct(*top)).over(Window.partitionBy(*joined))
        narrow = narrow.withColumn("__sets", seen).withColumn("__seen", F.explode("__sets")).withColumns({x: F.col(f"__seen.{x}") for x in top})
        narrow = narrow.where(reduce(and_, [F.col(x) <= F.col(m) for x, m in zip(top, best, strict=True)]))
    of_parents = [k for k in joined if k not in of_form]
    narrow = narrow.select(*of_parents, *links, *of_form, *top).dropDuplicates()
    if tgt is not None:
        narrow = _unknown(narrow, spec, as_of, tgt)
    narrow = narrow.withColumns({c: F.col(f"__f{i}") for i, c in enumerate(fks)})
    for p in spec.parents:
        narrow = _join_parent(narrow, p, io)
    same = [_expr(k) == F.col(f"__k{i}") for i, k in enumerate(lt.keys) if f"__k{i}" in of_parents]
    narrow = narrow.where(reduce(and_, same)) if same else narrow
    outs = [out for p in spec.parents if p.kind != "semi" for _, out in p.columns]
    narrow = narrow.select(*[F.col(c).alias(f"__w{c}") for c in (*links, *of_form, *top)], *outs)
    rows = marked.drop(*[c for c in form.columns if c.lower() in {o.lower() for o in outs}])
    on = [rows[c] == narrow[f"__w{c}"] for c in links]
    on += [rows[k] == narrow[f"__w{k}"] if k in joined else rows[k].eqNullSafe(narrow[f"__w{k}"]) for k in of_form]
    on += [rows[m] == narrow[f"__w{x}"] for m, x in zip(best, top, strict=True)]
    kept = [c for c in form.columns if c in rows.columns]
    return rows.join(narrow, reduce(and_, on)).select(*kept, *outs)


def _narrow_delta(spec: LoadSpec) -> dict[str, str] | None:
    """Where the delta's columns lie in the narrow rows of the latest rule; None if these do not hold them all.

    They do if each column is a key of the rule, a plain one, and one joined back on if it comes from a parent; if what the
    select list makes of it needs no other column; and if no lookup changes it."""
    lt = spec.latest
    if lt is None or lt.stage != "joined" or not _source_keys(spec):
        return None
    over, brought = _made(spec.parents if lt.over is None else lt.over), _made(spec.parents)
    if any(_mentions(m, over) for m in _measures(lt)):
        return None
    at = {k.lower(): f"__k{i}" for i, k in enumerate(lt.keys)
          if _IDENT.match(k) and (k.lower() not in over | brought
                                  or k.lower() in over & brought and (lt.join_keys is None or k in lt.join_keys))}
    told = [c for c in spec.columns if any(_mentions(k, {c.lower()}) for k in _source_keys(spec))]
    names = {c.lower() for c in told}
    barred = {lk.column.lower() for lk in spec.lookups} | {c.lower() for c in spec.nulls}
    others = {c.lower() for c in spec.columns} - names
    if not names <= at.keys() - barred or any(c.lower() in names and _mentions(e, others) for c, e in spec.select):
        return None
    return {c: at[c.lower()] for c in told}


def _unknown(narrow: DataFrame, spec: LoadSpec, as_of: dt.date, tgt: DataFrame) -> DataFrame:
    """The narrow rows whose delta key, as the select list and the rules leave it, is not in the target."""
    at = _narrow_delta(spec)
    mine = {c.lower() for c in at}
    df = narrow.withColumns({c: F.col(k) for c, k in at.items()})
    made = {c: F.expr(e) for c, e in spec.select if c.lower() in mine}
    df = df.withColumns(made) if made else df
    for rules in (spec.select_rules, spec.rules):
        df = _apply_rules(df, [r for r in rules if r.column.lower() in mine], as_of)
    return _not_loaded(spec, df, tgt).select(*narrow.columns)


def _form(spec: LoadSpec, io, as_of: dt.date | None) -> DataFrame:
    df = io.table(spec.source)
    if spec.derived:
        lit = f"DATE '{(as_of or dt.date.today()).isoformat()}'"
        df = df.withColumns({n: _expr(e.replace("{as_of}", lit)) for n, e in spec.derived})
    return df


def scan(spec: LoadSpec, io, as_of: dt.date | None = None, marked: DataFrame | None = None,
         tgt: DataFrame | None = None) -> DataFrame:
    """Form scan: latest rule, parent joins, filters, scan-level GROUP BY.

    ``marked``: the form with columns for a latest rule over it, which is then left to the caller.
    ``tgt``: the target, where ``_narrow_delta`` lets the latest rule leave out what it holds."""
    df = _form(spec, io, as_of) if marked is None else marked
    lt = spec.latest
    if marked is None and lt is not None and lt.stage == "form":
        df = _apply_latest(df, lt)
    form = df
    at_once = _latest_then_parents(form, spec, io, as_of, tgt) if lt is not None and lt.stage == "joined" else None
    if at_once is None:
        for p in spec.parents:
            df = _join_parent(df, p, io)
    else:
        df = at_once
    if at_once is None and lt is not None and lt.stage == "joined":
        over = None
        if lt.over is not None:
            over = form
            for p in lt.over:
                over = _join_parent(over, p, io)
        df = _apply_latest(df, lt, over)
    for w in spec.where:
        df = df.filter(F.expr(w))
    if spec.group_by:
        df = df.groupBy(*[_expr(g) for g in spec.group_by]).agg(
            *[F.expr(e).alias(n) for n, e in spec.aggregates])
    return df


def _selected(spec: LoadSpec, df: DataFrame, as_of: dt.date, beside=(), columns=None) -> DataFrame:
    """The output contract first: the DISTINCT of the source text is over its select list.

    Names resolve case-insensitively (EMR / Emr); the contract's spelling wins.  ``beside``: columns kept with it;
    ``columns``: a part of the contract, with all that the select list changes."""
    columns = spec.columns if columns is None else columns
    have = {c.lower(): c for c in df.columns}
    null = {c.lower() for c in spec.nulls}
    lacking = [c for c in columns if c.lower() not in have and c.lower() not in null]
    if lacking:
        raise ValueError(f"{spec.name}: the scan lacks contract columns {lacking}")
    df = df.select(*[(F.lit(None).cast("string") if c.lower() in null else F.col(f"`{have[c.lower()]}`")).alias(c)
                     for c in columns], *beside)
    if spec.select:
        df = df.withColumns({c: F.expr(e) for c, e in spec.select})
    return _apply_rules(df, spec.select_rules, as_of)


def _source_keys(spec: LoadSpec) -> list[str]:
    return [k[0] if isinstance(k, tuple) else k for k in (*spec.delta_keys, *spec.delta_plain_keys)]


def _not_loaded(spec: LoadSpec, df: DataFrame, tgt: DataFrame, **kw) -> DataFrame:
    def conv(k):
        return (_expr(k[0]), _expr(k[1])) if isinstance(k, tuple) else k
    return new_records(df, tgt, [conv(k) for k in spec.delta_keys], plain_keys=[conv(k) for k in spec.delta_plain_keys], **kw)


def _distinct_new(spec: LoadSpec, io, as_of: dt.date, tgt: DataFrame | None) -> DataFrame:
    """The distinct select list of new rows, with its wide rows in one shuffle.

    Parents, latest rule, delta and DISTINCT each would shuffle whole rows by keys of their own.  Here all are
    decided on narrow rows: foreign keys, keys, measures, two hashes of the form's part of the select list and one
    (``__e``) of what else tells a row's fate.  These rows bring the parents' columns and one ``__e`` of each row of the
    select list to the whole rows, which meet them in one place, by a hash that spreads any hot key.  The join
    builds on the narrow side, so no whole row is sorted; a row that was counted once is passed on as it comes, and
    only repeated ones are held by the DISTINCT, which compares whole rows.
    """
    lt, marks = spec.latest, []
    form = marked = None
    if lt is not None and lt.stage == "form":
        groups = lt.maxes if lt.maxes and isinstance(lt.maxes[0], tuple) else (lt.maxes,)
        names = {m: f"__lm{i}" for i, m in enumerate(dict.fromkeys(m for g in groups for m in g))}
        keys = {k: f"__lk{i}" for i, k in enumerate(lt.keys)}
        form = _form(spec, io, as_of)
        form = form.withColumns({n: _expr(e) for e, n in [*keys.items(), *names.items()]})
        joined = [keys[k] for k in (lt.keys if lt.join_keys is None else lt.join_keys)]
        marks = [*joined, *names.values()]
        # rows that the rule cannot keep
        marked = form.where(reduce(and_, [F.col(c).isNotNull() for c in marks])).drop(*set(keys.values()) - set(joined))

    brought, null = _made(spec.parents), {c.lower() for c in spec.nulls}
    parents, where = spec.parents, [w for w in spec.where if _mentions(w, brought)]
    if any(c.lower() in brought or _mentions(e, brought) for c, e in spec.select) or any(r.column.lower() in brought for r in spec.select_rules):
        df, parents, where, brought = scan(spec, io, as_of, marked), (), [], set()  # the select list is made of both
    else:
        df = _form(spec, io, as_of) if marked is None else marked
        for w in spec.where:
            df = df if w in where else df.filter(F.expr(w))
    fks = _form_keys(parents)
    for c in fks:
        df = df.where(F.col(c).isNotNull())  # equal to no parent's key
    told_by = {c.lower(): c for c in [*(c for c in df.columns if c.lower() not in brought and any(_mentions(w, {c.lower()}) for w in where)), *fks]}
    beside = {f"__b{i}": c for i, c in enumerate(told_by.values())}
    mine = [c for c in spec.columns if c.lower() in null or c.lower() not in brought]
    df = _selected(spec, df, as_of, [F.col(c).alias(b) for b, c in beside.items()] + marks, mine)

    def with_nulls(cols) -> list[Column]:
        return [F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in cols]), *[F.col(f"`{c}`") for c in cols]]

    row = with_nulls(mine)
    keyed = [c for c in spec.columns if any(_mentions(k, {c.lower()}) for k in _source_keys(spec))] if tgt is not None else []
    own_keyed = [c for c in keyed if c in mine]
    ids = [*marks, "__o0", "__o1", "__e"]
    # hashes last and no column of theirs beside them: the optimiser restates what it knows of them for each later alias of such a column
    df = df.select(*[F.col(f"`{c}`").alias(f"__w{c}") for c in mine], *beside, *[F.col(f"`{c}`").alias(f"__c{c}") for c in own_keyed], *marks,
                   F.xxhash64(*row).alias("__o0"), F.xxhash64(F.lit("second"), *row).alias("__o1"),
                   F.xxhash64(*with_nulls([*beside, *marks])).alias("__e"))
    told = df.select(*[F.col(b).alias(c) for b, c in beside.items()], *[f"`__c{c}`" for c in own_keyed], *ids)
    for p in parents:
        told = _join_parent(told, p, io)
    for w in where:
        told = told.filter(F.expr(w))
    have = {c.lower(): c for c in told.columns}
    outs = {f"__p{i}": c for i, c in enumerate(c for c in spec.columns if c not in mine)}
    told = told.select(*[F.col(f"`{have[c.lower()]}`").alias(p) for p, c in outs.items()],
                       *[F.col(f"`__c{c}`" if c in mine else f"`{have[c.lower()]}`").alias(c) for c in keyed], *ids)
    if keyed:
        told = _not_loaded(spec, _apply_rules(told, [r for r in spec.rules if r.column in keyed], as_of), tgt)
    told = told.select(*outs, *ids)
    if marks:
        told = latest_joint_max(told, list(keys.values()), list(names.values()), join_keys=joined, over=form)
    hashes = ids[-3:]
    passed = (told.select(*outs, *hashes).repartition("__o0", "__o1").groupBy("__o0", "__o1", *outs)
              .agg(F.min("__e").alias("__e"), F.count("*").alias("__n")))
    passed = passed.withColumnsRenamed({c: f"__n{c}" for c in hashes}).hint("shuffle_hash")
    # equal __e as a range, which leaves the shuffle to the two hashes that a row of the select list has
    met = [F.col(c) == F.col(f"__n{c}") for c in hashes[:2]] + [F.col("__e") >= F.col("__n__e"), F.col("__e") <= F.col("__n__e")]
    rows = df.select(*[f"`__w{c}`" for c in mine], *hashes).join(passed, reduce(and_, met))
    at = {c: p for p, c in outs.items()}
    found = [F.col(f"`__w{c}`").alias(c) if c in mine else F.col(at[c]).alias(c) for c in spec.columns]
    return rows.where("__n = 1").select(*found).unionByName(
        rows.where("__n > 1").select("__o0", "__o1", *found).distinct().select(*spec.columns))


def build_load(spec: LoadSpec, io, as_of: dt.date, split_nulls: bool = False, prune_on=(),
               audit: RuleAudit | None = None) -> DataFrame:
    """The rows this load appends (lazy).  ``split_nulls`` / ``prune_on`` – see ``new_records``.

    ``audit`` counts the values that rules and lookups change in the scanned rows, new and known ones."""
    tgt = io.target(spec.target)
    looked_up = {lk.column.lower() for lk in spec.lookups}
    at_once = (spec.distinct and spec.sample_limit is None and not spec.group_by and audit is None and not split_nulls
               and not any(_mentions(k, looked_up) for k in _source_keys(spec))
               and (spec.latest.stage == "form" if spec.latest else tgt is not None and bool(_source_keys(spec))))
    if at_once:
        df, tgt = _distinct_new(spec, io, as_of, tgt), None
    else:
        early = (tgt is not None and spec.sample_limit is None and not spec.group_by and audit is None and not split_nulls
                 and _narrow_delta(spec) is not None)
        df = _selected(spec, scan(spec, io, as_of, tgt=tgt if early else None), as_of)
        tgt = None if early else tgt
        if spec.distinct:
            df = df.distinct()
        if spec.sample_limit is not None:
            df = df.limit(spec.sample_limit)
    df = _apply_rules(df, spec.rules, as_of, audit)
    if audit is not None:  # raw values beside the lookups' answers
        df = df.withColumns({f"__raw{i}": F.col(lk.column) for i, lk in enumerate(spec.lookups)})
    prepared: dict = {}
    idents = [(lk.table, lk.source, lk.target, lk.case_insensitive) for lk in spec.lookups]
    for lk, ident in zip(spec.lookups, idents, strict=True):
        if ident not in prepared:
            one = prepare_lookup(io.table(lk.table), lk.source, lk.target, lk.case_insensitive)
            prepared[ident] = shared_lookup(one) if idents.count(ident) > 1 else one
        df = standardise(df, lk.column, prepared[ident], case_insensitive=lk.case_insensitive,
                         default=R.KEEP if lk.default is None else lk.default, prepared=True)
    if audit is not None:
        df = audit.watch(df, {f"{lk.column} lookup": (F.col(f"__raw{i}"), F.col(lk.column)) for i, lk in enumerate(spec.lookups)})
    if tgt is not None and (spec.delta_keys or spec.delta_plain_keys):
        df = _not_loaded(spec, df, tgt, split_nulls=split_nulls, prune_on=[c for c in prune_on if c in spec.delta_keys])
    if spec.hashes:
        df = hash_columns(df, dict(spec.hashes))
    return df.select(*spec.columns, *[h for _, h in spec.hashes])


def typed_load(spec: LoadSpec, io, as_of: dt.date, audit: RuleAudit | None = None) -> DataFrame:
    """The load in its target's types; rows that do not fit name their misfits (see ``checked``)."""
    return checked(build_load(spec, io, as_of, audit=audit), *contract(spec))


def run_load(spec: LoadSpec, io, as_of: dt.date, batch: str | None = None, audit_rules: bool = False) -> dict:
    """Append the new rows to the target, and those that do not fit its types to ``<target>_rejects``.

    The load is evaluated once; returns the counts of both.  ``batch``: the id under
    which a back end with versions commits, so that a retry adds nothing twice.  ``audit_rules`` adds
    how many values each rule and lookup changed in the scanned rows, known ones included.
    """
    audit = RuleAudit() if audit_rules else None
    with snapshot(typed_load(spec, io, as_of, audit)) as rows:
        out, new = audited(fitting(rows), spec.name)
        aside, kept = audited(rejected(rows), f"{spec.name}_rejects")
        extra = {"batch": batch} if batch else {}
        # counts of a write that was not run would be waited for without end
        set_aside = io.write(aside, f"{spec.target}_rejects", None, **extra) is not False
        added = io.write(out, spec.target, spec.write_partitions, **extra) is not False
        counts = {"spec": spec.name, "new_rows": new.get.get("rows", 0) if added else 0,
                  "rejected_rows": kept.get.get("rows", 0) if set_aside else 0}
        return counts | ({"rules": audit.counts if set_aside else {}} if audit else {})
