"""Constraints as validation jobs (V-01 .. V-10).

Every check returns rows ``(check_name, table_name, constraint_type,
violations)``. Row-local checks of one table (NOT NULL, CHECK, domain) are
evaluated together in a single aggregate pass over that table. Reports over
many constraints take one scan a table and one shuffle for all keys
(``key_groups``): rows of a key meet the keys that refer to it, counted before
the shuffle, so hot keys are absorbed and nothing is joined.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airdata.operators.scan import ranges_of
from airdata.schema import Check, Domain, ForeignKey, NotNull, Unique

REPORT_COLS = ("check_name", "table_name", "constraint_type", "violations")


def _report(frames):
    frames = [f.select(*REPORT_COLS) for f in frames]
    return reduce(DataFrame.unionByName, frames)


def _row(check_name, table, ctype, violations: str) -> str:
    return (f"named_struct('check_name', '{check_name}', 'table_name', '{table}', 'constraint_type', '{ctype}', "
            f"'violations', coalesce(cast({violations} AS bigint), 0L))")


def _listed(one_row: DataFrame, rows: list[str]) -> DataFrame:
    """A row a struct (SQL over the columns of a one-row frame)."""
    return one_row.select(F.expr(f"inline(array({', '.join(rows)}))"))


def _violated(c) -> tuple[str, str]:
    """Constraint type and violation condition (SQL) of a row-local constraint."""
    if isinstance(c, NotNull):
        return "NOT NULL", f"`{c.column}` IS NULL"
    if isinstance(c, Check):
        # CHECK passes on NULL: violation only when the predicate is false.
        return "CHECK", f"NOT coalesce(({c.predicate}), true)"
    if isinstance(c, Domain):
        values = ", ".join("'" + v.replace("'", "\\'") + "'" for v in c.values)
        return "DOMAIN", f"coalesce(`{c.column}` NOT IN ({values}), false)"
    raise TypeError(c)


def row_local_checks(df: DataFrame, table: str, checks) -> DataFrame:
    """NOT NULL, CHECK and domain checks of one table in one pass."""
    specs = [(c.name, *_violated(c)) for c in checks]
    if not specs:
        return None
    agg = df.agg(F.expr(f"named_struct({', '.join(f"'_{i}', count_if({cond})" for i, (_, _, cond) in enumerate(specs))})").alias("v"))
    return _listed(agg, [_row(name, table, ctype, f"v._{i}") for i, (name, ctype, _) in enumerate(specs)])


def check_not_null(df: DataFrame, table: str, columns) -> DataFrame:
    """V-01."""
    return row_local_checks(df, table, [NotNull(table, c) for c in columns])


def check_range(df: DataFrame, table: str, checks) -> DataFrame:
    """V-02 / V-03: CHECK predicates (single or cross column)."""
    return row_local_checks(df, table, checks)


def check_domain(df: DataFrame, table: str, domains) -> DataFrame:
    """V-07: values outside an enum domain."""
    return row_local_checks(df, table, domains)


def check_unique(df: DataFrame, u: Unique) -> DataFrame:
    """V-04 / V-05: number of key values held by more than one row.
    Rows with a null in the key never collide (SQL unique semantics); a
    partial index adds ``where_not_null`` filters."""
    d = df
    for c in set(u.columns) | set(u.where_not_null):
        d = d.filter(F.col(c).isNotNull())
    dup = (d.groupBy(*u.columns).agg(F.count(F.lit(1)).alias("_c"))
            .filter(F.col("_c") > 1).agg(F.count(F.lit(1)).alias("_v")))
    return _listed(dup, [_row(u.name, u.table, "UNIQUE", "_v")])


def check_foreign_key(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """V-06: child rows whose non-null key has no parent (null FK is legal)."""
    cols = list(fk.columns)
    d = child
    for c in cols:
        d = d.filter(F.col(c).isNotNull())
    per_key = d.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, cols)])
    missing = per_key.join(keys, cols, "left_anti").agg(F.sum("_c").alias("_v"))
    return _listed(missing, [_row(fk.name, fk.child, "FOREIGN KEY", "_v")])


@dataclass(frozen=True)
class KeyDomain:
    """Keys that mean the same: those of a table, and of the foreign keys to it."""
    table: str
    columns: tuple[str, ...]
    where_not_null: tuple[str, ...] = ()
    unique: Unique | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()


def key_domains(uniques=(), foreign_keys=()) -> list[KeyDomain]:
    """A domain a unique key, with the foreign keys that refer to it, and one for
    every other set of columns that foreign keys refer to."""
    out = [KeyDomain(u.table, u.columns, tuple(sorted(set(u.where_not_null) - set(u.columns))), u) for u in uniques]
    for fk in foreign_keys:
        # a partial unique key with a condition on other columns does not hold all parents
        i = next((i for i, d in enumerate(out) if (d.table, d.columns) == (fk.parent, fk.parent_columns) and not d.where_not_null), None)
        if i is None:
            out.append(KeyDomain(fk.parent, fk.parent_columns, foreign_keys=(fk,)))
        else:
            out[i] = replace(out[i], foreign_keys=(*out[i].foreign_keys, fk))
    return out


def _slots(tables, domain: KeyDomain) -> list[tuple[str, str]]:
    """For each column of a domain its slot kind (long or string) and common type.
    Whole numbers fit a long, whatever their width, and so do the days of dates;
    other columns of one type are compared as its text, those of several as text."""
    out = []
    for i, c in enumerate(domain.columns):
        kinds = {tables[t].schema[n].dataType for t, n in
                 [(domain.table, c), *((fk.child, fk.columns[i]) for fk in domain.foreign_keys)]}
        if all(isinstance(k, T.IntegralType) for k in kinds):
            out.append(("l", "bigint"))
        elif kinds == {T.DateType()}:
            out.append(("l", "date"))
        else:
            out.append(("s", "string"))
    return out


def key_groups(tables: dict[str, DataFrame], domains: list[KeyDomain], local: dict[str, list] | None = None, known_only: bool = False) -> DataFrame:
    """One row a distinct key of each domain: ``g`` (the domain's number), ``known``
    (no null in the key), ``own`` (rows of the table) and ``c0``, ``c1``, ... (rows
    of each foreign key).

    Every table is scanned once, whatever the number of its keys: a row puts out
    its key once a domain, for itself and as parent alike, and once a foreign
    key. Keys keep their type in the slots of one row layout, so all tables and
    domains meet in one shuffle, and equal keys are equal without a second look;
    rows of a task are counted before. ``local`` adds conditions of a row: table ->
    (number, SQL condition); a row puts out the numbers of those that hold.

    ``known_only`` leaves out keys with a null. If nothing refers to any of the
    others, they hardly ever repeat: they are dealt by key into as many tasks as
    the session has shuffle partitions and counted there only, since a task that
    counts before the shuffle would hold all of its rows for nothing.
    """
    entries, names = _entries(tables, domains, local)
    if known_only:
        entries = entries.filter("known")
        if not local and not any(d.foreign_keys for d in domains):
            entries = entries.repartition(ranges_of(entries), "g", "known", *names)
    most = max([len(d.foreign_keys) for d in domains], default=0)
    counted = [F.expr(f"count_if(role = {j})").alias(n) for j, n in enumerate(["own", *(f"c{i}" for i in range(most))])]
    return entries.groupBy("g", "known", *names).agg(*counted)


def _entries(tables, domains: list[KeyDomain], local) -> tuple[DataFrame, list[str]]:
    """A row a key that a row puts out, and the names of its slots."""
    slots = [_slots(tables, d) for d in domains]
    widths = {k: max([sum(kind == k for kind, _ in s) for s in slots], default=0) for k in "ls"}
    names = [f"{k}{i}" for k in "ls" for i in range(widths[k])]

    def entry(g, role, columns=(), slot=()):
        at, values = dict.fromkeys("ls", 0), {}
        for c, (kind, of) in zip(columns, slot):
            values[f"{kind}{at[kind]}"] = f"cast(unix_date(`{c}`) AS bigint)" if of == "date" else f"cast(`{c}` AS {of})"
            at[kind] += 1
        known = " AND ".join(f"`{c}` IS NOT NULL" for c in columns) or "true"
        rest = "".join(f", '{n}', {values.get(n, f"cast(null AS {'bigint' if n[0] == 'l' else 'string'})")}" for n in names)
        return f"named_struct('g', {g}, 'role', {role}, 'known', {known}{rest})"

    entries: dict[str, list[str]] = {}
    for g, (d, slot) in enumerate(zip(domains, slots)):
        own = entry(g, 0, d.columns, slot)
        if d.where_not_null:
            own = f"CASE WHEN {' AND '.join(f'`{c}` IS NOT NULL' for c in d.where_not_null)} THEN {own} END"
        entries.setdefault(d.table, []).append(own)
        for j, fk in enumerate(d.foreign_keys):
            entries.setdefault(fk.child, []).append(entry(g, j + 1, fk.columns, slot))
    frames = []
    for t in sorted({*entries, *(local or {})}):
        keys = f"array({', '.join(entries[t])})" if t in entries else None
        if local and t in local:
            broken = ", ".join(f"CASE WHEN {cond} THEN {entry(g, 0)} END" for g, cond in local[t])
            any_broken = " OR ".join(f"({cond})" for _, cond in local[t])
            broken = f"CASE WHEN {any_broken} THEN array({broken}) ELSE array() END"
            keys = f"concat({keys}, {broken})" if keys else broken
        frames.append(tables[t].select(F.expr(f"inline({keys})")).filter("g IS NOT NULL"))
    return reduce(DataFrame.unionByName, frames), names


def _summary(groups: DataFrame, per_domain: dict[str, str]) -> DataFrame:
    """One row ``m``: domain -> the values of ``per_domain``, aggregates (SQL) over its groups."""
    by = groups.groupBy("g").agg(*[F.expr(f"cast({c} AS bigint)").alias(n) for n, c in per_domain.items()])   # a row a domain
    return by.agg(F.map_from_entries(F.collect_list(F.struct("g", F.struct(*per_domain)))).alias("m"))


def constraint_report(tables: dict[str, DataFrame], not_null=(), checks=(), uniques=(),
                      foreign_keys=(), domains=()) -> DataFrame:
    """V-09: one row per declared constraint with its violation count.

    One scan a table and one shuffle for all of them (``key_groups``). A unique
    key is violated once a key that several rows hold, a foreign key once a row
    whose key has no parent; a null in a key violates neither. A constraint
    whose table or column is absent is an error of the caller."""
    keyed, numbered, local = key_domains(uniques, foreign_keys), [], {}
    for c in [*not_null, *checks, *domains]:
        kind, condition = _violated(c)
        local.setdefault(c.table, []).append((len(keyed) + len(numbered), condition))
        numbered.append((c, kind))
    groups = key_groups(tables, keyed, local, known_only=True)
    most = max([len(d.foreign_keys) for d in keyed], default=0)
    lost = {f"lost{j}": f"sum(CASE WHEN own = 0 AND known THEN c{j} ELSE 0 END)" for j in range(most)}
    summary = _summary(groups, {"rows": "sum(own)", "twice": "count_if(own > 1 AND known)", **lost})
    rows = [_row(c.name, c.table, kind, f"try_element_at(m, {len(keyed) + i}).rows") for i, (c, kind) in enumerate(numbered)]
    for g, d in enumerate(keyed):
        if d.unique:
            rows.append(_row(d.unique.name, d.table, "UNIQUE", f"try_element_at(m, {g}).twice"))
        rows += [_row(fk.name, fk.child, "FOREIGN KEY", f"try_element_at(m, {g}).lost{j}") for j, fk in enumerate(d.foreign_keys)]
    return _listed(summary, rows)


def key_issues(tables: dict[str, DataFrame], primary_keys, foreign_keys) -> DataFrame:
    """Rows ``check_name, issue_count``: of a primary key the rows less its distinct
    values, of a foreign key the rows without a parent. Here a null counts, as a
    row without a value and as one without a parent. One scan a table."""
    keyed = key_domains([Unique(t, (c,), name) for name, t, c in primary_keys],
                        [ForeignKey(child, (c,), parent, (pk,), name) for name, child, c, parent, pk in foreign_keys])
    groups = key_groups(tables, keyed)
    most = max(len(d.foreign_keys) for d in keyed)
    lost = {f"lost{j}": f"sum(CASE WHEN own = 0 OR NOT known THEN c{j} ELSE 0 END)" for j in range(most)}
    summary = _summary(groups, {"extra": "sum(own) - count_if(own > 0 AND known)", **lost})
    rows = []
    for g, d in enumerate(keyed):
        of = [(d.unique.name, "extra")] if d.unique else []
        of += [(fk.name, f"lost{j}") for j, fk in enumerate(d.foreign_keys)]
        rows += [f"named_struct('check_name', '{name}', 'issue_count', coalesce(try_element_at(m, {g}).{v}, 0L))" for name, v in of]
    return _listed(summary, rows)


def apply_fk_action(parent_deleted: DataFrame, child: DataFrame, fk: ForeignKey) -> DataFrame:
    """V-08: the child table after its parent rows in ``parent_deleted`` (a
    frame of parent keys) are deleted, per the declared ON DELETE action.

    CASCADE -> anti join; SET NULL -> left join and null the key;
    RESTRICT / NO ACTION -> the child unchanged, but the caller must check
    ``restrict_violations`` is 0 before deleting.
    """
    cols = list(fk.columns)
    keys = parent_deleted.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, cols)]).distinct()
    if fk.on_delete == "CASCADE":
        return child.join(keys, cols, "left_anti")
    if fk.on_delete == "SET NULL":
        hit = keys.withColumn("_hit", F.lit(True))
        j = child.join(hit, cols, "left")
        return j.select(*[F.when(F.col("_hit").isNull(), F.col(c)).cast(child.schema[c].dataType).alias(c)
                          if c in cols else F.col(c) for c in child.columns])
    return child


def restrict_violations(parent_deleted: DataFrame, child: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows of ``child`` that block the deletion under RESTRICT."""
    cols = list(fk.columns)
    keys = parent_deleted.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, cols)]).distinct()
    return child.join(keys, cols, "left_semi")


class Restricted(Exception):
    """A deletion that foreign keys forbid; ``blocking`` has the rows that forbid it by foreign key."""

    def __init__(self, blocking: dict[str, int]):
        super().__init__(f"rows refer to what is to be deleted: {blocking}")
        self.blocking = blocking


def cascade_order(tables, foreign_keys) -> list[str]:
    """The tables, each after those whose deletions cascade to it."""
    parents = {t: {fk.parent for fk in foreign_keys if fk.child == t and fk.on_delete == "CASCADE"} for t in tables}
    out: list[str] = []
    while len(out) < len(parents):
        ready = sorted(t for t, of in parents.items() if t not in out and of <= set(out))
        if not ready:
            raise ValueError(f"deletions cascade in a circle among {sorted(set(parents) - set(out))}")
        out += ready
    return out


def delete_rows(tables: dict[str, DataFrame], foreign_keys, deleted: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """V-08 for the whole graph: all tables after the rows of ``deleted`` are gone.

    ``deleted``: table -> a frame of some of its columns; rows that equal one of
    its rows there are deleted. CASCADE deletes the rows that refer to a deleted
    one, and so on; SET NULL clears their key. Before any table is changed, the
    deletion is refused (``Restricted``) if a row refers to a deleted one by a
    RESTRICT key, unless it was asked to be deleted itself, or by a NO ACTION key
    and is still there at the end. Foreign keys between tables that are not given
    play no part. A table is joined once with the deleted keys of each foreign
    key that can be touched; only those keys are written down on the way.
    """
    fks = [fk for fk in foreign_keys if fk.child in tables and fk.parent in tables]
    order = cascade_order(tables, fks)
    touched = set(deleted)   # tables that can lose rows
    for t in order:
        touched |= {t} & {fk.child for fk in fks if fk.on_delete == "CASCADE" and fk.parent in touched}
    marked: dict[str, DataFrame] = {}
    gone: dict[tuple, DataFrame] = {}   # (table, columns) -> keys of the deleted rows

    def mark(t: str) -> DataFrame:
        """The rows of t with ``_asked`` and, for each touched foreign key, whether it refers to a deleted row."""
        d = tables[t]
        flags = []
        if t in deleted:
            d = _flagged(d, deleted[t].distinct(), deleted[t].columns, "_asked")
        else:
            d = d.withColumn("_asked", F.lit(False))
        for i, fk in enumerate(fks):
            if fk.child == t and (fk.parent, fk.parent_columns) in gone:
                d = _flagged(d, gone[fk.parent, fk.parent_columns].toDF(*fk.columns), fk.columns, f"_hit{i}")
                flags += [f"_hit{i}"] if fk.on_delete == "CASCADE" else []
        return d.withColumn("_gone", reduce(lambda a, b: a | b, map(F.col, flags), F.col("_asked")))

    for t in order:
        if t in touched:
            m = mark(t)
            for columns in {fk.parent_columns for fk in fks if fk.parent == t}:
                keys = m.filter("_gone").select(*columns).dropna().distinct()
                gone[t, columns] = keys.checkpoint()   # keys only
    for t in order:
        if t in touched or any(fk.child == t and (fk.parent, fk.parent_columns) in gone for fk in fks):
            marked[t] = mark(t)

    counts = []
    for i, fk in enumerate(fks):
        if fk.child in marked and f"_hit{i}" in marked[fk.child].columns and fk.on_delete in ("RESTRICT", "NO ACTION"):
            free = "_asked" if fk.on_delete == "RESTRICT" else "_gone"
            counts.append(marked[fk.child].agg(F.lit(fk.name).alias("name"), F.count_if(F.col(f"_hit{i}") & ~F.col(free)).alias("n")))
    if counts:
        blocking = {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).filter("n > 0").collect()}   # a row a foreign key
        if blocking:
            raise Restricted(blocking)

    out = dict(tables)
    for t, m in marked.items():
        cleared: dict[str, list[str]] = {}
        for i, fk in enumerate(fks):
            if fk.child == t and fk.on_delete == "SET NULL" and f"_hit{i}" in m.columns:
                for c in fk.columns:
                    cleared.setdefault(c, []).append(f"_hit{i}")
        kept = [F.when(~reduce(lambda a, b: a | b, map(F.col, cleared[c])), F.col(c)).alias(c) if c in cleared else F.col(c) for c in tables[t].columns]
        out[t] = m.filter("NOT _gone").select(*kept)
    return out


def _flagged(df: DataFrame, keys: DataFrame, columns, flag: str) -> DataFrame:
    """Add ``flag``: whether the row's key is one of the (distinct) keys; a null is none."""
    return df.join(keys.withColumn(flag, F.lit(True)), list(columns), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    """V-10: fail early with a clear message when an input has no rows.
    ``isEmpty`` reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"input table '{name}' has no usable rows")
    return df
