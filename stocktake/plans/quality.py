"""Declarative checks; each one yields a row with its number of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.operators.joins import unmatched
from stocktake.plans.silver import ASSET, ASSET_KEY

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """One rule on a table column.

    ``kind`` is ``not_null``, ``unique``, ``accepted_values``,
    ``relationships``, ``unique_key``, ``exclusive_flags`` or ``no_row_lost``.
    """

    kind: str
    table: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    severity: str = ERROR
    others: tuple[str, ...] = field(default=())

    @property
    def label(self) -> str:
        return ", ".join(self.columns)


def count_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``coluna, violacoes`` for all columns out of one scan."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("violacoes")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas"))
    return counted.filter(F.col("linhas") > 1)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """As ``repeated_keys`` for one column, NULL aside."""
    return repeated_keys(df.filter(F.col(column).isNotNull()), [column])


def unexpected_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-NULL values outside the list, with their number of rows."""
    offending = df.filter(~F.col(column).isin(*values))
    return offending.groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL values without a parent, with their number of rows.

    Rows are counted per value first, so only distinct values are joined.
    """
    children = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))
    return children.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def not_exclusive(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Rows whose 0/1 flags do not sum to one."""
    total = reduce(Column.__add__, [F.col(f) for f in flags])
    return df.filter(total != 1).select(*keys)


def lost_rows(readings: DataFrame, fact: DataFrame, rejected: DataFrame) -> DataFrame:
    """Readings found neither through the fact nor in the quarantine."""
    unseen = unmatched(readings, fact, ASSET_KEY, scatter_by=["id_leitura"])
    return unmatched(unseen, rejected, ["id_leitura"]).select("id_leitura")


def _count(df: DataFrame, amount: Column | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if amount is None else F.coalesce(F.sum(amount), F.lit(0))
    return df.agg(total.cast("bigint").alias("violacoes"))


def violations(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The number of violations of one check, as a one-row DataFrame."""
    df, column = tables[check.table], check.columns[0]
    if check.kind == "not_null":
        return count_nulls(df, [column]).select("violacoes")
    if check.kind == "unique":
        return _count(repeated_values(df, column))
    if check.kind == "unique_key":
        return _count(repeated_keys(df, check.columns))
    if check.kind == "accepted_values":
        return _count(unexpected_values(df, column, check.values))
    if check.kind == "relationships":
        return _count(orphans(df, column, tables[check.parent], check.parent_column), F.col("linhas"))
    if check.kind == "exclusive_flags":
        return _count(not_exclusive(df, ASSET, check.columns))
    if check.kind == "no_row_lost":
        return _count(lost_rows(df, *(tables[t] for t in check.others)))
    raise ValueError(f"unknown check {check.kind}")


#: Kinds by what is counted of their evidence: rows, different values, values that repeat, rows of values without a parent.
ROWS, VALUES, REPEATS, ORPHANS = ("not_null", "exclusive_flags"), ("accepted_values",), ("unique", "unique_key"), ("relationships",)
EVIDENCE = "verificado: int, valor: string, linhas: bigint, registrado: boolean"


def _evidence(number: int, check: Check) -> Column:
    """What a row of the check's table has to say on it, or NULL."""
    column = F.col(check.columns[0])
    value = F.lit(None).cast("string")
    if check.kind == "not_null":
        says = column.isNull()
    elif check.kind == "exclusive_flags":
        says = reduce(Column.__add__, [F.col(c) for c in check.columns]) != 1
    elif check.kind == "accepted_values":
        says, value = ~column.isin(*check.values), column.cast("string")
    elif check.kind == "unique_key":
        # as JSON, which tells the parts apart and leaves NULL ones out
        says, value = F.lit(True), F.to_json(F.struct(*check.columns))
    else:
        says, value = column.isNotNull(), column.cast("string")
    return F.when(says, _entry(number, value, 1, False))


def _entry(number: int, value: Column, lines: int, known: bool) -> Column:
    return F.struct(F.lit(number), value, F.lit(lines).cast("bigint"), F.lit(known)).cast(f"struct<{EVIDENCE}>")


def _line(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("verificacao"),
        F.lit(check.table).alias("tabela"),
        F.lit(check.label).alias("coluna"),
        F.lit(check.severity).alias("severidade"),
        violations.alias("violacoes"),
    )


def _counted_together(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of single rows, keys and parents: one scan per table and one grouping for all of them.

    Every row gives its evidence for each check, as grouping sets expand rows;
    parents give theirs for the checks of their children. Evidence is added up
    by check and value, map-side first, so a value that repeats a million times
    is sent once per task.
    """
    spark = next(iter(tables.values())).sparkSession
    asked: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        asked.setdefault(check.table, []).append(_evidence(number, check))
        if check.kind in ORPHANS:
            parent = F.col(check.parent_column)
            asked.setdefault(check.parent, []).append(F.when(parent.isNotNull(), _entry(number, parent.cast("string"), 0, True)))
    # a check without any evidence is in the report too
    every = spark.range(len(checks)).select(F.col("id").cast("int").alias("verificado"), F.lit(None).cast("string").alias("valor"), F.lit(0).cast("bigint").alias("linhas"), F.lit(False).alias("registrado"))
    found = [tables[name].select(F.inline(F.array_compact(F.array(*evidence)))) for name, evidence in asked.items()]
    values = reduce(DataFrame.unionByName, found, every).groupBy("verificado", "valor").agg(F.sum("linhas").alias("linhas"), F.max("registrado").alias("registrado"))

    def of(kinds: tuple[str, ...]) -> Column:
        return F.col("verificado").isin([i for i, check in enumerate(checks) if check.kind in kinds])

    lines = F.col("linhas")
    counted = F.when(of(ROWS), lines).when(of(VALUES), (lines > 0).cast("bigint")).when(of(REPEATS), (lines > 1).cast("bigint")).when(~F.col("registrado"), lines)
    totals = values.groupBy("verificado").agg(F.coalesce(F.sum(counted), F.lit(0)).alias("violacoes"))
    labels = F.array(*(_line(check, F.col("violacoes")) for check in checks))
    return totals.select(F.inline(F.array(F.element_at(labels, F.col("verificado") + 1))))


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: what, where, how severe, how many violations, status.

    Only the conservation check, which asks three tables at once, is a plan of
    its own; all others share one scan per table.
    """
    together = [c for c in checks if c.kind in (*ROWS, *VALUES, *REPEATS, *ORPHANS)]
    frames = [_counted_together(together, tables)] if together else []
    for check in checks:
        if check not in together:
            frames.append(violations(check, tables).select(F.inline(F.array(_line(check, F.col("violacoes"))))))
    failed = F.when(F.col("severidade") == WARN, "WARN").otherwise("FAIL")
    status = F.when(F.col("violacoes") == 0, "PASS").otherwise(failed)
    return reduce(DataFrame.unionByName, frames).withColumn("situacao", status)


def summary(report: DataFrame) -> DataFrame:
    """Number of checks per status."""
    return report.groupBy("situacao").agg(F.count(F.lit(1)).alias("verificacoes"))


class ChecksFailed(Exception):
    """At least one check of severity ``error`` has violations."""


def require_passed(report: DataFrame) -> None:
    """Raise if an error-level check failed; warnings only show in the report."""
    failed = report.filter(F.col("situacao") == "FAIL").collect()  # one row per check at most
    if failed:
        raise ChecksFailed("; ".join(f"{r['verificacao']} {r['tabela']}({r['coluna']}): {r['violacoes']}" for r in failed))
