"""Constraint audits: reports over whole tables, and the split into good and quarantined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.schemas import TableRules


def _broken(condition: Column) -> Column:
    """True only when the check fails; an unknown result passes, as in a CHECK constraint."""
    return F.coalesce(~condition, F.lit(False))


def range_checks(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {(name, "range"): _broken(F.col(name).between(low, high))
            for name, (low, high) in rules.ranges.items()}


def null_checks(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {(name, "not_null"): F.col(name).isNull() for name in rules.not_null}


def length_checks(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {(name, "length"): _broken(F.char_length(name) <= limit)
            for name, limit in rules.max_length.items()}


def report(df: DataFrame, checks: dict[tuple[str, str], Column]) -> DataFrame:
    """One row per check with its number of violations, from one pass over the table."""
    names = list(checks)
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(checks[name]).alias(f"_bad_{i}") for i, name in enumerate(names)],
    )
    lines = F.array(*[
        F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
                 F.col("_rows").alias("n_rows"), F.col(f"_bad_{i}").alias("n_violations"))
        for i, (column, rule) in enumerate(names)
    ])
    return totals.select(F.inline(lines))


def check_ranges(df: DataFrame, rules: TableRules) -> DataFrame:
    return report(df, range_checks(rules))


def check_not_null(df: DataFrame, rules: TableRules) -> DataFrame:
    return report(df, null_checks(rules))


def check_varchar_length(df: DataFrame, rules: TableRules) -> DataFrame:
    return report(df, length_checks(rules))


def check_primary_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once (counted in part before the shuffle)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_foreign_key(child: DataFrame, child_key: str, parent: DataFrame,
                      parent_key: str) -> DataFrame:
    """Child keys without a parent. Keys are counted first, so the anti join sees each once."""
    keys = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def row_checks(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {**range_checks(rules), **null_checks(rules), **length_checks(rules)}


def with_violations(df: DataFrame, rules: TableRules) -> DataFrame:
    """Add `violations`, the broken row-level checks as `column:rule`."""
    marks = [F.when(bad, F.lit(f"{column}:{rule}"))
             for (column, rule), bad in row_checks(rules).items()]
    return df.withColumn("violations", F.array_compact(F.array(*marks)))


def split_quarantine(df: DataFrame, rules: TableRules) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every row-level rule, and the others with their violations."""
    checked = with_violations(df, rules)
    return (checked.where(F.size("violations") == 0).drop("violations"),
            checked.where(F.size("violations") > 0))


AUDIT = "table_name string, column_name string, rule string, n_rows long, n_violations long"


def _within(table: DataFrame, key: str, low, high) -> DataFrame:
    """Keys inside a range. The bounds are constants, so a scan can skip files by their statistics."""
    return table.where(F.col(key).between(F.lit(low), F.lit(high))).select(key)


def _line(spark: SparkSession, table: str, column: str, rule: str, rows: int, found: DataFrame) -> DataFrame:
    """One audit line; `found` has a row per broken key, with its number of rows `n_rows`."""
    return found.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
        F.lit(rows).cast("long").alias("n_rows"), F.col("n").cast("long").alias("n_violations"))


def _key_bounds(table: DataFrame, columns: list[str]):
    """Number of rows and the lowest and highest value of each column, in one pass."""
    return table.agg(F.count(F.lit(1)).alias("_rows"), *[
        f(c).alias(f"_{side}_{c}") for c in columns for side, f in (("low", F.min), ("high", F.max))]).first()


def load_audit(new: dict[str, DataFrame], before: dict[str, DataFrame],
               rules: dict[str, TableRules]) -> DataFrame:
    """Every rule of every table of a load: rows, and how many break it.

    Row rules are counted in one pass per table. Keys are audited in increments: the load against
    itself, and against the stored tables only within the load's own key range (two constants per
    key), which stored files with other keys are skipped by. A foreign key may lead to a row of the load or to a
    stored one. Repeated keys count all of their rows, keys taken by an earlier load the rows of
    the load that have them.
    """
    lines = []
    spark = next(iter(new.values())).sparkSession
    for name, rows in new.items():
        rule = rules[name]
        checks = row_checks(rule)
        if checks:
            lines.append(report(rows, checks).select(F.lit(name).alias("table_name"), "*"))
        parents = {c: p for c, p in rule.foreign_keys.items() if p[0] in new or p[0] in before}
        bounds = _key_bounds(rows, list(dict.fromkeys([*rule.primary_key, *parents])))
        if len(rule.primary_key) == 1:
            key = rule.primary_key[0]
            lines.append(_line(spark, name, key, "primary_key", bounds["_rows"], check_primary_key(rows, [key])))
            low, high = bounds[f"_low_{key}"], bounds[f"_high_{key}"]
            if name in before and low is not None:
                taken = _within(before[name], key, low, high).distinct()
                counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
                lines.append(_line(spark, name, key, "taken_key", bounds["_rows"],
                                   counted.join(taken, key, "left_semi")))
        for column, (parent, parent_key) in parents.items():
            low, high = bounds[f"_low_{column}"], bounds[f"_high_{column}"]
            known = [_within(tables[parent], parent_key, low, high)
                     for tables in (new, before) if parent in tables and low is not None]
            if not known:
                continue
            keys = known[0] if len(known) == 1 else known[0].union(known[1])
            lines.append(_line(spark, name, column, "foreign_key", bounds["_rows"],
                               check_foreign_key(rows, column, keys, parent_key)))
    result = spark.createDataFrame([], AUDIT)
    for line in lines:
        result = result.unionByName(line)
    return result
