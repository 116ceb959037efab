"""Check stored tables against their contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.schemas import LOAD_TIME, TableContract


def conform(df: DataFrame, contract: TableContract, loaded_at: Column | None = None) -> DataFrame:
    """Columns of the contract in order; a column ``df`` lacks gets the contract's default,
    the time of the load being ``loaded_at`` (by default now), else NULL."""
    load_time = F.current_timestamp() if loaded_at is None else loaded_at

    def column(f):
        if f.name in df.columns:
            return F.col(f.name)
        default = contract.defaults.get(f.name)
        return load_time if default == LOAD_TIME else F.lit(default)

    return df.select(*[column(f).cast(f.dataType).alias(f.name) for f in contract.schema])


def _violations(contract: TableContract, kind: str, columns: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(contract.name).alias("table_name"), F.lit(kind).alias("constraint_type"),
        F.lit(columns).alias("column_names"), F.col("violations").cast("bigint").alias("violations"))


def _missing(df: DataFrame, contract: TableContract) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.required])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(contract.name).alias("table_name"), F.lit("NOT_NULL").alias("constraint_type"),
            F.lit(c).alias("column_names"), F.col(c).cast("bigint").alias("violations"))
        for c in contract.required])))


def _repeated(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows beyond the first of each key; keys with a NULL are not compared."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    sizes = df.filter(complete).groupBy(*columns).agg(F.count("*").alias("_rows"))
    return sizes.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("violations"))


def _orphans(df: DataFrame, column: str, referenced: DataFrame, target: str) -> DataFrame:
    # Counting per key first keeps a frequent key from crowding one join task.
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    known = referenced.select(F.col(target).alias("_target"))
    lost = keys.join(known, F.col(column) == F.col("_target"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def contract_violations(df: DataFrame, contract: TableContract, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, constraint_type, column_names, violations), one row per promise."""
    found = [_missing(df, contract)]
    found.append(_violations(
        contract, "PRIMARY_KEY", ", ".join(contract.primary_key), _repeated(df, contract.primary_key)))
    for columns in contract.unique:
        found.append(_violations(contract, "UNIQUE", ", ".join(columns), _repeated(df, columns)))
    for fk in contract.foreign_keys:
        found.append(_violations(
            contract, "FOREIGN_KEY", fk.column, _orphans(df, fk.column, tables[fk.table], fk.references)))
    return reduce(DataFrame.unionByName, found)
