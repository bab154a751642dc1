"""Schema rules with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.schemas import SCHEMAS, rules


def coerce(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table's schema in its order and types; missing ones null, values that don't fit null, NaN null."""
    out = []
    for f in SCHEMAS[table].fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def with_reasons(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Adds reasons (array<string>): the rules that a row breaks; a rule that is unknown counts as broken."""
    return df.withColumn("reasons", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in checks])))


def validate(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """The rows that meet the table's rules, and the others with their reasons; one narrow pass each."""
    checked = with_reasons(df, rules(table))
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
