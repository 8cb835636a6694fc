"""Schema and quality checks as reports, and two ways to enforce them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.missing import is_blank, is_not_finite
from ..functions.names import quoted
from ..spec import AMOUNT_COLUMNS, SILVER_SCHEMA


class SchemaViolation(ValueError):
    """The frame's columns differ from the contract."""


class QualityViolation(ValueError):
    """The frame's values break a quality rule."""


Finding = tuple[str, str, str, str]


def schema_findings(schema: StructType, contract: StructType) -> list[Finding]:
    """Every difference from the contract as (rule, column_name, expected, actual)."""
    actual = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    wanted = {f.name: f.dataType.simpleString() for f in contract.fields}
    names = [name for name, _ in actual]
    repeats = Counter(names)
    found: list[Finding] = [("missing_column", c, t, "") for c, t in wanted.items() if c not in repeats]
    found += [("duplicate_column", c, "1", str(n)) for c, n in repeats.items() if n > 1]
    found += [("extra_column", c, "", t) for c, t in dict(actual).items() if c not in wanted]
    if names != list(wanted):
        found.append(("column_order", "", ",".join(wanted), ",".join(names)))
    found += [("column_type", c, wanted[c], t) for c, t in dict(actual).items() if c in wanted and t != wanted[c]]
    return found


def schema_report(df: DataFrame, contract: StructType = SILVER_SCHEMA) -> DataFrame:
    """The findings as rows, with the number of rows of the frame, all of which each of them affects. The count
    reads no column; ``schema_findings`` gives the findings alone, from metadata."""
    found = schema_findings(df.schema, contract)
    layout = "array<struct<rule:string,column_name:string,expected:string,actual:string>>"
    rows = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(f, ("rule", "column_name", "expected", "actual"))]) for f in found
    ]
    counted = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).agg(F.count(F.lit(1)).alias("affected_rows"))
    return counted.select(F.inline(F.array(*rows).cast(layout)), "affected_rows")


def enforce_schema(df: DataFrame, contract: StructType = SILVER_SCHEMA) -> DataFrame:
    """The frame itself, or SchemaViolation listing every finding. Looks at metadata only."""
    found = schema_findings(df.schema, contract)
    if found:
        raise SchemaViolation("; ".join(f"{r} {c}: expected {e!r}, got {a!r}" for r, c, e, a in found))
    return df


def _rules(
    df: DataFrame, required: Sequence[str], amounts: Sequence[str], trim: bool
) -> list[tuple[str, str, Column]]:
    kinds = dict(df.dtypes)
    rules = [("not_null", c, F.col(quoted(c)).isNull()) for c in required]
    rules += [("not_blank", c, is_blank(c, trim)) for c in required if kinds[c] == "string"]
    rules += [("finite", c, is_not_finite(c)) for c in amounts if kinds[c] in ("double", "float")]
    return rules


def quality_report(
    df: DataFrame,
    required: Sequence[str] = tuple(SILVER_SCHEMA.names),
    amounts: Sequence[str] = AMOUNT_COLUMNS,
    trim: bool = False,
) -> DataFrame:
    """Per rule and column: (rule, column_name, violations), all from one aggregation.

    Run it on the frame *before* missing values are filled to learn how complete the data was; on
    a filled frame the NULL rules hold by construction.
    """
    rules = _rules(df, required, amounts, trim)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        # Nulls are what a count leaves out, the cheapest aggregate there is.
        *[(F.count(F.lit(1)) - F.count(quoted(c)) if r == "not_null" else F.count_if(broken)).alias(f"r{i}") for i, (r, c, broken) in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit("not_empty").alias("rule"),
            F.lit("").alias("column_name"),
            F.when(F.col("total") == 0, 1).otherwise(0).cast("bigint").alias("violations"),
        )
    ] + [
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), F.col(f"r{i}").alias("violations"))
        for i, (r, c, _) in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def enforce_quality(report: DataFrame) -> None:
    """Raise QualityViolation naming every broken rule of a report (one row per rule and column)."""
    broken = report.filter(F.col("violations") > 0).orderBy("rule", "column_name").collect()
    if broken:
        raise QualityViolation("; ".join(f"{r.rule} {r.column_name}: {r.violations} row(s)" for r in broken))


GUARD_MARK = "quality rule broken: "


def guard(
    df: DataFrame,
    required: Sequence[str] = tuple(SILVER_SCHEMA.names),
    amounts: Sequence[str] = AMOUNT_COLUMNS,
    trim: bool = False,
) -> DataFrame:
    """The same rows, but the job that reads them fails at the first broken rule.

    Put it under a write: the data is checked while it is written, without a pass of its own, and
    a failed job commits nothing. Every column carries its own rules, so a column nobody reads is
    not checked and none is computed twice.
    """
    guarded = {}
    for rule, column, broken in _rules(df, required, amounts, trim):
        failure = F.raise_error(F.lit(f"{GUARD_MARK}{rule} {column};"))
        checked = guarded.get(column, F.col(quoted(column)))
        guarded[column] = F.when(broken, failure).otherwise(checked)
    return df.withColumns(guarded)
