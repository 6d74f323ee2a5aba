"""Data-quality checks. Each returns the failing rows (empty = pass).

Every check is a Spark job over the whole table: filters, a grouped count or
an anti join - nothing is collected to the driver. ``run_checks`` evaluates
a list of specs and returns one summary row per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.json import is_malformed


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, cols: str | Sequence[str], ignore_nulls: bool = True) -> DataFrame:
    """Key values that occur more than once: ``*cols, n_records``.

    A grouped count (partial counts map-side); single-column keys ignore NULL
    values, compound keys count every combination.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    src = df.where(F.col(cols[0]).isNotNull()) if (ignore_nulls and len(cols) == 1) else df
    return (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
               .where(F.col("n_records") > 1))


def check_compound_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Duplicated combinations of ``cols``; rows whose every column is NULL
    are ignored (the compound test's default)."""
    any_set = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    return check_unique(df.where(any_set), cols, ignore_nulls=False)


def check_relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no match in ``parent``."""
    p = parent.select(F.col(parent_col).alias("__pk")).where(F.col("__pk").isNotNull())
    c = child.where(F.col(col).isNotNull())
    return c.join(p, c[col] == p["__pk"], "left_anti")


def check_row_count(df: DataFrame, min_value: int | None = None, max_value: int | None = None) -> DataFrame:
    """One row ``n_rows`` when the row count is outside the bounds, else none."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | (F.col("n_rows") < min_value)
    if max_value is not None:
        cond = cond | (F.col("n_rows") > max_value)
    return n.where(cond)


def check_between(df: DataFrame, col: str, min_value=None, max_value=None) -> DataFrame:
    """Rows whose ``col`` is outside the inclusive bounds (NULL passes)."""
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < min_value)
    if max_value is not None:
        bad = bad | (c > max_value)
    return df.where(c.isNotNull() & bad)


def check_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows whose ``col`` does not match ``pattern`` (NULL passes)."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.rlike(pattern))


def check_in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose ``col`` is not one of ``values`` (NULL passes)."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.isin(list(values)))


def check_non_negative(df: DataFrame, col: str) -> DataFrame:
    """Rows with a negative ``col``."""
    return df.where(F.col(col) < 0)


def check_json(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is no JSON document (NULL passes)."""
    return df.where(is_malformed(col))


@dataclass(frozen=True)
class Check:
    """One declared test: ``kind`` is a check name, ``model`` the table."""

    name: str
    model: str
    kind: str
    args: dict = field(default_factory=dict)


_KINDS = {
    "not_null": lambda t, m, a: check_not_null(t[m], a["col"]),
    "unique": lambda t, m, a: check_unique(t[m], a["col"]),
    "compound_unique": lambda t, m, a: check_compound_unique(t[m], a["cols"]),
    "relationships": lambda t, m, a: check_relationships(t[m], a["col"], t[a["to"]], a["field"]),
    "row_count": lambda t, m, a: check_row_count(t[m], a.get("min"), a.get("max")),
    "between": lambda t, m, a: check_between(t[m], a["col"], a.get("min"), a.get("max")),
    "regex": lambda t, m, a: check_regex(t[m], a["col"], a["pattern"]),
    "in_set": lambda t, m, a: check_in_set(t[m], a["col"], a["values"]),
    "non_negative": lambda t, m, a: check_non_negative(t[m], a["col"]),
    "json": lambda t, m, a: check_json(t[m], a["col"]),
}


def failing_rows(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    return _KINDS[check.kind](tables, check.model, check.args)


def _failed(check: Check) -> Column | None:
    """Failing rows of a check that looks at rows one by one, as an aggregate; None for the others."""
    a = check.args
    n = F.count(F.lit(1))
    if check.kind == "row_count":
        low, high = a.get("min"), a.get("max")
        bad = (n < low if low is not None else F.lit(False)) | (n > high if high is not None else F.lit(False))
        return F.when(bad, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    c = F.col(a["col"]) if "col" in a else None
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "between":
        low, high = a.get("min"), a.get("max")
        return F.count_if((c < low if low is not None else F.lit(False)) | (c > high if high is not None else F.lit(False)))
    if check.kind == "regex":
        return F.count_if(~c.rlike(a["pattern"]))
    if check.kind == "in_set":
        return F.count_if(~c.isin(list(a["values"])))
    if check.kind == "non_negative":
        return F.count_if(c < 0)
    if check.kind == "json":
        return F.count_if(is_malformed(c))
    return None


def observed_aggregates(model: str, checks: Sequence[Check]) -> dict[str, Column]:
    """By check name, the failing rows of the model's checks that look at rows one by one: aggregates to take while it is written."""
    return {ch.name: f for ch in checks if ch.model == model and (f := _failed(ch)) is not None}


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check], observed: dict[str, int] | None = None) -> DataFrame:
    """``check_name, model, kind, failures, status`` - one row per check.

    All checks become one Spark job. Those that look at rows one by one share a
    single aggregate (and scan) per model, unless ``observed`` has their failing rows already (by check name,
    from :func:`observed_aggregates` while the model was written); unique checks are grouped counts, without a shuffle where the
    table is bucketed by the key; relationships count the child's rows per key value first and anti-join the
    values, so a hot key is one row in the join.
    """
    name, observed = ["check_name", "model", "kind", "failures"], observed or {}

    def row(ch, failures):
        return F.struct(F.lit(ch.name).alias(name[0]), F.lit(ch.model).alias(name[1]), F.lit(ch.kind).alias(name[2]), failures.alias(name[3]))

    parts = []
    known = [(ch.name, ch.model, ch.kind, int(observed[ch.name])) for ch in checks if ch.name in observed]
    if known:
        spark = tables[known[0][1]].sparkSession
        parts.append(spark.createDataFrame(known, "check_name string not null, model string not null, kind string not null, failures long not null"))
    left = [ch for ch in checks if ch.name not in observed]
    for model in dict.fromkeys(ch.model for ch in left):
        local = [(ch, f) for ch in left if ch.model == model and (f := _failed(ch)) is not None]
        if local:
            one = tables[model].agg(*(f.alias(f"f{i}") for i, (_, f) in enumerate(local)))
            parts.append(one.select(F.explode(F.array(*(row(ch, F.col(f"f{i}")) for i, (ch, _) in enumerate(local)))).alias("r")).select("r.*"))
    for ch in left:
        if ch.kind == "relationships":
            col = ch.args["col"]
            child = tables[ch.model].where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__fk")).agg(F.count(F.lit(1)).alias("n"))
            parent = tables[ch.args["to"]].select(F.col(ch.args["field"]).alias("__fk"))
            n = child.join(parent, "__fk", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        elif _failed(ch) is None:
            n = failing_rows(tables, ch).agg(F.count(F.lit(1)).alias("failures"))
        else:
            continue
        parts.append(n.select(row(ch, F.col("failures")).alias("r")).select("r.*"))
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "check_name string, model string, kind string, failures long, status string")
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
