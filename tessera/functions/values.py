"""Values of documents: membership as documents have it, domains, and JSON that may be damaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import global_rank


def not_in(c: Column, *values) -> Column:
    """True where ``c`` is none of ``values``; a missing value is none of them."""
    return F.coalesce(~c.isin(*values), F.lit(True))


def domain_errors(**checks: Column) -> Column:
    """The names of the checks that a row fails, in order; a check that is null is failed."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())


def split_valid(df: DataFrame, **checks: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, other rows with ``errors``): each row is in one of the two."""
    told = df.withColumn("errors", domain_errors(**checks))
    return told.where(F.size("errors") == 0).drop("errors"), told.where(F.size("errors") > 0)


def load_json(c: Column, schema: str, default: Column | None = None) -> Column:
    """The value that a JSON text spells, or ``default`` where it is missing, damaged or of another kind; a field of another kind is null."""
    whole = F.try_variant_get(F.try_parse_json(c), "$", schema)
    return whole if default is None else F.coalesce(whole, default)


def dump_json(c: Column) -> Column:
    """A value as JSON text, missing fields included."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def shuffled(df: DataFrame, key: str, seed: int = 42, name: str = "place") -> DataFrame:
    """``df`` with the place of each row in an order that the seed decides, the same for the same seed whatever the partitions."""
    return global_rank(df, [F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)], name)
