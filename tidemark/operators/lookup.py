"""Dictionary lookups.

No side is forced to be broadcast: the planner does so when the bytes of a side,
estimated or measured at run time (AQE), stay under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both, splitting
skewed partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import written_table


def lookup_join(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Left lookup join of a small dimension."""
    return df.join(dim, on, how)


def lookup_default(df: DataFrame, dim: DataFrame, key: str, value: str, out: str,
                   default: str = "Unknown", dim_key: str | None = None) -> DataFrame:
    """Code -> name, absent code -> ``default``."""
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("__k"), F.col(value).alias("__v"))
    j = df.join(d, df[key] == F.col("__k"), "left")
    return j.withColumn(out, F.coalesce(F.col("__v"), F.lit(default))).drop("__k", "__v")


def map_lookup(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Lookup in a literal map (a handful of fixed entries)."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    v = F.try_element_at(m, col)  # absent key (or null) -> null, never an error
    return v if default is None else F.coalesce(v, F.lit(default))


def struct_lookup(c: str | Column, mapping: Mapping[int, tuple], fields: Sequence[str]) -> Column:
    """Code -> several outputs as one struct; null/unknown code -> null."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for k, v in mapping.items() for x in (
        F.lit(k), F.struct(*[F.lit(e).alias(f) for e, f in zip(v, fields)]))])
    return F.try_element_at(m, col)


def _unmapped(code: str | Column, value: str | Column) -> Column:
    code, value = (F.col(c) if isinstance(c, str) else c for c in (code, value))
    return code.isNotNull() & value.isNull()


def observe_unmapped(df: DataFrame, seen: Observation, lookups: Mapping[str, tuple[str | Column, str | Column]]) -> DataFrame:
    """``df`` as it is; the job that runs it also counts into ``seen`` all rows (``rows``)
    and, for each lookup (name -> code, looked-up value), those whose code is there but has no
    value. A null code is missing, not unmapped.

    The counts cost no scan. They are exact where the rows are written or collected
    in the stage that looks them up (a task that is run again counts once there); in front of a
    further shuffle a lost executor may count its rows again. ``written_with_unmapped`` is exact."""
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(_unmapped(c, v)).alias(n) for n, (c, v) in lookups.items()])


def written_with_unmapped(df: DataFrame, name: str, lookups: Mapping[str, tuple[str | Column, str | Column]]) -> tuple[DataFrame, dict[str, int]]:
    """``df`` written below the shared folder and read back, and the counts of
    ``observe_unmapped`` gathered by that write."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = written_table(observe_unmapped(df, seen, lookups), name)
    return out, {k: int(v) for k, v in seen.get.items()}


def unmapped_codes(df: DataFrame, lookups: Mapping[str, tuple[str | Column, str | Column]]) -> DataFrame:
    """``lookup``, ``code`` (as text), ``n``: the codes that had no value, all lookups in one
    aggregate (worth running where a count of ``written_with_unmapped`` is not 0)."""
    cells = [F.when(_unmapped(c, v), F.struct(F.lit(n).alias("lookup"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("code")))
             for n, (c, v) in lookups.items()]
    return (df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.lookup", "x.code")
            .agg(F.count(F.lit(1)).alias("n")))
