"""Layout in which a filter on any of several columns skips files and row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CELL = "__cell"


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number of the same order."""
    kind = df.schema[name].dataType.simpleString()
    c = F.col(f"`{name}`")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return c.cast("timestamp").cast("double")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return c.cast("double")
    raise ValueError(f"z-order needs numbers, dates or times, not {name}: {kind}")


def with_cell(df: DataFrame, columns: Sequence[str], bits: int = 6, error: float = 0.002, out: str = _CELL) -> DataFrame:
    """Add ``out``, the interleaved bits of the columns' quantile numbers.

    Each column is cut at 2^``bits`` - 1 approximate quantiles (one pass for all columns; the
    cuts are all that reaches the driver), so skewed values fill the cells as evenly as equal
    ones allow. A value's number is found by halving, in column functions only. Null and NaN
    count as lowest. The first column's bit is the highest of each round."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("z-order takes one column or more and at most 62 bits in all")
    numbers = {f"__q{i}": _number(df, c) for i, c in enumerate(columns)}
    share = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.select(*[F.when(~F.isnan(e), e).alias(n) for n, e in numbers.items()]).approxQuantile(list(numbers), share, error)
    cell = F.lit(0).cast("bigint")
    for i, (name, expr) in enumerate(numbers.items()):
        bounds = F.array(*[F.lit(x) for x in cuts[i]]) if cuts[i] else None
        df = df.withColumn(name, F.when(~F.isnan(expr), expr)).withColumn(f"{name}_n", F.lit(0))
        for bit in reversed(range(bits)):
            if bounds is None:
                break
            step = F.when(F.col(name) >= F.get(bounds, F.col(f"{name}_n") + F.lit(2**bit - 1)), 2**bit).otherwise(0)
            df = df.withColumn(f"{name}_n", F.col(f"{name}_n") + step)
        for bit in range(bits):
            one = F.shiftright(F.col(f"{name}_n"), bit).bitwiseAND(F.lit(1)).cast("bigint")
            cell = cell + F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - i)
    return df.withColumn(out, cell).drop(*numbers, *[f"{n}_n" for n in numbers])


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = 6,
                   block_bytes: int | None = None) -> None:
    """Write ``df`` as Parquet in the order of its cells.

    Rows are dealt by ranges of (cell, hash of the row), so a cell that holds a third of all
    rows is spread over many files and none is one task's. Without ``files`` AQE chooses their
    number by size; ``block_bytes`` is the row group's size where the default (128 MB) is too coarse."""
    rank = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith(("map", "variant"))])
    keys = [F.col(_CELL), rank]
    dealt = with_cell(df, columns, bits)
    dealt = dealt.repartitionByRange(files, *keys) if files else dealt.repartitionByRange(*keys)
    writer = dealt.sortWithinPartitions(_CELL).drop(_CELL).write.mode("overwrite")
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)
