"""Row blocks: a symbol of any length as many window partitions.

``blocks`` deals each symbol's rows, by their rank in time order, into blocks of exactly ``rows`` rows (the last one has the rest) and adds to
each the rows around it that its windows reach into.  Ranks come from ``sorted_places``: bursts, gaps and hot symbols do not matter, and
no task ever sorts or counts a whole symbol.  What reaches further -- the last value before a gap, however long ago --
comes from one summary row for each block (``carried``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import saved
from .columns import by_time, fill
from .positions import sorted_places

#: Rows of a block; and rows of a symbol above which plans go by blocks.
ROWS = 200_000
LONG = 1_000_000

BLOCK = ("symbol", "_block")


def long_symbols(df: DataFrame, limit: int | None = None) -> bool:
    """Whether any symbol has more rows than a task should sort."""
    most = df.groupBy("symbol").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return (most or 0) > (LONG if limit is None else limit)


def indexed(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """``df`` with the 0-based place of each row in its symbol's time order: a window where symbols are short, ranges of rows else."""
    if name in df.columns:
        return df
    if long_symbols(df):
        return sorted_places(df, ["symbol"], ["timestamp"], name)
    return df.withColumn(name, (F.row_number().over(by_time()) - 1).cast("long"))


def blocks(df: DataFrame, before: int, after: int = 0, rows: int = ROWS) -> DataFrame:
    """``df`` with _block, _own, _rn and _rd: rows of a block and, not its own, copies of the ``before`` rows before and ``after`` rows after it.

    _rn is the 1-based place in the symbol, _rd that from the end of a full block (1: its last row).  A block has at least ``before`` and ``after`` rows, so
    that a row is copied at most twice.  A symbol's last rows may also be copied to a block of which no row is its own.
    """
    rows = max(rows, before, after, 1)
    ranked = sorted_places(df, ["symbol"], ["timestamp"], "_rn0")
    block, inside = F.floor(F.col("_rn0") / rows), F.col("_rn0") % rows
    ranked = ranked.withColumns({"_block": block, "_rn": F.col("_rn0") + 1, "_rd": rows - inside}).drop("_rn0")
    inside = rows - F.col("_rd")
    copies = F.array(F.col("_block"), F.when(F.col("_rd") <= before, F.col("_block") + 1), F.when((inside < after) & (F.col("_block") > 0), F.col("_block") - 1))
    out = ranked.withColumn("_to", F.explode(F.array_compact(copies)))
    return out.withColumn("_own", F.col("_to") == F.col("_block")).drop("_block").withColumnRenamed("_to", "_block")


def carried(df: DataFrame, columns: list[str], excluded: int = 0) -> DataFrame:
    """symbol, _block, before_<column>: the last value of the earlier blocks; first_<column>: the first value of the symbol.

    With ``excluded``, before_<column> leaves out the last rows of the block before, which are copied to this one.
    """
    at = lambda c, agg, ok: agg(F.when(ok & F.col(c).isNotNull(), F.struct("_rn", F.col(c).alias("x")))).getField("x")
    own = F.col("_own")
    aggs = []
    for c in columns:
        aggs += [at(c, F.max, own).alias(f"_l_{c}"), at(c, F.max, own & (F.col("_rd") > excluded)).alias(f"_e_{c}"), at(c, F.min, own).alias(f"_f_{c}")]
    s = df.groupBy(*BLOCK).agg(*aggs)
    w = Window.partitionBy("symbol").orderBy("_block")  # of blocks
    earlier, every = w.rowsBetween(Window.unboundedPreceding, -2 if excluded else -1), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = lambda c: F.last(f"_l_{c}", ignorenulls=True).over(earlier)
    near = lambda c: F.coalesce(F.lag(f"_e_{c}").over(w), last(c)) if excluded else last(c)
    return s.select(*BLOCK, *[near(c).alias(f"before_{c}") for c in columns], *[F.first(f"_f_{c}", ignorenulls=True).over(every).alias(f"first_{c}") for c in columns])


def completed(columns: list[str], backward: bool) -> dict[str, Column]:
    """Values filled within their block, completed by what ``carried`` gives."""
    return {c: F.coalesce(F.col(c), F.col(f"before_{c}"), *([F.col(f"first_{c}")] if backward else [])) for c in columns}


def filled_in_blocks(df: DataFrame, columns: list[str], backward: bool = True, rows: int = ROWS) -> DataFrame:
    """``columns`` filled forward, and the leading gap backward, within each symbol: the rows of ``fill`` for symbols of any length."""
    dealt = blocks(df, 0, 0, rows)
    local = saved(dealt.withColumns({c: fill(F.col(c), by_time(*BLOCK), backward=False) for c in columns}), "filled")
    return local.join(carried(local, columns), list(BLOCK)).withColumns(completed(columns, backward)).select(*df.columns)
