"""Group values brought back to rows, where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a side that may be broadcast, with what a row costs in the table that is built from it.
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 48


def attach(
    rows: DataFrame, key: str, spread: str, parts: dict[str, Column], totals: dict[str, Column],
    keep: str | None = None,
) -> DataFrame:
    """Every row with the aggregates of its group, null keys left out.

    Rows of a group are dealt by ``spread``, a column of many values, to as many shares as there
    are shuffle partitions. Shares are aggregated (``parts``), then groups over their shares
    (``totals``); the way back goes over the shares again, so no task gets a whole group of rows.
    Rows are shuffled once, and shares once: both uses of each read one exchange. Groups that do
    not meet ``keep``, a condition on the aggregates, go before the way back, with their rows.
    """
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.where(F.col(key).isNotNull()).withColumn(
        "_share", F.pmod(F.xxhash64(spread), F.lit(shares)).cast("int")
    ).repartition(key, "_share")
    of_share = dealt.groupBy(key, "_share").agg(*[c.alias(n) for n, c in parts.items()]).repartition(key)
    of_group = of_share.groupBy(key).agg(*[c.alias(n) for n, c in totals.items()])
    back = of_share.select(key, "_share").join(of_group.where(keep) if keep else of_group, key)
    return dealt.join(back, [key, "_share"]).drop("_share")


def checked(rows: DataFrame, most: int | None = None) -> DataFrame:
    """A stored table, marked for broadcast if all its values take at most ``most`` bytes.

    Texts are measured, not taken to be short; columns of arrays are never broadcast.
    """
    size, fixed = F.lit(0), _ROW_BYTES
    for name, kind in rows.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            return rows
        fixed += 8
    taken = rows.agg(F.coalesce(F.sum((size + F.lit(fixed)).cast("long")), F.lit(0))).first()[0]
    return F.broadcast(rows) if taken <= (BROADCAST_BYTES if most is None else most) else rows


def row_key(id_col: str, text_col: str) -> Column:
    """A string that tells rows apart by id and text; equal rows share it."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                       F.hex(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))))
