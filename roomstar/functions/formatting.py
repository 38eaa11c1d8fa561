"""Display formatting as column expressions (no per-row Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def thousands(c) -> Column:
    """12345 -> '12,345'."""
    return F.format_number(_c(c), 0)


def rank_label(rank, name) -> Column:
    """(3, 'room_0007') -> '03 room_0007', so an alphabetical sort keeps rank order."""
    return F.format_string("%02d %s", _c(rank), _c(name))


def readable_size(nbytes) -> Column:
    """Bytes in binary units with two decimals: '55.80 KiB'."""
    b = _c(nbytes).cast("double")
    out = None
    for power, unit in [(4, "TiB"), (3, "GiB"), (2, "MiB"), (1, "KiB")]:
        cond = b >= F.lit(1024.0 ** power)
        val = F.format_string(f"%.2f {unit}", b / F.lit(1024.0 ** power))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.format_string("%.2f B", b))


def last_part(name) -> Column:
    """'stg_events.coins' -> 'coins'."""
    return F.element_at(F.split(_c(name), r"\."), -1)


def qualify(name, default_table: str = "stg_events") -> Column:
    """A bare column name gets the default table prefix; a dotted name is kept."""
    n = _c(name)
    return F.when(n.contains("."), n).otherwise(F.concat(F.lit(default_table + "."), n))
