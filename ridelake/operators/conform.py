"""Conform the four raw trip layouts to the unified silver schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import CONFORMED_FIELDS, VEHICLE_TYPES
from ..sources.fixtures import RAW_NAMES

def conform(raw: DataFrame, tipo: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select one type's raw frame into the unified schema.

    ``keep`` passes extra columns through (file year/month, a row key).
    Missing metrics become typed NULLs; the type becomes a literal column.
    """
    names = RAW_NAMES[tipo]
    present = {c.lower() for c in raw.columns}
    cols = [F.col(k) for k in keep if k.lower() in present]
    for name, dtype in CONFORMED_FIELDS:
        if name == "tipo_vehiculo":
            cols.append(F.lit(tipo).alias(name))
            continue
        src = names.get(name)
        if src is None:
            cols.append(F.lit(None).cast(dtype).alias(name))
        else:
            cols.append(F.col(src).cast(dtype).alias(name))
    return raw.select(*cols)


def conform_all(raws: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """Union of every type's conformed rows (a bag union, no shuffle)."""
    parts = [conform(raws[t], t, keep) for t in VEHICLE_TYPES if t in raws]
    return reduce(lambda a, b: a.unionByName(b), parts)
