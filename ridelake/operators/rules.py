"""The trip quality rules, declared once.

``RULES`` lists every rule with its limits per vehicle type. Three forms derive
from it: the cleaning filter (``type_rule``), the independent counts of the
profile (``counted_rules``) and the ordered steps of the cascade (``CASCADE``).

A rule has two sides. A row *holds* it if the values prove so, and *breaks* it
if they prove that; a NULL proves neither. Cleaning keeps rows that hold every
enforced rule, the profile counts rows that break a rule.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.time import duration_minutes

Condition = Callable[[float | None], Column]


class Rule(NamedTuple):
    """``enforced``/``counted``: vehicle type → limit, for cleaning and for the profile."""

    name: str
    holds: Condition
    breaks: Condition
    enforced: dict[str, float | None]
    counted: dict[str, float | None]


def _range(name: str, measure: Callable[[], Column], low: bool, enforced: dict, counted: dict | None = None,
           strict: bool = False, floor: float | None = None) -> Rule:
    """A one-sided range rule: at least (``low``) or at most its limit; ``strict`` excludes the limit itself.

    With ``floor`` the profile counts only rows from there on: those below break another rule.
    """
    def holds(limit):
        m = measure()
        return (m > limit if strict else m >= limit) if low else m <= limit

    def breaks(limit):
        m = measure()
        out = (m <= limit if strict else m < limit) if low else m > limit
        return out if floor is None else out & (m >= floor)

    return Rule(name, holds, breaks, enforced, enforced if counted is None else counted)


def _types(*types: str, limit: float | None = None) -> dict[str, float | None]:
    return {t: limit for t in types}


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _refund(payments: tuple[int, ...]) -> Column:
    return (F.col("fare_amount") < 0) & F.col("payment_type").isin(*payments)


def _stationary() -> Column:
    return (F.col("trip_distance") <= 0) & (duration_minutes() > C.GPS_CHECK_MINUTES)


_EVERY = C.VEHICLE_TYPES
RULES = (
    Rule("eliminar_fare_negativo",
         lambda _: (F.col("fare_amount") >= 0) | _refund(C.NEGATIVE_FARE_OK_PAYMENTS),
         lambda _: _refund(C.NEGATIVE_FARE_ERROR_PAYMENTS), _types("yellow", "green"), _types("yellow", "green")),
    # fhvhv has no payment type: every negative fare is wrong there, and its minimum fare already removes them
    _range("eliminar_fare_negativo", _col("fare_amount"), True, {}, _types("fhvhv", limit=0.0)),
    _range("eliminar_fare_extremo", _col("fare_amount"), False, _types("yellow", "green", limit=C.FARE_MAX)),
    _range("eliminar_fare_minimo", _col("fare_amount"), True, _types("green", "fhvhv", limit=C.FARE_MIN), floor=0.0),
    _range("eliminar_driver_pay_invalido", _col("driver_pay"), True, _types("fhvhv", limit=0.0), strict=True),
    Rule("eliminar_distancia_gps", lambda _: ~_stationary(), lambda _: _stationary(),
         _types("yellow", "green", "fhvhv"), _types("yellow", "green", "fhvhv")),
    _range("eliminar_distancia_extrema", _col("trip_distance"), False,
           _types("yellow", "green", limit=C.DISTANCE_MAX_TAXI) | _types("fhvhv", limit=C.DISTANCE_MAX_FHVHV)),
    _range("eliminar_viaje_fantasma", duration_minutes, True, _types(*_EVERY, limit=C.DURATION_MIN)),
    _range("eliminar_duracion_extrema", duration_minutes, False, _types(*_EVERY, limit=C.DURATION_MAX)),
    *(Rule(name, lambda _, z=zone: F.col(z).isNotNull(), lambda _, z=zone: F.col(z).isNull(), _types("fhv"),
           _types("yellow", "green", "fhv"))
      for name, zone in (("eliminar_sin_origen", "pu_location_id"), ("eliminar_sin_destino", "do_location_id"))),
    # the cleaning checks the file's month instead (``file_month_rule``)
    Rule("eliminar_fecha_corrupta", lambda _: F.year("pickup_datetime").isin(*C.YEARS),
         lambda _: ~F.year("pickup_datetime").isin(*C.YEARS), {}, _types(*_EVERY)),
)


def _by_type(conditions: dict[str, Column]) -> Column:
    """CASE over ``tipo_vehiculo``; over a union of per-type scans it folds to one branch each."""
    out = None
    for tipo, condition in conditions.items():
        out = F.when(F.col("tipo_vehiculo") == tipo, condition) if out is None \
            else out.when(F.col("tipo_vehiculo") == tipo, condition)
    return out


def type_rule(tipo: str | None = None) -> Column:
    """Every enforced rule of one type, or (``tipo=None``) a CASE over ``tipo_vehiculo``."""
    def every(t):
        return reduce(lambda a, b: a & b, [r.holds(r.enforced[t]) for r in RULES if t in r.enforced])
    return every(tipo) if tipo is not None else _by_type({t: every(t) for t in C.VEHICLE_TYPES})


def counted_rules() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Rule name → whether a row breaks it (by its type), and the types that count it."""
    out = {}
    for name in sorted({r.name for r in RULES}):
        of = {t: r.breaks(limit) for r in RULES if r.name == name for t, limit in r.counted.items()}
        out[name] = _by_type(of), tuple(of)
    return out


def file_month_rule(file_ym: str = "file_ym") -> Column:
    """the pickup lies in the file's month, given as the number YYYYMM.

    The file's month comes from its path; the comparison uses it once, so the
    path is cut once per row. No month in the path: NULL, and the row goes.
    """
    p = F.col("pickup_datetime")
    return F.year(p) * 100 + F.month(p) == F.col(file_ym)


def verdict(tipo: str | None = None) -> Column:
    """True when a bronze row passes its type rule and the month rule."""
    return F.coalesce(type_rule(tipo) & file_month_rule(), F.lit(False))


# The cascade step labels, in step order.
CASCADE_LABELS = (
    "Fecha corrupta (año/mes no coincide)",
    "Fare negativo (payment_type inválido)",
    "Fare fuera de rango [0, max]",
    "GPS inválido (distancia≈0, duración alta)",
    "Distancia > máximo",
    "Duración fuera de rango",
)


def cascade_steps(tipo: str = "yellow") -> list[tuple[str, Column]]:
    """(label, keep-condition) of each ordered step, with the limits of one type.

    Step 2 removes invalid refunds only, and step 3 then every fare below 0:
    stricter than cleaning, which keeps valid refunds.
    """
    rule = {r.name: r for r in RULES if tipo in r.counted}
    holds = lambda *names: reduce(lambda a, b: a & b, [rule[n].holds(rule[n].counted[tipo]) for n in names])
    keeps = [
        file_month_rule(),
        ~rule["eliminar_fare_negativo"].breaks(None),
        (F.col("fare_amount") >= 0) & holds("eliminar_fare_extremo"),
        holds("eliminar_distancia_gps"),
        holds("eliminar_distancia_extrema"),
        holds("eliminar_viaje_fantasma", "eliminar_duracion_extrema"),
    ]
    return list(zip(CASCADE_LABELS, keeps))
