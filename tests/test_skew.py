"""A hot key (one zone and one day holding a third of all trips) stays correct and map-side combined."""

import contextlib
import datetime as dt
import io

from helpers import frame, plain_zone_counts, trip, zone_rows

from ridelake.operators import facts, silver


def test_hot_zone_and_day(spark):
    hot = [trip(trip_id=i, pu=132, do=132, pickup=dt.datetime(2024, 1, 5, 8, 0)) for i in range(200)]
    cold = [trip(trip_id=1000 + i, pu=1 + i % 50, do=None if i % 7 == 0 else 2 + i % 40,
                 pickup=dt.datetime(2024, 1, 1 + i % 28, i % 24, 0)) for i in range(400)]
    s = silver.clean(frame(spark, hot + cold))
    a = facts.trips_by_zone(s)
    assert zone_rows(a) == plain_zone_counts(s)
    r = a.where("location_id = 132 AND dia = 5").first()
    assert r.total_viajes_origen == 200 and r.total_viajes_destino == 200
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        a.explain()
    assert "partial_sum" in buf.getvalue()  # map-side combine before the exchange
