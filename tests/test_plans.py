"""Plan tests: pruning, pushdown, partition filters and shuffle shape."""

import contextlib
import io
import re

from helpers import SF_SMALL

from ridelake.queries import REGISTRY


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_rule_predicates_pushed_to_each_scan(spark):
    p = plan(REGISTRY["trips_by_hour"][0](spark, SF_SMALL))
    assert "LessThanOrEqual(fare_amount,300.0)" in p
    assert "LessThanOrEqual(trip_miles,150.0)" in p
    assert "GreaterThan(driver_pay,0.0)" in p


def test_column_pruning_on_hourly(spark):
    p = plan(REGISTRY["trips_by_hour"][0](spark, SF_SMALL))
    assert "tip_amount" not in p and "congestion_surcharge" not in p


def test_partition_filters(spark):
    df = REGISTRY["scan_partition_filter"][0](spark, SF_SMALL)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(tipo_vehiculo" in p and "(anio" in p and "= 2025" in p


def test_zone_fact_single_exchange_no_join(spark):
    p = plan(REGISTRY["trips_by_zone"][0](spark, SF_SMALL))
    assert p.count("Exchange (") == 1 or p.count("+- Exchange") == 1
    assert "Join" not in p


def test_airport_zone_dim_is_broadcast(spark):
    df = REGISTRY["zone_report"][0](spark, SF_SMALL)
    assert "BroadcastHashJoin" in plan(df) or "BroadcastExchange" in plan(df)


def test_gold_base_is_one_silver_scan(spark):
    """All aggregate gold tables come from one scan: the zone-hour base has a single
    Parquet scan of silver and a single exchange (partial aggregation before it)."""
    from ridelake.operators import facts
    from ridelake.queries import silver_df
    from ridelake.session import scratch_path
    from ridelake.sources import writers as WR
    path = scratch_path(spark, "silver-plan")
    WR.write_silver(silver_df(spark, SF_SMALL, multi=True), path)
    p = plan(facts.zone_hour_base(spark.read.parquet(path)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1 and "Join" not in p
    assert "partial_sum" in p


def test_silver_job_audit_reads_no_data_columns(spark):
    """The post-write audit counts rows from footers and partition paths only,
    and equals the one-pass verdict count over bronze."""
    from ridelake.operators import silver as SV
    from ridelake.plans import silver_job
    from ridelake.queries import bronze_files
    from ridelake.session import scratch_path
    from ridelake.sources import writers as WR
    bronze = silver_job.conformed_bronze(spark, bronze_files(spark, SF_SMALL, True))
    path = scratch_path(spark, "silver-audit")
    WR.write_silver(SV.clean(bronze), path)
    audit = SV.audit_from_counts(bronze, spark.read.parquet(path).select("tipo_vehiculo", "anio", "mes"))
    schemas = re.findall(r"ReadSchema: (\S+)", plan(audit))
    assert schemas and all(s == "struct<>" for s in schemas)
    direct = SV.audit(bronze)
    assert audit.exceptAll(direct).count() == 0 and direct.exceptAll(audit).count() == 0


AGGREGATE_KEYS = ["trips_by_hour", "trips_by_zone", "monthly_trend", "fares_by_zone", "vehicle_comparison",
                  "duration_distance", "zone_features", "rule_cascade", "silver_audit", "layer_audit",
                  "trips_by_zone_rollup", "zone_features_rollup", "daily_series_rollup", "partition_count"]


def test_aggregate_scans_read_only_needed_columns(spark):
    """No aggregate query reads the money columns none of them uses (column pruning reaches every scan)."""
    unused = ("tolls", "congestion_surcharge", "airport_fee")
    for key in AGGREGATE_KEYS:
        schemas = re.findall(r"ReadSchema: (\S+)", plan(REGISTRY[key][0](spark, SF_SMALL)))
        assert schemas, key
        for s in schemas:
            assert not any(c in s for c in unused), (key, s)


def test_audit_scans_read_no_data_columns(spark):
    """Counting in-rows per file month needs only footers: the partition and file-month columns
    come from paths, so the bronze side of the layer audit reads no column at all."""
    from ridelake.queries import bronze
    b = bronze(spark, SF_SMALL, multi=True).groupBy("tipo_vehiculo", "file_anio").count()
    schemas = re.findall(r"ReadSchema: (\S+)", plan(b))
    assert schemas and all(s == "struct<>" for s in schemas)


def test_train_test_split_scans_source_once(spark):
    """The per-type cut is a window over the day rows: one scan of the source, no self-join."""
    p = plan(REGISTRY["train_test_split_time"][0](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert "Join" not in p


def test_stored_layer_audit_reads_no_data_columns(spark):
    """Bronze vs stored silver counts come from footers and partition paths only."""
    p = plan(REGISTRY["layer_audit_stored"][0](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (\S+)", p)
    assert schemas and all(s == "struct<>" for s in schemas)


def test_file_path_is_cut_once_per_row(spark):
    """The month rule reads the path once, without a regular expression; the derived columns don't read it again."""
    from ridelake.operators import silver
    from ridelake.plans import silver_job
    from ridelake.queries import bronze_files
    files = bronze_files(spark, SF_SMALL, False)
    p = silver.clean(silver_job.conformed_bronze(spark, {"green": files["green"]}), "green")
    text = p._jdf.queryExecution().executedPlan().toString()
    assert text.count("substring_index") == 1 and "regexp" not in text
