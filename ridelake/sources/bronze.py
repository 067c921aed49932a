"""Bronze trip files: one Parquet file (or folder) per type × month.

All months of a type that share a physical schema are read in one scan; the
file's year and month come from its path (``..._YYYY-MM.parquet``) via the hidden
``_metadata`` column, so Spark splits the files across tasks.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import CONFORMED_FIELDS
from .fixtures import DRIFT_TYPES, RAW_NAMES, raw_frame


def raw_schema(tipo: str, key: str | None = None) -> T.StructType:
    """Raw column names of one layout with the types of the unified schema.

    ``key`` adds a ``long`` row-key column when the files carry one.
    """
    unified = dict(CONFORMED_FIELDS)
    fields = [T.StructField(key, T.LongType())] if key else []
    return T.StructType(fields + [T.StructField(raw, unified[name]) for name, raw in RAW_NAMES[tipo].items()])


FILE_COLUMNS = ("file_ym", "file_anio", "file_mes")


def _month_of(path: Column) -> Column:
    text = F.substring(F.substring_index(path, ".parquet", 1), -7, 7)
    return F.replace(text, F.lit("-"), F.lit("")).try_cast("int")


def with_file_month(df: DataFrame) -> DataFrame:
    """Add ``file_ym`` (YYYYMM), ``file_anio`` and ``file_mes`` from each row's source file path.

    The month is what stands before the first ``.parquet`` of the path
    (``..._YYYY-MM.parquet``): two substring cuts, no regular expression, and one
    number that the month rule compares. A path without a month gives NULLs,
    and its rows fail the month rule and show in the audit.
    """
    return (df.withColumn("file_ym", _month_of(F.col("_metadata.file_path")))
              .withColumns({"file_anio": F.floor(F.col("file_ym") / 100).cast("int"), "file_mes": F.col("file_ym") % 100}))


def _parquet(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")


def _unit(paths: list[str]) -> Column:
    """What is read for a listed file: its monthly file or folder, unless the paths name parts of such folders themselves."""
    if any(".parquet/" in p for p in paths):
        return F.col("path")
    return F.concat(F.substring_index("path", ".parquet", 1), F.lit(".parquet"))


def _listing(spark: SparkSession, folders: dict[str, list[str]]) -> DataFrame:
    """Type, path and unit of the Parquet files below each type's paths; a listing, no file is opened. Paths that are not there have none."""
    parts = []
    for tipo, paths in folders.items():
        try:
            files = _parquet(spark).format("binaryFile").load(paths)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        parts.append(files.select(F.lit(tipo).alias("tipo_vehiculo"), "path", _unit(paths).alias("archivo")))
    empty = "tipo_vehiculo string, path string, archivo string"
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], empty)


def _physical_schema(path: str) -> str | None:
    """Names, physical and logical types in a file's footer; None where its file system is not one that Arrow opens."""
    scheme, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", path, re.S).groups()
    try:
        if scheme in (None, "file"):
            where = {"source": "/" + rest.lstrip("/")}
        else:
            system, inner = pafs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{quote(rest)}")
            where = {"source": inner, "filesystem": system}
        with pq.ParquetFile(**where) as f:
            columns = [f.schema.column(i) for i in range(len(f.schema))]
            return ", ".join(sorted(f"{c.path.lower()} {c.physical_type} {c.logical_type}" for c in columns))
    except (OSError, ValueError, NotImplementedError):  # pyarrow's errors are of these kinds
        return None


def _footers(batches):
    for batch in batches:
        yield batch.assign(esquema=[_physical_schema(p) for p in batch["path"]])


def schema_groups(spark: SparkSession, folders: dict[str, list[str]]) -> dict[str, list[tuple[list[str], T.StructType]]]:
    """Per type, its files grouped by physical schema: ``(paths, schema)``.

    One job for all types: the tasks that list the files read their footers, and a
    grouping keeps the distinct schemas of each monthly file. Spark then infers
    each distinct schema from one file. Only files whose file system Arrow cannot open
    (and broken ones, which fail there) have their schema inferred one by one.
    """
    read = _listing(spark, folders).mapInPandas(_footers, "tipo_vehiculo string, path string, archivo string, esquema string")
    kinds = (read.groupBy("tipo_vehiculo", "archivo", "esquema").agg(F.min("path").alias("una"))
             .withColumn("partes", F.count(F.lit(1)).over(Window.partitionBy("tipo_vehiculo", "archivo")))
             .orderBy("archivo", "esquema").collect())  # monthly files: a few thousand at most
    alone = [r for r in kinds if r["partes"] == 1]
    mixed = {r["archivo"] for r in kinds if r["partes"] > 1}
    files = [(r["tipo_vehiculo"], r["archivo"], r["esquema"], r["una"]) for r in alone]
    if mixed:  # part files of one month differ: they are taken part by part
        parts = read.where(F.col("archivo").isin(sorted(mixed))).collect()
        files += [(r["tipo_vehiculo"], r["path"], r["esquema"], r["path"]) for r in parts]
    schemas: dict[str, T.StructType] = {}
    groups: dict[tuple[str, str], list[str]] = {}
    for tipo, path, key, one in files:
        if key is None:
            schema = _parquet(spark).parquet(one).schema
            key = schema.simpleString()
            schemas[key] = schema
        elif key not in schemas:
            schemas[key] = _parquet(spark).parquet(one).schema
        groups.setdefault((tipo, key), []).append(path)
    out: dict[str, list[tuple[list[str], T.StructType]]] = {t: [] for t in folders}
    for (tipo, key), paths in groups.items():
        out[tipo].append((paths, schemas[key]))
    return out


def read_bronze_types(spark: SparkSession, folders: dict[str, str | list[str]], key: str | None = None) -> dict[str, DataFrame]:
    """Every monthly file under each type's paths (folders, files or globs), one frame per type.

    Physical types may differ from month to month (zones as int, long or
    double, counts as long or double): each group of files of one schema is one
    scan, cast to the unified types. Columns that a month lacks are NULL, further ones are ignored.
    """
    folders = {t: [p] if isinstance(p, str) else list(p) for t, p in folders.items()}
    return {t: _read_groups(spark, groups, raw_schema(t, key)) for t, groups in schema_groups(spark, folders).items()}


def _read_groups(spark: SparkSession, groups, target: T.StructType) -> DataFrame:
    if not groups:
        return spark.createDataFrame([], T.StructType([*target.fields, *[T.StructField(c, T.IntegerType()) for c in FILE_COLUMNS]]))
    parts = []
    for files, schema in groups:
        have = {f.name.lower(): f for f in schema.fields}
        read = T.StructType([have[f.name.lower()] for f in target.fields if f.name.lower() in have])
        df = with_file_month(_parquet(spark).schema(read).parquet(*files))
        parts.append(df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                                 for f in target.fields], *FILE_COLUMNS))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_bronze(spark: SparkSession, paths: str | list[str], tipo: str, key: str | None = None) -> DataFrame:
    """S1/S4 for one type."""
    return read_bronze_types(spark, {tipo: paths}, key)[tipo]


def file_months(spark: SparkSession, folders: dict[str, str | list[str]]) -> list[tuple[str, int, int]]:
    """Type, year and month of every monthly file, from the listing alone. Files without a month in their name have none."""
    ym = _month_of(F.col("path"))
    found = _listing(spark, {t: [p] if isinstance(p, str) else list(p) for t, p in folders.items()}).select(
        "tipo_vehiculo", F.floor(ym / 100).cast("int"), ym % 100).where(ym.isNotNull()).distinct()
    return [tuple(r) for r in found.collect()]


def rows_per_month(spark: SparkSession, folders: dict[str, str | list[str]]) -> DataFrame:
    """Rows of every type and file month (``filas_entrada``).

    Rows are counted per file from the Parquet footers (no column is read); the month is cut from each file's path, not each row's.
    """
    parts = []
    for tipo, paths in folders.items():
        files = [r[0] for r in _listing(spark, {tipo: [paths] if isinstance(paths, str) else list(paths)})
                 .select("archivo").distinct().collect()]
        if files:
            rows = _parquet(spark).schema(T.StructType([])).parquet(*files).groupBy(F.col("_metadata.file_path").alias("path"))
            parts.append(rows.agg(F.count(F.lit(1)).alias("n")).withColumn("tipo_vehiculo", F.lit(tipo)))
    schema = "tipo_vehiculo string, anio int, mes int, filas_entrada long"
    if not parts:
        return spark.createDataFrame([], schema)
    ym = _month_of(F.col("path"))
    return (reduce(lambda a, b: a.unionByName(b), parts)
            .groupBy("tipo_vehiculo", F.floor(ym / 100).cast("int").alias("anio"), (ym % 100).alias("mes"))
            .agg(F.sum("n").alias("filas_entrada")))


def write_bronze_fixture(bronze: DataFrame, root: str) -> dict[str, str]:
    """Materialise fixture trips as bronze files, one folder per type × month.

    Folder names carry ``<type>_tripdata_<YYYY>-<MM>.parquet`` like the
    published files; returns the folder of each type.
    """
    out = {}
    for tipo in RAW_NAMES:
        raw = raw_frame(bronze, tipo, extra=("trip_id", "file_anio", "file_mes"))
        name = F.format_string(f"{tipo}_tripdata_%04d-%02d.parquet", F.col("file_anio"), F.col("file_mes"))
        # Rebalance by month: AQE sizes the files, splitting a hot month across
        # tasks instead of routing all its rows to one (the fixture's only shuffle).
        (raw.withColumn("archivo", name).drop("file_anio", "file_mes").hint("rebalance", "archivo")
            .write.mode("overwrite").partitionBy("archivo").parquet(f"{root}/{tipo}"))
        out[tipo] = f"{root}/{tipo}"
    return out


def write_drifting_fixture(bronze: DataFrame, root: str) -> dict[str, str]:
    """The same files, but the physical types change with the month; returns the folder of each type."""
    out = {}
    for tipo in RAW_NAMES:
        for i, types in enumerate(DRIFT_TYPES):
            part = bronze.where(F.pmod(F.col("file_anio") * 12 + F.col("file_mes"), F.lit(len(DRIFT_TYPES))) == i)
            raw = raw_frame(part, tipo, extra=("trip_id", "file_anio", "file_mes"), types=types)
            name = F.format_string(f"{tipo}_tripdata_%04d-%02d.parquet", F.col("file_anio"), F.col("file_mes"))
            (raw.withColumn("archivo", name).drop("file_anio", "file_mes").write.mode("append").partitionBy("archivo")
                .parquet(f"{root}/{tipo}"))
        out[tipo] = f"{root}/{tipo}"
    return out
