"""Bronze to silver: tolerant readers, the registry of sources, one normalising plan, partitioned writes."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import cast_all_but, cast_present, day_partitions, keyed_dedup, nanos_instant, parse_instant, rename_present, with_record_hash

NUMBERS = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A daily file or a glob; without one an empty table of the schema."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if schema is None or "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path with size and time; their content isn't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")


def read_drift_safe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files whose number columns drift between integer and double: one scan for each distinct schema, then one union.

    A column that is a double in any file is a double; columns that a file lacks are null.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    schemas: dict[str, T.StructType] = {}
    for path in paths:
        schema = spark.read.parquet(path).schema
        groups[schema.json()].append(path)
        schemas[schema.json()] = schema
    wanted: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema.fields:
            seen = wanted.get(f.name)
            wide = isinstance(f.dataType, T.DoubleType) and isinstance(seen, NUMBERS)
            wanted[f.name] = f.dataType if seen is None or wide else seen
    out = None
    for key, files in groups.items():
        df = spark.read.schema(schemas[key]).parquet(*files)
        df = df.select(*[F.col(f.name).cast(wanted[f.name]).alias(f.name) for f in schemas[key].fields])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files")
    return out


def flatten_envelope(df: DataFrame) -> DataFrame:
    """``body.*`` and one row per element of ``items``; tables without the envelope pass."""
    if "body" in df.columns and isinstance(df.schema["body"].dataType, T.StructType):
        df = df.select("body.*")
    if "items" in df.columns and isinstance(df.schema["items"].dataType, T.ArrayType):
        rest = [c for c in df.columns if c != "items"]
        return df.select(*rest, F.inline("items"))
    return df


def landed(records: DataFrame) -> DataFrame:
    """Raw records as they land: nested lists flattened, integers widened to double, instants as ISO text."""
    out = []
    for f in records.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, NUMBERS):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.ArrayType):
            c = F.flatten(c)
        out.append(c.alias(f.name))
    return records.select(*out)


@dataclass(frozen=True)
class Job:
    """How a source becomes silver: dedup keys, casts (a mapping, or None for "all but ``keep`` to double"), renames, time."""

    keys: tuple[str, ...]
    casts: dict[str, str] | None = None
    keep: tuple[str, ...] = ("date", "hour", "time")
    renames: dict[str, str] = field(default_factory=dict)
    instants: tuple[str, ...] = ("date",)
    lead_days: int = 0
    snapshot: bool = False


def doubles(*names: str, **others: str) -> dict[str, str]:
    return dict.fromkeys(names, "double") | others


_ORDER = {s: doubles(*[f"{s}Regulation{n}" for n in ("ZeroCoded", "OneCoded", "TwoCoded", "Delivered")], "net", organizationId="long") for s in ("up", "down")}
#: One row per source, in the order of the inventory. Order keys hold the organisation, dam keys the dam, so no rows collapse.
JOBS: dict[str, Job] = {
    "pricing": Job(("date", "hour"), doubles("price", "priceUsd", "priceEur", "marketTradePrice")),
    "interim_mcp": Job(("date", "hour"), doubles("marketTradePrice"), lead_days=1),
    "smf": Job(("date",), doubles("systemMarginalPrice")),
    "consumption": Job(("date", "hour"), doubles("consumption"), renames={"actualConsumption": "consumption"}),
    "generation": Job(("date",), None),
    "imbalance": Job(("date",), doubles("generationTotal", "consumption", "imbalanceQuantity", systemDirection="string")),
    "dam_clearing": Job(("date",), doubles("matchedBids", "matchedOffers", "blockBid", "blockOffer")),
    "dam_clearing_by_org": Job(("date", "hour", "organizationId"), None, ("date", "hour", "organizationId", "organizationName")),
    "kgup_bulk_by_org": Job(("date", "time", "orgId", "uevcbId"), None, ("date", "time", "orgId", "uevcbId", "uevcbName")),
    "idm_transactions": Job(("date", "contractName", "id"), doubles("price", "quantity")),
    "order_up": Job(("date", "hour", "organizationId"), _ORDER["up"]),
    "order_down": Job(("date", "hour", "organizationId"), _ORDER["down"]),
    "system_direction": Job(("date", "hour"), {}),
    "dpp": Job(("date", "time"), None),
    "sbfgp": Job(("date", "time"), None),
    "aic": Job(("date",), None),
    "res_forecast": Job(("date",), None),
    "gen_forecast": Job(("date",), None),
    "load_estimation": Job(("date",), doubles("lep")),
    "price_ind_bid": Job(("date",), doubles("bidVolume")),
    "supply_demand": Job(("date", "price"), doubles("price", "supply", "demand")),
    "injection": Job(("date", "hour"), doubles("total", organizationId="long", uevcbId="long")),
    "unlicensed": Job(("date",), doubles("toplam", "ruzgar", "gunes", "biyokutle", "biyogaz", "kanalTipi", "diger")),
    "outages": Job(("id",), doubles("operatorPower", "capacityAtCaseTime", id="long"), instants=("caseStartDate", "caseEndDate")),
    "dams": Job(("date", "damId"), doubles("activeVolume", damId="long")),
    "weather": Job(("date", "city"), doubles("temperature_2m", "wind_speed_10m", "shortwave_radiation", "relative_humidity_2m")),
    "fx_rates": Job(("date",), {"date": "date", "usdtry": "double", "is_ffilled": "boolean", "source": "string"}, instants=()),
    "participants": Job(("id",), {"id": "long"}, instants=(), snapshot=True),
    "uevcb_list": Job(("id",), {"id": "long", "organizationId": "long"}, instants=(), snapshot=True),
    "market": Job(("org_id",), {"org_id": "long", "is_active": "boolean"}, renames={"organizationId": "org_id", "active": "is_active"}, instants=(), snapshot=True),
}


def normalise(bronze: DataFrame, job: Job, run_date: str | None = None) -> DataFrame:
    """Silver rows: flat, renamed, typed, one per key, with record hash and day partitions."""
    df = rename_present(flatten_envelope(bronze), job.renames)
    present = [c for c in job.instants if c in df.columns]
    as_instant = lambda c: nanos_instant(c) if isinstance(df.schema[c].dataType, NUMBERS) else parse_instant(c)
    df = df.withColumns({c: as_instant(c) for c in present})
    if job.lead_days and run_date:
        df = df.withColumn("content_date", F.date_add(F.lit(run_date).cast("date"), job.lead_days))
    df = cast_all_but(df, [*job.keep, *present]) if job.casts is None else cast_present(df, job.casts)
    if job.snapshot and run_date:
        df = df.withColumn("ds", F.lit(run_date).cast("date"))
    deduped = with_record_hash(keyed_dedup(df, job.keys), job.keys)
    own = present[0] if present and run_date is None else None
    if own is None and run_date is None:
        own = "date" if "date" in df.columns else None
    return day_partitions(deduped, own, run_date) if own or run_date else deduped


def write_silver(df: DataFrame, path: str) -> None:
    """Overwrite the touched days; a day's rows go to one task, so files stay few."""
    days = ["year", "month", "day"]
    df.repartition(*days).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*days).parquet(path)


def run_jobs(spark: SparkSession, inputs: dict[str, str], out: str, run_date: str | None = None) -> DataFrame:
    """Normalise and write many sources in one session; a failing one is reported and doesn't stop the others."""
    rows = []
    for source, path in inputs.items():
        try:
            bronze = read_bronze(spark, path)
            if bronze.isEmpty():
                rows.append((source, "EMPTY", 0, None))
                continue
            write_silver(normalise(bronze, JOBS[source], run_date), f"{out}/{source}")
            rows.append((source, "OK", spark.read.parquet(f"{out}/{source}").count(), None))
        except Exception as error:  # noqa: BLE001  whatever stops one source is its result row
            rows.append((source, "FAILED", 0, type(error).__name__))
    return spark.createDataFrame(rows, "source string, status string, n_rows long, error string")


def register(spark: SparkSession, tables: dict[str, str], prefix: str = "silver_") -> list[str]:
    """Catalog tables over silver folders, with their partitions."""
    names = []
    for source, path in tables.items():
        name = f"{prefix}{source}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if "year" in spark.read.parquet(path).columns:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        names.append(name)
    return names


def recent_partitions(df: DataFrame, run_date, days: int = 7) -> DataFrame:
    """Rows of the last days by plain predicates on the partition columns, so that other folders aren't listed or read."""
    since = F.date_sub(F.lit(run_date).cast("date"), days)
    whole = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int")) >= since
    return df.where((F.col("year").cast("int") >= F.year(since)) & whole)


def integers_to_double(df: DataFrame, partitions: tuple[str, ...] = ("year", "month", "day")) -> DataFrame:
    """Every integer column that isn't a partition as double."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, NUMBERS) and f.name not in partitions else F.col(f.name) for f in df.schema.fields])


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each column of each table: type, rows, nulls."""
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        rows = counts.select(F.lit(name).alias("table_name"), F.col("_n").alias("n_rows"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(c).alias("n_nulls")) for c, t in df.dtypes])).alias("c"))
        rows = rows.select("table_name", "n_rows", "c.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def melted(df: DataFrame, keys: list[str], names: dict[str, str], value: str = "mwh") -> DataFrame:
    """Wide fuel columns as rows (keys, fuel, value), by a map from column to fuel name."""
    return df.select(*keys, *[F.col(c).alias(n) for c, n in names.items()]).unpivot(keys, list(names.values()), "fuel", value)
