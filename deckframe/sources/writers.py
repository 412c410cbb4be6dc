"""Writers: typed landing, run folders, CSV, database; tables are in :mod:`deckframe.sources.tables`."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_VALUE = "NULL in non-nullable column"


@dataclass
class AssetSpec:
    """Configuration of one landed asset."""
    name: str
    nature: str = "snapshot"                 # "snapshot" | "incremental"
    unique_key: list[str] = field(default_factory=lambda: ["id"])
    tombstone: str | None = None             # version column of incremental assets
    history: bool = True
    max_rows: int = 0
    filters: dict[str, str] = field(default_factory=dict)
    transforms: dict[str, str] = field(default_factory=dict)   # column -> kind

    @classmethod
    def from_dict(cls, d: dict) -> "AssetSpec":
        nature = d.get("nature", {})
        key = nature.get("unique_key", "id")
        return cls(name=d.get("asset", {}).get("name", d.get("name", "")),
                   nature=nature.get("name", "snapshot"),
                   unique_key=[key] if isinstance(key, str) else list(key),
                   tombstone=nature.get("tombstone"),
                   history=bool(d.get("history", True)),
                   max_rows=int(d.get("parameters", {}).get("max_rows", 0) or 0),
                   filters=dict(d.get("filters", {}) or {}),
                   transforms=dict(d.get("transform", d.get("transforms", {})) or {}))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: extra columns dropped, missing ones NULL, types cast."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def write_landing(df: DataFrame, schema: T.StructType, path: str, mode: str = "errorifexists") -> None:
    """Typed Parquet landing (S6): conform to the schema and refuse NULLs in
    non-nullable fields.  The check is part of the write: the first NULL ends the
    job and nothing is committed, so the input is computed once."""
    out = conform(df, schema)
    for f in schema.fields:
        if not f.nullable:
            refuse = F.raise_error(F.lit(f"{NULL_VALUE} {f.name}")).cast(f.dataType)
            out = out.withColumn(f.name, F.when(F.col(f.name).isNull(), refuse).otherwise(F.col(f.name)))
    try:
        out.write.mode(mode).parquet(path)
    except PySparkException as e:
        if NULL_VALUE in str(e):
            raise ValueError(f"{NULL_VALUE} {str(e).split(NULL_VALUE, 1)[1].split()[0]}") from e
        raise


def write_chunks(df: DataFrame, path: str, rows: int = 500, mode: str = "errorifexists") -> None:
    """Files of at most ``rows`` rows each."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def land_run(df: DataFrame, root: str, asset: str, end_ts: int) -> str:
    """Run folder ``<root>/<asset>/run=<end_ts>`` (S8); an existing run is never
    overwritten.  Read all runs back with ``spark.read.parquet(f"{root}/{asset}")``
    (``run`` becomes a partition column)."""
    path = f"{root.rstrip('/')}/{asset}/run={int(end_ts)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append") -> None:
    """Relational database sink (S12).  Connection details come from the caller
    (Spark conf / environment), never from code."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header."""
    df.write.mode(mode).option("header", True).csv(path)
