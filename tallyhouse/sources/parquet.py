"""Tables stored as Parquet under one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.schema import MARTS, STAGING, STAR
from tallyhouse.versions import folders

GROUPS = {**dict.fromkeys(STAR, "star"), **dict.fromkeys(MARTS, "marts")}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table in its known layout, so that no file has to be opened for it. Star and
    mart tables are those of the version in use."""
    if name not in GROUPS:
        return read_layout(spark, f"{root}/{name}", name)
    used = folders(spark, root, GROUPS[name])
    if not used:
        raise FileNotFoundError(f"there is no {GROUPS[name]} under {root} yet")
    return read_layout(spark, f"{root}/{used[0]}/{name}", name)


def read_layout(spark: SparkSession, path: str, name: str) -> DataFrame:
    layouts = {"staging": STAGING, **STAR, **{mart: MARTS[mart].columns for mart in MARTS}}
    return spark.read.schema(layouts[name]).parquet(path)
