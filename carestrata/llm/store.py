"""Tables kept between steps, and the reading of the given ones."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write to the shared folder and read again.

    Cuts the lineage so that a lost executor costs nothing already done, keeps a costly input from being computed
    twice, and gives the planner the true size, from which Spark alone decides whether a join may broadcast. With
    `release`, the driver collects its garbage: what the written plan shuffled is only deleted once its plan is.
    """
    path = f"{shared_dir(df.sparkSession)}/corpus/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if release:
        for _ in range(2):  # what the first one finds is let go of, and found again without its holder by the second
            df.sparkSession.sparkContext._jvm.System.gc()
            time.sleep(0.2)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
