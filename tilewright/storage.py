"""Tables that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A session that names none gets a temporary folder if it runs in this process alone
    (`local[...]`); on a cluster, where such a folder would lose data, this raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tilewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    This cuts the lineage: what was written survives the loss of any executor, and several
    later steps read the same rows without computing them again. The folder belongs to the
    cluster, which clears it; `<shared>/tilewright/` holds nothing but such tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tilewright/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
