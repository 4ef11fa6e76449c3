"""File lineage: one parent row per landed file, one child row per archive member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.functions.filenames import file_type, size_text, transaction_id
from carestrata.operators.ordinals import number_rows

# fixed values: columns of the lineage table
LINEAGE_COLUMNS = [
    "ID_TRANSACTION",
    "CHILD_ID_TRANSACTION",
    "FILE_NAME",
    "FILE_PATH_FQN",
    "CODE_FILE_TYPE",
    "CODE_TRANSACTION_TYPE",
    "DATE_INBOUND",
    "SUBJECT_AREA",
    "ID_BATCH",
    "CODE_FREQUENCY",
    "FILE_SIZE",
    "UPDATED_BY",
]


def lineage_rows(
    files: DataFrame,
    members: DataFrame,
    program: str,
    subject: str,
    batch_id: int,
    day: str,
    frequency: str = "DAILY",
    by: str = "ETL",
) -> DataFrame:
    """`files(path, name, size, modified)` and `members(path, ordinal, member, size)` -> lineage rows.

    Parents are numbered by path, children by their place in the archive, under their parent's id.
    """
    fixed = {
        "CODE_TRANSACTION_TYPE": F.lit("INBOUND"),
        "SUBJECT_AREA": F.lit(subject),
        "ID_BATCH": F.lit(batch_id).cast("bigint"),
        "CODE_FREQUENCY": F.lit(frequency),
        "UPDATED_BY": F.lit(by),
    }
    number = transaction_id(F.lit(program), F.lit(subject), F.lit(day), F.lit(batch_id), F.col("number"))
    parents = number_rows(files, "path", "number").withColumn("ID_TRANSACTION", number)
    parent_rows = parents.select(
        "ID_TRANSACTION",
        F.lit(None).cast("string").alias("CHILD_ID_TRANSACTION"),
        F.col("name").alias("FILE_NAME"),
        F.col("path").alias("FILE_PATH_FQN"),
        file_type(F.col("name")).alias("CODE_FILE_TYPE"),
        F.col("modified").alias("DATE_INBOUND"),
        size_text(F.col("size")).alias("FILE_SIZE"),
        *[v.alias(k) for k, v in fixed.items()],
    )
    base = F.substring_index("member", "/", -1)
    owner = parents.select("path", "ID_TRANSACTION", F.col("modified").alias("DATE_INBOUND"))
    # one archive may hold most of all members: nothing above the join needs them together, so its partition can be split
    child_rows = (
        members.where(~F.col("member").endswith("/"))
        .join(owner, "path")
        .select(
            "ID_TRANSACTION",
            F.col("ordinal").cast("string").alias("CHILD_ID_TRANSACTION"),
            base.alias("FILE_NAME"),
            F.concat_ws("/", "path", base).alias("FILE_PATH_FQN"),
            file_type(base).alias("CODE_FILE_TYPE"),
            "DATE_INBOUND",
            size_text(F.col("size")).alias("FILE_SIZE"),
            *[v.alias(k) for k, v in fixed.items()],
        )
    )
    return parent_rows.unionByName(child_rows).select(*LINEAGE_COLUMNS)
