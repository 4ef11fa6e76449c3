"""The jobs as a scheduler runs them: landed files of the given tables through to their last table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators.rules import Rule
from carestrata.operators.validate import ValidationFailed
from carestrata.plans.jobs import Lake, NotReady, RulesFailed, claims_job, code_set_job, program_job
from carestrata.settings import CODE_SET, CODE_SET_COLUMNS, CODE_SET_TABLE, Criterion, FileCriteria, ProgramConfig
from carestrata.verification.registry import buckets_for, scratch, table, verify

_AT = datetime(2024, 1, 1)


def _land(df: DataFrame, path: str) -> str:
    """One CSV file of that very name."""
    spark, staged = df.sparkSession, f"{path}.staged"
    df.coalesce(1).write.options(header="true", escape='"').csv(staged)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(conf)
    (part,) = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")]
    system.delete(target, False)
    system.rename(part, target)
    system.delete(folder, True)
    return path


@verify("""
    SELECT 'R_MMIS_ORDERS' AS table_name, CAST(o_orderkey AS VARCHAR) AS key,
           CASE WHEN o_orderstatus = 'P' THEN 'two' || chr(10) || 'lines' ELSE o_orderpriority END AS text, CAST(3 AS BIGINT) AS META_BATCH_ID FROM orders
    UNION ALL SELECT 'R_MMIS_CUSTOMERS', CAST(c_custkey AS VARCHAR), c_mktsegment, 3 FROM customer
    UNION ALL SELECT 'control', 'R_MMIS_CUSTOMERS', CAST(count(*) AS VARCHAR), 3 FROM customer
    UNION ALL SELECT 'control', 'R_MMIS_ORDERS', CAST(count(*) AS VARCHAR), 3 FROM orders
    UNION ALL SELECT 'lineage', 'R_MMIS_CONTROL.csv', 'RECIPIENT', 3
    UNION ALL SELECT 'lineage', 'R_MMIS_CUSTOMERS.csv', 'RECIPIENT', 3
    UNION ALL SELECT 'lineage', 'R_MMIS_ORDERS.csv', 'RECIPIENT', 3
""")
def program_files_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A program's landed files with a control file. A first set is short of a file, a second one of rows, a third one
    breaks a stopping rule of an earlier batch; what is complete is loaded with lineage and put away."""
    root = scratch(spark, "program")
    landing, lake = f"{root}/in", Lake(spark, f"{root}/lake", 4)
    text = F.when(F.col("o_orderstatus") == "P", "two\nlines").otherwise(F.col("o_orderpriority")).alias("text")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), text)
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("text"))
    config = ProgramConfig("MEDICAID", "RECIPIENT", FileCriteria(prefix=Criterion(("R_MMIS",), 3)), "G", control_file="R_MMIS_CONTROL.csv")
    rules = [Rule("r", "G", 0, "R_MMIS_ORDERS", expression="text <> 'stop'")]
    counts = orders.groupBy(F.lit("R_MMIS_ORDERS").alias("TABLE_NAME")).agg(F.count("*").alias("ROW_COUNT"))
    counts = counts.unionByName(customers.groupBy(F.lit("R_MMIS_CUSTOMERS").alias("TABLE_NAME")).agg(F.count("*").alias("ROW_COUNT")))

    def attempt(expected: type[Exception] | None, **options) -> None:
        try:
            program_job(lake, landing, config, _AT, **options)
        except (NotReady, RulesFailed, ValidationFailed) as failed:
            if expected is None or not isinstance(failed, expected):
                raise

    _land(customers, f"{landing}/R_MMIS_CUSTOMERS.csv")
    _land(counts, f"{landing}/R_MMIS_CONTROL.csv")
    attempt(NotReady)
    _land(orders.where("text <> '1-URGENT'"), f"{landing}/R_MMIS_ORDERS.csv")
    attempt(ValidationFailed)
    _land(orders, f"{landing}/R_MMIS_ORDERS.csv")
    attempt(RulesFailed, rules=[Rule("r", "G", 0, "R_MMIS_ORDERS", expression="text <> '1-URGENT'")])
    attempt(None, rules=rules, archive=f"{root}/away")
    names = ["table_name", "key", "text", "META_BATCH_ID"]
    loaded = [lake.bronze(n).read(3).select(F.lit(n), "key", "text", "META_BATCH_ID").toDF(*names) for n in ("R_MMIS_ORDERS", "R_MMIS_CUSTOMERS")]
    control = lake.control.read().where("META_BATCH_ID = 3")
    control = control.select(F.lit("control"), "TABLE_NAME", F.col("ROW_COUNT").cast("string"), "META_BATCH_ID").toDF(*names)
    lineage = lake.lineage.read().where("ID_BATCH = 3").select(F.lit("lineage"), "FILE_NAME", "SUBJECT_AREA", "ID_BATCH").toDF(*names)
    return loaded[0].unionByName(loaded[1]).unionByName(control).unionByName(lineage)


@verify("""
    SELECT p_name || ' ' || p_partkey AS CODE, p_brand AS GROUPING, p_type AS CLASSIFICATION,
           CASE WHEN p_size > 25 THEN p_name ELSE 'DESCRIPTION NOT AVAILABLE' END AS DISPLAY_NAME,
           CASE WHEN p_size % 7 = 0 THEN 'changed' ELSE 'x' END AS SECTION, CAST(1 AS BIGINT) AS META_BATCH_ID,
           CAST(CASE WHEN p_size % 7 = 0 THEN 2 END AS BIGINT) AS META_UPD_BATCH_ID
    FROM part
""")
def code_set_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two releases of a code set through bronze, silver and gold; a release that breaks a stopping rule between them
    leaves gold as it was."""
    root = scratch(spark, "code-set")
    part = table(spark, sf_dir, "part")
    lake = Lake(spark, f"{root}/lake", buckets_for(part.count(), 4, 100_000))
    name = F.col("p_name")
    values = [F.concat("p_name", F.lit(" "), "p_partkey"), F.col("p_brand"), F.col("p_type"), F.lit("s"), F.concat(name, F.lit("\n"), name), F.lit("n")]
    rows = part.select(*values, F.when(F.col("p_size") > 25, name), F.lit("x"), "p_size").toDF(*CODE_SET_COLUMNS, "size")
    changed = rows.withColumn("SECTION", F.when(F.col("size") % 7 == 0, "changed").otherwise("x"))
    rules = [Rule("r", CODE_SET.rule_group, 0, "GOLD_NUCC_TAXONOMY", expression="SECTION <> 'broken'")]
    for n, release in enumerate((rows, rows.withColumn("SECTION", F.lit("broken")), changed), 1):
        path = _land(release.select(CODE_SET_COLUMNS), f"{root}/in/nucc_taxonomy_{n}.csv")
        try:
            code_set_job(lake, path, CODE_SET, _AT, rules)
        except RulesFailed:
            if n != 2:
                raise
    batch = F.when(F.col("META_UPD_BATCH_ID") == 3, 2).cast("bigint").alias("META_UPD_BATCH_ID")
    return lake.gold(CODE_SET_TABLE).current().select("CODE", "GROUPING", "CLASSIFICATION", "DISPLAY_NAME", "SECTION", "META_BATCH_ID", batch)


@verify("""
    SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS text FROM orders
    UNION ALL SELECT 'outcome', 'customers', 'failed'
    UNION ALL SELECT 'outcome', 'orders', 'passed'
""")
def claims_validated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two claims files with a description file: the one whose header matches becomes an all-text table, the other none."""
    root, suffix = scratch(spark, "claims"), uuid.uuid4().hex[:12]
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("text"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    names = {"orders": f"orders_{suffix}", "customers": f"customers_{suffix}"}
    files = [_land(rows, f"{root}/in/{names[n]}.csv") for n, rows in (("orders", orders), ("customers", customers))]
    described = spark.createDataFrame([(f"{names['orders']}.csv", "key, text"), (f"{names['customers']}.csv", "key, text")], "FILE_NAME string, COLUMNS string")
    done = claims_job(spark, files, _land(described, f"{root}/described.csv"), f"{root}/parquet")
    outcome = [("outcome", n.rsplit("_", 1)[0], state) for state in ("passed", "failed") for n in done[state]]
    loaded = spark.table(names["orders"]).select(F.lit("orders").alias("table_name"), "key", "text")
    return loaded.unionByName(spark.createDataFrame(outcome, "table_name string, key string, text string"))
