"""The five provider tables built from a 330-column bronze table, one provider per order.

Their SQL twins read bronze once per unpivoted group, as a UNION ALL of branches.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata import settings as s
from carestrata.functions.hashing import PIPE, row_hash
from carestrata.operators.merge import BatchStamp
from carestrata.plans import silver
from carestrata.plans.tables import BatchTable
from carestrata.verification.registry import scratch, table, verify

_STAMP = BatchStamp("MEDICAID", "NPPES", 3, datetime(2024, 1, 1))
_PHONES = [*s.MAILING_ADDRESS[6:], *s.PRACTICE_ADDRESS[6:], "AUTHORIZED_OFFICIAL_TELEPHONE_NUMBER"]
_STATES = [s.MAILING_ADDRESS[3], s.PRACTICE_ADDRESS[3]]
_POSTAL = [s.MAILING_ADDRESS[4], s.PRACTICE_ADDRESS[4]]
_LINES = [s.MAILING_ADDRESS[0], s.PRACTICE_ADDRESS[0]]


_CYCLES = (7, 11, 13, 17, 19, 23, 29, 31)
_ORDERS_SQL = "(SELECT *, o_orderkey % 4 AS k4, " + ", ".join(
    f"CAST(o_orderkey % {c} AS VARCHAR) AS t{i}" for i, c in enumerate(_CYCLES)
) + " FROM orders)"


def _cell_sql(name: str, j: int) -> str:
    """Value of bronze column number `j`: set in three rows of four, of few or many distinct values."""
    key, text = "o_orderkey", "CAST(o_orderkey AS VARCHAR)"
    if name == "NPI":
        return f"CASE WHEN o_orderstatus <> 'O' OR o_orderpriority <> '5-LOW' THEN {text} END"
    if name == "ENTITY_TYPE_CODE":
        return "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'P' THEN '2' END"
    if name == "NPI_DEACTIVATION_DATE":
        return "CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'P' THEN '2299-12-31' END"
    if name in _PHONES:
        return f"CASE {key} % 3 WHEN 0 THEN lpad({text}, 10, '2') WHEN 1 THEN '(' || lpad({text}, 10, '3') || ')' ELSE lpad({text}, 9, '4') END"
    if name in _STATES:
        return f"CASE WHEN {key} % 5 < 3 THEN 'NY' WHEN {key} % 5 = 3 THEN 'New York' END"
    if name in _POSTAL:
        return f"CASE {key} % 3 WHEN 0 THEN lpad({text}, 5, '0') WHEN 1 THEN lpad({text}, 5, '0') || '-1234' ELSE lpad({text}, 9, '0') END"
    if name in _LINES:
        return f"CASE WHEN {key} % 4 = {j % 4} THEN '  ' WHEN {key} % 7 <> 0 THEN 'Street ' || {text} END"
    return f"CASE WHEN k4 <> {-j % 4} THEN '{name[:4]}-' || t{j % len(_CYCLES)} END"


def _bronze_path(spark: SparkSession, sf_dir: str) -> str:
    """Bronze, loaded anew for each query, so that each is timed with its input and reads what is there now."""
    cells = [f"{_cell_sql(name, j)} AS {name}" for j, name in enumerate(s.REGISTRY_COLUMNS)]
    spark_sql = [c.replace("AS VARCHAR", "AS STRING").replace("strftime(o_orderdate, '%Y-%m-%d')", "date_format(o_orderdate, 'yyyy-MM-dd')") for c in cells]
    path = scratch(spark, "bronze")
    # few input splits, but 330 columns to make from each row
    cycles = [f"CAST(o_orderkey % {c} AS STRING) AS t{i}" for i, c in enumerate(_CYCLES)]
    orders = table(spark, sf_dir, "orders").selectExpr("*", "o_orderkey % 4 AS k4", *cycles)
    orders = orders.repartition(spark.sparkContext.defaultParallelism)
    # one batch, so its folder is written without sorting wide rows by batch
    BatchTable(spark, path).replace(_STAMP.put_on(orders.selectExpr(*spark_sql)), _STAMP.batch_id)
    return path


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BatchTable(spark, _bronze_path(spark, sf_dir)).read(_STAMP.batch_id)


def _bronze_sql(names: list[str]) -> str:
    cells = ", ".join(f"{_cell_sql(n, s.REGISTRY_COLUMNS.index(n))} AS {n}" for n in names)
    return f"WITH raw AS (SELECT {cells} FROM {_ORDERS_SQL}), bronze AS (SELECT * FROM raw WHERE NPI IS NOT NULL)"


def _silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    built = silver.build(name, _bronze(spark, sf_dir), _STAMP)
    return built.drop("META_DATE_INSERT", "META_DATE_UPDATE", "META_UPD_BATCH_ID")


_META = "'MEDICAID' AS META_PROGRAM_NAME, 'NPPES' AS META_SUBJECT_AREA, CAST(3 AS BIGINT) AS META_BATCH_ID"


def _ten(c: str) -> str:
    return f"CASE WHEN length(regexp_replace({c}, '[^0-9]', '', 'g')) = 10 THEN {c} END"


def _provider_sql() -> str:
    business = s.PROVIDER_TABLES["PROVIDER_NPI"].business
    name = """CASE WHEN ENTITY_TYPE_CODE = '1' THEN coalesce(PROVIDER_LAST_NAME, '') || ', ' || coalesce(PROVIDER_FIRST_NAME, '')
        || CASE WHEN PROVIDER_MIDDLE_NAME IS NOT NULL THEN ' ' || PROVIDER_MIDDLE_NAME ELSE '' END ELSE PROVIDER_ORGANIZATION_NAME END"""
    cols = [name if c == "PROVIDER_ORGANIZATION_NAME" else _ten(c) if c in _PHONES else c for c in business]
    listed = ", ".join(f"{v} AS {c}" for v, c in zip(cols, business, strict=True))
    return f"{_bronze_sql(['NPI', *business])} SELECT {_META}, NPI, {listed} FROM bronze"


def _address_sql() -> str:
    def branch(kind: str, a: list[str]) -> str:
        values = [
            *a[:3],
            f"CASE WHEN length({a[3]}) = 2 THEN {a[3]} END",
            f"substring({a[4]}, 1, 5)",
            f"CASE WHEN length({a[4]}) > 5 THEN substring({a[4]}, 7, 4) END",
            a[5],
            _ten(a[6]),
            _ten(a[7]),
        ]
        listed = ", ".join(f"{v} AS {c}" for v, c in zip(values, s.ADDRESS_COLUMNS, strict=True))
        return f"SELECT {_META}, NPI, '{kind}' AS PROVIDER_ADDRESS_TYPE, {listed} FROM bronze WHERE {a[0]} IS NOT NULL AND trim({a[0]}) <> ''"

    both = [*s.MAILING_ADDRESS, *s.PRACTICE_ADDRESS]
    return f"{_bronze_sql(['NPI', *both])} {branch('M', s.MAILING_ADDRESS)} UNION ALL {branch('S', s.PRACTICE_ADDRESS)}"


def _groups_sql(table_name: str, slots: int) -> str:
    target = s.PROVIDER_TABLES[table_name]
    names = [f"{c}_{i}" for i in range(1, slots + 1) for c in target.business]
    branches = [
        f"SELECT {_META}, NPI, '{i}' AS {target.keys[1]}, " + ", ".join(f"{c}_{i} AS {c}" for c in target.business)
        + f" FROM bronze WHERE {target.business[0]}_{i} IS NOT NULL"
        for i in range(1, slots + 1)
    ]
    return f"{_bronze_sql(['NPI', *names])} " + " UNION ALL ".join(branches)


_ALL = ", ".join(f"coalesce({_cell_sql(n, j)}, '')" for j, n in enumerate(s.REGISTRY_COLUMNS))


@verify(f"SELECT {_cell_sql('NPI', 0)} AS NPI, CAST(3 AS BIGINT) AS META_BATCH_ID, md5(concat_ws('|', {_ALL})) AS row_hash FROM {_ORDERS_SQL}")
def provider_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze load itself: every column of every row, as one hash."""
    return _bronze(spark, sf_dir).select("NPI", "META_BATCH_ID", row_hash(s.REGISTRY_COLUMNS, PIPE).alias("row_hash"))


@verify(_provider_sql())
def provider_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "PROVIDER_NPI")


@verify(_address_sql())
def provider_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "PROVIDER_NPI_ADDRESS")


@verify(_groups_sql("PROVIDER_NPI_TAXONOMY", s.TAXONOMY_SLOTS))
def provider_taxonomies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "PROVIDER_NPI_TAXONOMY")


@verify(_groups_sql("PROVIDER_NPI_OTHER_IDS", s.OTHER_ID_SLOTS))
def provider_other_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "PROVIDER_NPI_OTHER_IDS")


@verify(f"""{_bronze_sql(["NPI", "PROVIDER_ENUMERATION_DATE", "NPI_DEACTIVATION_DATE"])}
    SELECT {_META}, NPI, NPI AS PROVIDER_ID, PROVIDER_ENUMERATION_DATE,
           CASE WHEN NPI_DEACTIVATION_DATE IS NULL THEN '2299-12-31' ELSE NPI_DEACTIVATION_DATE END AS NPI_DEACTIVATION_DATE,
           CASE WHEN NPI_DEACTIVATION_DATE IS NULL OR NPI_DEACTIVATION_DATE = '2299-12-31' THEN 'Y' ELSE 'N' END AS IS_NPI_ACTIVE
    FROM bronze""")
def provider_cross_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "PROVIDER_NPI_XREF")


@verify("""
    SELECT 'MEDICAID' AS META_PROGRAM_NAME, 'NPPES' AS META_SUBJECT_AREA, CAST(3 AS BIGINT) AS META_BATCH_ID,
           CAST(p_partkey AS VARCHAR) AS CODE, p_brand AS GROUPING, p_type AS CLASSIFICATION, CASE WHEN p_size > 9 THEN p_name END AS SPECIALIZATION,
           p_name AS DEFINITION, NULL::VARCHAR AS NOTES, CASE WHEN p_size > 25 THEN p_name ELSE 'DESCRIPTION NOT AVAILABLE' END AS DISPLAY_NAME, 'x' AS SECTION
    FROM part
""")
def code_set_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, name = F.col("p_size"), F.col("p_name")
    bronze = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("CODE"),
        F.col("p_brand").alias("GROUPING"),
        F.col("p_type").alias("CLASSIFICATION"),
        F.when(size > 9, name).alias("SPECIALIZATION"),
        name.alias("DEFINITION"),
        F.lit(None).cast("string").alias("NOTES"),
        F.when(size > 25, name).when(size > 10, "  ").alias("DISPLAY_NAME"),
        F.lit("x").alias("SECTION"),
    )
    built = silver.build("NUCC_TAXONOMY", bronze, _STAMP)
    return built.drop("META_DATE_INSERT", "META_DATE_UPDATE", "META_UPD_BATCH_ID")
