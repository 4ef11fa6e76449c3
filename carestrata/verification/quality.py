"""Validation, rules, alerts and audit over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators.audit import next_batch_ids
from carestrata.operators.rules import Rule, parse_status, route_alerts, run_log, run_rules, status_document
from carestrata.operators.validate import (
    check_against_metadata,
    check_row_counts,
    check_schemas,
    control_rows,
    tally,
)
from carestrata.settings import Criterion, FileCriteria
from carestrata.verification.registry import table, verify

# Control rows per part: counts of its lines, wrong for large parts, with names no file has for small ones, and
# rows of another batch and program that must not be looked at.
_CONTROL_SQL = """
    control AS (
      SELECT p_brand || '_' || p_partkey AS TABLE_NAME, p_partkey, coalesce(n, 0) + CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS ROW_COUNT
      FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
      WHERE p_size > 3),
    counts AS (
      SELECT p_brand || '_' || p_partkey AS TABLE_NAME, n AS actual_rows
      FROM part JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
      WHERE p_size > 10),
    result AS (
      SELECT TABLE_NAME AS table_name, CAST(ROW_COUNT AS BIGINT) AS expected_rows,
             CASE WHEN wanted THEN actual_rows END AS actual_rows,
             CASE WHEN NOT wanted THEN 'FILTERED' WHEN actual_rows = ROW_COUNT THEN 'PASSED' ELSE 'FAILED' END AS status,
             CASE WHEN NOT wanted THEN NULL WHEN actual_rows IS NULL THEN 'File not found'
                  WHEN actual_rows <> ROW_COUNT THEN 'Row count mismatch: expected ' || ROW_COUNT || ', got ' || actual_rows END AS error
      FROM (SELECT control.*, actual_rows, starts_with(TABLE_NAME, 'Brand#1') AND NOT contains(TABLE_NAME, '#19') AS wanted
            FROM control LEFT JOIN counts USING (TABLE_NAME)))"""


def _control_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    per_part = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    name = F.concat_ws("_", "p_brand", "p_partkey").alias("TABLE_NAME")
    size = F.col("p_size")
    expected = F.coalesce("n", F.lit(0)) + F.when(size > 40, 1).otherwise(0)
    registered = part.join(per_part, "p_partkey", "left").select(
        name,
        expected.alias("ROW_COUNT"),
        F.when(size > 3, 5).otherwise(4).alias("META_BATCH_ID"),
        F.lit("PARTS").alias("META_PROGRAM_NAME"),
        F.lit("LINES").alias("META_SUBJECT_AREA"),
    )
    counts = part.where(size > 10).join(per_part, "p_partkey").select(name, F.col("n").alias("actual_rows"))
    criteria = FileCriteria(
        prefix=Criterion(("Brand#1",)), not_contains=Criterion(("#19",)), extension=Criterion((".CSV",))
    )
    return check_row_counts(control_rows(registered, 5, "PARTS", "LINES"), counts, criteria)


@verify(f"WITH {_CONTROL_SQL} SELECT * FROM result")
def control_rowcount_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _control_check(spark, sf_dir)


@verify(f"""WITH {_CONTROL_SQL} SELECT count(*) FILTER (status = 'PASSED') AS passed,
    count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'FILTERED') AS filtered_out FROM result""")
def validation_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(_control_check(spark, sf_dir))


# A file per document: its words are the header. The registry has no entry for some sources, lists French files
# backwards and one Spanish word under another name.
_SCHEMA_SQL = """
    a AS (SELECT doc_id, lang, source, string_split(text, ' ') AS actual FROM documents),
    e AS (SELECT doc_id, actual, CASE WHEN source <> 'src3' THEN CASE lang WHEN 'fr' THEN list_reverse(actual)
            WHEN 'es' THEN list_transform(actual, lambda w, i: CASE WHEN i = 3 THEN w || '_x' ELSE w END) ELSE actual END END AS expected FROM a)"""


def _file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.split("text", " ").alias("actual"))


@verify(f"""WITH {_SCHEMA_SQL}
    SELECT doc_id AS object_name, CASE WHEN expected = actual THEN 'PASSED' ELSE 'FAILED' END AS status,
           CASE WHEN expected IS NULL THEN 'No schema definition found' WHEN expected <> actual THEN 'Schema mismatch' END AS error,
           CAST(coalesce(len(expected), 0) AS BIGINT) AS expected_columns,
           CAST(CASE WHEN expected IS NOT NULL THEN len(actual) END AS BIGINT) AS actual_columns,
           CASE WHEN expected <> actual THEN array_to_string(list_sort(list_distinct(list_filter(expected, lambda x: NOT list_contains(actual, x)))), ',') END AS missing,
           CASE WHEN expected <> actual THEN array_to_string(list_sort(list_distinct(list_filter(actual, lambda x: NOT list_contains(expected, x)))), ',') END AS extra
    FROM e
""")
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = _file_headers(spark, sf_dir)
    words = headers.where(F.col("source") != "src3").select("doc_id", "lang", F.posexplode("actual").alias("pos", "word"))
    renamed = (F.col("lang") == "es") & (F.col("pos") == 2)
    registry = words.select(
        F.col("doc_id").alias("OBJECT_NAME"),
        F.when(renamed, F.concat("word", F.lit("_x"))).otherwise(F.col("word")).alias("FIELD_NAME"),
        F.when(F.col("lang") == "fr", -F.col("pos")).otherwise(F.col("pos")).alias("ID_OBJECT"),
    )
    result = check_schemas(headers.select(F.col("doc_id").alias("object_name"), "actual"), registry)
    return result.select(
        "object_name",
        "status",
        "error",
        "expected_columns",
        "actual_columns",
        F.array_join(F.sort_array("missing_columns"), ",").alias("missing"),
        F.array_join(F.sort_array("extra_columns"), ",").alias("extra"),
    )


@verify(f"""WITH {_SCHEMA_SQL}
    SELECT 'doc_' || doc_id || '.csv' AS file_name, CASE WHEN expected = actual THEN 'PASSED' ELSE 'FAILED' END AS status,
           CASE WHEN expected IS NULL THEN 'No metadata found' WHEN expected <> actual THEN 'Column validation failed' END AS error
    FROM e
""")
def schema_check_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = _file_headers(spark, sf_dir).withColumn("file_name", F.concat(F.lit("doc_"), "doc_id", F.lit(".csv")))
    altered = F.transform("actual", lambda w, i: F.when(i == 2, F.concat(w, F.lit("_x"))).otherwise(w))
    listed = F.when(F.col("lang") == "fr", F.reverse("actual")).when(F.col("lang") == "es", altered).otherwise(F.col("actual"))
    metadata = headers.where(F.col("source") != "src3").select("file_name", listed.alias("columns"))
    return check_against_metadata(headers.select("file_name", "actual"), metadata).select("file_name", "status", "error")


RULES = [
    Rule("O1", "ORDERS", 0, "orders", expression="o_totalprice > 0"),
    Rule("O2", "ORDERS", 1, "orders", expression="o_orderstatus IN ('F', 'O')"),
    Rule("O3", "ORDERS", 2, "orders", expression="o_orderdate >= timestamp_ntz'1992-01-01'"),
    Rule("O4", "ORDERS", 3, "orders", kind="null", expression="o_orderpriority"),
    Rule("O5", "ORDERS", 1, "orders", kind="duplicate", keys=("o_orderkey",)),
    Rule("C1", "CUSTOMERS", 0, "customer", expression="c_acctbal >= 0"),
    Rule("C2", "CUSTOMERS", 2, "customer", kind="null", expression="CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END"),
    Rule("C3", "CUSTOMERS", 1, "customer", expression="no_such_column > 0"),
    Rule("L1", "LINES", 3, "lineitem", expression="l_discount BETWEEN 0 AND 0.05"),
    Rule("L2", "LINES", 1, "lineitem", kind="duplicate", keys=("l_orderkey", "l_linenumber")),
    Rule("L3", "LINES", 2, "lineitem", expression="l_quantity <= 50 AND l_extendedprice > 0"),
]


def _rule_sql(rule: Rule) -> str:
    head = f"SELECT '{rule.rule_id}' AS rule_id, '{rule.rule_group}' AS rule_group, {rule.severity} AS severity, " \
        f"'{rule.table_name}' AS table_name, '{rule.kind}' AS kind, "
    if rule.rule_id == "C3":
        return f"{head} count(*) AS n_rows, CAST(0 AS BIGINT) AS n_failed, 'SYNTAX' AS status FROM {rule.table_name}"
    if rule.kind == "duplicate":
        body = f"count(*) AS n_rows, count(*) - count(DISTINCT ({', '.join(rule.keys)})) AS n_failed"
    elif rule.kind == "null":
        body = f"count(*) AS n_rows, count(*) - count({rule.expression}) AS n_failed"
    else:
        expression = rule.expression.replace("timestamp_ntz", "TIMESTAMP ")
        body = f"count(*) AS n_rows, count(*) FILTER (NOT coalesce({expression}, false)) AS n_failed"
    return f"SELECT *, CASE WHEN n_failed > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM ({head} {body} FROM {rule.table_name})"


_RESULTS_SQL = "results AS (" + " UNION ALL ".join(_rule_sql(r) for r in RULES) + ")"
_LOG_SQL = f"""WITH {_RESULTS_SQL}, log AS (
    SELECT rule_group AS RULE_GROUP, '42' AS ID_BATCH, '2024-03-01' AS DATE_METRIC, 'RESULT' AS CODE_LOG_TYPE,
           count(*) FILTER (status = 'SYNTAX') AS N_FAILED_SYNTAX_COUNT,
           {", ".join(f"count(*) FILTER (status = 'FAILED' AND severity = {s}) AS N_FAILED_SEVERITY_{s}" for s in range(4))}
    FROM results GROUP BY rule_group)"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rules({t: table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem")}, RULES)


@verify(f"WITH {_RESULTS_SQL} SELECT * FROM results")
def dq_rules_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir)


@verify(f"WITH {_RESULTS_SQL} SELECT * FROM results WHERE rule_group = 'LINES' AND kind = 'duplicate'")
def dq_null_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule chosen by group and id."""
    return run_rules({"lineitem": table(spark, sf_dir, "lineitem")}, RULES, rule_group="LINES", rule_id="L2")


@verify(f"{_LOG_SQL} SELECT * FROM log")
def dq_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log(_results(spark, sf_dir), 42, "2024-03-01")


@verify(f"""{_LOG_SQL}
    SELECT RULE_GROUP, CAST(code AS INTEGER) AS status_code, ['success', 'warnings', 'critical failures', 'rules with syntax errors'][code + 1] AS status_message,
           ID_BATCH AS batch_id, DATE_METRIC AS batch_date
    FROM (SELECT *, CASE WHEN N_FAILED_SYNTAX_COUNT > 0 THEN 3 WHEN N_FAILED_SEVERITY_0 > 0 THEN 2
                         WHEN N_FAILED_SEVERITY_1 + N_FAILED_SEVERITY_2 + N_FAILED_SEVERITY_3 > 0 THEN 1 ELSE 0 END AS code FROM log)
""")
def dq_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_status(status_document(run_log(_results(spark, sf_dir), 42, "2024-03-01")))
    return parsed.select("RULE_GROUP", "status.status_code", "status.status_message", "status.batch_info.*")


@verify(f"""{_LOG_SQL},
    s AS (SELECT *, N_FAILED_SYNTAX_COUNT > 0 AS bad, N_FAILED_SYNTAX_COUNT = 0 AND N_FAILED_SEVERITY_0 > 0 AS sev0,
                 N_FAILED_SYNTAX_COUNT = 0 AND N_FAILED_SEVERITY_0 = 0 AS goes_on FROM log)
    SELECT RULE_GROUP, ID_BATCH, 'SYNTAX' AS cause, 'error' AS trigger_type, 'HIGH' AS alert_level, 'oncall' AS alert_type,
           true AS stops_run, N_FAILED_SYNTAX_COUNT AS failures, 'High' AS severity FROM s WHERE bad
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SEV_0', 'error', 'HIGH', unnest(['oncall', 'regular']), true, N_FAILED_SEVERITY_0, 'High' FROM s WHERE sev0
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SEV_1', 'error', 'MEDIUM', 'oncall', false, N_FAILED_SEVERITY_1, 'High' FROM s WHERE goes_on AND N_FAILED_SEVERITY_1 > 0
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SEV_1', 'log', 'MEDIUM', 'regular', false, N_FAILED_SEVERITY_1, 'Medium' FROM s WHERE goes_on AND N_FAILED_SEVERITY_1 > 0
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SEV_2', 'log', 'LOW', 'regular', false, N_FAILED_SEVERITY_2, 'Medium' FROM s WHERE goes_on AND N_FAILED_SEVERITY_2 > 0
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SEV_3', 'log', 'LOW', 'regular', false, N_FAILED_SEVERITY_3, 'Medium' FROM s WHERE goes_on AND N_FAILED_SEVERITY_3 > 0
    UNION ALL SELECT RULE_GROUP, ID_BATCH, 'SUCCESS', 'info', 'INFO', 'regular', false,
                     N_FAILED_SEVERITY_1 + N_FAILED_SEVERITY_2 + N_FAILED_SEVERITY_3, 'Informational' FROM s WHERE goes_on
""")
def severity_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_alerts(run_log(_results(spark, sf_dir), 42, "2024-03-01"))


@verify("""
    WITH audit AS (
      SELECT CASE WHEN o_orderstatus = 'P' THEN 'B-' || o_orderkey WHEN o_totalprice > 400000 THEN o_orderkey || '.5'
                  WHEN o_totalprice < 5000 THEN '-' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id_batch,
             o_orderpriority AS program, CAST(year(o_orderdate) AS VARCHAR) AS subject,
             CASE WHEN o_totalprice > 300000 THEN 'FAILED' WHEN o_totalprice > 200000 THEN 'COMPLETED'
                  WHEN o_totalprice > 100000 THEN 'CANCELLED' ELSE 'IN_PROGRESS' END AS status
      FROM orders)
    SELECT program AS PROGRAM_NAME, subject AS SUBJECT_AREA,
           greatest(coalesce(CAST(max(TRY_CAST(id_batch AS DECIMAL(38,0))) AS BIGINT), 0), 0) + 1 AS NEXT_ID_BATCH
    FROM audit WHERE status IN ('COMPLETED', 'FAILED', 'IN_PROGRESS') GROUP BY 1, 2
""")
def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice")
    ident = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("B-"), key))
        .when(price > 400000, F.concat(key, F.lit(".5")))
        .when(price < 5000, F.concat(F.lit("-"), key))
        .otherwise(key)
    )
    status = F.when(price > 300000, "FAILED").when(price > 200000, "COMPLETED").when(price > 100000, "CANCELLED")
    audit = table(spark, sf_dir, "orders").select(
        ident.alias("ID_BATCH"),
        F.col("o_orderpriority").alias("PROGRAM_NAME"),
        F.year("o_orderdate").cast("string").alias("SUBJECT_AREA"),
        status.otherwise("IN_PROGRESS").alias("CODE_LOAD_STATUS"),
    )
    return next_batch_ids(audit)
