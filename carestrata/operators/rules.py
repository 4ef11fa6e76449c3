"""Data-quality rules: definition, one-pass execution per table, run log, status document and alert rows."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.releases import severity_label

SEVERITIES = (0, 1, 2, 3)


@dataclass(frozen=True)
class Rule:
    """kind "predicate": `expression` must be true for every row; "null": `expression` names a column that must
    be set; "duplicate": the `keys` must be unique."""

    rule_id: str
    rule_group: str
    severity: int
    table_name: str
    kind: str = "predicate"
    expression: str = ""
    keys: tuple[str, ...] = ()


STATUS_SCHEMA = T.StructType(
    [
        T.StructField("status_code", T.IntegerType()),
        T.StructField("status_message", T.StringType()),
        T.StructField(
            "batch_info",
            T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("batch_date", T.StringType())]),
        ),
    ]
)
RESULT_COLUMNS = ["rule_id", "rule_group", "severity", "table_name", "kind", "n_rows", "n_failed", "status"]


def _failing(df: DataFrame, rule: Rule) -> Column | None:
    """Condition for a failing row, or None if the rule cannot be resolved against the table."""
    try:
        if rule.kind == "null":
            bad = F.expr(rule.expression).isNull()
        elif rule.kind == "predicate":
            bad = ~F.coalesce(F.expr(rule.expression), F.lit(False))
        else:
            return None
        df.agg(F.count_if(bad))  # resolved where it will stand: an aggregate in it is a syntax failure of this rule alone
        return bad
    except (AnalysisException, ParseException):
        return None


def _result(rule: Rule, n_rows: Column, n_failed: Column) -> list[Column]:
    failed = F.coalesce(n_failed, F.lit(0)).cast("bigint")
    status = F.when(n_failed.isNull(), "SYNTAX").when(failed > 0, "FAILED").otherwise("PASSED")
    return [
        F.lit(rule.rule_id),
        F.lit(rule.rule_group),
        F.lit(rule.severity),
        F.lit(rule.table_name),
        F.lit(rule.kind),
        n_rows.cast("bigint"),
        failed,
        status,
    ]


def _row_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All row rules of one table in one aggregate; a rule that does not resolve yields a NULL count."""
    tests = [_failing(df, r) for r in rules]
    none = F.lit(None).cast("bigint")
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.count_if(t) if t is not None else F.max(none)).alias(f"f{i}") for i, t in enumerate(tests)],
    )
    rows = [F.struct(*_result(r, F.col("n"), F.col(f"f{i}"))) for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*rows))).toDF(*RESULT_COLUMNS)


def _each_if_one_fails(df: DataFrame, rules: list[Rule]) -> list[DataFrame]:
    """Results of one table's row rules. They share one pass; only if that fails on the data (a value that can't be
    cast, a division by zero) is each rule run by itself, and the ones that fail are syntax failures."""

    def ran(some: list[Rule]) -> DataFrame:
        done = _row_rules(df, some)
        return df.sparkSession.createDataFrame(done.collect(), done.schema)  # one row a rule

    try:
        return [ran(rules)]
    except PySparkException:
        out = []
        for rule in rules:
            try:
                out.append(ran([rule]))
            except PySparkException:
                out.append(_row_rules(df, [replace(rule, kind="unresolved")]).withColumn("kind", F.lit(rule.kind)))
        return out


def _duplicate_rule(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows beyond the first of each key. Counts per key are combined before the exchange."""
    unresolved = not rule.keys or any(k not in df.columns for k in rule.keys)
    if unresolved:
        counts = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.lit(None).cast("bigint")).alias("f"))
    else:
        per_key = df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("_rows"))
        rows = F.coalesce(F.sum("_rows"), F.lit(0))
        counts = per_key.agg(rows.alias("n"), (rows - F.count(F.lit(1))).alias("f"))
    return counts.select(*_result(rule, F.col("n"), F.col("f"))).toDF(*RESULT_COLUMNS)


def run_rules(
    tables: dict[str, DataFrame], rules: list[Rule], rule_group: str | None = None, rule_id: str | None = None
) -> DataFrame:
    """One result row per selected rule."""
    chosen = [r for r in rules if rule_group in (None, r.rule_group) and rule_id in (None, r.rule_id)]
    if not chosen:
        raise ValueError(f"no rule for group {rule_group!r}, id {rule_id!r}")
    missing = sorted({r.table_name for r in chosen} - tables.keys())
    if missing:
        raise KeyError(f"rules ask for tables that are not there: {', '.join(missing)}")
    parts = []
    for name in dict.fromkeys(r.table_name for r in chosen):
        own = [r for r in chosen if r.table_name == name]
        by_row = [r for r in own if r.kind != "duplicate"]
        if by_row:
            parts += _each_if_one_fails(tables[name], by_row)
        parts += [_duplicate_rule(tables[name], r) for r in own if r.kind == "duplicate"]
    return reduce(DataFrame.unionByName, parts)


def run_log(results: DataFrame, batch_id: int | str, day: str) -> DataFrame:
    """Failed rules per group and severity."""
    failed = F.col("status") == "FAILED"
    by_severity = [F.count_if(failed & (F.col("severity") == s)) for s in SEVERITIES]
    return results.groupBy(F.col("rule_group").alias("RULE_GROUP")).agg(
        F.lit(str(batch_id)).alias("ID_BATCH"),
        F.lit(day).alias("DATE_METRIC"),
        F.lit("RESULT").alias("CODE_LOG_TYPE"),
        F.count_if(F.col("status") == "SYNTAX").alias("N_FAILED_SYNTAX_COUNT"),
        *[c.alias(f"N_FAILED_SEVERITY_{s}") for s, c in zip(SEVERITIES, by_severity, strict=True)],
    )


def latest_result(log: DataFrame, batch_id: int | str, day: str, rule_group: str) -> DataFrame:
    return log.where(
        (F.col("ID_BATCH") == str(batch_id))
        & (F.col("DATE_METRIC") == day)
        & (F.col("RULE_GROUP") == rule_group)
        & (F.col("CODE_LOG_TYPE") == "RESULT")
    )


def status_document(log: DataFrame) -> DataFrame:
    """JSON status per group: 3 syntax failure, 2 severity-0 failure, 1 lesser failures, 0 clean."""
    lesser = F.col("N_FAILED_SEVERITY_1") + F.col("N_FAILED_SEVERITY_2") + F.col("N_FAILED_SEVERITY_3")
    code = F.when(F.col("N_FAILED_SYNTAX_COUNT") > 0, 3).when(F.col("N_FAILED_SEVERITY_0") > 0, 2)
    code = code.when(lesser > 0, 1).otherwise(0)
    texts = F.array(*[F.lit(t) for t in ("success", "warnings", "critical failures", "rules with syntax errors")])
    body = F.struct(
        code.alias("status_code"),
        F.get(texts, code).alias("status_message"),
        F.struct(F.col("ID_BATCH").alias("batch_id"), F.col("DATE_METRIC").alias("batch_date")).alias("batch_info"),
    )
    return log.select("RULE_GROUP", F.to_json(body).alias("document"))


def parse_status(documents: DataFrame, column: str = "document") -> DataFrame:
    return documents.withColumn("status", F.from_json(F.col(column), STATUS_SCHEMA))


def route_alerts(log: DataFrame) -> DataFrame:
    """Alert rows of each run. A syntax or severity-0 failure stops the run and mutes the lesser alerts."""
    n = {s: F.col(f"N_FAILED_SEVERITY_{s}") for s in SEVERITIES}
    syntax = F.col("N_FAILED_SYNTAX_COUNT")
    stopped = (syntax > 0) | (n[0] > 0)
    lesser = n[1] + n[2] + n[3]

    def alert(when: Column, cause: str, trigger: str, level: str, to: str, stops: bool, count: Column) -> Column:
        fields = F.struct(
            F.lit(cause).alias("cause"),
            F.lit(trigger).alias("trigger_type"),
            F.lit(level).alias("alert_level"),
            F.lit(to).alias("alert_type"),
            F.lit(stops).alias("stops_run"),
            count.alias("failures"),
        )
        return F.when(when, fields)

    sev0 = (syntax == 0) & (n[0] > 0)
    alerts = F.array(
        alert(syntax > 0, "SYNTAX", "error", "HIGH", "oncall", True, syntax),
        alert(sev0, "SEV_0", "error", "HIGH", "oncall", True, n[0]),
        alert(sev0, "SEV_0", "error", "HIGH", "regular", True, n[0]),
        alert(~stopped & (n[1] > 0), "SEV_1", "error", "MEDIUM", "oncall", False, n[1]),
        alert(~stopped & (n[1] > 0), "SEV_1", "log", "MEDIUM", "regular", False, n[1]),
        alert(~stopped & (n[2] > 0), "SEV_2", "log", "LOW", "regular", False, n[2]),
        alert(~stopped & (n[3] > 0), "SEV_3", "log", "LOW", "regular", False, n[3]),
        alert(~stopped, "SUCCESS", "info", "INFO", "regular", False, lesser),
    )
    rows = log.select("RULE_GROUP", "ID_BATCH", F.explode(F.array_compact(alerts)).alias("a"))
    return rows.select("RULE_GROUP", "ID_BATCH", "a.*", severity_label(F.col("a.trigger_type")).alias("severity"))
