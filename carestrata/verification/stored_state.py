"""What is kept between batches: stored history, rule results by batch, and watched file sets, over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators.merge import BatchStamp
from carestrata.operators.rules import Rule
from carestrata.plans.jobs import Lake, history_job
from carestrata.plans.rule_state import RuleState, rule_digest
from carestrata.plans.tables import BatchTable
from carestrata.settings import Criterion, FileCriteria, ProgramConfig, TargetTable
from carestrata.streaming.monitor import ALERT_DDL, watch_sets
from carestrata.verification.registry import buckets_for, scratch, table, verify

_AT = datetime(2024, 1, 1)
_DAYS = ("2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01")
_ARRIVE = (1, 4, 2, 3)
_LAST_LINES = TargetTable("LAST_LINES", ("l_orderkey",), ("flag", "status"))


@verify("""
    WITH o AS (SELECT CAST(l_orderkey AS VARCHAR) AS k, (l_linenumber + 1) // 2 AS b, max(l_returnflag) AS flag, max(l_linestatus) AS status
               FROM lineitem GROUP BY 1, 2),
    d AS (SELECT k, flag, status, '2024-0' || b || '-01' AS day FROM o),
    n AS (SELECT *, CASE WHEN lag(flag) OVER w IS NOT DISTINCT FROM flag AND lag(status) OVER w IS NOT DISTINCT FROM status THEN 0 ELSE 1 END AS begins
          FROM d WINDOW w AS (PARTITION BY k ORDER BY day)),
    r AS (SELECT *, sum(begins) OVER (PARTITION BY k ORDER BY day) AS run FROM n),
    v AS (SELECT k, run, min(flag) AS flag, min(status) AS status, min(day) AS f, string_agg(day, ',' ORDER BY day) AS seen FROM r GROUP BY k, run),
    e AS (SELECT *, coalesce(lead(f) OVER (PARTITION BY k ORDER BY f), '2299-12-31') AS t FROM v)
    SELECT k AS l_orderkey, flag, status, f AS VALID_FROM, t AS VALID_TO, CASE WHEN t = '2299-12-31' THEN 'Y' ELSE 'N' END AS IS_CURRENT,
           seen AS CONFIRMED_DAYS FROM e
""")
def history_late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of order lines as four days' batches, of which the last day comes second; the versions are those by day."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.floor((F.col("l_linenumber") + 1) / 2)
    config = ProgramConfig("ORDERS", "HISTORY", FileCriteria(), "HISTORY")
    lake = Lake(spark, scratch(spark, "history"), buckets_for(lines.count(), 8, 1_000_000))
    for n in _ARRIVE:
        told = lines.where(number == n).groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("status"))
        history_job(lake, told, _LAST_LINES, config, _DAYS[n - 1], _AT)
    columns = ["l_orderkey", "flag", "status", "VALID_FROM", "VALID_TO", "IS_CURRENT", "CONFIRMED_DAYS"]
    return lake.history(_LAST_LINES).versions().select(*columns)


_KEPT_RULES = [
    Rule("K1", "KEPT", 0, "orders", expression="o_totalprice > 100000"),
    Rule("K2", "KEPT", 1, "orders", kind="null", expression="reviewed"),
    Rule("K3", "KEPT", 2, "orders", kind="duplicate", keys=("o_custkey", "o_orderpriority")),
    Rule("K4", "KEPT", 3, "orders", expression="no_such_column > 0"),
    Rule("K5", "KEPT", 3, "orders", kind="duplicate", keys=("o_orderkey",)),
]


@verify("""
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END AS c, o_orderpriority, o_totalprice,
                      CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS reviewed FROM orders),
    n AS (SELECT count(*) AS n_rows, count_if(NOT coalesce(o_totalprice > 100000, false)) AS k1, count_if(reviewed IS NULL) AS k2,
                 count(*) - count(DISTINCT (c, o_orderpriority)) AS k3, count(*) - count(DISTINCT o_orderkey) AS k5 FROM t),
    r AS (SELECT 'K1' AS rule_id, 0 AS severity, 'predicate' AS kind, k1 AS f, n_rows FROM n
          UNION ALL SELECT 'K2', 1, 'null', k2, n_rows FROM n UNION ALL SELECT 'K3', 2, 'duplicate', k3, n_rows FROM n
          UNION ALL SELECT 'K4', 3, 'predicate', 0, n_rows FROM n UNION ALL SELECT 'K5', 3, 'duplicate', k5, n_rows FROM n)
    SELECT rule_id, 'KEPT' AS rule_group, CAST(severity AS INTEGER) AS severity, 'orders' AS table_name, kind, n_rows, CAST(f AS BIGINT) AS n_failed,
           CASE WHEN rule_id = 'K4' THEN 'SYNTAX' WHEN f > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
           CASE WHEN rule_id IN ('K2', 'K4') THEN '1,2,3' ELSE '3' END AS checked_last FROM r
""")
def dq_rules_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status as three batches; the first one is replaced, the third one brings a column. The totals are those
    of the whole table, and the last run checked the third batch alone but for rules that the new column could mend."""
    root = scratch(spark, "rules")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    kept, state = BatchTable(spark, f"{root}/orders"), RuleState(spark, f"{root}/state")

    def load(status: str, batch_id: int, **changes) -> None:
        rows = orders.where(F.col("o_orderstatus") == status).withColumns(changes)
        kept.replace(rows, batch_id)

    load("F", 1)
    load("O", 2)
    state.update(kept, _KEPT_RULES)
    load("F", 1, o_custkey=F.col("o_custkey") + 1)
    state.update(kept, _KEPT_RULES)
    before = state.checked().agg(F.max("at")).first()[0]
    load("P", 3, reviewed=F.col("o_orderpriority"))
    totals = state.update(kept, _KEPT_RULES)
    ids = spark.createDataFrame([(r.rule_id, rule_digest(r)) for r in _KEPT_RULES], "rule_id string, rule string")
    last = state.checked().where(F.col("at") > before).join(ids, "rule").groupBy("rule_id")
    return totals.join(last.agg(F.array_join(F.array_sort(F.collect_set("batch_id")), ",").alias("checked_last")), "rule_id")


_WATCHED = FileCriteria(prefix=Criterion(("F_",), 2), extension=Criterion((".csv",), 3))


@verify("""
    WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS s, o_orderdate AS landed, o_orderstatus = 'F' AS f, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN -1 ELSE 1 END AS c,
                      CASE WHEN o_orderdate < '1994-06-01' THEN 1 WHEN o_orderdate < '1996-06-01' THEN 2 ELSE 3 END AS w FROM orders),
    g AS (SELECT s, w, coalesce(sum(c) FILTER (f), 0) AS df, sum(c) AS dn FROM a GROUP BY s, w),
    wm AS (SELECT w, max(m) OVER (ORDER BY w) AS mark FROM (SELECT w, max(landed) AS m FROM a GROUP BY w)),
    z AS (SELECT k.s, wm.w, wm.mark, k.first_at, g.s IS NOT NULL AS came, sum(coalesce(df, 0)) OVER o AS n, sum(coalesce(dn, 0)) OVER o AS seen
          FROM (SELECT s, min(w) AS w, min(landed) AS first_at FROM a GROUP BY s) k JOIN wm ON wm.w >= k.w LEFT JOIN g ON g.s = k.s AND g.w = wm.w
          WINDOW o AS (PARTITION BY k.s ORDER BY wm.w)),
    y AS (SELECT *, n = 2 AND seen >= 3 AS complete, CASE WHEN lag(n) OVER p <> n THEN 1 ELSE 0 END AS moved FROM z WINDOW p AS (PARTITION BY s ORDER BY w)),
    i AS (SELECT *, sum(moved) OVER (PARTITION BY s ORDER BY w) AS run FROM y),
    told AS (SELECT s, 'COMPLETE' AS state, n, seen FROM i WHERE complete AND came QUALIFY row_number() OVER (PARTITION BY s, run ORDER BY w) = 1
             UNION ALL
             SELECT s, 'OVERDUE', n, seen FROM i WHERE NOT complete AND first_at + INTERVAL 800 DAY < mark QUALIFY row_number() OVER (PARTITION BY s ORDER BY w) = 1)
    SELECT s AS file_set, state, CAST(n AS BIGINT) AS found_total, CAST(seen AS BIGINT) AS seen FROM told
""")
def monitor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the files of a set, which land in three waves and are taken away if not specified; each wave
    is one run of the stream from the same checkpoint."""
    root = scratch(spark, "monitor")
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    files = orders.select(
        F.col("o_custkey").alias("customer"),
        F.concat("o_orderstatus", F.lit("_"), "o_orderkey", F.lit(".csv")).alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("landed_at"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", -1).otherwise(1).alias("change"),
        F.when(day < "1994-06-01", 1).when(day < "1996-06-01", 2).otherwise(3).alias("wave"),
    )
    for wave in (1, 2, 3):
        files.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(files.drop("wave").schema).parquet(f"{root}/in")
        alerts = watch_sets(stream, _WATCHED, "customer", "name", "landed_at", "800 days", "0 seconds", "change")
        sink = alerts.writeStream.option("checkpointLocation", f"{root}/checkpoint").format("parquet").option("path", f"{root}/alerts")
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ALERT_DDL).parquet(f"{root}/alerts")
