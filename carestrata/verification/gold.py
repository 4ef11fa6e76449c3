"""Upserts, history and load statistics over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.hashing import PIPE
from carestrata.operators.counts import load_stats, rows_per_batch
from carestrata.operators.history import track_history
from carestrata.operators.merge import BatchStamp, fits_broadcast, merge_changed, merge_counts
from carestrata.operators.reshape import unpivot_groups
from carestrata.verification.registry import table, verify
from carestrata.verification.silver import _LINE_STEMS, wide_lines

FIRST = BatchStamp("ORDERS", "SALES", 1, datetime(2024, 1, 1))
SECOND = BatchStamp("ORDERS", "SALES", 2, datetime(2024, 2, 1))

_ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = [F.col(c).cast("string").alias(c) for c in ("o_custkey", "o_orderstatus", "o_orderpriority")]
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", *text, price)


def _changed_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Gold holds settled and partial orders; the batch brings open ones and re-sends partial ones, the
    urgent among them with a new status and the unspecified with a NULL that reads like the old ''."""
    rows = _order_rows(spark, sf_dir)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    vague = priority == "4-NOT SPECIFIED"
    gold = rows.where(status.isin("F", "P")).withColumn("o_orderpriority", F.when(vague, "").otherwise(priority))
    batch = rows.where(status.isin("O", "P")).withColumns(
        {
            "o_orderstatus": F.when((status == "P") & (priority == "1-URGENT"), "F").otherwise(status),
            "o_orderpriority": F.when(~vague, priority),
        }
    )
    return FIRST.put_on(gold), batch


def _stats_text(df: DataFrame) -> DataFrame:
    """Batch times as text, so that both engines print them alike."""
    times = ("META_DATE_INSERT", "META_DATE_UPDATE")
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})


_ORDERS_CTE = """
    r AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
                 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, o_orderpriority AS pr
          FROM orders),
    g AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                 CASE WHEN pr = '4-NOT SPECIFIED' THEN '' ELSE pr END AS o_orderpriority
          FROM r WHERE o_orderstatus IN ('F', 'P')),
    s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' AND pr = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                 o_totalprice, CASE WHEN pr <> '4-NOT SPECIFIED' THEN pr END AS o_orderpriority
          FROM r WHERE o_orderstatus IN ('O', 'P'))"""


def _hash(alias: str, cols: list[str], sep: str) -> str:
    return f"md5(concat_ws('{sep}', " + ", ".join(f"coalesce({alias}.{c}, '')" for c in cols) + "))"


def _merge_sql(keys: list[str], cols: list[str], sep: str = "") -> str:
    """The merge over CTEs g (gold data, batch 1) and s (batch 2)."""
    on = " AND ".join(f"g.{k} = s.{k}" for k in keys)
    k0 = keys[0]
    changed = f"(g.{k0} IS NOT NULL AND s.{k0} IS NOT NULL AND {_hash('g', cols, sep)} <> {_hash('s', cols, sep)})"
    out = [f"coalesce(g.{k}, s.{k}) AS {k}" for k in keys]
    out += [f"CASE WHEN g.{k0} IS NULL OR {changed} THEN s.{c} ELSE g.{c} END AS {c}" for c in cols]
    return f"""SELECT 'ORDERS' AS META_PROGRAM_NAME, 'SALES' AS META_SUBJECT_AREA,
        CAST(CASE WHEN g.{k0} IS NULL THEN 2 ELSE 1 END AS BIGINT) AS META_BATCH_ID,
        CASE WHEN g.{k0} IS NULL THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS META_DATE_INSERT,
        CASE WHEN {changed} THEN '2024-02-01 00:00:00' END AS META_DATE_UPDATE,
        CAST(CASE WHEN {changed} THEN 2 END AS BIGINT) AS META_UPD_BATCH_ID,
        {", ".join(out)}
        FROM g FULL OUTER JOIN s ON {on}"""


@verify(f"WITH {_ORDERS_CTE} {_merge_sql(['o_orderkey'], _ORDER_COLUMNS)}")
def merge_gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, batch = _changed_orders(spark, sf_dir)
    return _stats_text(merge_changed(gold, batch, ["o_orderkey"], _ORDER_COLUMNS, SECOND))


@verify(f"WITH {_ORDERS_CTE} {_merge_sql(['o_orderkey'], _ORDER_COLUMNS, '|')}")
def merge_gold_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert with the join chosen from the measured size of the batch."""
    gold, batch = _changed_orders(spark, sf_dir)
    small = fits_broadcast(batch, ["o_orderkey", *_ORDER_COLUMNS])
    merged = merge_changed(
        gold, batch, ["o_orderkey"], _ORDER_COLUMNS, SECOND, sep=PIPE, strategy="broadcast" if small else "shuffle"
    )
    return _stats_text(merged)


_LINES_CTE = """
    r AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS seq_id,
                 CAST(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS VARCHAR) AS qty, max(l_returnflag) AS flag,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS VARCHAR) AS price,
                 strftime(max(l_shipdate), '%Y-%m-%d') AS ship
          FROM lineitem GROUP BY l_orderkey, l_linenumber),
    g AS (SELECT * FROM r WHERE flag IN ('A', 'R')),
    s AS (SELECT l_orderkey, seq_id, qty, CASE WHEN flag = 'R' AND ship < '1999-01-01' THEN 'X' ELSE flag END AS flag, price, ship
          FROM r WHERE flag IN ('N', 'R'))"""


@verify(f"WITH {_LINES_CTE} {_merge_sql(['l_orderkey', 'seq_id'], list(_LINE_STEMS))}")
def merge_gold_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpivoted order lines upserted on (order, sequence): returned lines change, new lines come, others stay."""
    lines = unpivot_groups(wide_lines(spark, sf_dir), ["l_orderkey"], _LINE_STEMS, 7, "seq_id")
    gold = FIRST.put_on(lines.where(F.col("flag").isin("A", "R")))
    old_return = (F.col("flag") == "R") & (F.col("ship") < "1999-01-01")
    batch = lines.where(F.col("flag").isin("N", "R")).withColumn("flag", F.when(old_return, "X").otherwise(F.col("flag")))
    return _stats_text(merge_changed(gold, batch, ["l_orderkey", "seq_id"], _LINE_STEMS, SECOND, null_keys="absent"))


@verify(f"""WITH g AS (SELECT p_name || ' ' || p_partkey AS code, p_brand AS grouping_name, p_type AS classification,
                           CASE WHEN p_size > 5 THEN CAST(p_size AS VARCHAR) END AS notes FROM part WHERE p_size <= 35),
                 s AS (SELECT p_name || ' ' || p_partkey AS code, CASE WHEN p_size > 30 THEN p_brand || '*' ELSE p_brand END AS grouping_name,
                           p_type AS classification, CASE WHEN p_size > 15 THEN CAST(p_size AS VARCHAR) ELSE '' END AS notes
                       FROM part WHERE p_size > 10)
            {_merge_sql(["code"], ["grouping_name", "classification", "notes"], "|")}""")
def merge_gold_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code set with one text key and pipe-separated fingerprints."""
    size = F.col("p_size")
    code = F.concat("p_name", F.lit(" "), "p_partkey").alias("code")
    part = table(spark, sf_dir, "part")
    gold = part.where(size <= 35).select(
        code,
        F.col("p_brand").alias("grouping_name"),
        F.col("p_type").alias("classification"),
        F.when(size > 5, size.cast("string")).alias("notes"),
    )
    batch = part.where(size > 10).select(
        code,
        F.when(size > 30, F.concat("p_brand", F.lit("*"))).otherwise(F.col("p_brand")).alias("grouping_name"),
        F.col("p_type").alias("classification"),
        F.when(size > 15, size.cast("string")).otherwise("").alias("notes"),
    )
    business = ["grouping_name", "classification", "notes"]
    return _stats_text(merge_changed(FIRST.put_on(gold), batch, ["code"], business, SECOND, sep=PIPE))


@verify("""
    WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) || '-' || event_id END AS k,
                      event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v FROM events),
    g AS (SELECT * FROM e WHERE event_type IN ('view', 'click', 'error')),
    s AS (SELECT * FROM e WHERE event_type IN ('click', 'signup', 'purchase', 'error'))
    SELECT k, event_type, v, CAST(1 AS BIGINT) AS META_BATCH_ID FROM g
    UNION ALL
    SELECT k, event_type, v, CAST(2 AS BIGINT) FROM s WHERE k IS NULL OR k NOT IN (SELECT k FROM g WHERE k IS NOT NULL)
""")
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL keys match nothing: gold keeps its own, the batch's are inserted, none meets in the join."""
    key = F.when(F.col("event_type") != "error", F.concat_ws("-", "user_id", "event_id"))
    value = F.col("value").cast("decimal(18,2)").cast("string")
    rows = table(spark, sf_dir, "events").select(key.alias("k"), "event_type", value.alias("v"))
    gold = FIRST.put_on(rows.where(F.col("event_type").isin("view", "click", "error")))
    batch = rows.where(F.col("event_type").isin("click", "signup", "purchase", "error"))
    merged = merge_changed(gold, batch, ["k"], ["event_type", "v"], SECOND)
    return merged.select("k", "event_type", "v", "META_BATCH_ID")


@verify(f"""WITH {_ORDERS_CTE}, m AS ({_merge_sql(["o_orderkey"], _ORDER_COLUMNS)})
    SELECT count(*) FILTER (META_BATCH_ID = 2) AS inserted, count(*) FILTER (META_UPD_BATCH_ID = 2) AS updated,
           count(*) AS gold_total FROM m""")
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, batch = _changed_orders(spark, sf_dir)
    return merge_counts(merge_changed(gold, batch, ["o_orderkey"], _ORDER_COLUMNS, SECOND), SECOND.batch_id)


@verify("""
    SELECT META_BATCH_ID, count(*) AS row_count FROM (SELECT year(o_orderdate) AS META_BATCH_ID FROM orders) GROUP BY 1
""")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate").cast("bigint").alias("META_BATCH_ID")
    return rows_per_batch(table(spark, sf_dir, "orders").select(year, "o_orderkey"))


@verify("""
    WITH c AS (SELECT 'ORDERS' AS table_name, count(*) FILTER (year(o_orderdate) = 1998) AS row_count FROM orders
               UNION ALL SELECT 'LINES', count(*) FILTER (year(l_shipdate) = 1998) FROM lineitem)
    SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM c
""")
def silver_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one batch (a year) per target table, and their total."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("META_BATCH_ID"))
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("META_BATCH_ID"))
    return load_stats({"ORDERS": orders, "LINES": lines}, 1998)


@verify("""
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'O' THEN year(o_orderdate) END, 7) AS META_BATCH_ID,
           CASE WHEN o_orderstatus = 'O' THEN 'ORDERS' ELSE 'OLD' END AS META_PROGRAM_NAME
    FROM orders
""")
def backfill_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a batch get this batch's stamp, stamped rows keep theirs."""
    loaded = F.col("o_orderstatus") != "O"
    stamp = BatchStamp("ORDERS", "SALES", 7, datetime(2024, 3, 1))
    values = {
        "META_PROGRAM_NAME": F.when(loaded, "OLD"),
        "META_BATCH_ID": F.when(loaded, F.year("o_orderdate")).cast("bigint"),
    }
    blank = {c: values.get(c, F.lit(None)).cast(stamp_type) for c, stamp_type in _meta_types().items()}
    rows = table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(k) for k, v in blank.items()])
    return stamp.fill_in(rows).select("o_orderkey", "META_BATCH_ID", "META_PROGRAM_NAME")


def _meta_types() -> dict:
    from carestrata.settings import META_SCHEMA

    return {f.name: f.dataType for f in META_SCHEMA}


@verify(f"""
    WITH {_ORDERS_CTE},
    h AS (SELECT *, '2024-01-01' AS f, CASE WHEN o_orderstatus = 'F' THEN '2024-01-15' ELSE '2299-12-31' END AS t,
                 CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS c FROM g),
    b AS (SELECT * FROM s UNION ALL SELECT o_orderkey, o_custkey, 'C', o_totalprice, pr FROM r WHERE o_orderstatus = 'F' AND pr = '1-URGENT'),
    j AS (SELECT h.o_orderkey AS hk, b.o_orderkey AS bk, h.o_custkey, h.o_orderstatus, h.o_totalprice, h.o_orderpriority, h.f, h.t, h.c,
                 b.o_custkey AS b1, b.o_orderstatus AS b2, b.o_totalprice AS b3, b.o_orderpriority AS b4,
                 {_hash("h", _ORDER_COLUMNS, "|")} <> {_hash("b", _ORDER_COLUMNS, "|")} AS differs
          FROM (SELECT * FROM h WHERE c = 'Y') h FULL OUTER JOIN b ON h.o_orderkey = b.o_orderkey)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, f AS VALID_FROM, t AS VALID_TO, c AS IS_CURRENT
    FROM h WHERE c = 'N'
    UNION ALL
    SELECT hk, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, f,
           CASE WHEN bk IS NOT NULL AND differs THEN '2024-02-01' ELSE t END, CASE WHEN bk IS NOT NULL AND differs THEN 'N' ELSE c END
    FROM j WHERE hk IS NOT NULL
    UNION ALL
    SELECT bk, b1, b2, b3, b4, '2024-02-01', '2299-12-31', 'Y' FROM j WHERE bk IS NOT NULL AND (hk IS NULL OR differs)
""")
def scd2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with closed (settled) and current (partial) versions meets a batch that changes, adds and reopens."""
    gold, batch = _changed_orders(spark, sf_dir)
    closed = F.col("o_orderstatus") == "F"
    history = gold.select(
        "o_orderkey",
        *_ORDER_COLUMNS,
        F.lit("2024-01-01").alias("VALID_FROM"),
        F.when(closed, "2024-01-15").otherwise("2299-12-31").alias("VALID_TO"),
        F.when(closed, "N").otherwise("Y").alias("IS_CURRENT"),
    )
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    reopened = _order_rows(spark, sf_dir).where(urgent).withColumn("o_orderstatus", F.lit("C"))
    return track_history(history, batch.unionByName(reopened), ["o_orderkey"], _ORDER_COLUMNS, "2024-02-01")
