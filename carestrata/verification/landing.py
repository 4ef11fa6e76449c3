"""File names, file sets, releases, links, lineage and loads over the given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions import releases as rel
from carestrata.functions.filenames import (
    EMPTY_NAME,
    GENERAL_STAMPS,
    MARKER_STAMPS,
    MARKERS,
    clean_file_name,
    file_type,
    table_name,
)
from carestrata.operators.counts import volume
from carestrata.operators.fileset import due_sets, matched_files, set_completeness
from carestrata.operators.lineage import lineage_rows
from carestrata.operators.merge import BatchStamp
from carestrata.operators.predicates import file_matches
from carestrata.operators.rules import Rule
from carestrata.plans.gold import upsert
from carestrata.plans.jobs import Lake, RulesFailed, merge_checked
from carestrata.plans.sqltext import run_sql
from carestrata.plans.tables import BatchTable, GoldTable
from carestrata.settings import Criterion, FileCriteria, ProgramConfig, TargetTable
from carestrata.sources.columnar import parquet_into
from carestrata.sources.delimited import csv_by_name, csv_inferred, csv_positional, csv_profile
from carestrata.sources.files import first_member, list_members, member_lines, not_loaded, not_present
from carestrata.sources.pages import code_set_link, latest_releases, page_links, registry_releases
from carestrata.streaming.ingest import ingest_and_wait, new_files
from carestrata.verification.gold import _ORDERS_CTE, _changed_orders, _merge_sql, _order_rows, _stats_text
from carestrata.verification.registry import scratch, table, verify

# --- file names --------------------------------------------------------------------------------------------
# Stamped names, one form per rule: the digits come from each document's own id and length.
_FORMS = (
    "{s}_TB_{y}_07_18T{t}Z_x.csv",
    "{s}_TBL_{y}_07_18T{t}_x.csv",
    "{s}_TB_{y}_07_18.csv",
    "{s}_TBL_{y}_07_18_tail.CSV",
    "{s}_TB_{y}0718T{t}Z.parquet",
    "{s}_TBL_{y}0718T{t}.txt",
    "{s}_{y}0718-{y}0725.zip",
    "{s}_{y}_07_18T{t}Z.csv",
    "{s}_{y}_07_18_{t}.csv",
    "{s}_{y}-07-08T{t}Z.xlsx",
    "{s}_{y}-07-08_1430.csv",
    "{s}_{y}0708T{t}.csv",
    "{s}_{y}0708_{t}_b.csv",
    "{s}_{y}0708{t}.csv",
    "{s}_{y}07081430.xls",
    "{s}_1{n}_.csv",
    "{s}T{t}Z.tar.gz",
    "{s}_{y}_07_18.csv",
    "{s}_{y}0718-.csv",
    "{s}_251.csv",
    "_1234.csv",
    "{s}",
)
_PARTS_SQL = {
    "{s}": "source || '.' || lang",
    "{y}": "CAST(2000 + doc_id % 30 AS VARCHAR)",
    "{t}": "lpad(CAST(n_chars AS VARCHAR), 6, '0')",
    "{n}": "lpad(CAST(doc_id AS VARCHAR), 9, '0')",
}


def _form_sql(form: str) -> str:
    text = f"'{form}'"
    for mark, sql in _PARTS_SQL.items():
        text = f"replace({text}, '{mark}', {sql})" if mark in form else text
    return text


_NAMES_SQL = "SELECT doc_id, CASE doc_id % {n} {cases} END AS name FROM documents".format(
    n=len(_FORMS), cases=" ".join(f"WHEN {i} THEN {_form_sql(f)}" for i, f in enumerate(_FORMS))
)


def _named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = {
        "{s}": F.concat_ws(".", "source", "lang"),
        "{y}": (2000 + F.col("doc_id") % 30).cast("string"),
        "{t}": F.lpad(F.col("n_chars").cast("string"), 6, "0"),
        "{n}": F.lpad(F.col("doc_id").cast("string"), 9, "0"),
    }
    form = F.element_at(F.array(*[F.lit(f) for f in _FORMS]), (F.col("doc_id") % len(_FORMS) + 1).cast("int"))
    for mark, value in marks.items():
        form = F.replace(form, F.lit(mark), value)
    return table(spark, sf_dir, "documents").select("doc_id", form.alias("name"))


def _clean_sql() -> str:
    general = "base"
    for pattern in GENERAL_STAMPS:
        general = f"regexp_replace({general}, '{pattern}', '')"
    general = f"coalesce(nullif(regexp_replace({general}, '[_-]+$', ''), ''), '{EMPTY_NAME}')"
    cases = ""
    for stamp in MARKER_STAMPS:
        for marker in MARKERS:
            pattern = f"^(.+{marker}){stamp}.*"
            cases += f" WHEN regexp_matches(base, '{pattern}') THEN regexp_replace(base, '{pattern}', '\\1')"
    return f"CASE {cases} ELSE {general} END || ext"


@verify(f"""
    WITH n AS ({_NAMES_SQL}),
    e AS (SELECT *, regexp_extract(name, '[^/.][^/]*(\\.[^/.]*)$', 1) AS ext FROM n),
    b AS (SELECT *, left(name, length(name) - length(ext)) AS base FROM e)
    SELECT doc_id, {_clean_sql()} AS clean_name, regexp_replace(name, '(?i)\\.csv$', '') AS table_name,
           CASE lower(ext) WHEN '.csv' THEN 'CSV' WHEN '.parquet' THEN 'PARQUET' WHEN '.txt' THEN 'TEXT'
                WHEN '.xlsx' THEN 'EXCEL' WHEN '.xls' THEN 'EXCEL' WHEN '.zip' THEN 'ZIP' ELSE upper(ltrim(ext, '.')) END AS file_type
    FROM b
""")
def file_name_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return _named_documents(spark, sf_dir).select(
        "doc_id",
        clean_file_name(name).alias("clean_name"),
        table_name(name).alias("table_name"),
        file_type(name).alias("file_type"),
    )


_CRITERIA = FileCriteria(
    prefix=Criterion(("src1", "src0", "src")),
    contains=Criterion(("TB", "_2", "T0")),
    not_contains=Criterion((".de_", "-07-08")),
    regex=Criterion((r"_\d{4}", r"\.en")),
    extension=Criterion((".csv", ".TXT")),
)


@verify(f"""
    SELECT doc_id, name FROM ({_NAMES_SQL})
    WHERE (starts_with(name, 'src1') OR starts_with(name, 'src0') OR starts_with(name, 'src'))
      AND (contains(name, 'TB') OR contains(name, '_2') OR contains(name, 'T0'))
      AND NOT (contains(name, '.de_') OR contains(name, '-07-08'))
      AND (regexp_matches(name, '_\\d{{4}}') OR regexp_matches(name, '\\.en'))
      AND (ends_with(lower(name), '.csv') OR ends_with(lower(name), '.txt'))
""")
def file_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_documents(spark, sf_dir).where(file_matches(_CRITERIA, F.col("name")))


# --- file sets ---------------------------------------------------------------------------------------------
# A customer is a landing folder, an order a file in it.
_SET = FileCriteria.from_dict(
    {
        "prefix": {"pattern": ["1-URGENT", "2-HIGH"], "count": 2},
        "contains": {"pattern": "-F-", "count": 1},
        "suffix": {"pattern": None, "count": 0},
        "regex": {"pattern": None, "count": 0},
        "not_contains": {"pattern": ["NOT"], "count": 0},
        "extension": {"pattern": [".csv"], "count": 3},
    }
)
_FILES_SQL = """SELECT o_custkey AS folder, o_orderdate,
    o_orderpriority || '-' || o_orderstatus || '-' || o_orderkey || CASE WHEN o_totalprice > 450000 THEN '.CSV' ELSE '.csv' END AS name FROM orders"""


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.when(F.col("o_totalprice") > 450000, ".CSV").otherwise(".csv")
    name = F.concat("o_orderpriority", F.lit("-"), "o_orderstatus", F.lit("-"), "o_orderkey", ext)
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("folder"), "o_orderdate", name.alias("name"))


def _states_sql(where: str) -> str:
    return f"""
    SELECT *, CASE WHEN complete AND told THEN 'COMPLETE_NOTIFIED' WHEN complete THEN 'COMPLETE' WHEN found_total < 3 THEN 'INCOMPLETE'
                   WHEN found_total > 3 THEN 'EXCESS_FILES' ELSE 'CRITERIA_NOT_MET' END AS state
    FROM (SELECT *, found_prefix + found_contains AS found_total, CAST(3 AS BIGINT) AS expected_total,
                 found_prefix = 2 AND found_contains = 1 AND seen >= 3 AS complete, found_prefix + found_contains >= 3 AS enough
          FROM (SELECT folder, count(*) FILTER (ok AND (starts_with(name, '1-URGENT') OR starts_with(name, '2-HIGH'))) AS found_prefix,
                       count(*) FILTER (ok AND contains(name, '-F-')) AS found_contains, count(*) FILTER (ok) AS seen,
                       max(o_orderdate) > TIMESTAMP '1999-06-01' AS told
                FROM (SELECT *, ends_with(name, '.csv') AND NOT contains(name, 'NOT') AS ok FROM ({_FILES_SQL}) WHERE {where}) GROUP BY folder))"""


_NOTIFIED = "1999-06-01"


def _set_states(files: DataFrame) -> DataFrame:
    told = F.col("o_orderdate") > F.lit(_NOTIFIED).cast("timestamp_ntz")
    return set_completeness(files, _SET, by=["folder"], notified=told)


@verify(f"""SELECT folder, found_prefix, found_contains, found_total, expected_total, complete, enough, state FROM ({_states_sql('true')})""")
def file_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _set_states(_order_files(spark, sf_dir))


_EARLIER = "o_orderdate < TIMESTAMP '2000-01-01'"


@verify(f"""
    SELECT folder, found_total FROM ({_states_sql('true')}) n WHERE complete
      AND NOT EXISTS (SELECT 1 FROM ({_states_sql(_EARLIER)}) f WHERE f.complete AND f.folder = n.folder AND f.found_total = n.found_total)
""")
def due_file_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets complete now that had not fired with this count at an earlier look."""
    files = _order_files(spark, sf_dir)
    earlier = files.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    fired = _set_states(earlier).where("complete").select("folder", "found_total")
    return due_sets(_set_states(files), fired, "folder").select("folder", "found_total")


@verify(f"""SELECT DISTINCT name FROM ({_FILES_SQL}) WHERE ends_with(name, '.csv') AND NOT contains(name, 'NOT')
            AND (starts_with(name, '1-URGENT') OR starts_with(name, '2-HIGH') OR contains(name, '-F-'))""")
def matched_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched_files(_order_files(spark, sf_dir), _SET)


@verify("""SELECT count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes, CAST(sum(n_chars) AS BIGINT) / 1048576 AS megabytes FROM documents""")
def copied_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume(table(spark, sf_dir, "documents").select(F.col("n_chars").alias("size")))


# --- releases ----------------------------------------------------------------------------------------------
_MONTH_NAMES = ", ".join(f"'{m.title()}'" for m in rel.MONTHS)
_RELEASE_SQL = f"""
    SELECT o_orderkey, o_custkey, o_orderdate, CASE
        WHEN o_orderstatus = 'F' THEN 'NPPES_Data_Dissemination_' || strftime(o_orderdate, '%m%d%y') || '_' || strftime(o_orderdate + INTERVAL 6 DAY, '%m%d%y') || '_Weekly_V2.zip'
        WHEN o_orderstatus = 'P' THEN 'NPPES_Data_Dissemination_' || [{_MONTH_NAMES}][month(o_orderdate)] || '_' || (2000 + year(o_orderdate) % 100) || '_V.2.zip'
        WHEN o_orderpriority = '5-LOW' THEN 'NPPES_Dissemination_' || strftime(o_orderdate, '%m%d%y') || '_weekly_version2.zip'
        ELSE 'NPPES_Deactivated_' || strftime(o_orderdate, '%m%d%y') || '.zip' END AS href
    FROM orders"""
_SCORED_SQL = f"""
    SELECT *, CASE WHEN kind = 'weekly' THEN CAST('20' || last[5:6] || last[1:4] AS BIGINT)
                   ELSE CAST(regexp_extract(href, '20\\d{{2}}') AS BIGINT) * 10000
                        + list_position([{_MONTH_NAMES}], regexp_extract(href, '{"|".join(m.title() for m in rel.MONTHS)}')) * 100 END AS score
    FROM (SELECT *, CASE WHEN href ILIKE '%dissemination%' AND href ILIKE '%weekly%' THEN 'weekly' WHEN href ILIKE '%dissemination%' THEN 'monthly' END AS kind,
                 regexp_extract_all(href, '\\d{{6}}')[-1] AS last FROM ({_RELEASE_SQL}))
    WHERE kind IS NOT NULL"""


def _release_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    end = day + F.expr("INTERVAL 6 DAYS")
    month = F.element_at(F.array(*[F.lit(m.title()) for m in rel.MONTHS]), F.month(day))
    weekly = F.concat(
        F.lit("NPPES_Data_Dissemination_"), F.date_format(day, "MMddyy"), F.lit("_"), F.date_format(end, "MMddyy"), F.lit("_Weekly_V2.zip")
    )
    monthly = F.concat(F.lit("NPPES_Data_Dissemination_"), month, F.lit("_"), 2000 + F.year(day) % 100, F.lit("_V.2.zip"))
    single = F.concat(F.lit("NPPES_Dissemination_"), F.date_format(day, "MMddyy"), F.lit("_weekly_version2.zip"))
    other = F.concat(F.lit("NPPES_Deactivated_"), F.date_format(day, "MMddyy"), F.lit(".zip"))
    status = F.col("o_orderstatus")
    href = F.when(status == "F", weekly).when(status == "P", monthly).when(F.col("o_orderpriority") == "5-LOW", single)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", href.otherwise(other).alias("href"))


@verify(f"""SELECT o_custkey, kind, max(score) AS score, max_by(href, (score, href)) AS name FROM ({_SCORED_SQL}) GROUP BY 1, 2""")
def release_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest release per customer and kind."""
    found = registry_releases(_release_names(spark, sf_dir)).withColumn("by", F.struct("o_custkey", "kind"))
    return latest_releases(found, "by").select("by.*", "score", "name")


@verify(f"""
    SELECT o_orderkey,
      CASE WHEN w THEN href[26:27] || '/' || href[28:29] || '/20' || href[30:31] END AS start_date,
      CASE WHEN w THEN href[33:34] || '/' || href[35:36] || '/20' || href[37:38] END AS end_date,
      CASE WHEN w THEN 'weekly' WHEN mon <> '' THEN 'monthly' END AS type,
      CASE WHEN NOT w THEN nullif(regexp_extract(href, '20\\d{{2}}'), '') END AS year,
      CASE WHEN NOT w THEN nullif(mon, '') END AS month,
      'npidata_pfile_' || CASE WHEN w THEN '20' || href[30:31] || href[26:29] || '-20' || href[37:38] || href[33:36]
          WHEN mon <> '' THEN regexp_extract(href, '20\\d{{2}}') || lpad(CAST(list_position([{_MONTH_NAMES}], mon) AS VARCHAR), 2, '0') || '_monthly'
          ELSE '1700000000' END || '.csv' AS file_name,
      year(o_orderdate) || CASE WHEN month(o_orderdate) >= 7 THEN '.2' ELSE '.1' END AS version,
      CASE WHEN day(o_orderdate) BETWEEN 13 AND 17 THEN 'monthly' ELSE 'weekly' END AS cadence,
      month(o_orderdate) IN (1, 7) AND day(o_orderdate) <= 7 AS in_window
    FROM (SELECT *, regexp_matches(href, '\\d{{6}}_\\d{{6}}') AS w, regexp_extract(href, '{"|".join(m.title() for m in rel.MONTHS)}') AS mon FROM ({_RELEASE_SQL}))
""")
def release_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, day = F.col("href"), F.col("o_orderdate")
    return _release_names(spark, sf_dir).select("o_orderkey", name, day, rel.release_info(name).alias("info")).select(
        "o_orderkey",
        "info.*",
        rel.data_file_name(name, F.lit(1700000000)).alias("file_name"),
        rel.release_version(day).alias("version"),
        rel.release_cadence(day).alias("cadence"),
        rel.in_release_window(day).alias("in_window"),
    )


@verify(f"""
    WITH r AS (SELECT o_orderkey, href, regexp_extract(href, '(\\d{{6}})_(\\d{{6}})', ['a', 'b']) AS p FROM ({_RELEASE_SQL})),
    f AS (SELECT DISTINCT strftime(l_shipdate, '%Y%m%d') || '-' || strftime(l_shipdate + INTERVAL 6 DAY, '%Y%m%d') AS period FROM lineitem WHERE l_quantity > 20)
    SELECT o_orderkey FROM r
    WHERE p.a = '' OR '20' || p.a[5:6] || p.a[1:4] || '-20' || p.b[5:6] || p.b[1:4] NOT IN (SELECT period FROM f)
""")
def releases_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases without a data file for the same days; files are named after shipping weeks."""
    day = F.col("l_shipdate")
    days = [F.date_format(d, "yyyyMMdd") for d in (day, day + F.expr("INTERVAL 6 DAYS"))]
    name = F.concat(F.lit("npidata_pfile_"), F.concat_ws("-", *days), F.lit("_x.csv"))
    files = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 20).select(name.alias("name"))
    releases = _release_names(spark, sf_dir).select("o_orderkey", F.col("href").alias("name"))
    return not_loaded(releases, files, datetime(2024, 1, 1)).select("o_orderkey")


@verify(f"""SELECT name FROM ({_FILES_SQL}) WHERE name NOT IN (
    SELECT o_orderpriority || '-' || o_orderstatus || '-' || l_orderkey || '.csv' FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity > 30)""")
def files_to_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 30)
    lines = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    name = F.concat("o_orderpriority", F.lit("-"), "o_orderstatus", F.lit("-"), "o_orderkey", F.lit(".csv"))
    there = lines.join(table(spark, sf_dir, "orders"), "o_orderkey").select(name.alias("name"))
    return not_present(_order_files(spark, sf_dir).select("name"), there)


# --- pages -------------------------------------------------------------------------------------------------
_PAGE_SQL = """
    SELECT page_id, replace(html, '</nav>', '<a class="f" href="/nppes/NPPES_Data_Dissemination_' || ['March', 'May', 'July'][page_id % 3 + 1] || '_20' || (10 + page_id % 15)
        || '_V2.zip">Monthly</a><A HREF=''https://example.org/csv/nucc_taxonomy_' || (page_id % 9) || '.csv?a=1&amp;b=2''> <b>Version</b> 2025_' || (page_id % 4) || ' </A></nav>') AS html
    FROM pages"""
_LINKS_SQL = f"""
    SELECT page_id, ord, replace(regexp_extract(anchor, '(?i)href\\s*=\\s*["'']([^"'']*)["'']', 1), '&amp;', '&') AS href,
           trim(replace(replace(replace(replace(replace(regexp_replace(anchor, '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS link_text
    FROM (SELECT page_id, unnest(a) AS anchor, generate_subscripts(a, 1) - 1 AS ord
          FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*\\bhref\\s*=[^>]*>.*?</a\\s*>') AS a FROM ({_PAGE_SQL})))"""


def _linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    month = F.element_at(F.array(F.lit("March"), F.lit("May"), F.lit("July")), (page % 3 + 1).cast("int"))
    nav = F.concat(
        F.lit('<a class="f" href="/nppes/NPPES_Data_Dissemination_'),
        month,
        F.lit("_20"),
        10 + page % 15,
        F.lit("_V2.zip\">Monthly</a><A HREF='https://example.org/csv/nucc_taxonomy_"),
        page % 9,
        F.lit(".csv?a=1&amp;b=2'> <b>Version</b> 2025_"),
        page % 4,
        F.lit(" </A></nav>"),
    )
    return table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("</nav>"), nav).alias("html"))


@verify(f"""SELECT page_id, CAST(ord AS INTEGER) AS ordinal, href, link_text FROM ({_LINKS_SQL})""")
def release_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page, from the whole page text."""
    return page_links(_linked_pages(spark, sf_dir))


@verify(f"""
    SELECT page_id, 'NPPES_Data' || split_part(href, 'NPPES_Data', 2) AS name, 'https://download.cms.gov' || href AS url,
           CAST(regexp_extract(href, '20\\d{{2}}') AS BIGINT) * 10000 + CASE WHEN contains(href, 'March') THEN 300 WHEN contains(href, 'May') THEN 500 ELSE 700 END AS score
    FROM ({_LINKS_SQL}) WHERE ends_with(href, '.zip')
""")
def registry_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_releases(page_links(_linked_pages(spark, sf_dir))).select("page_id", "name", "url", "score")


@verify(f"""
    SELECT page_id, name, url, priority FROM (
      SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY priority, ord) AS nth FROM (
        SELECT page_id, ord, split_part(href, '/', -1) AS name, CASE WHEN starts_with(href, '/') THEN 'https://www.nucc.org' || href
                 WHEN starts_with(href, 'http') THEN href ELSE 'https://www.nucc.org/' || href END AS url,
               CASE WHEN contains(lower(link_text), '2025_1') THEN 1 WHEN contains(lower(link_text), 'current') AND contains(lower(link_text), 'version') THEN 2
                    WHEN regexp_matches(lower(href), 'nucc.*taxonomy.*csv') THEN 3 END AS priority
        FROM ({_LINKS_SQL}) WHERE contains(lower(href), 'csv')) WHERE priority IS NOT NULL) WHERE nth = 1
""")
def code_set_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_set_link(page_links(_linked_pages(spark, sf_dir)), "2025.1")


# --- lineage and archives ----------------------------------------------------------------------------------
_EVENT_FILE = "event_type || '/' || user_id || CASE WHEN event_type IN ('click', 'purchase') THEN '.zip' WHEN event_type = 'view' THEN '.csv' ELSE '.xlsx' END"
_LINEAGE_FIXED = "'INBOUND' AS CODE_TRANSACTION_TYPE"


def _event_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    zipped = F.col("event_type").isin("click", "purchase")
    ext = F.when(zipped, ".zip").when(F.col("event_type") == "view", ".csv").otherwise(".xlsx")
    path = F.concat("event_type", F.lit("/"), "user_id", ext)
    events = table(spark, sf_dir, "events").withColumn("path", path)
    known = F.max(F.when(F.col("event_type") != "error", F.length("props"))).cast("bigint")
    files = events.groupBy("path").agg(
        F.substring_index(F.first("path"), "/", -1).alias("name"), known.alias("size"), F.max("ts").alias("modified")
    )
    kind = F.when(F.col("value") > 50, ".txt").otherwise(".csv")
    folder = F.when(F.col("value") < 1, F.lit("/")).otherwise(kind)
    members = events.where(zipped).select(
        "path",
        (F.col("event_id") + 1).cast("int").alias("ordinal"),
        F.concat(F.lit("in/"), "event_id", folder).alias("member"),
        F.length("props").cast("bigint").alias("size"),
    )
    return files, members


@verify(f"""
    WITH e AS (SELECT *, {_EVENT_FILE} AS path FROM events),
    f AS (SELECT path, max(CASE WHEN event_type <> 'error' THEN length(props) END) AS size, max(ts) AS modified FROM e GROUP BY path),
    p AS (SELECT *, 'MEDICAID_EVENTS_2024-03-01_7_' || row_number() OVER (ORDER BY path) AS id FROM f)
    SELECT id AS ID_TRANSACTION, NULL AS CHILD_ID_TRANSACTION, split_part(path, '/', 2) AS FILE_NAME, path AS FILE_PATH_FQN,
           CASE split_part(path, '.', 2) WHEN 'zip' THEN 'ZIP' WHEN 'csv' THEN 'CSV' ELSE 'EXCEL' END AS CODE_FILE_TYPE, {_LINEAGE_FIXED},
           strftime(modified, '%Y-%m-%d %H:%M:%S') AS DATE_INBOUND, 'EVENTS' AS SUBJECT_AREA, CAST(7 AS BIGINT) AS ID_BATCH, 'DAILY' AS CODE_FREQUENCY,
           coalesce(size || 'B', 'UNKNOWN') AS FILE_SIZE, 'ETL' AS UPDATED_BY
    FROM p
    UNION ALL
    SELECT id, CAST(event_id + 1 AS VARCHAR), event_id || ext, path || '/' || event_id || ext, CASE ext WHEN '.txt' THEN 'TEXT' ELSE 'CSV' END, 'INBOUND',
           strftime(modified, '%Y-%m-%d %H:%M:%S'), 'EVENTS', 7, 'DAILY', length(props) || 'B', 'ETL'
    FROM (SELECT *, CASE WHEN value > 50 THEN '.txt' ELSE '.csv' END AS ext FROM e WHERE event_type IN ('click', 'purchase') AND NOT value < 1) JOIN p USING (path)
""")
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per user and event type, archives with one member per event."""
    files, members = _event_files(spark, sf_dir)
    rows = lineage_rows(files, members, "MEDICAID", "EVENTS", 7, "2024-03-01")
    return rows.withColumn("DATE_INBOUND", F.date_format("DATE_INBOUND", "yyyy-MM-dd HH:mm:ss"))


@verify("""
    SELECT user_id AS path, min_by('npidata_pfile_' || event_id || '.csv', event_id) AS member
    FROM events WHERE event_type NOT IN ('error', 'view') AND value > 5 GROUP BY user_id
""")
def archive_member_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    member = (
        F.when(kind == "error", F.concat(F.lit("npidata_pfile_"), "event_id", F.lit("_fileHeader.csv")))
        .when(kind == "view", F.concat(F.lit("othername_pfile_"), "event_id", F.lit(".csv")))
        .when(F.col("value") > 5, F.concat(F.lit("npidata_pfile_"), "event_id", F.lit(".csv")))
        .otherwise(F.concat(F.lit("npidata_pfile_"), "event_id", F.lit(".pdf")))
    )
    members = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("path"), F.col("event_id").alias("ordinal"), member.alias("member")
    )
    return first_member(members, "npidata_pfile")


def _zip_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("docs/", "")
                archive.writestr(f"docs/text_{lang}.txt", text)
            out.append(buffer.getvalue())
        yield pd.DataFrame({"path": batch["path"], "content": out})


def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text", "lang")
    # packing is heavy for its few input splits
    return documents.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_zip_up, "path string, content binary")


@verify("""
    SELECT CAST(doc_id AS VARCHAR) AS path, 1 AS ordinal, 'docs/' AS member, CAST(0 AS BIGINT) AS size FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 2, 'docs/text_' || lang || '.txt', CAST(strlen(text) AS BIGINT) FROM documents
""")
def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document zipped, then the archives listed."""
    return list_members(_archives(spark, sf_dir))


@verify("""
    SELECT CAST(doc_id AS VARCHAR) AS path, CAST(n - 1 AS BIGINT) AS line_no,
           md5(line) AS line_md5
    FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n, len(l) AS total FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
    WHERE NOT (n = total AND line = '')
""")
def archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document zipped, then the archives inflated to lines."""
    return member_lines(_archives(spark, sf_dir)).select("path", "line_no", F.md5("value").alias("line_md5"))


# --- loads that write to the shared folder -------------------------------------------------------------------
def _text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as landed text: quotes, separators and line breaks inside the values."""
    odd = F.when(F.col("o_orderstatus") == "P", F.concat(F.col("o_orderpriority"), F.lit(',\n"x"'))).otherwise(F.col("o_orderpriority"))
    return _order_rows(spark, sf_dir).withColumn("o_orderpriority", odd)


_TEXT_SQL = f"""WITH {_ORDERS_CTE} SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'P' THEN pr || ',' || chr(10) || '"x"' ELSE pr END AS o_orderpriority, o_totalprice"""


def _land(df: DataFrame, label: str, **options: str) -> str:
    path = scratch(df.sparkSession, label)
    df.write.options(header="true", escape='"', **options).csv(path)
    return path


@verify(f"{_TEXT_SQL}, CAST(NULL AS VARCHAR) AS not_landed FROM r")
def csv_load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _text_orders(spark, sf_dir).withColumnsRenamed({"o_custkey": "O_CustKey", "o_totalprice": "O_TOTALPRICE"})
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "not_landed"]
    return csv_by_name(spark, _land(landed, "by-name"), names, multiline=True)


@verify(f"{_TEXT_SQL} FROM r")
def csv_load_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _text_orders(spark, sf_dir)
    path = _land(landed.toDF(*[f"Source {i}" for i in range(len(landed.columns))]), "by-position")
    return csv_positional(spark, path, landed.columns, multiline=True)


@verify("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def csv_load_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    read = csv_inferred(spark, _land(landed, "inferred"))
    return read.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderpriority")


@verify("""SELECT o_orderstatus AS file_set, count(*) AS actual_rows, o_orderstatus = 'P' AS multiline FROM orders GROUP BY 1""")
def csv_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical records of landed files, counted split by split; one kind of order has line breaks in its values."""
    rows = _text_orders(spark, sf_dir)
    path = scratch(spark, "counted")
    rows.withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").options(header="true", escape='"').csv(path)
    profile = csv_profile(spark, f"{path}/*/*.csv")
    folder = F.regexp_extract("path", "/status=([^/]+)/", 1)
    return profile.groupBy(folder.alias("file_set")).agg(
        F.sum("actual_rows").alias("actual_rows"), F.max("multiline").alias("multiline")
    )


@verify("""
    SELECT O_ORDERKEY, O_CUSTKEY, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS O_ORDERPRIORITY FROM (SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus, o_orderpriority FROM orders)
""")
def parquet_load_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files with other letter case and a missing column, appended by name."""
    orders, path = table(spark, sf_dir, "orders"), scratch(spark, "aligned")
    columns = ["O_ORDERKEY", "o_custkey", "o_orderpriority"]
    full = orders.where("o_orderstatus = 'O'").select(*columns)
    orders.where("o_orderstatus <> 'O'").select(*columns[:2]).write.parquet(path)
    added = parquet_into(spark, path, full.schema)
    return full.toDF(*added.columns[:3]).unionByName(added)


_ORDER_TARGET = TargetTable("ORDERS", ("o_orderkey",), ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))


@verify(f"""WITH {_ORDERS_CTE}, m AS ({_merge_sql(["o_orderkey"], list(_ORDER_TARGET.business))})
            SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS o_orderkey) FROM m""")
def gold_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches merged into a bucketed gold table through its published versions."""
    first, second = _changed_orders(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gold = GoldTable(spark, scratch(spark, "gold"), _ORDER_TARGET, buckets)
    for n, (batch, at) in enumerate(((first, datetime(2024, 1, 1)), (second, datetime(2024, 2, 1))), 1):
        rows = batch.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
        upsert(gold, rows, BatchStamp("ORDERS", "SALES", n, at))
    return _stats_text(gold.current())


def _buckets(rows: int) -> int:
    """A bucket is one task's to sort, so there are more of them for more rows."""
    return max(2, rows // 2_000_000)


@verify(f"""WITH {_ORDERS_CTE}, m AS ({_merge_sql(["o_orderkey"], list(_ORDER_TARGET.business))})
            SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS o_orderkey) FROM m""")
def gold_rebucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `gold_publish`, with three times the buckets after the first batch and the old versions removed at the end."""
    first, second = _changed_orders(spark, sf_dir)
    buckets = _buckets(table(spark, sf_dir, "orders").count())
    gold = GoldTable(spark, scratch(spark, "gold"), _ORDER_TARGET, buckets)
    for n, (batch, at) in enumerate(((first, datetime(2024, 1, 1)), (second, datetime(2024, 2, 1))), 1):
        rows = batch.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
        upsert(gold, rows, BatchStamp("ORDERS", "SALES", n, at))
        if n == 1:
            gold.rebucket(3 * buckets, n, at)
    gold.expire(keep=1)
    return _stats_text(gold.current())


_BATCH_SQL = """
    r AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
                 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders),
    g AS (SELECT * FROM r),
    s AS (SELECT * REPLACE ('X' AS o_orderstatus) FROM r WHERE CAST(o_orderkey AS BIGINT) % 997 = 1)"""


@verify(f"""WITH {_BATCH_SQL}, m AS ({_merge_sql(["o_orderkey"], list(_ORDER_TARGET.business))})
            SELECT *, true AS only_hit_buckets, count(*) OVER () AS in_manifest FROM m""")
def gold_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of a thousandth of the rows: it writes the buckets that it hits, all others are taken over by reference."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus")],
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        "o_orderpriority",
    )
    gold = GoldTable(spark, scratch(spark, "gold"), _ORDER_TARGET, 64)
    small = rows.where(F.col("o_orderkey").cast("bigint") % 997 == 1).withColumn("o_orderstatus", F.lit("X"))
    upsert(gold, rows, BatchStamp("ORDERS", "SALES", 1, datetime(2024, 1, 1)))
    upsert(gold, small, BatchStamp("ORDERS", "SALES", 2, datetime(2024, 2, 1)))
    head = gold.head()
    held = gold.manifest(head)
    written = {r["bucket"] for r in held if f"/v={head.version}/" in r["path"]}
    told = {"only_hit_buckets": F.lit(written == set(gold.touched(small, head))), "in_manifest": F.lit(sum(r["rows"] for r in held)).cast("bigint")}
    gold.expire(keep=1)
    return _stats_text(gold.current()).withColumns(told)


@verify("""
    SELECT 'ORDERS' AS table_name, CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS v, CAST(CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 1 END AS BIGINT) AS META_BATCH_ID FROM orders
    UNION ALL SELECT 'CUSTOMERS', CAST(c_custkey AS VARCHAR), c_mktsegment, 1 FROM customer
""")
def gold_batch_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches for two gold tables; the second one fails a stopping rule, so no row of it is in either table."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderstatus").alias("v"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"), F.col("c_mktsegment").alias("v"))
    lake = Lake(spark, scratch(spark, "commit"), 4)
    targets = [TargetTable("ORDERS", ("k",), ("v",)), TargetTable("CUSTOMERS", ("k",), ("v",))]
    config = ProgramConfig("ORDERS", "SALES", FileCriteria(), rule_group="G", bronze_table="BRONZE")
    rules = [Rule("segment", "G", 0, "GOLD_CUSTOMERS", "predicate", "v <> 'BROKEN'")]
    batches = [
        (orders.where("v <> 'P'"), customers),
        (orders.withColumn("v", F.lit("BAD")), customers.withColumn("v", F.lit("BROKEN"))),
        (orders.where("v = 'P'"), customers.limit(0)),
    ]
    for n, parts in enumerate(batches, 1):
        stamp = BatchStamp("ORDERS", "SALES", n, datetime(2024, 1, n))
        for target, rows in zip(targets, parts, strict=True):
            lake.silver(target.name).replace(stamp.put_on(rows), n)
        try:
            merge_checked(lake, config, orders, targets, stamp, rules, None)
        except RulesFailed:
            if n != 2:
                raise
    found = [lake.gold(t).current().select(F.lit(t.name).alias("table_name"), "k", "v", "META_BATCH_ID") for t in targets]
    return found[0].unionByName(found[1])


@verify("""
    SELECT o_orderkey, year(o_orderdate) AS META_BATCH_ID, CASE WHEN year(o_orderdate) = 1998 THEN 'replaced' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderstatus <> 'F'
""")
def replace_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch (a year) loaded three times, the last two times with other rows; the rest stays."""
    year = F.year("o_orderdate").cast("bigint")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", year.alias("META_BATCH_ID"))
    silver = BatchTable(spark, scratch(spark, "silver"))
    silver.replace(orders)
    again = orders.where((F.col("META_BATCH_ID") == 1998) & (F.col("o_orderstatus") != "F"))
    for _ in range(2):
        silver.replace(again.withColumn("o_orderstatus", F.lit("replaced")))
    return silver.read()


@verify(f"{_TEXT_SQL}, CAST(CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS BIGINT) AS META_BATCH_ID FROM r")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed in two lots and taken by three runs of the same stream; nothing is read twice."""
    rows = _text_orders(spark, sf_dir)
    root = scratch(spark, "ingest")
    lots = (rows.where("o_orderstatus <> 'O'"), rows.where("o_orderstatus = 'O'"), None)
    for n, lot in enumerate(lots, 1):
        if lot is not None:
            lot.write.mode("append").options(header="true", escape='"').csv(f"{root}/landing")
        stamp = BatchStamp("ORDERS", "SALES", n, datetime(2024, 1, n))
        stream = new_files(spark, f"{root}/landing", rows.columns, multiline=True)
        ingest_and_wait(stream, f"{root}/bronze", f"{root}/checkpoint", stamp)
    return spark.read.parquet(f"{root}/bronze").select(*rows.columns, F.col("META_BATCH_ID").cast("bigint"))


_TEMPLATE = """
-- sizes; each part falls in one bucket
CREATE OR REPLACE TEMPORARY VIEW {{target_table}} AS
SELECT p_partkey, p_size, CASE WHEN p_size > 25 THEN 'large; heavy' ELSE 'small' END AS bucket FROM {{source_table}};
SELECT p_partkey, bucket, '{program_name}' AS program, {audit_batch_id} AS batch_id FROM {{target_table}} WHERE p_size >= {smallest};
"""


@verify("""
    SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large; heavy' ELSE 'small' END AS bucket, 'O''Neil' AS program, 12 AS batch_id
    FROM part WHERE p_size >= 5
""")
def sql_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("template_source")
    objects = {"source_table": "template_source", "target_table": "template_target"}
    return run_sql(spark, _TEMPLATE, objects, {"program_name": "O'Neil", "audit_batch_id": 12, "smallest": 5})

