"""The pipelines as plain functions any scheduler can call."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.cleanse import rating_category
from carestrata.functions.filenames import clean_file_name
from carestrata.functions.releases import monthly_score, weekly_score
from carestrata.operators.audit import AUDIT_SCHEMA, audit_row, claim_batch_id, may_start
from carestrata.operators.fileset import set_completeness
from carestrata.operators.lineage import LINEAGE_COLUMNS, lineage_rows
from carestrata.operators.merge import BatchStamp
from carestrata.operators.predicates import all_present, file_matches
from carestrata.operators.rules import Rule, latest_result, route_alerts, run_log, run_rules
from carestrata.operators.validate import (
    check_against_metadata,
    check_row_counts,
    check_schemas,
    control_rows,
    require_passed,
)
from carestrata.plans import silver
from carestrata.plans.gold import staged_upsert
from carestrata.plans.history import StoredHistory
from carestrata.plans.tables import DEFAULT_BUCKETS, BatchTable, GoldTable, LogTable, commit, truncate_load
from carestrata.settings import (
    CODE_SET_COLUMNS,
    CODE_SET_TABLE,
    META_SCHEMA,
    PROVIDER_TABLES,
    REGISTRY_COLUMNS,
    ProgramConfig,
    TargetTable,
)
from carestrata.sources.delimited import (
    bind_by_name,
    csv_by_name,
    csv_headers,
    csv_positional,
    csv_profile,
    csv_strings,
    csv_to_parquet,
    metadata_map,
    profiled_headers,
)
from carestrata.sources.files import (
    archive_members,
    extract_archives,
    file_inventory,
    finish_moves,
    first_member,
    not_present,
    put_away,
)

_LINEAGE_TYPES = {"DATE_INBOUND": "timestamp", "ID_BATCH": "bigint"}
LINEAGE_DDL = ", ".join(f"{c} {_LINEAGE_TYPES.get(c, 'string')}" for c in LINEAGE_COLUMNS)
CONTROL_DDL = "TABLE_NAME string, ROW_COUNT bigint, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in META_SCHEMA
)
_COUNTS = ["N_FAILED_SYNTAX_COUNT", *[f"N_FAILED_SEVERITY_{s}" for s in range(4)]]
RUN_LOG_DDL = "RULE_GROUP string, ID_BATCH string, DATE_METRIC string, CODE_LOG_TYPE string, " + ", ".join(
    f"{c} bigint" for c in _COUNTS
)


class NotReady(RuntimeError):
    pass


class RulesFailed(RuntimeError):
    pass


@dataclass
class Lake:
    """All tables of one deployment below one folder."""

    spark: SparkSession
    root: str
    buckets: int = DEFAULT_BUCKETS

    def bronze(self, name: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/bronze/{name}")

    def silver(self, name: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/silver/{name}")

    def gold(self, target: TargetTable) -> GoldTable:
        return GoldTable(self.spark, f"{self.root}/gold", target, self.buckets)

    def history(self, target: TargetTable) -> StoredHistory:
        return StoredHistory(self.spark, f"{self.root}/history", target, self.buckets)

    @property
    def audit(self) -> LogTable:
        return LogTable(self.spark, f"{self.root}/log/audit", AUDIT_SCHEMA)

    @property
    def lineage(self) -> LogTable:
        return LogTable(self.spark, f"{self.root}/log/lineage", LINEAGE_DDL)

    @property
    def control(self) -> LogTable:
        return LogTable(self.spark, f"{self.root}/log/control", CONTROL_DDL)

    @property
    def moves(self) -> str:
        return f"{self.root}/log/moves"

    @property
    def run_log(self) -> LogTable:
        return LogTable(self.spark, f"{self.root}/log/rules", RUN_LOG_DDL)


@contextmanager
def audited_batch(lake: Lake, config: ProgramConfig, at: datetime) -> Iterator[BatchStamp]:
    """Opens a batch under an id of its own and closes it as COMPLETED or FAILED. Moves that an earlier job left open are
    finished first."""
    finish_moves(lake.spark, lake.moves)
    batch_id = claim_batch_id(lake.spark, f"{lake.root}/log/claims", lake.audit.read(), config.program, config.subject)

    def record(status: str) -> None:
        lake.audit.append(audit_row(lake.spark, batch_id, config.program, config.subject, status, at))

    record("IN_PROGRESS")
    try:
        yield BatchStamp(config.program, config.subject, batch_id, at)
    except Exception:
        record("FAILED")
        raise
    record("COMPLETED")


def require_complete(files: DataFrame, config: ProgramConfig, at_least: bool = False) -> dict:
    state = set_completeness(files, config.criteria).first().asDict()
    if not may_start(state, at_least):
        raise NotReady(f"{config.subject}: {state['state']}, {state['found_total']}/{state['expected_total']} files")
    return state


def record_lineage(lake: Lake, folder: str, config: ProgramConfig, stamp: BatchStamp, any_name: bool = False) -> None:
    """Lineage of the files below a folder that fit the program's criteria, or of all with `any_name`."""
    files, members = file_inventory(lake.spark, folder), archive_members(lake.spark, folder)
    if not any_name:
        files = files.where(file_matches(config.criteria, F.col("name")))
        members = members.where(file_matches(config.criteria, F.substring_index("path", "/", -1)))
    day = stamp.as_of.date().isoformat()
    lake.lineage.append(lineage_rows(files, members, stamp.program, stamp.subject, stamp.batch_id, day))


def apply_rules(
    lake: Lake, tables: dict[str, DataFrame], rules: Sequence[Rule], config: ProgramConfig, stamp: BatchStamp
) -> DataFrame | None:
    """Run the configured rules, keep the run log, return the alert rows; a stopping alert fails the job, and so does a
    rule for a table the job does not have."""
    mine = [r for r in rules if r.rule_group == config.rule_group]
    if not mine:
        return None
    day = stamp.as_of.date().isoformat()
    results = run_rules(tables, mine, config.rule_group, config.rule_id)
    lake.run_log.append(run_log(results, stamp.batch_id, day))
    logged = latest_result(lake.run_log.read(), stamp.batch_id, day, config.rule_group)
    alerts = route_alerts(logged)
    stops = [r["cause"] for r in alerts.where("stops_run").select("cause").distinct().collect()]
    if stops:
        raise RulesFailed(f"{config.subject} batch {stamp.batch_id}: {', '.join(sorted(stops))}")
    return alerts


def _load_wide(lake: Lake, path: str, names: Sequence[str], table: str, stamp: BatchStamp) -> DataFrame | None:
    """Positional bronze load; None for a file without records. The count pass decides whether the file can be read
    split by split."""
    profile = csv_profile(lake.spark, path).select(F.max("multiline").alias("multiline"), F.sum("actual_rows").alias("n"))
    seen = profile.first()
    rows = csv_positional(lake.spark, path, names, bool(seen["multiline"]))
    if not seen["n"]:
        lake.bronze(table).drop_batch(stamp.batch_id)
        return None
    lake.bronze(table).replace(stamp.put_on_with_id(rows), stamp.batch_id)
    return lake.bronze(table).read(stamp.batch_id)


def _side_by_side(work: Callable, items: Sequence) -> list:
    """Independent tables of one batch, submitted together so that small ones do not leave the cluster idle."""
    with ThreadPool(max(1, min(len(items), 16))) as pool:
        return pool.map(work, items, chunksize=1)


def _build_silver(lake: Lake, names: Sequence[str], bronze: DataFrame, stamp: BatchStamp) -> None:
    """All silver tables of a batch, or none of them."""
    try:
        _side_by_side(lambda name: lake.silver(name).replace(silver.build(name, bronze, stamp), stamp.batch_id), names)
    except Exception:
        for name in names:
            lake.silver(name).drop_batch(stamp.batch_id)
        raise


def merge_checked(
    lake: Lake,
    config: ProgramConfig,
    bronze: DataFrame,
    targets: Sequence[TargetTable],
    stamp: BatchStamp,
    rules: Sequence[Rule],
    also: Callable[[BatchStamp], None] | None,
    **options,
) -> dict[str, dict]:
    """Write a new version of each gold table, check the rules on them, and only then make all of them current.

    Rules may name the bronze table, each silver table's batch and each gold table as it will be (`GOLD_<name>`). A merge
    or a stopping rule that fails leaves all gold tables as they were.
    """

    def merge(target: TargetTable) -> tuple:
        return staged_upsert(lake.gold(target), lake.silver(target.name).read(stamp.batch_id), stamp, **options)

    done = dict(zip([t.name for t in targets], _side_by_side(merge, targets), strict=True))
    tables = {config.bronze_table: bronze}
    for target in targets:
        tables[target.name] = lake.silver(target.name).read(stamp.batch_id)
        tables[f"GOLD_{target.name}"] = lake.gold(target).at(done[target.name][0])
    apply_rules(lake, tables, rules, config, stamp)
    if also:
        also(stamp)
    commit(lake.spark, f"{lake.root}/gold", {name: head for name, (head, _) in done.items()}, stamp.batch_id, stamp.as_of)
    return {name: counts for name, (_, counts) in done.items()}


def registry_job(
    lake: Lake,
    path: str,
    config: ProgramConfig,
    at: datetime,
    rules: Sequence[Rule] = (),
    names: Sequence[str] = REGISTRY_COLUMNS,
    also: Callable[[BatchStamp], None] | None = None,
) -> dict:
    """Provider registry file -> bronze -> five silver tables -> five gold tables -> rules -> all current at once. `also` runs before that."""
    with audited_batch(lake, config, at) as stamp:
        bronze = _load_wide(lake, path, names, config.bronze_table, stamp)
        if bronze is None:
            if also:
                also(stamp)
            return {"status": "no_data", "batch_id": stamp.batch_id}
        _build_silver(lake, list(PROVIDER_TABLES), bronze, stamp)

        gold = merge_checked(lake, config, bronze, list(PROVIDER_TABLES.values()), stamp, rules, also)
        return {"status": "completed", "batch_id": stamp.batch_id, "gold": gold}


def code_set_job(
    lake: Lake,
    path: str,
    config: ProgramConfig,
    at: datetime,
    rules: Sequence[Rule] = (),
    names: Sequence[str] = CODE_SET_COLUMNS,
    also: Callable[[BatchStamp], None] | None = None,
) -> dict:
    """Taxonomy code file -> bronze -> silver -> gold with pipe-separated fingerprints -> rules."""
    with audited_batch(lake, config, at) as stamp:
        bronze = _load_wide(lake, path, names, config.bronze_table, stamp)
        if bronze is None:
            if also:
                also(stamp)
            return {"status": "no_data", "batch_id": stamp.batch_id}
        _build_silver(lake, [CODE_SET_TABLE.name], bronze, stamp)
        gold = merge_checked(lake, config, bronze, [CODE_SET_TABLE], stamp, rules, also, sep="|", null_keys="drop")
        return {"status": "completed", "batch_id": stamp.batch_id, "gold": gold}


def history_job(lake: Lake, source: DataFrame, target: TargetTable, config: ProgramConfig, day: str, at: datetime) -> dict:
    """What a source tells of its day -> the stored history of a table. Batches may come late, and again."""
    with audited_batch(lake, config, at) as stamp:
        counts = lake.history(target).take(source, day, stamp)
        return {"status": "completed" if counts["rows"] else "no_data", "batch_id": stamp.batch_id, "history": counts}


def release_job(
    lake: Lake,
    landing: str,
    config: ProgramConfig,
    at: datetime,
    job: Callable[..., dict],
    stem: str,
    archive: str | None = None,
    **options,
) -> dict:
    """The newest landed release archive that no batch has taken -> its data file -> `job` -> archive put away.

    `job` is `registry_job` or `code_set_job`; `stem` starts the data file's name. Releases are ranked by the period or
    month in their names, and an archive counts as taken if a completed batch has its lineage.
    """
    spark = lake.spark
    mine = (F.col("PROGRAM_NAME") == config.program) & (F.col("CODE_LOAD_STATUS") == "COMPLETED")
    whole = lake.audit.read().where(mine).select("SUBJECT_AREA", "ID_BATCH")
    lineage = lake.lineage.read().where(F.col("SUBJECT_AREA") == config.subject).withColumn("ID_BATCH", F.col("ID_BATCH").cast("string"))
    taken = lineage.join(whole, ["SUBJECT_AREA", "ID_BATCH"], "left_semi").select(F.col("FILE_NAME").alias("name"))
    fresh = not_present(file_inventory(spark, landing, "*.[zZ][iI][pP]"), taken)
    score = F.coalesce(weekly_score(F.col("name")), monthly_score(F.col("name")), F.lit(0).cast("bigint"))
    best = fresh.agg(F.max_by(F.struct("path", "name"), F.struct(score, "name")).alias("b")).first()["b"]
    if best is None:
        return {"status": "no_new_release"}
    member = first_member(archive_members(spark, best["path"]), stem).first()
    if member is None:
        raise NotReady(f"{config.subject}: {best['name']} has no {stem} data file")
    load = f"{lake.root}/load/{config.subject}/release={best['name']}"
    extract_archives(spark, best["path"], load, wanted=f"^{re.escape(member['member'])}$")
    name = F.element_at(F.split("path", "/file_name="), -1)
    files = file_inventory(spark, load, "*.txt").select(F.url_decode(F.substring_index(name, "/", 1)).alias("name"), "path")
    require_complete(files, config)
    done = job(lake, files.first()["path"], config, at, also=lambda stamp: record_lineage(lake, best["path"], config, stamp, any_name=True), **options)
    if archive:
        done["archived"] = put_away(spark, best["path"], archive, lake.moves)
    return {**done, "release": best["name"]}


def program_job(
    lake: Lake,
    landing: str,
    config: ProgramConfig,
    at: datetime,
    registry: DataFrame | None = None,
    rules: Sequence[Rule] = (),
    at_least: bool = False,
    archive: str | None = None,
) -> dict:
    """Landed program files -> lineage -> extraction -> control counts and schemas -> one bronze table per file -> rules.

    With `archive`, the files of a completed batch are put away into a folder of that batch.
    """
    spark = lake.spark
    landed = file_inventory(spark, landing).withColumn("clean_name", clean_file_name(F.col("name")))
    landed = landed.where(file_matches(config.criteria, F.col("name")))
    require_complete(landed, config, at_least)
    with audited_batch(lake, config, at) as stamp:
        record_lineage(lake, landing, config, stamp)
        load = f"{lake.root}/load/{config.subject}/batch={stamp.batch_id}"
        extract_archives(spark, landing, load, config.criteria)
        sources = _load_sources(spark, landed, load)
        if config.control_file:
            control = csv_by_name(spark, sources.pop(config.control_file), ["TABLE_NAME", "ROW_COUNT"], case_sensitive=True)
            lake.control.append(stamp.put_on(control.withColumn("ROW_COUNT", F.col("ROW_COUNT").cast("bigint"))))
        # the profile is one small row per file
        files = [path for paths in sources.values() for path in paths]
        profile = csv_profile(spark, files)
        seen = profile.collect()
        profile = spark.createDataFrame(seen, profile.schema)
        table = F.regexp_replace(clean_file_name(F.col("file_name")), r"(?i)\.csv\z", "")
        counts = profile.groupBy(table.alias("TABLE_NAME")).agg(
            F.sum("actual_rows").alias("actual_rows"), F.max("multiline").alias("multiline")
        )
        rows = counts.collect()
        counts = spark.createDataFrame(rows, counts.schema)
        expected = control_rows(lake.control.read(), stamp.batch_id, stamp.program, stamp.subject)
        require_passed(check_row_counts(expected, counts), "Row count validation", "table_name")
        if registry is not None:
            headers = profiled_headers(profile.withColumn("TABLE_NAME", table))
            headers = headers.select(F.col("TABLE_NAME").alias("object_name"), "actual").distinct()
            require_passed(check_schemas(headers, registry), "Schema validation", "object_name")
        multiline = {r["TABLE_NAME"]: r["multiline"] for r in rows}
        filled = {r["TABLE_NAME"]: r["actual_rows"] for r in rows}

        def load_one(item: tuple[str, list[str]]) -> tuple[str, DataFrame]:
            name, paths = item[0][: -len(".csv")], item[1]
            parts = [csv_strings(spark, p, multiline.get(name, True)) for p in paths]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            loaded = stamp.put_on_with_id(rows)
            lake.bronze(name).replace(loaded, stamp.batch_id)
            return name, lake.bronze(name).read(stamp.batch_id) if filled.get(name) else loaded

        try:
            tables = dict(_side_by_side(load_one, list(sources.items())))
        except Exception:
            for name in sources:
                lake.bronze(name[: -len(".csv")]).drop_batch(stamp.batch_id)
            raise
        apply_rules(lake, tables, rules, config, stamp)
    done = {"status": "completed", "batch_id": stamp.batch_id, "rows": filled}
    if archive:
        paths = sorted(r["path"] for r in landed.select("path").collect())
        done["archived"] = [put_away(spark, p, f"{archive}/batch={stamp.batch_id}", lake.moves) for p in paths]
    return done


def _load_sources(spark: SparkSession, landed: DataFrame, load: str) -> dict[str, list[str]]:
    """Cleaned file name -> all paths that go by it, over landed CSV files and extracted members, one path a member; a
    set has a handful of files."""
    csv = F.lower("clean_name").endswith(".csv")
    found = [(r["clean_name"], r["path"]) for r in landed.where(csv).select("clean_name", "path").collect()]
    member = F.regexp_extract("path", r"/file_name=([^/]+)/", 1)
    folder = F.regexp_extract("path", r"/(file_name=[^/]+/member=[^/]+)/", 1)
    inside = file_inventory(spark, load, "*.txt").select(F.url_decode(member).alias("n"), folder.alias("f")).distinct()
    found += [(r["n"], f"{load}/{r['f']}") for r in inside.where(F.lower("n").endswith(".csv")).collect()]
    sources: dict[str, list[str]] = {}
    for name, path in sorted(found):
        sources.setdefault(name, []).append(path)
    return sources


def claims_job(spark: SparkSession, files: Sequence[str], metadata: str, parquet: str, database: str = "default") -> dict:
    """Claims files -> Parquet copies -> all-text tables, for the files whose header matches the description file."""
    names = [p.rstrip("/").rsplit("/", 1)[-1] for p in files]
    if len(set(names)) < len(names):
        raise ValueError(f"two files have one name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    csv_to_parquet(spark, files, parquet)
    checked = check_against_metadata(csv_headers(spark, files, naive=True), metadata_map(spark, metadata))
    outcome = {r["file_name"]: (r["status"], r["actual"]) for r in checked.collect()}
    for path in files:
        file_name = path.rstrip("/").rsplit("/", 1)[-1]
        status, columns = outcome[file_name]
        if status == "PASSED":
            stem = file_name.rsplit(".", 1)[0]
            truncate_load(bind_by_name(spark.read.parquet(f"{parquet}/{stem}.parquet"), columns), f"{database}.{stem}")
    return {
        "passed": sorted(n for n, (s, _) in outcome.items() if s == "PASSED"),
        "failed": sorted(n for n, (s, _) in outcome.items() if s != "PASSED"),
    }


def rating_job(spark: SparkSession, source: str, target: str, at: datetime) -> DataFrame:
    """Rated rows with their category, replacing the target table."""
    rated = spark.table(source).where(all_present("RATING", "STATE"))
    report = rated.select(
        "STATE",
        "COFFEE_SHOP",
        "RATING",
        rating_category(F.col("RATING")).alias("RATING_CATEGORY"),
        F.lit(at).alias("PROCESSED_AT"),
    )
    truncate_load(report, target)
    return spark.table(target)
