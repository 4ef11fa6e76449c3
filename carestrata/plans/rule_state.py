"""Data-quality results kept by batch: what is new is checked, the totals of the table are merged from what was kept."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.operators.rules import RESULT_COLUMNS, Rule, run_rules
from carestrata.plans.tables import BatchTable

STATE_DDL = (
    "rule string, batch_id bigint, content string, columns string, n_rows bigint, n_failed bigint, syntax boolean, "
    "n_distinct bigint, keys string, at bigint"
)


def _digest(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


class RuleState:
    """Counts of each rule for each batch of one table, and the distinct keys of each batch for duplicate rules.

    `update` checks the batches that are new, replaced or taken out since, for each rule as it is defined now, and gives
    what `run_rules` gives for the whole table. A batch is known by the names of its files, so one that was written again
    is seen by itself. Every result is one line of a log, the last of a rule and batch holds; a lost run leaves lines that
    are whole or none, and the next one goes on. The driver sees one line for each rule and batch.

    Repeated keys are exact: a batch's keys are looked up among the key columns kept for other batches, and change the
    number of distinct keys by those that no other batch has. Rows of earlier batches are not read again. NULL keys are
    equal to each other, as in `run_rules`. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def update(self, table: BatchTable, rules: Sequence[Rule]) -> DataFrame:
        """Check what is outstanding; one row per rule for the whole table. All rules are about this table."""
        names = {r.table_name for r in rules}
        if len(names) != 1:
            raise ValueError(f"rules of one table are wanted, not of {sorted(names)}")
        present, known = table.contents(), self._known()
        columns = _digest([(f.name, f.dataType.simpleString()) for f in table.read().schema]) if present else ""
        for batch_id in sorted({*present, *(b for _, b in known)}):
            due = [r for r in rules if self._is_due(known.get((rule_digest(r), batch_id)), present.get(batch_id), columns)]
            if due:
                known |= self._check(table, due, batch_id, present.get(batch_id), columns, known)
        return self._totals(rules, known, set(present))

    def checked(self) -> DataFrame:
        """All lines of the log."""
        try:
            return self.spark.read.schema(STATE_DDL).json(f"{self.root}/log")
        except AnalysisException:
            return self.spark.createDataFrame([], STATE_DDL)

    def _known(self) -> dict[tuple[str, int], Row]:
        line = F.struct(*self.checked().columns)
        last = self.checked().groupBy("rule", "batch_id").agg(F.max_by(line, "at").alias("line"))
        return {(r["rule"], r["batch_id"]): r["line"] for r in last.collect()}

    def _is_due(self, line: Row | None, content: str | None, columns: str) -> bool:
        if line is None:
            return content is not None
        if line["content"] != content:
            return True
        return line["syntax"] and line["columns"] != columns  # a column has come that the rule may have missed

    def _check(self, table: BatchTable, due: list[Rule], batch_id: int, content: str | None, columns: str, known: dict) -> dict:
        """Check one batch and log it; the lines as they are known from now on."""
        name = due[0].table_name
        rows = table.read(batch_id) if content is not None else None
        lines = []

        def add(rule: Rule, n_rows: int, n_failed: int, syntax: bool, n_distinct: int, keys: str | None) -> None:
            lines.append((rule_digest(rule), batch_id, content, columns, n_rows, n_failed, syntax, n_distinct, keys, time.time_ns()))

        by_row = [r for r in due if r.kind != "duplicate"]
        if by_row and rows is not None:
            results = {r["rule_id"]: r for r in run_rules({name: rows}, by_row).collect()}
            for rule in by_row:
                found = results[rule.rule_id]
                add(rule, found["n_rows"], found["n_failed"], found["status"] == "SYNTAX", 0, None)
        for rule in by_row if rows is None else []:
            add(rule, 0, 0, False, 0, None)
        for rule in (r for r in due if r.kind == "duplicate"):
            if rows is not None and (not rule.keys or any(k not in rows.columns for k in rule.keys)):
                add(rule, rows.count(), 0, True, 0, None)
            else:
                add(rule, *self._keys(rule, rows, batch_id, known))
        self.spark.createDataFrame(lines, STATE_DDL).coalesce(1).write.mode("append").json(f"{self.root}/log")
        fields = [f.name for f in T.StructType.fromDDL(STATE_DDL)]
        return {(line[0], batch_id): Row(**dict(zip(fields, line, strict=True))) for line in lines}

    def _keys(self, rule: Rule, rows: DataFrame | None, batch_id: int, known: dict) -> tuple:
        """Keep a batch's keys; by how many keys it makes the table richer, with what it added before."""
        digest = rule_digest(rule)
        old = known.get((digest, batch_id))
        before = old["n_distinct"] if old else 0
        others = [r["keys"] for (d, b), r in known.items() if d == digest and b != batch_id and r["keys"]]
        path, n_rows, sides = None, 0, []
        if rows is not None:
            path = f"{self.root}/keys/{digest}/batch={batch_id}-{uuid.uuid4().hex}"
            rows.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("_rows")).write.parquet(path)
            kept = self.spark.read.parquet(path)
            n_rows = kept.agg(F.sum("_rows")).first()[0] or 0
            sides.append(kept.select(*rule.keys, F.lit(1).alias("_side")))
        if old and old["keys"]:
            sides.append(self.spark.read.parquet(old["keys"]).select(*rule.keys, F.lit(-1).alias("_side")))
        if not sides:
            return n_rows, 0, False, before, path
        changed = reduce(DataFrame.unionByName, sides)
        if len(sides) > 1:
            changed = changed.groupBy(*rule.keys).agg(F.sum("_side").alias("_side")).where("_side <> 0")
        if others:
            elsewhere = self.spark.read.parquet(*others).select(*[F.col(k).alias(f"o_{k}") for k in rule.keys])
            on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in rule.keys])
            changed = changed.join(elsewhere, on, "left_anti")
        return n_rows, 0, False, before + (changed.agg(F.sum("_side")).first()[0] or 0), path

    def _totals(self, rules: Iterable[Rule], known: dict, present: set[int]) -> DataFrame:
        out = []
        for rule in rules:
            mine = [r for (d, _), r in known.items() if d == rule_digest(rule)]
            n_rows = sum(r["n_rows"] for r in mine if r["batch_id"] in present)
            failed = n_rows - sum(r["n_distinct"] for r in mine) if rule.kind == "duplicate" else sum(r["n_failed"] for r in mine if r["batch_id"] in present)
            syntax = any(r["syntax"] for r in mine if r["batch_id"] in present)
            status = "SYNTAX" if syntax else "FAILED" if failed else "PASSED"
            out.append((rule.rule_id, rule.rule_group, rule.severity, rule.table_name, rule.kind, n_rows, 0 if syntax else failed, status))
        types = ("string", "string", "int", "string", "string", "bigint", "bigint", "string")
        return self.spark.createDataFrame(out, ", ".join(f"{c} {t}" for c, t in zip(RESULT_COLUMNS, types, strict=True)))


def rule_digest(rule: Rule) -> str:
    """What a rule's counts depend on; severity and group may change without a new check."""
    return _digest(rule.table_name, rule.kind, rule.expression, rule.keys)
