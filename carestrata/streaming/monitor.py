"""Landed file sets watched as a stream: the counts of sets are keyed state, and timers tell which sets are overdue."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from carestrata.operators.fileset import counted_criteria, in_view
from carestrata.settings import FileCriteria

ALERT_DDL = "file_set string, state string, found_total bigint, seen bigint"
#: Of a shard: its sets, and of each set in turn seen, fired, deadline, alerted and the counts.
_STATE_DDL = "sets array<string>, numbers array<bigint>"
_NEVER = -1
#: No deadline ahead, one ahead, told that it has passed.
_IDLE, _ARMED, _TOLD = 0, 1, 2
SHARDS = 4096


def watch_sets(
    arrivals: DataFrame, criteria: FileCriteria, key: str, name: str, at: str, patience: str, lateness: str = "1 minute", change: str | None = None
) -> DataFrame:
    """Alerts of a stream of arrived files: COMPLETE once a set is, OVERDUE once a set is not `patience` after its first file.

    A set is complete if every counting criterion is met exactly and the extension count at least. It is told once for a
    count; when the count changes the set is armed again. OVERDUE is told once a set, when the watermark (newest `at`
    less `lateness`) passes its deadline. A file whose `at` is not after the watermark is left out by
    Spark: let `at` be the time of the listing, or `lateness` what the landing can be late and more than nothing, since
    else a file as old as the newest one of an earlier run is left out. `change` is a column of 1 for a file that came and -1 for one
    that was taken away; each is one row. Sets are judged once a micro-batch. A NULL set is a set like others, a NULL
    name meets no criterion, and a NULL time sets no deadline. State is a few numbers a set. A call of Python takes longer than
    the judging of a thousand sets, so sets are dealt into `SHARDS` by a hash of their keys, and a shard is one key of the
    stream's state, with a timer for the earliest of its sets' deadlines. A checkpoint holds for one number of shards.
    """
    flags = counted_criteria(criteria, F.col(name))
    weight = F.col(change).cast("bigint") if change else F.lit(1).cast("bigint")

    def weighed(condition):
        return F.when(F.coalesce(condition, F.lit(False)), weight).otherwise(0)

    file_set = F.col(key).cast("string")
    deadline_ms = F.unix_millis(F.col(at) + F.expr(f"INTERVAL {patience}"))
    rows = arrivals.withWatermark(at, lateness).select(
        F.pmod(F.xxhash64(file_set), F.lit(SHARDS)).alias("_shard"),
        file_set.alias("file_set"),
        F.col(at),
        F.array(deadline_ms, weighed(in_view(criteria, F.col(name))), *[weighed(c) for c in flags.values()]).alias("_file"),
    )
    wanted = [c.count for c in criteria.counting().values()]
    least = criteria.extension.count

    def judge(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        width, sets = 4 + len(wanted), {}
        if state.exists:
            names, numbers = state.get
            sets = {s: list(numbers[i * width : (i + 1) * width]) for i, s in enumerate(names)}
        mark = state.getCurrentWatermarkMs()
        # a set is judged if files came, or if its deadline has passed and not been looked at since
        before = {s: sum(held[4:]) for s, held in sets.items() if held[3] == _ARMED and held[2] < mark}
        for part in () if state.hasTimedOut else parts:
            for s, (due, in_sight, *more) in zip(part["file_set"].tolist(), part["_file"].tolist(), strict=True):
                held = sets.setdefault(s, [0, _NEVER, None, _IDLE, *[0] * len(wanted)])
                before.setdefault(s, sum(held[4:]))
                held[0] += int(in_sight)
                for i, n in enumerate(more, 4):
                    held[i] += int(n)
                if due is not None and due == due:
                    held[2] = int(due) if held[2] is None else min(int(due), held[2])
        told = []
        for s, found_before in before.items():
            seen, fired, deadline, alert, *counts = sets[s]
            complete, found = counts == wanted and seen >= least, sum(counts)
            if found != found_before:
                fired = _NEVER
            if complete and fired != found:
                told.append((s, "COMPLETE", found, seen))
                fired = found
            overdue = deadline is not None and deadline <= mark
            if overdue and not complete and alert != _TOLD:
                told.append((s, "OVERDUE", found, seen))
                alert = _TOLD
            if alert != _TOLD:
                alert = _ARMED if deadline is not None and not overdue else _IDLE
            sets[s][1], sets[s][3] = fired, alert
        state.update((list(sets), [n for held in sets.values() for n in held]))
        armed = [held[2] for held in sets.values() if held[3] == _ARMED]
        if armed:
            state.setTimeoutTimestamp(max(min(armed), mark + 1))
        if told:
            yield pd.DataFrame(told, columns=["file_set", "state", "found_total", "seen"])

    return rows.groupBy("_shard").applyInPandasWithState(judge, ALERT_DDL, _STATE_DDL, "append", GroupStateTimeout.EventTimeTimeout)
