"""Wide-to-long reshaping in a single scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.functions.cleanse import keep_state, keep_ten_digits, zip5, zip_plus4
from carestrata.operators.predicates import has_text
from carestrata.settings import ADDRESS_COLUMNS, MAILING_ADDRESS, PRACTICE_ADDRESS


# Above this many cells the fused code of `stack` outgrows what the JVM compiles (8,000 bytecodes per method) and
# runs interpreted; picking from arrays is then twice as fast. Below it `stack` is faster.
STACK_CELLS = 128


def unpivot_rows(
    df: DataFrame, keys: Sequence[str], label_name: str, groups: dict[str, Sequence[str]], value_names: Sequence[str]
) -> DataFrame:
    """One output row per input row and group: keys, the group's label, its columns renamed to `value_names`.

    Rows are generated from one scan; a UNION ALL of branches would read the input once per group.
    """
    if len(groups) * len(value_names) <= STACK_CELLS:
        cells = [x for label, cols in groups.items() for x in (F.lit(label), *[F.col(c) for c in cols])]
        return df.select(*keys, F.stack(F.lit(len(groups)), *cells)).toDF(*keys, label_name, *value_names)
    by_name = [F.array(*[F.col(cols[j]) for cols in groups.values()]).alias(v) for j, v in enumerate(value_names)]
    at, labels = F.col("_slot"), F.array(*[F.lit(label) for label in groups])
    # the arrays are made below the generator, once per input row
    slots = df.select(*keys, *by_name).select("*", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))).alias("_slot"))
    return slots.select(*keys, F.get(labels, at).alias(label_name), *[F.get(v, at).alias(v) for v in value_names])


def unpivot_groups(
    df: DataFrame, keys: Sequence[str], stems: Sequence[str], slots: int, seq_name: str, required: str | None = None
) -> DataFrame:
    """Unpivot `stem_1 .. stem_n` column groups, keeping slots whose `required` stem (first by default) is set."""
    groups = {str(i): [f"{s}_{i}" for s in stems] for i in range(1, slots + 1)}
    return unpivot_rows(df, keys, seq_name, groups, stems).where(F.col(required or stems[0]).isNotNull())


def split_addresses(df: DataFrame, keys: Sequence[str], zip_mode: str = "positional") -> DataFrame:
    """Mailing ('M') and practice ('S') address as separate, cleansed rows; an address without line 1 gives none."""
    long = unpivot_rows(
        df, keys, "PROVIDER_ADDRESS_TYPE", {"M": MAILING_ADDRESS, "S": PRACTICE_ADDRESS}, MAILING_ADDRESS
    )
    line1, _, _, state, postal, _, phone, fax = MAILING_ADDRESS
    plus4 = ADDRESS_COLUMNS[5]
    clean = {
        state: keep_state(F.col(state)),
        plus4: zip_plus4(F.col(postal), zip_mode),
        postal: zip5(F.col(postal)),
        phone: keep_ten_digits(F.col(phone)),
        fax: keep_ten_digits(F.col(fax)),
    }
    return long.where(has_text(F.col(line1))).select(
        *keys,
        "PROVIDER_ADDRESS_TYPE",
        *[clean[c].alias(c) if c in clean else F.col(c) for c in ADDRESS_COLUMNS],
    )
