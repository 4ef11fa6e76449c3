"""Silver tables of the provider registry and the taxonomy code set, each from one narrow bronze scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.functions.cleanse import active_flag, blank_to, display_name, keep_ten_digits, open_end
from carestrata.operators.merge import BatchStamp
from carestrata.operators.reshape import split_addresses, unpivot_groups
from carestrata.settings import (
    CODE_SET_TABLE,
    MAILING_ADDRESS,
    OTHER_ID_SLOTS,
    OTHER_ID_STEMS,
    PROVIDER_TABLES,
    TAXONOMY_SLOTS,
)


def provider(bronze: DataFrame) -> DataFrame:
    target = PROVIDER_TABLES["PROVIDER_NPI"]
    name = [F.col(f"PROVIDER_{part}_NAME") for part in ("LAST", "FIRST", "MIDDLE", "ORGANIZATION")]
    clean = {
        "PROVIDER_ORGANIZATION_NAME": display_name(F.col("ENTITY_TYPE_CODE"), *name),
        **{
            c: keep_ten_digits(F.col(c))
            for c in (*MAILING_ADDRESS[6:8], "AUTHORIZED_OFFICIAL_TELEPHONE_NUMBER")
        },
    }
    columns = [clean[c].alias(c) if c in clean else F.col(c) for c in target.business]
    return bronze.where(F.col("NPI").isNotNull()).select("NPI", *columns)


def addresses(bronze: DataFrame, zip_mode: str = "positional") -> DataFrame:
    return split_addresses(bronze.where(F.col("NPI").isNotNull()), ["NPI"], zip_mode)


def taxonomies(bronze: DataFrame) -> DataFrame:
    target = PROVIDER_TABLES["PROVIDER_NPI_TAXONOMY"]
    rows = bronze.where(F.col("NPI").isNotNull())
    return unpivot_groups(rows, ["NPI"], target.business, TAXONOMY_SLOTS, target.keys[1])


def other_ids(bronze: DataFrame) -> DataFrame:
    target = PROVIDER_TABLES["PROVIDER_NPI_OTHER_IDS"]
    rows = bronze.where(F.col("NPI").isNotNull())
    return unpivot_groups(rows, ["NPI"], OTHER_ID_STEMS, OTHER_ID_SLOTS, target.keys[1])


def cross_reference(bronze: DataFrame) -> DataFrame:
    end = F.col("NPI_DEACTIVATION_DATE")
    return bronze.where(F.col("NPI").isNotNull()).select(
        "NPI",
        F.col("NPI").alias("PROVIDER_ID"),
        "PROVIDER_ENUMERATION_DATE",
        open_end(end).alias("NPI_DEACTIVATION_DATE"),
        active_flag(end).alias("IS_NPI_ACTIVE"),
    )


def code_set(bronze: DataFrame) -> DataFrame:
    business = [c for c in CODE_SET_TABLE.business if c != "DISPLAY_NAME"]
    return bronze.select("CODE", *business, blank_to(F.col("DISPLAY_NAME")).alias("DISPLAY_NAME")).select(
        *CODE_SET_TABLE.keys, *CODE_SET_TABLE.business
    )


PROVIDER_BUILDS = {
    "PROVIDER_NPI": provider,
    "PROVIDER_NPI_ADDRESS": addresses,
    "PROVIDER_NPI_TAXONOMY": taxonomies,
    "PROVIDER_NPI_OTHER_IDS": other_ids,
    "PROVIDER_NPI_XREF": cross_reference,
}


def build(name: str, bronze: DataFrame, stamp: BatchStamp) -> DataFrame:
    """One stamped silver table; only the bronze columns it needs are read."""
    return stamp.put_on({**PROVIDER_BUILDS, "NUCC_TAXONOMY": code_set}[name](bronze))
