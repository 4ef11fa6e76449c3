"""Names every job agrees on: batch metadata, provider-registry columns, target keys, file criteria."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

META_SCHEMA = T.StructType(
    [
        T.StructField("META_PROGRAM_NAME", T.StringType()),
        T.StructField("META_SUBJECT_AREA", T.StringType()),
        T.StructField("META_BATCH_ID", T.LongType()),
        T.StructField("META_DATE_INSERT", T.TimestampType()),
        T.StructField("META_DATE_UPDATE", T.TimestampType()),
        T.StructField("META_UPD_BATCH_ID", T.LongType()),
    ]
)
META_COLUMNS = META_SCHEMA.fieldNames()

# --- fixed values: provider registry layout, in file order -------------------------------------------------
_IDENTITY = [
    "NPI",
    "ENTITY_TYPE_CODE",
    "REPLACEMENT_NPI",
    "EMPLOYER_IDENTIFICATION_NUMBER",
    "PROVIDER_ORGANIZATION_NAME",
    "PROVIDER_LAST_NAME",
    "PROVIDER_FIRST_NAME",
    "PROVIDER_MIDDLE_NAME",
    "PROVIDER_NAME_PREFIX_TEXT",
    "PROVIDER_NAME_SUFFIX_TEXT",
    "PROVIDER_CREDENTIAL_TEXT",
    "PROVIDER_OTHER_ORGANIZATION_NAME",
    "PROVIDER_OTHER_ORGANIZATION_NAME_TYPE_CODE",
    "PROVIDER_OTHER_LAST_NAME",
    "PROVIDER_OTHER_FIRST_NAME",
    "PROVIDER_OTHER_MIDDLE_NAME",
    "PROVIDER_OTHER_NAME_PREFIX_TEXT",
    "PROVIDER_OTHER_NAME_SUFFIX_TEXT",
    "PROVIDER_OTHER_CREDENTIAL_TEXT",
    "PROVIDER_OTHER_LAST_NAME_TYPE_CODE",
]
_DATES_AND_OFFICIAL = [
    "PROVIDER_ENUMERATION_DATE",
    "LAST_UPDATE_DATE",
    "NPI_DEACTIVATION_REASON_CODE",
    "NPI_DEACTIVATION_DATE",
    "NPI_REACTIVATION_DATE",
    "PROVIDER_SEX_CODE",
    "AUTHORIZED_OFFICIAL_LAST_NAME",
    "AUTHORIZED_OFFICIAL_FIRST_NAME",
    "AUTHORIZED_OFFICIAL_MIDDLE_NAME",
    "AUTHORIZED_OFFICIAL_TITLE_OR_POSITION",
    "AUTHORIZED_OFFICIAL_TELEPHONE_NUMBER",
]
_ORGANISATION_AND_OFFICIAL = [
    "IS_SOLE_PROPRIETOR",
    "IS_ORGANIZATION_SUBPART",
    "PARENT_ORGANIZATION_LBN",
    "PARENT_ORGANIZATION_TIN",
    "AUTHORIZED_OFFICIAL_NAME_PREFIX_TEXT",
    "AUTHORIZED_OFFICIAL_NAME_SUFFIX_TEXT",
    "AUTHORIZED_OFFICIAL_CREDENTIAL_TEXT",
]
# An address is eight columns; {place} is the mailing or the practice-location wording.
_ADDRESS = [
    "PROVIDER_FIRST_LINE_BUSINESS_{place}_ADDRESS",
    "PROVIDER_SECOND_LINE_BUSINESS_{place}_ADDRESS",
    "PROVIDER_BUSINESS_{place}_ADDRESS_CITY_NAME",
    "PROVIDER_BUSINESS_{place}_ADDRESS_STATE_NAME",
    "PROVIDER_BUSINESS_{place}_ADDRESS_POSTAL_CODE",
    "PROVIDER_BUSINESS_{place}_ADDRESS_COUNTRY_CODE",
    "PROVIDER_BUSINESS_{place}_ADDRESS_TELEPHONE_NUMBER",
    "PROVIDER_BUSINESS_{place}_ADDRESS_FAX_NUMBER",
]
TAXONOMY_SLOTS = 15
TAXONOMY_STEMS = [
    "HEALTHCARE_PROVIDER_TAXONOMY_CODE",
    "PROVIDER_LICENSE_NUMBER",
    "PROVIDER_LICENSE_NUMBER_STATE_CODE",
    "HEALTHCARE_PROVIDER_PRIMARY_TAXONOMY_SWITCH",
]
TAXONOMY_GROUP_STEM = "HEALTHCARE_PROVIDER_TAXONOMY_GROUP"
OTHER_ID_SLOTS = 50
OTHER_ID_STEMS = [
    "OTHER_PROVIDER_IDENTIFIER",
    "OTHER_PROVIDER_IDENTIFIER_TYPE_CODE",
    "OTHER_PROVIDER_IDENTIFIER_STATE",
    "OTHER_PROVIDER_IDENTIFIER_ISSUER",
]
CODE_SET_COLUMNS = [
    "CODE",
    "GROUPING",
    "CLASSIFICATION",
    "SPECIALIZATION",
    "DEFINITION",
    "NOTES",
    "DISPLAY_NAME",
    "SECTION",
]
# --- end of fixed values -----------------------------------------------------------------------------------

MAILING_ADDRESS = [c.format(place="MAILING") for c in _ADDRESS]
PRACTICE_ADDRESS = [c.format(place="PRACTICE_LOCATION") for c in _ADDRESS]


def _slots(stems: list[str], n: int) -> list[str]:
    return [f"{stem}_{i}" for i in range(1, n + 1) for stem in stems]


REGISTRY_COLUMNS = [
    *_IDENTITY,
    *MAILING_ADDRESS,
    *PRACTICE_ADDRESS,
    *_DATES_AND_OFFICIAL,
    *_slots(TAXONOMY_STEMS, TAXONOMY_SLOTS),
    *_slots(OTHER_ID_STEMS, OTHER_ID_SLOTS),
    *_ORGANISATION_AND_OFFICIAL,
    *_slots([TAXONOMY_GROUP_STEM], TAXONOMY_SLOTS),
    "CERTIFICATION_DATE",
]

ADDRESS_COLUMNS = [
    *MAILING_ADDRESS[:5],
    "PROVIDER_BUSINESS_MAILING_ADDRESS_POSTAL_CODE_PLUS4",
    *MAILING_ADDRESS[5:],
]


@dataclass(frozen=True)
class TargetTable:
    """Key and change-detected columns of one gold table."""

    name: str
    keys: tuple[str, ...]
    business: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*META_COLUMNS, *self.keys, *self.business]


PROVIDER_TABLES = {
    t.name: t
    for t in (
        TargetTable(
            "PROVIDER_NPI",
            ("NPI",),
            (*_IDENTITY[1:], *MAILING_ADDRESS, *_DATES_AND_OFFICIAL, *_ORGANISATION_AND_OFFICIAL, "CERTIFICATION_DATE"),
        ),
        TargetTable("PROVIDER_NPI_ADDRESS", ("NPI", "PROVIDER_ADDRESS_TYPE"), tuple(ADDRESS_COLUMNS)),
        TargetTable(
            "PROVIDER_NPI_TAXONOMY",
            ("NPI", "HEALTHCARE_PROVIDER_TAXONOMY_CODE_SEQ_ID"),
            (TAXONOMY_STEMS[0], TAXONOMY_GROUP_STEM, *TAXONOMY_STEMS[1:]),
        ),
        TargetTable("PROVIDER_NPI_OTHER_IDS", ("NPI", "OTHER_PROVIDER_IDENTIFIER_SEQ_ID"), tuple(OTHER_ID_STEMS)),
        TargetTable(
            "PROVIDER_NPI_XREF",
            ("NPI",),
            ("PROVIDER_ID", "PROVIDER_ENUMERATION_DATE", "NPI_DEACTIVATION_DATE", "IS_NPI_ACTIVE"),
        ),
    )
}
CODE_SET_TABLE = TargetTable("NUCC_TAXONOMY", ("CODE",), tuple(CODE_SET_COLUMNS[1:]))


@dataclass(frozen=True)
class Criterion:
    patterns: tuple[str, ...] = ()
    count: int = 0


@dataclass(frozen=True)
class FileCriteria:
    """Six ways to pick files by name. Kinds are ANDed, patterns inside a kind are ORed, empty = no condition."""

    prefix: Criterion = field(default_factory=Criterion)
    suffix: Criterion = field(default_factory=Criterion)
    contains: Criterion = field(default_factory=Criterion)
    not_contains: Criterion = field(default_factory=Criterion)
    regex: Criterion = field(default_factory=Criterion)
    extension: Criterion = field(default_factory=Criterion)

    @classmethod
    def from_dict(cls, spec: dict) -> FileCriteria:
        """Accepts {kind: {"pattern": str | list | None, "count": int}}."""
        kinds = {}
        for kind, item in spec.items():
            pattern = item.get("pattern")
            patterns = () if not pattern else (pattern,) if isinstance(pattern, str) else tuple(pattern)
            kinds[kind] = Criterion(patterns, int(item.get("count") or 0))
        return cls(**kinds)

    def counting(self) -> dict[str, Criterion]:
        """Criteria whose count is part of completeness; extension and not_contains only filter."""
        kinds = {k: getattr(self, k) for k in ("prefix", "suffix", "contains", "regex")}
        return {k: c for k, c in kinds.items() if c.count > 0}

    @property
    def expected_total(self) -> int:
        return sum(c.count for c in self.counting().values())


@dataclass(frozen=True)
class ProgramConfig:
    program: str
    subject: str
    criteria: FileCriteria
    rule_group: str
    rule_id: str | None = None
    control_file: str | None = None
    bronze_table: str | None = None


# fixed values: file prefixes, counts, rule ids and control files of the four programs
RECIPIENT = ProgramConfig(
    "MEDICAID",
    "RECIPIENT",
    FileCriteria(prefix=Criterion(("R_MMIS",), 9)),
    rule_group="RECIP_001",
    rule_id="RL_G_RECIPIENT_ELIG_ENROLL_008",
    control_file="R_MMIS_RECIPIENT_CONTROL_FILE.csv",
)
PROVIDER = ProgramConfig(
    "MEDICAID",
    "PROVIDER",
    FileCriteria(prefix=Criterion(("P_MMIS",), 11)),
    rule_group="PROV_001",
    control_file="P_MMIS_PROVIDER_CONTROL_FILE.csv",
)
REGISTRY = ProgramConfig(
    "MEDICAID",
    "NPPES",
    FileCriteria(prefix=Criterion(("npidata_pfile",), 1), extension=Criterion((".csv",), 1)),
    rule_group="RECIP_001",
    bronze_table="NPIDATA_PFILE",
)
CODE_SET = ProgramConfig(
    "MEDICAID",
    "NUCC",
    FileCriteria(prefix=Criterion(("nucc_taxonomy",), 1), extension=Criterion((".csv",), 1)),
    rule_group="RECIP_001",
    bronze_table="NUCC_TAXONOMY",
)
