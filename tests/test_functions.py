import hashlib
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from carestrata.functions import cleanse, filenames, hashing, releases

X = F.col("x")


def test_phone_keeps_text_with_ten_digits(many):
    given = [None, "", "2125551234", "(212) 555-1234", "212555123", "21255512345", "abc", "2125551234\n"]
    assert many(cleanse.keep_ten_digits(X), given) == [
        None, None, "2125551234", "(212) 555-1234", None, None, None, "2125551234\n",
    ]


def test_state_and_zip(many):
    assert many(cleanse.keep_state(X), ["NY", "N", "New York", None, ""]) == ["NY", None, None, None, None]
    postal = ["12345", "12345-6789", "123456789", "123456", None, ""]
    assert many(cleanse.zip5(X), postal) == ["12345", "12345", "12345", "12345", None, ""]
    assert many(cleanse.zip_plus4(X), postal) == [None, "6789", "789", "", None, None]
    assert many(cleanse.zip_plus4(X, "digits"), postal) == [None, "6789", "6789", None, None, None]


def test_blank_default(many):
    assert many(cleanse.blank_to(X), [None, "  ", "", "a", " a "]) == [cleanse.MISSING_DESCRIPTION] * 3 + ["a", " a "]


def test_end_date_and_flag(many):
    given = [None, "2299-12-31", "2020-01-01"]
    assert many(cleanse.open_end(X), given) == ["2299-12-31", "2299-12-31", "2020-01-01"]
    assert many(cleanse.active_flag(X), given) == ["Y", "Y", "N"]


@pytest.mark.parametrize(
    "kind, last, first, middle, org, expected",
    [
        ("1", "Doe", "Jo", "K", "Org", "Doe, Jo K"),
        ("1", "Doe", "Jo", None, "Org", "Doe, Jo"),
        ("1", None, "Jo", None, "Org", ", Jo"),
        ("1", None, None, "", None, ",  "),
        ("2", "Doe", "Jo", None, "Org", "Org"),
        (None, "Doe", "Jo", None, "Org", "Org"),
        ("2", None, None, None, None, None),
    ],
)
def test_display_name(one, kind, last, first, middle, org, expected):
    columns = [F.col(c) for c in "klfmo"]
    assert one(cleanse.display_name(*columns), k=kind, l=last, f=first, m=middle, o=org) == expected


def test_buckets(many):
    assert many(cleanse.rating_category(X.cast("double")), ["4", "3.99", "3", "2", "1.9", None]) == [
        "Excellent", "Good", "Good", "Fair", "Poor", "Poor",
    ]
    ages = ["0", "1", "30", "31", "40", "41", "100", "101", None]
    expected = pd.cut([float(a) if a else float("nan") for a in ages], [0, 30, 40, 100], labels=["Young", "Middle", "Senior"])
    assert many(cleanse.age_group(X.cast("int")), ages) == [None if pd.isna(v) else v for v in expected]


def test_tolerant_number(many):
    assert many(cleanse.tolerant_number(X), ["12", "12.6", " 7 ", "B1", "", None]) == [12, 13, 7, None, None, None]


def test_row_hash(one):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert one(hashing.row_hash(["a", "b", "c"]), a="AB", b="C", c=None) == md5("ABC")
    assert one(hashing.row_hash(["a", "b"]), a="A", b="BC") == one(hashing.row_hash(["a", "b"]), a="AB", b="C")
    assert one(hashing.row_hash(["a", "b", "c"], "|"), a="AB", b=None, c="C") == md5("AB||C")


@pytest.mark.parametrize(
    "name, expected",
    [
        ("A_TB_2025_07_18T094424Z_x.csv", "A_TB.csv"),
        ("A_TBL_2025_07_18.csv", "A_TBL.csv"),
        ("A_TBL_20250718.csv", "A_TBL.csv"),
        ("A_TB_20250718T094424.csv", "A_TB.csv"),
        ("npidata_pfile_20250707-20250713.csv", "npidata_pfile.csv"),
        ("npidata_pfile_202507_monthly.csv", "npidata_pfile_202507_monthly.csv"),
        ("nucc_taxonomy_251.csv", "nucc_taxonomy.csv"),
        ("report_20240708_143000.csv", "report.csv"),
        ("_1234.csv", "file.csv"),
        ("a-_.csv", "a.csv"),
        ("plain", "plain"),
        (".hidden", ".hidden"),
    ],
)
def test_clean_file_name(one, name, expected):
    assert one(filenames.clean_file_name(F.col("n")), n=name) == expected


def test_extension_follows_splitext(many):
    import os

    names = ["a.csv", "a.tar.gz", ".bashrc", "..a.b", "a.", "dir.x/file", "d/.b", "d/a.b", "", "x"]
    assert many(filenames.extension(X), names) == [os.path.splitext(n)[1] for n in names]
    assert many(filenames.stem(X), names) == [os.path.splitext(n)[0] for n in names]


def test_file_names(many, one):
    assert many(filenames.file_type(X), ["a.csv", "a.PARQUET", "a.txt", "a.xls", "a.zip", "a.dat", "a"]) == [
        "CSV", "PARQUET", "TEXT", "EXCEL", "ZIP", "DAT", "",
    ]
    assert many(filenames.table_name(X, suffix="_T"), ["a.CSV", "a_T.csv"]) == ["a_T", "a_T"]
    assert many(filenames.size_text(X.cast("bigint")), ["7", None]) == ["7B", "UNKNOWN"]
    parts = [F.lit(v) for v in ("P", "S", "2024-01-01", 3, 1)]
    assert one(filenames.transaction_id(*parts)) == "P_S_2024-01-01_3_1"


WEEKLY = "X_Dissemination_070725_071325_Weekly_V2.zip"
MONTHLY = "X_Dissemination_July_2025_V2.zip"


def test_release_scores(many):
    assert many(releases.weekly_score(X), [WEEKLY, "a_010224.zip", "none"]) == [20250713, 20240102, None]
    assert many(releases.monthly_score(X), [MONTHLY, "July", "2025"]) == [20250700, None, None]


def test_release_names(many):
    names = many(releases.data_file_name(X, F.lit(5)), [WEEKLY, MONTHLY, "foo"])
    assert names == ["npidata_pfile_20250707-20250713.csv", "npidata_pfile_202507_monthly.csv", "npidata_pfile_5.csv"]
    info = [tuple(v) for v in many(releases.release_info(X), [WEEKLY, MONTHLY, "foo"])]
    assert info[0] == ("07/07/2025", "07/13/2025", "weekly", None, None)
    assert info[1] == (None, None, "monthly", "2025", "July")
    assert info[2] == (None, None, None, None, None)
    same = releases.same_period(F.lit(WEEKLY), X)
    assert many(same, ["npidata_pfile_20250707-20250713.csv", "npidata_pfile_20250707-20250714.csv", "x"]) == [True, False, False]


def test_release_links(many):
    kinds = ["/a/" + WEEKLY, MONTHLY, WEEKLY.replace("V2", "V1"), WEEKLY.replace("zip", "csv"), "NPPES_V2.zip"]
    assert many(releases.release_kind(X), kinds) == ["weekly", "monthly", None, None, None]
    urls = many(releases.absolute_url(X, "https://s", "https://s/f/"), ["/a", "http://b", "c"])
    assert urls == ["https://s/a", "http://b", "https://s/f/c"]


def test_release_calendar(many):
    days = [date(2025, 1, 7), date(2025, 7, 8), date(2024, 6, 13), date(2024, 12, 17)]
    texts = [d.isoformat() for d in days]
    day = X.cast("date")
    assert many(releases.release_version(day), texts) == ["2025.1", "2025.2", "2024.1", "2024.2"]
    assert many(releases.release_cadence(day), texts) == ["weekly", "weekly", "monthly", "monthly"]
    assert many(releases.in_release_window(day), texts) == [True, False, False, False]


def test_severity_label(many):
    assert many(releases.severity_label(X), ["error", "info", "log", "other"]) == [
        "High", "Informational", "Medium", "Informational",
    ]
