"""Published-release names: period, ranking score, standard file name, link choice and calendar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------------------
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
VERSION_MARKS = ("v.2", "v2", "_v2", "version2")
RELEASE_WORD = "dissemination"
DATA_FILE_STEM = "npidata_pfile"
REGISTRY_SITE = "https://download.cms.gov"
REGISTRY_FOLDER = "https://download.cms.gov/nppes/"
CODE_SET_SITE = "https://www.nucc.org"
CODE_SET_FOLDER = "https://www.nucc.org/"
CODE_SET_LINK = r"nucc.*taxonomy.*csv"
# --- end of fixed values ------------------------------------------------------------------------------------

_YEAR = r"20\d{2}"


def _period(name: Column) -> Column:
    """The `MMDDYY_MMDDYY` text of a name, '' without one."""
    return F.regexp_extract(name, r"\d{6}_\d{6}", 0)


def _has_period(name: Column) -> Column:
    return _period(name) != ""


def _iso_day(mmddyy: Column) -> Column:
    """MMDDYY -> YYYYMMDD text, years taken as 20YY."""
    return F.concat(F.lit("20"), F.substring(mmddyy, 5, 2), F.substring(mmddyy, 1, 4))


def _us_day(mmddyy: Column) -> Column:
    year = F.concat(F.lit("20"), F.substring(mmddyy, 5, 2))
    return F.concat_ws("/", F.substring(mmddyy, 1, 2), F.substring(mmddyy, 3, 2), year)


def _edge(name: Column, which: int) -> Column:
    return F.substring(_period(name), 1 if which == 1 else 8, 6)


def year_in(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, _YEAR, 0), F.lit(""))


def month_in(name: Column) -> Column:
    """Number of the first calendar month whose English name occurs in the text, else NULL."""

    def number(lower: Column) -> Column:
        return F.coalesce(*[F.when(lower.contains(m), F.lit(i)) for i, m in enumerate(MONTHS, 1)])

    # a one-element array binds the lower-cased text, which would else be made anew for every month
    return F.get(F.transform(F.array(F.lower(name)), number), F.lit(0))


def weekly_score(name: Column) -> Column:
    """End of an `MMDDYY_MMDDYY` period as YYYYMMDD; without a period, the last six-digit run."""
    last_run = F.try_element_at(F.regexp_extract_all(name, F.lit(r"(\d{6})"), F.lit(1)), F.lit(-1))
    end = F.when(_has_period(name), _edge(name, 2)).otherwise(last_run)
    return _iso_day(end).cast("bigint")


def monthly_score(name: Column) -> Column:
    return year_in(name).cast("bigint") * 10000 + month_in(name) * 100


def release_info(name: Column) -> Column:
    weekly = _has_period(name)
    month = month_in(name)
    month_title = F.element_at(F.array(*[F.lit(m.title()) for m in MONTHS]), month)
    return F.struct(
        F.when(weekly, _us_day(_edge(name, 1))).alias("start_date"),
        F.when(weekly, _us_day(_edge(name, 2))).alias("end_date"),
        F.when(weekly, "weekly").when(month.isNotNull(), "monthly").alias("type"),
        F.when(~weekly, year_in(name)).alias("year"),
        F.when(~weekly & month.isNotNull(), month_title).alias("month"),
    )


def data_file_name(name: Column, epoch_seconds: Column) -> Column:
    """Standard data-file name of a release; a name without period or month falls back to a time stamp."""
    period = F.concat_ws("-", _iso_day(_edge(name, 1)), _iso_day(_edge(name, 2)))
    month = F.concat(year_in(name), F.lpad(month_in(name).cast("string"), 2, "0"), F.lit("_monthly"))
    tail = F.when(_has_period(name), period).otherwise(F.coalesce(month, epoch_seconds.cast("string")))
    return F.concat(F.lit(f"{DATA_FILE_STEM}_"), tail, F.lit(".csv"))


def same_period(release_name: Column, file_name: Column) -> Column:
    """Does a release (MMDDYY range) cover the same days as a data file (YYYYMMDD range)?"""
    in_file = r"(\d{8})-(\d{8})"
    return (
        _has_period(release_name)
        & file_name.rlike(in_file)
        & (_iso_day(_edge(release_name, 1)) == F.regexp_extract(file_name, in_file, 1))
        & (_iso_day(_edge(release_name, 2)) == F.regexp_extract(file_name, in_file, 2))
    )


def release_version(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.when(F.month(day) >= 7, ".2").otherwise(".1"))


def release_cadence(day: Column) -> Column:
    return F.when(F.dayofmonth(day).between(13, 17), "monthly").otherwise("weekly")


def in_release_window(day: Column) -> Column:
    return F.month(day).isin(1, 7) & F.dayofmonth(day).between(1, 7)


def absolute_url(href: Column, site: str, folder: str) -> Column:
    return (
        F.when(href.startswith("/"), F.concat(F.lit(site), href))
        .when(href.startswith("http"), href)
        .otherwise(F.concat(F.lit(folder), href))
    )


def last_segment(href: Column) -> Column:
    return F.substring_index(href, "/", -1)


def release_kind(href: Column) -> Column:
    """'weekly' or 'monthly' for a link to a registry release archive, NULL for any other link."""
    lower = F.lower(last_segment(href))
    marked = lower.rlike("|".join(m.replace(".", r"\.") for m in VERSION_MARKS))
    wanted = href.endswith(".zip") & marked & lower.contains(RELEASE_WORD)
    return F.when(
        wanted, F.when(lower.contains("weekly"), "weekly").when(lower.rlike("|".join(MONTHS)), "monthly")
    )


def code_set_priority(text: Column, href: Column, version: str) -> Column:
    """1 = names the wanted version, 2 = says 'current version', 3 = looks like the code-set file, NULL = neither."""
    t, h = F.lower(text), F.lower(href)
    rank = (
        F.when(t.contains(version.replace(".", "_")), 1)
        .when(t.contains("current") & t.contains("version"), 2)
        .when(h.rlike(CODE_SET_LINK), 3)
    )
    return F.when(h.contains("csv"), rank)


def severity_label(trigger: Column) -> Column:
    return F.when(trigger == "error", "High").when(trigger == "log", "Medium").otherwise("Informational")
