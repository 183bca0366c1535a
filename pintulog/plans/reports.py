"""Extracts, recaps, hit counts and usage by date."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pintulog.functions.regex_fields import field_text
from pintulog.functions.timestamps import date_part
from pintulog.operators import lookup as lk
from pintulog.operators import usage as us
from pintulog.operators.filters import NATIONAL_TENANT, cleansed, in_scope, qualifying_line
from pintulog.operators.parsing import analysis_fields, extract_row
from pintulog.shared import settle
from pintulog.sinks import UNKNOWN_DAY
from pintulog.sources.lines import decode_lines

DATE_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"

# Report layouts.
DATASET_COLUMNS = [
    "apiName", "apiCreator", "backendLatency", "requestMediationLatency", "apiId",
    "applicationName", "applicationOwner", "responseMediationLatency", "applicationId",
]
RECAP_COLUMNS = [
    "instansi_pemilik_api", "apiCreator", "apiName", "instansi_api_requester",
    "apiCreatorTenantDomain", "applicationOwner", "applicationName", "userIp", "occurrence",
]
USAGE_BY_DATE_COLUMNS = [
    "log_timestamp", "nama_instansi_pemilik_api", "api_name", "api_creator",
    "nama_instansi_requester", "application_owner", "application_name", "occurrence",
]
# Texts that CSV tools commonly read as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def scoped_records(lines: DataFrame, level: str, cleanse: bool) -> DataFrame:
    """Readable records of one interoperability level, test traffic removed on request."""
    records = in_scope(decode_lines(lines), level)
    return cleansed(records) if cleanse else records


def extract(lines: DataFrame, *keep: str, strict: bool = False) -> DataFrame:
    """The full 30-column extract of every readable line, after the ``keep`` columns."""
    return extract_row(decode_lines(lines), *keep, strict=strict)


def all_dataset(lines: DataFrame, level: str, cleanse: bool) -> DataFrame:
    return analysis_fields(scoped_records(lines, level, cleanse)).select(*DATASET_COLUMNS)


def qualifying_calls(lines: DataFrame, level: str, cleanse: bool, *keep: str) -> DataFrame:
    records = scoped_records(lines, level, cleanse).where(qualifying_line())
    return analysis_fields(records, *keep)


def with_institutions(table: DataFrame, mapping: DataFrame, level: str) -> DataFrame:
    """A recap table with the institutions of its creators and requesters."""
    column = "akun_nasional" if level == "national" else "domain"
    keys = lk.keys_of(table, ["apiCreator", "applicationOwner"], "occurrence")
    hits = lk.substring_lookup(keys, mapping, column)
    table = lk.attach(table, "apiCreator", hits, "instansi_pemilik_api")
    return lk.attach(table, "applicationOwner", hits, "instansi_api_requester")


def recap(lines: DataFrame, mapping: DataFrame, level: str, cleanse: bool) -> DataFrame:
    """Qualifying calls per API and consumer with both institutions."""
    table = us.count_calls(qualifying_calls(lines, level, cleanse), *us.RECAP_KEYS)
    return with_institutions(table, mapping, level).select(*RECAP_COLUMNS)


def recap_both_levels(
    lines: DataFrame, mapping: DataFrame, cleanse: bool
) -> tuple[DataFrame, DataFrame]:
    """The national and the internal recap from one scan of the log.

    The tenant is part of a recap key, so the levels can be told apart after counting.
    The counts are written once and both recaps read them.
    """
    records = decode_lines(lines)
    records = (cleansed(records) if cleanse else records).where(
        qualifying_line() & (field_text("apiCreatorTenantDomain") != "")
    )
    counts = settle(us.count_calls(analysis_fields(records), *us.RECAP_KEYS))
    national = F.col("apiCreatorTenantDomain") == NATIONAL_TENANT
    return (
        with_institutions(counts.where(national), mapping, "national").select(*RECAP_COLUMNS),
        with_institutions(counts.where(~national), mapping, "internal").select(*RECAP_COLUMNS),
    )


def recap_daily_long(
    lines: DataFrame, level: str, cleanse: bool, day_column: str = "file_stem"
) -> DataFrame:
    """Qualifying calls per API, consumer and day, one row each; calls of no day are of ``unknown``."""
    calls = qualifying_calls(lines, level, cleanse, day_column)
    day = F.coalesce(F.col(day_column).cast("string"), F.lit(UNKNOWN_DAY)).alias("file_stem")
    return us.count_calls(calls.select(*us.RECAP_KEYS, day), *us.RECAP_KEYS, "file_stem")


def recap_daily(
    lines: DataFrame,
    mapping: DataFrame,
    level: str,
    cleanse: bool,
    days: list[str] | None = None,
    day_column: str = "file_stem",
) -> DataFrame:
    """The recap with one count column per day.

    Without ``days`` the days with at least one qualifying call are found first: the
    daily counts are written once and read back, so the log is still scanned once.
    """
    daily = recap_daily_long(lines, level, cleanse, day_column)
    if days is None:
        daily = settle(daily)
        days = us.distinct_texts(daily, "file_stem")
    wide = us.pivot_days(daily, days)
    return with_institutions(wide, mapping, level).select(*RECAP_COLUMNS, *days)


def hits(lines: DataFrame, level: str, cleanse: bool) -> DataFrame:
    return us.hits_per_second(scoped_records(lines, level, cleanse))


def hits_summary(lines: DataFrame, level: str, cleanse: bool) -> DataFrame:
    return us.hits_summary(hits(lines, level, cleanse))


def is_date(text: str | Column) -> Column:
    """A calendar day written as yyyy-MM-dd, alone or before a time of day."""
    text = F.col(text) if isinstance(text, str) else text
    return text.rlike(DATE_SHAPE) & F.substring(text, 1, 10).try_cast("date").isNotNull()


def bad_dates(extract_rows: DataFrame) -> DataFrame:
    """Distinct date texts of an extract that are not dates."""
    dates = extract_rows.select(
        date_part(F.col("log_timestamp").cast("string")).alias("log_timestamp")
    )
    return dates.where(~is_date("log_timestamp")).distinct()


def usage_by_date(
    extract_rows: DataFrame,
    mapping: DataFrame,
    on_bad_date: str = "fail",
    pandas_na: bool = False,
) -> DataFrame:
    """Calls per date, API and application with owner and requester institutions.

    ``on_bad_date`` is ``fail`` (a date that is none stops the job) or ``skip``. Rows
    with an empty key drop out; ``pandas_na`` counts the usual missing-value texts as
    empty too.
    """
    if on_bad_date not in ("fail", "skip"):
        raise ValueError(f"on_bad_date must be 'fail' or 'skip', not {on_bad_date!r}")
    day = date_part(F.col("log_timestamp").cast("string"))
    if on_bad_date == "fail":
        message = F.concat(F.lit("not a date: "), F.coalesce(day, F.lit("null")))
        day = F.when(is_date(day), day).otherwise(F.raise_error(message))
    else:
        day = F.when(is_date(day), day)
    missing = MISSING_TEXTS if pandas_na else [""]
    names = [F.when(~F.col(c).isin(missing), F.col(c)).alias(c) for c in us.DATE_KEYS[1:]]
    rows = extract_rows.select(day.alias("log_timestamp"), *names).dropna(subset=us.DATE_KEYS)
    table = us.count_calls(rows, *us.DATE_KEYS)

    owners = lk.owner_lookup(lk.keys_of(table, ["api_creator"], "occurrence"), mapping)
    requesters = lk.requester_lookup(
        lk.keys_of(table, ["application_owner"], "occurrence"), mapping
    )
    table = lk.attach(table, "api_creator", owners, "nama_instansi_pemilik_api", default=None)
    table = lk.attach(table, "application_owner", requesters, "nama_instansi_requester")
    requester = F.col("nama_instansi_requester")
    return table.withColumn(
        "nama_instansi_requester",
        F.coalesce(F.nullif(requester, F.lit("")), F.lit(lk.UNREGISTERED)),
    ).select(*USAGE_BY_DATE_COLUMNS)
