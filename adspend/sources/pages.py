"""Landed JSON responses of the report APIs, parsed with an explicit schema.

Landing format (one JSON object per line)::

    {"account_id": 8, "stat_date": "2024-01-01", "page": 1,
     "response": {"code": 0, "message": "", "data": {"list": [...], "page_info": {"total_page": 2}}}}

A page counts only when ``code == 0`` and its list is not empty (SRC-2); the
request's account and day are attached to every row (SRC-7).  Lines that give
no rows are listed with a reason by ``report_page_rejects``: nothing goes
unseen.  The channel
report (``{"ec": 200, "data": [...]}``) has its own reader (SRC-4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

# ---- fixed values (as the reference states them) -------------------------
CHANNEL_FIELDS = {"time": "stat_day", "bids": "adx_bid", "bids_win": "adx_winbid",
                  "display": "adx_impression", "uniq_display": "adx_valid_impression",
                  "click": "adx_click", "uniq_click": "adx_valid_click", "fee": "adx_cost"}
CHANNEL_OK = 200
PAGE_OK = 0
# ---------------------------------------------------------------------------

ACCOUNT_ROW = StructType([StructField("account_id", LongType()),
                          StructField("corporation_name", StringType()),
                          StructField("system_status", StringType())])

CHANNEL_ROW = StructType([StructField("time", StringType()), StructField("bids", LongType()),
                          StructField("bids_win", LongType()), StructField("display", LongType()),
                          StructField("uniq_display", LongType()), StructField("click", LongType()),
                          StructField("uniq_click", LongType()), StructField("fee", DoubleType())])


def envelope(row_schema: StructType) -> StructType:
    return StructType([
        StructField("code", IntegerType()), StructField("message", StringType()),
        StructField("data", StructType([
            StructField("list", ArrayType(row_schema)),
            StructField("page_info", StructType([StructField("total_page", IntegerType())]))]))])


def landed(row_schema: StructType) -> StructType:
    return StructType([StructField("account_id", LongType()), StructField("stat_date", DateType()),
                       StructField("page", IntegerType()), StructField("response", envelope(row_schema))])


CORRUPT = "_corrupt_record"


def _parsed(lines: DataFrame, col: str, schema: StructType, *others, options: dict | None = None) -> DataFrame:
    """``line``, ``r`` (the line parsed by ``schema``, once) and ``others``. As a generator's output the record is
    not put into the filters above it in place of its name, each of which would parse the line again."""
    record = F.explode(F.array(F.from_json(F.col(col), schema, options or {})))
    return lines.select(F.col(col).alias("line"), *others, record.alias("r"))


def _pages(lines: DataFrame, row_schema: StructType, col: str, account_id=None, stat_date=None) -> DataFrame:
    """Landed records with the line they came from, and why a line gives no rows (NULL: it does)."""
    schema = landed(row_schema).add(CORRUPT, StringType())
    r = _parsed(lines, col, schema, options={"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).select("line", "r.*")
    if account_id is not None:
        r = r.withColumn("account_id", F.coalesce("account_id", F.lit(account_id).cast("long")))
    if stat_date is not None:
        r = r.withColumn("stat_date", F.coalesce("stat_date", F.to_date(F.lit(str(stat_date)))))
    # of a line cut short, the keys that its beginning still says
    for key, pattern, kind in (("account_id", r'"account_id"\s*:\s*(\d+)', "long"),
                               ("stat_date", r'"stat_date"\s*:\s*"(\d{4}-\d{2}-\d{2})"', "date")):
        said = F.regexp_extract("line", pattern, 1)
        r = r.withColumn(key, F.coalesce(key, F.when(F.col(CORRUPT).isNotNull() & (said != ""), said.try_cast(kind))))
    code = F.col("response.code")
    reason = (F.when(F.col(CORRUPT).isNotNull() | F.col("response").isNull() | code.isNull(), "unreadable")
              .when(code != PAGE_OK, "refused")
              .when(F.coalesce(F.size("response.data.list"), F.lit(0)) <= 0, "empty"))
    # the only page of a slice needs no number
    only = F.coalesce("response.data.page_info.total_page", F.lit(1)) == 1
    return r.withColumn("reason", reason).withColumn("page", F.coalesce("page", F.when(only, 1)))


def incomplete_slices(pages: DataFrame) -> DataFrame:
    """``account_id, stat_date`` of slices that lack a page out of 1..``total_page``,
    or have an unreadable one (if its line still says whose it is)."""
    good = F.col("reason").isNull()
    total = F.max(F.when(good, F.coalesce("response.data.page_info.total_page", F.lit(1))))
    have = F.count_distinct(F.when(good & (F.col("page") >= 1), F.col("page")))
    bad = F.count_if(F.col("reason") == "unreadable")
    return pages.groupBy("account_id", "stat_date").agg(total.alias("total"), have.alias("have"), bad.alias("bad")).where(
        (F.col("bad") > 0) | (F.col("have") < F.coalesce("total", F.lit(0)))).select("account_id", "stat_date")


def report_page_rejects(lines: DataFrame, row_schema: StructType, *, col: str = "value", complete: bool = False,
                        account_id=None, stat_date=None) -> DataFrame:
    """``line, account_id, stat_date, reason`` of every landed line that gives no
    rows: unreadable, refused, empty, or (with ``complete``) of an incomplete slice."""
    pages = _pages(lines, row_schema, col, account_id, stat_date)
    return rejects_of(pages, incomplete_slices(pages) if complete else None)


def rejects_of(pages: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """``report_page_rejects`` of parsed pages; ``gone`` are the slices that are not complete."""
    if gone is not None:
        gone = gone.select(F.col("account_id").alias("_a"), F.col("stat_date").alias("_d"), F.lit("incomplete").alias("_why"))
        pages = pages.join(gone, F.col("account_id").eqNullSafe(F.col("_a")) & F.col("stat_date").eqNullSafe(F.col("_d")),
                           "left").withColumn("reason", F.coalesce("reason", "_why"))
    return pages.where("reason IS NOT NULL").select("line", "account_id", "stat_date", "reason")


def asked_fields(row_schema: StructType, fields=None, drop: tuple[str, ...] = ("date",)) -> StructType:
    """The part of a row schema that is asked for."""
    return StructType([f for f in row_schema.fields if f.name not in drop and f.name not in ("account_id", "stat_date")
                       and (fields is None or f.name in fields)])


def rows_of(pages: DataFrame, asked: StructType) -> DataFrame:
    """Rows of the accepted pages."""
    rows = pages.filter("reason IS NULL").select("account_id", "stat_date", F.explode("response.data.list").alias("row"))
    return rows.select("account_id", "stat_date", *[F.col(f"row.{f.name}").alias(f.name) for f in asked.fields])


def parse_report_pages(lines: DataFrame, row_schema: StructType, *, col: str = "value",
                       fields: list[str] | None = None, drop: tuple[str, ...] = ("date",),
                       account_id=None, stat_date=None, dates=None, complete: bool = False) -> DataFrame:
    """Rows of all accepted pages: ``account_id, stat_date`` and the requested
    ``fields`` of the row schema (all but ``drop`` by default; H19).  The JSON is
    parsed by a schema cut to these fields: what is not asked for is skipped by
    the parser, and a bad value in it does no harm.

    ``account_id`` / ``stat_date`` give the request's keys when the landed
    record does not carry them (SRC-7); ``dates = (first, last)`` keeps the
    pages of those days only (SRC-6).

    ``complete`` keeps an account's day only if pages 1 to ``total_page`` are all
    there and readable, so that a slice is never replaced by a part of it.  It is
    off by default: the reference stores what the accepted pages held, and only an
    unreadable page makes it leave the slice alone.
    """
    asked = asked_fields(row_schema, fields, drop)
    r = _pages(lines, asked, col, account_id, stat_date)
    if complete:
        r = r.join(incomplete_slices(r), ["account_id", "stat_date"], "left_anti")
    if dates is not None:
        r = r.filter(F.col("stat_date").between(F.to_date(F.lit(str(dates[0]))), F.to_date(F.lit(str(dates[1])))))
    return rows_of(r, asked)


def read_report_pages(spark: SparkSession, path: str, row_schema: StructType, **kw) -> DataFrame:
    """``parse_report_pages`` over landed files (text, one JSON per line)."""
    return parse_report_pages(spark.read.text(path), row_schema, **kw)


def write_pages_by_day(lines: DataFrame, path: str, *, col: str = "value", mode: str = "append",
                       compression: str = "gzip") -> None:
    """Landed lines in one folder a day (``stat_date=yyyy-mm-dd``), by the day they say; a line that says none,
    or can't be read, goes to the default folder, which every read of rejects sees.

    Files are compressed, as names make up most of a page; a reader knows them by their ending. A file is
    read by one task: it holds what one task wrote of one day."""
    day = F.regexp_extract(col, r'"stat_date"\s*:\s*"(\d{4}-\d{2}-\d{2})"', 1)
    lines.select(F.col(col).alias("value"), F.when(day != "", day).try_cast("date").alias("stat_date")).write.mode(
        mode).partitionBy("stat_date").text(path, compression=compression)


def read_pages_by_day(spark: SparkSession, path: str, row_schema: StructType, *, dates=None, fields=None,
                      **kw) -> DataFrame:
    """Rows of the pages landed by ``write_pages_by_day`` on the days ``dates = (first, last)``.

    The range is a predicate on the folders: files of other days are neither
    listed for reading nor parsed (SRC-6), and of the days' own pages only the
    asked ``fields`` are parsed (SRC-5).
    """
    landed_lines = spark.read.schema(StructType([StructField("value", StringType()),
                                                 StructField("stat_date", DateType())])).text(path)
    if dates is not None:
        landed_lines = landed_lines.where(F.col("stat_date").between(*(F.lit(str(d)).cast("date") for d in dates)))
    return parse_report_pages(landed_lines.select("value"), row_schema, fields=fields, dates=dates, **kw)


def parse_account_pages(lines: DataFrame, *, col: str = "value") -> DataFrame:
    """Account ids listed on accepted account pages (SRC-3), distinct."""
    r = _parsed(lines, col, envelope(ACCOUNT_ROW))
    ok = (F.col("r.code") == PAGE_OK) & (F.size("r.data.list") > 0)
    return (r.filter(ok).select(F.explode("r.data.list").alias("row"))
            .select(F.col("row.account_id").alias("account_id")).distinct())


def parse_channel_report(lines: DataFrame, *, channel_id, type_id, col: str = "value",
                         seq: str | None = None, min_bids: int | None = None) -> DataFrame:
    """Rows of accepted channel reports (``ec == 200``), renamed to the
    consumption table, with the constant channel and type.

    ``batch_seq`` (from ``seq``, e.g. the file or message order) and
    ``batch_pos`` (position in the response) order the rows of one batch;
    ``min_bids`` keeps rows with at least that many bids (off by default, H9).
    """
    schema = StructType([StructField("ec", IntegerType()), StructField("data", ArrayType(CHANNEL_ROW))])
    r = _parsed(lines, col, schema, (F.col(seq) if seq else F.lit(0)).cast("long").alias("batch_seq"))
    rows = r.filter(F.col("r.ec") == CHANNEL_OK).select(
        "batch_seq", F.posexplode("r.data").alias("batch_pos", "row"))
    if min_bids is not None:
        rows = rows.filter(F.col("row.bids") >= min_bids)
    return rows.select(
        F.to_date(F.col("row.time")).alias("stat_day"),
        F.lit(channel_id).alias("channel_id"), F.lit(type_id).alias("type"),
        *[F.col(f"row.{src}").alias(dst) for src, dst in CHANNEL_FIELDS.items() if src != "time"],
        "batch_seq", "batch_pos")


def read_channel_report(spark: SparkSession, path: str, **kw) -> DataFrame:
    return parse_channel_report(spark.read.text(path), **kw)


def to_json_rows(df: DataFrame, *, name: str = "value") -> DataFrame:
    """Each row as one JSON text (SNK-5, SCL-11)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
