"""Read side over the readings table.

Every predicate is a Column built from typed values (no SQL text is glued
together), so Catalyst pushes it into the Parquet scan and prunes date
partitions; sort + limit plans as TakeOrderedAndProject (a per-task top-k).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import (DEFAULT_LIMIT, DEFAULT_OFFSET, FAULT_CODES, LATEST_PER_CODE,
                       MEASUREMENT)
from ..functions.timefn import micros

FAULT_DIM_COLUMNS = ("code", "name", "description", "severity", "action")


def is_fault() -> Column:
    """Any alarm or the fault code above zero (Q6)."""
    return ((F.col("alarm_1") > 0) | (F.col("alarm_2") > 0) | (F.col("alarm_3") > 0)
            | (F.col("fault_code") > 0))


def is_normal() -> Column:
    """All alarms and the fault code equal to zero (a negative code is in neither set)."""
    return ((F.col("alarm_1") == 0) & (F.col("alarm_2") == 0) & (F.col("alarm_3") == 0)
            & (F.col("fault_code") == 0))


RFC3339 = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})")


def _parse_time(text) -> datetime | None:
    if text is None or text == "":
        return None
    if isinstance(text, datetime):
        return text if text.tzinfo else text.replace(tzinfo=timezone.utc)
    if isinstance(text, date):
        return datetime(text.year, text.month, text.day, tzinfo=timezone.utc)
    if not RFC3339.fullmatch(str(text)):      # anything else is ignored (F4)
        return None
    try:
        return datetime.fromisoformat(str(text).replace("Z", "+00:00"))
    except ValueError:
        return None


def _parse_int(text, default: int) -> int:
    try:
        value = int(str(text))
    except (TypeError, ValueError):
        return default
    return value if value > 0 else default


@dataclass(frozen=True)
class RecordFilter:
    """Optional predicates + paging of the record listing."""
    device_id: str = ""
    fault_code: int | None = None
    start: datetime | None = None
    end: datetime | None = None
    limit: int = DEFAULT_LIMIT
    offset: int = DEFAULT_OFFSET

    @classmethod
    def from_params(cls, params: dict) -> "RecordFilter":
        """Request parameters: limit 100, offset 0; <=0 or non-numeric -> default;
        a bad fault code or time is ignored."""
        fc = params.get("fault_code")
        try:
            fault = int(str(fc)) if fc not in (None, "") else None
        except ValueError:
            fault = None
        offset = params.get("offset")
        try:
            off = int(str(offset)) if offset not in (None, "") else DEFAULT_OFFSET
        except ValueError:
            off = DEFAULT_OFFSET
        return cls(device_id=str(params.get("device_id") or ""), fault_code=fault,
                   start=_parse_time(params.get("start_time")),
                   end=_parse_time(params.get("end_time")),
                   limit=_parse_int(params.get("limit"), DEFAULT_LIMIT),
                   offset=off if off > 0 else DEFAULT_OFFSET)

    def predicate(self, ts: str = "ts") -> Column:
        cond = F.lit(True)
        if self.device_id:
            cond = cond & (F.col("device_id") == F.lit(self.device_id))
        if self.fault_code is not None:
            if self.fault_code == 0:
                cond = cond & is_normal()
            elif self.fault_code > 0:
                cond = cond & is_fault()
            else:
                cond = cond & F.lit(False)
        if self.start is not None:
            cond = cond & (F.col(ts) >= F.lit(self.start).cast("timestamp"))
        if self.end is not None:
            cond = cond & (F.col(ts) <= F.lit(self.end).cast("timestamp"))
        return cond

    def date_predicate(self, col: str = "ts_date") -> Column | None:
        """Partition predicate implied by the time range (prunes date folders)."""
        cond = None
        if self.start is not None:
            cond = F.col(col) >= F.lit(self.start.astimezone(timezone.utc).date())
        if self.end is not None:
            c = F.col(col) <= F.lit(self.end.astimezone(timezone.utc).date())
            cond = c if cond is None else cond & c
        return cond


def filtered(readings: DataFrame, flt: RecordFilter) -> DataFrame:
    df = readings
    if "ts_date" in df.columns:
        dp = flt.date_predicate()
        if dp is not None:
            df = df.where(dp)
    return df.where(flt.predicate())


def newest_first(df: DataFrame, ts: str = "ts", tie: str = "request_id") -> list[Column]:
    return [F.col(ts).desc(), F.col(tie).asc()]


def query_records(readings: DataFrame, flt: RecordFilter) -> DataFrame:
    """Filtered rows, newest first, then offset and limit."""
    df = filtered(readings, flt).orderBy(*newest_first(readings))
    if flt.offset > 0:
        df = df.offset(flt.offset)
    return df.limit(flt.limit) if flt.limit > 0 else df


def count_records(readings: DataFrame, flt: RecordFilter) -> DataFrame:
    """Count with the same filter, whole range (G1, Q7)."""
    return filtered(readings, flt).agg(F.count("*").alias("total"))


def page(readings: DataFrame, page_no: int, size: int) -> DataFrame:
    """Rows of one page, newest first."""
    page_no = max(int(page_no), 1)
    return (readings.orderBy(*newest_first(readings))
            .offset((page_no - 1) * size).limit(size))


def _slots(table) -> list[tuple[datetime, int]]:
    """Rows by hour of a stored table, newest first, from its manifest: (start of the hour, rows)."""
    rows: dict[datetime, int] = {}
    for p in table.parts():
        for hour, n in enumerate(p.hours):
            if n and p.date is not None:
                at = datetime.combine(date.fromisoformat(p.date), time(hour), timezone.utc)
                rows[at] = rows.get(at, 0) + n
    return sorted(rows.items(), reverse=True)


def _window(slots: list[tuple[datetime, int]], width: timedelta, first: int, last: int):
    """The time span of rows ``first`` to ``last`` (exclusive) of the slots, newest first.

    Returns ``(start, end, rows before the span, rows in it)``; ``end`` is exclusive.
    """
    at, before, start, end, inside = 0, 0, None, None, 0
    for begin, n in slots:
        if at + n > first and at < last:
            if end is None:
                end, before = begin + width, at
            start, inside = begin, inside + n
        at += n
    return start, end, before, inside


PAGE_RANGE = 200_000     # rows of a range beyond which it is counted more finely


def page_of(table, page_no: int, size: int) -> DataFrame:
    """Rows of one page of a stored table, newest first, however deep.

    The manifest's rows by hour say which hours hold the page; if those hold many
    rows, only their time column is counted by minute and then by second.  The
    range found is all that is read, sorted and skipped through.  Rows without a
    time are on no page.
    """
    first = (max(int(page_no), 1) - 1) * size
    start, end, before, inside = _window(_slots(table), timedelta(hours=1), first, first + size)
    if start is None:
        return table.of_parts([])
    for unit, width in (("minute", timedelta(minutes=1)), ("second", timedelta(seconds=1))):
        if inside <= PAGE_RANGE + size:
            break
        within = table.read(start=start, end=end - timedelta(microseconds=1))
        counts = within.groupBy(F.unix_seconds(F.date_trunc(unit, table.time)).alias("t")).agg(F.count("*").alias("n"))
        slots = sorted(((datetime.fromtimestamp(r["t"], timezone.utc), r["n"]) for r in counts.collect()), reverse=True)
        start, end, skipped, inside = _window(slots, width, first - before, first - before + size)
        before += skipped
    rows = table.read(start=start, end=end - timedelta(microseconds=1))
    return rows.orderBy(*newest_first(rows, table.time)).offset(first - before).limit(size)


LISTING_ROWS = 1_000_000     # rows of a range of an unbounded listing, about


def in_order(table, condition: Column, rows_per_range: int = LISTING_ROWS) -> DataFrame:
    """All rows of a stored table that meet ``condition``, newest first over its partitions.

    The manifest's rows by hour cut the time into ranges of about equal size, so rows
    are dealt to their range straight away and sorted inside it: no sampling pass
    over the rows and no task with all of them.  An hour that holds many ranges is
    cut evenly.
    """
    bounds, held = [], 0
    for begin, n in _slots(table):
        pieces = -(-n // rows_per_range)
        if held and held + n > rows_per_range or pieces > 1:
            bounds.append(begin + timedelta(hours=1))
            held = 0
        bounds += [begin + timedelta(hours=1) * (pieces - i) / pieces for i in range(1, pieces)]
        held = held + n if pieces == 1 else 0
    bounds = sorted(set(bounds), reverse=True)
    rows = table.read().where(condition)
    if not bounds:
        return rows.coalesce(1).sortWithinPartitions(*newest_first(rows, table.time))
    cuts = F.array(*[F.lit(micros(b)).cast("bigint") for b in bounds])
    later = F.size(F.filter(cuts, lambda b: b > F.unix_micros(table.time)))      # 0: the newest range
    later = F.when(F.col(table.time).isNull(), len(bounds)).otherwise(later)     # no time: last
    return (rows.repartitionById(len(bounds) + 1, later.cast("int"))
            .sortWithinPartitions(*newest_first(rows, table.time)))


def page_meta(readings: DataFrame, page_no: int, size: int) -> DataFrame:
    """page, limit, count, total, total_pages, has_prev, has_next (W2), one pass."""
    page_no = max(int(page_no), 1)
    total = F.count("*")
    first = (page_no - 1) * size
    pages = F.ceil(total / F.lit(size)).cast("bigint")
    return readings.agg(
        F.lit(page_no).cast("bigint").alias("page"),
        F.lit(size).cast("bigint").alias("limit"),
        F.greatest(F.least(total - F.lit(first), F.lit(size)), F.lit(0)).cast("bigint").alias("count"),
        total.alias("total"),
        pages.alias("total_pages"),
        F.lit(page_no > 1).alias("has_prev"),
        (F.lit(page_no) < pages).alias("has_next"))


def latest(readings: DataFrame, n: int, only_faults: bool = False) -> DataFrame:
    """Latest N rows; with ``only_faults`` rows with fault_code > 0."""
    df = readings.where(F.col("fault_code") > 0) if only_faults else readings
    return df.orderBy(*newest_first(readings)).limit(n)


def active_faults(table) -> DataFrame:
    """Fault rows of a stored table: time, code, voltage, power, temperature, newest first."""
    return in_order(table, is_fault()).select("request_id", "ts", "fault_code", "pv1_voltage", "total_output_power",
                                              "inverter_temp")


def latest_per_code(readings: DataFrame, k: int = LATEST_PER_CODE) -> DataFrame:
    """Latest k fault rows per fault code.

    Kept in the ``row_number() <= k`` shape so the planner adds a partial
    WindowGroupLimit before the shuffle: every map task forwards at most k rows
    per code, so a code holding most rows costs no more than a rare one.
    """
    w = Window.partitionBy("fault_code").orderBy(F.col("ts").desc(), F.col("request_id").asc())
    return (readings.where(is_fault())
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= k))


def fault_dim(spark: SparkSession) -> DataFrame:
    """Fault dimension, code order (S13): literals of the plan, no scan."""
    rows = [F.struct(F.lit(code).cast("bigint").alias("code"),
                     *[F.lit(text).alias(name) for name, text in zip(FAULT_DIM_COLUMNS[1:], texts)])
            for code, *texts in FAULT_CODES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fault_stats(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Rows per fault code with the fault's attributes, largest first.

    The dimension has 11 fixed rows; it is broadcast, the readings side is
    aggregated (partial + final) before the join, so the join sees one row per code.
    """
    counts = readings.groupBy("fault_code").agg(F.count("*").alias("count"))
    dim = F.broadcast(fault_dim(spark))
    return (counts.join(dim, counts.fault_code == dim.code, "left")
            .select("fault_code", "count", "name", "severity", "description", "action")
            .orderBy(F.col("count").desc(), F.col("fault_code")))


def fault_codes(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """The fault list with how many readings carry each code (S13, 0 when none)."""
    counts = readings.groupBy("fault_code").agg(F.count("*").alias("readings"))
    dim = fault_dim(spark)
    return (dim.join(counts.withColumnRenamed("fault_code", "code"), "code", "left")
            .select("code", "name", "description", "severity", "action",
                    F.coalesce("readings", F.lit(0)).cast("bigint").alias("readings"))
            .orderBy("code"))


def fault_totals(readings: DataFrame) -> DataFrame:
    """Fault rows per code plus the total across codes, in one rollup."""
    return (readings.where(is_fault())
            .rollup("fault_code")
            .agg(F.count("*").alias("n"), F.grouping("fault_code").cast("boolean").alias("is_total")))


def device_power(readings: DataFrame) -> DataFrame:
    """Rows and mean power per device.

    The sum is taken over exact milliwatt integers and divided once, so the
    result does not depend on the order partial sums are combined in.
    """
    milli = F.round(F.col("total_output_power") * 1000).cast("bigint")
    return (readings.groupBy("device_name")
            .agg(F.count("*").alias("n"), F.sum(milli).alias("power_milli"))
            .withColumn("avg_power", F.col("power_milli") / F.col("n") / F.lit(1000.0)))


def total_count(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count("*").alias("total"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Expose frames to SQL; ``inverter_data`` gains the ``time`` alias of ``ts``."""
    names = []
    for name, df in tables.items():
        if name == MEASUREMENT and "time" not in df.columns:
            df = df.withColumn("time", F.col("ts"))
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Ad-hoc SQL over the registered views."""
    return spark.sql(text)


def list_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """``SHOW TABLES`` restricted to ``names`` when given."""
    df = spark.sql("SHOW TABLES").select("tableName", "isTemporary")
    if names:
        df = df.where(F.col("tableName").isin(*names))
    return df
