"""Enrolment spells: current spell, first admission, conversions, renewals, attendance.

Every per-child step combines before it shuffles.  No step sorts or collects all spells of one
child in a task: what reaches a window is at most one row per child and calendar day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions import dates
from cohortline.operators.keys import first_per_key
from cohortline.operators.running import max_before
from cohortline.session import staged

# Fixed values.
LOOKBACK_DAYS = 10  # how long ago a new admission may have started
AHEAD_DAYS = 14  # how far ahead a spell may start and still be current
RENEWAL_ACTION = 15


def _is_current(as_of: dt.date) -> Column:
    """Live, not ended, starting no later than the month of ``as_of`` plus two weeks.

    A spell that ends on ``as_of`` has ended: its end is the midnight that the day begins with.
    """
    horizon = dates.month_after(as_of + dt.timedelta(days=AHEAD_DAYS))
    return (
        dates.is_live("start_dt", "end_dt")
        & dates.ends_after("end_dt", as_of)
        & (F.col("start_dt") < F.lit(horizon))
    )


def current_spell(spells: DataFrame, as_of: dt.date) -> DataFrame:
    """Spells that end when the last current spell of their child ends; ties are all kept."""
    latest = (
        spells.filter(_is_current(as_of))
        .groupBy("child_id")
        .agg(F.max(dates.open_end("end_dt")).alias("latest_end"))
        .withColumnRenamed("child_id", "latest_child_id")
    )
    # The latest end lies after as_of, so older spells need not take part in the join.
    reachable = spells.filter(dates.ends_after("end_dt", as_of))
    return reachable.join(
        latest,
        (F.col("child_id") == F.col("latest_child_id"))
        & (dates.open_end("end_dt") == F.col("latest_end")),
        "left_semi",
    )


def _ended_recently_before(start: Column, prior_end: Column) -> Column:
    """A prior end in the month before ``start`` or later: then ``start`` is no new admission."""
    return prior_end >= F.trunc(F.add_months(start, -1), "MM")


def first_admission(spells: DataFrame) -> DataFrame:
    """Spells without an earlier live spell of the same child that ended recently.

    Stands for a NOT EXISTS over pairs of spells: the latest end among earlier starts decides, so
    a running maximum over one row per child and day replaces the pairs.  A spell without a start
    is earlier than none, and none is earlier than it.
    """
    live_end = F.when(dates.is_live("start_dt", "end_dt"), dates.open_end("end_dt"))
    started = spells.filter(F.col("start_dt").isNotNull())
    by_day = started.groupBy("child_id", "start_dt").agg(F.max(live_end).alias("day_end"))
    earlier = Window.partitionBy("child_id").orderBy("start_dt").rowsBetween(Window.unboundedPreceding, -1)
    returning = (
        by_day.withColumn("prior_end", F.max("day_end").over(earlier))
        .filter(_ended_recently_before(F.col("start_dt"), F.col("prior_end")))
        .select("child_id", "start_dt")
    )
    return spells.join(returning, ["child_id", "start_dt"], "left_anti")


def first_admission_by_moment(spells: DataFrame, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """``first_admission`` of spells that begin at moments instead of on days.

    A spell that begins an hour earlier on the same day is earlier.  A child may have any number of moments, so the running
    maximum goes over ranges of them (``running.max_before``).  The anti-join is on child and moment, which spreads a hot child as well.
    """
    lived = F.col(end).isNull() | (F.col(end) > F.col(start))
    last = F.when(lived, F.coalesce(F.col(end), F.lit(dates.OPEN_END).cast("timestamp_ntz")))
    prior = max_before(spells.withColumn("_last", last), "child_id", start, "_last", "spell-moments")
    month = F.trunc(F.add_months(F.col(start), -1), "MM").cast("timestamp_ntz")
    returning = prior.filter(F.col("prior") >= month).select("child_id", start)
    return spells.join(returning, ["child_id", start], "left_anti").select(*spells.columns)


def admission_window(as_of: dt.date, lookback_days: int = LOOKBACK_DAYS) -> Column:
    """Started in the window, not cancelled, and no early leaver.

    An early leaver ends before the month that follows the start by two weeks.
    """
    stays = F.add_months(F.trunc(F.date_add("start_dt", AHEAD_DAYS), "MM"), 1)
    return (
        (F.col("start_dt") >= F.lit(as_of - dt.timedelta(days=lookback_days)))
        & dates.is_live("start_dt", "end_dt")
        & (F.col("end_dt").isNull() | (F.col("end_dt") >= stays))
    )


def new_admissions(spells: DataFrame, as_of: dt.date, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Current spells in the admission window that are first admissions.

    Same rows as ``current_spell``, ``first_admission`` and ``admission_window`` together, from
    one aggregate over the spells: starts before the window fall into one bucket per child,
    as every one of them is earlier than any start in the window.
    """
    window_start = as_of - dt.timedelta(days=lookback_days)
    bucket = F.greatest(F.col("start_dt"), F.lit(window_start - dt.timedelta(days=1)))
    by_bucket = (
        spells.filter(F.col("start_dt").isNotNull() & dates.is_live("start_dt", "end_dt"))
        .groupBy(F.col("child_id").alias("history_child_id"), bucket.alias("bucket_dt"))
        .agg(
            F.max(dates.open_end("end_dt")).alias("bucket_end"),
            F.max(F.when(_is_current(as_of), dates.open_end("end_dt"))).alias("bucket_current_end"),
        )
    )
    child = Window.partitionBy("history_child_id")
    earlier = child.orderBy("bucket_dt").rowsBetween(Window.unboundedPreceding, -1)
    admitted = (
        by_bucket.withColumn("prior_end", F.max("bucket_end").over(earlier))
        .withColumn("latest_end", F.max("bucket_current_end").over(child))
        .filter(F.col("bucket_dt") >= F.lit(window_start))
        .filter(
            F.col("prior_end").isNull()
            | ~_ended_recently_before(F.col("bucket_dt"), F.col("prior_end"))
        )
    )
    candidates = spells.filter(admission_window(as_of, lookback_days)).filter(
        dates.ends_after("end_dt", as_of)
    )
    return candidates.join(
        admitted,
        (F.col("child_id") == F.col("history_child_id"))
        & (F.col("start_dt") == F.col("bucket_dt"))
        & (dates.open_end("end_dt") == F.col("latest_end")),
        "left_semi",
    )


def spell_conversions(spells: DataFrame, quotes: DataFrame, as_of: dt.date) -> DataFrame:
    """Spells that started by the month of ``as_of``, each with its quote."""
    started = spells.filter(F.col("start_dt") < F.lit(dates.month_after(as_of)))
    return started.join(quotes, "quote_id").select(
        "child_id", "service_id", "start_dt", F.col("modified_ts").alias("converted_ts")
    )


def latest_conversion(spells: DataFrame, quotes: DataFrame, as_of: dt.date) -> DataFrame:
    """The most recently modified conversion of each child; the higher service id wins a tie."""
    order = [F.desc("converted_ts"), F.desc("service_id")]
    return first_per_key(spell_conversions(spells, quotes, as_of), ["child_id"], order)


def children_enrolled_in(spells: DataFrame, year: int) -> DataFrame:
    """Children with a live spell that touches the year, once each."""
    touching = spells.filter(
        dates.is_live("start_dt", "end_dt") & dates.lasts_into_year("start_dt", "end_dt", year)
    )
    return touching.select("child_id").distinct()


def with_enrolled_flag(rows: DataFrame, spells: DataFrame, year: int) -> DataFrame:
    """Whether the child of each row had a live spell in the year.

    The children are staged, so that Spark broadcasts them if they are few and can split the
    rows of a hot child if they are not.
    """
    children = staged(children_enrolled_in(spells, year), "enrolled")
    marked = rows.join(children.withColumn("enrolled", F.lit(True)), "child_id", "left")
    return marked.withColumn("enrolled", F.coalesce("enrolled", F.lit(False)))


def first_renewal_action(actions: DataFrame, year: int) -> DataFrame:
    """First renewal action of each child for a year: from July of the year before to February."""
    in_band = (F.col("action_ts") >= dates.midnight(dt.date(year - 1, 7, 1))) & (
        F.col("action_ts") < dates.midnight(dt.date(year, 3, 1))
    )
    renewals = actions.filter((F.col("action_id") == RENEWAL_ACTION) & (F.col("period") == year) & in_band)
    return renewals.groupBy("child_id", "period").agg(F.min("action_ts").alias("first_action_ts"))


def renewal_first_action(actions: DataFrame, spells: DataFrame, as_of: dt.date) -> DataFrame:
    """First renewal action for the year of ``as_of``, for children enrolled in the year before.

    Actions are combined per child before the semi-join.
    """
    first = first_renewal_action(actions, as_of.year)
    return first.join(children_enrolled_in(spells, as_of.year - 1), "child_id", "left_semi")


def child_facts(spells: DataFrame, quotes: DataFrame, actions: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest conversion, first renewal action and last year's enrolment, one row per child.

    One join of spells and quotes and one aggregate give both facts of the spells.  A renewal
    action counts for children enrolled last year, which the combined row knows.
    """
    live_last_year = dates.is_live("start_dt", "end_dt") & dates.lasts_into_year("start_dt", "end_dt", as_of.year - 1)
    of_spells = spells.join(quotes.select("quote_id", "modified_ts"), "quote_id", "left").select(
        "child_id",
        F.when(F.col("start_dt") < F.lit(dates.month_after(as_of)), F.col("modified_ts")).alias("converted_ts"),
        F.lit(None).cast("timestamp_ntz").alias("first_action_ts"),
        live_last_year.alias("enrolled_last_year"),
    )
    of_actions = first_renewal_action(actions, as_of.year).select(
        "child_id",
        F.lit(None).cast("timestamp_ntz").alias("converted_ts"),
        "first_action_ts",
        F.lit(None).cast("boolean").alias("enrolled_last_year"),
    )
    facts = ["converted_ts", "first_action_ts", "enrolled_last_year"]
    combined = of_spells.unionByName(of_actions).groupBy("child_id").agg(*[F.max(f).alias(f) for f in facts])
    return combined.withColumn("first_action_ts", F.when(F.col("enrolled_last_year"), F.col("first_action_ts")))


def with_last_enrollment(rows: DataFrame, spells: DataFrame, quotes: DataFrame, as_of: dt.date) -> DataFrame:
    """Last enrolment of each row: its quote's change, else its child's latest conversion, else its start.

    The conversions are staged, so that Spark can split the rows of a hot child.
    """
    converted = staged(latest_conversion(spells, quotes, as_of).select("child_id", "converted_ts"), "conversions")
    joined = rows.join(quotes.select("quote_id", "modified_ts"), "quote_id", "left").join(converted, "child_id", "left")
    latest = last_enrollment_ts(F.col("modified_ts"), F.col("converted_ts"), F.col("start_dt"))
    return joined.withColumn("last_enrollment_ts", latest).drop("modified_ts", "converted_ts")


def attendance_days(attendance: DataFrame) -> DataFrame:
    """Attended days per service: any of the three flags set."""
    attended = (F.col("day_flag") == 1) | (F.col("retail_flag") == 1) | (F.col("night_flag") == 1)
    return attendance.groupBy("service_id").agg(
        F.sum(F.when(attended, 1).otherwise(0)).alias("attendance_days")
    )


def last_enrollment_ts(quote_ts: Column, conversion_ts: Column, start_dt: Column) -> Column:
    """Quote change, else latest conversion, else the start."""
    return F.coalesce(quote_ts, conversion_ts, start_dt.cast("timestamp_ntz"))


def renewal_ts(
    *,
    is_corporate: Column,
    quote_ts: Column,
    conversion_ts: Column,
    has_renewal: Column,
    history_ts: Column,
    action_ts: Column,
    enrolled_last_year: Column,
    as_of: dt.date,
) -> Column:
    """Renewal date under the rules of the family and of the corporate channel.

    ``has_renewal`` says that a history row or a renewal action exists, whatever its date.
    """
    new_year = dates.midnight(dt.date(as_of.year, 1, 1))
    february = dates.midnight(dt.date(as_of.year, 2, 1))
    enrolled_ts = F.coalesce(quote_ts, conversion_ts)
    no_conversion = dates.midnight(dates.NO_CONVERSION)
    family = F.when(has_renewal, F.coalesce(history_ts, action_ts)).when(enrolled_ts < new_year, enrolled_ts)
    in_january = (enrolled_ts >= new_year) & (enrolled_ts < february)
    corporate = F.when(F.coalesce(enrolled_ts, no_conversion) < new_year, new_year).when(
        in_january & enrolled_last_year, enrolled_ts
    )
    return F.when(is_corporate, corporate).otherwise(family)
