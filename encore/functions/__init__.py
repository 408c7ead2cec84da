"""Scalar expressions shared by the jobs; all are built-in Column expressions
(JVM-side, whole-stage codegen), no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and texts the jobs must reproduce exactly.
EVENT_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
BIRTH_DATE_FORMAT = "yyyy-MM-dd"
ADDRESS_FORMAT = "%s, %s, %s, %s %s-%s %s"   # line1, line2, city, state zip5-zip4 country
NOTICE_SENDER = "tickets@example.com"   # default of a parameter
NOTICE_EMAIL_DOMAIN = "@email.com"
NOTICE_SUBJECT_PREFIX = "Ticket Confirmation ("
NOTICE_SUBJECT_MIDDLE = ") - Event "
NOTICE_BODY_PREFIX = "Your ticket has been "
NOTICE_BODY_SUFFIX = "!"
LIMITED_PERCENT = 20.0            # remaining% at or below which a confirmation is "limited"
TALLY_KEY = "TALLY"
LEADER_KEY = "global"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(price) -> Column:
    """Money as an exact decimal, to a millionth."""
    return col(price).cast("decimal(18,6)")


def money_sum(price) -> Column:
    """Sum of money, exact: decimals are summed and the total is rounded to cents, returned as double.

    Summing doubles directly depends on the order of addition, which differs
    between tasks, retries and engines; decimals do not.
    """
    return F.round(F.sum(amount(price)), 2).cast("double")


def parse_event_time(c, fmt: str = EVENT_DATE_FORMAT) -> Column:
    """Event date text to timestamp; unparseable text (e.g. "today") gives null."""
    return F.try_to_timestamp(col(c), F.lit(fmt))


def parse_birth_date(c) -> Column:
    return F.to_date(F.try_to_timestamp(col(c), F.lit(BIRTH_DATE_FORMAT)))


def born_between(c, first: str, last: str) -> Column:
    """Inclusive birth-date range on ``YYYY-MM-DD`` text; invalid dates are false."""
    d = parse_birth_date(c)
    return F.coalesce(d.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(False))


def format_address(line1="line1", line2="line2", city="citynm", state="state",
                   zip5="zip5", zip4="zip4", country="countrycd") -> Column:
    """``"{line1}, {line2}, {citynm}, {state} {zip5}-{zip4} {countrycd}"``; null parts render empty."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (line1, line2, city, state, zip5, zip4, country)]
    return F.format_string(ADDRESS_FORMAT, *parts)


def stable_id(*cols) -> Column:
    """Deterministic replacement for a random UUID: a SHA-256 of the given
    columns, so a retried task produces the same id."""
    return F.sha2(F.concat_ws("|", *[col(c).cast("string") for c in cols]), 256)


def remaining_percentage(remaining, capacity) -> Column:
    """Percentage of capacity still available; 0 once oversold."""
    r, c = col(remaining).cast("double"), col(capacity).cast("double")
    return F.when(r < 0, F.lit(0.0)).otherwise(r / c * 100)


def notice_recipient(customerid) -> Column:
    return F.concat(col(customerid).cast("string"), F.lit(NOTICE_EMAIL_DOMAIN))


def notice_subject(confirmation_id, eventid) -> Column:
    return F.concat(F.lit(NOTICE_SUBJECT_PREFIX), col(confirmation_id), F.lit(NOTICE_SUBJECT_MIDDLE),
                    col(eventid).cast("string"))


def notice_body(status) -> Column:
    return F.concat(F.lit(NOTICE_BODY_PREFIX), col(status), F.lit(NOTICE_BODY_SUFFIX))
