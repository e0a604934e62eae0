"""Event dates."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_timestamp(text: Column) -> Column:
    """Timestamp in UTC of any ISO date or date-time; NULL for everything else.

    A time of day alone is not a date: the text must begin with a four-digit year.
    """
    return F.try_to_timestamp(F.when(text.rlike(r"^\s*\d{4}"), text))


def event_year(text: Column) -> Column:
    return F.year(event_timestamp(text))
