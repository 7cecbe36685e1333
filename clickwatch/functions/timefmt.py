"""ISO-8601 text to instant and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickwatch.constants import ISO_FORMAT

_FULL_DATE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
# Accepted next to what a plain cast understands.
_OTHER_FORMS = ("yyyyMMdd'T'HHmmssX", "yyyyMMdd'T'HHmmX", "yyyy-MM-dd HH:mmX", "yyyy-MM-dd'T'HH:mmX")


def parse_utc(text: Column) -> Column:
    """Instant of an ISO text ending in `Z`, NULL for anything else."""
    canonical = F.when(text.rlike(_FULL_DATE), F.try_to_timestamp(text))
    others = [F.try_to_timestamp(text, F.lit(form)) for form in _OTHER_FORMS]
    return F.when(text.endswith("Z"), F.coalesce(canonical, *others))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)
