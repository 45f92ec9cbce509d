"""Renames, casts, times, constants and column selection."""

from pyspark.sql import functions as F


def quoted(name):
    """A column name that is safe in ``F.col`` even when it holds dots."""
    return "`" + name.replace("`", "``") + "`"


def to_double(column):
    """Text to double; text that is no number becomes NULL instead of failing the job."""
    return F.col(column).try_cast("double") if isinstance(column, str) else column.try_cast("double")


def with_types(df, types):
    """Cast the columns named in ``{name: type}``; text that does not fit becomes NULL."""
    return df.withColumns({name: F.col(quoted(name)).try_cast(t) for name, t in types.items()})


def _whole_seconds(column):
    """Numbers or text such as ``1699164000.0`` to whole seconds; anything else is NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("decimal(38,6)").try_cast("bigint")


def epoch_to_timestamp(column):
    """Epoch seconds to the instant, whatever the session time zone; fractions are cut off."""
    return F.timestamp_seconds(_whole_seconds(column))


def epoch_to_utc_ntz(column):
    """Epoch seconds to UTC wall-clock time without a zone; fractions are cut off."""
    seconds = _whole_seconds(column).try_cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def drop_prefix(df, prefix):
    """Drop every column whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def with_constants(df, **values):
    """Add one constant column per keyword."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def stem(column, extension):
    """The file name without folder and extension, e.g. ``kraken`` for ``…/kraken.json``."""
    return F.regexp_extract(column, r"([^/]+)\." + extension + r"(?:/|$)", 1)


def snapshot_name(key, time):
    """A name per snapshot, e.g. ``kraken_2024-01-31_12-00-00``."""
    return F.concat_ws("_", F.col(key), F.date_format(time, "yyyy-MM-dd_HH-mm-ss"))
