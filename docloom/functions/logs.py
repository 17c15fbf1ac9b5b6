"""Log-line rendering and parsing, run identifiers, report labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import col, let, one_line

LINE = r"^\[([^\]]+)\] \[([^\]]+)\] \[([^\]]*)\] \[([A-Z_]+)\]"


def field_value(c) -> Column:
    """One value as it is written after ``key=``: '-' for NULL, quoted when needed."""
    return let(F.regexp_replace(col(c).cast("string"), r"\s+", " "), _written)


def _written(t: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit("'")), F.lit('"'))
    return (
        F.when(t.isNull(), F.lit("-"))
        .when(t == "", F.lit('""'))
        .when(t.rlike(r'[\s"=]'), quoted)
        .otherwise(t)
    )


def render_line(ts, run, site, stage, status, url, fields: dict, message) -> Column:
    parts = [
        F.when(col(status) != "", F.concat(F.lit("status="), col(status))),
        F.when(col(url) != "", F.concat(F.lit("url="), col(url))),
    ] + [F.concat(F.lit(f"{k}="), field_value(v)) for k, v in fields.items()]
    head = F.concat(
        F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("] ["), col(run), F.lit("] ["),
        F.coalesce(col(site), F.lit("-")), F.lit("] ["), col(stage), F.lit("]"),
    )
    tail = F.when(col(message) != "", F.concat(F.lit(":: "), one_line(message)))
    return F.concat_ws(" ", head, *parts, tail)


def line_part(line, n: int) -> Column:
    """1 time, 2 run, 3 site, 4 stage; '' when the line has another form."""
    return F.regexp_extract(col(line), LINE, n)


def line_field(line, key: str) -> Column:
    """Value of ``key=``, quotes removed, '' when absent."""
    quoted = F.regexp_extract(col(line), rf'\b{key}="([^"]*)"', 1)
    plain = F.regexp_extract(col(line), rf"\b{key}=(\S+)", 1)
    return F.when(quoted != "", quoted).otherwise(F.btrim(plain, F.lit('"')))


def line_number(line, key: str) -> Column:
    """Digits after ``key=``, NULL when absent."""
    return F.regexp_extract(col(line), rf"\b{key}=([0-9]+)", 1).try_cast("long")


def line_seconds(line) -> Column:
    """``durasi=<n>s`` in seconds, NULL when absent."""
    return F.regexp_extract(col(line), r"durasi=([0-9.]+)s", 1).try_cast("double")


_RUN = r"^RUN-([0-9]{4})([0-9]{2})([0-9]{2})-([0-9]{2})([0-9]{2})([0-9]{2})$"


def is_run_id(run) -> Column:
    return col(run).rlike(_RUN)


def run_date(run) -> Column:
    parts = [F.regexp_extract(col(run), _RUN, i) for i in (1, 2, 3)]
    return F.when(is_run_id(run), F.concat_ws("-", *parts)).otherwise(F.lit(""))


def run_time(run) -> Column:
    parts = [F.regexp_extract(col(run), _RUN, i) for i in (4, 5, 6)]
    return F.when(is_run_id(run), F.concat_ws(":", *parts)).otherwise(F.lit(""))
