"""Small native string/date/JSON helpers (URL key, slug, digit runs, dates,
log-line fields, JSON attributes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Snapshot folder/stamp formats and the log-line layout
# ``asctime - name - level - file:line - func - message``.
DATE_DIR_FORMAT = "yyyyMMdd"
DATE_COLUMN_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
STAMP_SHAPE = r"^\d{8}_([01]\d|2[0-3])[0-5]\d[0-5]\d$"
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
LOG_LINE_PATTERN = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) - (.*?) - ([A-Z]+) - "
                    r"([^:\s]+):(\d+) - (\S+) - (.*)$")
LOG_FIELDS = ["logged_at", "logger", "level", "file", "line", "func", "message"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_key(url: Column | str, position: int = -2) -> Column:
    """Path segment by position (1-based, negative from the end); NULL if absent.

    ``…/produtos/rucula-70-g/`` → ``rucula-70-g`` for the default -2.
    """
    return F.try_element_at(F.split(_col(url), "/"), F.lit(position))


def slug(text: Column | str) -> Column:
    """File-name form of a category: blanks → ``_``, colons removed."""
    return F.replace(F.replace(_col(text), F.lit(" "), F.lit("_")), F.lit(":"), F.lit(""))


def digit_runs(text: Column | str) -> Column:
    """All ASCII-or-Unicode digit runs as BIGINTs (``1.234`` → [1, 234])."""
    runs = F.regexp_extract_all(_col(text), F.lit(r"(?U)(\d+)"), 1)
    return F.transform(runs, lambda x: x.try_cast("bigint"))


def max_digit_run(text: Column | str) -> Column:
    """Largest digit run in a text, NULL when there is none (result counter)."""
    return F.array_max(digit_runs(text))


# How shops group the digits of a large number, by threes after a dot, a blank
# or a no-break blank.
GROUPED_NUMBER = r"\d{1,3}(?:[. \u00a0\u202f]\d{3})+(?!\d)|\d+"


def max_grouped_number(text: Column | str) -> Column:
    """Largest number in a text whose thousands may be marked (``216 de 1.234`` → 1234); NULL
    when there is none.  ``max_digit_run`` reads 234 there and stays as the original did."""
    found = F.regexp_extract_all(_col(text), F.lit(GROUPED_NUMBER), 0)
    return F.array_max(F.transform(found, lambda x: F.regexp_replace(x, r"\D", "").try_cast("bigint")))


def parse_dir_date(text: Column | str) -> Column:
    return F.try_to_date(_col(text), DATE_DIR_FORMAT)


def parse_column_date(text: Column | str) -> Column:
    return F.try_to_date(_col(text), DATE_COLUMN_FORMAT)


def parse_stamp(text: Column | str) -> Column:
    """``20241113_173405`` → TIMESTAMP_NTZ (wall clock, as written).

    Built from its parts, so no session time zone is involved: an hour that a
    clock change skips stays as it is.  Anything else is NULL.
    """
    t = _col(text)
    part = lambda at, n: F.substring(t, at, n).try_cast("int")
    made = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(10, 2), part(12, 2),
                                    part(14, 2).cast("decimal(16,6)"))
    return F.when(t.rlike(STAMP_SHAPE), made)


def format_dir_date(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_DIR_FORMAT)


def format_column_date(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_COLUMN_FORMAT)


def format_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), STAMP_FORMAT)


def log_fields(line: Column | str) -> list[Column]:
    """Six fields (+ message) of a log line; non-matching lines give NULLs."""
    ln = _col(line)
    ok = ln.rlike(LOG_LINE_PATTERN)
    out = []
    for i, name in enumerate(LOG_FIELDS, start=1):
        v = F.regexp_extract(ln, LOG_LINE_PATTERN, i)
        if name == "line":
            v = v.try_cast("bigint")
        out.append(F.when(ok, v).alias(name))
    return out


def attribute_present(attr: Column | str) -> Column:
    """Truthy attribute: present and non-empty."""
    a = _col(attr)
    return a.isNotNull() & (a != "")


def json_fields(attr: Column | str, ddl: str) -> Column:
    """Typed struct out of a JSON attribute; absent/empty/bad JSON → NULL fields.

    An empty attribute is treated as absent (the original tool's truthiness
    test).  Apostrophes need no escaping: Spark's JSON reader accepts them.
    """
    a = _col(attr)
    return F.when(attribute_present(a), F.from_json(a, ddl))
