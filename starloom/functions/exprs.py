"""Column expressions of the warehouse: pure functions from Column to Column.

Everything here stays inside Catalyst (no Python UDF), so it is code-generated
and runs next to the scan.  Dirty input is handled with ``try_*`` functions
because Spark 4 runs in ANSI mode, where a bad cast raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Text values that the staging cleaner turns into NULL.
NULL_TOKENS = ("", "nan")

# Injury categorisation: ordered keyword rules, first match wins; substring
# match on the lower-cased reason; anything else is ("Other", "Low").
INJURY_RULES = (
    (("muscle", "strain", "tear"), ("Muscular", "Medium")),
    (("fracture", "break", "rupture"), ("Bone/Ligament", "High")),
    (("ankle", "knee", "hip"), ("Joint", "Medium")),
)
INJURY_DEFAULT = ("Other", "Low")

# Seeded transfer types: (code, name, is_free, is_loan).
TRANSFER_TYPES = (
    ("PERMANENT", "Permanent Transfer", False, False),
    ("FREE", "Free Transfer", True, False),
    ("LOAN", "Loan", False, True),
    ("END_LOAN", "End of Loan", False, False),
    ("LOAN_RETURN", "Return from Loan", False, False),
    ("UNKNOWN", "Unknown", False, False),
)

# Defaults used by the dimension builders.
UNKNOWN_TEXT = "Unknown"
UNKNOWN_TIER = 99
# Season boundary: a season starts on July 1.
SEASON_START_MONTH = 7
# Two-digit season years at or above this pivot are 19xx, below it 20xx.
SEASON_CENTURY_PIVOT = 50
# Open end of an SCD2 validity interval, for range tests.
OPEN_VALID_TO = "9999-12-31 00:00:00"

# ---------------------------------------------------------------------------
# Our own defaults for formulas the reference leaves open (named as ours).
# ---------------------------------------------------------------------------

# Severity score 1..5 from days missed: <=7, <=28, <=90, <=180, more.
SEVERITY_THRESHOLDS = (7, 28, 90, 180)
# Date formats accepted by the lenient date parser, tried in order.
LENIENT_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MMM d, yyyy", "yyyy-MM-dd HH:mm:ss",
                        "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F1, F2, F3 -------------------------------------------------------------

def first_digits_or(c: ColumnOrName, default: int = UNKNOWN_TIER) -> Column:
    """first run of digits as an int, ``default`` when there is none."""
    return F.coalesce(F.regexp_substr(_c(c), F.lit("[0-9]+")).try_cast("int"), F.lit(default))


def or_unknown(c: ColumnOrName, default: str = UNKNOWN_TEXT) -> Column:
    """COALESCE with a text default."""
    return F.coalesce(_c(c), F.lit(default))


# --- F6 ---------------------------------------------------------------------

def slug(c: ColumnOrName) -> Column:
    """lower case, blanks to underscores."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))


# --- F7 ---------------------------------------------------------------------

def row_hash(*cols: ColumnOrName, sep: str = "") -> Column:
    """MD5 over the text of the columns, NULL as ''.

    With ``sep=''`` this equals the reference's hash (and DuckDB's md5 of the
    same concatenation); a separator avoids ('ab','c') == ('a','bc').
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts) if sep else F.concat(*parts))


# --- F8 ---------------------------------------------------------------------

def season_years(c: ColumnOrName, pivot: int = SEASON_CENTURY_PIVOT) -> Column:
    """F8: parse a season name to struct(start_year, end_year).

    'YY/YY' → two-digit pivot (>= pivot → 19xx), end = start + 1; a plain
    year 'YYYY' → (y, y + 1); anything else → NULLs.
    """
    s = _c(c)
    parts = F.split(s, "/", -1)
    y1 = F.trim(F.get(parts, 0)).try_cast("int")
    y2 = F.trim(F.get(parts, 1)).try_cast("int")
    two_digit = F.when(y1 >= pivot, y1 + 1900).otherwise(y1 + 2000)
    start = (
        F.when(s.contains("/"), F.when(y1.isNotNull() & y2.isNotNull(), two_digit))
        .otherwise(F.trim(s).try_cast("int"))
    )
    return F.struct(start.alias("start_year"), (start + 1).alias("end_year"))


# --- F9 ---------------------------------------------------------------------

def categorize(c: ColumnOrName, rules=INJURY_RULES, default=INJURY_DEFAULT) -> Column:
    """ordered keyword rules → struct(category, severity); first match wins."""
    low = F.lower(_c(c))
    cat = None
    sev = None
    for words, (category, severity) in rules:
        cond = None
        for w in words:
            hit = low.contains(w)
            cond = hit if cond is None else (cond | hit)
        cat = F.when(cond, F.lit(category)) if cat is None else cat.when(cond, F.lit(category))
        sev = F.when(cond, F.lit(severity)) if sev is None else sev.when(cond, F.lit(severity))
    cat = cat.otherwise(F.lit(default[0]))
    sev = sev.otherwise(F.lit(default[1]))
    return F.struct(cat.alias("category"), sev.alias("severity"))


# --- F10..F14, B1 columns ----------------------------------------------------

def date_key(d: ColumnOrName) -> Column:
    """T4: yyyyMMdd integer key of a date; NULL stays NULL."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(d: ColumnOrName) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def is_weekend(d: ColumnOrName) -> Column:
    """F13."""
    return F.dayofweek(_c(d)).isin(1, 7)


def season_of(d: ColumnOrName, start_month: int = SEASON_START_MONTH) -> Column:
    """'YY/YY' season of a date; the season starts on ``start_month``/1."""
    d = _c(d)
    y = F.year(d)
    first = F.when(F.month(d) >= start_month, y).otherwise(y - 1)
    two = lambda v: F.substring(v.cast("string"), 3, 2)
    return F.concat(two(first), F.lit("/"), two(first + 1))


def calendar_columns(d: ColumnOrName) -> list[Column]:
    """All attribute columns of a dim_date row for date column ``d``."""
    d = _c(d)
    return [
        date_key(d).alias("date_sk"),
        d.alias("date_value"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        day_of_week0(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
        season_of(d).alias("season_name"),
    ]


# --- F15, F16, P15 -----------------------------------------------------------

def null_if_blank(c: ColumnOrName, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """The text tokens '' and 'nan' become NULL."""
    c = _c(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def lenient_date(c: ColumnOrName, formats: Sequence[str] = LENIENT_DATE_FORMATS) -> Column:
    """first format that parses wins, failures are NULL."""
    c = _c(c).cast("string")
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def epoch_to_date(c: ColumnOrName) -> Column:
    """F16: epoch seconds → date, read as UTC whatever the session zone."""
    return F.date_from_unix_date(F.floor(_c(c) / 86400).cast("int"))


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC (inverse of F16)."""
    ts = _c(ts)
    return (F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts)).cast("long")


# --- F19..F26 ----------------------------------------------------------------

def rate(num: ColumnOrName, den: ColumnOrName, scale: int = 4, times: int = 1) -> Column:
    """``num * times / den`` as decimal(10, scale), rounded half away from zero.

    NULL when the denominator is 0 or NULL, and where the quotient has more
    digits than the declared column holds.
    """
    top = _c(num).cast("decimal(18,2)") * F.lit(times).cast("decimal(3,0)")
    return (top / F.nullif(_c(den).cast("decimal(15,2)"), F.lit(0))).try_cast(f"decimal(10,{scale})")


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """(new - old) / old * 100 as decimal(10,4); NULL when old is 0/NULL."""
    return rate(_c(new) - _c(old), old, times=100)


def severity_score(days: ColumnOrName, thresholds: Sequence[int] = SEVERITY_THRESHOLDS) -> Column:
    """1..len(thresholds)+1 ladder over days missed; NULL stays NULL."""
    days = _c(days)
    out = None
    for i, t in enumerate(thresholds, start=1):
        out = F.when(days <= t, F.lit(i)) if out is None else out.when(days <= t, F.lit(i))
    return out.when(days.isNotNull(), F.lit(len(thresholds) + 1))


def chemistry_score(joint: ColumnOrName, minutes: ColumnOrName) -> Column:
    """F25 (our default): joint goal participations per 90 shared minutes."""
    return rate(joint, minutes, times=90)


def status_label(n: ColumnOrName, ok: str = "OK", empty: str = "EMPTY") -> Column:
    """OK when the count is positive."""
    return F.when(_c(n) > 0, F.lit(ok)).otherwise(F.lit(empty))


def failure_label(n: ColumnOrName, severity: ColumnOrName) -> Column:
    """the check's severity (INFO, WARNING, ERROR) when something failed, else OK."""
    return F.when(_c(n) > 0, _c(severity)).otherwise(F.lit("OK"))


def to_money(c: ColumnOrName, precision: int = 15, scale: int = 2) -> Column:
    """Exact decimal for money columns so sums are order-independent."""
    return _c(c).cast(f"decimal({precision},{scale})")
