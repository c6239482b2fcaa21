"""Column expressions and plan-time helpers that bring names, times and place keys in one form.

Missing data: an empty field and text that does not parse are NULL inside the engine;
the text ``nan`` in a numeric column is NaN, as a cast gives it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OFFSET = r"([+-]\d{2}:\d{2}|Z)$"
#: ``YYYY-MM-DD HH:MM:SS`` by the place of its signs; the digits are not looked at
SECONDS = r"^.{4}-.{2}-.{2} .{2}:.{2}:.{2}"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: str | Column) -> Column:
    """TIMESTAMP_NTZ of a time text; a trailing offset is dropped, not converted; NULL if it doesn't parse."""
    raw = F.trim(F.regexp_replace(F.trim(F.replace(col(c).cast("string"), F.lit("T"), F.lit(" "))), OFFSET, ""))
    return raw.try_cast("timestamp_ntz")


def standard_time(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a time text, NULL if it doesn't parse."""
    return F.date_format(parse_time(c), "yyyy-MM-dd HH:mm:ss")


def strip_after_seconds(c: str | Column) -> Column:
    """The first 19 characters where the signs stand as in ``YYYY-MM-DD HH:MM:SS``; other texts as they are."""
    bare = F.trim(col(c))
    return F.when(bare.rlike(SECONDS), F.substring(bare, 1, 19)).otherwise(col(c))


def zip_text(c: str | Column) -> Column:
    return col(c).cast("string")


def zip_first_digits(c: str | Column) -> Column:
    """The first run of five digits, else NULL."""
    return F.nullif(F.regexp_extract(col(c).cast("string"), r"(\d{5})", 1), F.lit(""))


def zip_padded(c: str | Column) -> Column:
    """The text before the first point, filled with zeros to five signs; longer ones stay."""
    part = F.substring_index(F.trim(col(c).cast("string")), ".", 1)
    return F.when(F.length(part) >= 5, part).otherwise(F.lpad(part, 5, "0"))


def zip_digits(c: str | Column) -> Column:
    """The first five of all digits, NULL with fewer."""
    digits = F.regexp_replace(col(c).cast("string"), r"\D", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))


ZIP_FORMS = {"text": zip_text, "first_digits": zip_first_digits, "padded": zip_padded, "digits": zip_digits}


def number(c: str | Column) -> Column:
    """DOUBLE, NULL for what is no number."""
    return col(c).try_cast("double")


def clip01(c: Column) -> Column:
    """Within [0, 1]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def find_column(names: Sequence[str], wanted: Sequence[str]) -> str | None:
    """A name equal to a wanted one but for case, in the order of wanted; else the first name that contains one."""
    exact = {n.lower(): n for n in names}
    for w in wanted:
        if w.lower() in exact:
            return exact[w.lower()]
    return next((n for n in names if any(w.lower() in n.lower() for w in wanted)), None)


def require_column(names: Sequence[str], wanted: Sequence[str], what: str) -> str:
    found = find_column(names, wanted)
    if found is None:
        raise ValueError(f"no {what} column among {list(names)}")
    return found


#: Marks of direction columns and candidate headers of source tables.
DIRECTION_MARKS = ("direction", "wind_dir", "winddirection")
FACILITY_ID_HEADERS = ("TRIFID", "TRIFD", "facility_id", "tri_facility_id")
FACILITY_HEADERS = {
    "facility_id": FACILITY_ID_HEADERS,
    "lat": ("LATITUDE83", "LATITUDE", "lat"),
    "lon": ("LONGITUDE83", "LONGITUDE", "lon", "lng"),
    "amount": ("total_air_emissions_lbs", "TOTAL RELEASE", "TOTAL_RELEASE", "amount"),
    "facility_name": ("FACILITY NAME", "FAC_NAME", "facility_name", "facility", "name"),
}
CHEMICAL_HEADERS = {
    "facility_id": FACILITY_ID_HEADERS,
    "chemical": ("CHEMICAL", "CHEMICAL NAME", "chemical_name"),
    "amount": ("TOTAL RELEASE", "TOTAL_RELEASE", "ON-SITE RELEASE TOTAL", "ONSITE_RELEASE_TOTAL", "TOTAL WASTE", "TOTAL_WASTE", "total_air_emissions_lbs", "stack_lbs", "fugitive_lbs", "amount"),
}
PLACE_HEADERS = ("ZCTA5CE20", "ZCTA5CE10", "GEOID20", "GEOID10", "zip", "zcta")


def pick_columns(names: Sequence[str], headers: dict[str, Sequence[str]], optional: Iterable[str] = ("amount", "facility_name")) -> dict[str, str | None]:
    """role -> column name; a missing role that is not optional raises."""
    found = {role: find_column(names, wanted) for role, wanted in headers.items()}
    missing = [r for r, n in found.items() if n is None and r not in set(optional)]
    if missing:
        raise ValueError(f"no column for {missing} among {list(names)}")
    return found


def direction_columns(names: Sequence[str], explicit: Sequence[str] = (), detect: bool = True) -> list[str]:
    """Columns named like a direction, then those asked for and present; each once, order kept."""
    auto = [n for n in names if any(m in n.lower() for m in DIRECTION_MARKS)] if detect else []
    return list(dict.fromkeys([*auto, *(c for c in explicit if c in names)]))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns but the excluded."""
    out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in out]


def name_list(text: str | None) -> list[str]:
    """The non-empty parts of a comma list."""
    return [p.strip() for p in (text or "").split(",") if p.strip()]


def by_trimmed_name(names: Sequence[str], wanted: str) -> str:
    """The column whose name equals ``wanted`` but for surrounding blanks."""
    for n in names:
        if n.strip() == wanted.strip():
            return n
    raise ValueError(f"no column {wanted!r} among {list(names)}")


def union_names(*names: Iterable[str]) -> list[str]:
    """All names, each once, in order of first use."""
    return list(dict.fromkeys(n for part in names for n in part))
