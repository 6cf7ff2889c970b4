"""Column expressions shared by the reports. All are built-in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode_sql(code: str, texts: dict[int, str], other: str | None) -> str:
    """Text of a code; ``other`` for an unknown or missing code (None: null)."""
    pairs = ", ".join(f"{key}, '{text}'" for key, text in texts.items())
    found = f"try_element_at(map({pairs}), {code})"
    return found if other is None else f"coalesce({found}, '{other}')"


def decode(code: str, texts: dict[int, str], other: str | None) -> Column:
    return F.expr(decode_sql(code, texts, other))


def smallest_text_sql(code: str, texts: dict[int, str], other: str) -> str:
    """The aggregate ``min`` of the texts of a code. It compares their places in
    text order, so that the aggregate holds a number and can hash its keys."""
    return text_at_sql(f"min({place_sql(code, texts, other)})", texts, other)


def place_sql(code: str, texts: dict[int, str], other: str) -> str:
    """The place from 1, in text order, of the text of a code."""
    shown = sorted({*texts.values(), other})
    places = ", ".join(f"{key}, {shown.index(text) + 1}" for key, text in texts.items())
    return f"coalesce(try_element_at(map({places}), {code}), {shown.index(other) + 1})"


def text_at_sql(place: str, texts: dict[int, str], other: str) -> str:
    listed = ", ".join(f"'{text}'" for text in sorted({*texts.values(), other}))
    return f"element_at(array({listed}), cast({place} as int))"


# Moments of the years 1 to 9999 lie within _REACH microseconds of this one.
_ORIGIN = "timestamp_ntz'1970-01-01 00:00:00'"
_REACH = 1 << 58


def _micros(moment: str) -> str:
    seconds = f"cast(cast({moment} - {_ORIGIN} as interval second) as decimal(18,6))"
    return f"cast({seconds} * 1000000 as bigint)"


def _moment(micros: str) -> str:
    return f"{_ORIGIN} + make_dt_interval(0, 0, 0, cast({micros} / 1000000 as decimal(18,6)))"


def moment_first_sql(moment: str, code: str) -> str:
    """A moment and a code (a whole number of at least 0) as one number that sorts as the
    pair does. An aggregate holds it in place and can hash its keys, where the
    smallest or largest struct makes it sort its rows. Null without a moment or code."""
    return f"cast({_micros(moment)} as decimal(38,0)) * {2 * _REACH}BD + {code}"


def moments_sql(moment: str, second: str) -> str:
    """``moment_first_sql`` for two moments; a missing second one comes first."""
    return moment_first_sql(moment, f"coalesce({_micros(second)} + {_REACH}L, 0L)")


def code_of_sql(packed: str) -> str:
    return f"cast(pmod({packed}, {2 * _REACH}BD) as bigint)"


def moment_of_sql(packed: str) -> str:
    return _moment(f"cast(({packed} - {code_of_sql(packed)}) / {2 * _REACH}BD as decimal(20,0))")


def second_moment_of_sql(packed: str) -> str:
    return f"case when {code_of_sql(packed)} > 0 then {_moment(f'cast({code_of_sql(packed)} - {_REACH}L as decimal(20,0))')} end"


def rounded(value: Column) -> Column:
    """Rounded half away from zero, as a whole number."""
    return F.round(value).cast("int")


def age(on: Column, birth: Column | str, days_per_year: int = 365) -> Column:
    return rounded(F.datediff(on, birth) / days_per_year)


def months_between_rounded(later: Column, earlier: Column | str) -> Column:
    return rounded(F.datediff(later, earlier) / 30)


def plus_days(moment: Column | str, days: int) -> Column:
    """Keeps the time of day (``date_add`` would drop it)."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return moment + F.make_dt_interval(F.lit(days))


def plus_months(moment: Column | str, months: int) -> Column:
    """Keeps the time of day; the day is clamped to the length of the month."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return moment + F.make_ym_interval(F.lit(0), F.lit(months))


def full_name() -> Column:
    """Three parts; a missing part leaves its blanks."""
    return F.expr(
        "concat(coalesce(given_name, ''), ' ', coalesce(middle_name, ''), ' ',"
        " coalesce(family_name, ''))"
    )


def short_name() -> Column:
    """Two parts; missing as a whole when either part is missing."""
    return F.concat(F.col("given_name"), F.lit(" "), F.col("family_name"))


def number_text_sql(value: str) -> str:
    """A number without trailing zeros: 1000, 10.5."""
    return rf"regexp_replace(cast(cast({value} as decimal(18,4)) as string), '\\.?0+$', '')"


def viral_load_text_sql(value: str) -> str:
    """Negative results are stored for an undetectable load."""
    return f"case when {value} < 0 then 'INDETECTAVEL' else {number_text_sql(value)} end"


def viral_load_text(value: str) -> Column:
    return F.expr(viral_load_text_sql(value))


def child_flag(years: Column) -> Column:
    return F.when(years < 5, F.lit("Criança (<5 anos)")).otherwise(F.lit(""))


def yes_flag(condition: Column) -> Column:
    return F.when(condition, F.lit("SIM")).otherwise(F.lit(""))


def care_status(exit_state: Column, next_date: Column, end: Column, no_date: str) -> Column:
    """The recorded exit, else whether the booked date is over 60 days past."""
    return (
        F.when(exit_state.isNotNull(), exit_state)
        .when(next_date.isNull(), F.lit(no_date))
        .when(F.datediff(end, next_date) > 60, F.lit("ABANDONO NAO NOTIFICADO"))
        .otherwise(F.lit("ACTIVO"))
    )
