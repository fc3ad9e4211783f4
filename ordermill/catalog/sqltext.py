"""Pieces of DuckDB SQL for the oracles, written independently of the Spark expressions."""

from __future__ import annotations

from ..functions import fixed_values as V

KEYS = "order_key, line_no, part_key, supp_key, amount_key"
AS_OF = "timestamp '2001-12-31 00:00:00'"
EVENTS_AS_OF = "timestamp '2024-01-31 00:00:00'"


def quoted(values) -> str:
    return ", ".join(lit(v) for v in values)


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def case_map(c: str, mapping: dict, default: str = "null") -> str:
    whens = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in mapping.items())
    return f"(case {c} {whens} else {default} end)"


def title(c: str) -> str:
    runs = rf"regexp_extract_all({c}, '(\p{{L}}+|[^\p{{L}}]+)')"
    # DuckDB's upper() makes one letter of a sharp s; its title form is "Ss"
    return f"array_to_string(list_transform({runs}, lambda w: replace(upper(w[1]), 'ẞ', 'Ss') || lower(w[2:])), '')"


def squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"


def clean(c: str) -> str:
    return f"nullif({squeeze(c)}, 'nan')"


def person(c: str) -> str:
    return rf"regexp_replace({title(clean(c))}, '[^a-zA-Z\s\-'']', '', 'g')"


def number(c: str) -> str:
    return rf"(case when regexp_full_match(trim({c}), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(trim({c}) as double) end)"


def currency(c: str) -> str:
    bare = f"replace({c}, ' USD', '')"
    for symbol in [*V.CURRENCY_SYMBOLS, ",", " "]:
        bare = f"replace({bare}, '{symbol}', '')"
    return number(bare)


def money(c: str) -> str:
    return f"cast(cast(cast({c} as decimal(18,4)) as decimal(18,2)) as double)"


def cents(c: str) -> str:
    return f"cast(round({c} * 100) as bigint)"


def mean_money(c: str) -> str:
    """Mean to the cent, half up, in whole numbers (values are not negative)."""
    return f"floor((2 * sum({cents(c)}) + count({c})) / (2.0 * count({c}))) / 100.0"


def mean(c: str, where: str = "") -> str:
    """Exact mean of values with at most two decimals, summed as whole cents."""
    f = f" filter (where {where})" if where else ""
    return f"(sum({cents(c)}){f} / 100.0 / count({c}){f})"


def email_ok(c: str) -> str:
    return rf"regexp_full_match({c}, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}')"


def iso(c: str) -> str:
    return rf"(case when regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}') then try_cast({c} as timestamp) end)"


def any_date(c: str) -> str:
    formats = ["%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y", "%Y/%m/%d", "%d %b %Y"]
    return f"coalesce({iso(c)}, " + ", ".join(f"try_strptime({c}, '{f}')" for f in formats) + ")"


def multi_date(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%d-%m-%Y'), try_strptime({c}, '%Y/%m/%d'))"


def blank(c: str) -> str:
    return f"({c} is null or trim({c}) = '')"


def pick_hash(c: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case cast('0x' || substr(md5({c}), 1, 6) as bigint) % {len(values)} {whens} end"


def first_per(keys: str, order: str = KEYS) -> str:
    return f"row_number() over (partition by {keys} order by {order}) = 1"


def summary(value: str) -> str:
    v = value
    return f"""count({v}) as n, sum({cents(v)}) / 100.0 as total, min({v}) as min_value, max({v}) as max_value, sum({cents(v)}) / 100.0 / count({v}) as mean,
      round(coalesce(stddev_samp({v}), 0.0), 6) as std_dev, median({v}) as median,
      list_sort(list({v}))[cast(floor(0.95 * count({v})) as bigint) + 1] as p95,
      list_sort(list({v}))[cast(floor(0.99 * count({v})) as bigint) + 1] as p99"""
