"""DuckDB spellings of the cleaning rules, for the comparison SQL only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

_NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def with_tables(body: str, **tables: str) -> str:
    parts = ", ".join(f"{name} as ({sql})" for name, sql in tables.items())
    return f"with {parts} {body}"


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9))"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '\\S+|\\s+'),"
        " lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def whole(x: str) -> str:
    return f"case when regexp_full_match({strip(x)}, '[+-]?[0-9]+') then try_cast({strip(x)} as bigint) end"


def number(x: str) -> str:
    return f"case when regexp_full_match({strip(x)}, '{_NUMBER}') then try_cast({strip(x)} as double) end"


def parsed(x: str, *formats: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in formats) + ")"


DAY_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S")


def order_stamp(x: str) -> str:
    return parsed(strip(x), *DAY_FORMATS)


def long_stamp(x: str) -> str:
    return parsed(f"replace({x}, ',', '')", "%B %d %Y")


def spend_stamp(x: str) -> str:
    clean = f"replace({strip(x)}, chr(34), '')"
    return f"coalesce({parsed(clean, *DAY_FORMATS, '%m/%d/%Y')}, {long_stamp(clean)})"


def calendar(stamp: str, prefix: str) -> str:
    return (
        f"cast(year({stamp}) as integer) as {prefix}_year,"
        f" cast(month({stamp}) as integer) as {prefix}_month,"
        f" 'Q' || cast(quarter({stamp}) as varchar) as {prefix}_quarter"
    )


def bands(x: str, limits: Sequence[tuple[int, str]], rest: str) -> str:
    arms = " ".join(f"when {x} < {limit} then '{label}'" for limit, label in limits)
    return f"case {arms} else '{rest}' end"


def groups(x: str, members: Mapping[str, Sequence[str]], rest: str) -> str:
    arms = " ".join(
        f"when {x} in ({', '.join(repr(n) for n in names)}) then '{group}'"
        for group, names in members.items()
    )
    return f"case {arms} else '{rest}' end"


def first_per(source: str, keys: str, order: str) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over"
        f" (partition by {keys} order by {order}) as rn from {source}) where rn = 1"
    )
