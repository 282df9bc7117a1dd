"""Small text builders shared by the comparison SQL."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping


def rounded(value: str, digits: int) -> str:
    scaled = f"(({value}) * 1e{digits})"
    return (
        f"(CASE WHEN {scaled} < 0 THEN -CAST(floor(0.5 - {scaled}) AS BIGINT) "
        f"ELSE CAST(floor({scaled} + 0.5) AS BIGINT) END / 1e{digits})"
    )


def mean(value: str, digits: int, carries: int = 0, over: str = "") -> str:
    """Rounded mean; a value with decimals is averaged as whole units."""
    if carries:
        return rounded(f"avg(CAST(round(({value}) * 1e{carries}) AS BIGINT)){over} / 1e{carries}", digits)
    return rounded(f"avg({value}){over}", digits)


def units(value: str, digits: int) -> str:
    return f"CAST(round(({value}) * 1e{digits}) AS BIGINT)"


def total(value: str, where: str = "") -> str:
    condition = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({value}){condition} AS BIGINT)"


def one_decimal(value: str) -> str:
    tenths = f"CAST(round({rounded(f'abs({value})', 1)} * 10) AS BIGINT)"
    digits = f"concat(CAST({tenths} // 10 AS VARCHAR), '.', CAST({tenths} % 10 AS VARCHAR))"
    return f"(CASE WHEN ({value}) IS NULL THEN NULL WHEN ({value}) < 0 AND {tenths} > 0 THEN concat('-', {digits}) ELSE {digits} END)"


def plus_signed(value: str) -> str:
    return f"(CASE WHEN ({value}) > 0 THEN concat('+', {one_decimal(value)}) ELSE {one_decimal(value)} END)"


def listed(items: Iterable[str]) -> str:
    return ",\n  ".join(items)


def named(pairs: Mapping[str, str]) -> str:
    return listed(f"{expression} AS {name}" for name, expression in pairs.items())


def assemble(query: str, library: Mapping[str, str]) -> str:
    """Put in front of ``query`` the parts of the library it needs, each after what it needs."""
    words = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in words.findall(text):
            if word in library and word not in ordered:
                visit(library[word])
                if word not in ordered:
                    ordered.append(word)

    visit(query)
    if not ordered:
        return query
    parts = ",\n".join(f"{name} AS (\n{library[name].strip()}\n)" for name in ordered)
    return f"WITH {parts}\n{query.strip()}"
