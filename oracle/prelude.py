"""Adds the derived tables a statement mentions as common table expressions."""

from __future__ import annotations

import re

from tidemark.sources import derive, star
from tidemark.sources.schemas import STORED

BASE_COLUMNS = {name: [c.split()[0] for c in ddl.split(", ")] for name, ddl in STORED.items()}

TABLES = {f"h_{k}" if k in STORED else k: v for k, v in star.TPCH.items()}
TABLES |= star.TPCDS
TABLES |= star.RETAIL
TABLES |= star.MONITOR


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """`extra` maps further names to statements, which may use the derived tables."""
    extra = extra or {}
    parts: dict[str, str] = {}

    def need(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", text):
            if name in parts:
                continue
            if name in extra:
                parts[name] = ""
                need(extra[name])
                del parts[name]
                parts[name] = extra[name]
            elif name in TABLES:
                d = TABLES[name]
                parts[name] = derive.duckdb_text(d, BASE_COLUMNS.get(d.base)).replace("@suppliers", "(select count(*) from supplier)")

    need(sql)
    if not parts:
        return sql
    head = ",\n".join(f"{n} as materialized ({s})" for n, s in parts.items())
    sql = sql.strip()
    if re.match(r"with\b", sql, re.I):
        return f"with {head},\n{sql[4:].strip()}"
    return f"with {head}\n{sql}"


# Fragments which mirror tidemark.functions.columns.
def S(x: str) -> str:
    return f"cast(sum({x}) as double)"


def A(x: str) -> str:
    return f"(cast(sum({x}) as double) / nullif(count({x}), 0))"


def X(x: str, scale: int = 4) -> str:
    return f"cast({x} as decimal(18,{scale}))"


def XS(x: str, scale: int = 4) -> str:
    return S(X(x, scale))


def XA(x: str, scale: int = 2) -> str:
    return A(X(x, scale))


def top(*keys: str, limit: int | None = None) -> str:
    parts = [f"{k[1:]} desc nulls first" if k.startswith("-") else f"{k} asc nulls last" for k in keys]
    return "order by " + ", ".join(parts) + (f" limit {limit}" if limit else "")
