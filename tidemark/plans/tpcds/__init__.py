"""TPC-DS, over any mapping from table name to DataFrame with its columns."""

from __future__ import annotations

from tidemark.plans.tpcds import baskets, channels, hierarchies, inventory, returns, star, windows

QUERIES = {}
for _module in (star, baskets, returns, channels, windows, hierarchies, inventory):
    QUERIES |= {f"tpcds_{n}": f for n, f in vars(_module).items() if n[0] == "q" and n[1:3].isdigit()}
QUERIES = dict(sorted(QUERIES.items()))
