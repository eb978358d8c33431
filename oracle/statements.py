"""Collects the checking statements of all suites."""

from __future__ import annotations

from oracle import jobs, micro, retail, runs, star, telemetry, tpcds_baskets, tpcds_channels, tpcds_hierarchies, tpcds_inventory, tpcds_returns, tpcds_star, tpcds_windows, tpch


def all_sql() -> dict[str, str]:
    return {**tpch.SQL, **micro.SQL, **retail.SQL, **tpcds_star.SQL, **tpcds_baskets.SQL, **tpcds_returns.SQL, **tpcds_channels.SQL,
            **tpcds_windows.SQL, **tpcds_hierarchies.SQL, **tpcds_inventory.SQL, **runs.SQL, **telemetry.SQL, **jobs.SQL, **star.SQL}
