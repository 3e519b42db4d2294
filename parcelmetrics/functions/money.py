"""Exact two-currency arithmetic and effective-dated marketplace fee rates.

The helpers write Spark SQL expressions; ``operators.columns`` adds them to a DataFrame.

KRW and USD amounts stay in decimals, so sums do not depend on the order in which
partitions are merged. Only a division by an exchange rate goes through double, and its
quotient is cut to nine fractional digits, the scale of the warehouse numeric type.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

MONEY = "DECIMAL(18,2)"
GOODS = "DECIMAL(20,2)"
FX = "DECIMAL(10,2)"
RATE = "DECIMAL(5,4)"
QUOTIENT = "DECIMAL(28,9)"
KRW = "DECIMAL(18,0)"
USD = "DECIMAL(18,2)"

# Fixed value: rate used when a date has no exchange rate.
FALLBACK_FX = 1450


def amount(c: str) -> str:
    """A money column with NULL read as zero."""
    return f"COALESCE(CAST({c} AS {MONEY}), CAST(0 AS {MONEY}))"


def rate_or_fallback(c: str) -> str:
    return f"COALESCE(CAST({c} AS {FX}), CAST({FALLBACK_FX} AS {FX}))"


def to_usd(krw: str, fx: str) -> str:
    return f"CAST(try_divide(CAST({krw} AS DOUBLE), CAST({fx} AS DOUBLE)) AS {QUOTIENT})"


def won(c: str) -> str:
    """Round half away from zero to whole KRW."""
    return f"CAST(ROUND({c}, 0) AS {KRW})"


def cents(c: str) -> str:
    """Round half away from zero to two USD decimals."""
    return f"CAST(ROUND({c}, 2) AS {USD})"


def total(columns: Iterable[str]) -> str:
    """Sum of columns, NULL read as zero."""
    return " + ".join(amount(c) for c in columns)


# Marketplaces of the standard programme, without and with number 20.
STANDARD_MARKETS = [1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 18, 19, 26, 27, 28, 29, 30]
STANDARD_MARKETS_20 = sorted([*STANDARD_MARKETS, 20])


FEE_KINDS = ("pg", "service", "surtax", "vendor")

#: A row of the rate table: valid from a day on and until the day before another, or for good.
RateRow = tuple[str, int, date, date | None, str]


@dataclass(frozen=True)
class FeeSchedule:
    """The days on which a rate of the published schedule changed; ``rows`` is that schedule as a table."""

    # Dates.
    pg_change: date = date(2025, 12, 9)
    vendor_change: date = date(2025, 12, 8)
    vendor_change_22: date = date(2026, 2, 1)

    def rows(self) -> list[RateRow]:
        """(fee, market_id, valid_from, valid_to, rate); a market without a row pays nothing."""
        always, open_end = date.min, None
        # Rates by fee, marketplaces and period.
        periods = [
            ("pg", STANDARD_MARKETS_20, always, open_end, "0.08"),
            ("pg", [2, 21], always, self.pg_change, "0.0778"),
            ("pg", [2, 21], self.pg_change, open_end, "0.1164"),
            ("pg", [22], always, open_end, "0.0778"),
            ("service", STANDARD_MARKETS, always, open_end, "0.05"),
            ("service", [3, 24, 33], always, open_end, "0.08"),
            ("service", [20, 34], always, open_end, "0.07"),
            ("service", [22], always, open_end, "0.0718"),
            ("surtax", STANDARD_MARKETS_20, always, open_end, "0.10"),
            ("vendor", [19], always, open_end, "0.05"),
            ("vendor", [2, 21], always, self.vendor_change, "0.0718"),
            ("vendor", [2, 21], self.vendor_change, open_end, "0.0218"),
            ("vendor", [22], always, self.vendor_change_22, "0.05"),
            ("vendor", [22], self.vendor_change_22, open_end, "0.04"),
        ]
        return [(fee, market, since, until, rate) for fee, markets, since, until, rate in periods for market in markets]
