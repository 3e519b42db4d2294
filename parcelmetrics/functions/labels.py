"""Fixed labels and classifications as SQL expressions."""

from __future__ import annotations

# Administrator suites, matched without regard to case.
ADMIN_SUITES = ["Z9996", "Z9997", "Z9998", "Z9999"]
UNKNOWN_SUITE = "Unknown"

# Weight bins in grams, closed on the right; zero belongs to the first.
WEIGHT_EDGES = [0, 1000, 3000, 5000, 10000, 20000]
WEIGHT_LABELS = ["~1kg", "1~3kg", "3~5kg", "5~10kg", "10~20kg", "20kg+"]

# Display names of the cases.
CASE_NAMES = {
    "Case 1": "배송대행(ASN) 단독",
    "Case 2": "구매대행(Buy Request) 단독",
    "Case 3": "배송대행(ASN) 합포장",
    "Case 4": "구매대행(Buy Request) 합포장",
    "Case 5": "배송대행(ASN) + 구매대행(Buy Request) 혼합",
}

# How a carrier is written and the column it counts under.
CARRIER_COLUMNS = {"DHL": "DHL", "DHL_EXPRESS": "DHL", "EMS": "EMS", "FEDEX": "FEDEX", "UPS": "UPS"}
CARRIER_KEYS = ["DHL", "EMS", "FEDEX", "UPS", "kpacket"]

# Countries with shipping volumes.
VOLUME_COUNTRIES = ["AU", "BR", "CA", "DE", "FR", "GB", "JP", "MX", "SG", "US"]


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def is_admin(suite: str = "suite_number") -> str:
    return f"UPPER({suite}) IN ({quoted([s.upper() for s in ADMIN_SUITES])})"


def is_country_code(c: str = "country_code") -> str:
    """Two capital letters; the length rules out a trailing line break."""
    return f"COALESCE(LENGTH({c}) = 2 AND {c} RLIKE '^[A-Z]{{2}}$', FALSE)"


def weight_bin(weight: str) -> str:
    """Position of the weight bin, NULL for missing, non-numeric or negative weights."""
    w = f"try_cast({weight} AS DOUBLE)"
    tops = WEIGHT_EDGES[1:]
    branches = [f"WHEN {w} < {WEIGHT_EDGES[0]} OR {w} IS NULL OR isnan({w}) THEN NULL"]
    branches += [f"WHEN {w} <= {top} THEN {i}" for i, top in enumerate(tops)]
    return f"CASE {' '.join(branches)} ELSE {len(tops)} END"


def weight_group(grams: str) -> str:
    """Half-kilogram step above the weight, at least 0.5; a bad weight counts as zero."""
    w = f"COALESCE(NANVL(try_cast({grams} AS DOUBLE), 0D), 0D)"
    return f"GREATEST(0.5D, CEIL({w} / 1000 / 0.5D) * 0.5D)"


def carrier_key(carrier: str = "carrier", service: str = "carrier_service") -> str:
    """Column a shipment counts under: the service decides first, then the carrier."""
    s, c = f"UPPER(COALESCE({service}, ''))", f"UPPER(COALESCE({carrier}, ''))"
    named = " ".join(f"WHEN {c} = '{raw}' THEN '{key}'" for raw, key in CARRIER_COLUMNS.items())
    return f"CASE WHEN {s} = 'KPACKET' THEN 'kpacket' WHEN {s} = 'EMS' THEN 'EMS' {named} ELSE 'other' END"


def case_name(source_case: str = "source_case") -> str:
    """Display name of a case; an unknown case keeps its own name."""
    branches = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CASE_NAMES.items())
    return f"CASE {source_case} {branches} ELSE {source_case} END"


def in_currency(krw: str, usd: str, rate: str) -> str:
    """USD figure where there is one, else KRW at the given rate."""
    return f"COALESCE({usd}, try_divide(COALESCE({krw}, 0), {rate}))"


def kilograms(grams: str) -> str:
    return f"{grams} / 1000"


def kst_minute(utc: str) -> str:
    """Minute stamp in Korean time of a UTC timestamp."""
    return f"CONCAT(date_format(from_utc_timestamp({utc}, 'Asia/Seoul'), 'yyyy-MM-dd HH:mm'), ' KST')"


def reporting_week(day: str) -> str:
    """Monday of the full week before the report date."""
    return f"CAST(date_trunc('WEEK', CAST({day} AS DATE)) AS DATE) - INTERVAL 7 DAY"
