"""DuckDB texts of the expressions the oracles share."""

from __future__ import annotations

from atlas.functions import text
from atlas.functions.osm import CARDINALS


def fold(x: str) -> str:
    source, target = text.base_letter_map()
    return rf"regexp_replace(translate(lower({x}), '{source}', '{target}'), '\p{{Mn}}', '', 'g')"


def name_key(x: str) -> str:
    return rf"trim(regexp_replace({fold(x)}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def km(a: str, o: str, b: str, p: str) -> str:
    k = f"cos(radians(({a} + {b}) / 2)) * 111.32e0"
    return f"sqrt(pow(({p} - {o}) * {k}, 2) + pow(({b} - {a}) * 110.54e0, 2))"


def meters(a: str, o: str, b: str, p: str) -> str:
    k = f"cos(radians(({a} + {b}) / 2)) * 111320e0"
    return f"sqrt(pow(({p} - {o}) * {k}, 2) + pow(({b} - {a}) * 110540e0, 2))"


def haversine(a: str, o: str, b: str, p: str, radius: float = 6371000.0) -> str:
    h = (f"pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b}))"
         f" * pow(sin(radians({p} - {o}) / 2), 2)")
    return f"{2 * radius:e} * asin(sqrt({h}))"


def portal_distance(a: str, b: str) -> str:
    """Between rows ``a`` and ``b`` with lat_e7, lon_e7."""
    d = haversine(f"{a}.lat_e7 / 1e7", f"{a}.lon_e7 / 1e7", f"{b}.lat_e7 / 1e7", f"{b}.lon_e7 / 1e7")
    return (f"CASE WHEN {a}.lat_e7 = {b}.lat_e7 AND {a}.lon_e7 = {b}.lon_e7 THEN 0e0"
            f" ELSE greatest(0.01e0, ceil({d} * 100) / 100e0) END")


def bearing(a: str, o: str, b: str, p: str) -> str:
    y = f"sin(radians({p}) - radians({o})) * cos(radians({b}))"
    x = (f"cos(radians({a})) * sin(radians({b})) - sin(radians({a})) * cos(radians({b}))"
         f" * cos(radians({p}) - radians({o}))")
    return f"((degrees(atan2({y}, {x})) + 360) % 360)"


def half_even(x: str, digits: int = 0) -> str:
    return f"round_even({x}, {digits})"


def decimal_cell(x: str, digits: int) -> str:
    n = f"{2 * 10 ** digits}e0"
    high = f"(134217729e0 * {x} - (134217729e0 * {x} - {x}))"
    error = f"(({high} * {n} - {x} * {n}) + ({x} - {high}) * {n})"
    rest = f"({x} * {n} / 2 - floor({x} * {n} / 2))"
    return (f"(floor({x} * {n} / 2) + CASE WHEN {rest} > 0.5 OR ({rest} = 0.5 AND ({error} > 0 OR ({error} = 0 AND floor({x} * {n} / 2) % 2 <> 0)))"
            f" THEN 1 ELSE 0 END)")


def cardinal_case(x: str) -> str:
    whens = " ".join(f"WHEN '{d}' THEN {i * 22.5}e0" for i, d in enumerate(CARDINALS))
    return f"CASE upper({x}) {whens} END"


def crossing(x: str, y: str, s: str) -> str:
    return (f"(({s}.yi > {y}) <> ({s}.yj > {y}) AND"
            f" {x} < ({s}.xj - {s}.xi) * ({y} - {s}.yi) / ({s}.yj - {s}.yi) + {s}.xi)")
