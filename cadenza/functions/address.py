"""Province and city read out of a Chinese postal address."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "null"  # the source system writes NULL as this text

# Autonomous regions and municipalities with their short names.
REGIONS = {
    "内蒙古自治区": "内蒙古",
    "宁夏回族自治区": "宁夏",
    "西藏自治区": "西藏",
    "广西壮族自治区": "广西",
    "新疆维吾尔自治区": "新疆",
}
MUNICIPALITIES = {
    "北京市": "北京",
    "上海市": "上海",
    "重庆市": "重庆",
    "天津市": "天津",
}

_REGIONS_OF_CITIES = ("内蒙古自治区", "宁夏回族自治区", "广西壮族自治区")
_XINJIANG, _CHONGQING = "新疆维吾尔自治区", "重庆市"


def _between(opening: str, closing: str) -> str:
    """Pattern for the text between the first ``opening`` and the first ``closing`` of
    the address, which must come in this order."""
    return f"(?s)^[^{opening}{closing}]*{opening}([^{closing}]*){closing}"


def _up_to_next(opening: str, closing: str) -> str:
    """Pattern for the text from the first ``opening`` to the next ``closing``."""
    return f"(?s)^[^{opening}]*{opening}([^{closing}]*){closing}"


def _extract(address: Column, pattern: str) -> Column:
    return F.regexp_extract(address, pattern, 1)


def _first_of(rules: list[tuple[Column, Column]]) -> Column:
    """Value of the first rule that holds, else ''."""
    return reduce(
        lambda rest, rule: F.when(*rule).otherwise(rest), reversed(rules), F.lit("")
    )


def province(address: Column) -> Column:
    """Short name of the region or municipality, else the text before 省, else ''."""
    named = [
        (address.contains(full), F.lit(short))
        for full, short in {**REGIONS, **MUNICIPALITIES}.items()
    ]
    before_sheng = (address.isNotNull(), _extract(address, "(?s)^([^省]*)省"))
    return _first_of([*named, before_sheng])


def city(address: Column) -> Column:
    """City, prefecture or municipal district; '' when no rule gives one."""

    def has(pattern: str) -> Column:
        return address.rlike(pattern)

    to_city, to_district = _between("区", "市"), _up_to_next("区", "区")
    rules = [(address.contains(name), _extract(address, to_city)) for name in _REGIONS_OF_CITIES]
    in_xinjiang = address.contains(_XINJIANG)
    rules += [
        (in_xinjiang & has(to_city), _extract(address, to_city)),
        (in_xinjiang & has(to_district), _extract(address, to_district)),
        (in_xinjiang, _extract(address, _up_to_next("区", "州"))),
    ]
    district, county = _between("市", "区"), _between("市", "县")
    for name in MUNICIPALITIES:
        inside = address.contains(name)
        if name == _CHONGQING:
            counties_only = inside & ~has(_up_to_next("市", "区"))
            rules.append((counties_only, _extract(address, county)))
        rules.append((inside, _extract(address, district)))
    rules += [
        (has(_up_to_next("省", "市")), _extract(address, _between("省", "市"))),
        (address.contains("省"), _extract(address, _up_to_next("省", "州"))),
    ]
    return _first_of(rules)


def repair_province(value: Column, address: Column) -> Column:
    """``value``, or the address's province where it is the missing-text."""
    return F.when(value == MISSING, province(address)).otherwise(value)


def repair_city(value: Column, address: Column) -> Column:
    """``value``, or the address's city where it is the missing-text."""
    return F.when(value == MISSING, city(address)).otherwise(value)
