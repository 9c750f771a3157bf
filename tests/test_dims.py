"""The fixed lookup values, written out on their own."""

from __future__ import annotations

from adinsight.sources import dims


def test_devices_and_countries():
    classes: dict[str, set] = {}
    for raw, cls in dims.DEVICE_CLASSES:
        classes.setdefault(cls, set()).add(raw)
    assert classes == {"pc": {"pc & other devices", "pc or unknown", "pc"}, "phone": {"mobile", "phone", "Phone"},
                       "tablet": {"tablet", "Tablet"}}
    assert set(dims.COUNTRIES) == {("AEST", c) for c in ("australia", "AU", "Australia")} | {
        ("NZST", c) for c in ("new zealand", "NZ", "New Zealand")}


def test_days():
    assert dims.DAY_NAMES == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert set(dims.WEEKEND) == {"Saturday", "Sunday"} and set(dims.WEEKDAYS) == set(dims.DAY_NAMES) - set(dims.WEEKEND)
    assert dims.DAY_ORDER == dims.DAY_NAMES[1:] + dims.DAY_NAMES[:1]


def test_regions():
    au, nz = dict(dims.AU_CODES), dict(dims.NZ_CODES)
    assert sorted(au.values()) == [f"{i:02d}" for i in range(1, 9)]
    assert sorted(nz.values()) == [f"{i:02d}" for i in range(1, 17)]
    # 16 spellings of 8 regions: each in lower and in title case.
    assert len(dims.AU_REGIONS) == 16 and {v for _, v in dims.AU_REGIONS} == set(au)
    lower = {k: v for k, v in dims.AU_REGIONS if k == k.lower()}
    assert {k.title(): v for k, v in lower.items()} == {k: v for k, v in dims.AU_REGIONS if k != k.lower()}
    assert lower["new south wales"] == "NSW" and au["NSW"] == "02"
    assert len(dims.NZ_REGIONS) == 17 and {v for _, v in dims.NZ_REGIONS} == set(nz)
    assert all(k == k.lower() for k, _ in dims.NZ_REGIONS)
    assert {k for k, v in dims.NZ_REGIONS if v == "Hawke's Bay"} == {"hawkes bay", "hawke's bay"} and nz["Hawke's Bay"] == "06"
