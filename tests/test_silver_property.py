"""Property test: Silver on random raw rows equals a pure-Python model of the rules."""
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.config import PanelConfig
from tidemark.operators import silver

CFG = PanelConfig()
COLS = ["iso_code", "location", "continent", "date", "total_cases", "new_cases", "total_deaths",
        "people_vaccinated", "population"]

num = st.one_of(st.none(), st.integers(-1000, 10**7).map(str), st.just("x1"),
                st.floats(-50, 5000, allow_nan=False).map(lambda f: f"{f:.3f}"))
row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["AFG", "BRA", "OWID_WRL", "OWIDX", "ZAF"])),
    st.sampled_from(["a", "b", "c"]),
    st.one_of(st.none(), st.sampled_from(["Asia", "Europe"])),
    st.one_of(st.just("bad"), st.dates(dt.date(2019, 1, 1), dt.date(2023, 1, 1)).map(str)),
    num, num, num, num, num)


def f32(text):
    if text is None:
        return None
    try:
        return float(np.float32(float(text)))
    except ValueError:
        return None


def half_up(x, digits):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def rate(num_, den, scale, digits):
    if den is None or den <= 0 or num_ is None:
        return None
    return half_up(num_ / den * scale, digits)


def model(r):
    iso, loc, cont, date, tc, nc, td, pv, pop = r
    if cont is None or iso is None or iso.startswith("OWID_"):
        return None
    tc, nc, td, pv, pop = map(f32, (tc, nc, td, pv, pop))
    if nc is not None and nc < 0:
        nc = 0.0
    try:
        d = dt.date.fromisoformat(date)
    except ValueError:
        d = None
    return {"date": d, "new_cases": nc, "total_cases": tc,
            "record_year": d.year if d else None,
            "death_rate": rate(td, tc, 100, 4), "vaccination_rate": rate(pv, pop, 100, 2),
            "cases_per_million_calc": rate(tc, pop, 1_000_000, 2)}


def close(a, b, digits):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= 1.01 * 10 ** -digits


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(row, min_size=1, max_size=40))
def test_silver_matches_model(spark, rows):
    keyed = [(r[0], f"{i}", *r[2:]) for i, r in enumerate(rows)]      # location = row id
    df = spark.createDataFrame(keyed, ", ".join(f"{c} string" for c in COLS))
    got = {r["location"]: r for r in silver.transform(df, CFG).collect()}
    want = {k[1]: model(k) for k in keyed}
    assert set(got) == {k for k, v in want.items() if v is not None}
    for k, g in got.items():
        w = want[k]
        assert g["date"] == w["date"] and g["record_year"] == w["record_year"]
        assert g["new_cases"] == w["new_cases"] and g["total_cases"] == w["total_cases"]
        assert close(g["death_rate"], w["death_rate"], 4)
        assert close(g["vaccination_rate"], w["vaccination_rate"], 2)
        assert close(g["cases_per_million_calc"], w["cases_per_million_calc"], 2)
