"""Expression helpers against plain Python."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.golden import AS_OF
from bridge.expected import PAYMENT_CODES
from tradeline.functions import dates, history, limits, numbers
from tradeline.functions.codes import code_level, code_levels, has_level

# text -> (day first, month first)
DATES = {
    "2023-02-01": ("2023-02-01 00:00:00",) * 2,
    "2023-2-1": ("2023-02-01 00:00:00",) * 2,
    " 2023-02-01 ": ("2023-02-01 00:00:00",) * 2,
    "2023-02-01 10:11:12": ("2023-02-01 10:11:12",) * 2,
    "2023-02-01T10:11:12Z": ("2023-02-01 10:11:12",) * 2,
    "2023-02": ("2023-02-01 00:00:00",) * 2,
    "2023/02/01": ("2023-02-01 00:00:00",) * 2,
    "20230201": ("2023-02-01 00:00:00",) * 2,
    "03-04-2023": ("2023-04-03 00:00:00", "2023-03-04 00:00:00"),
    "3/4/2023": ("2023-04-03 00:00:00", "2023-03-04 00:00:00"),
    "03.04.2023 05:06": ("2023-04-03 05:06:00", "2023-03-04 05:06:00"),
    "12-31-2023": ("2023-12-31 00:00:00",) * 2,
    "31-12-2023": ("2023-12-31 00:00:00",) * 2,
    "31/12/23": ("2023-12-31 00:00:00",) * 2,
    "31/12/99": ("1999-12-31 00:00:00",) * 2,
    "3/4/23": ("2023-04-03 00:00:00", "2023-03-04 00:00:00"),
    "3/4/74 10:00": ("1974-04-03 10:00:00", "1974-03-04 10:00:00"),
    "13/13/2023": (None, None),
    "00/01/2023": (None, None),
    "01/00/2023": (None, None),
    "1/1/0001": (None, None),
    "99990101": (None, None),
    "2262/01/01": (None, None),
    "1678-01-01": ("1678-01-01 00:00:00",) * 2,
    "01-01-2261": ("2261-01-01 00:00:00",) * 2,
    "5-Mar-2021": ("2021-03-05 00:00:00",) * 2,
    "05 March 2021": ("2021-03-05 00:00:00",) * 2,
    "Mar 5, 2021": ("2021-03-05 00:00:00",) * 2,
    "5 Jan 2023 10:00:00": ("2023-01-05 10:00:00",) * 2,
    "5 Jan 2023 10:00 PM": ("2023-01-05 22:00:00",) * 2,
    "Jan 5, 2023 12:30:15 am": ("2023-01-05 00:30:15",) * 2,
    "05-01-2023 10:00:00 AM": ("2023-01-05 10:00:00", "2023-05-01 10:00:00"),
    "05-01-2023 12:00:00 PM": ("2023-01-05 12:00:00", "2023-05-01 12:00:00"),
    "05-01-2023 13:00:00 PM": (None, None),
    "05-01-2023 10:20:30.5": ("2023-01-05 10:20:30", "2023-05-01 10:20:30"),
    "2023-01-05 10:20:30.5": ("2023-01-05 10:20:30",) * 2,
    "20230105103000": ("2023-01-05 10:30:00",) * 2,
    "20230105 103000": ("2023-01-05 10:30:00",) * 2,
    "20230105996000": (None, None),
    "5 Xyz 2023 10:00:00": (None, None),
    "31-31-2020": (None, None),
    "2023-02-30": (None, None),
    "30-02-2023": (None, None),
    "5-Xyz-2021": (None, None),
    "9999-12-31": (None, None),
    "0001-01-01": (None, None),
    "hello": (None, None),
    "": (None, None),
    None: (None, None),
}


def test_parse_date(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "t string")
    text = F.col("t")
    rows = df.select(
        "t",
        dates.date_text(dates.parse_date(text, AS_OF, True)).alias("d"),
        dates.date_text(dates.parse_date(text, AS_OF, False)).alias("m"),
    ).collect()
    assert {r.t: (r.d, r.m) for r in rows} == DATES


def test_numbers(spark):
    cases = {
        "1": (1.0, False, 1), " 2 ": (2.0, False, 2), "1e3": (1000.0, False, None), "-.5": (-0.5, False, None),
        "7.0": (7.0, False, None), "nan": (None, False, None), "INF": (float("inf"), False, None),
        "12d": (None, True, None), "0x10": (None, True, None), "": (None, True, None),
        "abc": (None, True, None), None: (None, False, None), "+3": (3.0, False, 3),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    t = F.col("t")
    rows = df.select("t", numbers.to_amount(t).alias("a"), numbers.is_bad_number(t).alias("b"),
                     numbers.to_whole(t).alias("w")).collect()
    assert {r.t: (r.a, r.b, r.w) for r in rows} == cases


def test_codes(spark):
    codes = [*PAYMENT_CODES, "*", "ZZZ", "0", None]
    df = spark.createDataFrame([(codes,)], "c array<string>")
    r = df.select(
        code_levels(F.col("c"), PAYMENT_CODES).alias("all"),
        code_level(F.get("c", F.lit(1)), PAYMENT_CODES).alias("one"),
        code_level(F.lit("it's"), {"it's": 4, "back\\slash": 5}).alias("quoted"),
        code_level(F.lit("back\\slash"), {"it's": 4, "back\\slash": 5}).alias("slash"),
    ).first()
    worst = df.select(*[has_level(F.col("c"), PAYMENT_CODES, n).alias(f"h{n}") for n in (-20, 5, 21, 22)]).first()
    assert tuple(worst) == (True, True, True, False)
    quiet = spark.createDataFrame([(["000", "30+", None],), (["000"],), ([],)], "c array<string>")
    hits = [r.h for r in quiet.select(has_level(F.col("c"), PAYMENT_CODES, 5).alias("h")).collect()]
    assert hits == [None, False, False]
    assert r.all == [PAYMENT_CODES.get(c) for c in codes]
    assert (r.one, r.quoted, r.slash) == (1, 4, 5)


def _named(levels, lag):
    """L0M..L48M by definition."""
    out = [None] * 49
    if lag is None or lag > 48:
        return out
    n = max(lag, 0)
    for k in range(n, 48):
        if k - n < len(levels):
            out[k] = levels[k - n]
    return out


def test_history_frames(spark):
    rng = random.Random(7)
    rows = []
    for lag in [None, -60, *range(0, 54)]:
        for size in (0, 1, 5, 12, 47, 48, 49):
            rows.append((lag, [rng.choice([None, 0, 1, 2, 5]) for _ in range(size)]))
    df = spark.createDataFrame(rows, "lag int, levels array<int>")
    levels, lag = F.col("levels"), F.col("lag")
    seen = history.visible(levels, lag)
    out = df.select(
        "lag", "levels",
        history.reanchor(levels, lag).alias("named"),
        *[history.lookback(seen, lag, m).alias(f"l{m}") for m in (3, 6, 12)],
        *[
            history.first_months(history.lookback(seen, lag, 12), lag, m).alias(f"f{m}")
            for m in (3, 6, 12)
        ],
        F.transform(history.long_form(levels, lag), lambda x: x["k"]).alias("ks"),
        history.pad(levels).alias("padded"),
    )
    for r in out.collect():
        want = _named(r.levels, r.lag)
        assert r.named == want, (r.lag, len(r.levels))
        assert r.padded == (r.levels + [None] * 49)[:49]
        for m in (3, 6, 12):
            frame = [v for v in (r[f"l{m}"] or []) if v is not None]
            assert frame == [v for v in want[1 : m + 1] if v is not None], (r.lag, len(r.levels), m)
            assert r[f"f{m}"] == r[f"l{m}"]
        if r.lag is not None and r.lag <= 48:
            n = max(r.lag, 0)
            assert r.ks == list(range(n, n + min(len(r.levels), 48 - n)))


def test_months(spark):
    day = dt.date(2023, 11, 30)
    r = spark.range(1).select(
        dates.months_ago(F.lit(day), AS_OF).alias("ago"),
        dates.tenure_months(F.lit(dt.date(2021, 5, 1)), F.lit(dt.date(2020, 3, 1))).alias("tenure"),
    ).first()
    assert (r.ago, r.tenure) == (2, 20)


@pytest.fixture(scope="module")
def limit_rows(spark):
    brackets = [(0, 0), (0, 10000), (10000, 25000), (25000, 30000), (30000, 40000), (40000, 50000),
                (50000, None), (1, 2), (None, None), (50000, 60000)]
    scores = [None, float("nan"), -1.0, 399.9, 400.0, 500.0, 600.0, 700.0, 800.0, 899.99, 900.0, 1000.0]
    bases = [None, float("nan"), -500.0, 0.0, 300.0, 301.0, 1234.0, 2000.0, 1e9, float("inf")]
    rows = [
        (b, s, None if lo is None else float(lo), None if hi is None else float(hi))
        for b, s, (lo, hi) in itertools.product(bases, scores, brackets)
    ]
    df = spark.createDataFrame(rows, "base double, score double, lo double, hi double")
    c = F.col
    limit = limits.credit_limit(c("base"), c("score"), c("lo"), c("hi"))
    joined = limits.with_grid(
        df.withColumns({"score_band": limits.score_band(c("score")),
                        "income_band": limits.income_band(c("lo"), c("hi"))}),
        limits.grid_frame(spark),
    )
    by_join = limits.limit_amount(c("base"), c("multiplier"), c("max_cap"), c("min_cap"))
    return joined.select("*", limit.alias("l1"), by_join.alias("l2")).collect()


def test_limit_properties(limit_rows):
    for r in limit_rows:
        assert r.l1 == (None if r.score is None else r.l2)
        if r.score is None or r.base is None or r.base != r.base:
            assert r.l1 is None
        else:
            assert r.l1 % 100 == 0 and 300 <= r.l1 <= 4000


def test_limit_bands(limit_rows):
    for r in limit_rows:
        want = "G"
        for band, bound in (("A", 900), ("B", 800), ("C", 700), ("D", 600), ("E", 500), ("F", 400)):
            if r.score is not None and r.score >= bound:
                want = band
                break
        assert r.score_band == want
        known = {(0, 0): 1, (0, 10000): 1, (10000, 25000): 2, (25000, 30000): 2, (30000, 40000): 3,
                 (40000, 50000): 3, (50000, None): 4}
        assert r.income_band == known.get((r.lo, r.hi), 1)
