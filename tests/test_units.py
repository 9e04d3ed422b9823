"""Intervals of loaded business days against sets of days."""

from datetime import date, timedelta

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions import dates
from marketlake.operators import asof
from marketlake.plans import units

START = date(2023, 12, 20)
DAYS = [START + timedelta(n) for n in range(40)]
WORK = [d for d in DAYS if d.weekday() < 5]


def spans(df, *columns):
    return [tuple(r) for r in df.select("k", *columns).orderBy("k", columns[0]).collect()]


def runs(days):
    """Runs of neighbouring business days."""
    out = []
    for k, d in enumerate(WORK):
        if d in days:
            if out and k and out[-1][1] == WORK[k - 1]:
                out[-1][1] = d
            else:
                out.append([d, d])
    return [tuple(r) for r in out]


def test_business_numbers(spark):
    df = spark.sql("SELECT explode(sequence(date'1968-01-01', date'1972-12-31')) AS d")
    n = dates.business_number(F.col("d"))
    got = df.select("d", n.alias("n"), dates.business_day(n).alias("back")).orderBy("d").collect()
    count = -sum(1 for r in got if r.d < date(1970, 1, 5) and r.d.weekday() < 5)
    for r in got:
        assert r.n == count and (r.back == r.d if r.d.weekday() < 5 else r.back.weekday() == 0 and 0 < (r.back - r.d).days < 3)
        count += r.d.weekday() < 5


keyed = st.dictionaries(st.sampled_from("abc"), st.sets(st.sampled_from(DAYS)), min_size=1)


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(keyed, st.integers(0, 39), st.integers(0, 39))
def test_gaps(spark, sets, low, high):
    rows = [(k, d) for k, ds in sets.items() for d in sorted(ds)] * 2 + [(None, DAYS[0]), ("a", None)]
    df = spark.createDataFrame(rows, "k string, d date")
    held = units.islands(df, "k", "d")
    assert spans(held, *units.INTERVAL) == [(k, *r) for k in sorted(sets) for r in runs(sets[k])]
    # two loads that overlap and adjoin
    halves = [units.islands(df.filter(F.col("d") <= DAYS[b]).filter(F.col("d") >= DAYS[a]), "k", "d") for a, b in ((0, 20), (15, 39))]
    assert spans(units.united(halves[0].unionByName(halves[1]), "k"), *units.INTERVAL) == spans(held, *units.INTERVAL)
    due = spark.createDataFrame([(k, DAYS[low], DAYS[high]) for k in "abd"], "k string, start date, end date")
    got = spans(units.gaps(due, held, "k"), "start", "end")
    inside = [d for d in WORK if DAYS[low] <= d <= DAYS[high]]
    want = []
    for k in "abd":
        missing = [d for d in inside if d not in sets.get(k, ())]
        want += [(k, *r) for r in runs(missing)]
    assert got == want


# --- as-of per key -----------------------------------------------------------------------

ASOF_ROW = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.sampled_from(DAYS)), st.integers(0, 3))


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(ASOF_ROW, max_size=12), st.lists(ASOF_ROW, max_size=12), st.booleans())
def test_keyed_asof(spark, left, right, strict):
    one = spark.createDataFrame(left, "k string, d date, n int")
    two = spark.createDataFrame(right, "k string, at date, v int")
    got = asof.keyed_asof(one, two, "k", "d", "at", ["at", "v"], order=["v"], strict=strict)
    want = []
    for k, d, n in left:
        earlier = [(at, v) for rk, at, v in right if k is not None and rk == k and at is not None and d is not None and (at < d or at == d and not strict)]
        want.append((k, d, n, *max(earlier, default=(None, None))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_asof_windows_are_partitioned(spark):
    df = spark.createDataFrame([("a", DAYS[0])], "k string, d date")
    plan = asof.keyed_asof(df, df.withColumnRenamed("d", "at"), "k", "d", "at", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
