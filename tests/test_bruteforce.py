"""Operators against brute-force Python on random small inputs."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storefront.functions import id_list, round_ratio
from storefront.operators import exclude_keys, rows_at_extreme, substrings

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
small_ints = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


@SETTINGS
@given(probe=st.lists(small_ints, max_size=8), values=st.lists(small_ints, max_size=6))
def test_exclude_keys_is_sql_not_in(spark, probe, values):
    p = spark.createDataFrame([(v,) for v in probe], "k int")
    s = spark.createDataFrame([(v,) for v in values], "k int")
    got = sorted((r[0] for r in exclude_keys(p, "k", s, "k").collect()), key=repr)

    def not_in(x):
        if not values:
            return True
        if x is None:
            return False
        if x in values:
            return False
        return None not in values  # any NULL makes the answer unknown

    assert got == sorted((x for x in probe if not_in(x)), key=repr)


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 9)), max_size=15),
       first=st.booleans())
def test_rows_at_extreme_keeps_all_ties(spark, data, first):
    df = spark.createDataFrame(data, "e string, v int, payload int")
    got = sorted(tuple(r) for r in rows_at_extreme(df, "e", "v", first=first).collect())
    pick = min if first else max
    best = {e: pick(v for e2, v, _ in data if e2 == e) for e, _, _ in data}
    assert got == sorted(t for t in data if t[1] == best[t[0]])


texts = st.one_of(st.none(), st.text(alphabet="0123456789, ", max_size=7), st.just("null"), st.just(""))


@SETTINGS
@given(rows=st.lists(texts, max_size=6), ids=st.lists(st.integers(0, 30), min_size=1, max_size=8, unique=True))
def test_substring_join_equals_like(spark, rows, ids):
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    keys = spark.createDataFrame([(str(i),) for i in ids], "tid string")
    hits = df.select(F.explode(substrings(F.col("t"), F.array(F.lit(1), F.lit(2), F.lit(3)))).alias("tid")).join(keys, "tid")
    got = sorted(r[0] for r in hits.collect())
    expected = sorted(str(i) for t in rows if t is not None for i in ids if str(i) in t)
    assert got == expected


@SETTINGS
@given(n=st.integers(-10**9, 10**9), d=st.integers(-10**6, 10**6), scale=st.sampled_from([1, 100]))
def test_round_ratio_is_exact(spark, n, d, scale):
    got = spark.createDataFrame([(n, d)], "n long, d long").select(round_ratio("n", "d", scale=scale)).first()[0]
    if d == 0:
        assert got is None
    else:
        assert got == float(_half_away(Decimal(n) * scale, Decimal(d)))


def _half_away(num: Decimal, den: Decimal) -> Decimal:
    """num / den rounded to 2 places, halves away from zero."""
    exact = abs(num) / abs(den)
    rounded = exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return rounded if (num < 0) == (den < 0) or rounded == 0 else -rounded


@SETTINGS
@given(text=texts)
def test_id_list_matches_python(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(id_list("t")).first()[0]
    if text is None or text.strip() in ("", "null"):
        expected = []
    else:
        expected = []
        for tok in re.split(r",\s*", text.strip()):
            tok = tok.strip()
            if tok:
                expected.append(tok)
    assert got == expected


@SETTINGS
@given(text=st.one_of(st.none(), st.text(alphabet="0123456789, ", max_size=8)),
       token=st.text(alphabet="0123456789", min_size=1, max_size=2))
def test_in_delimited_matches_split(spark, text, token):
    from storefront.functions import in_delimited
    got = spark.createDataFrame([(text, token)], "t string, k string").select(in_delimited("t", "k")).first()[0]
    assert got == (None if text is None else token in text.split(", "))


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from("xy"), st.text(alphabet="abc", min_size=1, max_size=3)),
                     max_size=10))
def test_compose_list_is_sorted_join(spark, data):
    from storefront.operators import compose_list
    df = spark.createDataFrame(data, "k string, v string")
    got = dict((r[0], r[1]) for r in compose_list(df, ["k"], "v", "lst").collect())
    expected = {k: ", ".join(sorted(v for k2, v in data if k2 == k)) for k, _ in data}
    assert got == expected


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from("xyz")), max_size=12))
def test_top_by_count_matches_python(spark, data):
    from collections import Counter

    from storefront.operators import top_by_count
    df = spark.createDataFrame(data, "c string, item string")
    got = sorted(tuple(r) for r in top_by_count(df, "c", "item").collect())
    counts = Counter(data)
    best = {c: max(n for (c2, _), n in counts.items() if c2 == c) for c, _ in data}
    assert got == sorted((c, i, n) for (c, i), n in counts.items() if n == best[c])


@SETTINGS
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(-1, 7)), st.one_of(st.none(), st.integers(0, 3))),
                     max_size=10))
def test_validate_rows_matches_sql_rules(spark, data):
    from storefront.operators import validate_rows
    df = spark.createDataFrame(data, "rating int, k int")
    valid, bad = validate_rows(df, not_null=["rating"], checks={"1-5": F.col("rating").between(1, 5)})
    ok = [(r, k) for r, k in data if r is not None and 1 <= r <= 5]
    assert sorted(map(tuple, valid.collect()), key=repr) == sorted(ok, key=repr)
    expected_bad = [(r, k, "rating is null") for r, k in data if r is None] + \
                   [(r, k, "1-5") for r, k in data if r is not None and not 1 <= r <= 5]
    assert sorted(map(tuple, bad.collect()), key=repr) == sorted(expected_bad, key=repr)


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from("pq"), st.integers(1, 30), st.one_of(st.none(), st.integers(0, 9))),
                     max_size=12))
def test_period_sums_match_python(spark, data):
    from storefront.operators import period_sums
    df = spark.createDataFrame(data, "k string, w int, s int")
    got = {r[0]: (r[1], r[2]) for r in period_sums(df, "s", {"a": F.col("w").between(1, 10),
                                                             "b": F.col("w").between(11, 20)}, ["k"]).collect()}

    def total(k, lo, hi):
        vals = [s for k2, w, s in data if k2 == k and lo <= w <= hi and s is not None]
        return sum(vals) if vals else None

    assert got == {k: (total(k, 1, 10), total(k, 11, 20)) for k, _, _ in data}
