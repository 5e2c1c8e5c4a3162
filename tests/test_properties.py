"""Property tests against brute-force Python on small random inputs (skewed on purpose)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelake.operators.features import calculate_patient_history
from carelake.operators.ml import auc_frame
from carelake.operators.quality import dedup_latest

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

visit = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]),  # one key holds about half the rows
    st.integers(0, 20),  # day
    st.integers(0, 3),  # hour
    st.sampled_from([True, False, None]),
)


def brute_history(rows):
    out = {}
    for i, (pid, day, hour, flag) in enumerate(rows):
        key = (day, hour, f"id{i:04d}")
        prior = [
            f for j, (p2, d2, h2, f) in enumerate(rows) if p2 == pid and (d2, h2, f"id{j:04d}") < key
        ]
        n = len(prior)
        known = [int(f) for f in prior if f is not None]
        s = sum(known) if known else None
        if n == 0:
            rate = 0.0
        elif s is None:
            rate = None
        else:
            import struct

            rate = struct.unpack("f", struct.pack("f", s / n))[0]
        out[f"id{i:04d}"] = (n, s, rate)
    return out


@SETTINGS
@given(st.lists(visit, min_size=1, max_size=60), st.booleans())
def test_history_matches_brute_force(spark, rows, split):
    data = [
        (f"id{i:04d}", pid, dt.date(2024, 1, 1) + dt.timedelta(days=d), dt.datetime(2024, 1, 1 + d, h), f)
        for i, (pid, d, h, f) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data, "appointment_id string, patient_id string, appointment_date date, appointment_time timestamp, no_show boolean"
    )
    got = {
        r.appointment_id: (r.previous_appointments, r.previous_no_shows, r.no_show_rate)
        for r in calculate_patient_history(df, split=split, hot_rows=1).collect()
    }
    assert got == brute_history(rows)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k1", "k1", "k2", "k3"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 3)), min_size=1, max_size=40))
def test_dedup_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, updated int, v int")
    got = sorted(tuple(r) for r in dedup_latest(df, ["k"], "updated").collect())
    expect = []
    for k in sorted({r[0] for r in rows}):
        group = [r for r in rows if r[0] == k]
        # newest first, NULL last; ties by the other column, descending, NULL last
        best = max(group, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        expect.append(best)
    assert got == sorted(expect)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from([0.0, 1.0])), min_size=2, max_size=80))
def test_auc_matches_brute_force(spark, rows):
    pos = [s for s, y in rows if y == 1.0]
    neg = [s for s, y in rows if y == 0.0]
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label double")
    got = auc_frame(df, "score", "label", n_chunks=3).first().auc
    if not pos or not neg:
        assert got is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


cell = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "a"]))


@SETTINGS
@given(st.lists(st.tuples(cell, cell), min_size=0, max_size=40))
def test_contract_and_profile_match_brute_force(spark, rows):
    from carelake.operators.quality import contract_check, profile_table

    df = spark.createDataFrame(rows, "k string, v string")
    cc = {r.column_name: r for r in contract_check(df, ["k", "v", "missing"], ["k"]).collect()}
    ks = [r[0] for r in rows]
    vs = [r[1] for r in rows]
    nonnull_k = [k for k in ks if k is not None]
    assert cc["k"].null_rows == ks.count(None)
    assert cc["k"].duplicate_rows == len(nonnull_k) - len(set(nonnull_k))
    assert (cc["v"].null_rows, cc["v"].duplicate_rows) == (vs.count(None), None)
    assert (cc["missing"].present, cc["missing"].null_rows) == (False, None)
    prof = {r.column_name: r for r in profile_table(df, exact=True).collect()}
    for name, values in (("k", ks), ("v", vs)):
        p = prof[name]
        assert (p.row_count, p.null_count) == (len(rows), values.count(None))
        assert p.distinct_count == len({x for x in values if x is not None})
