"""Operators against brute force on small random frames (Hypothesis)."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op

KEYS = st.sampled_from(["a", "b", None])
TS = st.one_of(st.none(), st.integers(0, 5).map(lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)))
ROW = st.tuples(KEYS, st.sampled_from(["x", "y"]), st.integers(-3, 3), TS)
SCHEMA = "k1 string, k2 string, v int, _ingested_at timestamp"
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def brute_latest(data):
    best = {}
    for r in data:
        key = (r[0], r[1])
        rank = (r[3] is not None, r[3] or dt.datetime.min, -r[2])  # latest; tie -> smallest v
        if key not in best or rank > best[key][0]:
            best[key] = (rank, r)
    return sorted((r for _, r in best.values()), key=lambda t: tuple((v is not None, v) for v in t))


@SETTINGS
@given(st.lists(ROW, max_size=25))
def test_dedup_latest_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    out = op.dedup_latest(df, ["k1", "k2"])
    assert rows(out) == brute_latest(data)
    assert rows(op.dedup_latest(out, ["k1", "k2"])) == rows(out)


@SETTINGS
@given(st.lists(ROW, max_size=25))
def test_split_partitions_the_input(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    on_time, late = op.late_arrival_split(df, as_of="2024-01-05", lookback_days=2)
    n_null = sum(1 for r in data if r[3] is None)
    assert on_time.count() + late.count() + n_null == len(data)
    assert late.filter(F.to_date("_ingested_at") < F.lit("2024-01-03").cast("date")).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["J1", "J2"]), st.sampled_from(["m1", "m2", "m3"]),
                          st.integers(2019, 2020), st.one_of(st.none(), st.integers(-5, 5))), max_size=30))
def test_pivot_preserves_sums(spark, data):
    df = spark.createDataFrame(data, "jurisdiction string, measure string, year int, obs_value int")
    pv = op.pivot_measures(df, {"m1": "a", "m2": "b"})
    pdf = pd.DataFrame(data, columns=["jurisdiction", "measure", "year", "obs_value"])
    wanted = pdf[pdf.measure.isin(["m1", "m2"])]
    expected = {}
    for (j, y), g in wanted.groupby(["jurisdiction", "year"]):
        cell = lambda m: (g[g.measure == m].obs_value.dropna().sum() if g[g.measure == m].obs_value.notna().any() else None)
        expected[(j, y)] = (cell("m1"), cell("m2"))
    got = {(r["jurisdiction"], r["year"]): (r["a"], r["b"]) for r in pv.collect()}
    assert got == expected


@st.composite
def json_stat_docs(draw):
    n_dims = draw(st.integers(1, 3))
    ids, sizes, dims, orders = [], [], {}, []
    for d in range(n_dims):
        name = f"d{d}"
        size = draw(st.integers(1, 3))
        codes = [f"{name}c{i}" for i in range(size)]
        form = draw(st.sampled_from(["map", "list", "none"]))
        labels = {c: f"L{c}" for c in codes if draw(st.booleans()) or form == "none"}
        cat = {"label": labels}
        if form == "map":
            pairs = list(enumerate(codes))
            pairs = draw(st.permutations(pairs))  # object order is not position order
            cat["index"] = {c: i for i, c in pairs}
        elif form == "list":
            cat["index"] = codes
        else:
            cat["label"] = {c: f"L{c}" for c in codes}  # label keys carry the order
        ids.append(name)
        sizes.append(size)
        dims[name] = {"category": cat}
        orders.append(codes)
    total = 1
    for s in sizes:
        total *= s
    cells = draw(st.lists(st.one_of(st.none(), st.integers(-9, 9)), min_size=total, max_size=total))
    sparse = draw(st.booleans())
    value = {str(i): v for i, v in enumerate(cells) if v is not None or draw(st.booleans())} if sparse else cells
    return {"id": ids, "size": sizes, "dimension": dims, "value": value}, orders


def brute_decode(doc, orders):
    sizes, ids = doc["size"], doc["id"]
    items = ([(int(k), v) for k, v in doc["value"].items()] if isinstance(doc["value"], dict)
             else [(i, v) for i, v in enumerate(doc["value"]) if v is not None])
    out = []
    for offset, v in items:
        coords, rest = [], offset
        for s in reversed(sizes):
            coords.append(rest % s)
            rest //= s
        coords.reverse()
        row = []
        for name, idx, codes in zip(ids, coords, orders):
            code = codes[idx]
            row += [code, doc["dimension"][name]["category"]["label"].get(code, code)]
        out.append(tuple(row) + (None if v is None else float(v),))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


@SETTINGS
@given(json_stat_docs())
def test_json_stat_decode_matches_brute_force(spark, generated):
    import json

    doc, orders = generated
    docs = spark.createDataFrame([("doc", json.dumps(doc))], "doc string, text string")
    out = op.decode_json_stat(docs, doc["id"])
    assert rows(out) == brute_decode(doc, orders)


def _element(values, p):
    vals = sorted(v for v in values if v is not None)
    if not vals:
        return None
    import math

    return vals[max(0, math.ceil(p * len(vals)) - 1)]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2020, 2021]), st.one_of(st.none(), st.integers(0, 6)),
                          st.one_of(st.none(), st.integers(-3, 6))), min_size=1, max_size=30))
def test_audit_signal_matches_brute_force(spark, data):
    rows_in = [(f"J{i}", y, None if e is None else float(e), None if p is None else float(p)) for i, (y, e, p) in enumerate(data)]
    df = spark.createDataFrame(rows_in, "id string, year int, employees double, profit_per_employee double")
    got = {r["id"]: r["audit_signal"] for r in op.qualify_audit(df).collect()}
    for rid, y, e, p in rows_in:
        same = [r for r in rows_in if r[1] == y]
        med, q3 = _element([r[2] for r in same], 0.5), _element([r[3] for r in same], 0.75)
        a = None if e is None or med is None else e > med
        b = None if p is None or q3 is None else p >= q3
        want = False if (a is False or b is False) else (None if (a is None or b is None) else True)
        assert got[rid] == want, (rid, e, p, med, q3)
