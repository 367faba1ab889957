"""Property tests: Spark expressions against plain-Python statements of the same rules,
each example a batch of random cases run as one DataFrame."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tarmac.functions import columns as C
from tarmac.operators import keyed, registry
from tarmac.operators.features import delay_bucketizer
from tarmac.schemas import ACTIVATION_SCHEMA

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def py_model_ids(text):
    if text is None:
        return None
    if text.startswith("["):
        text = text[1:]
    if text.endswith("]"):
        text = text[:-1]
    items = [p.strip("".join(chr(c) for c in range(33))).replace('"', "") for p in text.split(",")]
    return [p for p in items if p]


def py_artifact_id(key):
    parts = key.split("/")
    if len(parts) < 2:
        return None
    d = parts[1].split(".")
    if len(d) >= 3 and d[-1] == "bin":
        return d[-2]
    return None


def py_class(x):
    if x < -15.0:
        return 0.0
    if x < 0.0 or (x == 0.0 and str(x).startswith("-")):
        return 1.0
    if x < 30.0:
        return 2.0
    return 3.0


@SETTINGS
@given(st.lists(st.text(alphabet='[]", ab\t', max_size=12), min_size=1, max_size=40))
def test_parse_model_ids_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.ids for r in df.select("i", C.parse_model_ids("t").alias("ids")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_model_ids(t), t


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["models", "m", "bin", "x", "", "a.b", "a.b.bin"]), min_size=1,
                         max_size=4).map(lambda ps: "/".join(ps)), min_size=1, max_size=40))
def test_artifact_id_matches_python(spark, keys):
    keys = [k.replace("x", "x.y.bin") for k in keys]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string")
    got = {r.i: r.uid for r in df.select("i", C.artifact_id("key").alias("uid")).collect()}
    for i, k in enumerate(keys):
        assert got[i] == py_artifact_id(k), k


@SETTINGS
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=True, width=64),
                          st.sampled_from([-15.0, -0.0, 0.0, 30.0, -15.000000000000002, 29.999999999999996])),
                min_size=1, max_size=40))
def test_delay_class_matches_bucketizer(spark, xs):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, ArrDelay double")
    expr = {r.i: r.c for r in df.select("i", C.delay_class("ArrDelay").alias("c")).collect()}
    ml = {r.i: r.ArrDelayBucket for r in delay_bucketizer().transform(df).collect()}
    for i, x in enumerate(xs):
        assert expr[i] == ml[i] == py_class(x), x


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 99)), min_size=1, max_size=60,
                unique_by=lambda t: (t[0], t[1])))
def test_last_wins_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    got = {r.k: (r.seq, r.v) for r in keyed.last_wins(df, ["k"], ["seq"]).collect()}
    want = {}
    for k, seq, v in sorted(rows, key=lambda t: t[1]):
        want[k] = (seq, v)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("pqrs"), st.booleans()), min_size=1, max_size=40))
def test_active_set_matches_list_operations(spark, ops):
    """Activate = remove then append; deactivate = remove (applied in time order)."""
    t0 = dt.datetime(2024, 1, 1)
    log = [(m, "activate" if on else "deactivate", t0 + dt.timedelta(seconds=i)) for i, (m, on) in enumerate(ops)]
    active = []
    for m, action, _ in log:
        active = [x for x in active if x != m]
        if action == "activate":
            active.append(m)
    df = spark.createDataFrame(log, ACTIVATION_SCHEMA)
    assert [r.model_id for r in registry.active_set(df).collect()] == active
