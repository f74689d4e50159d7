import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.codes import code_in, code_mask, mask_bits, normalize_code, prefix_match, prefix_masks, prefix_regex, trie_regex
from cohortkit.functions.dates import parse_birth_date, parse_event_ts
from cohortkit.functions.format import with_fixed2


def test_normalize_code_t2(spark):
    df = spark.createDataFrame([("F03, G30.9",), (" g23.2",), ("EXEL-S1",), (None,), ("...",)], "c string")
    got = [r[0] for r in df.select(normalize_code("c")).collect()]
    assert got == ["F03G309", "G232", "EXELS1", None, ""]


def test_prefix_match_t1(spark):
    df = spark.createDataFrame([("R410",), ("R41",), ("R4",), ("F03G309",), (None,), ("G3180",)], "c string")
    got = [r[0] for r in df.select(prefix_match("c", ["R41", "R418", "F03", "G318"])).collect()]
    assert got == [True, True, False, True, False, True]
    assert [r[0] for r in df.select(prefix_match("c", [])).collect()] == [False] * 6


def test_prefix_regex_e4():
    assert prefix_regex(["R41", "R418", "F03"]) == "^(?:R418|F03|R41)"
    with pytest.raises(ValueError):
        prefix_regex([])


def test_code_in(spark):
    df = spark.createDataFrame([("A",), (None,), ("B",)], "c string")
    assert [r[0] for r in df.select(code_in("c", ["A"])).collect()] == [True, False, False]


def test_parse_event_ts_text_t3_t5(spark):
    rows = ["20150101", "2015-01-01", "2015-01-01 10:11:12", "2015", "20150231", "n/a", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r[0] for r in df.select(parse_event_ts("s", T.StringType())).collect()]
    assert got[:3] == [dt.datetime(2015, 1, 1), dt.datetime(2015, 1, 1), dt.datetime(2015, 1, 1, 10, 11, 12)]
    assert got[3:] == [None, None, None, None]
    assert df.select(parse_event_ts("s", T.StringType())).schema[0].dataType == T.TimestampNTZType()


def test_parse_event_ts_integer_t3(spark):
    df = spark.createDataFrame([(20150101,), (20150231,)], "d int")
    got = [r[0] for r in df.select(parse_event_ts("d", T.IntegerType())).collect()]
    assert got == [dt.datetime(2015, 1, 1), None]


def test_parse_event_ts_zone_free(spark):
    # a wall-clock time inside a DST gap of the session zone keeps its value
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2015-03-08 02:30:00",)], "s string")
        got = df.select(parse_event_ts("s", T.StringType()).cast("string")).collect()[0][0]
        assert got == "2015-03-08 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_birth_date_e3(spark):
    df = spark.createDataFrame([(19500101.0,), (None,), (19500231.0,)], "d double")
    got = [r[0] for r in df.select(parse_birth_date("d", T.DoubleType())).collect()]
    assert got == [dt.date(1950, 1, 1), None, None]
    s = spark.createDataFrame([("19500101.0",), ("19500101",), ("bad",)], "d string")
    got = [r[0] for r in s.select(parse_birth_date("d", T.StringType())).collect()]
    assert got == [dt.date(1950, 1, 1), dt.date(1950, 1, 1), None]


def test_fixed2_matches_python_t19(spark):
    import random

    random.seed(7)
    vals = [0.125, 0.265, 0.285, 12.125, 0.0, 100.0, 99.995, 0.005, 1 / 3 * 100, 2.675, 1e-9, 21.70]
    vals += [random.randint(0, 500) / random.randint(1, 500) * 100.0 for _ in range(500)]
    vals += [-0.125, -12.345, 123456.785, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = with_fixed2(df, [("x", "t", "r")]).collect()
    for r in rows:
        if r.x is None:
            assert r.t is None and r.r is None
            continue
        assert r.t == f"{r.x:.2f}", r.x
        assert r.r == round(r.x, 2), r.x


def test_derived_sources_do_not_depend_on_session_zone(spark):
    """Derived date texts come from timestamp fields, so a zone whose DST starts at midnight
    (here Sao Paulo, 1999-10-03) cannot shift them."""
    from cohortkit.checks.compare import rows_of
    from cohortkit.plans.queries import QUERIES

    base = rows_of(QUERIES["parse_dates"](spark, "/root/testdata/sf0.001").toPandas())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        other = rows_of(QUERIES["parse_dates"](spark, "/root/testdata/sf0.001").toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other


def test_fixed_lists_are_the_checked_ones():
    """The code lists and step names were compared with the published ones; the oracle takes them from
    the same place as the pipeline, so a change must show up here."""
    import hashlib

    from cohortkit.operators.reports import EXCLUSION_STEPS, FLOW_STEPS
    from cohortkit.sources.codemaps import CodeMaps

    m = CodeMaps.default()
    pins = {
        "5fabf55cd8661d2e": (m.dementia, m.mci, m.schizophrenia, m.review),
        "afe09c762842a436": (m.medication, m.clozapine),
        "9dea91823a9d6b55": (m.radiotherapy, m.billing),
        "d31b50bccb3394af": (EXCLUSION_STEPS, FLOW_STEPS),
    }
    for pin, value in pins.items():
        assert hashlib.sha256(repr(value).encode()).hexdigest()[:16] == pin


def test_rounding_of_large_values_matches_python(spark):
    from cohortkit.functions.format import with_fixed2

    values = [1099511627776.126, 2.0 ** 45 + 0.125, -(2.0 ** 51) - 0.5, 2.0 ** 53, 123456789012.345, 0.005, 2.675]
    df = with_fixed2(spark.createDataFrame([(v,) for v in values], "x double"), [("x", "t", "r")])
    for r in df.collect():
        assert r["t"] == f"{r['x']:.2f}" and r["r"] == round(r["x"], 2), r


def _random_codes(seed, n, longest=5):
    import random

    r = random.Random(seed)
    return ["".join(r.choice("AF0139") for _ in range(r.randint(1, longest))) for _ in range(n)]


def test_trie_regex_matches_like_the_alternation():
    import re

    for seed, n in enumerate((1, 2, 5, 30, 400)):
        prefixes = _random_codes(seed, n)
        tree, flat = re.compile(trie_regex(prefixes)), re.compile(prefix_regex(prefixes))
        for code in [*_random_codes(99 + seed, 500, 7), *prefixes, ""]:
            assert bool(tree.match(code)) == bool(flat.match(code)) == code.startswith(tuple(prefixes)), code


def test_code_mask_e7(spark):
    for seed, n in enumerate((0, 1, 4, 12, 60)):
        groups = {f"g{i}": _random_codes(10 * seed + i, n) for i in range(4)}
        codes = [*_random_codes(50 + seed, 300, 7), *groups["g0"], "", None]
        got = spark.createDataFrame([(c,) for c in codes], "c string").select("c", code_mask("c", groups).alias("m")).collect()
        bits = mask_bits(groups)
        for r in got:
            assert r["m"] == sum(bits[g] for g, ps in groups.items() if r["c"] is not None and r["c"].startswith(tuple(ps))), r["c"]


def test_prefix_masks_keep_what_adds_a_group():
    assert prefix_masks({"a": ["F0", "F03"], "b": ["F03", "F031"], "c": [""]}) == {"F0": 1, "F03": 3}


def test_many_prefixes_cost_no_more_than_few(spark):
    """The plan holds one lookup for each length and mask, whatever the number of prefixes."""
    few = {"a": [f"F{i:03d}" for i in range(30)], "b": [f"G{i:03d}" for i in range(30)]}
    many = {"a": [f"F{i:04d}" for i in range(2500)], "b": [f"G{i:04d}" for i in range(2500)]}
    df = spark.range(0, 2_000_000, 1, 4).select(F.concat(F.when(F.col("id") % 3 == 0, "F").otherwise("K"), F.lpad((F.col("id") % 9973).cast("string"), 4, "0")).alias("c"))

    def seconds(groups):
        import time

        every = [p for g in groups.values() for p in g]
        q = df.filter(prefix_match("c", every)).agg(F.bit_or(code_mask("c", groups)).alias("m"))
        q.collect()
        start = time.time()
        q.collect()
        return time.time() - start

    plan = df.select(code_mask("c", many).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring(") == 2 and plan.count("INSET") + plan.count("IN (") + plan.count("in (") <= 4
    assert seconds(many) < 2 * seconds(few) + 0.5
