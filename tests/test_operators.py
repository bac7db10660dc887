"""Operators: edge cases, invariants and equivalence with the reference's iterative rules."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marginflow.operators import arrival, bucketing, dedup, joins, products, reshape
from marginflow.operators.fill import fill_nearest
from marginflow.operators.volatility import complete_surface
from marginflow.operators.xml import extract_roles, parse_roles, recover_aliases
from marginflow.sources import fixtures as fx


@pytest.fixture(scope="module")
def intervals(spark):
    return bucketing.tenor_grid(fx.grid(spark))


def test_allocate_cases(spark, intervals):
    df = spark.createDataFrame([(1, 10), (2, 365), (3, 270), (4, 20000)], "k int, d int") \
        .withColumn("a", F.lit(100).cast("decimal(23,8)"))
    out = bucketing.allocate(df, "d", "a", intervals, "ir").collect()
    got = sorted((r.k, r.bucket, round(float(r.value), 4)) for r in out)
    assert got == [(1, "2W", 100.0), (2, "1Y", 100.0), (3, "1Y", 48.6486), (3, "6M", 51.3514), (4, "30Y", 100.0)]


def test_allocate_on_fine_grids_and_null_days(spark):
    """The same rule on a grid of 2,000 vertices; null days fall on the first vertex or go."""
    rnd = random.Random(7)
    vertices = sorted(rnd.sample(range(1, 90000), 2000))
    fine = spark.createDataFrame([("ir", v, f"v{v}") for v in vertices], "grid_type string, days int, label string")
    days = [None, -1, 0, vertices[0], vertices[-1], 89999, 200000] + [rnd.randint(0, 95000) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(days)), "k int, d int").withColumn("a", F.lit(7).cast("decimal(23,8)"))
    iv = bucketing.tenor_grid(fine)
    for on_bad in ("first", "null"):
        got = {}
        for r in bucketing.allocate(df, "d", "a", iv, "ir", on_bad=on_bad).collect():
            got.setdefault(r.k, {})[r.bucket] = float(r.value)
        for k, d in enumerate(days):
            if d is None and on_bad == "null":
                assert k not in got
                continue
            d = -1 if d is None else d
            low = max((v for v in vertices if v <= d), default=None)
            high = min((v for v in vertices if v > d), default=None)
            if low is None or high is None or low == d:
                assert got[k] == {f"v{low if low is not None else high}": 7.0}
            else:
                share = 7 * (high - d) / (high - low)
                assert got[k] == pytest.approx({f"v{low}": share, f"v{high}": 7 - share})


def test_interval_joins_are_hash_joins(spark, intervals, capsys):
    df = spark.createDataFrame([(1, 10)], "k int, d int").withColumn("a", F.lit(1).cast("decimal(23,8)"))
    bucketing.allocate(df, "d", "a", intervals, "ir").explain()
    bucketing.nearest_tenor(df, "d", intervals).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and plan.count("HashJoin") + plan.count("SortMergeJoin") >= 2


def test_allocate_conserves_amount(spark, intervals):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(-5, 15000), rnd.randint(-10**6, 10**6) / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, d int, a double").withColumn("a", F.col("a").cast("decimal(23,8)"))
    out = bucketing.allocate(df, "d", "a", intervals, "ir")
    per_in = {r.k: r.a for r in df.collect()}
    per_out = {}
    for r in out.collect():
        per_out[r.k] = per_out.get(r.k, 0) + r.value
        assert abs(r.value) <= abs(per_in[r.k])
    assert per_in == per_out


def test_rescale_and_nearest(spark, intervals):
    df = spark.createDataFrame([(270, "DeltaIR")], "d int, source_name string").select(
        "d", "source_name", F.lit(100).cast("decimal(23,8)").alias("amount"),
        F.lit(80).cast("decimal(23,8)").alias("amount_cup0"), F.lit(50).cast("decimal(23,8)").alias("pnlvar_delta_ir"),
        F.lit(0).cast("decimal(23,8)").alias("pnlvar_vega_ir"), F.lit("Risk_IRCurve").alias("risk_type"))
    a = bucketing.allocate_by_risk_type(df, "d", "amount", intervals)
    r = {x.bucket: x for x in bucketing.rescale_by_allocation(a).collect()}
    assert round(float(r["6M"].amount), 4) == 51.3514
    assert round(float(r["6M"].amount_cup0), 4) == 41.0811
    assert round(float(r["6M"].pnlvar_delta_ir), 4) == 25.6757
    n = spark.createDataFrame([(60,), (270,), (-1,)], "d int")
    got = [x.snapped for x in bucketing.nearest_tenor(n, "d", intervals).orderBy("d").collect()]
    assert got == ["2W", "1M", "6M"]


def test_allocate_other_risk_type_passes_through(spark, intervals):
    df = spark.createDataFrame([(10, "PV")], "d int, risk_type string").withColumn("amount", F.lit(5).cast("decimal(23,8)"))
    r = bucketing.allocate_by_risk_type(df, "d", "amount", intervals).collect()
    assert [(x.bucket, float(x.value)) for x in r] == [("", 0.0)]


def _iterative_fill(vals):
    vals = list(vals)
    if all(v is None for v in vals):
        return vals
    while any(v is None for v in vals):
        prev = list(vals)
        for i, v in enumerate(prev):
            if v is None:
                lag = prev[i - 1] if i > 0 else None
                lead = prev[i + 1] if i + 1 < len(prev) else None
                vals[i] = lag if lag is not None else lead
    return vals


def test_fill_nearest_examples(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, 5, None, None, None, 9, None])], "i int, v int") \
        .withColumn("p", F.lit(1))
    got = [r.v for r in fill_nearest(df, "v", ["p"], ["i"]).orderBy("i").collect()]
    assert got == [5, 5, 5, 5, 9, 9, 9]
    empty = spark.createDataFrame([(0, None), (1, None)], "i int, v int").withColumn("p", F.lit(1))
    rows = fill_nearest(empty, "v", ["p"], ["i"]).collect()
    assert all(r.v is None and r.unfillable for r in rows)


def test_fill_nearest_equals_iterative_rule(spark):
    rnd = random.Random(11)
    rows, expect = [], {}
    for p in range(120):
        n = rnd.randint(1, 12)
        vals = [None if rnd.random() < 0.55 else rnd.randint(1, 99) for _ in range(n)]
        for i, v in enumerate(vals):
            rows.append((p, i, v))
        for i, v in enumerate(_iterative_fill(vals)):
            expect[(p, i)] = v
    df = spark.createDataFrame(rows, "p int, i int, v int")
    got = {(r.p, r.i): r.v for r in fill_nearest(df, "v", ["p"], ["i"]).collect()}
    assert got == expect


def _recursive_period(ts, cutoff=dt.time(18), hol=((1, 1), (1, 5), (25, 12))):
    def non_working(d):
        return d.weekday() >= 5 or (d.day, d.month) in hol

    def start(t):
        if non_working(t.date()) or t.time() < cutoff:
            return start(dt.datetime.combine(t.date() - dt.timedelta(days=1), cutoff))
        return dt.datetime.combine(t.date(), cutoff)

    def end(t, exclude_exact=True):
        after = t.time() >= cutoff if exclude_exact else t.time() > cutoff
        if non_working(t.date()) or after:
            return end(dt.datetime.combine(t.date() + dt.timedelta(days=1), cutoff), False)
        return dt.datetime.combine(t.date(), cutoff)

    return start(ts), end(ts)


def test_working_period_cases(spark):
    ts = [dt.datetime(2019, 5, 17, 19), dt.datetime(2019, 5, 1, 12), dt.datetime(2019, 5, 20, 18)]
    df = spark.createDataFrame([(t,) for t in ts], "loaded_at timestamp_ntz")
    got = [(r.period_start, r.period_end) for r in arrival.working_period(df).collect()]
    assert got == [(dt.datetime(2019, 5, 17, 18), dt.datetime(2019, 5, 20, 18)),
                   (dt.datetime(2019, 4, 30, 18), dt.datetime(2019, 5, 2, 18)),
                   (dt.datetime(2019, 5, 20, 18), dt.datetime(2019, 5, 21, 18))]


def test_working_period_equals_recursive_rule(spark):
    rnd = random.Random(5)
    base = dt.datetime(2018, 12, 20)
    ts = [base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 500)) for _ in range(3000)]
    ts += [dt.datetime(2019, 12, 24, 18), dt.datetime(2019, 12, 31, 18), dt.datetime(2020, 5, 1, 17, 59)]
    df = spark.createDataFrame([(t,) for t in ts], "loaded_at timestamp_ntz")
    for r in arrival.working_period(df).collect():
        assert (r.period_start, r.period_end) == _recursive_period(r.loaded_at)
        assert r.period_start <= r.loaded_at < r.period_end


def test_readiness_app_without_rows_sees_everything_new(spark):
    log = fx.file_log(spark, "/root/testdata/sf0.001")
    tagged = arrival.tag_file_sets(log, fx.MASKS)
    r = arrival.load_readiness(tagged, fx.MASKS, "no-such-app").collect()
    sets = arrival.file_sets(tagged).groupBy(*arrival.PERIOD, "load").count().collect()
    n = {(x.period_start, x.load): x["count"] for x in sets}
    for x in r:
        assert x.new_load_files == n.get((x.period_start, x.load), 0)


def test_extract_roles_no_match_and_any_depth(spark):
    docs = spark.createDataFrame([
        ("<GLOBAL><OPERATIVES><OPERATIVE><RDR_Code_Operative>R1</RDR_Code_Operative><ROLES><ROLE_IDENTIFIER>"
         "<Role_Identifier>X1</Role_Identifier><Role_Identifier_Context>OTHER</Role_Identifier_Context>"
         "</ROLE_IDENTIFIER></ROLES></OPERATIVE></OPERATIVES></GLOBAL>",),
        ("<GLOBAL><A><OPERATIVE><RDR_Code_Operative>R2</RDR_Code_Operative><B><ROLE_IDENTIFIER>"
         "<Role_Identifier>C2</Role_Identifier><Role_Identifier_Context>MUREXID</Role_Identifier_Context>"
         "</ROLE_IDENTIFIER></B></OPERATIVE></A></GLOBAL>",)], "doc string")
    assert extract_roles(docs.limit(1)).count() == 0
    deep = extract_roles(docs).collect()
    assert [(r.identifier, r.ref_code, r.origin) for r in deep] == [("C2", "R2", "MUREXID")]


def test_extract_roles_same_either_way_at_declared_depth(spark):
    role = ("<ROLE_IDENTIFIER><Role_Identifier>C1</Role_Identifier><Role_Identifier_Context>MUREXID</Role_Identifier_Context>"
            "<Role_Identifier_Context>CALYPSOID</Role_Identifier_Context></ROLE_IDENTIFIER>")
    docs = spark.createDataFrame([(f"<GLOBAL><OPERATIVES><OPERATIVE><RDR_Code_Operative>R1</RDR_Code_Operative><ROLES>{role}</ROLES>"
                                   f"</OPERATIVE><OPERATIVE><ROLES>{role}</ROLES></OPERATIVE></OPERATIVES></GLOBAL>",)], "doc string")
    rows = [sorted(map(tuple, extract_roles(docs, any_depth=x).collect())) for x in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) == 4 and {r[1] for r in rows[0]} == {"R1", ""}


def test_aliases_of_shared_codes_stay_linear(spark):
    """300 roles of one code, all in scope: 300 rows before the dedup, not 90,000."""
    roles = spark.createDataFrame([(f"C{i}", None, "MUREXID") for i in range(300)], "identifier string, ref_code string, origin string")
    scope = roles.select("ref_code", F.lit("0182").alias("entity"), F.col("identifier").alias("contract"),
                         F.lit("1996-01-01").alias("effective"))
    got = recover_aliases(roles, scope).collect()
    assert len(got) == 300 and {r.contract for r in got} == {"C0"}


def test_null_safe_trade_join(spark):
    s = spark.createDataFrame([(None, "P", 1)], "trade_id string, portfolio string, v int")
    t = spark.createDataFrame([(None, "P", "01/01/2020", "", "1,0", "0,0", "EUR", "USD")],
                              "trade_id string, portfolio string, booked_text string, maturity_text string, "
                              "pay_text string, receive_text string, pay_ccy string, receive_ccy string")
    assert joins.join_trades(s, t).count() == 1


def test_dominant_product(spark):
    rows = spark.createDataFrame([("ST-1", 1), ("ST-1", 2), ("ST-1", 3)], "strategy string, product_id int")
    prods = spark.createDataFrame([(1, 5, "Y", "Y", "a", "b"), (2, 9, "Y", "N", "a", "b"), (3, 9, "Y", "Y", "a", "b")],
                                  "product_id int, weight int, eligible string, credit_risk string, "
                                  "product_class string, schedule_class string")
    d = products.dominant_product(rows, prods).collect()[0]
    assert (d.weight, d.credit_risk, d.dominant_product) == (9, "Y", 3)


def test_schedule_and_fx_legs(spark):
    df = spark.createDataFrame([(7, 3)], "market_value int, nominal int")
    got = sorted((r.risk_type, float(r.amount)) for r in reshape.schedule_rows(df).collect())
    assert got == [("Notional", 3.0), ("PV", 7.0)]
    f = spark.createDataFrame([(4, 0)], "delta int, vega int")
    legs = reshape.fx_legs(f).collect()
    assert [(r.risk_type, r.source_name, float(r.amount)) for r in legs] == [("Risk_FX", "DeltaFx", 4.0)]


def test_dedup_canonical_idempotent(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string") \
        .withColumn("m", F.create_map(F.lit("x"), F.col("k")))
    once = dedup.dedup_canonical(df)
    assert once.count() == 2 and dedup.dedup_canonical(once).count() == 2


def test_margin_table_counters(spark):
    from marginflow.plans.pipeline import margin_table
    from marginflow.plans.queries_pipeline import margin_inputs
    counters = {}
    m = margin_table(margin_inputs(spark, "/root/testdata/sf0.001"), counters=counters)
    n = m.count()
    got = {k: v.get["rows"] for k, v in counters.items()}
    assert got["simm_rows"] + got["schedule_rows"] == n
    assert got["resolved"] <= got["unified_feeds"]


def test_fill_nearest_balanced_equals_windowed_with_hot_key(spark):
    rnd = random.Random(23)
    rows = []
    for i in range(4000):                      # one hot key: most of the rows
        rows.append((0, i, None if rnd.random() < 0.7 else rnd.randint(1, 99)))
    for p in range(1, 150):
        for i in range(rnd.randint(1, 9)):
            rows.append((p, i, None if rnd.random() < 0.6 else rnd.randint(1, 99)))
    rows.append((None, 0, None)); rows.append((None, 1, 5))     # null key stays its own group
    df = spark.createDataFrame(rows, "p int, i int, v int")
    a = {(r.p, r.i): (r.v, r.unfillable) for r in fill_nearest(df, "v", ["p"], ["i"]).collect()}
    b = {(r.p, r.i): (r.v, r.unfillable)
         for r in fill_nearest(df, "v", ["p"], ["i"], balanced=True, chunks=16).collect()}
    assert a == b
    assert len(a) == len(rows)


def test_route_vol_strict_and_reference_mode(spark):
    from marginflow.operators.volatility import route_vol
    rows = [("FX", "VegaFX", ""), ("FX", "DeltaFx", ""), ("FX", "VegaIR", "SV"), ("OPT", "VegaIR", "CV"),
            (None, "DeltaIR", ""), ("OPT", "DeltaIR", None)]
    df = spark.createDataFrame(rows, "grp string, source_name string, vol_group_agg string")
    strict = [r.vol_branch for r in route_vol(df).collect()]
    assert strict == ["FX", "none", "SV", "CV", "none", "none"]
    loose = sorted((r.grp or "", r.source_name, r.vol_branch) for r in route_vol(df, strict=False).collect())
    # group FX catches every feed; the FX-group SV row is emitted twice; null group / vol group vanish
    assert loose == sorted([("FX", "VegaFX", "FX"), ("FX", "DeltaFx", "FX"), ("FX", "VegaIR", "FX"),
                            ("FX", "VegaIR", "SV"), ("OPT", "VegaIR", "CV")])


def test_balanced_fill_keeps_payload_and_rows(spark):
    """100,000 rows, a third on one key, with payload: rows and values as in the plain form."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("pos"),
        F.when(F.xxhash64("id") % 5 == 0, F.col("id") * 2).alias("v"),
        F.concat(F.lit("p"), "id").alias("payload"), (F.col("id") % 7).alias("_kept"))
    plain = fill_nearest(rows, "v", ["k"], ["pos"], out_col="w")
    balanced = fill_nearest(rows, "v", ["k"], ["pos"], out_col="w", balanced=True, chunks=16)
    assert balanced.columns == plain.columns
    assert balanced.count() == 100_000
    assert balanced.exceptAll(plain).isEmpty() and plain.exceptAll(balanced).isEmpty()


def test_surface_keeps_labels_with_equal_days(spark):
    surface = spark.createDataFrame([("EUR", "14D", 5), ("EUR", "6M", 9), ("EUR", "12M", 4), ("EUR", "1Y", 3)],
                                    "currency string, tenor string, vol int").withColumn("vol", F.col("vol").cast("decimal(23,8)"))
    asked = spark.createDataFrame([("EUR", "2W"), ("EUR", "6M"), ("EUR", "2W")], "currency string, tenor string")
    got = {r.tenor: float(r.vol) for r in complete_surface(asked, surface).collect()}
    assert got == {"14D": 5.0, "2W": 5.0, "6M": 9.0, "1Y": 3.0}


def test_roles_of_odd_documents(spark):
    """Whatever the JVM parser does not hold whole is walked; malformed documents are told, null ones give nothing."""
    def role(name, *contexts):
        return (f"<ROLE_IDENTIFIER><Role_Identifier>{name}</Role_Identifier>"
                + "".join(f"<Role_Identifier_Context>{c}</Role_Identifier_Context>" for c in contexts) + "</ROLE_IDENTIFIER>")

    def doc(code, *roles):
        return f"<GLOBAL><OPERATIVES><OPERATIVE>{code}<ROLES>{''.join(roles)}</ROLES></OPERATIVE></OPERATIVES></GLOBAL>"

    ref = "<RDR_Code_Operative>R1</RDR_Code_Operative>"
    docs = [doc(ref, role("A", "MUREXID", "OTHER")), doc("", role("B", "CALYPSOID")), doc(ref + ref, role("C", "MUREXID")),
            doc(ref, "<X>" + role("D", "MUREXID") + "</X>"), doc(ref, role(" E &amp; ", "MUREXID")), doc(ref),
            doc(f"<!-- {role('N', 'MUREXID')} -->" + ref, role("F", "MUREXID")), doc(ref, role("G"))[:-3], "", "no xml", None,
            "<GLOBAL/>", doc(ref, role("", "MUREXID"))]
    got = parse_roles(spark.createDataFrame([(d,) for d in docs], "doc string")).collect()
    assert sorted((r.identifier, r.ref_code, r.origin) for r in got if not r.malformed) == [
        ("", "R1", "MUREXID"), (" E & ", "R1", "MUREXID"), ("A", "R1", "MUREXID"), ("B", "", "CALYPSOID"),
        ("C", "R1R1", "MUREXID"), ("D", "R1", "MUREXID"), ("F", "R1", "MUREXID")]
    assert [r.malformed for r in got].count(True) == 3
