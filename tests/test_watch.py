"""Facts about the operators that the SQL comparison can't show, and state over several writes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from obswatch.functions import calendar as cal
from obswatch.functions import text as tx
from obswatch.operators import baselines, checks, extract, faults, model, season, series, state
from obswatch.plans import daily
from obswatch.plans.registry import QUERIES, SQL
from obswatch.sources import export, payloads
from obswatch.sources.store import Store, TableSpec

D = dt.date
SF = "/root/testdata/sf0.001"


def test_folded_days(spark):
    days = [D(2024, 2, 28), D(2023, 2, 28), D(2024, 2, 29), D(2024, 3, 1), D(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(cal.folded_day(F.col("d"))).collect()] == [59, 59, 59, 60, 365]


def test_weekdays_between(spark):
    start = D(2024, 1, 1)
    rows = [(start + dt.timedelta(a), start + dt.timedelta(b)) for a in range(9) for b in range(-2, 30)]
    got = spark.createDataFrame(rows, "a date, b date").select("a", "b", cal.weekdays_between(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        assert r.n == sum((r.a + dt.timedelta(i)).weekday() < 5 for i in range(1, (r.b - r.a).days + 1))


def _years(spark, value):
    days = [D(2001, 1, 1) + dt.timedelta(i) for i in range(365)]
    rows = [(d.replace(year=2000 + y), float(value(y, i))) for y in range(10) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "d date, v double")


def test_baseline_values(spark):
    base = baselines.smoothed(_years(spark, lambda y, i: y), "d", "v").collect()
    assert len(base) == 365 and all(abs(r["mean"] - 4.5) < 1e-9 and abs(r["sd"] - np.std(range(10), ddof=1)) < 1e-9 for r in base)
    spread = baselines.smoothed(_years(spark, lambda y, i: 15 if i == 0 else 0), "d", "v").collect()
    hit = {r["day_of_year"] for r in spread if r["mean"] > 0.5}
    assert hit == {*range(1, 9), *range(359, 366)}


def test_season(spark):
    reports = [D(2026, 11, 2), D(2027, 1, 4), D(2027, 2, 26)]
    df = spark.createDataFrame([(d,) for d in reports], "d date")
    got = season.state(df, "d", "2027-03-20").first()
    assert (got.status, got.opened_on, got.closed_on) == ("closed", D(2026, 11, 2), D(2027, 3, 5))
    assert season.state(df, "d", "2027-03-05").first().status == "open"
    assert season.state(df, "d", "2027-09-01").first().status == "awaiting"
    assert season.state(df, "d", "2027-11-16").first().status == "overdue"
    closed = season.state(df, "d", "2027-03-20")
    log = spark.createDataFrame([(D(2027, 3, 1), False)], "refreshed_on date, replayed boolean")
    assert season.refresh_due(closed, log, "2027-03-20") and not season.refresh_due(closed, log.withColumn("refreshed_on", F.lit("2027-03-06").cast("date")), "2027-03-20")


def test_incidents_are_idempotent(spark):
    none = spark.createDataFrame([], "incident_id string, source string, check_name string, opened_at timestamp, closed_at timestamp")
    v = lambda failed: spark.createDataFrame([("s", "c", failed)], "source string, check_name string, failed boolean")
    at = lambda n: F.lit(f"2024-01-0{n}").cast("timestamp")
    one = state.settle(none, v(True), at(1))
    assert state.settle(one, v(True), at(2)).count() == 1
    assert state.settle(one, v(True).limit(0), at(2)).where("closed_at is null").count() == 1
    shut = state.settle(one, v(False), at(3))
    assert shut.where("closed_at is not null").count() == 1
    assert state.settle(shut, v(True), at(4)).count() == 2


def test_decisions(spark):
    q = spark.createDataFrame([("t:1",), ("t:2",)], "obs_id string")
    none = spark.createDataFrame([], "obs_id string, decision string, reason string, decided_at timestamp")
    now = F.lit("2024-01-01").cast("timestamp")
    for bad in (("t:1", "maybe", "x"), ("t:1", "confirmed", " "), ("t:9", "confirmed", "x")):
        with pytest.raises(ValueError):
            state.decide(q, none, *bad, now)
    d = state.decide(q, none, "t:1", "confirmed", "seen", now)
    with pytest.raises(ValueError):
        state.decide(q, d, "t:1", "rejected", "no", now)
    assert state.held_out(q, d).collect() == [("t:2",)] and state.open_items(q, d).count() == 1
    assert state.decide(q, d, "t:1", "rejected", "no", now, replace=True).count() == 1


def test_store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s", [TableSpec("t", "k int, v double, run_id string", ("k",)), TableSpec("raw", "run_id string, payload string", ("run_id",)), TableSpec("runs", "run_id string, source string, status string, error string", ("run_id",))])
    assert s.read("t").count() == 0
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v double").coalesce(1)
    assert s.ingest("runs", "raw", {"run_id": "a", "source": "x"}, "p", lambda raw: {"t": rows((1, 1.0), (2, 2.0), (1, 3.0))}) == "succeeded"
    assert sorted((r.k, r.v) for r in s.read("t").collect()) == [(1, 3.0), (2, 2.0)]
    bad = lambda raw: {"t": rows((1, 9.0)).withColumn("v", F.raise_error(F.lit("broken")).cast("double"))}
    assert s.ingest("runs", "raw", {"run_id": "b", "source": "x"}, "q", bad) == "failed"
    assert sorted((r.k, r.v) for r in s.read("t").collect()) == [(1, 3.0), (2, 2.0)]
    assert {r.run_id: r.status for r in s.read("runs").collect()} == {"a": "succeeded", "b": "failed"} and s.read("raw").count() == 2
    assert s.read("runs", 1).count() == 1 and s.prune(1) == [1] and s.read("t").count() == 2


def test_checks_run_apart(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    none = spark.createDataFrame([], "incident_id string, source string, check_name string, opened_at timestamp, closed_at timestamp")
    bad = faults.dropped_column(df, "b")
    out = daily.run_checks({("one", "null"): lambda: df.select(F.col("b").isNull().alias("failed")), ("two", "null"): lambda: bad.select(F.col("b").isNull().alias("failed"))}, none, F.lit("2024-01-01").cast("timestamp"))
    assert {(r.source, r.check_name) for r in out.collect()} == {("one", "null"), ("two", "schema")}

    def broken():
        raise ValueError("no")

    assert daily.run_stages([("a", lambda: 1), ("b", broken), ("c", lambda: 2)]) == {"a": None, "b": "no", "c": None}


def test_faults_are_seen(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], "k int, v double")
    hurt = faults.null_spike(df, "v", ["k"], 0.3, 1)
    assert hurt.where("v is null").count() == 6
    assert checks.null_rates(hurt, ["v"]).first().null_rate > checks.Thresholds().null_rate
    twice = faults.duplicates(df, ["k"], 0.25, 1)
    assert twice.count() == 25 and checks.duplicate_keys(twice, ["k"]).count() == 5
    assert checks.guarded("s", "c", lambda: faults.renamed_key(df, "k").select("k"))[1] is not None
    assert faults.schema_difference(faults.added_column(df, "x"), df.columns) == {"missing": [], "added": ["x"]}
    whole = faults.unit_change(spark.createDataFrame([(2,), (7,)], "n int"), "n", 0.5)
    assert [r.n for r in whole.collect()] == [1, 4]
    with pytest.raises(ValueError):
        faults.assert_safe("/a/live", "/a/live/")


def test_payloads(spark):
    raw = spark.createDataFrame([('{"daily":{"time":["2024-01-10","2024-01-11"],"t":[1.5,null]}}',)], "p string")
    assert [(r.position, r.time, r.t) for r in payloads.parallel_rows(raw, "p", "daily", ["t"]).collect()] == [(0, "2024-01-10", 1.5), (1, "2024-01-11", None)]
    for bad in ('{"daily":{"time":["2024-01-10"],"t":[1,2]}}', '{"daily":{"time":["2024-01-10"]}}', "{}"):
        with pytest.raises(Exception, match="block daily"):
            payloads.parallel_rows(spark.createDataFrame([(bad,)], "p string"), "p", "daily", ["t"]).collect()
    page = '{"features":[{"properties":{"time":"2025-01-06T00:00","value":"16.9","unit_of_measure":"degC","approval_status":"Approved"}},{"properties":{"time":"2025-01-07","value":"Eqp"}}]}'
    import json

    got = payloads.features(spark.createDataFrame([(json.dumps([page]),)], "p string"), "p").collect()
    assert [(str(r.obs_date), r.value) for r in got] == [("2025-01-06", 16.9), ("2025-01-07", None)]
    pages = {"http://h/1": {"features": [1], "links": [{"rel": "next", "href": "http://h/2"}]}, "http://h/2": {"features": [], "links": [{"rel": "next", "href": "http://h/3"}]}}
    assert len(list(payloads.paged(pages.get, "http://h/1"))) == 2
    with pytest.raises(ValueError):
        list(payloads.paged(lambda u: {"features": [1], "links": [{"rel": "next", "href": "http://evil/"}]}, "http://h/1"))
    assert payloads.catch_up(D(2027, 1, 9), 7, D(2026, 1, 1), D(2027, 1, 13)) == D(2027, 1, 2)
    assert payloads.year_window(2027, D(2027, 1, 13)) == (D(2027, 1, 1), D(2027, 1, 12)) and payloads.year_window(2028, D(2027, 1, 13)) is None


RULES = extract.Prose(nouns=("seal", "seals", "sea cows"), events=("count", "beach survey", "beachsurvey"), places=("blue spring",))


def test_numbers_and_parties():
    r = lambda t: extract.resolve(t, rules=RULES)
    e = r("Our researchers counted 512 seals this morning and the park counted 498. The river was 61.5°F and the air temperature was 44 F.")
    assert (e.own, e.other, e.river_f, e.air_f, e.reasons) == (512, 498, 61.5, 44.0, [])
    e = r("Our researchers counted 512 seals this morning, and the park counted 498.")
    assert (e.own, e.other, e.reasons) == (512, 498, [])
    assert r("We saw 300 seals; 310 by the rangers").other == 310 and r("186 seals by our staff while we had 191 sea cows").own == 191
    assert r("We estimated 300 seals.").estimate and r("We had about 120 seals").estimate and not r("We had 120 seals, about noon").estimate
    assert r("Staff had about 90 seals, we saw 12 seals and 30 extra seals").additional == [30]
    late = r("There were 12 additional seals.")
    assert (late.own, late.additional, late.reasons) == (None, [12], ["only late arrivals are counted"])
    assert r("The count was 2,100 seals.").reasons == ["a count of 2100 is not plausible"]
    assert r("The count went up to 31 today").own == 31 and r("The count at 72 F").own is None and r("The count is 8 a.m. today").own is None
    assert r("We counted 1,2345 seals and 3.5 seals").own is None
    assert r("Bob + 3 others were counted").summed and r("Bob and 3 others").summed and not r("and 3 other seals").summed
    far = r("The park, with its many visitors and a long way from here to there and back, had no news. 40 seals")
    assert (far.own, far.other) == (40, None)
    assert r("It was 70 F. There were 51 seals at eight. Fine day.").count_text == "There were 51 seals at eight."


def test_no_counts_and_places():
    said = lambda t: extract.no_count(t, RULES) >= 0
    for t in ("No count today.", "we couldn't do the beach survey", "no beachsurvey today", "Unable to do a count", "We were not able to get a count", "They were not counted", "did not do the beach survey"):
        assert said(t), t
    for t in ("no conference call today", "We counted 30 seals", "no one saw the count go up", "The survey was on the beach"):
        assert not said(t), t
    both = extract.resolve("No count today, yet we saw 20 seals", rules=RULES)
    assert both.own == 20 and "a number, yet said not to be counted" in both.reasons
    f = lambda t: extract.temperature(t, "spring", RULES.places)
    assert f("at blue spring the water is 72 F") is None and f("BLUE SPRING was 72 F") is None
    assert f("Warm spring water was 72 F") == 72 and f("Cold spring: 71 F") == 71 and f("the spring. It was 71 F") is None and f("spring; 71 F") is None
    assert f("spring was 70.3° F (21.3°C)") == 70.3 and f("spring " + "x" * 70 + " 71 F") is None


HTML = """<html><title>Season 2024 \u2013 2025</title><body><nav><p>January 9: 99 seals</p></nav><main><p>Intro</p><div class="entry-content">
<noscript><p>January 8: 98 seals</p></noscript><p>December 30: we counted 20 seals<p>More text<p>Jan. 2, 2025 - the count is 31</p><p>January 2: nothing new</p><p>2/30: none</p>
<p>Tuesday, January 7th, 2026: we counted 5 seals</p></div><p>January 20: 7 seals</p></main></body></html>"""


def test_pages(spark):
    assert extract.blocks("<p>x<p>y") == ["x", "y"] and extract.blocks("<div>a<br>b</div>") == ["a", "b"]
    assert extract.blocks("<ul><li>a <b>c</b><li>b</ul><blockquote><p>q</p></blockquote>") == ["a c", "b", "q"]
    assert extract.page_season("<h1>Winter 2023-2024</h1>") == "2023-2024" and extract.page_season("<p>2023-2024</p>") is None
    season = extract.infer_season(HTML, D(2025, 2, 1))
    got = extract.entries(extract.blocks(HTML), season)
    assert season == "2024-2025" and [(d, t) for d, t, _ in got][:2] == [(D(2024, 12, 30), "we counted 20 seals More text"), (D(2025, 1, 2), "the count is 31")]
    assert got[2][1] == "nothing new 2/30: none" and got[3][0] == D(2026, 1, 7) and got[3][2] == ["the year 2026 is not of the season"] and len(got) == 4
    assert extract.entries(["January 2: x"], "2023-2024", "2024-2025")[0][2] == ["the page is of 2024-2025, not 2023-2024"]
    assert extract.infer_season("<p>December 30: x</p>", D(2025, 7, 20)) == "2024-2025" and extract.infer_season("<p>July 3: x</p>", D(2025, 7, 20)) == "2025-2026"
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "page_id long, html string")
    rows = extract.page_rows(pages, D(2025, 2, 1), rules=RULES).persist()
    out = extract.reports(rows, since=D(2025, 1, 1)).orderBy("report_date").collect()
    assert [(x.report_date, x.count_researchers) for x in out] == [(D(2025, 1, 2), 31), (D(2026, 1, 7), 5)]
    text = extract.season_rows(rows, F.lit("u")).orderBy("date").collect()
    assert len(text) == 4 and text[1].needs_review == "TRUE" and "this date has 2 entries" in text[1].review_reason and text[0].count_researchers == "20" and text[0].estimate == "FALSE"


def test_regressions(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=800)
    mu = np.exp(2 + 0.5 * x)
    frame = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, r.poisson(mu), strict=True)], "x double, y int").persist()
    assert np.allclose(model.glm(frame, ["x"], "y"), [2, 0.5], atol=0.05)
    wide = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, r.poisson(mu * r.gamma(2, 0.5, 800)), strict=True)], "x double, y int").persist()
    got = model.fit(wide, ["x"], "y")
    assert got.family == "negative_binomial" and 0.3 < got.alpha < 0.8
    out = model.predicted(wide, got).first()
    assert abs(out.predicted - np.exp(got.coefficients["const"] + got.coefficients["x"] * out.x)) < 1e-9
    assert model.retrain_reason(False, 0, None, None, True, False) == "first_model" and model.retrain_reason(True, 10, 2.0, 1.0, True, False) == "lost_to_persistence"
    assert model.retrain_reason(True, 9, 2.0, 1.0, True, False) is None and model.version_id("2027-01-13", 1) == "m20270113-2"


def test_features_as_of_a_day(spark):
    days = [D(2025, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    counts = spark.createDataFrame([(d, float(50 + i % 7)) for i, d in enumerate(days) if i != 20], "day date, count double")
    levels = spark.createDataFrame([(d, 20.0 + i % 5) for i, d in enumerate(days) if i not in (10, 11, 30, 31, 32, 33)], "day date, level double")
    air = spark.createDataFrame([(d, 10.0 + i % 3, 18.0 + i % 4) for i, d in enumerate(days) if i != 40], "day date, low double, mean double")
    got = {x.made_on: x for x in model.feature_rows(counts.select("day"), counts, levels, air, 20.5).collect()}
    late = got[days[11]]  # the level of two days before
    assert late.reason is None and (late.gauge_temp, late.gauge_change_3d, late.gauge_degree_hours_below) == (24.0, 3.0, 0.0)
    assert (late.days_since_last_count, late.air_min, late.air_degree_days_below) == (1.0, 10.0, 0.0 + 2.5)
    assert got[days[33]].reason == "no recent level" and got[days[39]].reason == "no air for the target" and got[days[40]].reason == "no air for the day"
    frame = model.training_frame(counts, levels, air, 20.5, "2025-02-20").persist()
    rows = frame.collect()
    assert all((x.target - x.made_on).days == 1 and x["count"] == 50 + days.index(x.target) % 7 for x in rows) and days[40] not in {x.target for x in rows}
    assert model.train(frame.limit(29)) is None
    fitted = model.train(frame)
    assert fitted.features == model.FEATURES and len(fitted.coefficients) == 8
    forecast = spark.createDataFrame([(days[49], days[50], 12.0, 19.0), (days[50], days[50], None, 20.0), (days[50], days[51], 11.0, 21.0), (days[47], days[51], 0.0, 0.0)], "issued date, day date, low double, mean double")
    out = model.daily_prediction(fitted, True, str(days[50]), counts, levels, forecast, 20.5).collect()
    assert len(out) == 1 and out[0].reason is None and out[0].predicted > 0 and (out[0].air_min, out[0].air_degree_days_below) == (11.0, 0.5)
    assert model.daily_prediction(fitted, False, str(days[50]), counts, levels, forecast, 20.5) is None


def test_newest_known_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None)], "k string, at int, v double")
    assert model.newest_known(df, ["k"], ["v"], "at").first().v == 1.0


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(2, None, True, 'a "b", c'), (1, 0.123456789, False, None), (None, 1e-7, None, "z"), (3, 250.0, True, "q")], "a int, b double, c boolean, d string")
    text = export.csv_text(df, ["a"])
    assert text == 'a,b,c,d\n1,0.123457,false,\n2,,true,"a ""b"", c"\n3,250,true,q\n,1e-07,,z\n'
    folder = export.Folder(spark, f"file://{tmp_path}/out")
    assert folder.publish({"x.csv": text}, "v1", "t1") == ["x.csv", "meta.csv"] and folder.publish({"x.csv": text}, "v1", "t2") == []
    assert (tmp_path / "out" / "x.csv").read_text() == text and "t1" in (tmp_path / "out" / "meta.csv").read_text()
    assert folder.publish({"x.csv": text}, "v2", "t3") == ["meta.csv"] and folder.publish({"x.csv": text + "4,,,\n"}, "v2", "t4") == ["x.csv", "meta.csv"]


def test_text(spark):
    df = spark.createDataFrame([('{"b":"1","a":"2"}', "\u00a0a b–c  d—e ")], "j string, t string")
    got = df.select(tx.sorted_json(F.from_json("j", "map<string,string>")), tx.normalised(F.col("t")), tx.unit_problems(F.lit("oops"), {"a": "1"})).first()
    assert tuple(got) == ('{"a":"2","b":"1"}', "a b-c d - e", ["unreadable"])


def test_streaming(spark, tmp_path):
    from obswatch.streaming import watch

    src = f"{tmp_path}/in"
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double").write.parquet(src)
    s = Store(spark, f"file://{tmp_path}/s", [TableSpec("t", "k int, v double", ("k",))])
    stream = spark.readStream.schema("k int, v double").parquet(src)
    watch.into_store(stream, s, "t", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(60)
    assert s.read("t").count() == 2


def test_store_parts_and_runs(spark, tmp_path):
    specs = [
        TableSpec("t", "d date, v double, run_id string, ingested_at timestamp", ("d",), "year(d)"),
        TableSpec("raw", "run_id string, payload string, payload_sha256 string", ("run_id",)),
        TableSpec("runs", "run_id string, source string, status string, error string, started_at timestamp, finished_at timestamp, payload_sha256 string", ("run_id",)),
    ]
    s = Store(spark, f"file://{tmp_path}/s", specs)
    rows = lambda *x: (lambda raw: {"t": spark.createDataFrame(list(x), "d date, v double").coalesce(1)})
    s.ingest("runs", "raw", {"run_id": "a", "source": "x"}, "p", rows((D(2020, 1, 1), 1.0), (D(2021, 1, 1), 2.0), (None, 3.0)))
    before = s.manifest()["t"]
    assert set(before) == {"2020", "2021", "null"}
    s.ingest("runs", "raw", {"run_id": "b", "source": "x"}, None, rows((D(2021, 1, 1), 5.0), (D(2021, 2, 1), 6.0), (D(2022, 1, 1), 7.0)))
    after = s.manifest()["t"]
    assert after["2020"] == before["2020"] and after["2021"] != before["2021"] and set(after) == {"2020", "2021", "2022", "null"}
    got = {(r.d, r.v, r.run_id) for r in s.read("t").where("ingested_at is not null").collect()}
    assert got == {(D(2020, 1, 1), 1.0, "a"), (D(2021, 1, 1), 5.0, "b"), (D(2021, 2, 1), 6.0, "b"), (D(2022, 1, 1), 7.0, "b"), (None, 3.0, "a")}
    log = {r.run_id: r for r in s.read("runs").collect()}
    assert log["a"].payload_sha256 and log["b"].payload_sha256 is None and log["a"].started_at <= log["a"].finished_at

    def broken():
        raise OSError("no route")

    with pytest.raises(OSError, match="no route"):
        s.fetched("runs", "raw", {"run_id": "c", "source": "x"}, broken, rows())
    bad = lambda raw: {"t": rows((D(2020, 1, 1), 0.0))(raw)["t"].withColumn("v", F.raise_error(F.lit("odd")).cast("double"))}
    with pytest.raises(RuntimeError, match="run d"):
        s.fetched("runs", "raw", {"run_id": "d", "source": "x"}, lambda: "q", bad)
    assert {r.run_id: r.status for r in s.read("runs").collect()} == {"a": "succeeded", "b": "succeeded", "c": "failed", "d": "failed"}
    copy = s.copy_to(f"file://{tmp_path}/copy")
    copy.commit({"t": faults.null_spike(copy.read("t"), "v", ["d"], 1.0)})
    assert copy.read("t").where("v is null").count() == 5 and s.read("t").where("v is null").count() == 0
    with pytest.raises(ValueError):
        s.copy_to(f"file://{tmp_path}/s/inside")
    assert s.backup(f"file://{tmp_path}/out") == ["raw", "runs", "t"]
    assert [r.v for r in spark.read.option("header", True).schema("d date, v double, run_id string, ingested_at timestamp").csv(f"file://{tmp_path}/out/t").coalesce(1).collect()] == [1.0, 5.0, 6.0, 7.0, 3.0]
    assert s.prune(1) and s.read("t").count() == 5


def test_more_payloads(spark):
    text = '{"daily":{"time":["2024-01-10"],"t":[1.5]},"hourly":{"time":["2024-01-10T00:00","2024-01-10T01:00"],"h":[1,2]}}'
    raw = spark.createDataFrame([(text,)], "p string")
    out = payloads.archive_rows(raw, "p", ["t"], ["h"])
    assert [tuple(r) for r in out["daily"].collect()] == [(1.5, D(2024, 1, 10))]
    assert [tuple(r) for r in out["hourly"].collect()] == [(1.0, dt.datetime(2024, 1, 10)), (2.0, dt.datetime(2024, 1, 10, 1))]
    with pytest.raises(Exception, match="oops"):
        payloads.hourly_rows(spark.createDataFrame([(text.replace("2024-01-10T01:00", "oops"),)], "p string"), "p", "hourly", ["h"]).collect()
    f = payloads.forecast_rows(raw, "p", "daily", ["t"], F.lit("2024-01-10 03:00:00").cast("timestamp_ntz")).first()
    assert (f.target_date, f.issue_date) == (D(2024, 1, 10), D(2024, 1, 9))
    pages = spark.createDataFrame([("/c/b.html", "B"), ("/c/a.html", "A"), ("/c/z.html", "Z")], "path string, payload string")
    wanted = spark.createDataFrame([("s1", 1, "gone.html"), ("s1", 2, "b.html"), ("s1", 3, "a.html"), ("s2", 1, "no.html")], "season string, rank int, name string")
    assert {r.season: r.payload for r in payloads.season_pages(pages, wanted).collect()} == {"s1": "B", "s2": None}
    assert payloads.fetch_window(D(2027, 1, 9), 7, D(2026, 1, 1), D(2027, 1, 13), 6) == (D(2027, 1, 2), D(2027, 1, 7))
    assert payloads.fetch_window(None, 7, D(2027, 1, 13), D(2027, 1, 13), 6) is None

    def run(a, b):
        if a.year == 2025:
            raise OSError("down")

    assert payloads.backfill(2024, 2030, D(2027, 1, 13), run) == {2025: "down"}
    df = spark.createDataFrame([(1, 2, 3, "r")], "k int, b int, a int, run_id string")
    assert faults.random_column(df, ["k"], 5) == faults.random_column(df.select("run_id", "a", "b", "k"), ["k"], 5) in ("a", "b")
    with pytest.raises(ValueError):
        faults.random_column(df, ["k", "a", "b"], 5)


def _streamed(spark, tmp_path, batches, schema, make):
    """The rows that a streaming query gives, batch by batch."""
    src, seen = f"{tmp_path}/in", []
    spark.createDataFrame([], schema).write.parquet(src)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = make(spark.readStream.schema(schema).parquet(src)).foreachBatch(lambda df, n: seen.extend((i, *r) for r in df.collect()))
        q.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    return seen


def test_streamed_incidents(spark, tmp_path):
    from obswatch.streaming import watch

    at = lambda n: dt.datetime(2024, 1, n)
    batches = [[("s", "c", at(2), True), ("s", "c", at(1), False), ("s", "d", at(1), None)], [("s", "c", at(3), True), ("t", "c", at(3), True)], [("s", "c", at(5), True), ("s", "c", at(4), False)]]
    got = _streamed(spark, tmp_path, batches, "source string, check_name string, at timestamp, failed boolean", lambda x: watch.incidents(x).writeStream)
    assert sorted(got, key=str) == sorted([(0, "s", "c", at(2), None), (1, "t", "c", at(3), None), (2, "s", "c", at(2), at(4)), (2, "s", "c", at(5), None)], key=str)


def test_streamed_seasons(spark, tmp_path):
    from obswatch.streaming import watch

    batches = [[(dt.datetime(2026, 11, 2),), (dt.datetime(2027, 2, 26),)], [(dt.datetime(2027, 3, 4),)], [(dt.datetime(2027, 11, 3),)], [(dt.datetime(2027, 11, 4),)]]
    got = _streamed(spark, tmp_path, batches, "at timestamp", lambda x: watch.season_changes(x, "at").writeStream)
    assert [r[1:] for r in got if r[1] == 2026] == [(2026, "open", D(2026, 11, 2), None), (2026, "closed", D(2026, 11, 2), D(2027, 3, 11))]
    assert [r[1:] for r in got if r[1] == 2027] == [(2027, "open", D(2027, 11, 3), None)]


def test_streamed_freshness(spark, tmp_path):
    from obswatch.streaming import watch

    batches = [[("a", dt.datetime(2024, 1, 1))], [("b", dt.datetime(2024, 1, 9)), ("a", dt.datetime(2024, 1, 3))]]
    got = _streamed(spark, tmp_path, batches, "source string, ts timestamp", lambda x: watch.last_seen(x, "source", "ts").writeStream.outputMode("complete"))
    seen = spark.createDataFrame([r[1:] for r in got if r[0] == 1], "source string, last_seen timestamp")
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")
    out = {r.source: r.failed for r in watch.freshness(seen, wanted, F.lit("2024-01-10").cast("timestamp")).collect()}
    assert out == {"a": True, "b": False, "c": True}


def _plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat().removesuffix("T00:00:00")
    return round(float(v), 6) if isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_)) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in "nation customer supplier part orders lineitem events documents pages conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), c.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda f: sorted(str(tuple(map(_plain, r))) for r in f[sorted(f.columns)].astype(object).where(f.notna(), None).values.tolist())
    assert rows(got) == rows(want)


def test_contract(spark):
    assert __spark_entry__.entry(spark).count() == 365
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_asof_tolerance_to_the_microsecond(spark, tmp_path):
    import duckdb

    at, days = dt.datetime(2024, 3, 1, 10, 0, 0, 900_000), dt.timedelta(3)
    ages = {1: days, 2: days + dt.timedelta(microseconds=1), 3: days + dt.timedelta(milliseconds=99), 4: days + dt.timedelta(milliseconds=400), 5: days - dt.timedelta(microseconds=1)}
    rows = [(10 * u, at, u, "error", float(u)) for u in ages] + [(10 * u + 1, at + age, u, "purchase", 0.0) for u, age in ages.items()]
    rows += [(100, at, None, "error", 1.0), (101, at, None, "purchase", 1.0), (110, None, 9, "error", 1.0), (111, at, 9, "purchase", 1.0)]
    for kind in ("timestamp", "timestamp_ntz"):
        path = str(tmp_path / kind)
        spark.createDataFrame(rows, f"event_id long, ts {kind}, user_id long, event_type string, value double").write.parquet(f"{path}/events.parquet")
        con = duckdb.connect()
        con.execute(f"SET TimeZone = 'UTC'; CREATE VIEW events AS SELECT * REPLACE (ts::TIMESTAMP AS ts) FROM '{path}/events.parquet/*.parquet'")
        for name in ("asof_tolerance", "asof_backward"):
            got = {tuple(r) for r in QUERIES[name](spark, path).collect()}
            assert got == set(con.execute(SQL[name]).fetchall()), (kind, name)
        assert {r.event_id for r in QUERIES["asof_tolerance"](spark, path).collect() if r.value is not None} == {11, 51}
