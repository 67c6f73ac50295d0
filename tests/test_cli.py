"""python -m almanac: the bundle run, the app-year run, and the empty case."""

import os
import tempfile

import pytest

from conftest import SF001

from almanac.__main__ import run


def test_bundle_run_writes_and_summarizes(spark, capsys):
    out = tempfile.mkdtemp(prefix="almanac-cli-")
    path = run(["--data", SF001, "--year", "1997", "--out", out], spark=spark)
    assert sorted(os.listdir(path)) == ["app", "organic", "web"]
    text = capsys.readouterr().out
    assert "web: 12 meses" in text and "Sessões Totais:" in text and "R$ " in text
    assert "Taxa Engajamento Média:" in text and "%" in text


def test_app_year_run(spark, capsys):
    out = tempfile.mkdtemp(prefix="almanac-cli-")
    path = run(["--data", SF001, "--year", "1998", "--out", out, "--app-year", "--format", "csv"], spark=spark)
    assert os.listdir(path) == ["app_year"]
    back = spark.read.option("header", "true").csv(os.path.join(path, "app_year"))
    assert back.count() == 12 and back.first()["Ano"] == "1998"
    assert back.columns == ["Mês", "Ano", "App_Usuários_total", "App_Sessões_total", "App_Receita_total"]
    text = capsys.readouterr().out
    assert "users:" in text and text.count("/1998: ") == 12 and " usuários | " in text


def test_empty_period_writes_nothing(spark):
    out = tempfile.mkdtemp(prefix="almanac-cli-")
    with pytest.raises(SystemExit):
        run(["--data", SF001, "--year", "2030", "--out", out], spark=spark)
    assert os.listdir(out) == []


def test_request_file(spark):
    import json
    req = {"android_only": {
        "property": "properties/ecommerce",
        "dimensions": [{"name": "month"}, {"name": "year"}],
        "metrics": [{"name": "sessions"}, {"name": "activeUsers"}],
        "date_ranges": [{"start_date": "1997-01-01", "end_date": "1997-12-31"}],
        "dimension_filter": {"filter": {"field_name": "platform",
                                        "string_filter": {"match_type": "EXACT", "value": "Android"}}}}}
    d = tempfile.mkdtemp(prefix="almanac-cli-")
    with open(os.path.join(d, "req.json"), "w") as f:
        json.dump(req, f)
    path = run(["--data", SF001, "--out", os.path.join(d, "out"), "--request", os.path.join(d, "req.json")],
               spark=spark)
    back = spark.read.parquet(os.path.join(path, "android_only"))
    from almanac.plans import report as R
    from almanac.plans.spec import ReportSpec
    from almanac.sources.properties import default_registry
    want = R.run_report(spark, ReportSpec.from_request(req["android_only"]), default_registry(SF001))
    assert back.columns == ["month", "year", "sessions", "active_users"]
    assert sorted(back.collect()) == sorted(want.collect())
    with pytest.raises(SystemExit):
        run(["--data", SF001, "--out", d, "--request", os.path.join(d, "req.json"), "--year", "1997"], spark=spark)


def test_written_under_headings(spark):
    from almanac.functions.labels import HEADINGS
    out = tempfile.mkdtemp(prefix="almanac-cli-")
    path = run(["--data", SF001, "--year", "1997", "--out", out, "--display"], spark=spark)
    for name in ("web", "app", "organic"):
        back = spark.read.parquet(os.path.join(path, name))
        assert back.columns == list(HEADINGS[name].values())
        assert all(r[-1].startswith("R$ ") for r in back.collect())


@pytest.mark.parametrize("more", [["--year", "1997", "--start", "1997-01-01", "--end", "1997-02-01"], ["--bindings", "x", "--year", "1997"], []])
def test_unusable_options_are_refused(spark, more):
    with pytest.raises(SystemExit):
        run(["--data", SF001, "--out", "/tmp/none", *more], spark=spark)


def test_own_tables(spark, capsys):
    import json
    d = tempfile.mkdtemp(prefix="almanac-cli-")
    rows = [("2025-01-10 10:00:00", 1, "web", "Organic Search", True, 10.0, "2025-01-10"),
            ("2025-01-10 10:10:00", 1, "web", "Other", False, 5.0, "2025-01-10"),
            ("2025-02-03 08:00:00", 2, "Android", None, True, 2.5, "2025-02-03")]
    df = spark.createDataFrame(rows, "at string, who long, device string, source string, active boolean, paid double, day string")
    df.selectExpr("cast(at as timestamp_ntz) at", "who", "device", "source", "active", "paid", "cast(day as date) day").write.partitionBy("day").parquet(f"{d}/hits")
    entry = {"path": f"{d}/hits", "partition_date": "day", "columns": {
        "ts": "at", "user_id": "who", "platform": "device", "channel": "source", "engaged": "active", "revenue": "paid"}}
    with open(f"{d}/tables.json", "w") as f:
        json.dump({"ecommerce": entry, "second": entry}, f)
    path = run(["--bindings", f"{d}/tables.json", "--year", "2025", "--out", f"{d}/out", "--internal-names"], spark=spark)
    assert sorted(os.listdir(path)) == ["app", "organic", "web"]
    web = spark.read.parquet(f"{path}/web").first()
    assert (web.month, web.sessions, web.revenue) == ("janeiro", 1, 15.0)
    assert "web: 1 meses" in capsys.readouterr().out
    with open(f"{d}/bad.json", "w") as f:
        json.dump({"ecommerce": entry | {"limit": 3}}, f)
    with pytest.raises(ValueError):
        run(["--bindings", f"{d}/bad.json", "--year", "2025", "--out", f"{d}/out"], spark=spark)
