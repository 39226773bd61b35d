"""Readers and country plans on small landed files."""

import datetime

import pytest
from pyspark.sql import functions as F

from pulsepanel import countries_by_zone, dimensions, get_data, process_testcounts
from pulsepanel.api import CountrySupport, Registry
from pulsepanel.operators.kernels import delay_kernel, drop_censored, kernel_values, valid_delays
from pulsepanel.plans.countries import default_registry
from pulsepanel.sources import files, germany
from pulsepanel.sources.line_list import read_line_list
from pulsepanel.sources.united_states import correction_rows

RUN = datetime.date(2020, 8, 3)


def days(first, n):
    start = datetime.date.fromisoformat(first)
    return [start + datetime.timedelta(days=i) for i in range(n)]


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


@pytest.fixture()
def landing(tmp_path):
    owid = ["iso_code,continent,date,total_cases,new_cases,total_deaths,new_deaths,total_tests,new_tests,tests_units"]
    for code in ("DEU", "AUT", "NLD", "PRT", "OWID_WRL"):
        total = 0
        for i, d in enumerate(days("2020-04-01", 60)):
            tests = 1000 + 10 * i
            total += tests
            shown = total if d.weekday() == 6 else ""
            owid.append(f"{code},X,{d},{100 + i},{i - 2},,,{shown},{tests if i % 9 else ''},units")
    write(tmp_path / "owid" / "owid.csv", "\n".join(owid) + "\n")

    cases = ["FID,Bundesland,Landkreis,Altersgruppe,AnzahlFall,AnzahlTodesfall,Meldedatum,Datenstand"]
    for d in days("2020-03-01", 150):
        ms = (d - datetime.date(1970, 1, 1)).days * 86_400_000
        for state in ("Bayern", "Hessen", "Bremen", "Baden-Württemberg"):
            for k in range(2):
                cases.append(f'1,{state},X,A{k},3,1,{ms},"03.08.2020, 00:00 Uhr"')
    write(tmp_path / "de" / "cases" / "data.csv", "\n".join(cases) + "\n")

    header = "Bundesland;Datum;Testungen (auf Fünfzig aufgerundet );Anteil positiv (auf zwei Stellen gerundet )"
    def tests(n, style):
        rows = [header]
        for d in days("2020-04-01", 60):
            for state in ("Bayern", "Hessen", "Baden-Württemberg", "nicht zugeordnet"):
                rows.append(f'"{state}";{d.strftime(style)};{n};0,11')
        return "\n".join(rows) + "\n"
    write(tmp_path / "de" / "tests" / "2020-07-30_tests_daily_BL.csv", tests(1000, "%d.%m.%Y"), "latin-1")
    write(tmp_path / "de" / "tests" / "2020-08-20_tests_daily_BL.CSV", tests(2000, "%Y-%m-%d"), "latin-1")

    us = ["date,state,positive,negative,total"]
    for i, d in enumerate(days("2020-06-01", 70)):
        for s in ("MI", "LA", "WA", "PR"):
            us.append(f"{d:%Y%m%d},{s},{100 + 5 * i},0,{1000 + 50 * i}")
    write(tmp_path / "us" / "daily.csv", "\n".join(us) + "\n")

    fr = ["reg;jour;P;T;cl_age90;pop"]
    for i, d in enumerate(days("2020-05-13", 60)):
        for reg in ("84", "01", "99"):
            for age in ("0", "9"):
                fr.append(f"{reg};{d};{i};{100 + i};{age};1")
    write(tmp_path / "fr" / "fr.csv", "\n".join(fr) + "\n")

    be = ["DATE,PROVINCE,REGION,TESTS_ALL,TESTS_ALL_POS"]
    for i, d in enumerate(days("2020-03-01", 60)):
        be += [
            f"{d},,Brussels,100,10",
            f"{d},Antwerpen,Flanders,600,20",
            f"{d},Liège,Wallonia,300,30",
            f"{d},,,500,4",
        ]
    write(tmp_path / "be" / "be.csv", "\n".join(be) + "\n")

    nation = ["data,stato,nuovi_positivi,tamponi"]
    regions = ["data,codice_regione,nuovi_positivi,tamponi"]
    for i, d in enumerate(days("2020-03-01", 40)):
        nation.append(f"{d}T18:00:00,ITA,{i},{1000 * (i + 1)}")
        if i != 5:
            regions.append(f"{d}T18:00:00,01,{i - 1},{100 * (i + 1)}")
    write(tmp_path / "it" / "nation" / "n.csv", "\n".join(nation) + "\n")
    write(tmp_path / "it" / "regions" / "r.csv", "\n".join(regions) + "\n")
    return str(tmp_path)


def by_key(df, *columns):
    return {(r.region, r.date.isoformat()): tuple(r[c] for c in columns) for r in df.collect()}


def test_germany(spark, landing):
    reg = default_registry(landing, take_latest_tests=False)
    df = get_data(reg, spark, "de", RUN)
    got = by_key(df, "new_cases", "new_deaths", "new_tests", "positive_fraction", "owid_total_tests")
    # Bremen is in the total only; the file of 30 July was the last before the run date
    assert got["BY", "2020-04-02"] == (6.0, 2.0, 1000.0, 0.11, None)
    assert got["all", "2020-04-02"][:4] == (24.0, 8.0, 4000.0, None)
    assert got["all", "2020-04-05"][4] == 1000 + 1010 + 1020 + 1030 + 1040
    assert got["BY", "2020-08-01"][:2] == (0.0, 0.0)
    assert ("BY", "2020-08-02") not in got and ("HB", "2020-04-02") not in got
    assert got["BW", "2020-04-02"][2] == 1000.0
    latest = by_key(get_data(default_registry(landing), spark, "DE", RUN), "new_tests")
    assert latest["BY", "2020-04-02"] == (2000.0,)
    processed = process_testcounts(reg, "DE", df, future_days=3)
    rows = by_key(processed, "predicted_new_tests_raw", "scaling_factor", "predicted_new_tests")
    raw, factor, predicted = rows["BY", "2020-04-10"]
    assert predicted == pytest.approx(raw * factor)
    assert rows["BY", "2020-08-04"][1] == rows["all", "2020-08-04"][1]


def test_united_states(spark, landing):
    reg = default_registry(landing)
    df = get_data(reg, spark, "US", RUN)
    assert df.where("region = 'PR'").isEmpty()
    out = by_key(process_testcounts(reg, "US", df), "new_tests", "predicted_new_tests", "new_cases")
    assert out["MI", "2020-06-18"] == (50.0, 14871.0, 5.0)
    assert out["WA", "2020-06-06"] == (50.0, None, None)
    # the offset makes the counter drop on the day, which is no test count
    assert out["MI", "2020-06-05"][1] is None
    assert out["LA", "2020-06-19"][1:] == (1716.0, 1671.0)
    # three states are fewer than forty
    assert out["all", "2020-06-10"] == (None, None, None)
    assert len(correction_rows()) > 40


def test_france(spark, landing):
    reg = default_registry(landing)
    df = get_data(reg, spark, "FR", datetime.date(2020, 6, 1))
    got = by_key(df, "new_cases", "new_tests")
    assert ("99", "2020-05-14") not in got
    assert got["01", "2020-05-14"] == (1.0, 101.0)
    assert got["all", "2020-05-14"] == (3.0, 303.0)
    assert max(k[1] for k in got) == "2020-05-31"
    out = by_key(process_testcounts(reg, "FR", df), "predicted_new_tests")
    assert out["84", "2020-01-01"] == (0.0,)
    assert out["84", "2020-05-12"] == (0.0,)
    assert out["84", "2020-05-14"] == (101.0,)


def test_belgium(spark, landing):
    reg = default_registry(landing)
    got = by_key(get_data(reg, spark, "BE", RUN), "new_cases", "new_tests")
    assert got["all", "2020-03-02"] == (64.0, 1500.0)
    assert got["BRU", "2020-03-02"][1] == 150.0
    assert got["ANT", "2020-03-02"] == (20.0, 600.0)
    assert got["LIE", "2020-03-02"] == (30.0, 300.0)


def test_italy(spark, landing):
    reg = default_registry(landing)
    got = by_key(get_data(reg, spark, "IT", RUN), "new_cases", "new_tests")
    assert got["01", "2020-03-01"] == (None, None)
    assert got["01", "2020-03-07"] == (5.0, None)
    assert got["01", "2020-03-08"] == (6.0, 100.0)
    assert got["all", "2020-03-07"] == (6.0, 1000.0)


@pytest.mark.parametrize("country,start", [("AT", "2020-01-01"), ("NL", "2020-01-01"), ("PT", "2020-04-01")])
def test_one_series_countries(spark, landing, country, start):
    reg = default_registry(landing)
    df = get_data(reg, spark, country, RUN)
    assert df.select("region").distinct().collect() == [("all",)]
    assert df.where("new_cases < 0").isEmpty()
    out = by_key(process_testcounts(reg, country, df, future_days=2), "new_tests", "predicted_new_tests")
    assert min(k[1] for k in out) == start
    assert max(k[1] for k in out) == "2020-06-01"
    assert out["all", "2020-06-01"][1] is not None
    if country == "AT":
        assert out["all", "2020-04-02"][0] is None
        assert out["all", "2020-01-01"][1] == 0.0


def test_holiday_table_enters_the_forecast(spark, landing, tmp_path):
    write(tmp_path / "holidays.csv", "alpha2,region,date,name\nPT,,2020-04-10,Good Friday\nPT,,2020-04-28,Made up\n")
    reg = default_registry(landing, holidays=str(tmp_path / "holidays.csv"))
    df = get_data(reg, spark, "PT", RUN)
    day = F.col("date")
    df = df.withColumn(
        "new_tests",
        F.when(day == F.lit("2020-04-10").cast("date"), F.lit(100.0))
        .when(day == F.lit("2020-04-28").cast("date"), F.lit(None))
        .otherwise(F.col("new_tests")),
    )
    processed = process_testcounts(reg, "PT", df)
    assert "holiday" not in processed.columns
    out = by_key(processed, "predicted_new_tests")
    assert out["all", "2020-04-28"][0] < 200


def test_registry_errors_and_zones(spark, landing):
    reg = Registry(iso_codes=["AQ"])
    support = CountrySupport(
        "AQ", "Asia", {"all": "Test country"}, {"all": 1_234_567},
        load=lambda s, d: s.range(1), process=lambda p: p,
    )
    with pytest.raises(KeyError, match="not in the collection"):
        get_data(reg, spark, "XY", RUN)
    with pytest.raises(KeyError, match="Unknown ISO-3166 alpha 2"):
        reg.add(CountrySupport("XY", "Asia", {}, {}, support.load, support.process))
    reg.add(support)
    assert "aq" in reg
    with pytest.raises(ValueError, match="missing"):
        get_data(reg, spark, "AQ", RUN)
    with pytest.raises(ValueError, match="future"):
        get_data(reg, spark, "AQ", datetime.date.today() + datetime.timedelta(days=2))
    row = reg.regions(spark).first()
    assert (row.short_name, row.population) == ("all", 1_234_567)
    zones = {r.zone: r.countries for r in countries_by_zone(default_registry(landing), spark).collect()}
    assert zones["Asia"] == [] and zones["America"] == ["US"] and len(zones["Europe"]) == 11


def test_dimensions(spark):
    countries = dimensions.country_dimension(spark)
    iso = dimensions.iso_dimension(spark)
    assert countries.join(iso, "alpha2").count() == countries.count() == 12
    regions = dimensions.region_dimension(spark)
    counts = {r.alpha2: r["count"] for r in regions.groupBy("alpha2").count().collect()}
    assert counts == {"AT": 1, "CH": 1, "CZ": 1, "DK": 1, "LU": 1, "NL": 1, "PT": 1,
                      "DE": 15, "US": 52, "FR": 19, "BE": 14, "IT": 22}
    us = regions.where("alpha2 = 'US'").groupBy(F.col("region") == "all").agg(F.sum("population").alias("p")).collect()
    assert us[0].p == us[1].p
    assert regions.where("alpha2 = 'FR' and region = 'all'").first().population == 67_063_703


def test_nowcast_file(spark, tmp_path):
    write(
        tmp_path / "n.csv",
        "Datum,PS_7_Tage_R_Wert,UG_PI_7_Tage_R_Wert,OG_PI_7_Tage_R_Wert\n"
        '05.03.2020,.,.,.\n06.03.2020,"1,05","0,9","1,2"\n2020-03-07,1.10,1.0,1.2\n',
    )
    nowcast = germany.read_nowcast(spark, str(tmp_path / "n.csv"))
    got = germany.nowcast_comparison(nowcast, german=True).orderBy("date").collect()
    assert [r.value for r in got] == [None, 1.05, 1.1]
    assert got[0].label == "(RKI) $R_t$ 7 Tage"
    assert got[1].lower == 0.9 and got[1].date == datetime.date(2020, 3, 6)


def test_line_list_and_stored_kernel(spark, tmp_path):
    rows = "\n".join(f"1,{c},{a},{b},x" for c, a, b in [
        ("A", "01.01.2020", "03.01.2020"), ("A", "01.01.2020", "05.01.2020"), ("A", "01.02.2020", "03.02.2020"),
    ])
    write(tmp_path / "p.csv", f"ID,country,date_onset_symptoms,date_confirmation,note\n{rows}\n")
    kernel = delay_kernel(drop_censored(valid_delays(read_line_list(spark, str(tmp_path / "p.csv")))))
    files.write_kernel(kernel, str(tmp_path / "kernel"))
    assert kernel_values(files.read_kernel(spark, str(tmp_path / "kernel"))) == [0] * 7 + [0.5, 0, 0.5]


def test_snapshots_are_pruned_by_day(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1.0)], "region string, v double")
    files.archive_snapshot(df, path, "2020-03-01")
    files.archive_snapshot(df.withColumn("v", F.lit(2.0)), path, "2020-03-02")
    files.archive_snapshot(df.withColumn("v", F.lit(3.0)), path, "2020-03-02")
    found = files.read_snapshots(spark, path).where("snapshot_date = date '2020-03-02'")
    assert [r.v for r in found.collect()] == [3.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_missing_vintage(spark, landing):
    with pytest.raises(FileNotFoundError):
        germany.read_test_counts(spark, f"{landing}/de/tests", "2020-01-01")


def test_csv_reads_only_chosen_columns(spark, landing):
    plan = germany.read_case_lines(spark, f"{landing}/de/cases")._jdf.queryExecution().executedPlan().toString()
    assert "Landkreis" not in plan.split("ReadSchema")[1]
    with pytest.raises(ValueError, match="lacks"):
        files.read_text_csv(spark, f"{landing}/us", ["nope"])
