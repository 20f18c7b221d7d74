from __future__ import annotations

import pytest

from skyledger.cli import main
from skyledger.sources import schemas
from skyledger.sources.quarantine import read_load


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    maker = {"N1": ("CESSNA", "172M"), "N2": ("CESSNA", "550"), "N3": ("BOEING", "737")}
    aircrafts = [f"{t},,{m},,{model},,,," for t, (m, model) in maker.items()]
    aircrafts.append("N1,cut short,CESSNA")
    legs = [("AA", "N1", "10:10:00")] * 3 + [("AA", "N3", "10:20:00")] * 2
    legs += [("BB", "N2", "10:30:00"), ("BB", "N2", "")]
    flights = [
        f"{i},{carrier},{i},1996-06-01,SYD,MEL,{tail},10:00:00,12:00:00,{left},,439"
        for i, (carrier, tail, left) in enumerate(legs)
    ]
    airlines = ["AA,Alpha,Canada", "BB,Beta,Egypt"]
    contents = {
        "aircrafts": (schemas.AIRCRAFTS, aircrafts),
        "airlines": (schemas.AIRLINES, airlines),
        "flights": (schemas.FLIGHTS_FILE, flights),
    }
    paths = {}
    for name, (schema, rows) in contents.items():
        path = folder / f"{name}.csv"
        path.write_text("\n".join([",".join(schema.names), *rows]) + "\n")
        paths[name] = str(path)
    return paths


@pytest.fixture
def run(spark, tables, tmp_path):
    def command(name, *inputs, **options):
        out = str(tmp_path / f"{name}-out")
        argv = [name, "--out", out]
        for table in inputs:
            argv += [f"--{table}", tables[table]]
        for option, value in options.items():
            argv.append(f"--{option.replace('_', '-')}")
            if value is not True:
                argv.append(str(value))
        main(argv)
        return out

    return command


def lines(spark, path):
    return [row.value for row in spark.read.text(path).collect()]


def test_top_models(spark, run):
    out = run("top-models", "flights", "aircrafts")
    assert lines(spark, out) == ["Cessna 172 \t 3", "Cessna 550 \t 2"]


def test_top_models_flown_only(spark, run):
    out = run("top-models", "flights", "aircrafts", flown_only=True)
    assert lines(spark, out) == ["Cessna 172 \t 3", "Cessna 550 \t 1"]


DELAYS = ["Alpha \t 5 \t 14.0 \t 10.0 \t 20.0", "Beta \t 1 \t 30.0 \t 30.0 \t 30.0"]


def test_delays(spark, run):
    assert sorted(lines(spark, run("delays", "flights", "airlines", year=1996))) == DELAYS


def test_delays_of_one_country(spark, run):
    out = run("delays", "flights", "airlines", year=1996, country="Canada")
    assert lines(spark, out) == DELAYS[:1]


def test_delays_from_the_year_layout(spark, run, tables, tmp_path):
    stored = run("layout-flights", "flights", out_format="csv", max_records=4)
    out = str(tmp_path / "report")
    main(
        ["delays", "--flights", stored, "--airlines", tables["airlines"], "--layout"]
        + ["--year", "1996", "--out", out, "--layout-format", "csv"]
    )
    assert sorted(lines(spark, out)) == DELAYS


def test_layouts_and_reports_by_default(spark, run, tables, tmp_path):
    by_year = run("layout-flights", "flights")
    out = str(tmp_path / "delays")
    main(
        ["delays", "--flights", by_year, "--airlines", tables["airlines"], "--layout"]
        + ["--year", "1996", "--out", out]
    )
    assert sorted(lines(spark, out)) == DELAYS
    rollup = run("layout-rollup", "flights", "airlines")
    out = str(tmp_path / "fleet")
    main(
        ["fleet-from-rollup", "--rollup", rollup, "--country", "Canada", "--out", out]
        + ["--aircrafts", tables["aircrafts"]]
    )
    flat = run("fleet", "flights", "airlines", "aircrafts", country="Canada")
    assert lines(spark, out) == lines(spark, flat)
    assert lines(spark, flat) == ["Alpha \t 1 \t CESSNA 172M", "Alpha \t 2 \t BOEING 737"]


def test_layout_by_year_alone(spark, run):
    stored = run("layout-flights", "flights", keys="year")
    assert "carrier_code=" not in spark.read.parquet(stored).inputFiles()[0]


def test_fleet(spark, run):
    out = run("fleet", "flights", "airlines", "aircrafts", country="Canada", ties="exact")
    assert lines(spark, out) == ["Alpha \t [CESSNA 172M, BOEING 737]"]


def test_fleet_from_the_country_rollup(spark, run, tables, tmp_path):
    stored = run("layout-rollup", "flights", "airlines", out_format="csv")
    out = str(tmp_path / "report")
    main(
        ["fleet-from-rollup", "--rollup", stored, "--aircrafts", tables["aircrafts"]]
        + ["--country", "Egypt", "--out", out, "--ties", "exact"]
        + ["--layout-format", "csv"]
    )
    assert lines(spark, out) == ["Beta \t [CESSNA 550]"]


def test_country_layout(spark, run):
    stored = run("layout-country", "flights", "airlines", by_tail=True)
    counts = spark.read.parquet(stored).groupBy("country").count().collect()
    assert {row["country"]: row["count"] for row in counts} == {"Canada": 5, "Egypt": 1}


def test_country_and_tail_layout(spark, run):
    stored = run("layout-tail", "flights", "airlines", parts=3, max_records=2)
    files = spark.read.parquet(stored).inputFiles()
    assert len(files) >= 3
    assert all(spark.read.parquet(f).count() <= 2 for f in files)


def test_load_sets_lines_aside(spark, tables, tmp_path):
    out = str(tmp_path / "loaded")
    main(["load", "--table", "aircrafts", "--source", tables["aircrafts"], "--out", out])
    load = read_load(spark, out, schemas.AIRCRAFTS)
    assert load.accepted.count() == 3
    assert [r.reject_line for r in load.rejected.collect()] == ["N1,cut short,CESSNA"]


def test_days_are_loaded_in_place(spark, run, tables, tmp_path):
    out = str(tmp_path / "table")
    for _ in range(2):
        main(["load-days", "--flights", tables["flights"], "--out", out, "--headers-differ"])
    report = str(tmp_path / "report")
    main(
        ["delays", "--flights", out, "--airlines", tables["airlines"], "--layout"]
        + ["--year", "1996", "--out", report]
    )
    assert sorted(lines(spark, report)) == DELAYS


def test_deltas_are_applied_once(spark, tables, tmp_path):
    out = str(tmp_path / "rollup")
    for name in ("one", "one", "two"):
        main(
            ["apply-delta", "--airlines", tables["airlines"], "--flown", tables["flights"]]
            + ["--name", name, "--out", out]
        )
    main(
        ["apply-delta", "--airlines", tables["airlines"], "--cancelled", tables["flights"]]
        + ["--name", "three", "--out", out]
    )
    counts = spark.read.parquet(out).groupBy("tail_number").sum("count").collect()
    # Two loads of flown flights, less one of all of them.
    assert {r[0]: r[1] for r in counts} == {"N1": 3, "N3": 2}
