from __future__ import annotations

from skyledger.plans import reports


def lines(df):
    return [row.line for row in df.collect()]


def test_model_lines(spark):
    top = spark.createDataFrame(
        [("172", 30), ("550", 7)], "modelName string, numFlights long"
    )
    assert lines(reports.model_lines(top)) == ["Cessna 172 \t 30", "Cessna 550 \t 7"]


def test_delay_lines_are_ordered_by_name(spark):
    stats = spark.createDataFrame(
        [("Beta", 2, 360.25, 0.5, 720.0), ("Alpha", 4, 10.0, 5.0, 20.0)],
        "name string, numOfDelays long, avgDelays double, minDelay double,"
        " maxDelay double",
    )
    assert lines(reports.delay_lines(stats)) == [
        "Alpha \t 4 \t 10.0 \t 5.0 \t 20.0",
        "Beta \t 2 \t 360.25 \t 0.5 \t 720.0",
    ]


def test_fleet_lines_list_every_airline_in_rank_order(spark):
    ranked = spark.createDataFrame(
        [
            ("Beta", "OTHER", "M9", 3, 1),
            ("Alpha", "MAKER", "M2", 5, 2),
            ("Alpha", "MAKER", "M3", 9, 1),
        ],
        "name string, manufacturer string, model string, numFlights long, rank int",
    )
    assert lines(reports.fleet_lines(ranked)) == [
        "Alpha \t [MAKER M3, MAKER M2]",
        "Beta \t [OTHER M9]",
    ]
    assert lines(reports.fleet_lines(ranked.limit(0))) == []
