"""Many small files of one directory are the work of several tasks."""

import re

from pyspark.sql import functions as F

from skyledger.sources import layouts


def test_small_files_of_a_directory_are_dealt_over_tasks(spark, tmp_path):
    # All rows of the only country come from one task.
    rows = spark.range(0, 600, 1, 1).select(
        F.lit("airline").alias("name"),
        F.lit("C1").alias("carrier_code"),
        F.sha2(F.col("id").cast("string"), 256).alias("tail_number"),
        F.col("id").alias("count"),
        F.lit("NATION_3").alias("country"),
    )
    before = [spark.conf.get(name) for name in (layouts.ADVISORY, layouts.LEAST)]
    path = str(tmp_path / "rollup")
    layouts.write_country_rollup(rows, path, max_records_per_file=2)
    assert [spark.conf.get(name) for name in (layouts.ADVISORY, layouts.LEAST)] == before
    stored = layouts.read_country_rollup(spark, path)
    assert stored.exceptAll(rows.select(stored.columns)).count() == 0 and stored.count() == 600
    files = stored.groupBy(F.input_file_name().alias("file")).count().collect()
    assert max(f["count"] for f in files) <= 2
    assert len({re.search(r"part-(\d+)", f["file"]).group(1) for f in files}) > 1


def test_few_rows_make_few_files(spark, tmp_path):
    rows = spark.range(0, 600, 1, 1).selectExpr(
        "'airline' AS name", "'C1' AS carrier_code", "string(id) AS tail_number",
        "id AS count", "'NATION_' || id % 3 AS country",
    )
    path = str(tmp_path / "rollup")
    layouts.write_country_rollup(rows, path, max_records_per_file=500)
    assert len(layouts.read_country_rollup(spark, path).inputFiles()) == 3
