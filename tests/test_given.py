"""What the checks make of the given tables."""
from pyspark.sql import functions as F

from feedyard.checks import views as v


def test_only_the_numbers_of_dropped_files_are_written(spark):
    """Names, inventory, log and bronze follow from them; none is a table of its own."""
    from feedyard.checks import operations
    sf = "/root/testdata/sf0.001"
    for made in (v.files, v.inventory, v.ingest_log, operations._bronze):
        folders = {f.rsplit("/", 2)[-2].rsplit("-", 1)[0] for f in made(spark, sf).inputFiles()}
        assert folders == {"drops"}, made
    assert "file_path" not in v.stored(spark, sf, "drops", None).columns


def test_tasks_that_read_dropped_files_are_small_and_hold_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    drops = v.stored(spark, sf, "drops", lambda: v._drops(spark, sf))
    files = drops.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")).orderBy("low").collect()
    assert sum(r["n"] for r in files) == drops.dropDuplicates(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).count() > 4 * v.ROWS_PER_FILE
    assert all(r["n"] <= 12_500 for r in files) and all(a["high"] <= b["low"] for a, b in zip(files, files[1:]))
