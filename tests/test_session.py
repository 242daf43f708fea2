from pyspark.sql import functions as F

from pushback.session import cut_lineage, ensure_checkpoint_dir


def test_cut_lineage_writes_under_checkpoint_dir(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    out = cut_lineage(df.filter("k > 0"), "unit")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, None)]
    files = out.inputFiles()
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
    plan = out.select("k").filter("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


def test_a_wide_row_is_not_read_by_one_giant_method(spark, tmp_path):
    """A method somewhat below HotSpot's limit is compiled late and badly."""
    import contextlib
    import io
    import re
    path = str(tmp_path / "wide")
    spark.range(10).select(*[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(54)]).write.parquet(path)
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        spark.read.parquet(path).explain("codegen")
    size = max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue()))
    assert 2000 < size < 8000
    assert size > int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))


def _shuffle_bytes(spark) -> int:
    import os
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for root in top for d, _, files in os.walk(root)
               for f in files if f.startswith("shuffle_"))


def test_a_written_stage_leaves_no_shuffle_files(spark):
    from pushback.session import SHUFFLE_CLEANUP
    before = _shuffle_bytes(spark)
    df = spark.range(200_000).groupBy((F.col("id") % 50_000).alias("k")).agg(F.sum("id").alias("n"))
    out = cut_lineage(df, "unit")
    assert _shuffle_bytes(spark) - before < 50_000  # some 700 kB while it is written
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert out.count() == df.count() == 50_000


def test_the_split_needs_no_cleaned_table_beside_it(spark):
    from pushback.plans import catalog
    sf = "/root/testdata/sf0.001"
    catalog.forget_stages()
    written = sorted(map(tuple, catalog.cleaned(spark, sf).collect()), key=str)
    catalog.forget_stages()
    train, test = catalog._split(spark, sf)
    kept = catalog.cleaned(spark, sf)
    assert all("/split-" in f for f in kept.inputFiles()) and not catalog._has(spark, sf, "cleaned")
    assert sorted(map(tuple, kept.collect()), key=str) == written
    assert train.count() + test.count() == len(written)
    catalog.forget_stages()
