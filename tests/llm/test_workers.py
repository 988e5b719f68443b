"""Python workers, shuffles and tables that stay on the executors."""

import time

import pytest
from pyspark.sql import functions as F

from newslode.llm import bpe, common, simhash


def at_once(df):
    """Python steps of a task of df, at most."""
    return max(part.count("MapInArrow") for part in df._jdf.queryExecution().executedPlan().toString().split("Exchange"))


def test_encoding_passes_python_once_in_a_task(spark, odd, vocabulary):
    path, pattern = vocabulary.path("byte_bpe_multi_50k.tiktoken"), vocabulary.PATTERN
    apart = bpe.round_trip(spark, odd, path, pattern, with_ids=True, apart=True)
    assert at_once(apart) == 1
    rows = lambda df: sorted(df.collect(), key=str)
    assert rows(apart) == rows(bpe.round_trip(spark, odd, path, pattern, with_ids=True))


def test_near_copies_pass_python_once_in_a_task(odd, monkeypatch):
    """Links were found and joined to a forest in one task: two workers a core, which each executor kept."""
    seen, stash = [], simhash.stash
    monkeypatch.setattr(simhash, "stash", lambda df, *a: seen.append(at_once(df)) or stash(df, *a))
    assert simhash.one_of_each(odd).count()
    assert seen and max(seen) == 1


def test_what_was_shuffled_goes_when_it_is_written(spark):
    disk, key = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def files():
        found = disk.getAllFiles()
        return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}

    before, setting = files(), spark.conf.get(key)
    counts = spark.range(10_000).groupBy((F.col("id") % 777).alias("k")).count().repartition(3, "count")
    written = common.stash(counts, "counts")
    end = time.time() + 20
    while (left := files() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == setting
    assert written.count() == 777


def test_of_the_stages_only_the_last_table_stays(spark, odd, monkeypatch):
    """Tables of all stages stayed, in snappy."""
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as p

    made, stash = [], p.stash
    monkeypatch.setattr(p, "stash", lambda df, name: made.append(stash(df, name)) or made[-1])
    monkeypatch.setattr(p, "table", lambda *a: odd)
    monkeypatch.setattr(p, "STAGES", [(x, lambda spark, docs, _, x=x: p.in_small_batches(spark, lambda: docs, x)) for x in ("one", "two", "three")])
    assert p.run(spark, "").count() == odd.count()
    assert all(n.endswith(".zstd.parquet") for df in made for n in df.inputFiles())

    def there(df):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    assert [there(df) for df in made] == [False, False, True]
