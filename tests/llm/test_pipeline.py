import time

from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import quality
from feedloom.llm.common import saved


def test_only_the_rejected_rows_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "prior_of", lambda cells: 0.75)  # the share of good texts here
    good, junk = "the thing that was there with others and then some more of it.", "BUY!! NOW!! CHEAP!! CHEAP!! CHEAP!!"
    rows = [(i, (junk if i % 4 == 0 else good) + f" x{i}", "en", "s", 1) for i in range(400)]
    rows += [(None, junk + " x", "en", "s", 1), (None, good + " null", "en", "s", 1), (7, junk + " y", "en", "s", 1), (None, "жжж щщщ ъъъ", "en", "s", 1), (900, None, "en", "s", 1), (901, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).collect()]
    assert (None, good + " null") in out and (7, good + " x7") in out
    assert (None, junk + " x") not in out and (7, junk + " y") not in out
    out = [(r.doc_id, r.text) for r in corpus_pipeline.language_stage(spark, docs.filter("text not like 'BUY%'"), str(tmp_path)).collect()]
    assert (None, good + " null") in out and (None, "жжж щщщ ъъъ") not in out


def test_near_duplicates_with_repeated_and_null_ids(spark):
    one, two = "a text of some words that comes more than once in here", "quite another text under the same id as one of those"
    rows = [(5, one), (5, one), (None, one), (None, one), (3, one), (5, two), (None, "a text of its own"), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(out, key=str) == sorted([(3, one), (5, two), (None, "a text of its own"), (None, None), (None, "")], key=str)


def test_texts_are_not_shuffled_to_be_filtered(spark, tmp_path):
    rows = [(i, f"a text of some words under the number {i % 50} that comes more than once", "en", "s", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table of rejected numbers were beyond it
    try:
        for stage in (corpus_pipeline.quality_stage, corpus_pipeline.near_duplicate_stage):
            plan = stage(spark, docs, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_rejected_rows_go_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "FEW", 0)
    test_near_duplicates_with_repeated_and_null_ids(spark)


def test_saved_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles() -> int:
        files = disk.getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    before = shuffles()
    table = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    end = time.time() + 20  # files go in the background
    while shuffles() > before and time.time() < end:
        time.sleep(0.1)
    assert shuffles() <= before
    assert table.count() == 7
