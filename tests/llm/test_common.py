import pyarrow as pa
from strataudit.llm import common, jaccard, lines


def test_workers_release_memory_when_their_batches_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 60, None, "b" * 60, "c"]})
    some = common.pieces(iter([batch, batch]), "text", 64)
    assert next(some).num_rows == 2 and not calls
    assert sum(x.num_rows for x in some) == 6 and len(calls) == 1


def test_release_can_be_called_anywhere():
    common.release()
    common.release()


def test_what_a_task_sorts_at_once_fits_beside_the_heap():
    """A part is copied, sorted and compared: about seven times its bytes, in each of the two tasks of an executor that has 1,200 MB beside its heap."""
    assert 2 * 7 * (lines.PART + lines.BUCKET) <= 800 << 20
    assert 2 * 7 * jaccard.PIECE <= 800 << 20


def test_stored_frames_leave_no_exchanges_behind(spark):
    """What a stored frame exchanged is gone at once, not when the driver happens to collect garbage; the caller's setting is as before."""
    import glob
    import time

    from pyspark.sql import functions as F

    def files():
        folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {x for at in folder for x in glob.glob(f"{at}/**/shuffle_*.data", recursive=True)}

    before, setting = files(), spark.conf.get(common.CLEANUP, None)
    for store in (common.kept, lambda df: common.written(df, "numbers")):
        df = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
        assert store(df).count() == 7
    for _ in range(50):  # Spark removes them in a thread of its own
        if len({x.split("shuffle_")[1].split("_")[0] for x in files() - before}) <= 2:
            break
        time.sleep(0.2)
    assert len({x.split("shuffle_")[1].split("_")[0] for x in files() - before}) <= 2  # those of the two counts; four more without the setting
    assert spark.conf.get(common.CLEANUP, None) == setting


def test_components_of_a_small_graph_make_few_tasks(spark):
    """However many shuffle partitions there are, the rounds and their result have as many tasks as the links take."""
    from strataudit.llm import graph

    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen, kept = [], graph.kept
    graph.kept = lambda df: seen.append(kept(df)) or seen[-1]
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(60) if i % 20 != 19], "a long, b long")
        got = {(r.node, r.root) for r in graph.components(links, "a", "b").collect()}
    finally:
        graph.kept = kept
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == {(i, i // 20 * 20) for i in range(60)}
    assert len(seen) > 2 and all(x.rdd.getNumPartitions() <= 2 for x in seen[1:])
