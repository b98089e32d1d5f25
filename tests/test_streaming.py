import datetime as dt

from helpers import rows, same
from pyspark.sql import functions as F

from namewright.operators.mapping import apply_mapping
from namewright.operators.metrics import bucket_counts
from namewright.plans.joins import Limits, salted_join
from namewright.plans.shared import folder_names, shared_dir
from namewright.streaming.jobs import (
    canonicalise_stream,
    dropped_late,
    insert_missing_stream,
    lag_stream,
    latest_buckets,
    read_buckets,
    throughput_stream,
)


def _one_file_a_batch(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_and_goes_on(spark, folder):
    corrections = spark.createDataFrame([("a0", "A"), ("a1", "B")], "original string, normalized string")
    arrivals = spark.range(60).select("id", F.concat(F.lit("a"), F.col("id") % 4).alias("name"))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    arrivals.repartition(5).write.parquet(f"{folder}/in")

    def run():
        stream = _one_file_a_batch(spark, f"{folder}/in")
        canonicalise_stream(stream, corrections, "name", f"{folder}/out", f"{folder}/ck", stamp).awaitTermination()
        return spark.read.parquet(f"{folder}/out")

    assert same(run(), apply_mapping(arrivals, corrections, "name", stamp))
    more = spark.createDataFrame([(100, "a1")], arrivals.schema)
    more.write.mode("append").parquet(f"{folder}/in")
    assert same(run(), apply_mapping(arrivals.union(more), corrections, "name", stamp))


def test_inserting_from_a_stream(spark, folder):
    arrivals = spark.range(90).select((F.col("id") % 30).alias("key"), (F.col("id") % 30).cast("string").alias("name"))
    arrivals.repartition(4).write.parquet(f"{folder}/in")

    def run(checkpoint):
        stream = _one_file_a_batch(spark, f"{folder}/in")
        insert_missing_stream(stream, f"{folder}/out", ["key"], f"{folder}/{checkpoint}").awaitTermination()
        return spark.read.parquet(f"{folder}/out")

    assert same(run("ck"), arrivals.distinct())
    # Everything again, as after a lost checkpoint: nothing is added.
    assert same(run("other"), arrivals.distinct())


def test_live_throughput(spark, folder):
    start = dt.datetime(2024, 1, 1)
    for part in range(3):
        data = [(start + dt.timedelta(seconds=20 * i), i % 5 == 0) for i in range(part * 50, part * 50 + 50)]
        spark.createDataFrame(data, "ts timestamp, bad boolean").coalesce(1).write.parquet(f"{folder}/in/p{part}")
    source = f"{folder}/in/*"
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    throughput_stream(stream, "ts", F.col("bad"), f"{folder}/out", f"{folder}/ck").awaitTermination()
    batch = bucket_counts(spark.read.parquet(source), "ts", F.col("bad"), "minute")
    assert rows(latest_buckets(spark, f"{folder}/out")) == rows(batch)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    throughput_stream(
        stream, "ts", F.col("bad"), f"{folder}/final", f"{folder}/ck2", watermark="2 minutes", final_only=True
    ).awaitTermination()
    newest = start + dt.timedelta(seconds=20 * 149)
    closed = batch.filter(F.col("t") + F.expr("INTERVAL 1 MINUTE") <= F.lit(newest - dt.timedelta(minutes=2)))
    assert rows(spark.read.parquet(f"{folder}/final")) == rows(closed)


def test_late_events_count_after_a_restart_and_a_repeated_batch(spark, folder):
    start = dt.datetime(2024, 1, 1)

    def arrive(days):
        for day in days:
            at = start + dt.timedelta(days=day)
            data = [(at + dt.timedelta(seconds=45 * i), i % 4 == 0) for i in range(20)]
            spark.createDataFrame(data, "ts timestamp, bad boolean").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run(out, checkpoint, **options):
        stream = _one_file_a_batch(spark, f"{folder}/in")
        query = throughput_stream(stream, "ts", F.col("bad"), f"{folder}/{out}", f"{folder}/{checkpoint}", **options)
        query.awaitTermination()
        return query

    def batch():
        return rows(bucket_counts(spark.read.parquet(f"{folder}/in"), "ts", F.col("bad"), "minute"))

    assert rows(latest_buckets(spark, f"{folder}/out")) == []
    arrive((5, 1, 4, 0))
    run("out", "ck")
    assert rows(latest_buckets(spark, f"{folder}/out")) == batch()
    # Started again: the counts so far are Spark's state, and buckets of old days go on.
    arrive((2, 3, 0))
    last = run("out", "ck")
    assert rows(latest_buckets(spark, f"{folder}/out")) == batch()
    assert last.lastProgress.stateOperators[0].numRowsTotal == len(batch())
    # The last batch again, as after a failure before its commit: it replaces what it wrote.
    commits = f"{folder}/ck/commits"
    newest = max(int(name) for name in folder_names(spark, commits) if name.isdigit())
    spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{commits}/{newest}"), False
    )
    run("out", "ck")
    assert rows(latest_buckets(spark, f"{folder}/out")) == batch()
    assert dropped_late(run("final", "ck2", final_only=True)) > 0


def test_batches_leave_no_settled_folder(spark, folder):
    spark.range(60).select((F.col("id") % 45).alias("key")).repartition(20).write.parquet(f"{folder}/in")
    there = f"{shared_dir(spark)}/namewright/{spark.sparkContext.applicationId}"
    before = folder_names(spark, there)
    stream = _one_file_a_batch(spark, f"{folder}/in")
    insert_missing_stream(stream, f"{folder}/out", ["key"], f"{folder}/ck").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 45
    assert folder_names(spark, there) == before


def test_hot_names_of_a_stream_are_split(spark, folder):
    """Two thirds of the rows have one name; no task may get more than twice the median."""
    name = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 12 != 0, F.concat(F.lit("n"), F.col("id") % 500))
    arrivals = spark.range(6000).select("id", name.alias("name"))
    arrivals.repartition(5).write.parquet(f"{folder}/in")
    known = spark.range(400).select(F.concat(F.lit("n"), "id").alias("original"), F.concat(F.lit("N"), "id").alias("normalized"))
    corrections = known.union(spark.createDataFrame([("hot", "HOT")], known.schema))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    limits = Limits(broadcast_rows=0, broadcast_bytes=0, hot_rows=500)

    def per_task(out, **options):
        stream = spark.readStream.schema(arrivals.schema).parquet(f"{folder}/in")
        canonicalise_stream(
            stream, corrections, "name", f"{folder}/{out}", f"{folder}/ck-{out}", stamp, limits=limits, **options
        ).awaitTermination()
        done = spark.read.parquet(f"{folder}/{out}")
        assert same(done, apply_mapping(arrivals, corrections, "name", stamp))
        counts = [row["count"] for row in done.groupBy(F.input_file_name()).count().collect()]
        return sorted(counts)

    # As with a large mapping: a true shuffle join, its partitions left as they are.
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        plain, salted = per_task("plain"), per_task("salted", history=arrivals)
        none_hot = per_task("cold", history=arrivals.filter("name <> 'hot'"))
    finally:
        for setting in settings:
            spark.conf.unset(setting)
    assert plain[-1] > 2 * plain[len(plain) // 2] and none_hot == plain
    assert salted[-1] < 2 * salted[len(salted) // 2]


def test_salted_join_of_static_rows(spark):
    rows_ = spark.createDataFrame([(1 if i % 2 else None if i % 10 == 0 else i, i) for i in range(400)], "k int, i int")
    lookup = spark.range(0, 300, 3).select(F.col("id").alias("k"), F.lit("x").alias("v")).union(
        spark.createDataFrame([(1, "one"), (None, "null")], "k bigint, v string")
    )
    limits = Limits(hot_rows=20)
    for how in ("left", "left_semi", "left_anti"):
        for null_safe in (False, True):
            got = salted_join(rows_, lookup, ["k"], rows_, how, null_safe, limits)
            unsplit = salted_join(rows_, lookup, ["k"], rows_.limit(0), how, null_safe, limits)
            assert same(got, unsplit) and got.count() > 0


def test_repeats_of_a_stream_stop_before_the_target(spark, folder):
    """Each of six files holds the rows of an hour and, again, those of the hour before."""
    start = dt.datetime(2024, 1, 1)
    schema = "ts timestamp, key string, name string"

    def hour(h):
        return [(start + dt.timedelta(hours=h, minutes=i), f" K{(h * 40 + i) % 90}" if i % 7 else None, f"n{h}") for i in range(40)]

    for h in range(6):
        data = hour(h) + (hour(h - 1) if h else [])
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/h{h}")
    source = f"{folder}/in/*"
    arrivals = spark.read.parquet(source).schema

    def run(target, checkpoint, **options):
        stream = spark.readStream.schema(arrivals).option("maxFilesPerTrigger", 1).parquet(source)
        query = insert_missing_stream(stream, f"{folder}/{target}", ["key"], f"{folder}/{checkpoint}", **options)
        query.awaitTermination()
        return query

    run("plain", "ck0")
    plain = spark.read.parquet(f"{folder}/plain")
    assert plain.filter("key IS NOT NULL").count() == len({(h * 40 + i) % 90 for h in range(6) for i in range(40) if i % 7})
    query = run("buckets", "ck1", buckets=8, repeats=("ts", "80 minutes"))
    bucketed = read_buckets(spark, f"{folder}/buckets", arrivals)
    assert same(bucketed, plain) and dropped_late(query) == 0
    # The rows sent again are met in the state; only rows seen within the delay are held.
    seen = [report.stateOperators[0] for report in query.recentProgress if report.stateOperators]
    assert sum(op.numRowsUpdated for op in seen) == 6 * 40
    assert max(op.numRowsTotal for op in seen) < 6 * 40
    # Again from the start, as after a lost checkpoint, and with batches of few keys.
    run("buckets", "ck2", buckets=8)
    assert same(read_buckets(spark, f"{folder}/buckets", arrivals), plain)


def test_batch_leaves_other_buckets_alone(spark, folder):
    schema = "key string, v int"
    spark.createDataFrame([(f"k{i}", i) for i in range(60)], schema).coalesce(1).write.parquet(f"{folder}/in/a")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/*")
        insert_missing_stream(stream, f"{folder}/out", ["key"], f"{folder}/ck", buckets=16).awaitTermination()
        return {name: folder_names(spark, f"{folder}/out/{name}") for name in folder_names(spark, f"{folder}/out") if "=" in name}

    before = run()
    spark.createDataFrame([("K5 ", -1), ("new", 1)], schema).coalesce(1).write.parquet(f"{folder}/in/b")
    after = run()
    changed = [name for name in after if after[name] != before.get(name)]
    assert len(changed) == 1 and len(before) > 8
    got = read_buckets(spark, f"{folder}/out", spark.read.schema(schema).parquet(f"{folder}/in/a").schema)
    assert rows(got) == sorted([(f"k{i}", i) for i in range(60)] + [("new", 1)], key=repr)


def test_lag_of_two_streams(spark, folder):
    """Twelve files a side, an hour each; a change is indexed up to 90 minutes later, every ninth one too late."""
    start = dt.datetime(2024, 1, 1)
    changed, indexed = [], []
    for i in range(240):
        at = start + dt.timedelta(minutes=3 * i)
        changed.append((i if i % 40 else None, at))
        late = dt.timedelta(hours=3) if i % 9 == 0 else dt.timedelta(seconds=(i * 977) % 5400)
        indexed.append((i if i % 40 else None, at + late))
    indexed.append((5, start))
    indexed.append((1000, start))

    def run(out, within):
        streams = []
        for name, table, col in (("c", changed, "changed"), ("x", indexed, "indexed")):
            schema = f"k int, {col} timestamp_ntz"
            by_hour = sorted(table, key=lambda row: row[1])
            if out == "a":
                size = -(-len(by_hour) // 12)
                for part in range(12):
                    some = by_hour[part * size : (part + 1) * size]
                    spark.createDataFrame(some, schema).coalesce(1).write.parquet(f"{folder}/{name}/p{part:02}")
            streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}/*"))
        query = lag_stream(*streams, "k", "changed", "indexed", f"{folder}/{out}", f"{folder}/ck-{out}", within, "4 hours")
        query.awaitTermination()
        wanted = []
        for k, at in changed:
            for k2, then in indexed:
                lag = (then - at).total_seconds()
                if k is not None and k == k2 and 0 <= lag <= (5400 if out == "a" else 14400):
                    wanted.append((k, at, then, int(lag)))
        assert rows(spark.read.parquet(f"{folder}/{out}")) == sorted(wanted, key=repr)
        return query, wanted

    query, wanted = run("a", "90 minutes")
    assert 150 < len(wanted) < 230 and dropped_late(query) == 0
    held = [report.stateOperators[0].numRowsTotal for report in query.recentProgress if report.stateOperators]
    assert max(held) < 0.8 * (len(changed) + len(indexed)) and held[-1] < max(held)
    _, longer = run("b", "4 hours")
    assert len(longer) > len(wanted)
