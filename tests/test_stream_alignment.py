"""The cursor of a stream: batches, restarts, jobs that come late."""

from quiremill.operators import alignment as A
from quiremill.streaming import alignment as ST
from quiremill.streaming import gate as G

ENTRIES = "job string, page long, idx int, entry int, heading string, body string"


def run(spark, folder, checkpoint, canon, keys, out):
    s = spark.readStream.schema(ENTRIES).option("maxFilesPerTrigger", 1).parquet(folder)
    with ST.rocksdb(spark):
        q = ST.canonical_stream(s, canon, keys).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()


def test_batches_and_restarts_give_what_one_table_gives(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    texts = {j: [f"{w} {j}{j} text" for w in words] for j in ("a", "b")}
    canon = spark.createDataFrame([(j, i, f"1.1.{i}", t) for j, ts in texts.items() for i, t in enumerate(ts)], "job string, ord int, ref string, text string")
    keys = canon.selectExpr("job", "ref as key", "ord")
    rows = []
    for j, ts in texts.items():
        for i, t in enumerate(ts):
            heading = {3: "nothing like it at all, no", 7: "see 01.01.9 here", 5: ""}.get(i, t)
            rows.append((j, i // 3, i % 3, i % 3, heading, "1.1.6 in the body" if i == 5 else "body"))
    rows.append(("none", 0, 0, 0, "alpha aa text", ""))
    want = {(r.job, r.page, r.entry, r.ref, r.ord) for r in A.align_canonical(spark.createDataFrame(rows, ENTRIES), canon, keys).collect()}
    assert len(want) > 8
    folder, out, check = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    parts = [[r for r in rows if r[1] == p] for p in range(3)]
    for part in parts[:2]:
        spark.createDataFrame(part, ENTRIES).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, check, canon, keys, out)
    some = spark.read.parquet(out).count()
    # a new query goes on from the checkpoint
    spark.createDataFrame(parts[2], ENTRIES).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([r for r in rows if r[1] == 3], ENTRIES).coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, check, canon, keys, out)
    got = spark.read.parquet(out).collect()
    assert 0 < some < len(got) == len(want)
    assert {(r.job, r.page, r.entry, r.ref, r.ord) for r in got} == want


def test_query_is_the_batch(spark, sf):
    from quiremill.plans import document_queries as Q

    got = {(r.job, r.page, r.entry, r.ord) for r in Q.stream_alignment(spark, sf).collect()}
    c = Q._canon(spark, sf).collect()
    rows = [(str(r.job), r.page, r.ord, r.ord, r.text[::-1] if r.key % 4 == 3 else r.text, "") for r in c]
    canon = Q._canon(spark, sf).withColumn("job", Q.F.col("job").cast("string"))
    want = A.align_canonical(spark.createDataFrame(rows, ENTRIES), canon, canon.selectExpr("job", "ref as key", "ord")).collect()
    assert got == {(int(r.job), r.page, r.entry, r.ord) for r in want} and got
    assert G is not None
