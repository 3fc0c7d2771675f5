import collections

from pyspark.sql import functions as F

from tidegrid.llm.common import with_row_id


def test_rows_keep_their_numbers_however_files_are_split(spark, some_docs, tmp_path):
    path = str(tmp_path / "a b%c é")
    some_docs.withColumn("_metadata", F.lit(1)).repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    seen = []
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for parallelism, size in ((1, "128m"), (9, "16k")):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism)
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            docs = spark.read.parquet(path)
            seen.append((docs.rdd.getNumPartitions(), {r["n"]: r["doc_id"] for r in with_row_id(docs, "n").select("n", "doc_id").collect()}))
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert seen[0][0] < seen[1][0] and seen[0][1] == seen[1][1] and len(seen[0][1]) == some_docs.count()


def test_what_is_not_read_from_files_is_numbered_once(spark, some_docs):
    for docs in (some_docs.union(some_docs), spark.range(50).withColumn("x", F.lit(1)), some_docs.groupBy("lang").count()):
        rows = with_row_id(docs, "n")
        numbers = collections.Counter(r["n"] for r in rows.collect())
        assert len(numbers) == docs.count() and max(numbers.values()) == 1
        assert numbers == collections.Counter(r["n"] for r in rows.filter("n >= 0").collect())
