import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import common, mixing, packing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- mixing --------------------------------------------------------------------------------------


def targets_by_force(sizes, repeats=3):
    """Share, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, capped, left = {}, set(), float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in capped]
        total = sum(weight[s] for s in rest)
        new = [s for s in rest if left * weight[s] / total >= repeats * sizes[s]]
        if not new:
            return out | {s: left * weight[s] / total for s in rest}
        for s in new:
            out[s] = float(repeats * sizes[s])
            capped.add(s)
        left -= sum(out[s] for s in new)
        if len(capped) == len(names):
            return out


def test_targets_stop_at_three_times_a_source(spark):
    rng = random.Random(1)
    for k in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 50000]) for i in range(rng.randrange(1, 12))} | ({None: 7} if k % 2 else {})
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(targets_by_force(sizes))


def test_sources_reach_their_targets(some_docs, odd_docs, no_docs):
    for docs in (some_docs, odd_docs):
        for bucket in (20_000, 3):
            got = mixing.mix(docs, range_rows=bucket).collect()
            assert len(got) == docs.count()
            by = collections.defaultdict(list)
            for r in got:
                by[r["source"]].append(r)
            want = targets_by_force({s: sum(r["size"] for r in v) for s, v in by.items()})
            for s, rows in by.items():
                size = sum(r["size"] for r in rows)
                assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == size for r in rows)
                assert abs(sum(r["taken"] for r in rows) - want[s]) <= 2 * max(r["size"] for r in rows)
                assert all(r["taken"] in [k * r["size"] for k in range(4)] for r in rows)
            assert sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    counts = collections.Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in odd_docs.select("doc_id", "text").collect())
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == counts
    first, second = (sorted((r["row"], r["taken"]) for r in mixing.mix(some_docs).collect()) for _ in range(2))
    assert first == second
    assert mixing.mix(no_docs).count() == 0


def test_no_range_grows_with_what_many_rows_share(spark, tmp_path):
    # a source without words, one id that a third of the rows share, and null ids
    df = spark.range(3000).selectExpr("CASE id % 3 WHEN 0 THEN id WHEN 1 THEN 7 END AS doc_id", "IF(id % 2 = 0, 'a b c', '') AS text", "IF(id % 2 = 0, 'full', 'bare') AS source")
    df.repartition(3).write.parquet(str(tmp_path / "d"))
    d = common.with_row_id(spark.read.parquet(str(tmp_path / "d")), "row").withColumn("u", F.lit(0.5))
    sizes = [r["count"] for r in common.in_ranges(d, [F.col("u"), F.col("doc_id"), F.col("row")], 100, "b").groupBy("b").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 300
    got = mixing.mix(spark.read.parquet(str(tmp_path / "d")), range_rows=100).collect()
    assert len(got) == 3000 and sum(r["taken"] for r in got) == 4500 and all(r["target"] == (4500 if r["source"] == "full" else 0) for r in got)


def test_running_totals_over_buckets(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS x", "id % 7 AS v", "id div 50 AS b").withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    got = {r["x"]: r["t"] for r in common.running_total(df, ["k"], "b", [F.col("x")], F.col("v"), "t").collect()}
    sums = collections.Counter()
    for x in range(1000):
        sums[x % 3] += x % 7
        assert got[x] == sums[x % 3]


def test_mixing_runs_no_python(some_docs):
    plan = mixing.mix(some_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# -- packing -------------------------------------------------------------------------------------


def best_by_force(sizes, permitted, overhead):
    """The least cost of all partitions of a few sizes to bins."""
    best = [float("inf")]

    def cost(used):
        return next(c for c in permitted if c >= used) + overhead

    def place(i, bins):
        if sum(map(cost, bins)) >= best[0]:
            return
        if i == len(sizes):
            best[0] = sum(map(cost, bins))
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= permitted[-1]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_packings_are_near_the_optimum():
    rng = random.Random(2)
    worst = 0.0
    for _ in range(60):
        sizes = sorted((rng.randrange(1, 17) for _ in range(rng.randrange(1, 9))), reverse=True)
        total, where, used, lengths = packing.best_packing(sizes, (4, 8, 16), 1)
        assert [sum(s for s, b in zip(sizes, where, strict=True) if b == k) for k in range(len(used))] == used
        assert all(c >= u and c in (4, 8, 16) and not any(d >= u for d in (4, 8, 16) if d < c) for u, c in zip(used, lengths, strict=True))
        assert total == sum(c + 1 for c in lengths)
        worst = max(worst, total / best_by_force(sizes, (4, 8, 16), 1))
    assert worst <= 1.34


def test_joint_lengths_cost_no_more_than_one(some_docs):
    rng = random.Random(3)
    sizes = sorted((int(rng.lognormvariate(5, 1)) % 4096 + 1 for _ in range(3000)), reverse=True)
    total, *_ = packing.best_packing(sizes)
    for one in packing.LENGTHS:
        if one >= sizes[0]:
            alone, *_ = packing.best_packing(sizes, (one,))
            assert total <= alone
    assert total >= sum(sizes)


@pytest.mark.parametrize("options", [{}, {"permitted": (16, 64), "group_pieces": 50, "chunk": 20}])
def test_every_token_is_packed_once(some_docs, odd_docs, no_docs, options):
    permitted = options.get("permitted", packing.LENGTHS)
    for docs in (some_docs, odd_docs):
        sized = common.with_row_id(docs.select("doc_id", "text"), "r").withColumn("size", common.n_words(F.col("text")) + 1)
        got = packing.pack(sized, "size", row="r", **options).collect()
        pieces = collections.defaultdict(list)
        bins = collections.defaultdict(list)
        for r in got:
            pieces[r["row"]].append((r["start"], r["length"]))
            bins[r["bin_id"]].append((r["bin_offset"], r["length"], r["bin_length"], r["bin_used"]))
        for r in sized.collect():
            at = 0
            for start, length in sorted(pieces.pop(r["r"])):
                assert start == at and 0 < length <= max(permitted)
                at += length
            assert at == r["size"]
        assert not pieces
        for b in bins.values():
            at = 0
            for offset, length, _, _ in sorted(b):
                assert offset == at
                at += length
            assert {(x[2], x[3]) for x in b} == {(min(c for c in permitted if c >= at), at)}
    assert packing.pack(no_docs, "n_chars", **options).count() == 0
    with pytest.raises(ValueError):
        packing.pack(some_docs, "n_chars", permitted=())


@pytest.mark.parametrize("options", [{}, {"permitted": (16, 64), "group_pieces": 50, "chunk": 20}])
def test_sequences_hold_every_id_once(some_docs, odd_docs, no_docs, options):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    permitted = options.get("permitted", packing.LENGTHS)
    for docs in (some_docs, odd_docs):
        rows = common.with_row_id(docs, "r")
        want = {r["r"]: (r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in rows.collect()}
        got = collections.defaultdict(list)
        for b in packing.pack_documents(rows, path, row="r", **options).collect():
            assert len(b["ids"]) == b["bin_used"] and b["bin_length"] == min(c for c in permitted if c >= b["bin_used"])
            assert b["doc_ids"] == [p["doc_id"] for p in b["pieces"]]
            at = 0
            for p in b["pieces"]:
                assert p["offset"] == at and want[p["row"]][0] == p["doc_id"]
                got[p["row"]].append((p["start"], b["ids"][at : at + p["length"]]))
                at += p["length"]
            assert at == b["bin_used"]
        assert {k: [x for _, part in sorted(v) for x in part] for k, v in got.items()} == {k: v for k, (_, v) in want.items()}
    assert packing.pack_documents(no_docs, path, **options).count() == 0


# -- sharding ------------------------------------------------------------------------------------


def jump_by_force(key, shards):
    k = key % (1 << 64)
    k = (k ^ (k >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    k = (k ^ (k >> 27)) * 0x94D049BB133111EB % (1 << 64)
    k ^= k >> 31
    b, j = -1, 0
    while j < shards:
        b = j
        k = (k * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((k >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop_and_moves_little():
    rng = random.Random(4)
    keys = [*range(-50, 2000), *(rng.getrandbits(63) for _ in range(500))]
    arr = np.array(keys, np.int64)
    before = sharding.jump(arr, 1)
    for n in (1, 2, 3, 40, 41, 1000):
        now = sharding.jump(arr, n)
        assert now.tolist() == [jump_by_force(k, n) for k in keys]
    for n in range(1, 60):
        now, then = sharding.jump(arr, n), before
        assert n == 1 or set(now[now != then].tolist()) <= {n - 1}
        before = now
    share = np.bincount(sharding.jump(np.arange(200_000), 40), minlength=40)
    assert share.min() > 4600 and share.max() < 5400


def test_shards_of_tables(some_docs, odd_docs, no_docs):
    import zlib

    for docs, bucket in itertools.product((some_docs, odd_docs), (20_000, 2)):
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            raw = (r["text"] or "").encode()
            key = -1 if r["doc_id"] is None else r["doc_id"]
            want[(r["doc_id"], len(raw) + 16, zlib.crc32(raw), "key", jump_by_force(key, 5), jump_by_force(key, 6))] += 1
        got = sharding.shard(docs, 5, range_rows=bucket).collect()
        assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == want
        slots = collections.defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(no_docs, 0)


def test_written_shards_hold_whole_rows(spark, odd_docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(odd_docs, path, 3)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*odd_docs.columns, "shard"} and back.count() == odd_docs.count()
    assert back.drop("shard").exceptAll(odd_docs).count() == 0
