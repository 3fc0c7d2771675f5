import collections
import hashlib
import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from tidegrid.llm import exact, graph, similar, simhash, substring

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def classes(keys, links):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {k: find(k) for k in keys}


# -- exact ---------------------------------------------------------------------------------------


def exact_by_force(rows):
    by = collections.defaultdict(list)
    for i, t in rows:
        by[(t or "").translate(LOWER)].append(i)
    return by


def test_exact_equals_brute_force(some_docs):
    rows = [tuple(r) for r in some_docs.select("doc_id", "text").collect()]
    by = exact_by_force(rows)
    text = dict(rows)
    got = exact.exact_dedup(some_docs, block_bytes=64).collect()  # many levels
    assert len(got) == len(rows)
    for r in got:
        t = (text[r["doc_id"]] or "").translate(LOWER)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(by[t]), len(by[t]), r["doc_id"] == max(by[t]))
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_exact_on_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    by = exact_by_force(rows)
    for size in (3, 4096):
        got = exact.exact_dedup(odd_docs, block_bytes=size).collect()
        assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(by)
        sizes = {t: len(v) for t, v in by.items()}
        assert sorted(r["group_size"] for r in got) == sorted(sizes[(t or "").translate(LOWER)] for _, t in rows)
        assert sum(r["kept"] for r in got if r["doc_id"] == 8) == 1
        nulls = [r for r in got if r["doc_id"] is None]
        assert all(r["keep_id"] is None for r in nulls) and sum(r["kept"] for r in nulls) == 1
    assert exact.exact_dedup(no_docs).count() == 0


def test_names_tell_texts_apart_that_share_blocks(spark, tmp_path):
    # the same blocks in other orders and numbers
    texts = ["ab" * 8, "ba" * 8, "abab" + "baba", "baba" + "abab", "ab", "abab", "", "a"]
    spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = exact.exact_identity(spark.read.parquet(str(tmp_path / "d")), block_bytes=2).collect()
    names = collections.defaultdict(set)
    for r in got:
        names[(r["n_bytes"], r["name"])].add(texts[r["doc_id"] % len(texts)])
    assert len(names) == len(set(texts)) and all(len(v) == 1 for v in names.values())


# -- simhash -------------------------------------------------------------------------------------


def print_by_force(t):
    w = WORD.findall((t or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components_equal_brute_force(some_docs, odd_docs, no_docs):
    for docs in (some_docs, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        got = simhash.near_dedup(docs).collect()
        want = collections.Counter((i, format(print_by_force(t), "016x")) for i, t in rows)
        assert collections.Counter((r["doc_id"], r["fingerprint"]) for r in got) == want
        prints = {int(p, 16) for _, p in want}
        root = classes(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
        low = collections.defaultdict(list)
        for i, p in want:
            if i is not None:
                low[root[int(p, 16)]].append(i)
        for r in got:
            members = low[root[int(r["fingerprint"], 16)]]
            assert r["component_id"] == (min(members) if members else None)
        assert sum(r["kept"] for r in got) == len(set(root.values()))
    assert simhash.near_dedup(no_docs).count() == 0


def test_links_are_whole_for_small_and_large_buckets(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base:
        for _ in range(60):  # a chain of small steps, and a cloud in one segment
            b ^= 1 << rng.randrange(64) | (1 << rng.randrange(64))
            prints.add(b)
    prints |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(32) for j in range(i)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    want = classes(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(x,) for x in signed.values()], "print long")
    for bucket in (2, 8, 1000):
        roots = {r["node"]: r["root"] for r in graph.components(simhash.near_links(df, bucket)).collect()}
        got = collections.defaultdict(set)
        for p, x in signed.items():
            got[roots.get(x, x)].add(p)
        wanted = collections.defaultdict(set)
        for p, r in want.items():
            wanted[r].add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_chains_stars_and_loops(spark):
    n = 300
    chain = [(i, i + 1) for i in range(n)]
    star = [(1000, 1000 + i) for i in range(1, n)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    rng = random.Random(1)
    edges = chain + star + ring + [(5, 5)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    for chunk, few in ((1, 0), (1_000_000, 0), (1, graph.FEW)):  # in rounds, and in one task
        got = {r["node"]: r["root"] for r in graph.components(df, chunk, few).collect()}
        want = {k: r for k, r in classes({x for e in edges for x in e}, edges).items() if k != r}
        assert got == want
    assert graph.components(df.filter("u < 0")).count() == 0


def test_a_hub_is_shared_among_tasks(spark):
    star = spark.range(1, 4000).selectExpr("0L AS u", "id AS v").union(spark.createDataFrame([(9000, 9001)], "u long, v long"))
    shared = graph._shared(star)
    rows = [r["count"] for r in shared.groupBy("u", "s").count().filter("u = 0").collect()]
    assert len(rows) == 4 and max(rows) < 1100
    assert {(r["u"], r["m"]) for r in graph._least(shared).collect()} == {(0, 1), (9000, 9001)}
    plan = shared.join(graph._least(shared), ["u", "s"])._jdf.queryExecution().toString()
    assert "hashpartitioning(u#" in plan and ", s#" in plan


def test_alike_texts_are_found(spark, some_docs, odd_docs, no_docs, tmp_path):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, group = [], {}
    for g in range(12):
        words = [rng.choice(vocabulary) for _ in range(400)]
        for k in range(6 if g else 80):
            w = list(words)
            for _ in range(4 if k else 0):  # 4 words of 400 changed: shingles 0.9 alike
                w[rng.randrange(400)] = "changed"
            rows.append((len(rows), " ".join(w)))
            group[rows[-1][0]] = g
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for pivots in (32, 4):
        got = {r["doc_id"]: r["component_id"] for r in similar.similar_dedup(docs, pivots=pivots).collect()}
        for g in range(12):
            assert len({got[i] for i in group if group[i] == g}) == 1
        assert len(set(got.values())) == 12
    odd = similar.similar_dedup(odd_docs).collect()
    assert len(odd) == 18 and {r["component_id"] for r in odd if r["doc_id"] in (4, 5, 6)} == {4}
    assert similar.similar_dedup(no_docs).count() == 0


# -- substrings ----------------------------------------------------------------------------------


def judged_by_force(rows, window):
    words = [(k, i, WORD.findall(t or "")) for k, (i, t) in enumerate(rows)]
    seen = collections.Counter(tuple(w[p : p + window]) for _, _, w in words for p in range(len(w) - window + 1))
    out = []
    for _, i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return collections.Counter(out)


def test_removed_words_equal_brute_force(some_docs, odd_docs, no_docs):
    for docs, options in ((some_docs, {}), (odd_docs, {}), (some_docs, {"window": 9, "gram": 3, "batches": 1}), (odd_docs, {"window": 2, "gram": 2, "batches": 3})):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = substring.substring_dedup(docs, **options).collect()
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == judged_by_force(rows, options.get("window", 35))
        assert all(r["n_removed"] == sum(s["stop"] - s["start"] for s in r["removed"]) for r in got)
    assert substring.substring_dedup(no_docs).count() == 0


def test_repeats_inside_one_text_and_overlaps(spark, tmp_path):
    rng = random.Random(3)
    a, b = ([f"x{rng.randrange(9)}" for _ in range(40)] for _ in range(2))
    texts = [" ".join(a + b + a), " ".join(["y"] * 30), " ".join(b[:20]), " ".join(["q"] + a[5:] + ["r"]), " ".join(a[:9]), " ".join(["z"] * 10)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows = [tuple(r) for r in docs.collect()]
    for w in (4, 10):
        got = substring.substring_dedup(docs, window=w, gram=2).collect()
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == judged_by_force(rows, w)


def test_runs_are_sorted_and_compacted(spark, tmp_path):
    index = substring.RunIndex(spark, str(tmp_path / "runs"), fanout=2)
    for i in range(5):
        met = index.add(spark.range(100).selectExpr(f"(id * 37 + {i}) % 50 AS print", "id AS row", "CAST(id AS INT) AS at"))
        assert met.count() == 50
    assert sorted(r["print"] for r in index.add(spark.range(3).selectExpr("id + 48 AS print", "id AS row", "0 AS at")).collect()) == [48, 49]
    assert sorted(r["print"] for r in index.places(spark.createDataFrame([(50,)], "print long")).selectExpr("row AS print").collect()) == [2]
    index.drop()
    for i in range(5):
        index.add(spark.range(100).selectExpr(f"(id * 37 + {i}) % 50 AS print", "id AS row", "CAST(id AS INT) AS at"))
    assert [len(x) for x in index.levels] == [1, 0, 1] and index.postings().count() == 500
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "runs").iterdir() if not p.name.startswith(".")) == ["level", "level", "manifest"]
    for name in index.runs():
        for part in ("postings", "prints"):
            for f in spark.read.parquet(f"{tmp_path}/runs/{name}/{part}").inputFiles():
                p = [r["print"] for r in spark.read.parquet(f).coalesce(1).collect()]
                assert p == sorted(p)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = index.prints(index.runs()[0]).join(index.prints(index.runs()[1]), "print", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan  # runs meet as they lie


def test_a_kept_index_judges_later_batches(spark, some_docs, no_docs, tmp_path):
    rows = [tuple(r) for r in some_docs.select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if t]
    days = [rows[:70], rows[70:120], [(10**6, rows[3][1]), (10**6 + 1, rows[80][1] + " and " + rows[5][1]), (10**6 + 2, "new words")]]
    folder, seen = str(tmp_path / "kept"), []
    for n, day in enumerate(days):
        spark.createDataFrame(day, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / f"day{n}"))
        index = substring.RunIndex(spark, folder)  # as another session would open it
        for name in index.runs():
            spark.sql(f"DROP TABLE IF EXISTS {index._table(name)}")
        got = index.add_documents(spark.read.parquet(str(tmp_path / f"day{n}"))).collect()
        seen += day
        want = judged_by_force(seen, 35)
        have = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)
        ids = {i for i, _ in day}
        assert have == collections.Counter({k: v for k, v in want.items() if k[0] in ids})
    assert {r["n_removed"] == r["n_words"] for r in got if r["doc_id"] == 10**6} == {True}
    assert substring.RunIndex(spark, folder).add_documents(no_docs).count() == 0
    assert len(substring.RunIndex(spark, folder).batches) == 4


def test_window_hashes_depend_on_words_alone():
    h = np.random.default_rng(0).integers(0, 1 << 64, 50, np.uint64)
    twice = np.concatenate((h, h))
    for m in (substring._M1, substring._M2):
        p = substring._polynomials(twice, 7, m)
        assert np.array_equal(p[:44], p[50:94]) and len(set(p[:50].tolist())) == 50
    g = substring.grams(twice, 3)
    at = substring.smallest(g, 5)
    assert all(a == i + int(np.argmin(g[i : i + 5])) for i, a in enumerate(at.tolist()))


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_families_that_share_a_passage_equal_brute_force(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for own in (20, 8):  # as in a template; the second is mostly the passage
        for _ in range(150):
            w = [rng.choice(vocabulary) for _ in range(own)] + passage
            rows.append(" ".join(w))
            w[rng.choice((0, 1, own // 2))] = "changed"
            rows.append(" ".join(w))
    want = classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if 5 * jaccard(rows[i], rows[j]) >= 4 - 1e-9])
    assert 150 < len(set(want.values())) < len(rows)
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for part in (similar.PART, 50):  # crowded lists whole, and in pairs of blocks
        got = {r["doc_id"]: r["component_id"] for r in similar.similar_dedup(docs, pivots=4, part=part).collect()}
        assert got == want


def test_texts_less_alike_stay_apart(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for _ in range(60):
        w = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append(" ".join(w))
        for i in range(20, 300, 35):  # 8 words, so 40 of 296 shingles
            w[i] = "changed"
        rows.append(" ".join(w))
    assert all(0.7 < jaccard(a, b) < 0.8 for a, b in zip(rows[::2], rows[1::2], strict=True))
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = similar.similar_dedup(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got) and len(got) == 120


def test_signatures_are_deletion_variants(spark):
    rng = np.random.default_rng(9)
    width = similar.segment_width(300)
    prints = rng.integers(0, 1 << width, (300, similar.SEGMENTS))
    for i in range(150, 300):  # up to two bits of each segment changed
        for s in range(similar.SEGMENTS):
            for w in rng.choice(width, rng.integers(0, 3), replace=False).tolist():
                prints[i, s] = prints[i - 150, s] ^ (1 << w)
    texts = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(prints)], "id long, segments array<long>")
    rows = similar.signatures(texts, width).collect()
    assert len(rows) == 300 * similar.SEGMENTS * width
    lists = collections.defaultdict(list)
    for r in rows:
        lists[r["key"]].append(r["id"])
    got = {(max(a, b), min(a, b)) for ids in lists.values() for a in ids for b in ids if a != b}
    apart = np.bitwise_count(prints[:, None, :] ^ prints[None, :, :]).min(axis=2)
    assert got == {(i, j) for i in range(300) for j in range(i) if apart[i, j] <= 1} and len(got) > 100


def test_the_near_stage_links_by_signatures_and_prefixes_add_the_rest(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    rows = []
    for _ in range(60):
        w = [f"w{rng.randrange(5000)}" for _ in range(400)]
        rows.append(" ".join(w))
        for i in range(30, 400, 75):  # 5 words, so 25 of 396 shingles
            w[i] = "changed"
        rows.append(" ".join(w))
    assert all(jaccard(a, b) > 0.85 for a, b in zip(rows[::2], rows[1::2], strict=True))
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    found, whole = [], graph.components
    monkeypatch.setattr(similar, "components", lambda links: found.append(links.distinct().count()) or whole(links))
    ways = {"signatures": similar.signatures, "prefixes": similar.prefixes}
    for closed in (None, *ways):
        for name, way in ways.items():
            monkeypatch.setattr(similar, name, (lambda *a, way=way: way(*a).filter("false")) if name == closed else way)
        found.clear()
        kept = {r["doc_id"] for r in corpus_pipeline.near(spark, docs, "unused").collect()}
        assert kept >= set(range(0, 120, 2))
        if closed == "prefixes":  # signatures alone find at least 0.9
            assert found[-1] >= 54
        else:
            assert len(kept) == found[-1] == 60


def test_no_bloom_filter_goes_with_the_tasks_of_crowded_lists(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    passage, rows = [f"p{i}" for i in range(40)], []
    for i in range(40):
        own = [f"own{i}x{j}" for j in range(8 if i % 2 else 20)]
        rows += [" ".join(own + passage), " ".join([*own[:-1], "changed", *passage])]
    rng.shuffle(rows)
    want = classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if 5 * jaccard(rows[i], rows[j]) >= 4 - 1e-9])
    assert 20 <= len(set(want.values())) < len(rows)
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    plans, write = {}, similar.written
    monkeypatch.setattr(similar, "written", lambda df, path: plans.update({path.rpartition("/")[2]: df._jdf.queryExecution().optimizedPlan().toString()}) or write(df, path))
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side of a join were small
    try:
        got = {r["doc_id"]: r["component_id"] for r in similar.similar_dedup(docs, pivots=4).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert got == want
    assert "crowded" in plans and not [k for k, p in plans.items() if "bloom_filter_agg" in p]
