import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pixsieve.llm import lines, queries, sharding, topk

SF = "/root/testdata/sf0.01"


def test_shards_are_equal_and_gapless(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op5_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert r["size"] == len(data) + 8 and r.text_crc32 == zlib.crc32(data)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.01 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_rebalancing_edits_the_map(spark):
    first = sharding.first_map(spark, 4, 64)
    load = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), F.when(F.col("id") % 4 == 0, 100).otherwise(10).cast("long").alias("bytes"))
    old = {r.virtual_slot: r.shard for r in first.collect()}
    new = {r.virtual_slot: (r.shard, r.version) for r in sharding.rebalanced(first, load, 4).collect()}
    size = {r.virtual_slot: r["bytes"] for r in load.collect()}
    total = Counter()
    for slot, (shard, version) in new.items():
        assert version == 2
        total[shard] += size[slot]
    assert max(total.values()) - min(total.values()) <= 100
    assert all(new[s][0] == old[s] for s in old if old[s] != 0)
    again = {r.virtual_slot: r.shard for r in sharding.rebalanced(first, load.withColumn("bytes", F.lit(5).cast("long")), 4).collect()}
    assert again == old


def test_sharding_edge_cases(spark, awkward):
    rows = sharding.sharded_documents(awkward, 3).collect()
    assert len(rows) == awkward.count() and sum(r["size"] == 8 for r in rows) == 2
    assert sharding.sharded_documents(awkward.limit(0), 3).count() == 0


def test_lines_by_hand(spark, make_docs):
    menu, rare = "Home | News", "Only here"
    rows = [(f"{menu}\n\nbody {i}\n{menu}  " + (f"\n{rare}" if i == 3 else ""), "en", "a") for i in range(20)]
    rows += [("copied story\nof two lines", "en", "a")] * 30
    rows += [(f"{menu}\nother {i}", "en", "small") for i in range(3)] + [(None, "en", "a"), ("", "en", None)]
    out = {r.doc_id: r for r in lines.drop_boilerplate(make_docs(rows), "source").collect()}
    assert [out[i].text for i in range(3)] == [f"\nbody {i}" for i in range(3)]
    assert out[3].text == f"\nbody 3\n{rare}" and (out[3].n_lines, out[3].n_dropped) == (5, 2)
    assert all(out[i].text == rows[i][0] for i in range(20, 55))
    assert (out[53].n_lines, out[54].n_lines) == (0, 1)


def test_line_edge_cases(spark, awkward, make_docs):
    clash = awkward.withColumns({"n_dropped": F.lit("old"), "host": F.col("source"), "line_keys": F.lit(1)})
    assert lines.drop_boilerplate(clash, "source").count() == awkward.count()
    assert lines.drop_boilerplate(awkward.limit(0), "source").count() == 0
    only = make_docs([("menu", "en", "a"), *[(f"menu\nx{i}", "en", "a") for i in range(9)]])
    left = lines.without_boilerplate(only, "source").collect()
    assert sorted(r.text for r in left) == [f"x{i}" for i in range(9)] and all(r.n_chars == len(r.text) for r in left)


def test_lines_on_one_to_fifteen_percent_of_a_host(spark, make_docs):
    """1000 pages of one host: lines above 2 % go, copied articles and lines of few pages stay."""
    shares = {0.01: False, 0.018: False, 0.02: False, 0.021: True, 0.03: True, 0.08: True, 0.15: True}
    pages = [[f"page {i}"] for i in range(1000)]
    for share in shares:
        for i in range(round(1000 * share)):
            pages[(i * 7) % 1000].append(f"line on {share}")
    rows = [("\n".join(p), "en", "large") for p in pages] + [("a copied story\nin two lines", "en", "large")] * 300
    rows += [(f"menu\nsmall {i}", "en", "four pages") for i in range(4)] + [(f"menu\nother {i}", "en", "five pages") for i in range(5)]
    out = {r.doc_id: r.text for r in lines.drop_boilerplate(make_docs(rows), "source").collect()}
    for share, goes in shares.items():
        left = sum(f"line on {share}" in out[i].split("\n") for i in range(1000))
        assert left == (0 if goes else round(1000 * share))
    assert all(out[i] == "a copied story\nin two lines" for i in range(1000, 1300))
    assert [out[i] for i in range(1300, 1304)] == [f"menu\nsmall {i}" for i in range(4)]
    assert [out[i] for i in range(1304, 1309)] == [f"other {i}" for i in range(5)]
    assert all(out[i].startswith(f"page {i}") for i in range(1000))


def brute(vectors, k):
    out = []
    for q, x in vectors:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), v) for v, y in vectors if v != q and len(x) == len(y))
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 4e5])
def test_top_k_by_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    data = [(i * 20, [scale * ((i * j) % 7 - 3) / 4 for j in range(5)]) for i in range(50)] + [(1, [1.0, 2.0]), (100_000, [1.0, 2.5])]
    odd = [(7, None), (8, []), (9, [1.0, None, 1.0, 1.0, 1.0]), (200, [math.inf] * 5), (300, [math.nan] * 5), (None, [1.0] * 5)]
    table = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
    vectors = topk.quantised(table)
    got = topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors, fan_in=3).collect()
    want = brute([(i, [math.floor(1024 * x) for x in v]) for i, v in data], 10)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    none = vectors.limit(0)
    assert topk.top_k(none, none).count() == 0


def test_top_k_shuffles_each_matrix_once(spark):
    vectors = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[(F.col("id") * k % 97).cast("long") for k in (3, 5, 7)]).alias("vector"))
    out = topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    packed = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(dim" in line or "Exchange hashpartitioning(c_dim" in line]
    assert len(packed) == 2 and "FlatMapCoGroupsInArrow" in plan
    assert out.count() == 300


@pytest.mark.parametrize(("group", "part"), [(1, 1), (3, 2), (100, 100)])
def test_groups_and_parts_change_nothing(spark, monkeypatch, group, part):
    monkeypatch.setattr(topk, "SHARD_ROWS", 11)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", group)
    monkeypatch.setattr(topk, "PART_SHARDS", part)
    data = [(i * 10, [(i * j) % 5 - 2 for j in range(4)]) for i in range(150)]
    vectors = spark.createDataFrame(data, "vec_id long, vector array<long>").repartition(5)
    got = topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors, k=7, fan_in=2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(data, 7)
