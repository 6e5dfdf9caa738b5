import collections
import zlib

from pyspark.sql import functions as F

from strata.llm import sharding

from . import odd


def check(placed, docs, shards):
    rows = placed.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == \
        sorted(((r[0], r[1]) for r in docs), key=repr)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 1 and r.law == "key"
        assert 0 <= r.shard < shards and r.grown_shard in (r.shard, shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(s) == 1 for s in by_id.values())
    return rows


def test_every_row_has_one_place(spark):
    docs = odd.rows([(100 + i, f"text {i % 7}") for i in range(300)])
    df = odd.frame(spark, [(100 + i, f"text {i % 7}") for i in range(300)])
    for bucket_bytes in (200, 1 << 24):  # several buckets a shard, and one
        rows = check(sharding.external_shuffle(df, 16, bucket_bytes=bucket_bytes), docs, 16)
    grown = {r.doc_id: r.shard for r in sharding.external_shuffle(df, 17).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in rows)
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)) if r.shard == rows[0].shard
             and r.doc_id is not None]
    assert order != sorted(order)
    assert sharding.external_shuffle(odd.empty(spark), 16).collect() == []


def test_query_columns_and_written_shards(spark, sf_small, tmp_path):
    from strata.llm.queries import op7_sharding
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in op7_sharding(spark, sf_small).collect():
        assert r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
    sharding.write_shards(odd.frame(spark), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(odd.rows()) and back.agg(F.max("shard")).first()[0] < 4
