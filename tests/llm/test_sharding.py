import zlib
from collections import defaultdict

from skyledger.llm import sharding
from tests.llm import odd


def check(docs, shards=sharding.SHARDS):
    rows = sharding.assign(docs, shards).collect()
    given = sorted((str(r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == given
    slots, sizes = defaultdict(list), defaultdict(int)
    for row in rows:
        assert 0 <= row.shard < shards
        slots[row.shard].append(row.slot)
        sizes[row.shard] += row["size"]
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    return rows, sizes


def test_fixture_shards_are_near_equal(spark):
    rows, sizes = check(odd.fixture_documents(spark), 8)
    mean = sum(sizes.values()) / 8
    # At most half a document at either end.
    assert max(abs(s - mean) for s in sizes.values()) <= max(r["size"] for r in rows)


def test_hot_group_is_subdivided_and_small_groups_stay_whole(spark):
    rows = [(i, "hot " * 20 if i % 3 == 0 else odd.prose(i // 4, 12)) for i in range(6000)]
    found, sizes = check(odd.documents(spark, rows))
    mean = sum(sizes.values()) / sharding.SHARDS
    assert len(sizes) == sharding.SHARDS and max(abs(s - mean) for s in sizes.values()) < 0.1 * mean
    text = dict(rows)
    where = defaultdict(set)
    for row in found:
        where[text[row.doc_id]].add(row.shard)
    assert len(where.pop("hot " * 20)) > 5
    assert max(map(len, where.values())) == 1


def test_pieces_follow_the_bytes_of_a_range(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS", 4)
    # A hot text with and without ids, in more ranges than shards ask for.
    rows = [(i if i % 6 else None, "hot " * 20 if i % 2 == 0 else odd.prose(i, 12)) for i in range(6000)]
    found, sizes = check(odd.documents(spark, rows), 4)
    mean = sum(sizes.values()) / 4
    assert max(abs(s - mean) for s in sizes.values()) < 0.02 * mean
    again = sharding.assign(odd.documents(spark, rows), 4)
    place = lambda r: (r.doc_id, r.shard, r.slot)
    assert sorted(place(r) for r in again.collect() if r.doc_id) == sorted(place(r) for r in found if r.doc_id)


def test_odd_rows(spark):
    check(odd.documents(spark))


def test_empty(spark):
    check(odd.documents(spark, []))
