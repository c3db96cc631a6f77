import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm.packing import public_byte_bpe
from lotwise.llm.training_order import END_ID, KEY, Layout, Permutation, read_record, read_shards, write_training_order

from .conftest import SCHEMA

SMALL = Layout(sequence=64, shard_records=16)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 255, 1000, 4097])
def test_permutation_is_a_bijection(n):
    every = np.arange(n)
    slots = Permutation(n, 7).slot(every)
    assert sorted(slots.tolist()) == every.tolist()
    assert Permutation(n, 7).sequence(slots).tolist() == every.tolist()


def test_key_decides_the_order():
    every = np.arange(5000)
    a, b = (Permutation(5000, k).slot(every) for k in (1, 2))
    assert (a == b).mean() < 0.01 and (a == every).mean() < 0.01
    assert (Permutation(5000, 1).slot(every) == a).all()
    assert abs(np.corrcoef(every, a)[0, 1]) < 0.1


def all_ids(rows):
    enc = public_byte_bpe()
    return [(r[0], [*enc.ids(r[1] or "").tolist(), END_ID]) for r in rows]


def in_order(rows):
    text = lambda t: (0, 0, "") if t is None else (1, zlib.crc32(t.encode()), t)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, text(r[1])))


def written(spark, docs, path, **more):
    n = write_training_order(docs, path, layout=SMALL, **more)
    return n, sorted(read_shards(spark, path, SMALL).collect(), key=lambda r: r["slot"])


def test_round_trip(spark, odd_docs, tmp_path):
    path = str(tmp_path / "o")
    n, records = written(spark, odd_docs, path)
    # brute force: the stream of the rows by doc_id, one sequence after the other
    each = all_ids(in_order(odd_docs.collect()))
    stream = [i for _, ids in each for i in ids]
    assert n == len(records) == -(-len(stream) // 64)
    assert [r["slot"] for r in records] == list(range(n))
    order = Permutation(n, KEY)
    index = {r["slot"]: r["doc_ids"] for r in spark.read.parquet(f"{path}/index").collect()}
    docs = [d for d, ids in each for _ in ids]
    for r in records:
        s = r["sequence_id"]
        assert order.slot([s])[0] == r["slot"]
        assert (r["shard"], r["record"]) == divmod(r["slot"], 16)
        ids = np.frombuffer(r["ids"], "<u2").tolist()
        assert ids == stream[64 * s : 64 * s + 64] and r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(r["ids"])
        held = docs[64 * s : 64 * s + 64]
        assert set(index[r["slot"]]) == set(held)


def test_order_does_not_follow_partitions(spark, odd_rows, tmp_path):
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    found = [written(spark, docs.repartition(n), str(tmp_path / str(n)), passes=passes) for n, passes in ((2, 1), (7, 2), (3, 5))]
    assert found[0] == found[1] == found[2]


def test_every_file_has_fixed_stride(spark, odd_docs, tmp_path):
    path = str(tmp_path / "o")
    n, _ = written(spark, odd_docs, path)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(f"{path}/shards").select("length", "path", "first").orderBy("first", "path").collect()]
    assert sizes == [SMALL.stride * min(16, n - 16 * k) for k in range(-(-n // 16))]


def test_resumes_at_a_slot(spark, odd_docs, tmp_path):
    path = str(tmp_path / "o")
    n, records = written(spark, odd_docs, path)
    for first in (0, 1, 16, 37, n - 1, n):
        rest = sorted(read_shards(spark, path, SMALL, first).collect(), key=lambda r: r["slot"])
        assert rest == records[first:]


def test_one_record_by_its_place(spark, odd_docs, tmp_path):
    path = str(tmp_path / "o")
    n, records = written(spark, odd_docs, path)
    for slot in (0, 1, 15, 16, n // 2, n - 1):
        sequence, ids = read_record(spark, path, slot, SMALL)
        assert sequence == records[slot]["sequence_id"] and ids.tobytes() == records[slot]["ids"]
    for slot in (n, n + 1000):
        with pytest.raises(Exception, match="no slot|past"):
            read_record(spark, path, slot, SMALL)


def test_damage_is_found(spark, odd_docs, tmp_path):
    path = tmp_path / "o"
    written(spark, odd_docs, str(path))
    shard = next((path / "shards" / "first=0").glob("part-00000*"))
    data = bytearray(shard.read_bytes())
    data[40] ^= 1
    (shard.parent / f".{shard.name}.crc").unlink()
    shard.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        read_shards(spark, str(path), SMALL).collect()


def test_clashing_and_empty(spark, no_docs, odd_docs, tmp_path):
    more = odd_docs.withColumns({c: F.lit("x") for c in ("slot", "part", "start", "offset", "sequence_id", "record", "n_ids", "ids", "shard", "doc_ids")})
    assert written(spark, more, str(tmp_path / "a")) == written(spark, odd_docs, str(tmp_path / "b"))
    assert write_training_order(no_docs, str(tmp_path / "c"), layout=SMALL) == 0


def test_id_that_does_not_fit(spark, odd_docs, tmp_path):
    with pytest.raises(Exception, match="needs over 1 bytes"):
        write_training_order(odd_docs, str(tmp_path / "o"), layout=Layout(id_bytes=1))
