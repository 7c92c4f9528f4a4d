"""Token shards: a writer that runs again, one that was killed, other keys and parameters, several shards a partition."""

import os

import pytest

from quiremill.llm import token_shards as S


def contents(folder):
    return {f: open(f"{folder}/shards/{f}", "rb").read() for f in os.listdir(f"{folder}/shards")}


def test_writing_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "WRITERS", 2)
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7 + 1)) for i in range(60)], "doc_id long, text string")
    folder, how = f"file://{tmp_path}/s", {"seq_len": 16, "shard_bytes": 256}
    first = sorted(map(tuple, S.write_shards(docs, folder, key=3, **how).collect()))
    whole = contents(f"{tmp_path}/s")
    assert len(whole) > 6
    names = sorted(whole)
    # a killed writer: one shard is missing, one is cut short, one isn't renamed, and one has other bytes before its end
    path = f"{tmp_path}/s/shards/"
    os.remove(path + names[0])
    with open(path + names[1], "r+b") as f:
        f.truncate(100)
    os.rename(path + names[2], path + names[2] + ".99.tmp")
    kept = os.stat(path + names[3]).st_mtime_ns
    assert sorted(map(tuple, S.write_shards(docs, folder, key=3, **how).collect())) == first
    os.remove(path + names[2] + ".99.tmp")
    assert contents(f"{tmp_path}/s") == whole and os.stat(path + names[3]).st_mtime_ns == kept
    # another key replaces the shards, in another order
    other = S.write_shards(docs, folder, key=4, **how)
    assert sorted(r.slot for r in other.collect()) == sorted(r[0] for r in first)
    ids = dict(S.read_slots(folder, 0, len(first)))
    assert [int(ids[r.slot].astype(int).sum()) for r in other.collect()] == [r.id_sum for r in other.collect()]
    assert all(contents(f"{tmp_path}/s")[n] != whole[n] for n in names)
    with pytest.raises(ValueError):
        S.write_shards(docs, folder, key=4, seq_len=32)
    # repeated in another order the corpus is the same; with another text or id it isn't
    S.write_shards(docs.repartition(3), folder, key=4, **how)
    for other in (docs.replace(7, 77, "doc_id"), docs.replace("text number 0 ", "text number zero ", "text"), docs.union(docs.limit(1)), docs.where("doc_id > 0")):
        with pytest.raises(ValueError, match="another corpus"):
            S.write_shards(other, folder, key=4, **how)
    # the same vocabulary at another place is the same, another one at the same place isn't
    copy = tmp_path / "vocabulary"
    copy.write_bytes(open(S.VOCABULARY, "rb").read())
    S.write_shards(docs, folder, key=4, vocabulary=str(copy), **how)
    copy.write_bytes(b"\n".join(copy.read_bytes().splitlines()[:-1]))
    with pytest.raises(ValueError, match="vocabulary"):
        S.write_shards(docs, folder, key=4, vocabulary=str(copy), **how)
