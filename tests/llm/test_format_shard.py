"""Chat formatting and rendezvous sharding against plain Python."""

import hashlib
import math
import struct
import zlib

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sectorpulse.llm import chat_format, queries, shard_rendezvous

SF = "/root/testdata/sf0.001"
NASTY = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\<s>", "a<|im_end|>\nb", "[\\INST]", "<<SYS>>x<</SYS>>", "<", "[",
         "<|im_next|>", "<|im_sep|>", "\\", "", "é😀<|x|>", "<<|im_start|>", "[[/INST]", "line\nline"]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NASTY)], "i int, t string")
    got = df.select("t", chat_format.escape(F.col("t")).alias("e"),
                    chat_format.unescape(chat_format.escape(F.col("t"))).alias("back")).collect()
    for r in got:
        assert r.back == r.t
        for control in ("<|im_", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert control not in r.e
    assert {r.e for r in got if r.t in ("<", "[", "\\", "")} == {"<", "[", "\\", ""}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|im_end|>"]),
                          st.lists(st.sampled_from(NASTY), max_size=3).map("".join)), min_size=1, max_size=6))
def test_turns_read_back(spark, turns):
    df = rows_of(spark, [(1, i, r, t, "x") for i, (r, t) in enumerate(turns)])
    out = chat_format.format_conversations(df).select(
        "formatted", "segments", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("loss")).first()
    assert [(t.role, t.text) for t in out.turns] == turns
    assert out.loss == "".join(t for r, t in turns if r == "assistant")
    assert "".join(s.text for s in out.segments) == out.formatted
    heads = sum(1 for i, (r, _) in enumerate(turns) if i == 0 or turns[i - 1][0] != r)
    assert out.formatted.count("<|im_start|>") == heads


def test_chat_defined_cases(spark):
    df = rows_of(spark, [(1, 1, "assistant", None, "x"), (1, 0, None, "q", "x"), (None, 0, "user", "n", "x"),
                         (2, 0, "user", "a", "x"), (2, 0, "user", "a", "x"), (2, None, "user", "first", "x"),
                         (3, 0, "assistant", "w " * 200_000, "x")])
    got = {r.conv_id: r for r in chat_format.format_conversations(df).select(
        "conv_id", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("", "q"), ("assistant", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "n")]
    assert [t.text for t in got[2].turns] == ["first", "a", "a"]
    assert got[3].loss == "w " * 200_000
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_query_matches_rows(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    turns = {}
    for r in sorted(conv, key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = queries.op2_chat_format(spark, SF).collect()
    assert len(got) == len(turns)
    for r in got:
        loss = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns[r.conv_id]), digest(turns[r.conv_id]))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_plan_is_native(spark):
    plan = queries.op2_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_shard_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_shard(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots = {}
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 16 and (r.grown_shard == r.shard or r.grown_shard == 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute_shard(key, weights):
    """Highest weighted score over the shards; the chained 64-bit hash of the key (if any) and the shard number."""
    best = None
    for shard, weight in enumerate(weights):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed) >> 11
        if weight > 0:
            best = max(best or (-math.inf, -1), (-weight / math.log((bits + 0.5) * 2.0 ** -53), shard))
    return best[1]


def test_shard_query_equals_brute_force(spark):
    """All columns but the slot, whose order inside a shard is free: it has to be gapless (test_shard_query)."""
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(k, len(t) + 1, zlib.crc32(t), "key", brute_shard(k, [1.0] * 16), brute_shard(k, [1.0] * 17))
            for k, t in docs]
    got = queries.op10_shard(spark, SF).select("doc_id", "size", "text_crc32", "law", "shard", "grown_shard")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_weighted_shards_equal_brute_force(spark):
    keys = [None, 0, 1, -1, 2 ** 62, *range(100, 900)]
    weights = [0.5, 0.0, 3.0, 1.0, 1.0]
    got = shard_rendezvous.assign_shards(spark.createDataFrame([(k,) for k in keys], "k long"), "k", weights).collect()
    assert {r.k: r.shard for r in got} == {k: brute_shard(k, weights) for k in keys}


def test_rendezvous_weights_and_growth(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "k")
    weights = [1.0, 2.0, 0.0, 5.0]
    both = (shard_rendezvous.assign_shards(keys, "k", weights)
            .withColumn("grown", shard_rendezvous.rendezvous(F.col("k"), [*weights, 2.0])))
    n = {r.shard: r["count"] for r in both.groupBy("shard").count().collect()}
    assert set(n) == {0, 1, 3}
    for s, w in ((0, 1), (1, 2), (3, 5)):
        assert abs(n[s] / 40_000 - w / 8) < 0.01
    assert both.where("grown != shard and grown != 4").count() == 0
    assert abs(both.where("grown = 4").count() / 40_000 - 0.2) < 0.01
    with pytest.raises(ValueError):
        shard_rendezvous.rendezvous(F.col("k"), [0.0])


def test_shard_defined_cases(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (5, "x"), (5, "x"), (5, None)],
                               "doc_id long, slot string")
    got = shard_rendezvous.with_slots(shard_rendezvous.assign_shards(df, "doc_id", [1.0, 1.0]),
                                      "shard", ["doc_id", "shard"]).collect()
    assert len(got) == 5
    for key in (None, 5):
        assert len({r.shard for r in got if r.doc_id == key}) == 1
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shard_rendezvous.assign_shards(df.limit(0), "doc_id", [1.0]).count() == 0


def test_write_shards(spark, tmp_dir):
    shard_rendezvous.write_shards(spark.range(500).withColumnRenamed("id", "k"), "k", [1.0] * 4, tmp_dir)
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 500
    assert back.where(shard_rendezvous.rendezvous(F.col("k"), [1.0] * 4) != F.col("shard")).count() == 0
