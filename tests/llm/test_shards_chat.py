"""Sharding and chat rotation against plain Python versions."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import types as T

from tripweave.llm import chat_rotation, mixture_shards


def test_shards_hold_the_mixture(spark, docs_of):
    rows = [(i, f"text {i}", "big" if i % 3 else f"s{i % 11}") for i in range(3000)]
    out = mixture_shards.shard(docs_of(rows), 16).collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    sizes = [sum(r.shard == s for r in out) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    for name in {r.source for r in out}:
        own = [sum(r.shard == s and r.source == name for r in out) for s in range(16)]
        assert max(own) - min(own) <= 5
    for s in range(16):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert sorted(out) == sorted(mixture_shards.shard(docs_of(rows[::-1]).repartition(5), 16).collect())


def test_odd_rows_are_sharded(spark, odd_docs):
    out = mixture_shards.shard(odd_docs, 4).collect()
    assert len(out) == odd_docs.count() and len({(r.shard, r.slot) for r in out}) == len(out)
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in out}
    assert sizes[2] == (1, 0) and sizes[3] == (1, 0)
    assert sizes[7] == (2, zlib.crc32(b"a"))
    assert mixture_shards.shard(odd_docs.limit(0), 4).count() == 0
    assert {r.shard for r in mixture_shards.shard(odd_docs.limit(2), 16).collect()} <= set(range(16))


TURN = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("participant", T.StringType()), T.StructField("turns", T.StringType()),
])


def _rotated(rows):
    """(conv_id, participant) to (text, spans) by plain loops."""
    seen = {}
    for c, t, s, x in {(c, chat_rotation.NO_TURN if t is None else t, s or "unknown", x or "") for c, t, s, x in rows if c is not None}:
        seen.setdefault(c, []).append((t, s, x))
    out = {}
    for c, turns in seen.items():
        for who in {s for _, s, _ in turns} - {"system"}:
            text, spans = "", []
            for _, s, x in sorted(turns):
                x = x.replace("<|", "< |")
                head = "system" if s == "system" else "assistant" if s == who else f"user name={s}"
                text += f"<|im_start|>{head}\n"
                if s == who:
                    spans.append((len(text), len(text) + len(x) + len("<|im_end|>\n")))
                text += f"{x}<|im_end|>\n"
            out[c, who] = (text, spans)
    return out


def _glued(parts):
    """Pieces put together in order."""
    got = {}
    for r in sorted(parts, key=lambda r: r.piece):
        text, spans = got.get((r.conv_id, r.participant), ("", []))
        moved = [(s.start + len(text), s.end + len(text)) for s in r["mask"]]
        got[r.conv_id, r.participant] = (text + r.rendered, spans + moved)
    return got


def test_every_participant_gets_its_whole_view(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([0, 1, 2, 300, None]), rnd.choice(["user", "ann", "bob", "system", None]),
             rnd.choice(["hi", "", None, "<|im_start|>x", "long " * 2000])) for _ in range(120)]
    rows += [(9, t, "user" if t % 2 else "ann", f"turn {t}") for t in range(700)] + [(10, 0, "system", "alone")]
    rows += [(11, 1000 * t, "user" if t % 2 else "ann", f"turn {t}") for t in range(6)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURN)
    parts = chat_rotation.rotate(df).collect()
    assert {(r.conv_id, r.participant): (r.rendered, [(s.start, s.end) for s in r["mask"]]) for r in parts} == _rotated(rows)
    assert all(r.piece == 0 for r in parts) and len(parts) == len(_rotated(rows))
    assert sorted(r.n_turns for r in parts if r.conv_id in (9, 11)) == [6, 6, 700, 700]
    assert chat_rotation.rotate(df.limit(0)).count() == 0


def test_large_dialogues_come_in_pieces_by_position(spark):
    rows = [(1, i % 256, "user" if i % 2 else "ann", f"text {i}") for i in range(1100)]
    rows += [(1, 7, "bob", f"{'long ' * 60}{i}") for i in range(1500)]
    rows += [(2, t, "user", f"turn {t}") for t in range(256)] + [(3, 1, "ann", "x" * 9000), (3, 2, "ann", "y")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURN)
    parts = chat_rotation.rotate(df, piece_bytes=5000).collect()
    assert _glued(parts) == _rotated(rows)
    assert max(sum(s.end - s.start for s in r["mask"]) for r in parts if r.conv_id == 1) < 5400
    assert [r.n_turns for r in sorted((r for r in parts if r.conv_id == 3), key=lambda r: r.piece)] == [1, 1]


def test_pieces_equal_the_sql(spark, tmp_path, monkeypatch):
    import duckdb

    from tripweave.llm import queries

    rows = [(1, i // 3, "user" if i % 2 else "ann", f"{'words ' * 3000}{i}") for i in range(400)] + [(2, 5000 * i, "b", "x") for i in range(9)]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame([(*r, "x", "y") for r in rows], TURN).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    told = con.execute(queries.ORACLE_SQL["op4_chat"])
    names = [d[0] for d in told.description]
    got = queries.op4_chat(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(told.fetchall()) and len({r.piece for r in got}) == 7
