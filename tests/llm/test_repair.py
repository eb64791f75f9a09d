"""Repair of conversations against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from tripweave.llm import chat_repair, repair_grammar as grammar

LEGAL = re.compile(r"(s?(ua)+)?")
BLANK, ENDED = re.compile(r"[\x20\x09-\x0D]*"), re.compile(r"(?s).*[.!?][\x20\x09-\x0D]*")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if BLANK.fullmatch(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif not ENDED.fullmatch(text):
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def search(rows):
    """Cheapest (cost, audit, repaired) by the definition: all edits of every row, all insertions up to two a gap."""
    told = faults(rows)
    options = []
    for (role, text), fault in zip(rows, told):
        gap = [("", [])] + [("I", [(r, "")]) for r in ("user", "assistant")] + [("II", [(a, ""), (b, "")]) for a, b in (("user", "assistant"), ("assistant", "user"))]
        options.append([(5 * len(k), k, made) for k, made in gap])
        extra = 5 if fault == "truncated" else 0
        edits = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            edits += [(extra, "K", [(role, text)]), *[(1 + extra, "R", [(r, text)]) for r in ("user", "assistant")]]
        options.append(edits)
    options.append([(5 * len(k), k, made) for k, made in ([("", [])] + [("I", [(r, "")]) for r in ("user", "assistant")] + [("II", [("user", ""), ("assistant", "")])])])
    best = None
    for choice in itertools.product(*options):
        made = [x for _, _, part in choice for x in part]
        if LEGAL.fullmatch("".join(r[:1] if r[:1] in "sua" and r else "x" for r, _ in made)):
            found = (sum(c for c, _, _ in choice), "".join(a for _, a, _ in choice), made)
            if best is None or found[:2] < best[:2]:
                best = found
    return best


def chain(rows):
    """The same by a table over the rows, for longer conversations (state: what the pattern expects next)."""
    steps = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    table = {"0": (0, "", [])}

    def inserted(table):
        for _ in range(3):
            for (p, r), q in steps.items():
                if p in table and r in names:
                    c, a, made = table[p]
                    table[q] = min(table.get(q, (10**9, "", [])), (c + 5, a + "I", [*made, (names[r], "")]), key=lambda x: x[:2])
        return table

    table = inserted(table)
    for (role, text), fault in zip(rows, faults(rows)):
        new, extra = {}, 5 if fault == "truncated" else 0
        for p, (c, a, made) in table.items():
            found = [(p, (c + 2, a + "D", made))]
            if fault not in ("blank", "duplicate"):
                for (x, r), q in steps.items():
                    if x == p and r == role[:1]:
                        found.append((q, (c + extra, a + "K", [*made, (role, text)])))
                    if x == p and r in names:
                        found.append((q, (c + 1 + extra, a + "R", [*made, (names[r], text)])))
            for q, cell in found:
                new[q] = min(new.get(q, (10**9, "", [])), cell, key=lambda x: x[:2])
        table = inserted(new)
    return min((table[q] for q in ("0", "a") if q in table), key=lambda x: x[:2])


def parsed(rows, span):
    told = faults(rows)
    cells = [grammar.row_cells(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, told)]
    parts = [grammar.fold(cells[i:i + span]) for i in range(0, len(cells), span)]
    cost, audit = grammar.best(grammar.fold(parts))
    return cost, audit


def random_dialogue(rnd, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", " "]
    texts = ["yes.", "no!", "why?", "cut", "", " \n", "x. ", "y.\t"]
    return [(rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.4 else f"t{rnd.random()}.") for _ in range(n)]


def test_cells_equal_all_edits():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3):
        for _ in range(25 if n < 3 else 12):
            rows = random_dialogue(rnd, n)
            cost, audit, made = search(rows)
            assert parsed(rows, 2) == (cost, audit) == chain(rows)[:2]
            assert grammar.apply(audit, rows, 0)[0] == made


def test_cells_equal_a_table_on_long_dialogues_cut_anywhere():
    rnd = random.Random(2)
    for n in (10, 37, 200):
        rows = random_dialogue(rnd, n)
        cost, audit, made = chain(rows)
        for span in (1, 3, 64):
            assert parsed(rows, span) == (cost, audit)
        assert grammar.apply(audit, rows, 0)[0] == made
        cuts = grammar.slices(audit, [3] * (n // 3) + [n % 3])
        assert "".join(e for e, _ in cuts) == audit


def brute(rows):
    """What op13_repair states, by loops."""
    out, by_conv = {}, {}
    fill = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, [])
        kind = zlib.crc32(f"{fill(conv)}:{fill(turn)}".encode()) % 20
        role, text = fill(role), fill(text)
        new = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        made = ((turn is not None, turn or 0, role, text), turn, "user" if kind == 4 else role, new)
        by_conv[conv] += [] if kind == 0 else [made, made] if kind == 3 else [made]
    for conv, found in by_conv.items():
        found.sort(key=lambda x: x[0])
        told = [(r, t) for _, _, r, t in found]
        turns = {t for _, t, _, _ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        kinds = faults(told)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(told, told[1:])]
        cost, audit, made = chain(told)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (
            gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, digest,
        )
    return out


SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    *[T.StructField(x, T.StringType()) for x in ("g", "c", "pos", "fault", "audit", "cost")],
])


@pytest.mark.parametrize(("span_rows", "fan"), [(512, 64), (4, 2)])
def test_query_equals_plain_loops(spark, tmp_path, monkeypatch, span_rows, fan):
    from tripweave.llm import queries

    rnd = random.Random(5)
    rows = []
    for conv in [*range(40), None, -3]:
        n = rnd.randint(1, 9) if conv != 7 else 300
        for i in range(n):
            role, text = random_dialogue(rnd, 1)[0]
            rows.append((conv, rnd.choice([i, i, i, i // 2, None, i + 900]), rnd.choice([role, role, None]), rnd.choice([text, text, None, "same."])))
    rows += rows[:4] + [(50, 1, "user", "word " * 30_000 + "."), (51, None, "user", " "), (52, 3, "", ".")]
    spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    whole = chat_repair.repair
    monkeypatch.setattr(chat_repair, "repair", lambda d: whole(d, span_rows=span_rows, fan=fan))
    got = {r[0]: tuple(r)[1:] for r in queries.op13_repair(spark, str(tmp_path)).collect()}
    assert got == brute(rows)


def test_no_rows(spark, tmp_path):
    from tripweave.llm import queries

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_repair(spark, str(tmp_path)).count() == 0
