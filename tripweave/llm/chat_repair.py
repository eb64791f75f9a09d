"""Repair of the structure of conversations by weighted interval parsing.

A conversation of one span is gathered, parsed and repaired by itself. One conversation may have most
of the rows, so the rows of longer ones are numbered in order and cut into spans. Each span is parsed bottom-up to its cells in a task; cells of neighbouring spans are
combined in rounds of ``FAN`` until one is left for each conversation, which names the cheapest
edits. These are dealt back to the spans, and the repaired spans of a conversation are digested in
their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm import repair_grammar as grammar
from tripweave.llm.batches import map_slices
from tripweave.session import cut

#: Rows of a span, and spans or cells combined at a time.
SPAN_ROWS, FAN = 512, 64
#: Ranges into which rows of conversations of more than one span are dealt for numbering, and characters of a text that deal them.
RANGES, RANGE_CHARS = 200, 200
_BLANK = "\\A[\\x20\\x09-\\x0D]*\\z"
_SPACE = " \t\n\x0b\x0c\r"
_ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"
CELL = T.StructType([
    T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
])


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(df: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """c, turn, role, text, o_role, o_text, copy: rows as a seeded fault of their (conv_id, turn) leaves them.

    Nulls count as one space. By crc32 of "conv_id:turn" modulo 20: 0 drops a row, 1 empties its
    text, 2 takes its sentence ends, 3 repeats it (copy 1), 4 makes its role user. o_role and o_text
    are as they were; they order rows of one turn.
    """
    kind = F.crc32(F.concat(_filled(conv_id), F.lit(":"), _filled(turn)).cast("binary")) % 20
    rows = df.select(
        F.col(conv_id).alias("c"), F.col(turn).cast("long").alias("turn"), _filled(role).alias("o_role"), _filled(text).alias("o_text"), kind.alias("kind")
    )
    changed = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("o_text", "[.!?]", "")).otherwise(F.col("o_text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "c", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("o_role")).alias("role"), changed.alias("text"),
        "o_role", "o_text", F.explode(copies).alias("copy"),
    )


TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_ORDER = ["turn", "o_role", "o_text", "copy"]  # nulls first


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` plus pos, their place in their conversation from 0: dealt by ranges of their order and counted per range."""
    begin = F.substring("o_text", 1, RANGE_CHARS)
    dealt = cut(rows.repartitionByRange(RANGES, "g", "turn", "o_role", begin).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy("g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("g", "_range").agg(F.count("*").alias("_n")).select(
        "g", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    within = F.row_number().over(Window.partitionBy("g", "_range").orderBy(*_ORDER)) - 1
    placed = dealt.withColumn("_row", within).join(base, ["g", "_range"])
    return placed.withColumn("pos", F.col("_base") + F.col("_row")).drop("_range", "_row", "_base")


def _cells(value: grammar.Cells) -> list[dict]:
    return [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in sorted(value.items())]


def _read(cells: list[dict]) -> grammar.Cells:
    return {(x["p"], x["q"]): (x["cost"], x["audit"]) for x in cells}


def _combined(spans: DataFrame, fan: int) -> DataFrame:
    """g and the cells of its whole conversation, from rows (g, span, cells), ``fan`` neighbours at a time."""

    def start():
        return lambda lists: [[_cells(grammar.fold([_read(x["cells"]) for x in one])) for one in lists]]

    while True:
        spans = cut(spans)
        if spans.where("span > 0").isEmpty():
            return spans.select("g", "cells")
        near = spans.groupBy("g", F.floor(F.col("span") / fan).alias("span")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("span").alias("k"), "cells"))).alias("parts")
        )
        spans = map_slices(near, ["parts"], ["g", "span"], [T.StructField("cells", T.ArrayType(CELL))], start)


@dataclass(frozen=True)
class Repaired:
    """``short``: conversations of one span with all their figures and repaired, their (role, text) in order.

    ``long``: the figures of the others. ``spans``: their repaired rows by span, to be put together in
    the order of span. All have g, which stands for c where c may be null.
    """

    short: DataFrame
    long: DataFrame
    spans: DataFrame


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repair(rows: DataFrame, *, span_rows: int = SPAN_ROWS, fan: int = FAN) -> Repaired:
    """Repaired conversations of rows with c, turn, role and text, and o_role, o_text and copy to order rows of one turn.

    Figures are c, gaps, blank, duplicate, truncated, illegal, cost and audit. Rows are ordered by turn, a
    missing one first. A row's first fault counts: blank (nothing but white space), duplicate (role and text
    seen before), truncated (does not end in ``.``, ``!`` or ``?``). Blank rows and duplicates must go; a
    truncated row that stays costs 5. Among the cheapest edits the audit that comes first as text is
    taken. c may be null, which is a conversation like others; role and text must not be. Equal rows are
    told apart by their place alone. A very long text is held whole by one task. No rows give no rows;
    other columns are not read.
    """
    rows = rows.select(
        F.struct(F.col("c").isNull().alias("n"), F.coalesce(F.col("c").cast("string"), F.lit("")).alias("v")).alias("g"),
        "c", *_ORDER[:1], "role", "text", *_ORDER[1:],
    )
    many = cut(rows.groupBy("g").count().where(F.col("count") > span_rows).select("g"))
    if many.isEmpty():
        short = _short(rows)
        none = short.where(F.lit(False))
        return Repaired(short, none.select("c", "g", *FIGURES), none.select("c", "g", F.lit(0).cast("long").alias("span"), "repaired"))
    return Repaired(_short(rows.join(many, "g", "left_anti")), *_long(rows.join(many, "g", "left_semi"), span_rows, fan))


def _short(rows: DataFrame) -> DataFrame:
    fields = [*_ORDER, "role", "text"]
    gathered = rows.groupBy("g").agg(F.first("c").alias("c"), F.collect_list(F.struct(*fields)).alias("rows"))

    def start():
        def work(lists: list[list[dict]]) -> list[list]:
            made = [_repaired(sorted(one, key=lambda x: (x["turn"] is not None, x["turn"] or 0, x["o_role"], x["o_text"], x["copy"]))) for one in lists]
            return [list(column) for column in zip(*made, strict=True)] if made else [[] for _ in range(len(FIGURES) + 1)]

        return work

    added = [T.StructField(f, T.StringType() if f == "audit" else T.LongType()) for f in FIGURES] + [T.StructField("repaired", TURNS)]
    return map_slices(gathered, ["rows"], ["c", "g"], added, start)


def _repaired(rows: list[dict]) -> tuple:
    """The figures of a whole conversation, in order, and its repaired rows."""
    turns = {x["turn"] for x in rows} - {None}
    told, seen = [], set()
    for x in rows:
        end = x["text"].rstrip(_SPACE)
        told.append("b" if not end else "d" if (x["role"], x["text"]) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((x["role"], x["text"]))
    cost, audit = grammar.best(grammar.fold(_parsed(rows, told)))
    turned, _ = grammar.apply(audit, [(x["role"], x["text"]) for x in rows], 0)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(told.count(k) for k in "bdt"), _illegal(rows), cost, audit,
        [{"role": r, "text": t} for r, t in turned],
    )


def _parsed(rows: list[dict], faults: list[str]) -> list[grammar.Cells]:
    return [grammar.row_cells(x["role"][:1], f in ("b", "d"), f == "t") for x, f in zip(rows, faults, strict=True)]


def _illegal(rows: list[dict]) -> int:
    return sum((a["role"][:1] + b["role"][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def _long(rows: DataFrame, span_rows: int, fan: int) -> tuple[DataFrame, DataFrame]:
    placed = cut(_numbered(rows).select("g", "c", "turn", "role", "text", "pos", F.col("text").rlike(_BLANK).alias("is_blank")))
    # positions are unique in a conversation, so a text repeated very often joins no key of its own
    firsts = placed.where("NOT is_blank").groupBy("g", "role", F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(F.min("pos").alias("pos")).select(
        "g", "pos", F.lit(True).alias("is_first")
    )
    faulty = placed.join(firsts, ["g", "pos"], "left").withColumn("fault", F.when(F.col("is_blank"), "b").when(
        F.col("is_first").isNull(), "d"
    ).when(~F.col("text").rlike(_ENDED), "t").otherwise(F.lit("")))
    span = F.floor(F.col("pos") / span_rows).cast("long").alias("span")
    spans = cut(faulty.groupBy("g", span).agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text", "fault"))).alias("rows"), F.first("c").alias("c")))

    def parsed():
        def work(lists: list[list[dict]]) -> list[list]:
            out: list[list] = [[], [], [], []]
            for one in lists:
                out[0].append(_cells(grammar.fold(_parsed(one, [x["fault"] for x in one]))))
                out[1].append(_illegal(one))
                out[2].append(one[0]["role"][:1])
                out[3].append(one[-1]["role"][:1])
            return out

        return work

    added = [
        T.StructField("cells", T.ArrayType(CELL)), T.StructField("illegal", T.LongType()), T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
    ]
    parsed_spans = cut(map_slices(spans.withColumn("n", F.size("rows")), ["rows"], ["g", "span", "n"], added, parsed))
    whole = cut(_combined(parsed_spans.select("g", "span", "cells"), fan))

    def chosen():
        def work(cells: list, numbers: list) -> list[list]:
            found = [grammar.best(_read(x)) for x in cells]
            dealt = []
            for (_, audit), lengths in zip(found, numbers, strict=True):
                ordered = sorted((x["span"], x["n"]) for x in lengths)
                cuts = grammar.slices(audit, [n for _, n in ordered])
                # the state before a span follows from what was made and whether an instruction leads
                dealt.append([{"span": s, "edits": e, "made": m} for (s, _), (e, m) in zip(ordered, cuts, strict=True)])
            return [[c for c, _ in found], [a for _, a in found], dealt]

        return work

    sizes = parsed_spans.groupBy("g").agg(F.collect_list(F.struct("span", "n")).alias("lengths"))
    slice_type = T.ArrayType(T.StructType([T.StructField("span", T.LongType()), T.StructField("edits", T.StringType()), T.StructField("made", T.LongType())]))
    best = cut(map_slices(
        whole.join(sizes, "g"), ["cells", "lengths"], ["g"],
        [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("dealt", slice_type)], chosen,
    ))
    edits = best.select("g", F.inline("dealt"))
    # the first row that is kept or made tells whether an instruction leads; it decides the state behind an even or odd number
    lead = _lead(spans, edits)
    joined = spans.join(edits, ["g", "span"]).join(lead, "g", "left")

    def rebuilt():
        def work(lists: list, edits: list, made: list, leads: list) -> list[list]:
            out = []
            for one, audit, m, led in zip(lists, edits, made, leads, strict=True):
                state = 0 if m == 0 else 1 if led and m == 1 else 3 if (m - bool(led)) % 2 == 0 else 2
                out.append([{"role": r, "text": t} for r, t in grammar.apply(audit, [(x["role"], x["text"]) for x in one], state)[0]])
            return [out]

        return work

    repaired = map_slices(joined, ["rows", "edits", "made", "led"], ["c", "g", "span"], [T.StructField("repaired", TURNS)], rebuilt)
    ordered = Window.partitionBy("g").orderBy("span")
    seams = parsed_spans.select("g", "illegal", F.concat(F.lag("last").over(ordered), "first").alias("seam"), F.row_number().over(ordered).alias("i"))
    illegal = seams.groupBy("g").agg((F.sum("illegal") + F.count_if((F.col("i") > 1) & ~F.col("seam").isin("su", "ua", "au"))).alias("illegal"))
    counts = faulty.groupBy("g", "turn").agg(
        F.first("c").alias("c"), *[F.count_if(F.col("fault") == k[0]).alias(k) for k in ("blank", "duplicate", "truncated")]
    ).groupBy("g").agg(
        F.first("c").alias("c"), F.count("turn").alias("turns"), F.max("turn").alias("top"), F.min("turn").alias("low"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")],
    ).withColumn("gaps", F.coalesce(F.col("top") - F.col("low") + 1 - F.col("turns"), F.lit(0)))
    conversations = counts.join(illegal, "g").join(best.select("g", "cost", "audit"), "g").select(
        "c", "g", *FIGURES
    )
    return conversations, repaired


def _lead(spans: DataFrame, edits: DataFrame) -> DataFrame:
    """g and led: whether the first row that the edits keep or make is an instruction that is kept."""

    def start():
        def work(lists: list, edits: list) -> list[list]:
            out = []
            for one, audit in zip(lists, edits, strict=True):
                at = next(i for i, e in enumerate(audit) if e != "D")  # rows before it are all deleted
                out.append(audit[at] == "K" and one[at]["role"][:1] == "s")
            return [out]

        return work

    first = edits.where("made = 0 AND edits RLIKE '[^D]'")
    return map_slices(spans.join(first, ["g", "span"]), ["rows", "edits"], ["g"], [T.StructField("led", T.BooleanType())], start)


def lines(repaired: str = "repaired") -> Column:
    """Repaired rows as "role:text", joined by line feeds."""
    return F.array_join(F.transform(repaired, lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


def digests(repaired: DataFrame) -> DataFrame:
    """n, v (of g) and sha256 of the lines of all repaired rows of spans, a span at a time in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def close() -> None:
            if key is not None:
                out.append((*key, state[0].hexdigest()))

        for batch in batches:
            for n, v, body, some in zip(*(batch.column(c).to_pylist() for c in ("n", "v", "body", "some")), strict=True):
                if (n, v) != key:
                    close()
                    key, state = (n, v), [hashlib.sha256(), False]
                if some:
                    state[0].update((b"\n" if state[1] else b"") + body.encode())
                    state[1] = True
            if out:
                yield _rows(out)
                out.clear()
        close()
        if out:
            yield _rows(out)

    rows = repaired.select("g.n", "g.v", "span", lines().alias("body"), (F.size("repaired") > 0).alias("some"))
    return rows.repartition("n", "v").sortWithinPartitions("n", "v", "span").select("n", "v", "body", "some").mapInArrow(run, "n boolean, v string, sha256 string")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    n, v, h = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(n, pa.bool_()), pa.array(v, pa.string()), pa.array(h, pa.string())], ["n", "v", "sha256"])
