"""Chat formatting by perspective rotation: each dialogue once for every participant.

The participant's turns become assistant turns, which carry the training mask; the others are
users with their names, and instruction turns stay instructions. A dialogue is rendered whole; one
beyond a bound of bytes comes in consecutive pieces: one conversation may have most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.session import cut

#: Bytes of speakers and texts beyond which a dialogue comes in pieces.
PIECE_BYTES = 1 << 20
#: Ranges into which the rows of large dialogues are dealt for summing, and characters of a text that deal them.
RANGES, RANGE_CHARS = 200, 200
#: The number given to turns that have none; they come first.
NO_TURN = -(1 << 62)
START, END = "<|im_start|>", "<|im_end|>\n"
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def render(turns: list[tuple[str, str]], participant: str, instructions: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (speaker, text) turns seen by one participant, and the spans it is trained on.

    A span has a turn of the participant with its end marker, in code points, end exclusive.
    Markers within a text or name are broken by a space, so no text can open a turn.
    """
    out, at, spans = [], 0, []
    for speaker, text in turns:
        name, text = (x.replace("<|", "< |") for x in (speaker, text))
        if speaker in instructions:
            head = f"{START}system\n"
        elif speaker == participant:
            head = f"{START}assistant\n"
            spans.append((at + len(head), at + len(head) + len(text) + len(END)))
        else:
            head = f"{START}user name={name}\n"
        out += [head, text, END]
        at += len(head) + len(text) + len(END)
    return "".join(out), spans


def _pieces(turns: DataFrame, piece_bytes: int) -> DataFrame:
    """``turns`` plus piece: the bytes of speakers and texts before a turn, in its conversation's order, divided by ``piece_bytes``.

    Rows are dealt by ranges of that order and summed per range, so one conversation may have most rows.
    """
    begin = F.substring("text", 1, RANGE_CHARS)
    fixed = cut(turns.repartitionByRange(RANGES, "conv_id", "turn", "speaker", begin).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = fixed.groupBy("conv_id", "_range").agg(F.sum("size").alias("_sum")).select(
        "conv_id", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("conv_id", "_range").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = fixed.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(base, ["conv_id", "_range"])
    return placed.withColumn("piece", F.floor((F.col("_base") + F.col("_before")) / piece_bytes).cast("long")).select(*turns.columns, "piece")


def rotate(
    df: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    instructions: tuple[str, ...] = ("system",), piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """conv_id, participant, piece, n_turns, rendered, mask.

    A row for each participant of a conversation, with the whole dialogue; only a dialogue of more
    than ``piece_bytes`` comes in consecutive pieces of about that size, numbered from 0: a turn
    belongs to the piece that the UTF-8 bytes of the speakers and texts before it, divided by
    ``piece_bytes``, name (numbers may be left out after a longer text). Turns are ordered by number,
    speaker and text; equal rows are one turn. A null turn number comes first, a null speaker is
    named unknown, a null text is empty. Rows without conv_id belong to no dialogue and are not
    rendered; a conversation of instructions alone has no participant and no row. A very long text is
    rendered whole. An empty table gives no rows; other columns are not read.
    """
    turns = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.coalesce(F.col(turn).cast("long"), F.lit(NO_TURN)).alias("turn"),
        F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).distinct().withColumn("size", (F.octet_length("speaker") + F.octet_length("text")).cast("long"))
    large = turns.groupBy("conv_id").agg(F.sum("size").alias("_size")).where(F.col("_size") > piece_bytes).select("conv_id")
    whole = turns.join(large, "conv_id", "left_anti").withColumn("piece", F.lit(0).cast("long"))
    dealt = whole.unionByName(_pieces(turns.join(large, "conv_id", "left_semi"), piece_bytes))
    parts = dealt.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    speakers = turns.where(~F.col("speaker").isin(*instructions)).select("conv_id", F.col("speaker").alias("participant")).distinct()

    def start():
        def work(turns: list[list[dict]], who: list[str]) -> list[list]:
            made = [render([(t["speaker"], t["text"]) for t in x], p, instructions) for x, p in zip(turns, who, strict=True)]
            masks = [[{"start": a, "end": b} for a, b in spans] for _, spans in made]
            return [[len(x) for x in turns], [m[0] for m in made], masks]

        return work

    added = [
        T.StructField("n_turns", T.LongType()), T.StructField("rendered", T.StringType()), T.StructField("mask", T.ArrayType(SPAN)),
    ]
    keep = ["conv_id", "participant", "piece"]
    return map_slices(parts.join(speakers, "conv_id"), ["turns", "participant"], keep, added, start)
