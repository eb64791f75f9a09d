"""Best-fit packing by minimum bin slack.

Texts are tokenized, ended and cut into pieces no longer than a sequence. How pieces are combined
depends on their lengths alone, and there are at most ``capacity`` different lengths, so the
combinations are found on the driver from a table of counts of that bounded size: per bin, the
longest piece left is set and a bitset dynamic program over the lengths left finds the fullest
combination for the rest. A combination that was the fullest stays the fullest while its lengths
last, so it is repeated until one of them runs out; the number of programs run depends on
``capacity``, not on the rows. Spark then gives each piece of a length its rank and looks up
its place.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.word_table import packed
from tripweave.session import cut

#: Parts into which the pieces of one length are split for ranking.
RANK_PARTS = 512
#: Blanks of the pattern (not those of Python's \s), and the longest run of them that its matcher is given:
#: it keeps a state for every blank and fails at a million.
_BLANKS, RUN = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000", 10_000
_LONG_RUN = re.compile(f"[{_BLANKS}]{{{RUN},}}")
#: One encoder for each pair of rank file and vocabulary in a Python worker.
_ENCODERS: dict = {}

PLACE = T.StructType([
    T.StructField("length", T.LongType()), T.StructField("rank_from", T.LongType()),
    T.StructField("rank_to", T.LongType()), T.StructField("first_sequence", T.LongType()),
    T.StructField("offset", T.LongType()),
])


def added_tokens(vocabulary_path: str) -> dict[str, int]:
    """The added tokens of a vocabulary in the format of ``tokenizers``, and their ids."""
    with open(vocabulary_path, encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    if any(t[flag] for t in listed for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take more than their own text are not supported")
    return {t["content"]: t["id"] for t in listed}


def encoder(ranks_path: str, vocabulary_path: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids by a file of merge ranks.

    The added tokens of ``vocabulary_path`` are found first, the leftmost and longest ones, and
    give their ids, as the library does; without it their names are plain text.
    """
    import public_tokenizers
    import tiktoken

    key = ranks_path, vocabulary_path
    if key not in _ENCODERS:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        plain = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        added = added_tokens(vocabulary_path) if vocabulary_path else {}
        _ENCODERS[key] = _with_added(_with_runs(plain), added)
    return _ENCODERS[key]


def _with_runs(plain) -> Callable[[str], list[int]]:
    """``plain.encode_ordinary`` for texts with blank runs of any length.

    A run always begins a piece of the pattern, which has all of it at the end of a text and all
    but its last blank elsewhere; the last one goes to what follows.
    """
    encode, one_piece = plain.encode_ordinary, plain._encode_single_piece

    def any_run(text: str) -> list[int]:
        if len(text) < RUN:
            return encode(text)
        out, at = [], 0
        for m in _LONG_RUN.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += encode(text[at:m.start()])
            out += one_piece(text[m.start():end])
            at = end
        return out + encode(text[at:])

    return any_run


def _with_added(encode: Callable[[str], list[int]], added: dict[str, int]) -> Callable[[str], list[int]]:
    if not added:
        return encode
    names = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))

    def whole(text: str) -> list[int]:
        if not any(name in text for name in added):
            return encode(text)
        out, at = [], 0
        for m in names.finditer(text):
            out += [*encode(text[at:m.start()]), added[m[0]]]
            at = m.end()
        return out + encode(text[at:])

    return whole


def tokenize(
    df: DataFrame, ranks_path: str, vocabulary_path: str | None = None, *, text: str = "text", keep: list[str], end_id: int,
    capacity: int = 1024,
) -> DataFrame:
    """A row for each piece: ``keep``, ``piece`` (from 0), ``start``, ``length``, ``ids``.

    ids are packed little-endian unsigned 32-bit integers. A text of more than ``capacity`` ids
    (its end id counts) is cut so that all pieces but the first are full. Null and empty texts
    have their end id alone. Repeated rows stay; columns outside ``keep`` are not returned.
    """
    added = [T.StructField("pieces", T.ArrayType(T.BinaryType()))]
    wide = 4 * capacity

    def start():
        encode = encoder(ranks_path, vocabulary_path)

        def work(texts: list[str | None]) -> list[list]:
            out = []
            for text in texts:
                ids = packed([*encode(text or ""), end_id])
                first = (len(ids) - 1) % wide + 1
                out.append([ids[:first], *(ids[i:i + wide] for i in range(first, len(ids), wide))])
            return [out]

        return work

    first = F.length(F.col("pieces")[0]) / 4
    return map_slices(df, [text], keep, added, start).select(
        *keep, first.cast("long").alias("_first"), F.posexplode("pieces").alias("piece", "ids")
    ).select(
        *keep, "piece",
        F.when(F.col("piece") == 0, F.lit(0)).otherwise(F.col("_first") + (F.col("piece") - 1) * capacity).cast("long").alias("start"),
        (F.length("ids") / 4).cast("long").alias("length"), "ids",
    )


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, with repeats, whose sum is the largest that ``counts`` allow within ``room``.

    Reachable sums are bits of one integer; each step adds a block of one, two, four ... equal
    lengths. Longer lengths come first and the search ends as soon as ``room`` is filled.
    """
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, block = min(counts[length], room // length), 1
        while left and not sums >> room:
            n = min(block, left)
            steps.append((sums, length, n))
            sums = (sums | sums << length * n) & mask
            left, block = left - n, 2 * block
        if sums >> room:
            break
    goal, out = sums.bit_length() - 1, []
    for before, length, n in reversed(steps):
        if not before >> goal & 1:
            goal -= length * n
            out += [length] * n
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places as (length, rank_from, rank_to, first_sequence, offset), ranks from 0.

    The piece of rank r, rank_from <= r < rank_to, goes to sequence first_sequence + r - rank_from.
    """
    left = {x: n for x, n in counts.items() if n}
    if left and (max(left) > capacity or min(left) < 1):
        raise ValueError("lengths must lie between 1 and the capacity")
    used, sequences, places = dict.fromkeys(left, 0), 0, []
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = [longest, *fullest(left, capacity - longest)]
        left[longest] += 1
        times = min(left[x] // combination.count(x) for x in set(combination))
        offset = 0
        for x in combination:
            places.append((x, used[x], used[x] + times, sequences, offset))
            used[x] += times
            left[x] -= times
            offset += x
        sequences += times
        left = {x: n for x, n in left.items() if n}
    return places


def pack(spark: SparkSession, pieces: DataFrame, *, capacity: int = 1024, parts: int = RANK_PARTS) -> DataFrame:
    """``pieces`` (with a ``length``) plus ``sequence_id`` and ``offset``, as few sequences as found.

    Pieces of one length are interchangeable; their ranks are counted in ``parts`` parts, so one
    length may have most of the rows. Repeated pieces each get a place; no pieces give no rows.
    The pieces are written once to the checkpoint folder.
    """
    fixed = cut(pieces.withColumn("_part", F.pmod(F.xxhash64(*pieces.columns), F.lit(parts))))
    counts = fixed.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    found = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = spark.createDataFrame(plan(found, capacity), PLACE)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_part").orderBy(*pieces.columns)
    ranked = fixed.withColumn("_row", F.row_number().over(within) - 1).join(base, ["length", "_part"])
    rank = F.col("_base") + F.col("_row")
    # the places are bounded by the capacity, whatever the number of rows
    return ranked.withColumn("_rank", rank).join(F.broadcast(places), "length").where(
        (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to"))
    ).select(
        *pieces.columns, (F.col("first_sequence") + F.col("_rank") - F.col("rank_from")).alias("sequence_id"), "offset",
    )
