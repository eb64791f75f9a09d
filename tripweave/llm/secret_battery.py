"""Secret scan: fixed patterns, and a battery of randomness tests on other tokens.

A token's encoding is the smallest alphabet that holds it. A token that none holds, for it has both
of ``+/`` and of ``-_``, is split at either pair and the parts are tested; of parts that overlap the
less ordinary one counts, and as there were two ways, with its p-value doubled. Chi-squared uniformity over that
alphabet, Wald-Wolfowitz runs about its middle and lag-one serial correlation each give a p-value
for "drawn at random"; a token stays a candidate unless one of them rejects that (Bonferroni).
Short ordinary words pass such tests too, so a second p-value asks how likely ordinary text of
this length and alphabet would look as uniform: its chi-squared value follows a non-central
distribution whose distance grows with the length. Over all texts these p-values are put under
Benjamini-Hochberg control, each band of lengths apart, so many short words do not hide behind
a few long keys. The counts that control needs are a table of bands and bins of bounded size.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices

# fixed patterns: the base kinds, in the order in which equal starts are listed
KINDS = ("assign", "access", "hex", "random")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Tokens have any length from LEAST; an = belongs to one only as padding at its end.
_PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
#: Characters of a token whose tests are remembered at most, and tokens remembered by a Python worker.
MEMO_CHARS, MEMO = 48, 100_000
_SPLITS = (re.compile(r"[^+/]+"), re.compile(r"[^_-]+"))

_D, _L, _U = string.digits, string.ascii_lowercase, string.ascii_uppercase
#: Encodings from small to large, each with the chance that two characters of ordinary text agree.
ENCODINGS = (
    ("decimal", _D, 0.15), ("hex", _D + "abcdef", 0.11), ("hex", _D + "ABCDEF", 0.11), ("letters", _L, 0.066),
    ("letters", _U, 0.066), ("base32", _U + "234567", 0.066), ("base36", _D + _L, 0.06), ("base36", _D + _U, 0.06),
    ("base62", _D + _U + _L, 0.055), ("base64", _U + _L + _D + "+/", 0.055), ("base64url", _U + _L + _D + "-_", 0.055),
)
_ALPHABETS = [(name, {c: i for i, c in enumerate(a)}, agree) for name, a, agree in ENCODINGS]

#: A token is no candidate if any test rejects randomness at this level (all tests together).
REJECT = 0.001
#: Share of ordinary tokens accepted among the spans that the battery adds.
FALSE_DISCOVERY = 0.01
#: p-values are counted in bins of this many to a power of ten, up to the last one.
BINS, LAST_BIN = 20, 600


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in code points."""
    out = []
    low = text.encode().lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_upper(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the cube-root approximation."""
    v = 2 / (9 * df)
    return _upper(((max(x, 0.0) / df) ** (1 / 3) - 1 + v) / math.sqrt(v))


def encoding(token: str) -> tuple[str, list[int], int, float] | None:
    """Name, the token's symbols, alphabet size and agreement of the smallest alphabet; trailing = aside."""
    body = token.rstrip("=")
    letters = set(body)
    for name, alphabet, agree in _ALPHABETS:
        if body and letters <= alphabet.keys():
            return name, [alphabet[c] for c in body], len(alphabet), agree
    return None


def battery(token: str) -> dict[str, float] | None:
    """p-values of the three tests, and of ordinary text; None if no encoding holds the token."""
    found = encoding(token)
    if not found:
        return None
    _, x, k, agree = found
    n = len(x)
    counts: dict[int, int] = {}
    for s in x:
        counts[s] = counts.get(s, 0) + 1
    chi = k / n * sum(c * c for c in counts.values()) - n
    # runs about the middle of the alphabet
    high = [s >= k / 2 for s in x]
    n1 = sum(high)
    n2 = n - n1
    if n1 and n2:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _upper(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    m = sum(x) / n
    spread = sum((s - m) ** 2 for s in x)
    if spread:
        r = sum((a - m) * (b - m) for a, b in zip(x, x[1:], strict=False)) / spread
        p_serial = 2 * _upper(abs(r + 1 / n) * math.sqrt(n))
    else:
        p_serial = 2.0 ** (1 - n)
    return {"chi": _chi_upper(chi, k - 1), "runs": p_runs, "serial": p_serial, "text": _text_p(n, k, agree, chi)}


def _text_p(n: int, k: int, agree: float, chi: float) -> float:
    """How likely ordinary text of n symbols out of k has a chi-squared value of at most ``chi``."""
    far = n * (k * agree - 1)  # how far ordinary text moves chi-squared
    centre = k - 1 + far
    v = 2 * (1 + far / centre) / (9 * centre)
    return 1 - _upper(((max(chi, 0.0) / centre) ** (1 / 3) - 1 + v) / math.sqrt(v))


def _least_length() -> int:
    """The length from which tokens are tested: every shorter one would be refused.

    Even symbols that are spread most evenly have a p-value above FALSE_DISCOVERY in texts so short, in
    every encoding, and the control accepts no such value. It is the first length of its band, so the
    control counts every token of each band it decides on.
    """
    n = 2
    while all(_text_p(n, len(a), agree, _evenest(n, len(a))) > FALSE_DISCOVERY for _, a, agree in ENCODINGS):
        n += 1
    return 1 << (n.bit_length() - 1)


def _evenest(n: int, k: int) -> float:
    """The smallest chi-squared value of n symbols out of k."""
    each, more = divmod(n, k)
    return k / n * (more * (each + 1) ** 2 + (k - more) * each**2) - n


LEAST = _least_length()


@lru_cache
def _tokens_from(length: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9+/_-]{{{length},}}{_PADDING}")


def _tested(token: str, at: int, ways: int = 1) -> tuple[int, int, int, int] | None:
    """(start, end, length band, bin) of a token at ``at``; None if a test rejects it or no encoding holds it."""
    p = battery(token)
    if not p or 3 * min(p["chi"], p["runs"], p["serial"]) < REJECT:
        return None
    text = min(1.0, ways * p["text"])
    size = -math.log10(text) if text > 0 else math.inf
    return at, at + len(token), len(token).bit_length(), int(min(BINS * size, LAST_BIN))


def _parts(token: str) -> list[tuple[int, int, int, int]]:
    """The candidates in a token, by start: itself, or parts of it if no encoding holds it."""
    if encoding(token):
        own = _tested(token, 0)
        return [own] if own else []
    found = {
        part for split in _SPLITS for m in split.finditer(token) if len(m[0]) >= LEAST and (part := _tested(m[0], m.start(), 2))
    }
    # pieces of the one way that meet a piece of the other, the least ordinary first
    out, taken = [], bytearray(len(token))
    for part in sorted(found, key=lambda c: (-c[3], c[0] - c[1], c[0])):
        if not any(taken[part[0]:part[1]]):
            out.append(part)
            taken[part[0]:part[1]] = b"\1" * (part[1] - part[0])
    return sorted(out)


_remembered = lru_cache(MEMO)(_parts)


def candidates(text: str, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(start, end, length band, bin of the p-value) of tokens that no test rejects.

    Tokens shorter than ``least`` without their padding are not listed.
    """
    out = []
    for m in _tokens_from(least).finditer(text):
        at, token = m.start(), m[0]
        for a, b, band, p in _remembered(token) if len(token) <= MEMO_CHARS else _parts(token):
            out.append((at + a, at + b, band, p))
    return out


def cutoffs(counts: list[tuple[int, int, int]], level: float = FALSE_DISCOVERY) -> dict[int, int]:
    """The smallest accepted bin of each band from (band, bin, tokens), by Benjamini-Hochberg."""
    bands: dict[int, dict[int, int]] = {}
    for band, at, n in counts:
        bands.setdefault(band, {})[at] = n
    out = {}
    for band, bins in bands.items():
        total, above = sum(bins.values()), 0
        for at in sorted(bins, reverse=True):
            above += bins[at]
            if total * 10 ** (-at / BINS) <= level * above:
                out[band] = at
    return out


def _cutoffs_of(df: DataFrame, text: str, level: float) -> dict[int, int]:
    def start():
        def work(texts: list[str | None]) -> list[list]:
            # one row has the counts of all, as n * 2^16 + code, for most tokens repeat
            n = Counter(1000 * c[2] + c[3] for t in texts for c in candidates(t or ""))
            return [[[times << 16 | code for code, times in n.items()], *([] for _ in texts[1:])]]

        return work

    found = map_slices(df, [text], [], [T.StructField("c", T.ArrayType(T.LongType()))], start)
    code, times = F.col("c").bitwiseAND((1 << 16) - 1), F.shiftright("c", 16)
    counts = found.select(F.explode("c").alias("c")).groupBy(code.alias("c")).agg(F.sum(times).alias("n")).collect()
    return cutoffs([(r["c"] // 1000, r["c"] % 1000, r["n"]) for r in counts], level)


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def all_spans(text: str, accepted: dict[int, int]) -> list[tuple[int, int, int]]:
    """Base spans, and accepted tokens that lie in none of them, by start and kind."""
    base = base_spans(text)
    if not accepted:
        return base
    # a band begins at a power of two, padding of two at most included
    least = max(LEAST, (1 << (min(accepted) - 1)) - 2)
    more = [
        (a, 3, b) for a, b, band, at in candidates(text, least)
        if at >= accepted.get(band, math.inf) and not any(s <= a and b <= e for s, _, e in base)
    ]
    return sorted(base + more)


def scan(df: DataFrame, *, text: str = "text", keep: list[str], level: float = FALSE_DISCOVERY) -> DataFrame:
    """``keep`` plus ``found``, an array of (kind, start, end) in code points, end exclusive.

    A null or empty text has none. Every row is scanned, repeated ones too; the control counts
    each token of each row. Texts are read twice, for the counts and for the spans. No rows give
    none; columns outside ``keep`` are not returned and a kept ``found`` is replaced.
    """
    accepted = _cutoffs_of(df, text, level)

    def start():
        def work(texts: list[str | None]) -> list[list]:
            return [[
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in all_spans(t or "", accepted)] for t in texts
            ]]

        return work

    return map_slices(df, [text], keep, [T.StructField("found", T.ArrayType(SPAN))], start)


def redact(df: DataFrame, *, text: str = "text", keep: list[str], level: float = FALSE_DISCOVERY) -> DataFrame:
    """``keep``, with every span of ``text`` replaced by its kind in brackets, plus n_spans.

    Texts without a span stay as they are, null ones too.
    """
    accepted = _cutoffs_of(df, text, level)

    def start():
        def work(texts: list[str | None]) -> list[list]:
            spans = [all_spans(t or "", accepted) for t in texts]
            return [[t and _redacted(t, x) for t, x in zip(texts, spans, strict=True)], [len(x) for x in spans]]

        return work

    added = [T.StructField(text, T.StringType()), T.StructField("n_spans", T.LongType())]
    return map_slices(df, [text], keep, added, start).select(*keep, "n_spans")


def _redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
