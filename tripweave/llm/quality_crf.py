"""Line quality by a linear-chain conditional random field, and document quality from it.

Every line is good or bad. Its features are its own and those of the lines before and after it;
the chain adds a weight for each two labels that follow each other. Forward-backward gives each
line's probability of being good; the mean of these, weighted by line length, is the document's
quality. Labels are of documents, so each line of a labelled document is taken to have its label.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.ordinal_toxicity import labelled_sample
from tripweave.llm.shingles import groups, mix, word_hashes

#: Labelled rows used for fitting at most, and lines of all of them together.
SAMPLE_ROWS, SAMPLE_LINES = 5_000, 320_000
#: Lines in a row that are taken from a text too long to be taken whole.
STRETCH = 64

_CLASSES = ("upper", "lower", "digit", "blank", "stop", "bang", "bar", "sign", "high")
_CODE = np.full(256, 7, dtype=np.int64)
for _name, _bytes in (
    ("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)), ("blank", (9, 10, 11, 12, 13, 32)),
    ("stop", b".,;:?'\"()-"), ("bang", b"!"), ("bar", b"|"), ("high", range(128, 256)),
):
    _CODE[list(_bytes)] = _CLASSES.index(_name)
#: Own features of a line: shares of each class, and the ones that lines_of adds.
OWN = len(_CLASSES) + 9
FEATURES = 3 * OWN + 1


def lines_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line, the lines' lengths in bytes, and how many lines each text has.

    Lines end at line feeds; a text has one more line than line feeds, so an empty one has one.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(joined == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = len(ends)
    sizes = ends - begins
    line = np.repeat(np.arange(n), sizes + 1)
    counts = np.bincount(line * len(_CLASSES) + _CODE[joined], minlength=n * len(_CLASSES)).reshape(n, -1)[:n]
    counts = counts.astype(float)
    counts[:, _CLASSES.index("blank")] -= 1  # the line feed itself
    raw = joined.tobytes()
    each = [raw[a:b] for a, b in zip(begins, ends, strict=True)]
    words, bounds = word_hashes(each)
    n_words = np.diff(bounds)
    of_line = np.repeat(np.arange(n), n_words)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (of_line[1:] == of_line[:-1])
    # the same line once more in its text, blank ones aside
    per_text = np.array([t.count(b"\n") + 1 for t in texts])
    text_of = np.repeat(np.arange(len(texts), dtype=np.uint64), per_text)
    key = mix(np.array([hash(x) for x in each], dtype=np.int64).view(np.uint64)) + text_of
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    repeats = (times[inverse] > 1) & (n_words > 0)
    last = joined[np.maximum(ends - 1, begins)]
    first = joined[begins]
    length = np.maximum(sizes, 1)[:, None]
    words_or_one = np.maximum(n_words, 1)
    extra = np.column_stack([
        np.log1p(sizes), np.log1p(n_words), (sizes - counts[:, 3]) / words_or_one / 10, np.bincount(of_line, weights=again, minlength=n) / words_or_one,
        repeats, np.isin(last, list(b".?!:;")) & (sizes > 0), (first >= 65) & (first <= 90), sizes == 0,
        counts[:, 5:8].sum(axis=1) / words_or_one,
    ])
    return np.column_stack([counts / length, extra]), sizes, per_text


def with_neighbours(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it in its text, and a 1."""
    ends = np.cumsum(per_text)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[ends[:-1]] = 0
    before[:1] = 0
    after[ends - 1] = 0
    return np.column_stack([own, before, after, np.ones(len(own))])


def marginals(emission: np.ndarray, per_text: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected counts of each two labels in a row, over all texts.

    emission is the score of good over bad; chain[i, j] the weight of label j after label i.
    Texts are taken together a line at a time, longest first, each step scaled to sum 1.
    """
    order = np.argsort(-per_text, kind="stable")
    lengths = per_text[order]
    starts = (np.cumsum(per_text) - per_text)[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    local = np.column_stack([np.ones(len(emission)), np.exp(np.clip(emission, -30, 30))])
    step = np.exp(chain)
    forward = np.zeros((len(emission), 2))
    for t in range(longest):
        at = starts[: active[t]] + t
        now = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        forward[at] = now / now.sum(axis=1, keepdims=True)
    good = np.zeros(len(emission))
    pairs = np.zeros((2, 2))
    behind = np.ones((len(lengths), 2))
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        both = forward[at] * behind[:m]
        good[at] = both[:, 1] / both.sum(axis=1)
        if t:
            ahead = local[at] * behind[:m]
            joint = forward[at - 1][:, :, None] * step * ahead[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            ahead = ahead @ step.T
            behind[:m] = ahead / ahead.sum(axis=1, keepdims=True)
    return good, pairs


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, chain: np.ndarray):
        self.mean, self.scale, self.weights, self.chain = mean, scale, weights, chain

    def lines(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) and length of every line, and the number of lines of each text."""
        own, sizes, per_text = lines_of(texts)
        x = with_neighbours(own, per_text)
        emission = ((x - self.mean) / self.scale) @ self.weights
        return marginals(emission, per_text, self.chain)[0], sizes, per_text

    def quality(self, texts: list[bytes]) -> Iterator[float]:
        for group in groups(texts):
            good, sizes, per_text = self.lines(group)
            weight = sizes + 1.0
            ends = np.cumsum(per_text)
            owner = np.repeat(np.arange(len(group)), per_text)
            total = np.bincount(owner, weights=weight * good, minlength=len(ends))
            mean = total / np.bincount(owner, weights=weight, minlength=len(ends))
            # the last bits depend on the texts scored together
            yield from np.round(np.clip(mean, 0.0, 1.0), 9).tolist()


def train(x: np.ndarray, per_text: np.ndarray, label: np.ndarray, *, penalty: float = 1.0, steps: int = 150) -> Model:
    """Maximizes the penalized likelihood of the line labels by Adam over all lines."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[-1] = 0.0, 1.0
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (x - mean) / scale
    y = np.repeat(label, per_text).astype(float)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = (per_text - 1)[label == 0].sum(), (per_text - 1)[label == 1].sum()
    params = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        good, pairs = marginals(x @ params[:-4], per_text, params[-4:].reshape(2, 2))
        gradient = (np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) - penalty * params) / max(len(y), 1)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(mean, scale, params[:-4], params[-4:].reshape(2, 2))


def share_of(sizes: list[int], lines: int) -> int:
    """The most lines a text may give, so that texts of ``sizes`` lines give ``lines`` at most (one each at least)."""
    left = lines
    for i, n in enumerate(sorted(sizes)):
        share = left // (len(sizes) - i)
        if n > share:
            return max(share, 1)
        left -= n
    return max(sizes, default=1)


def stretches(n: int, share: int, seed: int) -> list[tuple[int, int]]:
    """(first, end) of the lines taken from a text of n: all, or up to ``share`` in stretches over the whole text.

    The text is cut into equal parts and each gives a stretch at a place drawn by ``seed``.
    """
    if n <= share:
        return [(0, n)]
    long = min(STRETCH, share)
    parts = share // long
    rng = np.random.default_rng(seed)
    edges = [n * i // parts for i in range(parts + 1)]
    begins = [int(rng.integers(a, b - long + 1)) for a, b in zip(edges, edges[1:])]
    return [(a, a + long) for a in begins]


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS,
    lines: int = SAMPLE_LINES,
) -> Model:
    """Model from all lines of at most ``rows`` labelled texts, if they have at most ``lines`` together.

    Else the longest texts give stretches of lines from all over them, each a chain of its own. Without
    good or without bad labels every line is as likely good as that label says.
    """
    sample = labelled_sample(docs, labels, label, doc_id, text, rows)
    feeds = F.length("text") - F.length(F.translate("text", "\n", ""))
    sizes = [r["n"] for r in sample.select((F.coalesce(feeds, F.lit(0)) + 1).alias("n")).collect()]  # at most ``rows``
    share = share_of(sizes, lines)

    def start():
        def work(texts: list[str | None]) -> list[list]:
            packs, sizes = [], []
            for t in texts:
                raw = (t or "").encode()
                own, _, _ = lines_of([raw])
                taken = stretches(len(own), share, zlib.crc32(raw))
                x = with_neighbours(own, np.array([len(own)]))
                packs.append(np.concatenate([x[a:b] for a, b in taken]).astype("<f4").tobytes())
                sizes.append([b - a for a, b in taken])
            return [packs, sizes]

        return work

    added = [T.StructField("x", T.BinaryType()), T.StructField("lines", T.ArrayType(T.LongType()))]
    found = map_slices(sample, ["text"], ["_id", "label"], added, start).collect()  # at most ``rows``
    found.sort(key=lambda r: r["_id"])
    if len({r["label"] for r in found}) < 2:
        sure = 4.0 if not found or found[0]["label"] else -4.0
        weights = np.zeros(FEATURES)
        weights[-1] = sure
        return Model(np.zeros(FEATURES), np.ones(FEATURES), weights, np.zeros((2, 2)))
    x = np.concatenate([np.frombuffer(r["x"], dtype="<f4").reshape(-1, FEATURES) for r in found]).astype(float)
    label_of = np.repeat([r["label"] for r in found], [len(r["lines"]) for r in found])
    return train(x, np.array([n for r in found for n in r["lines"]]), label_of)


def score(df: DataFrame, model: Model, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` plus score, the length-weighted probability that lines are good (0 to 1).

    A null text counts as empty: one empty line. Line lengths count their line end, so empty lines
    weigh 1. Every row is scored by its whole text alone, repeated rows equally; a kept ``score``
    is replaced and an empty table gives no rows.
    """

    def start():
        return lambda texts: [list(model.quality([(t or "").encode() for t in texts]))]

    return map_slices(df, [text], keep, [T.StructField("score", T.DoubleType())], start)


def held_out(doc_id: str = "doc_id"):
    """Rows kept away from fitting: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
