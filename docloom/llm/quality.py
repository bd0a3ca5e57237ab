"""Quality rules: counts of a document, fixed limits, and boosted trees over its statistics.

``statistics`` counts words, symbols, repeated lines and repeated windows of words over whole
texts. ``QualityModel`` is a sum of gradient-boosted trees over ratios of such counts, kept as
flat arrays of nodes: a batch of documents walks all trees level by level in numpy. The trees
never rate a document higher for more symbols, more repeated lines or more repeated words, all
else being equal; a split that would is not made, and children stay on their side of it.

The model is fitted on at most ``sample`` labelled documents, those least by the hash of their
id, whatever the size of the table. Everything else covers every row and the whole text.

Defined cases: a null or empty text has no words and fails the fixed limits. A document with
contradicting labels counts with the lower one; null labels and labels of unknown documents are
left out. Where fewer than two classes are labelled the model accepts everything that keeps the
fixed limits. Rows with a null id and repeated rows are scored like any other. ``keep`` passes
all other columns through, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import column_bytes, map_batches, narrow, parts

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

SAMPLE = 20_000
ACCEPT = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "words", "word_length", "symbols", "dup_lines", "repeat_words", "upper", "capitals", "distinct",
    "end_marks", "commas", "bangs", "bars", "digits", "other_marks", "high_bytes", "line_words", "stops",
]
# The more of these, the lower the score or the same.
FALLING = ["symbols", "dup_lines", "repeat_words", "bangs", "bars"]

_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_DIGIT = np.isin(np.arange(256), list(range(48, 58)))
_MARK = np.isin(np.arange(256), list(b"\"'()-/:;=?@[\\]^_`{}~+"))
_LATER = (np.arange(256) & 0xC0) == 0x80  # bytes of a code point after its first
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight which the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    # hash() is the same for equal bytes within a process, which is all that is needed here.
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashed[i : n + i]
            windows ^= windows >> np.uint64(29)
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    often = np.zeros(n, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def describe(text: bytes | None) -> tuple[list[int], list[float]]:
    """The counts and the features of one text."""
    text = text or b""
    words = text.split()
    n = len(words)
    seen: set[bytes] = set()
    repeated_lines = lines = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                repeated_lines += 1
            else:
                seen.add(line)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(histogram[~(_SPACE | _LATER)].sum())
    symbols = int(histogram[_SYMBOL].sum())
    repeats = repeated_words(words)
    letters = max(int(histogram[_LETTER].sum()), 1)
    per_word = 1.0 / max(n, 1)
    known: dict[bytes, int] = {}
    for word in words:
        known[word] = known.get(word, 0) + 1
    features = [
        float(np.log1p(n)),
        chars * per_word,
        symbols * per_word,
        repeated_lines / max(lines, 1),
        repeats * per_word,
        int(histogram[_UPPER].sum()) / letters,
        sum(c for w, c in known.items() if 65 <= w[0] <= 90) * per_word,
        len(known) / max(n, 1) ** 0.7,
        int(histogram[46]) * per_word,
        int(histogram[44]) * per_word,
        int(histogram[33]) * per_word,
        int(histogram[124]) * per_word,
        int(histogram[_DIGIT].sum()) * per_word,
        int(histogram[_MARK].sum()) * per_word,
        int(histogram[128:].sum()) / max(len(text), 1),
        n / max(lines, 1),
        sum(sorted(known.values())[-10:]) * per_word,
    ]
    return [n, chars, symbols, repeated_lines, repeats], features


@dataclass(frozen=True)
class QualityModel:
    """Trees as flat arrays: node i of a tree has its children at ``child[i]`` and ``child[i] + 1``.

    A leaf is its own child and has an infinite limit, so walking on from a leaf stays there.
    """

    feature: np.ndarray  # trees x nodes
    limit: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """The probability of good quality of each row of features."""
        rows, trees = len(features), len(self.feature)
        total = np.full(rows, self.base)
        each = np.arange(rows)
        for t in range(trees):
            at = np.zeros(rows, np.int64)
            for _ in range(self.depth):
                right = features[each, self.feature[t][at]] > self.limit[t][at]
                at = self.child[t][at] + right
            total += self.value[t][at]
        return 1.0 / (1.0 + np.exp(-total))

    @staticmethod
    def constant() -> QualityModel:
        """The model that accepts everything."""
        none = np.zeros((0, 1))
        return QualityModel(none.astype(np.int64), none, none.astype(np.int64), none, 0, 30.0)

    @staticmethod
    def train(features: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
              bins: int = 48, least: float = 4.0, ridge: float = 1.0) -> QualityModel:
        """Boost ``trees`` trees on the logistic loss, splits taken from histograms of ``bins`` bins."""
        if len(np.unique(labels)) < 2:
            return QualityModel.constant()
        falling = np.isin(FEATURES, FALLING)
        edges = [np.unique(np.quantile(features[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features.shape[1])]
        binned = np.stack([np.searchsorted(e, features[:, f], side="left") for f, e in enumerate(edges)], 1)
        mean = labels.mean()
        base = float(np.log(mean / (1 - mean)))
        raw = np.full(len(labels), base)
        nodes = 2 ** (depth + 1) - 1
        grown = []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            tree = _Tree(nodes)
            tree.grow(binned, edges, p - labels, p * (1 - p), falling, depth, bins, least, ridge, rate)
            raw += tree.value[tree.leaf_of]
            grown.append(tree)
        return QualityModel(
            *[np.stack([getattr(t, a) for t in grown]) for a in ("feature", "limit", "child", "value")], depth, base
        )


class _Tree:
    """One tree while it grows, level by level."""

    def __init__(self, nodes: int):
        self.feature = np.zeros(nodes, np.int64)
        self.limit = np.full(nodes, np.inf)
        self.child = np.arange(nodes)
        self.value = np.zeros(nodes)
        self.leaf_of = np.zeros(0, np.int64)

    def grow(self, binned, edges, gradient, hessian, falling, depth, bins, least, ridge, rate) -> None:
        rows = len(binned)
        at = np.zeros(rows, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        open_nodes, used = [0], 1
        self.value[0] = -rate * gradient.sum() / (hessian.sum() + ridge)
        for _ in range(depth):
            following = []
            for node in open_nodes:
                inside = np.flatnonzero(at == node)
                best = self._split(binned[inside], gradient[inside], hessian[inside], falling, bounds[node], bins, least, ridge, rate, edges)
                if best is None:
                    continue
                _, f, b, left, right = best
                self.feature[node], self.limit[node], self.child[node] = f, edges[f][b], used
                at[inside] = used + (binned[inside, f] > b)
                self.value[used], self.value[used + 1] = left, right
                low, high = bounds[node]
                middle = (left + right) / 2
                bounds[used], bounds[used + 1] = ((middle, high), (low, middle)) if falling[f] else ((low, high), (low, high))
                following += [used, used + 1]
                used += 2
            open_nodes = following
        self.leaf_of = at

    @staticmethod
    def _split(binned, gradient, hessian, falling, bound, bins, least, ridge, rate, edges):
        """The best ``(gain, feature, bin, left value, right value)`` that keeps the constraints."""
        best = None
        whole_g, whole_h = gradient.sum(), hessian.sum()
        for f in range(binned.shape[1]):
            if not len(edges[f]):
                continue
            g = np.cumsum(np.bincount(binned[:, f], gradient, bins))[: len(edges[f])]
            h = np.cumsum(np.bincount(binned[:, f], hessian, bins))[: len(edges[f])]
            left = np.clip(-rate * g / (h + ridge), *bound)
            right = np.clip(-rate * (whole_g - g) / (whole_h - h + ridge), *bound)
            gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
            allowed = (h >= least) & (whole_h - h >= least)
            if falling[f]:
                allowed &= left >= right
            gain = np.where(allowed, gain, 0)
            b = int(np.argmax(gain))
            if gain[b] > 1e-6 and (best is None or gain[b] > best[0]):
                best = (float(gain[b]), f, b, float(left[b]), float(right[b]))
        return best


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, features array<double>)`` of every document."""
    rows = narrow(docs, doc_id=key, text=text)

    def run(batch: pa.RecordBatch) -> dict:
        found = [describe(t)[1] for t in column_bytes(batch, "text")]
        return {"doc_id": batch.column("doc_id"), "features": pa.array(found, pa.list_(pa.float64()))}

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text",
        label: str = "quality", **options) -> QualityModel:
    """Fit the trees on at most ``sample`` labelled documents; only their features reach the driver."""
    chosen = (
        narrow(labels, doc_id=key, label=label)
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` narrow rows, so this broadcast has a bound.
    wanted = narrow(docs, doc_id=key, text=text).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    found = features(wanted).dropDuplicates(["doc_id"]).join(chosen, "doc_id").orderBy("doc_id").limit(sample).toPandas()
    if not len(found):
        return QualityModel.constant()
    return QualityModel.train(np.array(found["features"].tolist()), (found["label"].to_numpy() > 0).astype(float), **options)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    """The fixed limits, in whole numbers."""
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def _judge(model: QualityModel, texts: list[bytes | None], accept: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    described = [describe(t) for t in texts]
    counts = np.array([c for c, _ in described], np.int64).reshape(-1, len(COUNTS))
    failed = np.array([base_failed(c[0], c[4]) for c, _ in described], bool)
    score = model.score(np.array([f for _, f in described], float).reshape(-1, len(FEATURES)))
    return counts, failed, score, ~failed & (score >= accept)


def judge(docs: DataFrame, model: QualityModel, accept: float = ACCEPT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts, ``base_failed``, ``score`` and ``kept`` of every document."""
    rows = narrow(docs, doc_id=key, text=text)

    def run(batch: pa.RecordBatch) -> dict:
        counts, failed, score, kept = _judge(model, column_bytes(batch, "text"), accept)
        return {
            "doc_id": batch.column("doc_id"),
            **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)},
            "base_failed": pa.array(failed),
            "score": pa.array(score),
            "kept": pa.array(kept),
        }

    counted = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, {counted}, base_failed boolean, score double, kept boolean"
    return map_batches(rows, run, schema)


def keep(docs: DataFrame, model: QualityModel, accept: float = ACCEPT, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept."""

    def run(batches):
        for batch in parts(batches):
            yield batch.filter(pa.array(_judge(model, column_bytes(batch, text), accept)[3]))

    return docs.mapInArrow(run, docs.schema)
