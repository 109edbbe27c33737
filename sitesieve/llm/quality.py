"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts. They are computed once, kept, and used for training and scoring. Trees are grown
level by level over binned statistics with second-order gains, and flattened into arrays (feature, threshold, left
child, leaf value) that numpy traverses for all rows of a batch at once.

Training looks at most at `train_rows` labelled rows, those with the least hash of id and statistics, in the driver;
this bound is a parameter of the classifier and the only sample taken.

Defined cases: null and empty texts have zero statistics and get a score like any other; labels that are null, of
unknown documents or of held-out documents are not learned from; repeated labels of a document count each; with no
labels, or labels of one kind, every score is that share (0.5 without any); a null doc_id counts as the empty text for
the fold and is never labelled; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

NAMES = [
    "log_bytes", "log_words", "mean_word", "word_spread", "letters", "upper", "digits", "marks", "stops", "commas", "spaces",
    "lines_per_word", "wide", "symbols", "distinct_words", "top_word", "repeated_pairs", "top_pair", "bare_words", "word_entropy",
    "byte_entropy", "mean_line", "distinct_lines", "long_words", "short_words", "capital_words", "sentence_words",
]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_KINDS = {
    "letters": _table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _table("0123456789"),
    "marks": _table("#$%&*@^~|<>{}[]=+_\\/!"),
    "stops": _table(".!?"),
    "commas": _table(",;:"),
    "spaces": _table(" \t\n\r\f\v"),
}


def _runs(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distinct values, count of the commonest, values that occur again, and entropy of the values."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(v)))
    of = r[at]
    distinct = np.bincount(of, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of, count)
    again = np.bincount(of, weights=np.where(count > 1, count, 0), minlength=n)
    total = np.maximum(np.bincount(r, minlength=n), 1)
    share = count / total[of]
    return distinct, top, again, -np.bincount(of, weights=share * np.log(share), minlength=n)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of NAMES per text."""
    w = W.split(texts)
    _, off = W.buffers(texts)
    n = len(texts)
    size = np.diff(off)
    per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])
    words = np.diff(w.first)
    chars, some = np.maximum(size, 1), np.maximum(words, 1)
    length = w.end - w.start
    by_row = lambda x: np.bincount(w.row, weights=x, minlength=n)
    h = W.hashes(w)
    distinct, top, _, entropy = _runs(h, w.row, n)
    pairs, ok = W.windows(h, 2), W.inside(w, 2)
    _, top_pair, again, _ = _runs(pairs[ok], w.row[: len(ok)][ok], n)
    row_of_byte = np.repeat(np.arange(n), size)
    hist = np.bincount(row_of_byte * 256 + w.buf, minlength=n * 256).reshape(n, 256)
    p = hist / chars[:, None]
    byte_entropy = -(p * np.log(np.maximum(p, 1e-12))).sum(1)
    lines = W.split(texts, _LINE)
    n_lines = np.diff(lines.first)
    lines_distinct = _runs(W.hashes(lines), lines.row, n)[0]
    first_byte, last_byte = (w.buf[w.start], w.buf[w.end - 1]) if len(w.start) else (np.zeros(0, np.uint8), np.zeros(0, np.uint8))
    bare = _KINDS["letters"][first_byte] & _KINDS["letters"][last_byte]
    mean = by_row(length) / some
    kinds = {k: per(t[w.buf]) / chars for k, t in _KINDS.items()}
    columns = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(words), "mean_word": mean, "word_spread": np.sqrt(np.maximum(by_row(length.astype(float) ** 2) / some - mean**2, 0)), **kinds,
        "lines_per_word": n_lines / some, "wide": per(w.buf >= 0x80) / chars, "symbols": per(_SYMBOL[w.buf]) / chars, "distinct_words": distinct / some, "top_word": top / some,
        "repeated_pairs": again / some, "top_pair": top_pair / some, "bare_words": by_row(bare) / some, "word_entropy": entropy, "byte_entropy": byte_entropy,
        "mean_line": size / np.maximum(n_lines, 1), "distinct_lines": lines_distinct / np.maximum(n_lines, 1), "long_words": by_row(length > 15) / some, "short_words": by_row(length < 4) / some,
        "capital_words": by_row(_KINDS["upper"][first_byte]) / some, "sentence_words": words / np.maximum(per(_KINDS["stops"][w.buf]), 1),
    }
    return np.stack([columns[x] for x in NAMES], axis=1).astype(np.float64)


_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[0x21:0x7F] = True
for _k in ("letters", "digits"):
    _SYMBOL &= ~_KINDS[_k]


class Trees(NamedTuple):
    """All trees in arrays; a leaf is its own child. base: the log-odds before the first tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 1.0, least: int = 8) -> Trees:
    """Histogram boosting by logistic loss, a level of a tree at a time."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    empty = Trees(np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(0, np.int64), depth, base)
    if not len(y) or share in (0.0, 1.0):
        return empty
    n, d = x.shape
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T  # d rows of cuts
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
    flat = binned + np.arange(d) * bins
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    logit = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p)
        at = len(feature)
        roots.append(at)
        nodes, where = [at], np.full(n, at)
        grow = lambda: (feature.append(0), threshold.append(np.inf), left.append(len(left)), right.append(len(right)), value.append(0.0))
        grow()
        for _level in range(depth):
            following = []
            for node in nodes:
                rows = np.flatnonzero(where == node)
                if len(rows) < 2 * least:
                    continue
                cells = flat[rows].ravel()
                gs, hs = (np.bincount(cells, np.repeat(v[rows], d), d * bins).reshape(d, bins).cumsum(1) for v in (g, h))
                cs = np.bincount(cells, minlength=d * bins).reshape(d, bins).cumsum(1)
                g_all, h_all = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + ridge) + (g_all - gs) ** 2 / (h_all - hs + ridge) - g_all**2 / (h_all + ridge)
                gain[(cs < least) | (len(rows) - cs < least)] = -1
                gain[:, -1] = -1
                best = int(np.argmax(gain))
                if gain.flat[best] <= 1e-9:
                    continue
                f, b = divmod(best, bins)
                feature[node], threshold[node] = f, edges[f, b]
                a, c = len(feature), len(feature) + 1
                grow(), grow()
                left[node], right[node] = a, c
                goes = binned[rows, f] <= b
                where[rows[goes]], where[rows[~goes]] = a, c
                following += [a, c]
            nodes = following
        for node in np.unique(where):
            rows = where == node
            value[node] = rate * float(g[rows].sum() / (h[rows].sum() + ridge))
        logit += np.array(value)[where]
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth, base)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every document, computed once and kept."""

    def run(part: pa.RecordBatch):
        x = statistics(part.column("text"))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), flat], names=["doc_id", "x"])

    return shared.cut(W.mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, x array<double>", most=2 << 20))


def trained(stats: DataFrame, labels: DataFrame, column: str = "quality", train_rows: int = 20_000, **how) -> Trees:
    """Trees for labels.column, learned from the documents of folds 1 to 4."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("double").alias("y")).filter(F.col("y").isNotNull() & (fold_of_id() != 0))
    rows = stats.join(known, "doc_id").withColumn("o", F.xxhash64("doc_id", "x", "y")).orderBy("o", "doc_id", "y").limit(train_rows).select("x", "y").toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    x = rows["x"].combine_chunks()
    x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
    return fit(x.flatten().to_numpy().reshape(rows.num_rows, -1), rows["y"].to_numpy(), **how)


def fold_of_id():
    return shared.fold_of("doc_id")


def scored(docs: DataFrame, labels: DataFrame, cut: float = 0.3, train_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    stats = described(docs)
    trees = trained(stats, labels, train_rows=train_rows)

    def run(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(trees.score(x))], names=["doc_id", "score"])

    out = stats.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", (fold_of_id() == 0).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
