"""Language identification by a linear-chain conditional random field over words.

Every word has hashed features (the word itself as a lexicon entry, its affixes of one to four bytes, its byte n-grams
of two and three, its length); transitions between the labels of neighbouring words are learned too. Forward-backward
gives each word of a text, code-switched or not, a distribution over the languages; a text's language is the one with
the largest sum over its words, and its score the mean of that sum. Words without a letter have no features of their
own and follow their neighbours.

The model is fitted in the driver on at most `train_docs` labelled documents of at most `train_bytes` bytes, their whole
texts; these bounds are parameters and the only sample taken. Languages are sampled in turn (the documents with the
least hash of each), so that a rare one is learned too, as long as there are no more languages than `train_docs` and it
has a document within `train_bytes`. Fitting is stochastic gradient ascent on the conditional
likelihood of the label sequences, where a training sequence joins texts of different languages, so that switches are
seen and their cost is learned.

Chains of a slice are run at once: each text starts afresh, which makes the slice one chain whose blocks are joined by
products of transition matrices.

Defined cases: a null text, or one without a letter, is `und` with score 0; with no labelled rows every text is; rows
with null lang or null doc_id teach nothing; a null doc_id counts as the empty text for the fold; ties go to the
language that sorts first; repeated rows are judged each, and learned from once; an empty table gives no rows; very
long texts are read whole, a slice each; other columns are ignored, or kept where documents are filtered, whatever their
names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.llm import shared
from sitesieve.llm import words as W

BITS = 16
#: Bytes that are letters or part of one: A-Z, a-z and all of a multi-byte character.
LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
_LONGEST = 4


def has_letter(text):
    """A DataFrame condition: the text has a letter of any script."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).rlike(r"\p{L}")


class Features(NamedTuple):
    """Feature numbers of words, word by word: `of` is the word of each, sorted."""

    number: np.ndarray
    of: np.ndarray
    n: int


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> Features:
    mask = np.uint64((1 << BITS) - 1)
    bucket = lambda x, kind: ((W.mix(x + np.uint64(kind * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(40)) & mask).astype(np.int32)
    size = end - start
    wide = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.arange(len(start))
    numbers, owners = [bucket(h, 1), bucket(np.minimum(size, 20).astype(np.uint64), 2)], [words, words]
    for n in range(1, _LONGEST + 1):
        long = np.flatnonzero(size >= n)
        for kind, at in ((10 + n, start[long]), (20 + n, end[long] - n)):
            value = np.zeros(len(long), np.uint64)
            for j in range(n):
                value = value * np.uint64(257) + wide[at + j] + np.uint64(1)
            numbers.append(bucket(value, kind)), owners.append(long)
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        of = np.repeat(words, count)
        at = start[of] + np.arange(len(of)) - (np.cumsum(count) - count)[of]
        value = np.zeros(len(of), np.uint64)
        for j in range(n):
            value = value * np.uint64(257) + wide[at + j] + np.uint64(1)
        numbers.append(bucket(value, 30 + n)), owners.append(of)
    number, of = np.concatenate(numbers), np.concatenate(owners)
    by = np.argsort(of, kind="stable")
    return Features(number[by], of[by], len(start))


def emissions(f: Features, weights: np.ndarray, lettered: np.ndarray) -> np.ndarray:
    """Mean weight of each word's features times the root of their count; zero for words without a letter."""
    k = weights.shape[1]
    count = np.bincount(f.of, minlength=f.n)
    out = np.empty((f.n, k))
    for j in range(k):
        out[:, j] = np.bincount(f.of, weights=weights[:, j][f.number], minlength=f.n)
    out /= np.sqrt(np.maximum(count, 1))[:, None]
    out[~lettered] = 0
    return out


def posteriors(e: np.ndarray, fresh: np.ndarray, transition: np.ndarray, block: int = 64, with_joint: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over one long chain that starts anew at each `fresh` word: the distribution of each word, and
    the expected number of each transition.

    The chain is cut into blocks of equal length, all run together step by step; the blocks' matrix products give the
    vectors that enter each block."""
    n, k = e.shape
    if not n:
        return np.zeros((0, k)), np.zeros((k, k))
    size = -(-n // block)
    pad = size * block - n
    emit = np.maximum(np.exp(e - e.max(1, keepdims=True)), 1e-13)
    emit = np.ascontiguousarray(np.concatenate([emit, np.ones((pad, k))]).reshape(size, block, k).transpose(1, 0, 2))
    start = np.concatenate([fresh, np.ones(pad, bool)]).reshape(size, block)
    starts = [np.flatnonzero(start[:, j]) for j in range(block)]
    step = np.maximum(np.exp(transition - transition.max()), 1e-13)
    product = np.tile(np.eye(k), (size, 1, 1))
    for j in range(block):
        before = product[starts[j]].sum(-1, keepdims=True) / k  # a start forgets what came before
        product = (product.reshape(-1, k) @ step).reshape(size, k, k)
        product[starts[j]] = before
        product *= emit[j][:, None, :]
        if j % 8 == 7 or j == block - 1:
            product /= product.sum((1, 2), keepdims=True)
    enter, v = np.empty((size, k)), np.full(k, 1.0 / k)
    for i in range(size):
        enter[i] = v
        v = v @ product[i]
        v = v / v.sum()
    ahead = np.empty((block, size, k))
    v = enter
    for j in range(block):
        v = v @ step
        v[starts[j]] = 1.0 / k
        v *= emit[j]
        v /= v.sum(-1, keepdims=True)
        ahead[j] = v
    # backward: what a place's label says of all later words
    leave, v = np.empty((size, k)), np.ones(k)
    for i in range(size - 1, -1, -1):
        leave[i] = v
        v = product[i] @ v
        v = v / v.sum()
    behind = np.empty((block, size, k))
    v = leave
    back = np.ascontiguousarray(step.T)
    for j in range(block - 1, -1, -1):
        behind[j] = v
        v = (v * emit[j]) @ back
        v[starts[j]] = 1.0
        v /= v.sum(-1, keepdims=True)
    flat = lambda x: x.transpose(1, 0, 2).reshape(-1, k)[:n]
    both = flat(ahead * behind)
    both = both / both.sum(1, keepdims=True)
    if not with_joint:
        return both, np.zeros((k, k))
    a, b, m = flat(ahead)[: n - 1], flat(behind)[1:n], flat(emit)[1:n]
    on = np.flatnonzero(~fresh[1:n])
    joint = a[on, :, None] * step[None] * (b[on] * m[on])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return both, joint.sum(0)


class Model(NamedTuple):
    langs: list[str]
    weights: np.ndarray
    transition: np.ndarray


def _words(texts: pa.Array) -> tuple[W.Words, np.ndarray, np.ndarray]:
    w = W.split(texts)
    letters = np.concatenate([[0], np.cumsum(LETTERS[w.buf])])
    return w, W.hashes(w), letters[w.end] > letters[w.start]


def fit(texts: list[str], langs: list[str], piece: int = 40, rounds: int = 4, rate: float = 0.5, ridge: float = 1e-5, seed: int = 7) -> Model:
    """A model from labelled texts: their pieces of `piece` words, shuffled, make one chain of switching languages."""
    names = sorted(set(langs))
    k = len(names)
    weights, transition = np.zeros((1 << BITS, k)), np.zeros((k, k))
    if k < 2:
        return Model(names, weights, transition)
    w, h, lettered = _words(pa.array(texts, pa.string()))
    label = np.array([names.index(x) for x in langs])[w.row]
    place = np.arange(len(w.start)) - w.first[w.row]
    _, piece_of = np.unique(w.row * (1 << 32) + place // piece, return_inverse=True)
    rng = np.random.default_rng(seed)
    n_pieces = int(piece_of.max(initial=-1)) + 1
    starts = np.searchsorted(piece_of, np.arange(n_pieces + 1))
    f = features(w.buf, w.start, w.end, h)
    first = np.searchsorted(f.of, np.arange(len(w.start) + 1))
    squares = np.full_like(weights, 1e-3)
    t_squares = np.full_like(transition, 1e-3)
    for _ in range(rounds):
        order = rng.permutation(n_pieces)
        for batch in np.array_split(order, max(1, n_pieces // 64)):
            at = np.concatenate([np.arange(starts[p], starts[p + 1]) for p in batch])
            counts = first[at + 1] - first[at]
            of = np.repeat(np.arange(len(at)), counts)
            number = f.number[first[at][of] + np.arange(len(of)) - (np.cumsum(counts) - counts)[of]]
            part = Features(number, of, len(at))
            e = emissions(part, weights, lettered[at])
            fresh = np.zeros(len(at), bool)
            sizes = (starts[1:] - starts[:-1])[batch]
            fresh[(np.cumsum(sizes) - sizes)[::4]] = True  # four pieces a sequence: switches occur within it
            p, joint = posteriors(e, fresh, transition, 32, True)
            y = label[at]
            grad = -p
            grad[np.arange(len(at)), y] += 1
            grad[~lettered[at]] = 0
            grad /= np.sqrt(np.maximum(counts, 1))[:, None]
            on = np.flatnonzero(~fresh[1:])
            seen = np.zeros((k, k))
            np.add.at(seen, (y[on], y[on + 1]), 1)
            touched, inverse = np.unique(number, return_inverse=True)
            total = np.stack([np.bincount(inverse, weights=grad[of, j], minlength=len(touched)) for j in range(k)], axis=1)
            total -= ridge * len(at) * weights[touched]
            squares[touched] += total**2
            weights[touched] += rate * total / np.sqrt(squares[touched])
            change = seen - joint
            t_squares += change**2
            transition += rate * change / np.sqrt(t_squares)
    return Model(names, weights.astype(np.float32), transition)


class Tagger:
    """A model at work: emissions of the words seen are kept (emptied when they are `most`)."""

    def __init__(self, model: Model, most: int = 2_000_000) -> None:
        self.model, self.most = model, most
        self.clear()

    def clear(self) -> None:
        self.known, self.kept = np.zeros(0, np.uint64), np.zeros((0, len(self.model.langs)), np.float32)

    def emissions(self, w: W.Words, h: np.ndarray, lettered: np.ndarray) -> np.ndarray:
        kinds, first = np.unique(h, return_index=True)
        if len(self.known) > self.most:
            self.clear()
        place = np.minimum(np.searchsorted(self.known, kinds), max(0, len(self.known) - 1))
        new = first if not len(self.known) else first[self.known[place] != kinds]
        if len(new):
            f = features(w.buf, w.start[new], w.end[new], h[new])
            e = emissions(f, self.model.weights, lettered[new]).astype(np.float32)
            known = np.concatenate([self.known, h[new]])
            by = np.argsort(known)
            self.known, self.kept = known[by], np.concatenate([self.kept, e])[by]
        return self.kept[np.searchsorted(self.known, h)].astype(np.float64)

    def tagged(self, texts: pa.Array) -> tuple[W.Words, np.ndarray]:
        """Words of the texts and the distribution over the model's languages of each."""
        w, h, lettered = _words(texts)
        fresh = np.ones(len(w.row), bool)
        fresh[1:] = w.row[1:] != w.row[:-1]
        return w, posteriors(self.emissions(w, h, lettered), fresh, self.model.transition)[0]

    def judged(self, texts: pa.Array, letter: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Language and score of each text; letter: whether it has one."""
        n, k = len(texts), len(self.model.langs)
        judged = letter.to_numpy(zero_copy_only=False).astype(bool)
        total = np.zeros((n, max(1, k)))
        if k == 1:
            total[:, 0] = 1
        elif k:
            w, p = self.tagged(texts)
            for j in range(k):
                total[:, j] = np.bincount(w.row, weights=p[:, j], minlength=n)
        else:
            judged[:] = False
        best = total.argmax(1)
        share = total[np.arange(n), best] / np.maximum(total.sum(1), 1e-12)
        pred = [self.model.langs[b] if j else "und" for b, j in zip(best.tolist(), judged.tolist(), strict=True)]
        return pa.array(pred, pa.string()), pa.array(np.where(judged, np.minimum(share, 1.0), 0.0))


def trained(docs: DataFrame, train_docs: int = 400, train_bytes: int = 64 << 10) -> Model:
    """A model from folds 1 to 4 of the documents with a lang and a letter."""
    usable = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (shared.fold_of("doc_id") != 0) & (F.octet_length("text") <= train_bytes) & has_letter("text")
    )
    usable = usable.withColumn("o", F.xxhash64("doc_id", "text", F.lit(11)))
    key = ["lang", "o", "doc_id"]
    # the commonest train_docs languages, and of each some three times the hashes that are needed: few rows meet for a rank
    common = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(train_docs)
    few = F.shiftrightunsigned("o", 11) / 2.0**53 * F.col("n") < 3 * train_docs
    turns = Window.partitionBy("lang").orderBy("o", "doc_id")
    each = usable.select(*key).join(F.broadcast(common), "lang").filter(few).select(*key).withColumn("turn", F.dense_rank().over(turns)).filter(F.col("turn") <= train_docs)
    least = each.distinct().orderBy("turn", "o", "lang", "doc_id").limit(train_docs).select(*key)
    rows = usable.join(F.broadcast(least), key).groupBy(*key).agg(F.min("text").alias("text")).collect()  # train_docs rows of train_bytes at most
    rows.sort(key=lambda r: (r.doc_id, r.lang, r.text))
    return fit([r.text for r in rows], [r.lang for r in rows])


def _run(docs: DataFrame, model: Model, f, schema) -> DataFrame:
    """f over slices of docs (text, letter and others), with the languages and scores of their texts; a tagger serves a
    whole partition."""

    def run(batches):
        tagger = Tagger(model)
        for batch in batches:
            for part in W.slices(batch, most=1 << 19):
                yield f(part, *tagger.judged(part.column("text"), part.column("letter")))

    return docs.mapInArrow(W.released(run), schema)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", has_letter("text").alias("letter"))
    told = lambda part, pred, score: pa.RecordBatch.from_arrays([part.column("doc_id"), pred, score], names=["doc_id", "lang_pred", "score"])
    out = _run(given, model, told, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", (shared.fold_of("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a score of `least` or more, with all their columns. A model without
    languages rejects none: documents with a letter stay."""
    names = docs.columns
    given = docs.select("text", has_letter("text").alias("letter"), *shared.rest_of(docs, "text"))

    def kept(part, pred, score):
        keep = W.pc.and_(W.pc.not_equal(pred, "und"), W.pc.greater_equal(score, least)) if model.langs else part.column("letter")
        part = part.filter(keep)
        own = {"text": part.column("text")}
        if "rest" in part.schema.names:
            own |= {f.name: part.column("rest").field(i) for i, f in enumerate(part.column("rest").type)}
        return pa.RecordBatch.from_arrays([own[c] for c in names], names=names)

    return _run(given, model, kept, docs.schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    return identified(docs, trained(docs))
