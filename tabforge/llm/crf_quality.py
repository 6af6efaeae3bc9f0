"""Quality classifier: a linear-chain conditional random field over lines.

Each line gets a label, good or bad, from features of itself and of the lines
before and after it, and from the label of its neighbours. Training lines carry
the label of their document. A document's quality is the mean of its lines'
forward-backward marginals weighted by line length, put through a logistic curve
fitted on the training documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_hashed, packed
from .piece_bpe import spans

#: Labelled documents (of least hash) that the field is fitted on, and the most
#: lines that such a document may have.
TRAIN_DOCS = 4000
TRAIN_LINES = 400
STEPS = 100
SLICE_CHARS = 2_000_000

_LOWER, _UPPER, _DIGIT, _SPACE, _POINT, _COMMA, _SHOUT, _PIPE, _SIGN, _OTHER = range(10)
N_FEATURES = 20


def _class_table() -> np.ndarray:
    out = np.full(0x10000, _OTHER, np.int64)
    for i in range(0x10000):
        c = chr(i)
        if c.islower():
            out[i] = _LOWER
        elif c.isupper():
            out[i] = _UPPER
        elif c.isdigit():
            out[i] = _DIGIT
        elif c.isspace():
            out[i] = _SPACE
        elif c.isalpha():
            out[i] = _LOWER
    for kind, chars in ((_POINT, ".?"), (_COMMA, ",;:'\"()-"), (_SHOUT, "!"), (_PIPE, "|"), (_SIGN, "#$%&*+/<=>@[\\]^_`{}~")):
        for c in chars:
            out[ord(c)] = kind
    return out


_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _CLASSES:
        _CLASSES.append(_class_table())
    return _CLASSES[0]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, characters of each line, lines of each text)."""
    split = [t.split("\n") for t in texts]
    n_lines = np.array([len(s) for s in split], np.int64)
    lines = [x for s in split for x in s]
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    n = len(lines)
    point = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[np.minimum(point, 0xFFFF)]
    line = np.repeat(np.arange(n), size)
    count = np.bincount(line * 10 + kind, minlength=10 * n).reshape(n, 10).astype(np.float64)
    first = np.zeros(len(point), bool)
    starts = np.cumsum(size) - size
    first[starts[size > 0]] = True
    space = kind == _SPACE
    begins = ~space & (first | np.concatenate([[True], space[:-1]])) if len(point) else space
    words = np.bincount(line[begins], minlength=n).astype(np.float64)
    capital = np.bincount(line[begins & (kind == _UPPER)], minlength=n)
    marked = ~space & (np.concatenate([space[1:], [True]]) | np.concatenate([first[1:], [True]])) if len(point) else space
    signed = np.bincount(line[marked & (kind >= _SHOUT) & (kind <= _SIGN)], minlength=n)
    distinct = np.fromiter((len(set(x.split())) for x in lines), np.float64, n)
    seen = np.zeros(n)
    at = 0
    for s in split:
        if len(s) > 1:
            known: set[str] = set()
            for x in s:
                seen[at] = x in known
                known.add(x)
                at += 1
        else:
            at += 1
    chars, safe = size.astype(np.float64), np.maximum(words, 1)
    share = count / np.maximum(chars, 1)[:, None]
    last = np.full(n, -1)
    last[size > 0] = kind[(starts + size - 1)[size > 0]]
    x = np.column_stack([
        share, np.log1p(chars), np.log1p(words), (chars - count[:, _SPACE]) / safe, capital / safe, signed / safe,
        distinct / safe, (words > 20) * (1 - distinct / safe), seen, last == _POINT, last == _SHOUT])
    return x, chars, n_lines


def with_neighbours(x: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Features of the line, of the line before and after (0 beyond the ends), both ends, and 1."""
    head = np.zeros(len(x), bool)
    ends = np.cumsum(n_lines)
    head[(ends - n_lines)[n_lines > 0]] = True
    tail = np.concatenate([head[1:], [True]])[:len(x)]
    before = np.vstack([np.zeros((1, x.shape[1])), x[:-1]]) * ~head[:, None]
    after = np.vstack([x[1:], np.zeros((1, x.shape[1]))]) * ~tail[:, None]
    return np.column_stack([x, before, after, head, tail, np.ones(len(x))])


def _columns(n_lines: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Documents by falling length, and for each step the row numbers of its lines in them."""
    order = np.argsort(-n_lines, kind="stable")
    start = (np.cumsum(n_lines) - n_lines)[order]
    size = n_lines[order]
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
    return order, [start[:k] + t for t, k in enumerate(live)]


def marginals(unary: np.ndarray, trans: np.ndarray, n_lines: np.ndarray):
    """(P(good) of each line, expected transitions 2 x 2, log partition in all).

    ``unary`` is the score of good over bad; ``trans[i, j]`` that of i followed by j.
    All documents advance one line at a time together, in log space.
    """
    _, steps = _columns(n_lines)
    score = np.column_stack([np.zeros(len(unary)), unary])
    ahead, behind = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    for t, rows in enumerate(steps):
        if t == 0:
            ahead[rows] = score[rows]
        else:
            prev = ahead[steps[t - 1][:len(rows)]]
            ahead[rows] = score[rows] + np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1])
    pairs = np.zeros((2, 2))
    total = np.zeros(len(unary))
    for t in range(len(steps) - 1, -1, -1):
        rows = steps[t]
        k = len(steps[t + 1]) if t + 1 < len(steps) else 0
        if k:
            nxt = steps[t + 1]
            out = score[nxt] + behind[nxt]
            behind[rows[:k]] = np.logaddexp(out[:, :1] + trans[:, 0], out[:, 1:] + trans[:, 1])
        total[rows] = np.logaddexp(ahead[rows, 0] + behind[rows, 0], ahead[rows, 1] + behind[rows, 1])
        if k:
            joint = ahead[rows[:k], :, None] + trans + out[:, None, :] - total[rows[:k], None, None]
            pairs += np.exp(joint).sum(0)
    good = np.exp(ahead[:, 1] + behind[:, 1] - total)
    firsts = steps[0] if steps else np.zeros(0, np.int64)
    return good, pairs, total[firsts].sum()


def document_means(good: np.ndarray, chars: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Mean marginal of each document, weighted by characters (an empty line weighs 1)."""
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    weight = np.maximum(chars, 1)
    return np.bincount(doc, weight * good, len(n_lines)) / np.maximum(np.bincount(doc, weight, len(n_lines)), 1)


@dataclass
class LineField:
    """A fitted field: scaling, weights, transitions and the final logistic curve."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    trans: np.ndarray
    slope: float
    shift: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x, chars, n_lines = line_features(texts)
        unary = with_neighbours((x - self.mean) / self.scale, n_lines) @ self.weight
        good, _, _ = marginals(unary, self.trans, n_lines)
        return _squash(self.slope * _logit(document_means(good, chars, n_lines)) + self.shift)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_field(x: np.ndarray, chars: np.ndarray, n_lines: np.ndarray, label: np.ndarray, steps: int = STEPS,
              ridge: float = 1e-3) -> LineField:
    """Fit on lines of labelled documents by Adam on the penalised log likelihood.

    Both labels weigh the same in all, and each document the same within its label.
    """
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = with_neighbours((x - mean) / scale, n_lines)
    y = np.repeat(label.astype(np.float64), n_lines)
    w, trans = np.zeros(z.shape[1]), np.zeros((2, 2))
    # as many lines of one label as of the other: copies of the rarer label's documents weigh more
    per_doc = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    per_line = np.repeat(per_doc / np.maximum(n_lines, 1), n_lines)
    m1, m2 = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    groups = [np.flatnonzero(label == k) for k in (0, 1)]
    ends = np.cumsum(n_lines)
    rows_of = [spans((ends - n_lines)[g], n_lines[g]) for g in groups]
    for k in range(1, steps + 1):
        grad_w, grad_t = ridge * w, ridge * trans.copy()
        for value, g, rows in zip((0, 1), groups, rows_of, strict=True):
            if not len(g):
                continue
            good, pairs, _ = marginals(z[rows] @ w, trans, n_lines[g])
            grad_w = grad_w + z[rows].T @ (per_line[rows] * (good - y[rows]))
            lines = max(1, int(n_lines[g].sum()))
            seen = np.zeros((2, 2))
            seen[value, value] = (n_lines[g] - 1).sum()
            grad_t = grad_t + 0.5 * (pairs - seen) / lines
        grad = np.concatenate([grad_w, grad_t.ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        move = 0.1 * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-8)
        w, trans = w - move[:-4], np.clip(trans - move[-4:].reshape(2, 2), -2.0, 2.0)
    good, _, _ = marginals(z @ w, trans, n_lines)
    v = _logit(document_means(good, chars, n_lines))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method in two unknowns
        p = _squash(slope * v + shift)
        r, h = p - label, p * (1 - p) + 1e-9
        g = np.array([(r * v).sum() + 1e-3 * (slope - 1), r.sum()])
        hess = np.array([[(h * v * v).sum() + 1e-3, (h * v).sum()], [(h * v).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, g), -1, 1)
        slope, shift = slope - step[0], shift - step[1]
    return LineField(mean, scale, w, trans, float(slope), float(shift))


def fold_of(doc_id) -> object:
    """crc32(doc_id as text) mod 3; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> LineField | None:
    """Fit on at most ``train_docs`` labelled documents of at most ``train_lines`` lines, fold 1 left out.

    ``labels``: doc_id, quality (0 or 1; null rows are left out; several labels of
    a document go by their mean). The features are made on the executors; only
    they reach the driver. None when no document of either label is left.
    """
    known = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id"))
             .agg((F.avg("quality") >= 0.5).cast("int").alias("label")).where(fold_of(F.col("label_id")) != 1))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, F.col("doc_id") == F.col("label_id"))
            .withColumn("lines", F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
            .where(F.col("lines") <= train_lines).select("doc_id", "label", "text"))
    rows = least_hashed(rows, train_docs, "doc_id")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x, chars, n = line_features(part.column("text").to_pylist())
                ends = np.cumsum(n)
                cut = [(x[e - k:e].astype(np.float32).tobytes(), chars[e - k:e].tobytes()) for e, k in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([c[0] for c in cut], pa.binary()),
                                                  pa.array([c[1] for c in cut], pa.binary())], ["label", "x", "chars"])

    got = rows.mapInArrow(features, "label int, x binary, chars binary").collect()
    label = np.array([r.label for r in got], np.int64)
    if not len(label) or label.min() == label.max():
        return None
    x = [np.frombuffer(bytes(r.x), np.float32).reshape(-1, N_FEATURES) for r in got]
    chars = np.concatenate([np.frombuffer(bytes(r.chars)) for r in got])
    return fit_field(np.concatenate(x).astype(np.float64), chars, np.array([len(a) for a in x]), label)


def score(docs: DataFrame, field: LineField | None) -> DataFrame:
    """row (a struct of all columns of ``docs``) and score, for every row of ``docs`` (text, any others).

    Scores lie in 0 to 1, higher for label 1; they depend on the text alone. A
    null text is empty, and an empty text is one empty line. Without a field
    every score is 0.5. Repeated rows score alike; an empty table gives no rows.
    """
    wide = docs.select(packed(docs), F.coalesce("text", F.lit("")).alias("text"))
    shape = f"row {wide.schema['row'].dataType.simpleString()}, score double"
    if field is None:
        return wide.select("row", F.lit(0.5).alias("score"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(field.scores(part.column("text").to_pylist()))], ["row", "score"])

    return wide.mapInArrow(run, shape)
