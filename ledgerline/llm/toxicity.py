"""Toxic spans by a linear-chain conditional random field, summed up to documents.

Tags: 0 (clean), 1 (toxic). A word of the fitted list has a weight of its own for tag 1, all
other words share one. Between two listed words lie runs of words with the same weight, so
forward and backward messages cross such a run by one power of the transfer matrix: exact
over whole texts, and as cheap as the few listed words of a text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, fold, in_slices, table, texts

# The model is fitted on at most so many labelled rows of each class, none longer than that.
FIT_ROWS = 2000
FIT_BYTES = 10_000
# A word counts as toxic in toxic texts if it stands there in so many different contexts, at
# least and per toxic text (by chance a word of near copies gathers more of them the more texts
# there are), and its share of contexts there is so many times the share in clean texts.
CONTEXTS, CONTEXTS_PER_TEXT = 4, 0.01
RATIO = 12.0
FOLDS = 5
# Cells (texts times listed words) whose messages move together; a text with more listed words than LONG runs alone.
CELLS, LONG = 1 << 20, 4096

# Everything but letters separates words; letters beyond ASCII are bytes from 0x80 on.
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile("[a-z\x80-\U0010ffff]+")


def words_of(text: str) -> list[bytes]:
    """Lower-case runs of letters."""
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


@dataclass(frozen=True)
class ToxicModel:
    """Word weights for tag 1, the weight of all other words, transitions, calibration."""

    weights: dict[bytes, float]
    other: float
    transitions: tuple[tuple[float, float], tuple[float, float]]
    slope: float
    offset: float


def _forward_backward(emit: np.ndarray, trans: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log Z, tag marginals and expected transitions of padded chains.

    ``emit`` is [chains, length] (weight of tag 1); masked-out cells lie at the end.
    """
    n, length = emit.shape
    psi = np.exp(trans)
    up = np.stack([np.ones_like(emit), np.exp(emit)], axis=2)
    alpha, scale = np.empty((n, length, 2)), np.ones((n, length))
    for i in range(length):
        now = up[:, i] if i == 0 else (alpha[:, i - 1] @ psi) * up[:, i]
        total = now.sum(1)
        now = now / total[:, None]
        if i:
            now = np.where(mask[:, i, None], now, alpha[:, i - 1])
            total = np.where(mask[:, i], total, 1.0)
        alpha[:, i], scale[:, i] = now, total
    beta = np.ones((n, length, 2))
    moves = np.zeros((2, 2))
    for i in range(length - 2, -1, -1):
        ahead = up[:, i + 1] * beta[:, i + 1] / scale[:, i + 1, None]
        live = mask[:, i + 1]
        beta[:, i] = np.where(live[:, None], ahead @ psi.T, beta[:, i + 1])
        moves += np.einsum("na,nb,n->ab", alpha[:, i], ahead, live.astype(float)) * psi
    marginal = alpha * beta
    marginal /= marginal.sum(2, keepdims=True)
    return np.log(scale).sum(1), marginal[:, :, 1] * mask, moves


def fit_chains(chains: np.ndarray, tags: np.ndarray, mask: np.ndarray, size: int, steps: int = 150, ridge: float = 0.5):
    """Weights [size] (0: all other words) and transitions of chains of word numbers."""
    theta, trans = np.zeros(size), np.zeros((2, 2))
    theta[0] = -3.0
    seen = np.bincount(chains[mask & (tags == 1)], minlength=size).astype(float)
    pairs = mask[:, 1:] & mask[:, :-1]
    moved = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            moved[a, b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & pairs).sum()
    squares = [np.full(size, 1e-8), np.full((2, 2), 1e-8)]
    for _ in range(steps):  # scaled gradient ascent on the penalised log-likelihood
        _, marginal, moves = _forward_backward(theta[chains], trans, mask)
        gradient = [
            seen - np.bincount(chains.ravel(), weights=marginal.ravel(), minlength=size) - ridge * theta,
            moved - moves - ridge * trans,
        ]
        for value, g, s in zip((theta, trans), gradient, squares):
            s *= 0.9
            s += 0.1 * g * g
            value += 0.15 * g / np.sqrt(s)
    return theta, trans


def fit(sample: list[tuple[str, int]], prior: float | None = None) -> ToxicModel:
    """Model from (text, label) rows; equal texts count once.

    ``prior`` is the share of toxic texts where scores are wanted, if the sample's is another.

    Token labels come from the rows: in a toxic text, a word is toxic if it stands in many
    different contexts of toxic texts and hardly any of clean ones. Copies of a text repeat
    its contexts, so they add nothing. Without rows of both classes every score is 0.5 or,
    with one class, that class's.
    """
    rows = sorted(set(sample))
    spread: tuple[dict, dict] = ({}, {})
    for text, label in rows:
        words = words_of(text)
        for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
            spread[label].setdefault(word, set()).add(hash((before, after)))
    count = [Counter({w: len(s) for w, s in part.items()}) for part in spread]
    total = [sum(c.values()) + 1 for c in count]
    least = max(CONTEXTS, CONTEXTS_PER_TEXT * sum(label for _, label in rows))
    odds = {w: (p + 0.5) / total[1] / ((count[0][w] + 0.5) / total[0]) for w, p in count[1].items() if p >= least}
    toxic = {w for w, ratio in odds.items() if ratio >= RATIO}
    # Listed: the toxic words, and as many of those next in line, as counter-examples.
    near = sorted((w for w in odds if w not in toxic), key=lambda w: (-odds[w], w))[: len(toxic) + 50]
    number = {w: i + 1 for i, w in enumerate(sorted(toxic) + near)}
    chains, tags, mask = [], [], []
    reach = 4
    for text, label in rows:
        ids = [number.get(w, 0) for w in words_of(text)]
        last = -1
        for at, word in enumerate(ids):
            if word and at > last:
                low, high = max(0, at - reach, last + 1), min(len(ids), at + reach + 1)
                chain = ids[low:high]
                pad = [0] * (2 * reach + 1 - len(chain))
                chains.append(chain + pad)
                tags.append([int(label == 1 and 0 < x <= len(toxic)) for x in chain] + pad)
                mask.append([True] * len(chain) + [False] * len(pad))
                last = high - 1
    if chains and toxic:
        theta, trans = fit_chains(np.array(chains), np.array(tags), np.array(mask), len(number) + 1)
    else:
        theta, trans = np.full(len(number) + 1, -6.0), np.zeros((2, 2))
    model = ToxicModel({w: float(theta[i]) for w, i in number.items()}, float(theta[0]), tuple(map(tuple, trans.tolist())), 1.0, 0.0)
    # Calibration: logistic regression of the label on the log-odds the chain gives.
    x = np.array([_logit(p) for p, _ in document_marginals([t for t, _ in rows], model)] if rows else [])
    y = np.array([label for _, label in rows], float)
    slope, offset = 0.0, 0.0 if not len(y) or 0 < y.mean() < 1 else 6.0 * (2 * y.mean() - 1)
    if len(y) and 0 < y.mean() < 1:
        slope = 0.5
        for _ in range(50):
            p = 1 / (1 + np.exp(-(slope * x + offset)))
            v = p * (1 - p) + 1e-6
            h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
            g = np.array([((y - p) * x).sum() - 1e-2 * slope, (y - p).sum() - 1e-2 * offset])
            step = np.linalg.solve(h, g)
            slope, offset = slope + np.clip(step[0], -1, 1), offset + np.clip(step[1], -1, 1)
        if prior and prior < 1:
            offset += np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return ToxicModel(model.weights, model.other, model.transitions, float(slope), float(offset))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def document_marginals(batch: list[str], model: ToxicModel) -> list[tuple[float, list[tuple[int, float]]]]:
    """Per text: the chance that a listed word of it is toxic, and (word position, marginal) of each.

    The forward and backward messages of texts of like length move together, one listed word a
    step; a very long text runs alone.
    """
    known = {w: i for i, w in enumerate(model.weights)}
    weight = np.array([*model.weights.values(), 0.0])
    places, lengths = [], []
    for text in batch:
        words = words_of(text)
        ids = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        places.append((at, ids[at]))
        lengths.append(len(words))
    result: list = [(0.0, [])] * len(batch)
    live = sorted((i for i in range(len(batch)) if len(places[i][0])), key=lambda i: -len(places[i][0]))
    while live:
        # Texts of like length together: memory follows CELLS, not the longest text times all others.
        most = len(places[live[0]][0])
        size = 1 if most > LONG else max(1, CELLS // most)
        group, live = live[:size], live[size:]
        work = _one_chain if most > LONG else _many_chains
        for i, marginal in zip(group, work([places[i][0] for i in group], [weight[places[i][1]] for i in group], [lengths[i] for i in group], model)):
            chance = 1 - float(np.exp(np.log1p(-np.minimum(marginal, 1 - 1e-12)).sum()))
            result[i] = (chance, list(zip(places[i][0].tolist(), marginal.tolist())))
    return result


def _crossing(model: ToxicModel) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Transitions; eigenvectors of a step into an unlisted word, their inverse, and the fall of the smaller value."""
    psi = np.exp(np.array(model.transitions))
    run = psi * np.array([1.0, np.exp(model.other)])
    values, vectors = np.linalg.eig(run)
    order = np.argsort(-values.real)
    values, vectors = values.real[order], vectors.real[:, order]
    return psi, vectors, np.linalg.inv(vectors), float(values[1] / values[0])


def _one_chain(at: list[np.ndarray], emit: list[np.ndarray], words: list[int], model: ToxicModel) -> list[np.ndarray]:
    """Marginals of a single long text, word by word in plain numbers: memory in proportion to its listed words."""
    psi, vectors, inverse, fall = _crossing(model)
    (p00, p01), (p10, p11) = psi.tolist()
    (v00, v01), (v10, v11) = vectors.tolist()
    (i00, i01), (i10, i11) = inverse.tolist()

    def forward(a: float, b: float, steps: int) -> tuple[float, float]:
        x, y = a * v00 + b * v10, (a * v01 + b * v11) * fall ** steps
        a, b = max(x * i00 + y * i10, 0.0), max(x * i01 + y * i11, 0.0)
        return a / (a + b), b / (a + b)

    def backward(a: float, b: float, steps: int) -> tuple[float, float]:
        x, y = a * i00 + b * i01, (a * i10 + b * i11) * fall ** steps
        a, b = max(x * v00 + y * v01, 0.0), max(x * v10 + y * v11, 0.0)
        return a / (a + b), b / (a + b)

    places, ups = at[0].tolist(), np.exp(emit[0]).tolist()
    alpha, before = np.zeros((len(places), 2)), -1
    first = (1.0 / (1.0 + math.exp(model.other)), math.exp(model.other) / (1.0 + math.exp(model.other)))
    a, b = first
    for k, (place, up) in enumerate(zip(places, ups)):
        if k == 0 and place == 0:
            a, b = 1.0, up
        else:
            a, b = forward(a, b, place - before - 1 if k else place - 1)
            a, b = a * p00 + b * p10, (a * p01 + b * p11) * up
        a, b = a / (a + b), b / (a + b)
        alpha[k] = a, b
        before = place
    beta, after = np.zeros((len(places), 2)), words[0]
    a, b = 1.0, 1.0
    for k in range(len(places) - 1, -1, -1):
        a, b = backward(a, b, after - places[k] - 1)
        beta[k] = a, b
        after = places[k]
        b *= ups[k]
        a, b = a * p00 + b * p01, a * p10 + b * p11
    both = alpha * beta
    return [both[:, 1] / both.sum(1)]


def _many_chains(at_: list[np.ndarray], emit_: list[np.ndarray], words_: list[int], model: ToxicModel) -> list[np.ndarray]:
    """Marginals of several texts, ordered by falling number of listed words; their messages move together."""
    most, n = len(at_[0]), len(at_)
    at, emit = np.zeros((n, most), np.int64), np.zeros((n, most))
    filled = np.array([len(x) for x in at_])
    for row in range(n):
        at[row, :filled[row]], emit[row, :filled[row]] = at_[row], emit_[row]
    psi, vectors, inverse, fall = _crossing(model)

    def cross(message: np.ndarray, steps: np.ndarray, side: str) -> np.ndarray:
        """A message over ``steps`` unlisted words, scaled to sum 1."""
        keep = np.stack([np.ones(len(steps)), np.power(fall, steps.astype(float))], axis=1)
        out = ((message @ vectors) * keep) @ inverse if side == "forward" else ((message @ inverse.T) * keep) @ vectors.T
        out = np.maximum(out, 0)
        return out / out.sum(1, keepdims=True)

    first = np.array([1.0, np.exp(model.other)])
    alpha = np.zeros((n, most, 2))
    for k in range(most):
        m = int((filled > k).sum())  # texts are ordered by how many listed words they have
        up = np.stack([np.ones(m), np.exp(emit[:m, k])], axis=1)
        if k == 0:
            gap = at[:m, 0]
            into = cross(np.tile(first / first.sum(), (m, 1)), np.maximum(gap - 1, 0), "forward") @ psi
            into[gap == 0] = 1.0
        else:
            into = cross(alpha[:m, k - 1], at[:m, k] - at[:m, k - 1] - 1, "forward") @ psi
        now = into * up
        alpha[:m, k] = now / now.sum(1, keepdims=True)
    words = np.array(words_)
    beta = np.ones((n, 2))
    marginal = np.zeros((n, most))
    for k in range(most - 1, -1, -1):
        m = int((filled > k).sum())
        ends = filled[:m] == k + 1
        after = np.where(ends, words[:m], at[:m, min(k + 1, most - 1)]) - at[:m, k] - 1
        into = np.ones((m, 2))
        later = np.flatnonzero(~ends)
        if len(later):
            up = np.stack([np.ones(len(later)), np.exp(emit[later, k + 1])], axis=1)
            into[later] = (up * beta[later]) @ psi.T
        beta[:m] = cross(into, after, "backward")
        both = alpha[:m, k] * beta[:m]
        marginal[:m, k] = both[:, 1] / both.sum(1)
    return [marginal[row, :filled[row]] for row in range(n)]


def calibrated(chance: float, model: ToxicModel) -> float:
    return float(1 / (1 + np.exp(-(model.slope * _logit(chance) + model.offset))))


def training_labels(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """doc_id, y of the labelled documents outside the held-out fold; of several labels the highest."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        "doc_id is not null and y in (0, 1)"
    ).groupBy("doc_id").agg(F.max("y").alias("y")).filter(fold("doc_id", folds) != held)


def training_sample(documents: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int = FIT_ROWS) -> list[tuple[str, int]]:
    """At most ``rows`` labelled texts of each class outside the held-out fold.

    Which rows, is decided by a hash of the id alone. Two bounded sets of ids meet the texts
    (a broadcast of at most 2 * ``rows`` ids); texts over FIT_BYTES are left out of the fit.
    """
    marked = training_labels(labels, label, folds, held)
    mixed = F.xxhash64("doc_id", F.lit(7))
    chosen = marked.filter("y = 1").orderBy(mixed, "doc_id").limit(rows).unionByName(
        marked.filter("y = 0").orderBy(mixed, "doc_id").limit(rows)
    )
    found = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .filter(F.col("text").isNotNull() & (F.octet_length("text") <= FIT_BYTES))
        .join(F.broadcast(chosen), "doc_id").select("text", "y").dropDuplicates(["text"]).limit(2 * rows)
    )
    return [(r["text"], r["y"]) for r in found.collect()]


def toxic_model(documents: DataFrame, labels: DataFrame) -> ToxicModel:
    """Model from the labelled rows outside the held-out fold."""
    prior = training_labels(labels, "toxic", FOLDS, 0).agg(F.avg("y")).first()[0]
    return fit(training_sample(documents, labels, "toxic", FOLDS, 0), prior)


def toxicity(documents: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, spans of every row: spans are (start, end, marginal) of toxic words.

    start and end count characters. NULL text is empty text; a text without listed words
    gets the score of a text in which nothing is toxic. Texts are scored whole, however long, with
    memory in proportion to the text. Repeated rows are scored each; a missing doc_id stays NULL.
    Only doc_id and text are read. An empty table gives no rows.
    """
    schema = "doc_id long, score double, spans array<struct<start: int, end: int, marginal: double>>"
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = texts(batch)
            scores, spans = [], []
            for text, (chance, marks) in zip(found, document_marginals(found, model)):
                scores.append(calibrated(chance, model))
                hot = {at: p for at, p in marks if p >= threshold}
                spans.append(_offsets(text, hot) if hot else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, span)], names=["doc_id", "score", "spans"]
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _offsets(text: str, hot: dict[int, float]) -> list[dict]:
    """Character spans of the words at the given positions."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a few letters grow in lower case; then find words letter by letter
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return [
        {"start": m.start(), "end": m.end(), "marginal": hot[i]}
        for i, m in enumerate(_WORD.finditer(lowered)) if i in hot
    ]


def reject_toxic(documents: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The rows scored below ``threshold``, with all their columns, whatever their names.

    NULL text is scored as empty text; rows without doc_id and repeated rows are judged each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            marks = document_marginals(texts(batch), model)
            yield batch.filter(pa.array([calibrated(chance, model) < threshold for chance, _ in marks], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; labels only from outside the held-out fold."""
    documents = table(spark, folder, "documents")
    scored = toxicity(documents, toxic_model(documents, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("spans").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("offsets"),
    )
