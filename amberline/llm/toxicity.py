"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents, so tokens get theirs first: in documents labelled toxic, tokens with a
feature (the word, or its beginning) whose presence tells such documents from others. Of copies in
the sample one counts. The chain learns from these tokens in their surroundings. Forward-backward gives each token
of a text its probability to be toxic; a logistic curve, fitted on documents that the chain has not
seen, turns the largest and the sum of them into the document's score.

All that is learned comes from a bounded sample of labelled rows: ``PER_CLASS`` of each label, of at most
``LONGEST`` characters each. Words are numbers there, so the sample takes little more than its texts.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amberline.llm.common import texts
from amberline.llm.words import mix, shingle_sets

PER_CLASS = 2500
#: Longer texts are no examples (they are scored whole), which bounds the sample in bytes.
LONGEST = 100_000
THRESHOLD = 0.3
SPAN = 0.5
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(3, 9)
#: Least log-likelihood ratio of a telling feature; chance gives less than one such in a million.
TELLING = 14.0
CHUNK, CHUNKS, STEPS = 64, 6000, 120
CACHE = 400_000
TINY = 1e-9


def features(word: str) -> list[str]:
    """The word in small letters and its beginnings; longer words have more of them."""
    low = word.lower()
    return [low, *(low[:k] + "*" for k in BEGINNINGS if k < len(low))]


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    transition: np.ndarray  # log weights from clean or toxic to clean or toxic
    curve: np.ndarray  # constant, log odds of the largest marginal, log of 1 + sum of marginals

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))


def packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all tokens when texts, longest first, stand side by side, and how many texts are that long."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(1, longest + 1), "right")
    begin = np.concatenate([[0], np.cumsum(active)])
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return begin[within] + np.repeat(rank, lengths), begin


def marginals(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Exact probability of the toxic state for each token of texts that stand behind each other.

    Works on the ratio toxic : clean of forward and of backward weights, for all texts at once.
    """
    place, begin = packed(lengths)
    e = np.empty(len(emission))
    e[place] = np.exp(np.clip(emission, -40, 40))
    t = np.exp(transition)
    forward, backward = np.empty(len(e)), np.ones(len(e))
    steps = len(begin) - 1
    for i in range(steps):
        a, b = begin[i], begin[i + 1]
        if i:
            r = forward[begin[i - 1] : begin[i - 1] + b - a]
            forward[a:b] = e[a:b] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
        else:
            forward[a:b] = e[a:b]
    for i in range(steps - 2, -1, -1):
        a, b, c = begin[i], begin[i + 1], begin[i + 2]
        s = e[b:c] * backward[b:c]
        backward[a : a + c - b] = (t[1, 0] + t[1, 1] * s) / (t[0, 0] + t[0, 1] * s)
    odds = forward * backward
    return (odds / (1 + odds))[place]


def _chunk_gradient(e, labels, mask, transition):
    """Gradients of the mean log-likelihood of chunks (rows of 64 tokens): of emissions and transitions."""
    n, width = e.shape
    w, t = np.exp(np.clip(e, -30, 30)), np.exp(transition)
    forward, norm = np.empty((width, n, 2)), np.ones((width, n))
    backward = np.ones((width, n, 2))
    state = np.stack([np.ones(n), w[:, 0]], 1)
    forward[0] = state / state.sum(1, keepdims=True)
    for i in range(1, width):
        state = forward[i - 1] @ t
        state[:, 1] *= w[:, i]
        state /= state.sum(1, keepdims=True)
        forward[i] = np.where(mask[:, i : i + 1], state, forward[i - 1])
    pairs = np.zeros((2, 2))
    for i in range(width - 2, -1, -1):
        ahead = backward[i + 1] * np.stack([np.ones(n), w[:, i + 1]], 1)
        live = mask[:, i + 1]
        joint = forward[i][:, :, None] * t * ahead[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pairs += joint[live].sum(0)
        state = ahead @ t.T
        backward[i] = np.where(live[:, None], state / state.sum(1, keepdims=True), backward[i + 1])
    both = forward * backward
    probability = (both[:, :, 1] / both.sum(2)).T
    seen = np.zeros((2, 2))
    a, b, live = labels[:, :-1], labels[:, 1:], mask[:, 1:]
    np.add.at(seen, (a[live], b[live]), 1)
    return np.where(mask, labels - probability, 0), seen - pairs


def telling_features(in_toxic: np.ndarray, in_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Which features, by the documents of either kind that hold them, tell toxic from clean ones: a log-likelihood ratio."""
    share = toxic / max(1, toxic + clean)
    if not 0 < share < 1:
        return np.zeros(len(in_toxic), bool)
    part = in_toxic / np.maximum(in_toxic + in_clean, 1)
    ratio = in_toxic * np.log(np.maximum(part, TINY) / share) + in_clean * np.log(np.maximum(1 - part, TINY) / (1 - share))
    return (part > share) & (ratio >= TELLING)


def numbered(words: list[str], place: dict[str, int]) -> np.ndarray:
    """Words as numbers; new ones are added to ``place``."""
    return np.array([place.setdefault(w.lower(), len(place)) for w in words], np.int32)


def without_copies(rows: list, column: list[str]) -> list:
    """``rows`` without those whose text shares one of three smallest shingle hashes with that of an earlier row."""
    seen: set = set()
    out = []
    for row, tokens in zip(rows, shingle_sets(pa.array(column, pa.large_string()), 3), strict=True):
        least = {(k, int(mix(tokens + np.uint64(k)).min())) for k in range(3)} if len(tokens) else {None}
        if seen.isdisjoint(least):
            out.append(row)
        seen |= least
    return out


def train_chain(rows: list[np.ndarray], labels: np.ndarray, words: list[str]) -> tuple[dict[str, float], float, np.ndarray]:
    """Feature weights, bias and transitions from documents as numbers of ``words``, and their labels."""
    place: dict[str, int] = {}
    of_each = [np.array([place.setdefault(f, len(place)) for f in features(w)], np.int32) for w in words]
    names = list(place)
    counts = np.zeros((2, len(names)), np.int64)
    for row, label in zip(rows, labels.tolist(), strict=True):
        if len(row):
            counts[label, np.unique(np.concatenate([of_each[i] for i in np.unique(row)]))] += 1
    telling = telling_features(counts[1], counts[0], int(labels.sum()), int((labels == 0).sum()))
    toxic_word = np.array([telling[fs].any() for fs in of_each], bool)
    chunks = []
    for row, label in zip(rows, labels, strict=True):
        tags = (toxic_word[row] & bool(label)).astype(np.int64)
        chunks += [(int(tags[i : i + CHUNK].any()), row[i : i + CHUNK], tags[i : i + CHUNK]) for i in range(0, len(row), CHUNK)]
    rng = np.random.default_rng(7)
    rng.shuffle(order := np.arange(len(chunks)))
    hits = [i for i in order if chunks[i][0]][: CHUNKS // 2]
    chosen = [chunks[i] for i in hits + [i for i in order if not chunks[i][0]][: CHUNKS - len(hits)]]
    transition = np.array([[0.0, -2.0], [0.0, 0.0]])
    if not hits:
        return {}, -12.0, transition
    often = counts.sum(0) >= 3
    known = {f: i for i, f in enumerate(sorted(f for f, n in zip(names, often.tolist(), strict=True) if n))}
    pairs = [(i, known[names[f]]) for i, fs in enumerate(of_each) for f in fs if often[f]]
    of_word, of_feature = np.array(pairs, np.int64).reshape(-1, 2).T
    token, tag, mask = (np.zeros((len(chosen), CHUNK), np.int64) for _ in range(3))
    for i, (_, row, tags) in enumerate(chosen):
        token[i, : len(row)], tag[i, : len(row)], mask[i, : len(row)] = row, tags, 1
    mask = mask.astype(bool)
    weights, bias = np.zeros(len(known)), -4.0
    square, square_t, square_b = np.full(len(known), 1.0), np.full((2, 2), 1.0), 1.0
    for _ in range(STEPS):  # gradient ascent with a step size per weight
        score = bias + np.bincount(of_word, weights[of_feature], minlength=len(words))
        g, gt = _chunk_gradient(score[token], tag, mask, transition)
        gw = np.bincount(of_feature, np.bincount(token[mask], g[mask], minlength=len(words))[of_word], minlength=len(known)) - 0.1 * weights
        square += gw**2
        square_t += gt**2
        square_b += g.sum() ** 2
        weights += 0.5 * gw / np.sqrt(square)
        transition += 0.5 * gt / np.sqrt(square_t)
        bias += 0.5 * g.sum() / np.sqrt(square_b)
    return {f: float(weights[i]) for f, i in known.items() if abs(weights[i]) > 0.01}, float(bias), transition


def summary(probability: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each text: 1, log odds of its largest marginal, log of 1 + sum of marginals."""
    at = np.cumsum(lengths) - lengths
    full = lengths > 0
    largest, total = np.zeros(len(lengths)), np.zeros(len(lengths))
    if full.any():
        largest[full] = np.maximum.reduceat(probability, at[full])
        total[full] = np.add.reduceat(probability, at[full])
    largest = np.clip(largest, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(len(lengths)), np.log(largest / (1 - largest)), np.log1p(total)], 1)


def fit_curve(x: np.ndarray, labels: np.ndarray, shares: tuple[float, float]) -> np.ndarray:
    """Logistic regression by Newton's steps; a class weighs as it does among all labelled rows."""
    weight = np.where(labels == 1, shares[1] / max(1, (labels == 1).sum()), shares[0] / max(1, (labels == 0).sum())) * len(labels)
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (weight * (labels - p)) - theta * [0, 1, 1]
        theta += np.linalg.solve((x * (weight * p * (1 - p) + TINY)[:, None]).T @ x + np.diag([TINY, 1, 1]), gradient)
    return theta


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learn from at most ``per_class`` rows of each label, the first by a hash of their id; held-out and null labels are not used."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    counts = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = [usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for label in (0, 1)]
    ids = F.broadcast(sample[0].unionByName(sample[1]).dropDuplicates(["doc_id"]))  # 2 * per_class rows
    short = docs.select("doc_id", "text").where(F.length(F.coalesce("text", F.lit(""))) <= LONGEST)
    sampled = short.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(2 * per_class).collect()
    sampled = without_copies(sampled, [r.text or "" for r in sampled])
    place: dict[str, int] = {}
    rows = [numbered(WORD.findall(r.text or ""), place) for r in sampled]
    kinds, words = np.array([r.toxic for r in sampled], np.int64), list(place)
    model = Model(*train_chain(rows[::2], kinds[::2], words), np.zeros(3))
    rest, labels_of_rest = (rows[1::2], kinds[1::2]) if len(rows) > 1 else (rows, kinds)
    share = {k: v / max(1, sum(counts.values())) for k, v in counts.items()}
    if len(set(labels_of_rest.tolist())) < 2:
        return model._replace(curve=np.array([np.log((share.get(1, 0) + 0.01) / (share.get(0, 0) + 0.01)), 0.0, 0.0]))
    lengths = np.array([len(row) for row in rest], np.int64)
    emission = np.array([model.emission(w) for w in words])[np.concatenate(rest)] if lengths.sum() else np.empty(0)
    x = summary(marginals(emission, lengths, model.transition), lengths)
    return model._replace(curve=fit_curve(x, labels_of_rest, (share.get(0, 0), share.get(1, 0))))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def emissions(self, words: list[str]) -> list[float]:
        known, out = self.known, []
        for word in words:
            value = known.get(word)
            if value is None:
                if len(known) > CACHE:
                    known.clear()
                value = known[word] = self.model.emission(word)
            out.append(value)
        return out

    def score(self, batch: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores of texts and their toxic spans, as offsets in characters."""
        split = [WORD.findall(text) for text in batch]
        lengths = np.array([len(words) for words in split], np.int64)
        emission = np.fromiter((x for words in split for x in self.emissions(words)), np.float64, int(lengths.sum()))
        p = marginals(emission, lengths, self.model.transition) if len(emission) else np.empty(0)
        score = 1 / (1 + np.exp(-np.clip(summary(p, lengths) @ self.model.curve, -30, 30)))
        spans, at = [], 0
        for text, n in zip(batch, lengths.tolist(), strict=True):
            spans.append(self._spans(text, p[at : at + n]))
            at += n
        return score, spans

    @staticmethod
    def _spans(text: str, p: np.ndarray) -> list[dict]:
        toxic, out = p >= SPAN, []
        if toxic.any():
            before = -2
            for i, found in enumerate(WORD.finditer(text)):
                if toxic[i]:
                    if before == i - 1:
                        out[-1]["stop"] = found.end()
                        out[-1]["probability"] = max(out[-1]["probability"], float(p[i]))
                    else:
                        out.append({"start": found.start(), "stop": found.end(), "probability": float(p[i])})
                    before = i
        return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())]))


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text of ``docs`` (``doc_id, text``) by what ``labels`` (``doc_id, toxic``) teach.

    Returns ``doc_id, held_out, score, predicted, spans``. ``spans`` are runs of tokens with a
    marginal of ``SPAN`` or more. A null or empty text has no tokens and the curve's lowest score;
    a null id is held out of nothing (``held_out`` false). Without labels of both kinds all scores
    are one constant. Equal texts get equal scores, up to rounding; an empty table gives an empty
    result. Scoring is one narrow stage.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))

    def run(batches):
        scorer = Scorer(shared.value)
        for whole in batches:
            for low in range(0, whole.num_rows, 2500):
                batch = whole.slice(low, 2500)
                score, spans = scorer.score(texts(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(spans, SPANS)], ["doc_id", "_text", "score", "spans"]).select(["doc_id", "score", "spans"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, spans array<struct<start int, stop int, probability double>>")
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )
