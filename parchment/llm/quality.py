"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; web text without a look at its label is
unlabelled. With the share of good documents p (the class prior), the risk of a scorer f is

    p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)])

whose second part estimates the risk on bad documents and is kept non-negative. A
small network over features of the text minimises it. No document labelled bad is used anywhere.

The prior is estimated from positives and unlabelled text alone: above any output the unlabelled text holds at least p times the share that the positives
have there, and where a region is all good, just that; the least ratio, within its confidence, is the prior. Estimate and
the map from outputs to probabilities, which minimises the same risk with the logistic loss, take all unlabelled rows into account.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import Shared, sampled, text_of, without

#: Slots of hashed word shapes.
SHAPES = 256
#: Words whose shapes a worker remembers; with more after a text, it forgets them all and goes on.
REMEMBERED = 500_000
#: Words handled at a time, so that memory doesn't grow with a text.
STEP = 1 << 18

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUNS = [(re.compile(r"[^\W\d_a-zß-öø-ÿ]"), "A"), (re.compile(r"[^\W\d_A]"), "a"), (re.compile(r"\d"), "0")]
_workers: dict[str, "_Shapes"] = {}


def shape(word: str) -> str:
    """Letters become A or a, digits 0, and runs of a kind one; a character that itself stands more than three times in a row has a mark after it."""
    word = re.sub(r"(.)\1{3,}", r"\1+", word)
    for pattern, by in _RUNS:
        word = pattern.sub(by, word)
    return re.sub(r"(.)\1+", r"\1", word)[:32]


class _Shapes(dict):
    """A number of each word's own, whose remainder modulo SHAPES is its shape's slot."""

    def __missing__(self, word: str) -> int:
        slot = xxhash.xxh32_intdigest(shape(word)) % SHAPES
        self[word] = number = len(self) * SHAPES + slot
        return number


FEATURES = 20
#: Kinds of outputs that are counted, at most.
BUCKETS = 4096


def features(text: str) -> np.ndarray:
    """Numbers that describe a text: shares of kinds of characters, words, repeats and lines, then word shapes' shares."""
    known = _workers.setdefault("shapes", _Shapes())
    out = np.zeros(FEATURES + SHAPES, np.float32)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    by = np.bincount(raw, minlength=256)
    words = _WORD.findall(text)
    m = max(1, len(words))
    at = np.empty(len(words), np.int64)
    for s in range(0, len(words), STEP):
        part = words[s : s + STEP]
        at[s : s + len(part)] = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
    counts = np.unique(at, return_counts=True)[1] if len(at) else np.zeros(1)
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    out[:FEATURES] = [
        np.log1p(len(raw)) / 10,
        np.log1p(len(words)) / 8,
        by[65:91].sum() / n,
        by[97:123].sum() / n,
        by[48:58].sum() / n,
        by[128:].sum() / n,
        (by[33:48].sum() + by[58:65].sum() + by[91:97].sum() + by[123:127].sum()) / n,
        (by[44] + by[46]) / m,
        by[32] / n,
        (by[9:14].sum()) / n,
        by[124] / m,
        by[33] / m,
        (len(raw) - by[32] - by[9:14].sum()) / m / 10,
        len(counts) / m,
        np.log1p(len(counts)) / np.log1p(m),
        counts.max() / m,
        float((at[1:] == at[:-1]).sum()) / m,
        1 - len(set(full)) / max(1, len(full)),
        len(full) / m,
        sum(x.rstrip()[-1:] in ".!?" for x in full) / max(1, len(full)),
    ]
    out[FEATURES:] = np.bincount(at % SHAPES, minlength=SHAPES) / m
    if len(known) > REMEMBERED:
        known.clear()
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    hidden: tuple[np.ndarray, np.ndarray]
    top: tuple[np.ndarray, float]
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.5

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.hidden[0] + self.hidden[1]) @ self.top[0] + self.top[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _network(positive: np.ndarray, unlabelled: np.ndarray, pull: Callable[[np.ndarray, np.ndarray], np.ndarray], units: int, epochs: int, batch: int, rate: float, decay: float, seed: int) -> Model:
    """A network of one hidden layer by Adam steps; pull gives the slopes of the risk in its outputs on positives and unlabelled rows."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-4
    d = both.shape[1]
    w = {"a": rng.normal(0, 1 / np.sqrt(d), (d, units)), "b": np.zeros(units), "c": rng.normal(0, 1 / np.sqrt(units), units), "e": np.zeros(1)}
    m, v, t = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    z = lambda x: np.clip((x - mean) / scale, -6, 6).astype(np.float64)
    p, u = z(positive), z(unlabelled)
    steps = max(1, min(len(p), len(u)) // batch)
    for _ in range(epochs * steps):
        x = np.concatenate([p[rng.integers(0, len(p), batch)], u[rng.integers(0, len(u), batch)]])
        h = np.tanh(x @ w["a"] + w["b"])
        f = h @ w["c"] + w["e"]
        g = pull(f[:batch], f[batch:])
        gh = np.outer(g, w["c"]) * (1 - h * h)
        grads = {"a": x.T @ gh + decay * w["a"], "b": gh.sum(0), "c": h.T @ g + decay * w["c"], "e": np.array([g.sum()])}
        t += 1
        for k, gr in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * gr
            v[k] = 0.999 * v[k] + 0.001 * gr * gr
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, (w["a"], w["b"]), (w["c"], float(w["e"][0])))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, units: int = 24, epochs: int = 60, batch: int = 512, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> Model:
    """Minimises the non-negative risk with the sigmoid loss; where the bad documents' risk is negative, a step goes against that part alone."""

    def pull(fp: np.ndarray, fu: np.ndarray) -> np.ndarray:
        good, free = _sigmoid(fp), _sigmoid(fu)  # loss(f) = 1 - good, loss(-f) = good
        sp, su = good * (1 - good) / len(fp), free * (1 - free) / len(fu)
        if free.mean() - prior * good.mean() < 0:
            return np.concatenate([prior * sp, -su])
        return np.concatenate([-2 * prior * sp, su])

    out = _network(positive, unlabelled, pull, units, epochs, batch, rate, decay, seed)
    out.prior = prior
    return out


def fit_apart(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 30, seed: int = 11) -> Model:
    """A network that tells positives from unlabelled rows, by the logistic loss."""
    pull = lambda fp, fu: np.concatenate([(_sigmoid(fp) - 1) / len(fp), _sigmoid(fu) / len(fu)])
    return _network(positive, unlabelled, pull, 24, epochs, 512, 3e-3, 1e-3, seed)


def estimate_prior(positive: np.ndarray, outputs: np.ndarray, counts: np.ndarray) -> float:
    """The share of good ones among unlabelled rows, of which counts have these outputs, by the outputs of positives that had no part in their making.

    At every output the share of unlabelled rows from there up is divided by that of positives; the least of
    these ratios counts, each raised by what chance allows for (with confidence 0.9). Between 0.01 and 0.99.
    """
    order = np.argsort(-outputs, kind="stable")
    cuts, total = outputs[order], max(1, int(counts.sum()))
    above = np.cumsum(counts[order]) / total
    own = np.sort(positive)
    share = (len(own) - np.searchsorted(own, cuts, side="left")) / max(1, len(own))
    noise = np.sqrt(np.log(40.0) / 2) * (1 / np.sqrt(total) + 1 / np.sqrt(max(1, len(own))))
    seen = share > 0
    if not seen.any():
        return 0.5
    bound = (above[seen] + 1.01 * noise) / share[seen]
    at = int(np.argmin(bound))
    return float(np.clip(above[seen][at] / share[seen][at], 0.01, 0.99))


def calibrate(model: Model, x: np.ndarray | None, good: np.ndarray, every: np.ndarray | None = None, outputs: np.ndarray | None = None) -> None:
    """A logistic fit on the model's outputs (of x, if they are not given) by Newton steps; only a rising one is kept.

    good weighs each row as a positive, every as a row of all (1 if it is left out): with labels, good is the label; for positives and unlabelled rows,
    the former weigh the prior in good and nothing in every, the latter the reverse. The risk, sum of every * softplus(z) - good * z, is convex.
    """
    f = model.raw(x) if outputs is None else outputs
    every = np.ones(len(f)) if every is None else every
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * f + b)
        e = every * p - good
        g = np.array([(e * f).sum() + 1e-2 * a, e.sum() + 1e-2 * b])
        s = every * p * (1 - p)
        h = np.array([[(s * f * f).sum() + 1e-2, (s * f).sum()], [(s * f).sum(), s.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    if a > 0:
        model.slope, model.shift = float(a), float(b)


def _features(rows: DataFrame) -> np.ndarray:
    """Features of the texts of a bounded number of rows, in an order that does not depend on the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t.as_py()).tobytes() for t in batch.column(0)], pa.binary())], ["x"])

    found = sorted(rows.select("text").mapInArrow(run, "x binary").toArrow().column("x").to_pylist())
    return np.frombuffer(b"".join(found), np.float32).reshape(-1, FEATURES + SHAPES)


def fit_network(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 8000) -> tuple[Model, np.ndarray] | None:
    """(model, features of positives that it did not learn from), from about `sample` positives and as many unlabelled documents of docs.

    The network is fitted on these two bounded samples, whole texts each; a third of the positives is held back. None where no document is labelled good.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("l_id")).where("l_id IS NOT NULL").distinct()
    # The labelled sample has a bound, so it may be sent to all tasks.
    x = _features(rows.join(F.broadcast(sampled(good, sample, "l_id")), F.col("id") == F.col("l_id")))
    if not len(x):
        return None
    # Unlabelled text: any training rows, whatever their label, which is not looked at.
    u = _features(sampled(rows, sample))
    held = np.arange(len(x)) % 3 == 2
    own, rest = (x[~held], x[held]) if held.any() else (x, x)
    half = np.arange(len(u)) % 2 == 0
    apart = fit_apart(own, u[half])
    other = apart.raw(u[~half]) if (~half).any() else apart.raw(u)
    model = fit_nnpu(own, u, estimate_prior(apart.raw(rest), other, np.ones(len(other))))
    return model, rest


def settle(model: Model, held: np.ndarray, outputs: DataFrame) -> Model:
    """The model with prior and probabilities by all unlabelled rows: outputs has one number, out, for each. They are counted by BUCKETS; only counts reach the driver."""
    bucket = F.floor((F.tanh(F.col("out") / 4) + 1) / 2 * BUCKETS)
    # Sums of whole numbers: their order makes no difference.
    found = outputs.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("out") * 1e6).cast("long")).alias("s")).collect()
    found.sort()
    counts = np.array([r.n for r in found], float)
    centre = np.array([r.s / 1e6 / r.n for r in found])
    own = model.raw(held)
    if len(found):
        model.prior = estimate_prior(own, centre, counts)
        n = counts.sum()
        good = np.concatenate([np.zeros(len(centre)), np.full(len(own), model.prior * n / len(own))])
        every = np.concatenate([counts, np.zeros(len(own))])
        calibrate(model, None, good, every, np.concatenate([centre, own]))
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 8000) -> Model | None:
    """Learns from docs (training rows only); see fit_network() and settle(). None where no document is labelled good.

    Labels may be null, repeated or of absent documents; ids that are null label nothing. Rows without a good label are unlabelled, and so are, for
    the estimate, all rows. Null texts are empty. Other columns are not read.
    """
    found = fit_network(docs, labels, id_col, text_col, label_col, sample)
    return found and settle(*found, outputs(docs.select(text_of(text_col).alias("text")), found[0]))


def _applied(docs: DataFrame, model: Model, text_col: str, name: str, use: Callable[[Model, np.ndarray], np.ndarray]) -> DataFrame:
    """docs with a further double column that use makes of the features of the texts; one that has its name already is replaced."""
    docs = without(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            # A few at a time: texts can be long.
            found = [use(own, np.stack([features(t.as_py() or "") for t in batch.column(at).slice(s, 256)])) for s in range(0, len(batch), 256)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def outputs(docs: DataFrame, model: Model, text_col: str = "text", name: str = "out") -> DataFrame:
    """docs with the model's output, before it becomes a probability; see score()."""
    return _applied(docs, model, text_col, name, lambda m, x: m.raw(x))


def score(docs: DataFrame, model: Model | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with a further column between 0 and 1, higher where good is likelier; all other columns pass as they are.

    Null texts are empty; empty texts are scored like any other. Repeated rows score alike. Without a model, every score is
    0.5. A column that has the new one's name already is replaced. An empty table gives an empty result.
    """
    if model is None:
        return without(docs, name).withColumn(name, F.lit(0.5))
    return _applied(docs, model, text_col, name, lambda m, x: m.score(x))


def rate_documents(docs: DataFrame, train: Callable[[DataFrame], DataFrame] | DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: id, score, predicted. A row's score depends on its text alone; repeated rows and ties score alike.

    train is the table to learn from, or a filter on rows of docs by `id`; the latter spares a second look at their texts. Null texts are empty, null ids are rows
    like others without a label. Without a good label every score is 0.5. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    if isinstance(train, DataFrame):
        model = fit(train, labels, id_col, text_col)
        out = score(rows, model).drop("text")
    elif (found := fit_network(train(rows), labels.withColumnRenamed(id_col, "id"), "id")) is None:
        out = score(rows, None).drop("text")
    else:
        raw = Shared(docs.sparkSession, "quality").save(outputs(rows, found[0]).drop("text"), "outputs")
        model = settle(*found, train(raw))
        z = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(model.slope) * F.col("out") + F.lit(model.shift)))
        out = raw.withColumn("score", 1 / (1 + F.exp(-z)))
    return out.select("id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
