"""Language identification, words first.

A known word scores by its log frequency in each language. A word never seen in
training backs off to its character n-grams, the longest length of which any is known.
The scores of all words of a text add up; their softmax with the languages' shares is the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import Shared, keep, sampled, trim, without

#: What is given to a text that is null or has no letter.
UNKNOWN = "und"
#: The longest n-grams of the backoff.
LONGEST = 5
#: Words whose scores a worker remembers; with more after a text, it forgets them all and goes on.
REMEMBERED = 300_000

_LETTERS = re.compile(r"[^\W\d_]+")


class Rows:
    """Rows of numbers by name: one list of names and one matrix, which travel as they are; the index is made where it is used."""

    def __init__(self, names: pa.Array, matrix: np.ndarray):
        self.names, self.matrix = names, matrix.astype(np.float32)
        self.index: dict[str, int] | None = None

    def __getstate__(self) -> dict:
        return {"names": self.names, "matrix": self.matrix, "index": None}

    def __len__(self) -> int:
        return len(self.names)

    def get(self, name: str) -> np.ndarray | None:
        if self.index is None:
            self.index = {x: i for i, x in enumerate(self.names.to_pylist())}
        i = self.index.get(name)
        return None if i is None else self.matrix[i]


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    words: Rows | dict[str, np.ndarray]
    grams: Rows | dict[str, np.ndarray]


def letters(text: str) -> list[str]:
    """Lower-cased runs of letters (and what else is neither punctuation nor a decimal digit)."""
    return _LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _by_name(found: pa.Table, langs: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(names, names by languages) of rows (name, lang, n), each pair at most once."""
    coded = found.column("name").combine_chunks().dictionary_encode()
    matrix = np.zeros((len(coded.dictionary), len(langs)))
    of = pc.index_in(found.column("lang").combine_chunks(), value_set=pa.array(langs, pa.string()))
    matrix[coded.indices.to_numpy(zero_copy_only=False), of.to_numpy(zero_copy_only=False)] = found.column("n").to_numpy()
    return coded.dictionary, matrix


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", documents: int = 6000, smooth: float = 0.1) -> Model:
    """Learns from about `documents` whole documents with a language, those with the least hashes of their ids (null ids like one id).

    All their words and n-grams are learned, counted by the cluster; one row for each of them and language reaches the driver and, in the
    model, the workers: that is bounded by the number of documents. Rows with null text or language teach nothing; repeated rows count
    each. Without any row the model knows no language. Other columns are not read.
    """
    shared = Shared(rows.sparkSession, "langid")
    sample = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample = sampled(sample.where("text IS NOT NULL AND lang IS NOT NULL"), documents)
    schema = "name string, lang string, n long"

    def counted(seen: Counter) -> pa.RecordBatch:
        keys = list(seen)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())], ["name", "lang", "n"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                seen["", lang] += 1  # documents
                seen.update((w, lang) for w in letters(text))
        yield counted(seen)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for word, lang, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # By the root of their counts: frequent words say little of how unseen words look. Whole numbers, so that sums don't depend on order.
                weight = round(1000 * n**0.5)
                for k in range(1, LONGEST + 1):
                    for g in grams_of(word, k):
                        seen[g, lang] += weight
            yield counted(seen)

    summed = lambda df: df.groupBy("name", "lang").agg(F.sum("n").alias("n"))
    counts = shared.save(summed(sample.mapInArrow(words, schema)), "words")
    docs = {r.lang: r.n for r in counts.where("name = ''").collect()}  # a row a language
    langs = sorted(docs)
    prior = np.array([docs[x] for x in langs], float)
    known = counts.where("name != ''")
    names, by_word = _by_name(known.toArrow(), langs)
    logs = lambda v: np.log((v + smooth) / (v.sum(0) + smooth * len(v)))
    word_rows = Rows(names, logs(by_word))
    names, by_gram = _by_name(summed(known.mapInArrow(grams, schema)).toArrow(), langs)
    size = pc.utf8_length(names).to_numpy(zero_copy_only=False)
    for k in range(1, LONGEST + 1):
        own = size == k
        by_gram[own] = logs(by_gram[own] / 1000)
    return Model(langs, np.log(prior / prior.sum()) if len(langs) else prior, word_rows, Rows(names, by_gram))


def word_score(model: Model, word: str) -> np.ndarray:
    """Log score of one word in each language; nothing known about it scores 0 everywhere."""
    if (s := model.words.get(word)) is not None:
        return s
    for n in range(LONGEST, 0, -1):
        known = [s for g in grams_of(word, n) if (s := model.grams.get(g)) is not None]
        if known:
            return np.mean(known, axis=0)
    return np.zeros(len(model.langs))


class _Scorer(dict):
    """Rows of a growing matrix of word scores, by word; words without a letter have row 0."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.rows = np.zeros((1024, len(self.model.langs)))
        self.used = 1

    def __missing__(self, word: str) -> int:
        if not any(c.isalpha() for c in word):
            self[word] = 0
            return 0
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = word_score(self.model, word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = letters(text or "")
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not self.model.langs or not at.any():
            out = UNKNOWN, 0.0
        else:
            total = self.rows[at].sum(0) + self.model.prior
            best = int(total.argmax())
            out = self.model.langs[best], float(1 / np.exp(total - total[best]).sum())
        if len(self) > REMEMBERED:
            self.reset()
        return out


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two further columns: the likeliest language, and its share between 0 and 1.

    A text that is null or has no letter gets "und" and 0, as does every text if nothing was learned. Ties go to the first
    language by name. Repeated rows are predicted alike. Only the text is read; all other columns pass as they are, but those
    that have a new one's name already are replaced. An empty table gives an empty result.
    """
    docs = without(docs, lang, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{lang}` string, `{score}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = keep("languages", lambda: _Scorer(model), lambda x: x.model is model)
        for batch in batches:
            found = [scorer(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*batch.schema.names, lang, score])
        trim()

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: id, lang_pred, score, learned from train, which is read at no other place.

    What predict() says of nulls, ties, repeated rows and empty tables holds; other columns are not read.
    """
    model = fit(train, lang_col, text_col, id_col)
    return predict(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), model).drop("text")


def keep_known(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """docs without those rejected: texts that are null or without letters, and those for which no language reaches `least`.

    Repeated rows share their fate; all columns are as they were, whatever their names. An empty table gives an empty result, and so
    does any if nothing was learned.
    """
    names = set(docs.columns)
    lang, score = (next(f"{x}{i}" for i in range(99) if f"{x}{i}" not in names) for x in ("_lang", "_score"))
    found = predict(docs, fit(train, lang_col, text_col, id_col), text_col, lang, score)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(docs.columns)
