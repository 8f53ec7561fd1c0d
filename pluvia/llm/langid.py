"""Language of a text in two steps: its family, then one-versus-one machines inside the family.

Features are unit vectors of hashed letter n-grams (``features.ngrams``). A linear support vector machine
per family, one against the rest, names the family; inside a family every pair of languages has its own
linear machine, and the language with most wins (then the largest sum of margins, then the first name)
is the answer. Families are a parameter; a language in none of them forms the family of its own name.

Machines are fit by dual coordinate descent on a bounded sample: about ``PER_LANGUAGE`` labelled texts
of every language and ``SAMPLE`` in all, those of smallest hashed doc_id. The share of a language that is
taken follows from its count, so no group is gathered. The ``LANGUAGES`` most frequent values of ``lang`` are
learned (ties to the first name), so a column full of stray values costs no more than that many languages; texts
of the others are predicted like any. Texts without a letter, null texts and null languages teach nothing.

A text that is null or has no letter is ``und`` with score 0. Without anything learned every text is
``und``. With one language learned, every text with a letter has it, with score 1. The score is the
probability that a logistic curve gives the family's margin, times that of the margins in the family.
Equal texts have equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.llm.columnar import add_columns, bucket, learned, text_chunks
from pluvia.llm.features import DIMENSIONS, ROWS, ngrams

PER_LANGUAGE, LANGUAGES, SAMPLE = 1200, 64, 19_200
UNKNOWN = "und"
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sr"),
}
FOLDS, COST, PASSES = 1 << 20, 1.0, 12


@dataclass(frozen=True)
class Machine:
    """A separating plane; ``curve`` turns a margin into a probability."""

    weights: np.ndarray
    bias: float
    curve: tuple[float, float]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def sure(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -50, 50)))


def separate(x: np.ndarray, positive: np.ndarray) -> Machine:
    """Linear machine with squared hinge loss, classes weighted to equal totals."""
    y = np.where(positive, 1.0, -1.0)
    n = len(y)
    weight = np.where(positive, n / (2 * max(1, positive.sum())), n / (2 * max(1, (~positive).sum())))
    extra = 1 / (2 * COST * weight)
    w, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(n)
    norm = np.einsum("ij,ij->i", x, x) + 1 + extra
    turn = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in turn.permutation(n):
            slope = y[k] * (float(x[k] @ w) + bias) - 1 + extra[k] * alpha[k]
            new = max(0.0, alpha[k] - slope / norm[k])
            if new != alpha[k]:
                step = (new - alpha[k]) * y[k]
                w += np.float32(step) * x[k]
                bias += step
                alpha[k] = new
    margin = x @ w + bias
    a, b = 1.0, 0.0
    for _ in range(200):  # logistic curve through the margins, by gradient steps
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        slope = weight * (p - positive)
        a, b = a - 0.5 * float((slope * margin).mean()), b - 0.5 * float(slope.mean())
    return Machine(w, float(bias), (max(a, 0.1), b))


@dataclass(frozen=True)
class Hierarchy:
    families: list[list[str]]
    of_family: list[Machine | None]
    of_pair: dict[tuple[str, str], Machine]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of each row."""
        if not self.families:
            return np.full(len(x), UNKNOWN, object), np.zeros(len(x))
        if len(self.families) == 1:
            family, sure = np.zeros(len(x), np.int64), np.ones(len(x))
        else:
            chance = np.stack([m.sure(m.margin(x)) for m in self.of_family], axis=1)
            family = chance.argmax(axis=1)
            sure = chance.max(axis=1)
        language = np.empty(len(x), object)
        for f, members in enumerate(self.families):
            here = np.flatnonzero(family == f)
            if len(members) == 1:
                language[here] = members[0]
                continue
            wins, chance = np.zeros((2, len(here), len(members)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    machine = self.of_pair[a, members[j]]
                    p = machine.sure(machine.margin(x[here]))
                    wins[:, i] += p >= 0.5
                    wins[:, j] += p < 0.5
                    chance[:, i] += p / (len(members) - 1)
                    chance[:, j] += (1 - p) / (len(members) - 1)
            best = (wins + chance / 2).argmax(axis=1)
            language[here] = np.array(members, object)[best]
            sure[here] *= chance[np.arange(len(here)), best]
        return language, np.clip(sure, 0.0, 1.0)


def fit(x: np.ndarray, lang: np.ndarray, families: dict[str, tuple[str, ...]] = FAMILIES) -> Hierarchy:
    of = {language: family for family, members in families.items() for language in members}
    groups: dict[str, list[str]] = {}
    for language in sorted(set(lang.tolist())):
        groups.setdefault(of.get(language, f"={language}"), []).append(language)
    members = [groups[g] for g in sorted(groups)]
    of_family = [separate(x, np.isin(lang, m)) if len(members) > 1 else None for m in members]
    of_pair = {}
    for m in members:
        for i, a in enumerate(m):
            for b in m[i + 1 :]:
                both = (lang == a) | (lang == b)
                of_pair[a, b] = separate(x[both], lang[both] == a)
    return Hierarchy(members, of_family, of_pair)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def shares(docs: DataFrame, usable: Column, per_language: int, languages: int, sample: int) -> list[tuple[str, int]]:
    """The languages to learn, ``languages`` at most, each with the number of the ``FOLDS`` it is taken from."""
    found = docs.where(usable).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    each = min(per_language, sample / max(1, len(found)))
    return [(r["lang"], max(1, int(FOLDS * min(1, each / r["count"])))) for r in found]


def learn(
    docs: DataFrame,
    allowed: Column | None = None,
    per_language: int = PER_LANGUAGE,
    families: dict[str, tuple[str, ...]] = FAMILIES,
    languages: int = LANGUAGES,
    sample: int = SAMPLE,
) -> Hierarchy:
    """Fit on about ``per_language`` texts of each of at most ``languages`` languages, at most ``sample`` texts in
    all; ``allowed`` is a condition on doc_id."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    usable = F.col("lang").isNotNull() if allowed is None else F.col("lang").isNotNull() & allowed
    share = shares(docs, usable, per_language, languages, sample)
    if not share:
        return Hierarchy([], [], {})
    # one row a language, ``languages`` rows at most
    taken = F.broadcast(docs.sparkSession.createDataFrame(share, "lang string, taken int"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(FOLDS))
    known = docs.where(usable).join(taken, "lang").where((place < F.col("taken")) & has_letter(F.col("text")))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        chunks = text_chunks(batch.column(batch.schema.get_field_index("text")), most=ROWS)
        parts = [ngrams(d, o).astype("<f2").tobytes() for _, _, d, o in chunks]
        blob = b"".join(parts)
        size = 2 * DIMENSIONS
        return [pa.array([blob[k : k + size] for k in range(0, len(blob), size)], pa.binary())]

    known = known.select("doc_id", "lang", "text")
    rows = add_columns(known, [("x", T.BinaryType())], make, ["doc_id", "lang"])
    # repeated rows hash alike and may exceed the share; the limit holds the bound
    bound = min(per_language * len(share), sample)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(bound).select("lang", "x")

    def taught(table: pa.Table) -> Hierarchy:
        lang = np.array(table.column(0).to_pylist(), object)
        x = np.empty((len(lang), DIMENSIONS), np.float32)
        for k, packed in enumerate(table.column(1)):
            x[k] = np.frombuffer(packed.as_buffer(), "<f2")
        return fit(x, lang, families)

    return learned(rows, taught) or Hierarchy([], [], {})


def with_language(docs: DataFrame, model: Hierarchy, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``."""
    flagged = "_has_letter"
    columns = docs.columns if keep is None else keep

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        lettered = np.asarray(batch.column(batch.schema.get_field_index(flagged)).to_numpy(zero_copy_only=False), bool)
        names, scores = [np.zeros(0, object)], [np.zeros(0)]
        for _, _, d, o in text_chunks(batch.column(batch.schema.get_field_index("text")), most=ROWS):
            name, score = model.predict(ngrams(d, o))
            names.append(name)
            scores.append(score)
        name = np.where(lettered, np.concatenate(names), UNKNOWN)
        score = np.where(lettered & (name != UNKNOWN), np.concatenate(scores), 0.0)
        return [pa.array(name.tolist(), pa.string()), pa.array(score)]

    fields = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType())]
    return add_columns(docs.withColumn(flagged, has_letter(F.col("text").cast("string"))), fields, make, columns)


def op4_langid(docs: DataFrame) -> DataFrame:
    """One row per document; a quarter of the hashed doc_ids is held out from learning."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(docs, bucket("doc_id", 4) != 2)
    return with_language(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )
