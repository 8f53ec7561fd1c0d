"""Language identification with many languages, and against a slow version of its features and votes."""

import math

import numpy as np
import pytest

from pluvia.llm import langid
from pluvia.llm.features import DIMENSIONS, ngrams

TEXTS = [
    "The river and the STREET, 12 of them!",
    "  Überall ÄÖÜ ist  Straße... ",
    "l'été à la plage: où ça?",
    "x",
    "- 1 -",
    "",
    "日本語 text",
    "a" * 5000,
]


def slow_row(text):
    data, out = list(text.encode()), []
    for k, b in enumerate(data):
        if 65 <= b <= 90 or (k and data[k - 1] == 0xC3 and 0x80 <= b <= 0x9E):
            b += 32
        letter = b >= 128 or chr(b).isalpha()
        if letter:
            out.append(b)
        elif out and out[-1] != 32:
            out.append(32)
    row = [0.0] * DIMENSIONS
    if not out:
        return row
    padded = [32, *out, 32]
    for size in (2, 3):
        for k in range(len(padded) - size + 1):
            code = int.from_bytes(bytes(padded[k : k + size])) + (size << 24)
            row[(code * 2654435761 % 2**32) >> 20] += 1
    norm = math.sqrt(sum(row))
    return [math.sqrt(c) / norm for c in row]


def slow_answer(model, row):
    """Family of the surest machine, then a vote of every pair inside it, margin by margin."""
    sure = lambda m: 1 / (1 + math.exp(-(m.curve[0] * (sum(a * float(b) for a, b in zip(row, m.weights) if a) + m.bias) + m.curve[1])))
    chance = [sure(m) for m in model.of_family]
    best = chance.index(max(chance))
    members = model.families[best]
    wins, total = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
    for i, a in enumerate(members):
        for b in members[i + 1 :]:
            p = sure(model.of_pair[a, b])
            wins[a if p >= 0.5 else b] += 1
            total[a] += p
            total[b] += 1 - p
    if len(members) == 1:
        return members[0], chance[best]
    name = min(members, key=lambda m: (-wins[m], -total[m], m))
    return name, chance[best] * total[name] / (len(members) - 1)


def test_features_equal_a_slow_version():
    coded = [t.encode() for t in TEXTS]
    offsets = np.cumsum([0, *(len(c) for c in coded)])
    fast = ngrams(np.frombuffer(b"".join(coded), np.uint8), offsets)
    assert np.allclose(fast, [slow_row(t) for t in TEXTS], atol=1e-6)


def sentences(languages, each):
    turn = np.random.default_rng(3)
    for k in range(languages):
        letters = list("abcdefghijklmnopqrstuvwxyz")
        turn.shuffle(letters)
        for _ in range(each):
            yield k, " ".join("".join(turn.choice(letters[:8], turn.integers(2, 7))) for _ in range(20))


def test_votes_equal_a_slow_version(spark):
    names = ["en", "de", "nl", "fr", "es", "xx"]
    rows = [(i, t, names[k]) for i, (k, t) in enumerate(sentences(6, 12))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.learn(docs)
    got = {r["doc_id"]: r for r in langid.with_language(docs, model).collect()}
    for doc_id, text, _ in rows:
        name, score = slow_answer(model, slow_row(text))
        assert got[doc_id]["lang_pred"] == name and got[doc_id]["lang_score"] == pytest.approx(score, abs=1e-4)
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows) >= 60


def test_stray_values_of_lang_are_bounded(spark):
    """3,000 values: the most frequent ones are learned, every text is answered."""
    rows = [(i, t, ["en", "de", "fr"][k]) for i, (k, t) in enumerate(sentences(3, 30))]
    rows += [(1000 + k, f"stray text {k}", f"v{k:04d}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.learn(docs)
    learned = sorted(m for members in model.families for m in members)
    assert learned == sorted(["en", "de", "fr", *(f"v{k:04d}" for k in range(langid.LANGUAGES - 3))])
    got = langid.op4_langid(docs).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} <= {"en", "de", "fr", *(f"v{k:04d}" for k in range(3000))}


def test_sample_is_bounded_in_all(spark):
    rows = [(i, t, f"l{k}") for i, (k, t) in enumerate(sentences(5, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    share = langid.shares(docs, docs.lang.isNotNull(), per_language=30, languages=4, sample=40)
    assert [lang for lang, _ in share] == ["l0", "l1", "l2", "l3"]
    assert {taken for _, taken in share} == {langid.FOLDS // 4}
