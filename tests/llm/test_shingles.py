"""The near-duplicate stage against brute-force similarity, with planted copies."""

import itertools

import numpy as np
import pytest

import corpus_pipeline
from pluvia.llm import shingles

SCHEMA = "doc_id long, text string"


def five(text):
    w = (text or "").lower().split()
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def planted():
    """Texts, copies at 0.6 to 0.97, chains of copies, one crowded family, nothing."""
    turn = np.random.default_rng(21)
    word = lambda n: ["w%d" % k for k in turn.integers(0, 3000, n)]
    out = []
    for size in (12, 40, 90, 200, 600):
        for share in (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5):
            w = word(size)
            out.append(w)
            for _ in range(2):
                w = [*w[: max(1, round(len(w) * (1 - share / 2)))], *word(round(len(w) * share / 2))]
                out.append(w)
    base = word(120)
    for _ in range(60):
        k = int(turn.integers(0, 120))
        out.append([*base[:k], *word(1), *base[k + 1 :]])
    made = [" ".join(w) for w in out]
    return [*made, *made[:5], made[7].upper(), "a b", "a  B", "a c", "", " \n", None]


def slow_kept(rows):
    sets = [five(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or both / len(sets[a] | sets[b]) >= 0.8:
            top[find(b)] = find(a)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted(least.values())


@pytest.mark.parametrize("cell", [4096, 20])
def test_stage_keeps_one_of_each_group_of_similar_texts(spark, monkeypatch, cell):
    monkeypatch.setattr(shingles, "CELL", cell)
    rows = [(k, t) for k, t in enumerate(planted())]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    kept = corpus_pipeline.distinct(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == slow_kept(rows)
    assert corpus_pipeline.distinct(spark, docs.limit(0), "").count() == 0


def test_the_same_row_stays_however_rows_are_dealt(spark):
    """Rows of one doc_id and text that differ in other columns, whole copies, and a null doc_id."""
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(7, text, f"x{k}") for k in range(6)] + [(7, text, "x3"), (None, text, "z"), (9, text + " more", "y"), (8, "other words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = {tuple(sorted(map(tuple, shingles.one_of_each(docs.repartition(n, "node")).collect()))) for n in (1, 3, 7)}
    (only,) = kept
    assert len(only) == 2 and only[1][:2] == (8, "other words") and only[0][0] == 7
    named = sorted(map(tuple, shingles.near_duplicates(docs).collect()), key=repr)
    assert named == sorted([(7, 7)] * 7 + [(None, 7), (9, 7), (8, 8)], key=repr)


def lead_of(hashes, heavy):
    return set(sorted(hashes.tolist(), key=lambda h: (h in heavy, h))[: len(hashes) + 1 + -4 * len(hashes) // 5])


# eight words, and a ninth that makes one of five shingles, so the similarity is 0.8; found by search
NO_BAND = [
    ("w267 w2589 w66 w1624 w241 w899 w1443 w1268", "w588554"),
    ("w659 w2565 w2002 w2583 w2520 w2629 w931 w1415", "w876664"),
    ("w1852 w822 w2758 w21 w2514 w1937 w760 w2159", "w820667"),
]


def test_similar_texts_without_a_shared_band_are_linked(spark):
    texts = [t for text, more in NO_BAND for t in (text, f"{text} {more}")]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    keys = shingles.bands(*shingles.sets(data, np.cumsum([0, *map(len, texts)])))
    assert not (keys[::2] == keys[1::2]).any()
    rows = [*enumerate(texts), (6, texts[0].upper()), (7, "w0 " + texts[4]), (8, texts[0] + " x y z")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(r["doc_id"] for r in shingles.one_of_each(docs).collect()) == slow_kept(rows) == [0, 2, 4, 8]
    named = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(docs).collect()}
    assert named == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 0, 7: 4, 8: 8}


def test_the_exact_pass_alone_finds_every_link(spark, monkeypatch):
    monkeypatch.setattr(shingles, "CELL", 20)
    monkeypatch.setattr(shingles, "HEAVY", 30)
    monkeypatch.setattr(shingles, "candidates", lambda nodes: spark.createDataFrame([], "u long, v long"))
    rows = list(enumerate(planted()))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(r["doc_id"] for r in shingles.one_of_each(docs).collect()) == slow_kept(rows)


def test_leads_meet_and_marks_never_part_linked_sets():
    turn = np.random.default_rng(5)
    sizes = turn.integers(1, 3000, 60)
    both = [turn.integers(0, 1 << 64, n, np.uint64) for n in sizes]
    shares = (0, 0.1), (0.09, 0)  # left out and put in
    sides = [
        [np.unique(np.append(x[round(len(x) * less) :], turn.integers(0, 1 << 64, round(len(x) * more), np.uint64))) for less, more in shares]
        for x in both
    ]
    flat = [x for pair in sides for x in pair]
    hashes, bounds = np.concatenate(flat), np.append(0, np.cumsum([len(x) for x in flat]))
    heavy = turn.choice(hashes, 500)
    first, many = shingles.lead(hashes, bounds, heavy)
    leads = [set(x.tolist()) for x in np.split(first, np.cumsum(many)[:-1])]
    assert leads == [lead_of(x, set(heavy.tolist())) for x in flat]
    bits = shingles.own_bits(np.diff(bounds))
    own = np.split(shingles.marks(hashes, bounds, bits), np.cumsum(bits // 8)[:-1])
    even = shingles.even_marks(hashes, bounds, 512)
    for k in range(0, len(flat), 2):
        a, b = set(flat[k].tolist()), set(flat[k + 1].tolist())
        apart = len(a ^ b)
        assert int(np.bitwise_count(even[k] ^ even[k + 1]).sum()) <= apart
        assert shingles._differ(own[k].tobytes(), own[k + 1].tobytes()) <= apart
        linked = len(a & b) / len(a | b) >= 0.8
        assert linked == bool(shingles.reachable(np.array([apart]), np.array([len(a)]), np.array([len(b)]))[0])
        assert leads[k] & leads[k + 1] or not linked
    assert shingles.reachable(np.array([0, 1]), np.array([4, 4]), np.array([5, 6])).tolist() == [True, False]
