"""Each operator against a brute-force version on a small table with the awkward rows."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pluvia.llm import ann, bpe, langid, lm, mixing, packing, quality, sharding, simhash, topk
from pluvia.llm.components import connected

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score double, fp string"


def texts():
    """Words in four manners, copies, near copies, junk, nothing, one very long text."""
    turn = np.random.default_rng(5)
    syllables = {
        "en": "th he an ing ion er the of and in".split(),
        "de": "sch ein ung keit ver der die und ß ü".split(),
        "fr": "eau oui è aux ment le la les des ç".split(),
        "es": "ción ado ñ de que el los mente ía rr".split(),
    }
    out = []
    for k in range(160):
        lang = list(syllables)[k % 4]
        words = ["".join(turn.choice(syllables[lang], turn.integers(1, 4))) for _ in range(turn.integers(1, 160))]
        out.append((" ".join(words), lang))
    for k in range(0, 40, 4):
        words = out[k][0].split(" ")
        out += [(out[k][0], "en"), (" ".join(words[:-1] + ["changed"]), "en"), (" ".join(words).upper(), "en")]
    out += [(" ".join(w + "***" for w in out[k][0].split(" ")), "en") for k in range(0, 120, 3)]
    out += [("", "en"), (None, "en"), ("   \n\t", None), ("12 34 !!", "fr"), ("<|endoftext|> a'll 's", None), ("日本語 😀 é É", "xx")]
    return out + [(" ".join(t for t, _ in out[:150]) * 8, "en"), ("z" * 3000, "de")]


@pytest.fixture(scope="module")
def rows():
    out = [(k, t, lang, "src0", len(t or ""), "x", 1.0, "y") for k, (t, lang) in enumerate(texts())]
    return out + [(None, out[0][1], "en", None, None, None, None, None), out[3], out[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, rows):
    known = [(r[0], int("***" not in (r[1] or "")), int((r[0] or 0) % 7 == 0)) for r in rows if (r[0] or 0) % 3]
    odd = [(None, 1, 0), (1, None, None), (99_999, 0, 1), (2, 1, 0), (4, 7, 0)]
    return spark.createDataFrame(known + odd, "doc_id long, quality int, toxic int")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_row(frame):
    return sorted(map(tuple, frame.to_numpy().tolist()), key=repr)


def crc(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode())


# -- op9


def test_bpe_is_that_of_the_library(docs, rows):
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want.append((r[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.op9_bpe(docs, VOCABULARY).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_bpe_round_trip(docs, rows, empty):
    back = bpe.decode(bpe.encode(docs, VOCABULARY, ["doc_id", "text"]), VOCABULARY).collect()
    assert len(back) == len(rows)
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe.op9_bpe(empty, VOCABULARY).count() == 0


def test_bpe_pieces_and_merges():
    library, own = Tokenizer.from_file(VOCABULARY), bpe.vocabulary(VOCABULARY)
    turn = np.random.default_rng(1)
    parts = ["a", "s", "t", "re", "'", " ", "  ", "\n", "1", "é", "日", "!", "<|endoftext|>", "ll", "ve", "　", "Ab", "$$$"]
    made = ["".join(turn.choice(parts, turn.integers(0, 50))) for _ in range(600)] + ["ab" * n for n in range(40)]
    raw = [t.encode() for t in made]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, where = own.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for k, text in enumerate(made):
        assert ids[where[k] : where[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_and_short_trees_agree():
    own = bpe.vocabulary(VOCABULARY)
    for piece in (b"internationalization", b"aaaaaaaaaaaaaaaaaaaaaaaa", b" hello", b"xy"):
        raw = np.frombuffer(piece, np.uint8)[None, :]
        short = own.merge_short(raw.copy(), np.array([len(piece)]))[0]
        assert short[short >= 0].tolist() == own.merge_long(piece)


# -- op1


def best_fit_slowly(sizes, length):
    rows, free = [], []
    for k, size in enumerate(sizes):
        fit = [r for r in range(len(rows)) if free[r] >= size]
        if not fit:
            rows.append([])
            free.append(length)
            fit = [len(rows) - 1]
        best = min(free[r] for r in fit)
        row = [r for r in fit if free[r] == best][-1]
        rows[row].append(k)
        free[row] -= size
    return sorted(length - f for f in free)


def test_best_fit_decreasing():
    turn = np.random.default_rng(2)
    for length in (1, 7, 64, 100):
        sizes = sorted(turn.integers(1, length + 1, 200).tolist(), reverse=True)
        made = packing.best_fit_decreasing(sizes, length)
        assert sorted(k for r in made for k in r) == list(range(200))
        # rows with equally many free places are interchangeable
        assert sorted(sum(sizes[k] for k in r) for r in made) == best_fit_slowly(sizes, length)


def test_packing_restores_every_document(docs, rows, empty):
    packed = packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), VOCABULARY, length=128, pad=9, block_tokens=4000)
    library = Tokenizer.from_file(VOCABULARY)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids for r in rows if r[0] is not None}
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in packing.unpack(packed).collect()}
    assert got == want
    lines = packed.where("row_no is not null").collect()
    for r in lines:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 128 and (ids[r["n_tokens"] :] == 9).all()
        assert r["segment_ends"][0] == 0 and r["segment_ends"][-1] == r["n_tokens"] <= 128
        place = packing.position_ids(r["positions"], 128)
        for a, b in itertools.pairwise(r["segment_ends"]):
            assert place[a:b].tolist() == list(range(b - a))
    assert sum(r["n_tokens"] for r in lines) == sum(map(len, want.values()))
    assert len({(r["block"], r["row_no"]) for r in lines}) == len(lines)
    assert packing.pack(empty, VOCABULARY).count() == 0
    assert packing.op1_packing(docs, VOCABULARY).select(F.explode("doc_ids")).count() >= len(rows)


def test_packed_files(docs, tmp_path, spark):
    packing.write_packed(packing.pack(docs, VOCABULARY), str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).select(F.sum("n_tokens")).first()[0] > 0


# -- op2, op3


@pytest.fixture(scope="module")
def vectors(spark):
    turn = np.random.default_rng(3)
    made = turn.standard_normal((700, 12)).astype(np.float32)
    made[100:300] = made[100]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(made)]
    rows += [rows[40], rows[40], rows[55]]
    rows += [(1000, None, 0), (1020, [1.0, None] * 6, 0), (1040, [float("nan")] * 12, 0), (1060, [float("inf")] * 12, 0)]
    rows += [(None, made[0].tolist(), 0), (1100, [0.0] * 12, 0), (1120, [], 0), (1200, [1.0, 2.0], 0), (1220, [2.0, 1.0], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(4).cache()


def usable(frame, zero=True):
    out = []
    for r in frame.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out.append((r["vec_id"], tuple(v)))
    return out


@pytest.mark.parametrize("depths", [(0.25, 0.5, 0.7, 0.85, 1.0), (1.0,), (0.05, 0.1, 0.2, 0.3, 1.0)])
def test_top_k_is_exact(vectors, monkeypatch, depths):
    from pluvia.llm import vectors as blocks

    monkeypatch.setattr(blocks, "BLOCK", 150)
    monkeypatch.setattr(blocks, "GROUP", 10)
    rows = [(i, np.floor(64 * np.array(v, np.float64))) for i, v in usable(vectors)]
    want = []
    for q, a in {(i, v.tobytes()): (i, v) for i, v in rows if i % 20 == 0}.values():
        scored = sorted((-int(a @ b), i) for i, b in rows if i != q and len(a) == len(b))[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    monkeypatch.setattr(topk, "DEPTHS", depths)
    assert sorted(map(tuple, topk.op2_topk(vectors).collect())) == sorted(want)


def test_bounds_hold():
    turn = np.random.default_rng(4)
    q, v = turn.integers(-9, 9, (5, 8)).astype(float), turn.integers(-9, 9, (60, 8)).astype(float)
    order = np.argsort(-v, axis=0, kind="stable")
    rank = np.argsort(order, axis=0)
    for depth in (1, 7, 30, 60):
        low, high = topk.bounds(q, v, rank, np.take_along_axis(v, order, axis=0), depth)
        assert (low <= q @ v.T).all() and (high >= q @ v.T).all()
    assert np.array_equal(low, q @ v.T) and np.array_equal(high, low)


def test_forest_recall_and_scores(spark, vectors):
    rows = usable(vectors, zero=False)
    got = vectors_of(ann.op3_ann(vectors))
    hits = total = 0
    for q, a in {r for r in rows if r[0] % 50 == 0}:
        a = np.array(a, np.float64)
        cos = {}
        for i, b in rows:
            if i != q and len(b) == len(a):
                b = np.array(b, np.float64)
                cos.setdefault(i, float(a @ b / np.sqrt((a @ a) * (b @ b))))
        best = sorted(((-round(c, 12), i) for i, c in cos.items()))[:5]
        found = got.get(q, [])
        assert all(abs(s - cos[i]) < 1e-12 for i, s in found)
        hits += len({i for _, i in best} & {i for i, _ in found})
        total += len(best)
    assert hits >= 0.9 * total
    assert ann.op3_ann(vectors.limit(0)).count() == 0
    assert topk.op2_topk(vectors.limit(0)).count() == 0


def vectors_of(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_forest_ranges_hold_the_prefixes():
    turn = np.random.default_rng(6)
    bits = ann.SYMBOL_BITS * ann.SYMBOLS
    array = np.sort(turn.integers(0, 1 << bits, 300))
    asked = np.concatenate([turn.integers(0, 1 << bits, 20), array[:5], array[-5:]])
    for level in range(ann.SYMBOLS + 1):
        first, end = ann.prefix_range(array, asked, level)
        cut = bits - ann.SYMBOL_BITS * level
        for q, a, b in zip(asked, first, end):
            assert np.flatnonzero((array >> cut) == (q >> cut)).tolist() == list(range(a, b))


def plain_forest(rows, k, trees, wanted):
    """Neighbours and rows read by the rule, one query and one tree at a time, from unsorted strings."""
    ids = np.array([i for i, _ in rows])
    v = np.array([a for _, a in rows], np.float64)
    unit = ann.units(v)
    centre = np.rint(unit.astype(np.float64) * ann.FIXED).astype(np.int64).sum(axis=0) / len(v) / ann.FIXED
    keys = np.stack([ann.strings(unit - centre.astype(np.float32), ann.planes(v.shape[1], t)) for t in range(trees)])
    out = {}
    for j in np.flatnonzero(ids % 50 == 0):
        def same(t, level):
            cut = ann.SYMBOL_BITS * (ann.SYMBOLS - level)
            return (keys[t] >> cut) == (keys[t, j] >> cut)

        level = ann.SYMBOLS
        while level and sum(same(t, level).sum() for t in range(trees)) < wanted:
            level -= 1
        deeper = min(level + 1, ann.SYMBOLS)
        entries, read = sum(same(t, deeper).sum() for t in range(trees)), np.zeros(len(v), bool)
        for t in range(trees):
            read |= same(t, level if entries < wanted or level == ann.SYMBOLS else deeper)
            entries += same(t, level).sum() - same(t, deeper).sum() if entries < wanted else 0
        read &= ids != ids[j]
        near = sorted((-float(c), int(i)) for c, i in zip(ann.cosine(v[[j]], v[read]), ids[read]))[:k]
        out[int(ids[j])] = (int(read.sum()), [i for _, i in near])
    return out


@pytest.mark.parametrize("deal, part", [(0, 1 << 20), (1, 1 << 20), (2, 40)])
def test_forest_reads_what_the_rule_says(spark, monkeypatch, deal, part):
    """The same rows at any dealing: whole trees, parts of one or two symbols with fallback, arrays in slices."""
    turn = np.random.default_rng(12)
    made = turn.standard_normal((400, 6)) + 0.7
    rows = [(k, v.tolist()) for k, v in enumerate(made)]
    monkeypatch.setattr(ann, "BLOCK", 90)
    monkeypatch.setattr(ann, "SLICE", part)
    monkeypatch.setattr(ann, "ASKED", 3)
    table = spark.createDataFrame(rows, "id long, vector array<double>")
    got = ann.nearest(table.where("id % 50 = 0"), table, 5, trees=6, wanted=120, deal=deal).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], (r["rows_read"], []))[1].append(r["vec_id"])
    assert found == plain_forest(rows, 5, 6, 120)


# -- op4


def test_language(docs, rows, empty):
    got = langid.op4_langid(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    lang = {r[0]: r for r in rows}
    right = total = 0
    for r in got:
        text = lang[r["doc_id"]][1]
        assert r["held_out"] == (crc(r["doc_id"]) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 160:
            right += r["lang_pred"] == lang[r["doc_id"]][2]
            total += 1
    assert right >= 0.9 * total
    assert langid.op4_langid(empty).count() == 0
    unknown = langid.op4_langid(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in unknown] == ["und"]
    one = langid.op4_langid(docs.withColumn("lang", F.lit("en"))).where("lang_pred <> 'und'").select("lang_pred", "score").distinct()
    assert [tuple(r) for r in one.collect()] == [("en", 1.0)]


# -- op5


def test_sharding_law(docs, rows, empty):
    got = sharding.op5_sharding(docs).toPandas()
    want = [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows]
    mine = got[["doc_id", "size", "text_crc32"]].astype(object).where(got[["doc_id", "size", "text_crc32"]].notna(), None)
    assert sorted(map(tuple, mine.to_numpy().tolist()), key=str) == sorted(map(tuple, pd.DataFrame(want, dtype=float).astype(object).where(pd.DataFrame(want).notna(), None).to_numpy().tolist()), key=str)
    counts = got.groupby("shard").size()
    assert set(counts.index) <= set(range(24)) and counts.max() - counts.min() <= 1 and len(counts) == 24
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert sharding.op5_sharding(empty).count() == 0


def test_ring_walk_is_the_walk_of_single_keys(spark):
    place, owner = sharding.ring(5, 8)
    keys = [(k, int(hashlib.md5(str(k).encode()).hexdigest()[:13], 16)) for k in range(400)]
    for slack in (0.0, 0.25):
        capacity = [400 // 5 + (s < 400 % 5) for s in range(5)] if not slack else [100] * 5
        room, want = list(capacity), {}
        for k, point in sorted(keys, key=lambda x: x[1]):
            at = int(np.searchsorted(place, point)) % len(place)
            while room[owner[at]] == 0:
                at = (at + 1) % len(place)
            room[owner[at]] -= 1
            want[k] = int(owner[at])
        rows = spark.createDataFrame([(k,) for k, _ in keys], "k long")
        got = {r["k"]: r["shard"] for r in sharding.assign(rows, "k", 5, slack, 8).collect()}
        home = {k: int(owner[np.searchsorted(place, p) % len(place)]) for k, p in keys}
        assert got == want
        assert sum(got[k] == home[k] for k in got) > 200


def test_sharding_of_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 7)
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    rows = spark.createDataFrame([(1, "a")] * 200 + [(k, "b") for k in range(400)] + [(None, None)] * 3, "k long, v string")
    got = sharding.assign(rows, "k", 7).toPandas()
    counts = got.groupby("shard").size()
    assert len(got) == 603 and counts.max() - counts.min() <= 1
    assert all(sorted(p["slot"]) == list(range(len(p))) for _, p in got.groupby("shard"))


# -- op6


def test_rates_meet_targets(docs, rows, labels, empty):
    got = mixing.op6_mixing(docs, labels).toPandas()
    assert len(got) == len(rows)
    p = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and (got["rate"] >= 0).all()
    tokens = {r[0]: len(words(r[1])) for r in rows}
    assert all(t == tokens[None if pd.isna(k) else int(k)] for k, t in zip(got["doc_id"], got["tokens"]))
    share = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    total = (p * (got["rate"] * got["tokens"]).to_numpy()[:, None]).sum(axis=0)
    assert np.allclose(total, share / share.sum() * got["tokens"].sum(), rtol=1e-6)
    assert ((got["taken"] - got["rate"]).abs() < 1).all()
    assert mixing.op6_mixing(empty, labels).count() == 0
    assert mixing.op6_mixing(docs, labels.limit(0)).select("rate").distinct().count() >= 1


def test_rates_with_a_floor_and_against_a_plain_solver(spark):
    turn = np.random.default_rng(8)
    p = turn.dirichlet([6, 0.5, 1], 500)
    tokens = turn.integers(0, 400, 500)
    rows = spark.createDataFrame(pd.DataFrame(np.column_stack([p]), columns=[f"p_{d}" for d in mixing.DOMAINS]).assign(tokens=tokens))
    for least, targets in ((0.0, {"plain": 0.9, "poor": 0.05, "toxic": 0.05}), (1.0, {"plain": 0.82, "poor": 0.06, "toxic": 0.12}), (0.0, {"plain": 0.1, "poor": 0.1, "toxic": 0.8})):
        moved = mixing.solve(rows, targets, least)
        r = np.maximum(least, 1 - p @ moved)
        share = np.array([targets[d] for d in mixing.DOMAINS])
        have = (p * tokens[:, None]).sum(axis=0)
        want = share * (max([tokens.sum(), *(have / share)]) if least else tokens.sum())
        slow = slow_rates(p, tokens, want, least)
        cost = lambda r: (((p * (r * tokens)[:, None]).sum(axis=0) - want) ** 2).sum()
        assert cost(r) <= cost(slow) + 1e-6 * tokens.sum() ** 2
        shown = rows.select(mixing.rate(moved, least).alias("r")).toPandas()["r"].to_numpy()
        assert np.allclose(np.sort(shown), np.sort(r))


def slow_rates(p, tokens, want, least):
    """Plain projected gradient on the squared residuals, in weights of tokens."""
    r, size = np.ones(len(p)), 1 / np.linalg.eigvalsh((p * tokens[:, None]).T @ p).max()
    for _ in range(4000):
        r = np.maximum(least, r - size * (p @ ((p * (r * tokens)[:, None]).sum(axis=0) - want)))
    return r


# -- op7


def slow_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fingerprints):
    root = {f: f for f in fingerprints}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 4:
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {f: top(f) for f in root}


def test_near_duplicates(docs, rows, empty):
    fp = [slow_fingerprint(r[1]) for r in rows]
    top = slow_components(set(fp))
    least = {}
    for r, f in zip(rows, fp):
        if r[0] is not None:
            least[top[f]] = min(least.get(top[f], r[0]), r[0])
    want = [(r[0], f"{f:016x}", least[top[f]]) for r, f in zip(rows, fp)]
    got = [tuple(r) for r in simhash.op7_simhash(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.op7_simhash(empty).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_no_link_is_lost_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 28)
    turn = np.random.default_rng(9)
    made = set()
    for _ in range(6):  # clouds around centres, and chains that leave them
        centre = int(turn.integers(0, 1 << 63, dtype=np.uint64))
        for _ in range(90):
            f = centre
            for b in turn.choice(64, turn.integers(0, 5), replace=False):
                f ^= 1 << int(b)
            made.add(f)
        for _ in range(30):
            for b in turn.choice(64, 4, replace=False):
                centre ^= 1 << int(b)
            made.add(centre)
    made |= {int(x) for x in turn.integers(0, 1 << 63, 300, dtype=np.uint64)} | {0, (1 << 64) - 1, (1 << 64) - 16}
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in made], "fp long")
    assert simhash.crowded(nodes).count() > 0
    edges = simhash.links(nodes)
    for u, v in edges.collect():
        assert ((u ^ v) & ((1 << 64) - 1)).bit_count() <= 4
    roots = {r["node"]: r["root"] for r in connected(edges).collect()}
    want, groups = slow_components(made), {}
    for f, t in want.items():
        groups.setdefault(t, set()).add(int(np.uint64(f).astype(np.int64)))
    mine = {}
    for f in (int(np.uint64(f).astype(np.int64)) for f in made):
        mine.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_pigeonring_keys_miss_nothing():
    turn = np.random.default_rng(10)
    for _ in range(3000):
        bits = turn.choice(64, turn.integers(0, 5), replace=False)
        a = turn.integers(0, 1 << 63, dtype=np.uint64)
        b = a
        for bit in bits:
            b ^= np.uint64(1) << np.uint64(bit)
        assert any(simhash.within_ring(np.array([a]), np.array([b]), s)[0] for s in range(5))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(40)} | {200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


# -- op8


def test_quality(docs, rows, labels, empty):
    got = quality.op8_quality(docs, labels).collect()
    assert len(got) == len(rows)
    held = [(r["score"], "***" not in (rows[r["doc_id"]][1] or "")) for r in got if r["held_out"] and r["doc_id"] is not None]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(s >= 0.3) == y for s, y in held]) >= 0.9
    assert quality.op8_quality(empty, labels).count() == 0
    assert [r[0] for r in quality.op8_quality(docs, labels.limit(0)).select("score").distinct().collect()] == [0.5]


def test_trees_are_walked_as_they_are_built():
    turn = np.random.default_rng(11)
    x = turn.standard_normal((3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    for k in range(50):
        margin = model.base
        for t in range(len(model.statistic)):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + int(x[k, model.statistic[t, node]] > model.threshold[t, node])
            margin += model.value[t, node - model.statistic.shape[1]]
        assert abs(model.score(x[k : k + 1])[0] - 1 / (1 + np.exp(-margin))) < 1e-12


# -- op10


def slow_scores(texts_, order, alpha):
    from collections import Counter

    made = [words(t) for t in texts_]
    grams = [Counter(tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w))) for w in made]
    total, size, out = sum(grams, Counter()), sum(map(len, made)), []
    for w, own in zip(made, grams):
        score = 0.0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                c = total[g] - own[g]
                if n == 1:
                    score += np.log((c if c > 0 else alpha) / max(1, size - len(w)))
                elif c > 0:
                    score += np.log(c / (total[g[:-1]] - own[g[:-1]]))
                    break
                else:
                    score += np.log(alpha)
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(docs, rows, empty, order):
    want = [(r[0], *s) for r, s in zip(rows, slow_scores([r[1] for r in rows], order, 0.4))]
    got = [tuple(r) for r in lm.backoff_scores(docs, order, block_bytes=20_000).collect()]
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, abs(b[2]))
    assert lm.op10_backoff(empty).count() == 0


def test_learned_in_one_task(spark):
    from pluvia.llm.columnar import learned

    rows = spark.range(0, 1000, 1, 7)
    assert learned(rows, lambda table: (table.num_rows, sum(table.column(0).to_pylist()))) == (1000, 499_500)
    assert learned(rows.orderBy("id").limit(10), lambda table: table.num_rows) == 10
    assert learned(rows.where("id < 0"), lambda table: table.num_rows) is None


def test_repeated_ids_lose_no_neighbour(spark):
    """Six equal rows of the asking id, and six others with its vector: five of those are nearest."""
    turn = np.random.default_rng(8)
    same = turn.normal(size=8).astype(np.float32).tolist()
    rows = [(50, same)] * 6 + [(60 + k, same) for k in range(6)]
    rows += [(200 + k, turn.normal(size=8).astype(np.float32).tolist()) for k in range(30)]
    got = ann.op3_ann(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).where("query_id = 50").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [60, 61, 62, 63, 64] and all(abs(r["score"] - 1) < 1e-12 for r in got)
