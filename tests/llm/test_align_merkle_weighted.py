"""Operators 11 to 13 against brute force, with the awkward rows of each."""

import bisect
import collections
import functools
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pluvia.llm import align, merkle, weighted
from pluvia.llm.bpe import printable_bytes
from pluvia.llm.ranks import numbered

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, key string, pos string, block string, row string, a string, proof string"
ODD = [
    "a ", " ", "   ", "a  b", "\n\n x\t y", "▁x", "日本語 😀 é É", "<s> </s> <|endoftext|> <unk>", "z" * 3000, "\x00a\x01",
    "  lead", "trail   ", "ﬁ ½ Å", "", None, " x y", "don't 'll we're", "a\r\nb", "é" * 50 + " " + "ᚠ" * 40, "the the the the",
]


def texts():
    turn = np.random.default_rng(3)
    words = [bytes(turn.integers(97, 123, turn.integers(1, 9)).tolist()).decode() for _ in range(60)]
    plain = [" ".join(turn.choice(words, turn.integers(1, 120))) for _ in range(80)]
    return plain + ODD + plain[:10] + [" ".join(plain) * 6]


@pytest.fixture(scope="module")
def rows():
    out = [(k, t, f"s{k % 3}", ["en", "de", None, "en", ""][k % 5], len(t or ""), "k", "p", "b", "r", "a", "x") for k, t in enumerate(texts())]
    extra = [(None, "no id", None, "en", None, *"kpbrax"), (None, "no id", None, "en", None, *"kpbrax"), (7, "other text", "s", "en", None, *"kpbrax")]
    return out + extra + [out[3], out[3], out[50]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- alignment


@functools.cache
def tokenizers():
    coder = Tokenizer.from_file(A)
    coder.encode_special_tokens = True
    return coder, sentencepiece.SentencePieceProcessor(model_file=B)


@functools.cache
def slow_groups(text):
    if not text:
        return []
    coder, pieces = tokenizers()
    byte_of, whole = printable_bytes(), " " + text
    a = coder.encode(whole, add_special_tokens=False).ids
    b = pieces.encode(text)
    of_a = [bytes(byte_of[c] for c in coder.id_to_token(i)) for i in a]
    of_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(of_a) == b"".join(of_b) == whole.encode():
        return []
    ends = [np.cumsum([len(w) for w in side]).tolist() for side in (of_a, of_b)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in cuts]
    for side, (ids, where) in enumerate(zip((a, b), ends)):
        for i, end in zip(ids, where):
            groups[bisect.bisect_left(cuts, end)][side].append(i)
    return groups


def slow_alignments(rows):
    made = [(r[0], slow_groups(r[1])) for r in rows]
    counts = collections.Counter(pair for _, g in made for pair in {(a, b) for x, y in g for a in x for b in y})
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    for doc, groups in made:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


@pytest.mark.parametrize("crowded, block", [(256, 3), (1, 1)])
def test_alignment_equals_brute_force(docs, rows, monkeypatch, crowded, block):
    """Small and crowded groups, one block and many."""
    monkeypatch.setattr(align, "CROWDED", crowded)
    monkeypatch.setattr(align, "CHUNKS_PER_BLOCK", block)
    got = align.op11_align(docs, A, B).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(slow_alignments(rows), key=repr)


def test_alignment_keeps_groups_and_columns(docs, rows):
    made = align.alignments(docs, A, B, spelled=True).select("row.*", "groups", "groups_sha256").collect()
    assert len(made) == len(rows)
    for r in made:
        assert r["key"] == "k" and r["block"] == "b" and r["a"] == "a"
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")


def test_alignment_of_nothing(empty):
    assert align.op11_align(empty, A, B).count() == 0


def test_pairs_of_a_long_run_without_shared_ends():
    """Distinct ids with multiplicity give the same links as all pairs, in pieces of bounded size."""
    import pyarrow as pa

    turn = np.random.default_rng(1)
    left = pa.table({"doc": np.zeros(700, np.int64), "id": turn.integers(0, 40, 700).astype(np.int32), "group": np.zeros(700, np.int64)})
    right = pa.table({"doc": np.zeros(900, np.int64), "id": turn.integers(0, 30, 900).astype(np.int32), "group": np.zeros(900, np.int64)})
    got = collections.Counter()
    for part in align._linked(left, right):
        assert part.num_rows <= align.SLICE_PAIRS
        for a, b, n in zip(part["a"].to_pylist(), part["b"].to_pylist(), part["links"].to_pylist()):
            got[a, b] += n
    want = collections.Counter((a, b) for a in left["id"].to_pylist() for b in right["id"].to_pylist())
    assert got == want


# -- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sized(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def slow_tree(leaves, fanout):
    """The root, and for each leaf its siblings level by level."""
    nodes, proofs, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place - place % fanout
            proofs[k].append((nodes[first:place], nodes[place + 1 : first + fanout]))
            at[k] = place // fanout
        nodes = [sha("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def slow_manifest(rows, fanout):
    groups = collections.defaultdict(list)
    for r in rows:
        doc, text, source, lang, n = r[:5]
        leaf = sha("".join(map(sized, (doc, source, lang, n, text))))
        touched = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        changed = sha("".join(map(sized, (doc, source, lang, n + 1, text)))) if touched else leaf
        groups[lang].append((doc, leaf, changed))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = slow_tree([x[1] for x in groups[lang]], fanout)
    root, above = slow_tree([trees[lang][0] for lang in order], fanout)
    for lang, upper in zip(order, above):
        subroot, proofs = trees[lang]
        for (doc, leaf, changed), lower in zip(groups[lang], proofs):
            node = changed
            for left, right in lower + upper:
                node = sha("".join([*left, node, *right]))
            proof = "".join("".join(left + right) for left, right in lower + upper)
            yield doc, leaf, subroot, root, sha(proof), node, node == root


@pytest.mark.parametrize("fanout, levels", [(2, 10), (2, 2), (3, 1)])
def test_manifest_equals_brute_force(docs, rows, monkeypatch, fanout, levels):
    """One block, and butterflies of several rounds with blocks that lack partners."""
    plain = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda *given: plain(*given, fanout=fanout, block_levels=levels))
    monkeypatch.setattr(merkle, "ROUNDS_PER_PLAN", 2)
    got = merkle.op12_merkle(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(slow_manifest(rows, fanout), key=repr)


def test_manifest_of_one_row_and_of_none(spark, docs, empty):
    assert merkle.op12_merkle(empty).count() == 0
    (one,) = merkle.op12_merkle(docs.where("doc_id = 8")).collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha("")


def test_manifest_keeps_columns_of_any_name(docs, rows):
    made = merkle.manifest(docs, merkle.leaf_of(F.col("text")), F.col("lang"), [F.col("doc_id")])
    assert made.select("row.*").exceptAll(docs).count() == 0 and made.count() == len(rows)


def test_tampering_shows(docs):
    made = merkle.manifest(docs, merkle.leaf_of(F.col("text")), F.col("lang"), [F.col("doc_id")])
    held = made.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("whole"), (merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).alias("bent"))
    assert held.where("not whole or bent").count() == 0


def test_places_by_ranges(spark):
    rows = [(g, k // 3, k) for g in ("x", "y") for k in range(200)] + [("x", None, -1)]
    got = numbered(spark.createDataFrame(rows, "g string, o long, id long").repartition(7), "g", ["o", "id"], ["o", "id"]).collect()
    for g in ("x", "y"):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["pos"])
        assert [r["pos"] for r in mine] == list(range(len(mine))) and {r["n_group"] for r in mine} == {len(mine)}
        assert [r["id"] for r in mine] == sorted(r["id"] for r in mine)


# -- weighted sampling


def counts_of(text):
    return collections.Counter((text or "").lower().split())


def similarity(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def test_words_and_weights(spark, docs):
    ided = docs.where("text is not null and doc_id is not null").dropDuplicates(["doc_id"])
    got = weighted.weighted_words(ided.select("doc_id", "text"), ["doc_id"])
    got = got.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.round(F.exp("weight"), 6))).alias("n")).collect()
    want = {r["doc_id"]: sorted(counts_of(r["text"]).values()) for r in ided.collect()}
    assert {r["doc_id"]: [int(n) for n in r["n"]] for r in got} == want


def test_fingerprints_and_their_texts(docs, rows):
    got = sorted(weighted.op13_fingerprint(docs).collect(), key=repr)
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{'-' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest())
    order = sorted(rows, key=key)
    want = []
    for r, after in zip(order, order[1:] + order[:1]):
        text, half = r[1] or "", len(r[1] or "") // 2
        edited = text[: len(text) - half] + (after[1] or "")[:half]
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
    of_text = collections.defaultdict(set)
    for r, made in zip(sorted(rows, key=lambda r: repr((r[0], len(r[1] or "")))), sorted(got, key=lambda r: repr((r[0], r[1])))):
        if rows.count(r) == 1 and r[0] not in (7, None):
            of_text[r[1] or ""].add(made["fingerprint"])
    assert all(len(f) == 1 for f in of_text.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert weighted.op13_fingerprint(docs.limit(0)).count() == 0


def test_collisions_estimate_the_generalised_jaccard(spark):
    """Pairs of bags with unequal weights, and one of weights doubled: within four standard errors of the exact similarity."""
    turn, samples = np.random.default_rng(11), 64
    bags = [({f"w{k}": 1 for k in range(60)}, {f"w{k}": 2 for k in range(60)})]
    for _ in range(40):
        a = {f"w{k}": int(n) for k, n in enumerate(turn.integers(1, 30, 40))}
        b = {w: max(1, int(n * turn.uniform(0.2, 3))) for w, n in a.items() if turn.random() < 0.8} | {"own": int(turn.integers(1, 60))}
        bags.append((a, b))
    text = lambda bag: " ".join(w for w, n in bag.items() for _ in range(n))
    rows = [(k, side, text(bag)) for k, pair in enumerate(bags) for side, bag in enumerate(pair)]
    signed = weighted.signatures(spark.createDataFrame(rows, "k long, side long, text string"), ["k", "side"], samples)
    both = signed.groupBy("k").pivot("side", [0, 1]).agg(F.first("signature"))
    off = []
    for r in both.select("k", weighted.likeness(F.col("0"), F.col("1")).alias("near")).collect():
        a, b = (collections.Counter(bag) for bag in bags[r["k"]])
        exact = similarity(a, b)
        off.append((r["near"] - exact) / np.sqrt(exact * (1 - exact) / samples))
    assert np.abs(off).max() < 4 and abs(np.mean(off)) < 0.8
