"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is its words (white space apart, lower case) with their counts as weights. For sample k a word has
r and c from a Gamma(2, 1) distribution and b from a uniform one, all of them functions of the hash of word
and k alone. With weight w its level is t = floor(ln w / r + b) and its value c * exp(-r * (t - b + 1)); the word
of least value is drawn, and word and level are the sample. Two texts draw the same sample with the probability of
their generalised Jaccard similarity, sum of least weights by sum of largest, so the share of equal samples
estimates it; with 24 samples its standard error is 0.10 at most.

``least`` packs value and identity into one number per sample, so that drawing is a plain minimum, which Spark
combines before it shuffles. Words of a text are counted inside its row, on sorted hashes.

A null text is an empty one. A text without words has the fingerprint of zeros, so two of them are alike.
Repeated rows are worked out once and expanded at the end. An empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.ranks import numbered

SAMPLES = 24
LOW = 0xFFFFFFFF
STEPS = 2.0**31 - 1


def weighted_words(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, word, weight): a hash per distinct word of ``text`` and the logarithm of its count.

    A text without words has one row of nulls.
    """
    words = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    hashes = texts.select(*keys, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))).alias("hashes"))
    known = hashes.withColumns({"word": F.array_distinct("hashes"), "n": F.size("hashes")})
    places = F.sequence(F.lit(1), F.greatest("n", F.lit(1)))
    # the first place of each distinct hash; all places where none repeats
    turns = F.filter(places, lambda i: (i == 1) | (F.get("hashes", i - 1) != F.get("hashes", i - 2)))
    first = F.when(F.col("n") == F.size("word"), places).otherwise(turns)
    runs = known.withColumn("first", F.when(F.col("n") > 0, first)).drop("hashes")
    ends = F.concat(F.slice("first", 2, F.greatest("n", F.lit(1))), F.array(F.col("n") + 1))
    rows = runs.withColumn("end", ends).select(*keys, F.inline_outer(F.arrays_zip("word", "first", "end")))
    return rows.select(*keys, "word", F.ln((F.col("end") - F.col("first")).cast("double")).alias("weight"))


def _uniform(bits: Column) -> Column:
    """A number in (0, 1) from 32 bits."""
    return (bits + 0.5) * F.lit(2.0**-32)


def least(word: Column, weight: Column, k: int) -> Column:
    """Sample ``k`` of a word: its value in the upper half, in steps that keep the order, its identity in the lower."""
    shape, scale, level = (F.xxhash64(word.bitwiseXOR(F.lit(3 * k + j + 1))) for j in range(3))

    def gamma(bits: Column) -> Column:
        return -F.ln(_uniform(F.shiftrightunsigned(bits, 32)) * _uniform(bits.bitwiseAND(F.lit(LOW))))

    r, c, b = gamma(shape), gamma(scale), _uniform(F.shiftrightunsigned(level, 32))
    t = F.floor(weight / r + b)
    value = c * F.exp(-r * (t - b + 1))
    identity = level.bitwiseXOR(t).bitwiseAND(F.lit(LOW))
    return F.shiftleft(F.floor(F.sqrt(value / (value + 1)) * STEPS), 32).bitwiseOR(identity)


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, signature) for each text; ``keys`` tell the texts apart."""
    rows = weighted_words(texts, keys)
    drawn = rows.groupBy(*keys).agg(*[F.min(least(F.col("word"), F.col("weight"), k)).alias(f"_s{k}") for k in range(samples)])
    ids = [F.coalesce(F.col(f"_s{k}").bitwiseAND(F.lit(LOW)), F.lit(0).cast("long")) for k in range(samples)]
    return drawn.select(*keys, F.array(*ids).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("double"))
    return F.aggregate(equal, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def spelled(signature: Column) -> Column:
    """A signature as text, eight hexadecimal digits a sample."""
    return F.array_join(F.transform(signature, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def op13_fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and its likeness to that and to the
    next document. Documents lie by doc_id, null first, then by the digest of doc_id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text), 256))
    base = docs.select(key.alias("key"), "doc_id", text.alias("text"))
    each = base.groupBy("key", "doc_id", F.char_length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    placed = numbered(each.withColumn("all", F.lit("")), "all", ["doc_id", "key"], ["key", "doc_id", "n_chars", "copies"])
    placed = placed.drop("all")
    before = placed.select(
        F.expr("(pos + 1) % n_group").alias("pos"), F.col("key").alias("to"), F.expr("n_chars div 2").cast("int").alias("take")
    )
    whole = base.select("key", "text").dropDuplicates(["key"]).join(placed.join(before, "pos"), "key")
    sent = whole.select(F.col("to").alias("key"), F.expr("substring(text, 1, take)").alias("lead"))
    half = F.expr("cast(n_chars div 2 as int)")
    head = F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))")
    own = F.concat(head, F.substring(F.col("text"), F.lit(1), half))
    versions = F.array(
        F.struct(F.lit(0).alias("version"), F.col("text")),
        F.struct(F.lit(1).alias("version"), F.concat(head, F.col("lead")).alias("text")),
        F.when(F.col("copies") > 1, F.struct(F.lit(2).alias("version"), own.alias("text"))),
    )
    facts = ["key", "doc_id", "n_chars", "copies", "pos", "n_group"]
    texts = whole.join(sent, "key").select(*facts, F.explode(F.array_compact(versions)).alias("v"))
    texts = texts.select(*facts, "v.version", "v.text", F.sha2("v.text", 256).alias("sha256"))
    signed = signatures(texts, [*facts, "version", "sha256"], samples)
    # every original also goes to the document before it
    targets = F.when(F.col("version") == 0, F.array(F.col("pos"), F.expr("(pos + n_group - 1) % n_group"))).otherwise(F.array("pos"))
    rows = signed.select("*", F.posexplode(targets).alias("as_next", "at"))

    def of(version: int, as_next: int, *names: str) -> Column:
        chosen = (F.col("version") == version) & (F.col("as_next") == as_next)
        return F.max(F.when(chosen, F.struct(*names)))

    joined = rows.groupBy("at").agg(
        of(0, 0, "doc_id", "n_chars", "copies", "signature").alias("own"),
        of(1, 0, "sha256", "signature").alias("last"),
        of(2, 0, "sha256", "signature").alias("inner"),
        of(0, 1, "signature").alias("following"),
    )
    # of equal rows all but the last have the next one as their next document
    copy = joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("own.copies"))).alias("copy"))
    ends = F.col("copy") == F.col("own.copies")
    edited = F.when(ends, F.col("last")).otherwise(F.col("inner"))
    following = F.when(ends, F.col("following.signature")).otherwise(F.col("own.signature"))
    return copy.select(
        "own.doc_id",
        "own.n_chars",
        edited["sha256"].alias("edited_sha256"),
        spelled(F.col("own.signature")).alias("fingerprint"),
        spelled(edited["signature"]).alias("edited_fingerprint"),
        likeness(F.col("own.signature"), edited["signature"]).alias("near_edited"),
        likeness(F.col("own.signature"), following).alias("near_next"),
    )
