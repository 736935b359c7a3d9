"""Near-duplicate classes by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.llm.components import components
from layerflow.llm.training import stored

BITS = 64
SEED = 42


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit integer; 0 for a text without words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and the space with U+0009 to U+000D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash over word shingles, repeats included; null and wordless texts give 0."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return simhash(text)


def block_ranges(n_blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``n_blocks`` nearly equal blocks of a fingerprint."""
    edges = [i * BITS // n_blocks for i in range(n_blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def block_keys(fp: Column, max_bits: int, n_blocks: int) -> Column:
    """The keys on which fingerprints at ``max_bits`` or fewer differing bits must meet.

    Of ``n_blocks`` blocks, ``max_bits`` differing bits spoil at most ``max_bits``, so every
    close pair agrees on some choice of ``n_blocks - max_bits`` blocks.
    """
    ranges = block_ranges(n_blocks)
    keys = []
    for n, chosen in enumerate(combinations(ranges, n_blocks - max_bits)):
        mask = 0
        for low, width in chosen:
            mask |= ((1 << width) - 1) << low
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(
            F.struct(F.lit(n).cast("byte").alias("part"), fp.bitwiseAND(F.lit(signed)).alias("bits"))
        )
    return F.array(*keys)


def close_pairs(
    prints: DataFrame, max_bits: int = 2, n_blocks: int = 4, crowded: int = 64
) -> DataFrame:
    """Links ``a, b`` among the distinct ``fp`` of ``prints`` that connect all close pairs.

    Fingerprints are joined on blocks and kept when their Hamming distance is at most
    ``max_bits``. A block key with more than ``crowded`` fingerprints (near copies of one text)
    is not joined with itself, which would emit all its pairs. There, each fingerprint lists the
    values that differ from it in at most ``max_bits // 2`` bits: two fingerprints are close
    exactly if they list a common value (``max_bits`` is even), and a value is listed by few
    fingerprints, whatever the size of the group. They are linked to their smallest. So no
    link is lost in terms of what is connected, and the work is linear in the group.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    fp = F.col("fp")
    keyed = prints.select(F.explode(block_keys(fp, max_bits, n_blocks)).alias("key"), "fp")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = keyed.join(sizes, "key")
    few = keyed.where(F.col("n") <= crowded).select("key", "fp")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    joined = (
        few.join(few.withColumnRenamed("fp", "other"), "key")
        .where((F.col("fp") < F.col("other")) & (distance <= max_bits))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    # any key that a crowded group shares will do for its inner links, so no key is needed below
    many = keyed.where(F.col("n") > crowded).select("fp").distinct()
    masks = [0]
    for flips in range(1, max_bits // 2 + 1):
        for chosen in combinations(range(BITS), flips):
            mask = sum(1 << bit for bit in chosen)
            masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    near = F.transform(F.array(*map(F.lit, masks)), lambda mask: fp.bitwiseXOR(mask))
    starred = (
        many.select(F.explode(near).alias("value"), "fp")
        .groupBy("value")
        .agg(F.sort_array(F.collect_set("fp")).alias("group"))  # at most len(masks) of them
        .where(F.size("group") > 1)
        .select(F.col("group")[0].alias("a"), F.explode(F.slice("group", 2, len(masks))).alias("b"))
    )
    return joined.union(starred).distinct()


def simhash_classes(
    docs: DataFrame,
    *,
    shingle: int = 3,
    max_bits: int = 2,
    n_blocks: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, representative`` of every row of ``docs``.

    ``component_id`` is the smallest id among rows whose fingerprints are connected by links of
    at most ``max_bits`` bits. Rows with a null id take part but give no id, so it is null where
    all are. ``representative`` tells one row of each class: the smallest id, null ids last,
    then the smallest ``text_hash``; rows equal in both are equal and all marked. Null and empty
    texts have fingerprint 0. Repeated rows come back as often as they came.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
            fingerprint(F.col(text_col), shingle).alias("fp"),
        ),
        "simhash-rows",
    )
    rank = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("id"),
        F.col("text_hash").alias("hash"),
    )
    prints = stored(rows.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-prints")
    links = stored(close_pairs(prints.select("fp"), max_bits, n_blocks), "simhash-links")
    linked = components(links)  # node, component
    classes = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    firsts = classes.groupBy("component").agg(F.min("first").alias("class_first"))
    named = classes.join(firsts, "component").select("fp", "class_first")
    return rows.join(named, "fp").select(
        "doc_id",
        "text_hash",
        "fp",
        F.col("class_first.id").alias("component_id"),
        rank.eqNullSafe(F.col("class_first")).alias("representative"),
    )


def drop_near_copies(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each class of near copies, with the columns of ``docs``.

    The row that stays is the one ``simhash_classes`` marks; of repeated rows (equal id and
    text, other columns perhaps unequal) the one whose other columns have the least hash, whatever
    the partitioning. Maps and variants do not count for that.
    """
    names = ["__lf_no_id", "__lf_id", "__lf_hash"]
    chosen = (
        simhash_classes(docs, shingle=shingle, max_bits=max_bits)
        .where("representative")
        .select(
            F.col("doc_id").isNull().alias(names[0]),
            # rows without an id are told apart by their text alone
            F.coalesce("doc_id", "text_hash").alias(names[1]),
            F.col("text_hash").alias(names[2]),
        )
    )
    hashed = F.xxhash64("text")
    marked = docs.withColumns(
        {
            names[0]: F.col("doc_id").isNull(),
            names[1]: F.coalesce("doc_id", hashed),
            names[2]: hashed,
        }
    )
    kept = marked.join(chosen, names, "left_semi")
    unhashed = (T.MapType, T.VariantType)
    others = [f.name for f in docs.schema if not isinstance(f.dataType, unhashed)]
    rank = F.xxhash64(*(x for c in others for x in (F.col(c).isNull(), F.col(c))))
    one = F.min_by(F.struct(*docs.columns), rank).alias("row")
    return kept.groupBy(*names).agg(one).select("row.*")
