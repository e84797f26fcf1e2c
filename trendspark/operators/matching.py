"""Exact substring matching of many keywords against many texts.

The reference tests every keyword against every post with ``k in text``
inside a Python UDF and then joins on ``array_contains`` (a nested-loop
join).  Here the same relation — keyword k is a substring of text s — is
computed as an equi-join on gram hashes, so Spark can hash-join it and the
keyword list never passes through the driver.

Gram index (exact, no sampling):
  * keywords are split into length tiers; tier t uses grams of G_t bytes and
    a stride S_t with G_t + S_t - 1 <= every keyword length in the tier;
  * a text contributes the grams that start at byte positions p ≡ 0 (mod S_t);
  * a keyword contributes its S_t grams that start at offsets j = 0 … S_t-1.
  If k occurs at position P of s, exactly one offset j makes P + j a
  multiple of S_t, and the text gram at p = P + j equals the keyword gram at
  offset j.  So every occurrence yields one candidate (p, j); a candidate is
  kept only if the bytes of s at p - j equal k, which removes hash
  collisions and chance gram hits.  Texts thus emit ~n/S_t grams per tier
  and no occurrence is missed.

Matching runs on UTF-8 bytes: a valid UTF-8 keyword occurs in a valid UTF-8
text at some byte offset exactly when it occurs as a character substring,
and byte slicing is O(1) where character slicing is not.

Scale: the keyword-gram table is broadcast only when its measured size is
below ``broadcast_max_bytes``.  A larger table is split by keyword hash into
the fewest chunks that each fit, and the texts are scanned once per chunk
with that chunk broadcast (every chunk is processed; the results are a
union, so nothing is dropped).  Re-scanning text a few times is far cheaper
than shuffling one row per text gram.  Only beyond ``max_passes`` chunks
does the join become a shuffle join on the gram hash (AQE splits skewed
gram partitions); its rows carry ids and positions, not texts, and the texts
are joined back by id once to verify.  Up to there the text side is not
shuffled before candidates are verified; de-duplication of (text, keyword) pairs starts as a partial
aggregate inside the scan stage, because all candidates of one text are
produced in the same task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (minimum keyword length in bytes, gram length, stride).  gram 0 means
# "the shortest keyword length found in the tier" (stride 1, every position).
# Long keywords use long strides (text work ~ n/stride, keyword rows ~ stride
# per keyword): passages of 72+ bytes cost the text side n/64 grams instead
# of n/8.  Keywords of 1–5 bytes get one exact-length tier each: their gram
# is the whole keyword, so every candidate is a true hit (measured faster
# than one shared short tier, whose 1-byte grams produce many false
# candidates).  A tier is only generated when keywords of its lengths exist.
DEFAULT_TIERS: tuple[tuple[int, int, int], ...] = (
    (72, 8, 64), (40, 8, 32), (15, 8, 8), (6, 4, 3),
    (5, 5, 1), (4, 4, 1), (3, 3, 1), (2, 2, 1), (1, 1, 1))
# Largest keyword-gram table (or chunk of it) we are willing to broadcast,
# and the most text passes we accept before falling back to a shuffle join.
DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024
DEFAULT_MAX_PASSES = 16
_ROW_OVERHEAD = 48  # bytes per keyword-gram row besides the keyword itself


@dataclass(frozen=True)
class Tier:
    index: int
    gram: int
    stride: int


def _tier_of(length: Column, tiers) -> Column:
    expr = F.lit(None).cast("int")
    for i in reversed(range(len(tiers))):
        expr = F.when(length >= tiers[i][0], F.lit(i)).otherwise(expr)
    return expr


def plan_tiers(keywords: DataFrame, kw_col: str = "keyword",
               tiers=DEFAULT_TIERS) -> tuple[list[Tier], int]:
    """Measure the keyword table (one small aggregate) and fix the tiers.

    Returns the tiers that hold keywords and the estimated size in bytes of
    the keyword-gram table.  The aggregate returns at most len(tiers) rows.
    """
    klen = F.octet_length(F.col(kw_col))
    stats = (keywords.select(_tier_of(klen, tiers).alias("t"), klen.alias("n"))
             .where(F.col("t").isNotNull())
             .groupBy("t").agg(F.count("*").alias("rows"), F.min("n").alias("min_len"),
                               F.sum("n").alias("bytes"))
             .collect())
    out, size = [], 0
    for r in sorted(stats, key=lambda r: r["t"]):
        min_len, gram, stride = tiers[r["t"]]
        if gram <= 0:
            gram, stride = int(r["min_len"]), 1
        if gram + stride - 1 > max(min_len, 1) and tiers[r["t"]][1] > 0:
            raise ValueError(f"tier {tiers[r['t']]} cannot guarantee exact matches")
        out.append(Tier(int(r["t"]), gram, stride))
        size += stride * (int(r["bytes"]) + _ROW_OVERHEAD * int(r["rows"]))
    return out, size


def keyword_grams(keywords: DataFrame, plan: list[Tier], kw_col: str = "keyword",
                  tiers=DEFAULT_TIERS) -> DataFrame:
    """Keyword side of the index: (h, j, klen, kbin) per offset j.

    The keyword travels only as its UTF-8 bytes (needed for verification);
    matched rows decode it back, so the broadcast holds each keyword once.
    """
    kbin = F.encode(F.col(kw_col), "UTF-8")
    tier = _tier_of(F.octet_length(F.col(kw_col)), tiers)
    gram_len = F.lit(None).cast("int")
    stride = F.lit(None).cast("int")
    for t in plan:
        gram_len = F.when(F.col("t") == t.index, F.lit(t.gram)).otherwise(gram_len)
        stride = F.when(F.col("t") == t.index, F.lit(t.stride)).otherwise(stride)
    base = (keywords.select(F.col(kw_col).alias("keyword"), kbin.alias("kbin"), tier.alias("t"))
            .where(F.col("t").isin([t.index for t in plan])))
    return (base.select("*", F.explode(F.sequence(F.lit(0), stride - 1)).alias("j"))
            .select(F.xxhash64(F.col("t"), F.substring("kbin", F.col("j") + 1, gram_len)).alias("h"),
                    "j", F.octet_length("kbin").alias("klen"), "kbin"))


# Gram start positions are generated per chunk of this many bytes, so one
# very long text never materialises one huge position array.
_CHUNK = 1 << 16


def _text_chunks(nbytes: Column) -> Column:
    """Chunk indexes 0 … (n-1) // _CHUNK of a text (empty for an empty text)."""
    n = nbytes.cast("bigint")
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / _CHUNK).cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))


def substring_candidates(texts: DataFrame, keywords: DataFrame, text_col: str,
                         kw_col: str = "keyword", carry=(), tiers=DEFAULT_TIERS,
                         broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                         max_passes: int = DEFAULT_MAX_PASSES,
                         token_masks: tuple[str, str] | None = None) -> DataFrame:
    """Every occurrence of every keyword: rows (carry..., keyword).

    A keyword occurring several times in a text gives several rows; use
    :func:`substring_matches` for distinct pairs.  Null or empty keywords
    never match (an empty keyword would be a substring of everything).

    ``token_masks`` = (start mask column, end mask column), built with
    ``functions.token_start_mask`` / ``token_end_mask`` from the same raw
    text, switches to whole-token matching: an occurrence counts only when
    it starts where a token starts and ends where a token ends (it may span
    several tokens: 'thelionking' matches "The Lion King" but 'here' does
    not match "where").  The default is plain substring matching (T10).
    """
    valid = (keywords.select(F.col(kw_col).alias("keyword"))
             .where(F.col("keyword").isNotNull() & (F.octet_length("keyword") > 0)))
    # Stats on the distinct list: a caller may repeat its keywords (once per
    # day, say), and the table that is broadcast holds each of them once.
    kws = valid.distinct()
    plan, size = plan_tiers(kws, "keyword", tiers)
    carry = list(carry)
    if not plan:
        # no usable keyword: an empty, typed result (no text is scanned)
        return texts.select(*carry, F.lit(None).cast("string").alias("keyword")).where(F.lit(False))
    grams = keyword_grams(kws, plan, "keyword", tiers)
    passes = max(1, -(-size // max(broadcast_max_bytes, 1)))
    if passes == 1 and size <= broadcast_max_bytes:
        return _probe(texts, F.broadcast(grams), plan, text_col, carry, token_masks)
    if passes <= max_passes:
        chunk = F.pmod(F.xxhash64("kbin"), F.lit(passes))
        parts = [_probe(texts, F.broadcast(grams.where(chunk == i)), plan, text_col, carry, token_masks)
                 for i in range(passes)]
        return reduce(DataFrame.unionAll, parts)
    if not carry:
        raise ValueError("so many keywords are joined by a shuffle, which needs carry columns that identify the texts")
    return _probe(texts, grams, plan, text_col, carry, token_masks, shuffled=True)


def _may_start(stride: Column, token_masks) -> Column:
    """Whether a keyword can start at position p: in a tier of stride 1 its only
    gram is its start, so with whole tokens other places are left out unhashed."""
    if not token_masks:
        return F.lit(True)
    return (stride > 1) | (F.substring("_smask", F.col("p") + 1, 1) == F.lit(b"#").cast("binary"))


def _probe(texts: DataFrame, grams: DataFrame, plan: list[Tier], text_col: str,
           carry: list[str], token_masks: tuple[str, str] | None = None, shuffled: bool = False) -> DataFrame:
    """Explode the text grams, hash-join the keyword grams, verify bytes.

    ``shuffled``: the gram join is a shuffle join, so its rows carry no text;
    candidates meet the texts again by the ``carry`` columns to be verified.

    Per text: one row per 64 KiB chunk, then one row per tier present, then
    one row per gram start p of that tier inside the chunk (the multiples of
    S_t in [chunk·C, min((chunk+1)·C, n - G_t + 1))).
    """
    gram_len = F.lit(None).cast("int")
    stride = F.lit(None).cast("int")
    for t in plan:
        gram_len = F.when(F.col("tier") == t.index, F.lit(t.gram)).otherwise(gram_len)
        stride = F.when(F.col("tier") == t.index, F.lit(t.stride)).otherwise(stride)
    # A null text becomes empty bytes (no grams, so no rows).  Keeping sbin
    # non-nullable also stops Catalyst from inferring an IS NOT NULL filter
    # from the join condition and pushing it below the projection, which
    # would evaluate the whole text expression twice per row.
    sbin = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"").cast("binary"))
    n = F.col("_n").cast("bigint")
    lo = F.col("_chunk") * _CHUNK
    first = F.ceil(lo / stride).cast("bigint") * stride
    last = F.least(lo + _CHUNK, n - gram_len + 1) - 1
    starts = F.when(first <= last, F.sequence(first, last, stride.cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))
    masks = []
    if token_masks:
        # masks as bytes (ASCII '#'/'.'): O(1) lookups by position
        masks = [F.coalesce(F.encode(F.col(c), "UTF-8"), F.lit(b"").cast("binary")).alias(a)
                 for c, a in zip(token_masks, ("_smask", "_emask"))]
    extra = ["_smask", "_emask"] if token_masks else []
    side = (texts.select(*carry, sbin.alias("sbin"), *masks)
            .select("*", F.octet_length("sbin").alias("_n"))
            .select("*", F.explode(_text_chunks(F.col("_n"))).alias("_chunk"))
            .select("*", F.explode(F.array(*[F.lit(t.index) for t in plan])).alias("tier"))
            .select("*", F.explode(starts).alias("p"))
            .where(_may_start(stride, token_masks))
            .select(*carry, "sbin", *extra, "p",
                    F.xxhash64(F.col("tier"), F.substring("sbin", F.col("p") + 1, gram_len)).alias("h")))
    if shuffled:
        found = (side.select(*carry, "p", "h").join(grams, "h").where("p >= j")
                 .select(*carry, (F.col("p") - F.col("j") + 1).alias("_start"), "klen", "kbin").distinct())
        back = texts.select(*[F.col(c).alias(f"_t_{c}") for c in carry], sbin.alias("sbin"), *masks)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in carry])
        ok = F.substring(F.col("sbin"), F.col("_start"), F.col("klen")) == F.col("kbin")
        if token_masks:
            mark = F.lit(b"#").cast("binary")
            ok = (ok & (F.substring(F.col("_smask"), F.col("_start"), 1) == mark)
                  & (F.substring(F.col("_emask"), F.col("_start") + F.col("klen") - 1, 1) == mark))
        return found.join(back, same).where(ok).select(*carry, F.decode("kbin", "UTF-8").alias("keyword"))
    start = side["p"] - grams["j"] + 1  # 1-based start of the occurrence
    cond = ((side["h"] == grams["h"]) & (side["p"] >= grams["j"])
            & (F.substring(side["sbin"], start, grams["klen"]) == grams["kbin"]))
    if token_masks:
        mark = F.lit(b"#").cast("binary")
        cond = (cond & (F.substring(side["_smask"], start, 1) == mark)
                & (F.substring(side["_emask"], start + grams["klen"] - 1, 1) == mark))
    return side.join(grams, cond, "inner").select(*[side[c] for c in carry],
                                                  F.decode(grams["kbin"], "UTF-8").alias("keyword"))


def substring_matches(texts: DataFrame, keywords: DataFrame, text_col: str,
                      kw_col: str = "keyword", carry=(), **opts) -> DataFrame:
    """M1 as a relation: distinct (carry..., keyword) with keyword ⊆ text.

    ``carry`` should identify the text (e.g. its id plus small attributes);
    the distinct is a partial aggregate before any shuffle.
    """
    return substring_candidates(texts, keywords, text_col, kw_col, carry, **opts).distinct()


def texts_matching_any(texts: DataFrame, keywords: DataFrame, text_col: str,
                       kw_col: str = "keyword", carry=(), **opts) -> DataFrame:
    """The texts (their ``carry`` columns) that contain at least one keyword."""
    return substring_candidates(texts, keywords, text_col, kw_col, carry, **opts) \
        .select(*carry).distinct()


def keyword_lists(texts: DataFrame, keywords: DataFrame, text_col: str, key: str,
                  kw_col: str = "keyword", **opts) -> DataFrame:
    """M1 in list form: (key, mentions array<string>) per text, [] when none.

    The list of one text is bounded by the number of distinct keywords it
    contains.  Candidates go straight into a per-text ``collect_set``: its
    partial step runs in the scan task that produced all of the text's
    candidates.  Texts without a match are kept by a sentinel row per text
    (its key with a null keyword, which ``collect_set`` skips) in the same
    aggregate, so there is one shuffle and no join back to the texts.
    """
    cands = substring_candidates(texts, keywords, text_col, kw_col, carry=[key], **opts)
    sentinels = texts.select(key, F.lit(None).cast("string").alias("keyword"))
    return (cands.unionByName(sentinels).groupBy(key)
            .agg(F.sort_array(F.collect_set("keyword")).alias("mentions")))
