"""Benchmark decontamination by template canonicalisation, DataFrame functions only.

A text becomes words without marks, in lower case, of which numbers, names
(capitalised words inside a sentence) and units (after a number) are slots: in
the template only their kind counts.  Windows of five template words are hashed
and joined with those of the benchmark items; a window with fewer than three
words outside slots says too little as a template and is joined by its raw
words, slots with their values.  Hits of a document and an item with the same
offset form an alignment.  In it each value of the item's slots must meet one
value in the document: windows with a slot that met another value than most are
dropped.  A document contains an item if the windows left cover ``ENOUGH`` of
the item's words, or all but one of a shorter item's, in alignments up to
``SHIFT`` words apart (words put in or left out).

Items of fewer than eleven words have shorter windows, so that one changed word
leaves some whole; items under five words are one window of raw words.  An
item's first word may stand inside a sentence of the document, where it looks
like a name: windows with it are joined in both readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.scratch import fits, written

#: Covered words that are enough, and words that may be put in or left out between two alignments.
ENOUGH, SHIFT = 13, 2
#: (tier, least words of its items, most, window, least words outside slots of a template window; 0: raw words only)
TIERS = [(1, 11, 1 << 30, 5, 3), (2, 7, 10, 3, 2), (3, 5, 6, 2, 2), (4, 4, 4, 4, 0), (5, 3, 3, 3, 0), (6, 2, 2, 2, 0), (7, 1, 1, 1, 0)]
#: Words taken as units after a number (fixed values).
UNITS = ["%", "percent", "km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "ml", "l", "liters", "litres", "miles",
         "meters", "metres", "feet", "inches", "seconds", "minutes", "hours", "days", "weeks", "months", "years", "dollars",
         "euros", "cents", "pounds", "degrees"]
SPACE = r"\x20\x09-\x0D"
_NAME, _NUMBER, _UNIT, _START = "\x01", "\x02", "\x03", "\x04"
#: (pattern, replacement) in order; the groups are kept.  Understood alike by Java's and RE2's syntax.
STEPS = [
    (rf"(^|[.!?:][{SPACE}]+|\n[{SPACE}]*)([A-Z])", _START),
    (rf"(^|[{SPACE}])([A-Z][a-z]+)", _NAME),
    (rf"(^|[{SPACE}])[$€£]?([0-9][^{SPACE}]*)", _NUMBER),
    (rf"({_NUMBER}[^{SPACE}]*[{SPACE}]+)({'|'.join(sorted(UNITS, key=len, reverse=True))})\b", _UNIT),
]
MARKS = rf"[^\p{{L}}\p{{N}}{SPACE}{_NAME}-{_UNIT}]+"
SLOT = rf"^([{_NAME}-{_UNIT}]).*$"


def words(text: Column) -> Column:
    """Words without marks, lower case; a slot's word has its kind before it."""
    t = F.coalesce(text, F.lit(""))
    for pattern, mark in STEPS:
        t = F.regexp_replace(t, F.lit(pattern), F.lit(f"$1{mark}$2"))
    t = F.regexp_replace(F.lower(t), F.lit(MARKS), F.lit(""))
    return F.filter(F.split(t, f"[{SPACE}]+"), lambda w: w != "")


def template(words_col: Column) -> Column:
    """The words with each slot reduced to its kind."""
    return F.transform(words_col, lambda w: F.when(w < "\x04", F.substring(w, 1, 1)).otherwise(w))


def _parts(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep``, n, and of each word the hash of its template form (th) and of
    itself (rh), and whether it is outside slots (lits)."""
    return rows.select(*keep, F.size("w").alias("n"), F.transform(template(F.col("w")), lambda w: F.xxhash64(w)).alias("th"),
                       F.transform("w", lambda w: F.xxhash64(w, F.lit(1))).alias("rh"),
                       F.transform("w", lambda w: (w >= _START).cast("int")).alias("lits"))


def _key(tier: tuple, at: str = "at") -> Column:
    """Hash of the window that begins with word ``at`` (from 1), as template or raw words."""
    number, _, _, size, least = tier
    here = [F.col(at) + (i - 1) for i in range(size)]
    raw = F.xxhash64(F.lit(-number), *[F.get("rh", i) for i in here])
    if not least:
        return raw
    outside = sum((F.get("lits", i) for i in here), F.lit(0))
    return F.when(outside >= least, F.xxhash64(F.lit(number), *[F.get("th", i) for i in here])).otherwise(raw)


def _readings(item: DataFrame) -> DataFrame:
    """(item_id, w) of every item, and again with its first word as a name."""
    first = F.get("w", F.lit(0))
    named = F.concat(F.array(F.concat(F.lit(_NAME), first)), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))))
    return item.select("item_id", "w").where("size(w) > 0").union(
        item.where("size(w) > 0").where(first >= _START).select("item_id", named.alias("w")))


def _item_windows(item: DataFrame) -> DataFrame:
    """(item_id, n, tier, size, at, h): distinct windows of every item."""
    rows = _parts(_readings(item), "item_id")
    out = None
    for tier in TIERS:
        number, low, high, size, _ = tier
        own = rows.where(F.col("n").between(low, high)).select("item_id", "n", "th", "rh", "lits", F.explode(
            F.sequence(F.lit(1), F.col("n") - (size - 1))).alias("at"))
        own = own.select("item_id", "n", F.lit(number).alias("tier"), F.lit(size).alias("size"), "at", _key(tier).alias("h"))
        out = own if out is None else out.union(own)
    return out.distinct()


def contained(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", enough: int = ENOUGH) -> DataFrame:
    """(doc_id, item_id, covered) of the items that a document contains, with the words covered."""
    item = written(items.select(F.col(item_col).alias("item_id"), words(F.col(item_text)).alias("w"))
                   .where("item_id is not null"), "items")
    windows = written(_item_windows(item), "item-windows")
    used = {r[0] for r in windows.select("tier").distinct().collect()}  # at most one row a tier
    small = fits(windows, 64)
    side = windows.select("item_id", "n", "tier", "size", F.col("at").alias("place"), "h")
    side = F.broadcast(side) if small else side
    # a column for each step: an expression named twice, or in a lambda, would be worked out again for every window
    rows = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    rows = _parts(rows, "doc_id").where("doc_id is not null")
    hits = None
    for tier in [t for t in TIERS if t[0] in used]:
        size = tier[3]
        own = (rows.where(F.col("n") >= size).select("doc_id", "th", "rh", "lits", F.explode(F.sequence(F.lit(1), F.col("n") - (size - 1))).alias("at"))
               .select("doc_id", "at", _key(tier).alias("h")).join(side.where(F.col("tier") == tier[0]), "h"))
        hits = own if hits is None else hits.union(own)
    if hits is None:
        hits = rows.select("doc_id", F.lit(1).alias("at"), F.lit(0).cast("long").alias("h")).join(side, "h")
    hits = written(hits.select("doc_id", "item_id", "n", "size", F.col("place").alias("at"), (F.col("at") - F.col("place")).alias("shift")).distinct(),
                   "hits")
    # slots of the items, and of the documents with hits
    item_slots = (item.select("item_id", F.posexplode("w").alias("j", "value")).where(F.col("value") < _START)
                  .select("item_id", (F.col("j") + 1).alias("j"), "value"))
    ids = written(hits.select("doc_id").distinct(), "hit-docs")
    ids = F.broadcast(ids) if fits(ids, 24) else ids
    doc_slots = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(ids, "doc_id", "left_semi")
                 .select("doc_id", F.posexplode(words(F.col("text"))).alias("k", "met")).where(F.col("met") < _START)
                 .select("doc_id", (F.col("k") + 1).alias("k"), "met").distinct())
    same = ["doc_id", "item_id", "shift"]
    inside = (F.col("j") >= F.col("at")) & (F.col("j") < F.col("at") + F.col("size"))
    met = written(hits.join(item_slots, "item_id").where(inside).select(*same, "value", "j", (F.col("j") + F.col("shift")).alias("k")).distinct()
                  .join(doc_slots, ["doc_id", "k"]), "slots")
    most = (met.groupBy(*same, "value", "met").agg(F.count("*").alias("c"))
            .groupBy(*same, "value").agg(F.count("*").alias("kinds"), F.min(F.struct((-F.col("c")).alias("c"), "met")).alias("best"))
            .where("kinds > 1").select(*same, "value", "best.met"))
    wrong = met.join(most.withColumnRenamed("met", "right"), [*same, "value"]).where("met != right").select(*same, "j").distinct()
    kept = hits.join(wrong, (hits["doc_id"] == wrong["doc_id"]) & (hits["item_id"] == wrong["item_id"]) & (hits["shift"] == wrong["shift"]) & inside,
                     "left_anti")
    covers = kept.groupBy(*same, "n").agg(F.collect_set("at").alias("ats"), F.first("size").alias("size"))
    covers = covers.select(*same, "n", F.array_distinct(F.flatten(F.transform(
        "ats", lambda a: F.sequence(a, a + F.col("size") - 1)))).alias("cover"))
    near = Window.partitionBy("doc_id", "item_id").orderBy("shift").rangeBetween(-SHIFT, SHIFT)
    covers = covers.withColumn("all", F.when(F.col("n") > 10, F.collect_list("cover").over(near)).otherwise(F.array("cover")))
    need = F.when(F.col("n") < 5, F.col("n")).otherwise(F.least(F.lit(enough), F.col("n") - 1))
    return (covers.select("doc_id", "item_id", "n", F.size(F.array_distinct(F.flatten("all"))).alias("covered"))
            .where(F.col("covered") >= need).groupBy("doc_id", "item_id").agg(F.max("covered").alias("covered")))


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", items_col: str = "items",
                  flag_col: str = "contaminated", **kwargs) -> DataFrame:
    """``docs`` with ``items_col`` (ids of the benchmark items it contains, ascending)
    and ``flag_col``; all rows and other columns stay (but for columns of these names).

    Null and empty texts contain nothing, null and empty items are contained in
    nothing; a null id is never contaminated; rows that repeat an id share what
    any of them contains; very long texts are taken whole; items that repeat a
    text are each listed.
    """
    names = [c for c in docs.columns if c not in (items_col, flag_col)]
    found = written(contained(docs, items, id_col=id_col, **kwargs).groupBy("doc_id")
                    .agg(F.sort_array(F.collect_set("item_id")).alias("__items"))
                    .withColumnRenamed("doc_id", "__found"), "contained")
    size = found.agg(F.coalesce(F.sum(F.size("__items") + 4), F.lit(0))).first()[0] * 8
    side = F.broadcast(found) if size <= 32 << 20 else found
    return (docs.select(*names).join(side, F.col(id_col) == F.col("__found"), "left")
            .select(*names, F.coalesce("__items", F.array().cast(found.schema["__items"].dataType)).alias(items_col))
            .withColumn(flag_col, F.size(items_col) > 0))


def oracle(doc_table: str = "documents", item_table: str = "benchmark") -> str:
    """DuckDB SQL for (doc_id, contaminated, items)."""
    def sql_words(column: str) -> str:
        t = f"coalesce({column}, '')"
        for pattern, mark in STEPS:
            t = f"regexp_replace({t}, {_sql(pattern)}, {_sql(chr(92) + '1' + mark + chr(92) + '2')}, 'g')"
        t = f"regexp_replace(lower({t}), {_sql(MARKS)}, '', 'g')"
        return f"[w FOR w IN string_split_regex({t}, '[{SPACE}]+') IF w <> '']"

    tiers = ", ".join(f"({', '.join(map(str, t))})" for t in TIERS)
    # a window as a list: its tier, 't' and the template words, or 'r' and the raw words
    raw = "w[place:place + size - 1]"
    key = f"""[CAST(tier AS VARCHAR)] || CASE WHEN least > 0 AND len([x FOR x IN {raw} IF x >= {_sql(_START)}]) >= least
              THEN ['t'] || [CASE WHEN x < {_sql(_START)} THEN substr(x, 1, 1) ELSE x END FOR x IN {raw}] ELSE ['r'] || {raw} END"""
    return f"""
    WITH tiers(tier, low, high, size, least) AS (VALUES {tiers}),
    i0 AS (SELECT item_id, {sql_words('text')} AS w FROM {item_table} WHERE item_id IS NOT NULL),
    d0 AS (SELECT doc_id, {sql_words('text')} AS w FROM {doc_table}),
    i1 AS (SELECT item_id, w FROM i0 WHERE len(w) > 0 UNION ALL
           SELECT item_id, list_concat([{_sql(_NAME)} || w[1]], w[2:]) AS w FROM i0 WHERE len(w) > 0 AND w[1] >= {_sql(_START)}),
    i2 AS (SELECT DISTINCT item_id, n, tier, size, place AS spot, {key} AS win
           FROM (SELECT item_id, w, len(w) AS n, tier, size, least, unnest(range(1, len(w) - size + 2)) AS place FROM i1 JOIN tiers ON len(w) BETWEEN low AND high)),
    d2 AS (SELECT doc_id, place AS pos, {key} AS win
           FROM (SELECT doc_id, w, tier, size, least, unnest(range(1, len(w) - size + 2)) AS place
                 FROM d0 JOIN (SELECT * FROM tiers WHERE tier IN (SELECT tier FROM i2)) ON len(w) >= size WHERE doc_id IS NOT NULL)),
    hits AS (SELECT DISTINCT doc_id, item_id, n, size, spot, pos - spot AS shift FROM d2 JOIN i2 USING (win)),
    islots AS (SELECT item_id, j, value FROM (SELECT item_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS value FROM i0) WHERE value < {_sql(_START)}),
    dslots AS (SELECT DISTINCT doc_id, k, met FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS met FROM d0) WHERE met < {_sql(_START)}),
    met AS (SELECT DISTINCT h.doc_id, h.item_id, h.shift, s.value, s.j, d.met FROM hits h JOIN islots s ON s.item_id = h.item_id AND s.j >= h.spot AND s.j < h.spot + h.size
            JOIN dslots d ON d.doc_id = h.doc_id AND d.k = s.j + h.shift),
    most AS (SELECT doc_id, item_id, shift, value, met AS right_ FROM (SELECT doc_id, item_id, shift, value, met, count(*) AS c FROM met GROUP BY ALL)
             QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift, value ORDER BY c DESC, met) = 1),
    wrong AS (SELECT DISTINCT doc_id, item_id, shift, j FROM met JOIN most USING (doc_id, item_id, shift, value) WHERE met <> right_),
    words AS (SELECT DISTINCT doc_id, item_id, shift, n, unnest(range(spot, spot + size)) AS j FROM hits h
              WHERE NOT EXISTS (SELECT 1 FROM wrong x WHERE x.doc_id = h.doc_id AND x.item_id = h.item_id AND x.shift = h.shift AND x.j >= h.spot AND x.j < h.spot + h.size)),
    starts AS (SELECT DISTINCT doc_id, item_id, shift, n FROM words),
    covers AS (SELECT s.doc_id, s.item_id, s.n, s.shift, count(DISTINCT w.j) AS covered FROM starts s JOIN words w ON w.doc_id = s.doc_id AND w.item_id = s.item_id
               AND abs(w.shift - s.shift) <= CASE WHEN s.n > 10 THEN {SHIFT} ELSE 0 END GROUP BY ALL),
    found AS (SELECT DISTINCT doc_id, item_id FROM covers WHERE covered >= CASE WHEN n < 5 THEN n ELSE least({ENOUGH}, n - 1) END),
    lists AS (SELECT doc_id, list_sort(list(item_id)) AS items FROM found GROUP BY doc_id)
    SELECT d.doc_id, l.items IS NOT NULL AS contaminated, coalesce(l.items, CAST([] AS BIGINT[])) AS items
    FROM {doc_table} d LEFT JOIN lists l ON l.doc_id = d.doc_id"""


def _sql(s: str) -> str:
    """A DuckDB string literal; control characters by chr()."""
    parts, plain = [], ""
    for c in s:
        if ord(c) < 32:
            if plain:
                parts.append("'" + plain.replace("'", "''") + "'")
            parts.append(f"chr({ord(c)})")
            plain = ""
        else:
            plain += c
    if plain or not parts:
        parts.append("'" + plain.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"
