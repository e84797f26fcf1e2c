"""Conversation structure repair by a square-root checkpointed DP.

The turns of a conversation are to read ``(s?(ua)+)?`` by role initials
(system once, then user and assistant by turns, or nothing).  Edits: keep (0),
give the role that fits, user or assistant (1), delete (2), insert an empty
turn that fits (5).  Blank turns and repeated ones must go; a truncated turn
that stays costs 5 more.  Of the cheapest edit scripts the one whose letters
(D, I, K, R) are least in ASCII order is applied.

What is left to do costs a vector of one number per state of the grammar.  The
vectors are made from the last turn to the first, and only every sqrt(n)-th is
stored; the way forward makes a block's vectors again from the checkpoint behind
it and takes, turn by turn, the least letter that stays on a cheapest path.
Vectors are held less their minimum, so few different ones exist and each step
is worked out once a worker.

A turn reaches the DP as one byte, so a conversation holds a byte a turn and its
script; texts stream through, in order, and are never collected.  Equal turns
are counted before the shuffle, repeats found by a minimum per (role, text).
One conversation's script and text are made in order, hence by one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.scratch import written

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
#: State after each role initial (s, u, a, other), from nothing, s, u, a; -1: not allowed.
_KEEP = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: State after an inserted or retyped turn, and its role.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
#: Cost of what is left behind the last turn; states 0 and 3 may end.
_END = (0, 2 * INSERT, INSERT, 0)
_OK = {(0, 1), (1, 2), (2, 1)}
_FINE, _CUT, _BLANK, _TWIN = range(4)


def _least(vector: list[int]) -> tuple[int, ...]:
    """The vector with insertions before the turn allowed (two at most are of use)."""
    one = [INSERT + vector[_NEXT[q]] for q in range(4)]
    two = [2 * INSERT + vector[_NEXT[_NEXT[q]]] for q in range(4)]
    return tuple(map(min, vector, one, two))


@lru_cache(maxsize=1 << 14)
def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a turn from the costs after it."""
    role, fault = code >> 2, code & 3
    vector = []
    for q in range(4):
        cost = DELETE + after[q]
        if fault < _BLANK:
            extra = TRUNCATED * (fault == _CUT)
            to = _KEEP[q][role]
            cost = min(cost, RETYPE + extra + after[_NEXT[q]], extra + after[to] if to >= 0 else _FAR)
        vector.append(cost)
    return _least(vector)


@lru_cache(maxsize=1 << 14)
def _step(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """(costs before the turn less their minimum, the minimum)."""
    vector = _before(code, after)
    low = min(vector)
    return tuple(v - low for v in vector), low


@lru_cache(maxsize=1 << 16)
def _letters(code: int, after: tuple[int, ...], state: int) -> tuple[bytes, int]:
    """(letters up to and with that of the turn, the state then): least letters on a cheapest path."""
    here, role, fault = _before(code, after), code >> 2, code & 3
    out, q = b"", state
    while True:
        if here[q] == DELETE + after[q]:
            return out + b"D", q
        if here[q] == INSERT + here[_NEXT[q]]:
            out, q = out + b"I", _NEXT[q]
            continue
        extra, to = TRUNCATED * (fault == _CUT), _KEEP[q][role]
        if to >= 0 and here[q] == extra + after[to]:
            return out + b"K", to
        return out + b"R", _NEXT[q]


def script(codes: bytes) -> tuple[bytes, int]:
    """(letters of the edits, their cost) of a conversation's turns, each 4 * role + fault."""
    n = len(codes)
    block = max(1, math.isqrt(n))
    marks, vector, cost = {}, _END, 0
    for i in range(n - 1, -1, -1):
        if (i + 1) % block == 0:
            marks[i + 1] = vector  # costs behind turn i
        vector, low = _step(codes[i], vector)
        cost += low
    cost += vector[0]
    out, q = [], 0
    for a in range(0, n, block):
        b = min(a + block, n)
        vectors = [marks.get(b, _END)]
        for i in range(b - 1, a, -1):
            vectors.append(_step(codes[i], vectors[-1])[0])
        for i in range(a, b):
            more, q = _letters(codes[i], vectors.pop(), q)
            out.append(more)
    out.append(b"I" * (_END[q] // INSERT))
    return b"".join(out), cost


class _Tally:
    """One conversation, turn by turn in order."""

    def __init__(self, conv):
        self.conv, self.codes = conv, bytearray()
        self.count, self.illegal, self.last = [0] * 4, 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: int, fault: int, later: bool, n: int) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        first = _TWIN if later and fault != _BLANK else fault
        rest = fault if fault == _BLANK else _TWIN
        self.codes += bytes([4 * role + first]) + bytes([4 * role + rest]) * (n - 1)
        self.count[first] += 1
        self.count[rest] += n - 1
        if self.last is not None:
            self.illegal += (self.last, role) not in _OK
        self.illegal += (n - 1) * ((role, role) not in _OK)
        self.last = role

    def row(self) -> tuple:
        letters, cost = script(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.count[_BLANK], self.count[_TWIN], self.count[_CUT], self.illegal, cost,
                letters.decode())


_AUDIT = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of sorted turns: the conversations of a partition, one after the other."""
    now, kind, done, held = None, None, [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), [kind, *[pa.int64()] * 6, pa.string()])], names=_AUDIT)

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, turn, role, fault, later, n in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                    held += len(done[-1][-1]) + 100
                    if held > 1 << 20:
                        yield flush()
                        done, held = [], 0
                now = _Tally(conv)
            if n:
                now.add(turn, role, fault, later, n)
    if now is not None:
        done.append(now.row())
        yield flush()


def _named(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None) -> DataFrame:
    space = F.lit(" ")
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
                        (F.lit(1) if copies is None else copies).cast("long").alias("n"))


def audits(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of (conv, turn, role, text, n) rows."""
    there = F.col("n") > 0
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    codes = rows.select(
        "conv", *[F.when(there, F.col(c)).alias(c) for c in ("turn", "role")], F.when(there, F.unhex(F.md5("text"))).alias("key"),
        F.when(~there, F.lit(None)).when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("kind"),
        F.when(~there, F.lit(None)).when(end == "", _BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), _FINE)
        .otherwise(_CUT).alias("fault"), "n")
    codes = codes.groupBy("conv", "turn", "role", "key", "kind", "fault").agg(F.sum("n").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    many = (codes.where("role is not null").groupBy("conv", "role", "key").agg(F.min(place).alias("first"), F.count("*").alias("met"))
            .where("met > 1").select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("key").alias("key2"), "first"))
    marked = codes.join(many, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2"))
                        & (F.col("key") == F.col("key2")), "left")
    later = F.coalesce(place > F.col("first"), F.lit(False))
    kind = rows.schema["conv"].dataType.simpleString()
    return (marked.select("conv", "turn", "role", "key", "kind", "fault", later.alias("later"), "n")
            .repartition("conv").sortWithinPartitions("conv", "turn", "role", "key")
            .select("conv", "turn", "kind", "fault", "later", "n")
            .mapInArrow(_audit, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                "audit string"))


_REPAIRED = ["conv", "place", "role", "text"]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of sorted rows: of each conversation its script (kind 0), then its turns."""
    conv = letters = None
    at = q = place = 0

    def put(role, text):
        nonlocal place
        out.append((conv, place, role, text))
        place += 1

    def inserts():
        nonlocal at, q
        while at < len(letters) and letters[at] == "I":
            put(_ROLE[q], "")
            at, q = at + 1, _NEXT[q]

    for batch in batches:
        out: list[tuple] = []
        kind = batch.schema.field(0).type
        for c, audit, turn_role, text, n in zip(*(x.to_pylist() for x in batch.columns)):
            if audit is not None:
                if letters is not None:
                    inserts()
                conv, letters, at, q, place = c, audit, 0, 0, 0
                continue
            for _ in range(n):
                inserts()
                letter = letters[at]
                at += 1
                if letter == "K":
                    q = _KEEP[q]["sua".find(turn_role[:1])]
                    put(turn_role, text)
                elif letter == "R":
                    put(_ROLE[q], text)
                    q = _NEXT[q]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*out), [kind, pa.int64(), pa.string(), pa.string()])], names=_REPAIRED)
    if letters is not None:
        out = []
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*out), [kind, pa.int64(), pa.string(), pa.string()])], names=_REPAIRED)


def _repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()
    texts = rows.where("n > 0").select("conv", "turn", "role", F.unhex(F.md5("text")).alias("key"),
                                       F.lit(None).cast("string").alias("audit"), "text", "n")
    return (texts.unionByName(audited.select("conv", "audit"), allowMissingColumns=True)
            .withColumn("head", F.col("audit").isNull()).repartition("conv")
            .sortWithinPartitions("conv", "head", "turn", "role", "key").select("conv", "audit", "role", "text", "n")
            .mapInArrow(_apply, f"conv {kind}, place long, role string, text string"))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each conversation's ``role:text`` lines; rows as :func:`repair` gives them."""
    now, state, kind = None, None, None
    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if place == 0:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = conv, hashlib.sha256()
            state.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (kind, pa.string()))], names=["conv", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()])], names=["conv", "sha"])


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired turns) of conversations.

    Audits, a row per conversation: conv, gaps (numbers missing between the
    least and the greatest turn), blank, duplicate, truncated (turns by first
    fault), illegal (neighbours whose initials are not su, ua, au), cost, audit
    (letters of the edits in order).  Repaired turns: conv, place (from 0),
    role, text; a conversation's rows stand in order in one partition.

    Turns are taken by turn (null first), then role, then md5 of the text.  A
    null role or text is one space, a null conversation id is an id like any
    other, and an empty table gives empty results.  ``copies`` (a column) says
    how many times a row stands there; rows with 0 only name their conversation.
    Other columns are not read, so their names may clash.
    """
    rows = _named(turns, conv_col, turn_col, role_col, text_col, copies)
    audited = written(audits(rows), "audits")
    return audited, _repaired(rows, audited)


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """(turns with planted faults, copies): by crc32 of ``conv_id:turn`` mod 20,
    0 drops a turn, 1 empties it, 2 takes its [.!?], 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
                        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("__copies"))
    return rows, F.col("__copies")


def structure_digest(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation after :func:`damaged`; see :func:`repair`."""
    rows, copies = damaged(turns)
    audited, fixed = repair(rows, copies=copies)
    kind = rows.schema["conv_id"].dataType.simpleString()
    hashes = fixed.mapInArrow(_hashes, f"conv {kind}, sha string").withColumnRenamed("conv", "conv2")
    return (audited.join(hashes, F.col("conv").eqNullSafe(F.col("conv2")), "left")
            .select(F.col("conv").alias("conv_id"), *_AUDIT[1:],
                    F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


def oracle(table: str = "conversations") -> str:
    """DuckDB SQL for :func:`structure_digest`, turn by turn."""
    return r"""
    WITH RECURSIVE base AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce(list_concat([4294967295], flatten([[CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')])),
               lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS f
      FROM TABLE_NAME
    ), rows AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM base
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS k,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM rows
    ), turns AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN '' ELSE 'truncated' END AS fault,
             lag(k) OVER (PARTITION BY conv_id ORDER BY i) AS k0 FROM placed
    ), facts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (i > 1 AND (k0, k) NOT IN (('s', 'u'), ('u', 'a'), ('a', 'u'))) AS illegal
      FROM turns GROUP BY conv_id
    ), back(conv_id, i, b) AS (
      SELECT conv_id, n + 1, [0, 10, 5, 0] FROM facts
      UNION ALL
      SELECT conv_id, i, [least(r[1], 5 + r[3], 10 + r[4]), least(r[2], 5 + r[3], 10 + r[4]), least(r[3], 5 + r[4]), least(r[4], 5 + r[3])]
      FROM (SELECT t.conv_id, t.i, [
              least(2 + b[1], x + 1 + b[3], x + CASE k WHEN 's' THEN b[2] WHEN 'u' THEN b[3] ELSE 1000000 END),
              least(2 + b[2], x + 1 + b[3], x + CASE k WHEN 'u' THEN b[3] ELSE 1000000 END),
              least(2 + b[3], x + 1 + b[4], x + CASE k WHEN 'a' THEN b[4] ELSE 1000000 END),
              least(2 + b[4], x + 1 + b[3], x + CASE k WHEN 'u' THEN b[3] ELSE 1000000 END)] AS r
            FROM back JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000 END AS x FROM turns) t
              ON t.conv_id IS NOT DISTINCT FROM back.conv_id AND t.i = back.i - 1)
    ), walk(conv_id, i, q, audit, body) AS (
      SELECT conv_id, CAST(1 AS BIGINT), 1, '', CAST(NULL AS VARCHAR) FROM facts
      UNION ALL
      SELECT conv_id, i + CAST(e <> 'I' AS INTEGER), CASE WHEN e = 'D' THEN q WHEN e = 'K' AND k = 's' THEN 2 WHEN q = 3 THEN 4 ELSE 3 END,
             audit || e, CASE WHEN e = 'D' THEN body ELSE concat_ws(chr(10), body, CASE WHEN e = 'K' THEN role WHEN q = 3 THEN 'assistant' ELSE 'user' END
                                                     || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END
      FROM (SELECT w.*, t.k, t.role, t.text,
                   CASE WHEN n.b IS NOT NULL AND 2 + n.b[q] = h.b[q] THEN 'D'
                        WHEN 5 + h.b[CASE q WHEN 3 THEN 4 ELSE 3 END] = h.b[q] THEN 'I'
                        WHEN x + CASE WHEN q = 1 AND k = 's' THEN n.b[2] WHEN q <> 3 AND k = 'u' THEN n.b[3] WHEN q = 3 AND k = 'a' THEN n.b[4]
                                      ELSE 1000000 END = h.b[q] THEN 'K'
                        ELSE 'R' END AS e
            FROM walk w JOIN facts USING (conv_id) JOIN back h ON h.conv_id = w.conv_id AND h.i = w.i
            LEFT JOIN back n ON n.conv_id = w.conv_id AND n.i = w.i + 1
            LEFT JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000 END AS x FROM turns) t
              ON t.conv_id = w.conv_id AND t.i = w.i
            WHERE w.i <= facts.n OR w.q IN (2, 3))
    ), ends AS (
      SELECT w.conv_id, w.audit, w.body FROM walk w JOIN facts f ON f.conv_id = w.conv_id AND w.i = f.n + 1 AND w.q IN (1, 4)
    )
    SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
           coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, CAST(coalesce(h.b[1], 0) AS BIGINT) AS cost,
           coalesce(e.audit, '') AS audit, sha256(coalesce(e.body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM TABLE_NAME) c LEFT JOIN facts f USING (conv_id)
    LEFT JOIN back h ON h.conv_id = c.conv_id AND h.i = 1 LEFT JOIN ends e ON e.conv_id = c.conv_id""".replace("TABLE_NAME", table)
