"""Operator 11, conversation structure repair by square-root checkpointed dynamic programming.

``repair`` finds faulty rows of conversations and the cheapest edits after which the role
initials read ``(s?(ua)+)?``, and gives the repaired conversations. A row's first fault
counts: blank (no character but white space), duplicate (role and text seen earlier in the
conversation), truncated (its last character that is no white space is none of ``.!?``).
Edits: K keep 0, R give the role user or assistant 1, D delete 2 (the only edit of blank
and duplicate rows), I insert a row of empty text 5; a truncated row that is not deleted
costs 5 more.

``cheapest_edits`` runs over the row codes of one conversation. The backward state-cost
vectors (cost to finish from a row in each of the four states of the pattern) are stored at
every sqrt(n)-th row only; walking forward, the vectors of one block at a time are
recomputed from its checkpoint, and of the tight edits the one with the least letter is
emitted. Vectors that differ by a constant share their transitions, so a row costs a few
dictionary look-ups, and memory is sqrt(n) vectors.

Shuffles: the order of rows that share a turn (by conversation and turn), the search for
duplicates (by conversation, role and digest of the text: narrow rows), and one exchange
by conversation through which rows are streamed in order. Only one code a row of a
conversation is held at a time, as its audit is one string; texts pass through in batches
whatever the conversation's length. The digest of a whole conversation is one stream of
bytes, so its rows must pass one task; everything before that is spread over turns and texts.

Defined cases: a null role or text counts as one space (so such a row is blank, or has a
role that must change); turns go by ``turn`` (nulls first), equal turns by role, then text;
repeated rows are duplicates; a role's initial is its first character, an empty role has
none and cannot be kept; a null conversation id is a conversation; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelmart.session import scratch_path

from .arrowmap import visible

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = " \t\n\x0b\f\r"
ROWS_OUT = 2_000  # rows of an output batch
_BYTES_OUT = 1 << 22

# Row codes: initial (s, u, a, other) + 4 * fault (none, blank, duplicate, truncated).
FAULTS = ("none", "blank", "duplicate", "truncated")
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
_INSERTED = (2, 2, 3, 2)  # the state after inserting (or giving) the one role that fits
_ROLE_INTO = {2: "user", 3: "assistant"}
_KEEPS = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (state, initial) -> state
_NEVER = 1 << 60


def _close(v: list[int]) -> tuple[int, ...]:
    """Costs with any number of insertions first."""
    two, three = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + two), min(v[1], INSERT + two), two, three


def _moves(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state after) of one row, letters ascending."""
    initial, fault = code & 3, code >> 2
    yield "D", DELETE, state
    if fault in (1, 2):
        return
    extra = TRUNCATED if fault == 3 else 0
    if (state, initial) in _KEEPS:
        yield "K", KEEP + extra, _KEEPS[state, initial]
    yield "R", REROLE + extra, _INSERTED[state]


class Tables:
    """Transitions between state-cost vectors, worked out once for each vector and code."""

    def __init__(self) -> None:
        self.end = _close([0, _NEVER, _NEVER, 0])
        self._back: dict = {}
        self._walk: dict = {}

    def back(self, after: tuple, code: int) -> tuple[tuple, int]:
        """(vector before the row less its least cost, that least cost)."""
        key = (after, code)
        found = self._back.get(key)
        if found is None:
            v = _close([min(cost + after[to] for _, cost, to in _moves(code, q)) for q in range(4)])
            low = min(v)
            found = self._back[key] = tuple(x - low for x in v), low
        return found

    def walk(self, after: tuple, code: int, state: int) -> tuple[str, int]:
        """(insertions and the row's edit, state after it): tight, letters ASCII-least."""
        key = (after, code, state)
        found = self._walk.get(key)
        if found is None:
            before = _close([min(cost + after[to] for _, cost, to in _moves(code, q)) for q in range(4)])
            edits, q = "", state
            while found is None:
                tight = {edit: to for edit, cost, to in _moves(code, q) if cost + after[to] == before[q]}
                if INSERT + before[_INSERTED[q]] == before[q]:
                    tight["I"] = None
                edit = min(tight)
                edits += edit
                if edit == "I":
                    q = _INSERTED[q]
                else:
                    found = self._walk[key] = edits, tight[edit]
        return found


def cheapest_edits(codes: bytes, tables: Tables | None = None) -> tuple[int, str]:
    """(cost, edits): the ASCII-least of the cheapest edit strings of one conversation."""
    tables = tables or Tables()
    n = len(codes)
    step = isqrt(n) + 1
    starts = range(0, n, step)
    back, walk = tables.back, tables.walk
    checkpoint: dict[int, tuple] = {}  # block start -> vector after the block
    v, cost = tables.end, 0
    for start in reversed(starts):
        checkpoint[start] = v
        for code in reversed(codes[start:start + step]):
            v, low = back(v, code)
            cost += low
    cost += v[0]
    out, state = [], 0
    for start in starts:
        block = codes[start:start + step]
        after = [checkpoint[start]]
        for code in reversed(block[1:]):
            after.append(back(after[-1], code)[0])
        for code, v in zip(block, reversed(after)):
            edits, state = walk(v, code, state)
            out.append(edits)
    while state in (1, 2):  # rows that are missing at the end
        out.append("I")
        state = _INSERTED[state]
    return cost, "".join(out)


def row_code(role: Column, text: Column, repeated: Column) -> Column:
    """The code of a row, as an integer."""
    bare = F.rtrim(text, F.lit(BLANK))
    initial = F.substr(role, F.lit(1), F.lit(1))
    first = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", 1).when(repeated, 2).when(~F.substr(bare, F.lit(-1), F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return (first + 4 * fault).cast("int")


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Conversation:
    """What is kept of one conversation while its rows stream by: codes, then edits."""

    def __init__(self, key, tables: Tables) -> None:
        self.key, self.tables = key, tables
        self.codes = bytearray()
        self.low = self.high = self.last = None
        self.turns = 0
        self.edits: str | None = None
        self.at = self.state = self.position = 0

    def add(self, turn, code) -> None:
        if code is None:  # the conversation exists, but this row is gone
            return
        self.codes.append(code)
        if turn is not None:
            if turn != self.last:
                self.turns += 1
                self.low = turn if self.low is None else self.low
                self.last = self.high = turn

    def report(self) -> dict:
        codes = bytes(self.codes)
        cost, self.edits = cheapest_edits(codes, self.tables)
        faults = [0] * 4
        for code in range(16):
            faults[code >> 2] += codes.count(code)
        illegal = sum((a & 3, b & 3) not in _LEGAL for a, b in zip(codes, codes[1:]))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        self.codes = bytearray()
        return {"position": 0, "edit": None, "role": None, "text": None, "gaps": gaps, "blank": faults[1], "duplicate": faults[2],
                "truncated": faults[3], "illegal": illegal, "cost": cost, "audit": self.edits}

    def _row(self, edit: str, role: str, text: str) -> dict:
        self.position += 1
        return {"position": self.position, "edit": edit, "role": role, "text": text}

    def insertions(self) -> Iterator[dict]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            self.state = _INSERTED[self.state]
            yield self._row("I", _ROLE_INTO[self.state], "")

    def edited(self, role: str, text: str) -> Iterator[dict]:
        yield from self.insertions()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEEPS[self.state, "sua".index(role[0])]
            yield self._row("K", role, text)
        elif edit == "R":
            self.state = _INSERTED[self.state]
            yield self._row("R", _ROLE_INTO[self.state], text)


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: str | None = None) -> DataFrame:
    """Reports and repaired rows of all conversations, each conversation's together and in order.

    Columns: ``conv_id``, ``position`` (0: the report; from 1: the repaired rows), ``edit``
    (K, R or I), ``role``, ``text``, and in the report ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``. Rows whose boolean column ``present`` is
    false are no part of the conversation, but the conversation is reported without them.
    """
    spark = turns.sparkSession
    visible(spark)
    blank = F.lit(" ")
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), blank).alias("role"),
                        F.coalesce(F.col(text).cast("string"), blank).alias("text"),
                        (F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))).alias("there"))
    tie = Window.partitionBy("conv_id", "turn").orderBy("there", "role", "text")
    path = scratch_path(spark, "repair-rows")
    rows.withColumns({"tie": F.row_number().over(tie), "digest": F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))}).write.parquet(path)
    rows = spark.read.parquet(path)
    first = Window.partitionBy("conv_id", "there", "role", "digest").orderBy("turn", "tie")
    narrow = rows.select("conv_id", "turn", "tie", "there", "role", "digest", row_code(F.col("role"), F.col("text"), F.lit(False)).alias("code"))
    fault = F.when((F.col("code") >= 4) & (F.col("code") < 8), F.col("code")).when(F.row_number().over(first) > 1, 8 + F.col("code") % 4).otherwise(F.col("code"))
    codes = narrow.withColumn("code", fault).select("conv_id", F.lit(0).alias("part"), "turn", "tie", F.when(F.col("there"), F.col("code")).alias("code"),
                                                    F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = rows.filter("there").select("conv_id", F.lit(1).alias("part"), "turn", "tie", F.lit(None).cast("int").alias("code"), "role", "text")
    stream = codes.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "tie")
    schema = StructType([StructField("conv_id", turns.select(conv_id).schema[0].dataType), StructField("position", LongType()),
                         StructField("edit", StringType()), StructField("role", StringType()), StructField("text", StringType()),
                         *[StructField(c, LongType()) for c in REPORT], StructField("audit", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, now = Tables(), None
        out: list[dict] = []
        size = 0

        def closing(conv: _Conversation | None) -> Iterator[dict]:
            if conv is not None:
                if conv.edits is None:
                    yield {"conv_id": conv.key, **conv.report()}
                for row in conv.insertions():
                    yield {"conv_id": conv.key, **row}

        for batch in batches:
            for key, part, t, code, r, x in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6))):
                if now is None or key != now.key:
                    out.extend(closing(now))
                    now = _Conversation(key, tables)
                if part == 0:
                    now.add(t, code)
                    continue
                if now.edits is None:
                    out.append({"conv_id": key, **now.report()})
                for row in now.edited(r, x):
                    out.append({"conv_id": key, **row})
                    size += len(row["text"])
                if len(out) >= ROWS_OUT or size >= _BYTES_OUT:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out, size = [], 0
        out.extend(closing(now))
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return stream.mapInArrow(run, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """One row a conversation of ``repair``'s result: its report and the digest of the repaired ``role:text`` lines.

    The rows of a conversation follow each other in ``repair``'s result, so they are hashed as they stream by, without another shuffle.
    """
    id_field = repaired.schema["conv_id"]
    schema = StructType([id_field, *[StructField(c, LongType()) for c in REPORT], StructField("audit", StringType()),
                         StructField("repaired_sha256", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, digest = None, None
        for batch in batches:
            out = []
            at = {name: i for i, name in enumerate(batch.schema.names)}
            position = batch.column(at["position"]).to_pylist()
            roles, texts = batch.column(at["role"]).to_pylist(), batch.column(at["text"]).to_pylist()
            for i, p in enumerate(position):
                if p == 0:
                    if report is not None:
                        out.append({**report, "repaired_sha256": digest.hexdigest()})
                    report = {c: batch.column(at[c])[i].as_py() for c in ("conv_id", *REPORT, "audit")}
                    digest = hashlib.sha256()
                else:
                    digest.update((("\n" if p > 1 else "") + roles[i] + ":" + texts[i]).encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
        if report is not None:
            yield pa.RecordBatch.from_pylist([{**report, "repaired_sha256": digest.hexdigest()}], arrow)

    return repaired.mapInArrow(run, schema)


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage: rows (conv_id, turn, role, text, present), by crc32 of ``conv_id:turn`` modulo 20."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    text = F.coalesce(F.col("text"), blank)
    return turns.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), blank)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every conversation of the damaged table, reported, repaired and digested."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(repair(damage(turns), present="present"))


#: crc32 bit by bit; then the backward recursion over rows, its four states side by side, each with its least (cost, edits).
OP11_SQL = r"""
with recursive src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations
), crc as (
  select name, xor(list_reduce(list_concat([4294967295::bigint],
      flatten([[((ascii(c) >> k) & 1)::bigint for k in range(8)] for c in string_split(name, '')])),
    lambda acc, b: case when (xor(acc, b) & 1) = 1 then xor(acc >> 1, 3988292384::bigint) else acc >> 1 end), 4294967295::bigint) % 20 as kind
  from (select distinct name from src)
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from src join crc using (name), range(2) as c(copy) where kind <> 0 and (copy = 0 or kind = 3)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
), marked as (
  select *, row_number() over (partition by conv_id, role, text order by i) as seen,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, substr(role, 1, 1) as initial
  from numbered
), faults as (
  select *, case when bare = '' then 'blank' when seen > 1 then 'duplicate' when right(bare, 1) not in ('.', '!', '?') then 'truncated' else 'none' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair
  from marked
), counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    sum((fault = 'blank')::int) as blank, sum((fault = 'duplicate')::int) as duplicate, sum((fault = 'truncated')::int) as truncated,
    sum(coalesce((pair not in ('su', 'ua', 'au'))::int, 0)) as illegal
  from faults group by conv_id
), dp as (
  -- edits before a row from the states nothing, after s, after u, after a; c cost, e edits, t repaired lines
  select conv_id, n as i, {'c': 0, 'e': '', 't': ''} as v0, {'c': 10, 'e': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} as v1,
    {'c': 5, 'e': 'I', 't': chr(10) || 'assistant:'} as v2, {'c': 0, 'e': '', 't': ''} as v3 from counts
  union all
  select conv_id, i, least(w0, {'c': 5 + v2.c, 'e': 'I' || v2.e, 't': chr(10) || 'user:' || v2.t}),
    least(w1, {'c': 5 + v2.c, 'e': 'I' || v2.e, 't': chr(10) || 'user:' || v2.t}), v2, v3
  from (
    select *, least(w2, {'c': 5 + w3.c, 'e': 'I' || w3.e, 't': chr(10) || 'assistant:' || w3.t}) as v2,
      least(w3, {'c': 5 + w2.c, 'e': 'I' || w2.e, 't': chr(10) || 'user:' || w2.t}) as v3
    from (
      select d.conv_id, d.i - 1 as i,
        list_min(list_filter([{'c': 2 + v0.c, 'e': 'D' || v0.e, 't': v0.t},
          case when stays and initial = 's' then {'c': x + v1.c, 'e': 'K' || v1.e, 't': line || v1.t} when stays and initial = 'u' then {'c': x + v2.c, 'e': 'K' || v2.e, 't': line || v2.t} end,
          case when stays then {'c': 1 + x + v2.c, 'e': 'R' || v2.e, 't': uline || v2.t} end], lambda o: o is not null)) as w0,
        list_min(list_filter([{'c': 2 + v1.c, 'e': 'D' || v1.e, 't': v1.t},
          case when stays and initial = 'u' then {'c': x + v2.c, 'e': 'K' || v2.e, 't': line || v2.t} end,
          case when stays then {'c': 1 + x + v2.c, 'e': 'R' || v2.e, 't': uline || v2.t} end], lambda o: o is not null)) as w1,
        list_min(list_filter([{'c': 2 + v2.c, 'e': 'D' || v2.e, 't': v2.t},
          case when stays and initial = 'a' then {'c': x + v3.c, 'e': 'K' || v3.e, 't': line || v3.t} end,
          case when stays then {'c': 1 + x + v3.c, 'e': 'R' || v3.e, 't': aline || v3.t} end], lambda o: o is not null)) as w2,
        list_min(list_filter([{'c': 2 + v3.c, 'e': 'D' || v3.e, 't': v3.t},
          case when stays and initial = 'u' then {'c': x + v2.c, 'e': 'K' || v2.e, 't': line || v2.t} end,
          case when stays then {'c': 1 + x + v2.c, 'e': 'R' || v2.e, 't': uline || v2.t} end], lambda o: o is not null)) as w3
      from dp d join (select *, fault not in ('blank', 'duplicate') as stays, case when fault = 'truncated' then 5 else 0 end as x,
          chr(10) || role || ':' || text as line, chr(10) || 'user:' || text as uline, chr(10) || 'assistant:' || text as aline from faults) f
        on f.conv_id is not distinct from d.conv_id and f.i = d.i)))
select s.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(v0.c, 0)::bigint as cost,
  coalesce(v0.e, '') as audit, sha256(coalesce(substr(v0.t, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) s
left join counts c on c.conv_id is not distinct from s.conv_id
left join dp d on d.conv_id is not distinct from s.conv_id and d.i = 0
"""
