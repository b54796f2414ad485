"""Conversation structure repair: cheapest edits to a grammar of turns.

Edits form an implicit lattice of (turn index, grammar state). Dijkstra's search walks it with the priority
(cost, audit), the audit being the edits' initials so far, and stops at the first accepting end node that it pops.
Two ways to a node never have the same cost with one audit a prefix of the other, so the least audit stays least.

Turns are range-partitioned by conversation and turn, and equal turns are one row with a count, so
a hot conversation is dealt over tasks and no task holds more than ``PIECE`` of its turns. A conversation that one
task reads in one piece is solved there. The others come as pieces: for each state before and after a piece,
its least cost and the place of its audit among the piece's audits (none is a prefix of another, as insertions go before
a turn). Costs to go along the pieces, from the end, then pick each piece's way from the front, which is the search's own result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, partitions_for, sliced, written

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar state: what the last role was
ACCEPTING = (START, ASSISTANT)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}  # the role that an inserted or given role has to be
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
PIECE, PIECE_BYTES = 512, 16 << 20  # turns and bytes of a piece
RANGE_ROWS, RANGE_BYTES = 200_000, 128 << 20  # of a range partition
LEAD = 64  # characters of a text that range partitions are cut by
NEVER = 1 << 60

Turn = tuple[str, str, bool, bool]  # role, text, whether it has to be deleted, whether it is truncated


def edits(turns: list[Turn], index: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, initial, index, state) of each edit at a node."""
    yield INSERT, "I", index, AFTER[state, NEXT[state]]
    if index == len(turns):
        return
    role, _, doomed, truncated = turns[index]
    yield DELETE, "D", index + 1, state
    if not doomed:
        if (state, role[:1]) in AFTER:
            yield TRUNCATED * truncated, "K", index + 1, AFTER[state, role[:1]]
        yield REROLE + TRUNCATED * truncated, "R", index + 1, AFTER[state, NEXT[state]]


def search(turns: list[Turn], entry: int, until: Callable[[int, int], bool]) -> Iterator[tuple[int, int, str]]:
    """(state, cost, audit) of the end nodes in the order in which Dijkstra's search pops them; nodes where ``until`` holds are not left."""
    queue: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    seen = set()
    while queue:
        cost, audit, index, state = heapq.heappop(queue)
        if (index, state) in seen:
            continue
        seen.add((index, state))
        if index == len(turns):
            yield state, cost, audit
            if until(index, state):
                continue
        for more, initial, at, then in edits(turns, index, state):
            if (at, then) not in seen:
                heapq.heappush(queue, (cost + more, audit + initial, at, then))


def cheapest(turns: list[Turn]) -> tuple[int, str]:
    """Cost and audit of the least edits of a whole conversation."""
    return next((cost, audit) for state, cost, audit in search(turns, START, lambda *_: False) if state in ACCEPTING)


def ways(turns: list[Turn]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and audit of the least edits of a piece, for each state before and after; nothing is inserted behind its last turn."""
    return {(entry, state): (cost, audit) for entry in range(4) for state, cost, audit in search(turns, entry, lambda *_: True)}


def repaired(turns: Iterable[Turn], audit: str, state: int = START) -> Iterator[str]:
    """The ``role:text`` lines that the edits of an audit leave."""
    turns = iter(turns)
    for edit in audit:
        if edit == "I":
            role, text = ROLES[NEXT[state]], ""
        else:
            role, text, _, _ = next(turns)
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES[NEXT[state]]
        state = AFTER[state, role[:1]]
        yield f"{role}:{text}"


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``__conv, __turn, __role, __text, __copies`` after the planted damage; dropped turns have no copies and no content. Nulls are one space."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col)]
    kind = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spelled[3], ".!?", "")).otherwise(spelled[3])
    there = kind != 0

    def left(c: Column) -> Column:
        return F.when(there, c)

    return df.select(
        F.col(conv_col).alias("__conv"),
        left(F.col(turn_col).cast("long")).alias("__turn"),
        left(F.when(kind == 4, "user").otherwise(spelled[2])).alias("__role"),
        left(text).alias("__text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("__copies"),
    )


def undamaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The columns of ``damaged`` for turns as they are."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return df.select(F.col(conv_col).alias("__conv"), F.col(turn_col).cast("long").alias("__turn"), role.alias("__role"), text.alias("__text"), F.lit(1).cast("long").alias("__copies"))


def faults(turns: DataFrame) -> DataFrame:
    """Equal turns as one row with their number, and each row's faults; sorted by conversation and turn in range partitions."""
    spark = turns.sparkSession
    key = ["__conv", "__role", "__text"]
    last = F.rtrim(F.col("__text"), F.lit(BLANKS))
    counted = turns.groupBy("__turn", *key).agg(F.sum("__copies").alias("__copies"))
    own = written(counted.withColumn("__blank", last == "").withColumn("__cut", ~F.substring(last, -1, 1).isin(".", "!", "?")), "turns")
    # texts that a conversation has at several turns: a row each, joined by key
    first = (
        own.where((F.col("__copies") > 0) & ~F.col("__blank"))
        .groupBy(*key)
        .agg(F.count("*").alias("__n"), (F.count("*") > F.count("__turn")).alias("__null"), F.min("__turn").alias("__first"))
        .where("__n > 1")
    )
    again = own.alias("a").join(first.alias("b"), F.expr("a.__conv <=> b.__conv and a.__role = b.__role and a.__text = b.__text"), "left")
    later = F.expr("b.__n is not null and a.__turn is not null and (b.__null or a.__turn > b.__first)")
    marked = again.select("a.*", later.alias("__later"))
    size = own.agg(F.count("*"), F.sum(F.octet_length("__text"))).first()
    parts = max(partitions_for(spark), -(-size[0] // RANGE_ROWS), -(-(size[1] or 0) // RANGE_BYTES))
    order = [F.asc_nulls_first(c) for c in ("__conv", "__turn", "__role")]
    cut = marked.repartitionByRange(parts, *order, F.substring("__text", 1, LEAD))
    return cut.sortWithinPartitions(*order, F.asc_nulls_first("__text"))


class Piece:
    """Turns of one conversation as they stream by, and what is counted of them."""

    def __init__(self, conv: object):
        self.conv, self.turns, self.size, self.rows = conv, [], 0, 0
        self.low = self.high = self.first = self.last = None
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.head = self.tail = None

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, cut: bool, later: bool) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if self.high is None or turn != self.high:
                self.distinct += 1
            self.high = turn
        initial = role[:1]
        if self.head is None:
            self.head = initial
        elif self.tail + initial not in LEGAL:
            self.illegal += 1
        if initial + initial not in LEGAL:
            self.illegal += copies - 1
        self.tail = initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + later
            self.truncated += cut and not later
        self.turns.append((role, text, blank or later, cut, copies))
        self.rows += 1
        self.size += len(text)

    def search_turns(self) -> tuple[list[Turn], list[int]]:
        """The turns that the search sees, a run of copies of one being two at most, and how often each one's edit stands."""
        seen, runs = [], []
        for role, text, doomed, cut, copies in self.turns:
            if not doomed:
                seen.append((role, text, False, cut))
                runs.append(1)
                copies -= 1
            if copies:
                seen.append((role, text, True, cut))
                runs.append(copies)
        return seen, runs


def spelled_out(audit: str, runs: list[int]) -> tuple[int, str]:
    """What runs of copies add to the cost, and the audit with an initial for each copy."""
    out, at, more = [], 0, 0
    for edit in audit:
        if edit == "I":
            out.append(edit)
        else:
            out.append(edit * runs[at])
            more += DELETE * (runs[at] - 1)
            at += 1
    return more, "".join(out)


COUNTS = ("blank", "duplicate", "truncated", "illegal")
LONGS = ("low", "high", "n_turns", *COUNTS, "cost")
PLACE = "conv {}, place long, part long"
PIECES = f"{PLACE}, whole boolean, {', '.join(f'{c} long' for c in LONGS)}, audit string, sha string, head string, tail string, costs array<long>, ranks array<int>, audits array<string>, roles array<string>, texts array<string>, doomed array<boolean>, copies array<long>"
CHOSEN = f"{PLACE}, entry int, rank int, closing string, gaps long, {', '.join(f'{c} long' for c in COUNTS)}, cost long"
FOUND = "conv {}, audit string, sha string, gaps long, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost"))


def whole_result(piece: Piece) -> dict:
    turns, runs = piece.search_turns()
    cost, audit = cheapest(turns)
    sha = hashlib.sha256("\n".join(repaired(turns, audit)).encode("utf-8", "replace")).hexdigest()
    more, audit = spelled_out(audit, runs)
    return {"cost": cost + more, "audit": audit, "sha": sha}


def piece_result(piece: Piece) -> dict:
    turns, runs = piece.search_turns()
    found = ways(turns)
    audits = sorted({audit for _, audit in found.values()})
    pairs = [found.get((a, b)) for a in range(4) for b in range(4)]
    more = {audit: spelled_out(audit, runs)[0] for audit in audits}
    roles, texts, doomed, _ = ([*x] for x in zip(*turns, strict=True)) if turns else ([], [], [], [])
    costs = [NEVER if p is None else p[0] + more[p[1]] for p in pairs]
    return {"costs": costs, "ranks": [-1 if p is None else audits.index(p[1]) for p in pairs], "audits": audits, "roles": roles, "texts": texts, "doomed": doomed, "copies": runs}


def pieces_of(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: conversations that lie whole in a partition, solved, and the pieces of others.

    A partition's first and last conversation may go on elsewhere, so they come as pieces.
    """
    place, held, size, part = TaskContext.get().partitionId(), [], 0, 0
    current, first, pieces, schema = None, True, 0, None

    def finish(whole: bool) -> None:
        nonlocal size, part
        row = {"conv": current.conv, "whole": whole, "place": place, "part": part, "low": current.low, "high": current.high, "n_turns": current.distinct, "head": current.head, "tail": current.tail}
        held.append(row | {c: int(getattr(current, c)) for c in COUNTS} | (whole_result if whole else piece_result)(current))
        size += 0 if whole else current.size
        part += 1

    for batch in sliced(batches):
        schema = schema or piece_schema(batch.schema.field("__conv").type)
        for conv, *turn, copies, blank, cut, later in zip(*(batch.column(c).to_pylist() for c in ("__conv", "__turn", "__role", "__text", "__copies", "__blank", "__cut", "__later")), strict=True):
            if current is None or conv != current.conv:
                if current is not None:
                    finish(whole=not first and not pieces)
                    first, pieces = False, 0
                current = Piece(conv)
            elif current.rows >= most or current.size >= PIECE_BYTES:
                finish(whole=False)
                current, pieces = Piece(conv), pieces + 1
            if copies:
                current.add(*turn, copies, blank, cut, later)
            if len(held) >= 256 or size > PIECE_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
    if current is not None:
        finish(whole=False)
        yield pa.RecordBatch.from_pylist(held, schema)


def piece_schema(conv_type: pa.DataType) -> pa.Schema:
    fields = [("conv", conv_type), ("place", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_())]
    fields += [(c, pa.int64()) for c in LONGS] + [(c, pa.string()) for c in ("audit", "sha", "head", "tail")]
    fields += [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))] + [(c, pa.list_(pa.string())) for c in ("audits", "roles", "texts")]
    return pa.schema([*fields, ("doomed", pa.list_(pa.bool_())), ("copies", pa.list_(pa.int64()))])


def chosen(table: pa.Table) -> pa.Table:
    """For one conversation's pieces: the state before each, the place of its audit, and on the first one the conversation's counts."""
    table = table.sort_by([("place", "ascending"), ("part", "ascending")])
    rows = table.to_pylist()
    closing = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    togo = [[INSERT * len(closing[s]) for s in range(4)]]
    for row in reversed(rows):
        togo.append([min(row["costs"][4 * a + b] + togo[-1][b] for b in range(4)) for a in range(4)])
    togo.reverse()
    state, out, seen = START, [], None
    total = {"gaps": 0, **dict.fromkeys(COUNTS, 0), "cost": togo[0][START]}
    low, distinct = None, 0
    for k, row in enumerate(rows):
        best = [b for b in range(4) if row["costs"][4 * state + b] + togo[k + 1][b] == togo[k][state] and row["ranks"][4 * state + b] >= 0]
        then = min(best, key=lambda b: row["ranks"][4 * state + b])
        out.append({"conv": row["conv"], "place": row["place"], "part": row["part"], "entry": state, "rank": row["ranks"][4 * state + then], "closing": ""})
        state = then
        for c in COUNTS:
            total[c] += row[c]
        if row["head"] is not None:
            total["illegal"] += seen is not None and seen + row["head"] not in LEGAL
            seen = row["tail"]
        if row["low"] is not None:
            distinct += row["n_turns"] - (low is not None and high == row["low"])
            low, high = row["low"] if low is None else low, row["high"]
    if low is not None:
        total["gaps"] = high - low + 1 - distinct
    out[-1]["closing"] = closing[state]
    for k, row in enumerate(out):
        row |= total if not k else dict.fromkeys(total)
    schema = pa.schema([("conv", table.schema.field("conv").type), ("place", pa.int64()), ("part", pa.int64()), ("entry", pa.int32()), ("rank", pa.int32()), ("closing", pa.string()), *((c, pa.int64()) for c in total)])
    return pa.Table.from_pylist(out, schema)


def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: a piece's chosen audit with an initial a copy, and the lines that it leaves (null for none)."""
    for batch in sliced(batches, rows=64):
        audits, bodies = [], []
        for entry, rank, closing, options, roles, texts, doomed, runs in zip(*(batch.column(c).to_pylist() for c in ("entry", "rank", "closing", "audits", "roles", "texts", "doomed", "copies")), strict=True):
            turns = [(*x, False) for x in zip(roles, texts, doomed, strict=True)]
            lines = list(repaired(turns, options[rank] + closing, entry))
            audits.append(spelled_out(options[rank], runs)[1] + closing)
            bodies.append("\n".join(lines) if lines else None)
        kept = [batch.column(c) for c in ("conv", "place", "part", "gaps", *COUNTS, "cost")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(audits, pa.string()), pa.array(bodies, pa.string())], names=["conv", "place", "part", "gaps", *COUNTS, "cost", "audit", "body"])


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: pieces in order as one row a conversation; their lines go through one hash, a piece at a time."""
    conv, held, schema = None, None, None

    def close() -> pa.RecordBatch:
        digest, _, audits, counts = held
        return pa.RecordBatch.from_pylist([{"conv": conv, "audit": "".join(audits), "sha": digest.hexdigest()} | counts], schema)

    for batch in sliced(batches, rows=64):
        if schema is None:
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("audit", pa.string()), ("sha", pa.string()), *((c, pa.int64()) for c in ("gaps", *COUNTS, "cost"))])
        for row in batch.to_pylist():
            if held is None or row["conv"] != conv:
                if held is not None:
                    yield close()
                conv, held = row["conv"], [hashlib.sha256(), False, [], {c: row[c] for c in ("gaps", *COUNTS, "cost")}]
            held[2].append(row["audit"])
            if row["body"] is not None:
                held[0].update(("\n" if held[1] else "").encode() + row["body"].encode("utf-8", "replace"))
                held[1] = True
    if held is not None:
        yield close()


def repair(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for the columns of ``damaged`` or ``undamaged``.

    Turns are ordered by turn (null first), then role and text; copies of one stand together. A blank turn or a copy has to go,
    whatever its role; an unknown or empty role breaks the grammar. Null conversation ids are one conversation. A conversation without turns
    has zeros, an empty audit and the empty text's hash; an empty table gives no rows. Repeated rows are copies. Texts are
    hashed whole; a conversation's hash is sequential, so one task reads the lines that a conversation of several pieces keeps, a piece at a time.
    """
    spark = turns.sparkSession
    bounded_batches(spark)
    kind = dict(turns.dtypes)["__conv"]
    pieces = written(faults(turns).mapInArrow(partial(pieces_of, most=piece), PIECES.format(kind)), "conversation-pieces")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n_turns"), F.lit(0))
    whole = pieces.where("whole").select("conv", "audit", "sha", gaps.alias("gaps"), *COUNTS, "cost")
    parts = pieces.where("not whole")
    slim = parts.select("conv", "place", "part", "low", "high", "n_turns", *COUNTS, "head", "tail", "costs", "ranks")
    ways_taken = written(slim.groupBy("conv").applyInArrow(chosen, CHOSEN.format(kind)), "conversation-ways")
    bodies = parts.select("place", "part", "audits", "roles", "texts", "doomed", "copies").join(ways_taken, ["place", "part"])
    lines = bodies.mapInArrow(spelled, f"{PLACE.format(kind)}, gaps long, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string, body string")
    joined = lines.repartition(partitions_for(spark), "conv").sortWithinPartitions("conv", "place", "part").mapInArrow(streamed, FOUND.format(kind))
    return whole.unionByName(joined).select(F.col("conv").alias("conv_id"), "gaps", *COUNTS, "cost", "audit", F.col("sha").alias("repaired_sha256"))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: The damage with a CRC-32 spelled out, the edits as four labels a turn (cost in eight digits, then audit) that a
#: recursion carries along, and a second recursion that reads the audit to build the repaired lines.
OP12_SQL = """
WITH RECURSIVE spelled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda h, z: xor(h >> 1, 3988292384::BIGINT * (h & 1)))), 4294967295::BIGINT) % 20 AS kind
  FROM spelled
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), faulty AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    role[1:1] AS r, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered
), flags AS (
  SELECT *, t = '' AS blank, t <> '' AND again AS dup, t <> '' AND NOT again AND right(t, 1) NOT IN ('.', '!', '?') AS cut FROM faulty
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM flags GROUP BY conv_id
), search AS (
  SELECT conv_id, 0::BIGINT AS i, '00000000' AS c0, NULL::VARCHAR AS c1, '00000002I' AS c2, '00000004II' AS c3 FROM counts
  UNION ALL
  SELECT conv_id, i, c0, c1, c2, least(c3, printf('%08d', c2[1:8]::BIGINT + 2) || c2[9:] || 'I') FROM (
    SELECT conv_id, i, c0, c1, c3, least(c2, printf('%08d', c0[1:8]::BIGINT + 2) || c0[9:] || 'I', printf('%08d', c1[1:8]::BIGINT + 2) || c1[9:] || 'I', printf('%08d', c3[1:8]::BIGINT + 2) || c3[9:] || 'I') AS c2 FROM (
      SELECT s.conv_id, f.i,
        printf('%08d', c0[1:8]::BIGINT + 3) || c0[9:] || 'D' AS c0,
        least(printf('%08d', c1[1:8]::BIGINT + 3) || c1[9:] || 'D', CASE WHEN ok AND r = 's' THEN printf('%08d', c0[1:8]::BIGINT + x) || c0[9:] || 'K' END) AS c1,
        least(printf('%08d', c2[1:8]::BIGINT + 3) || c2[9:] || 'D',
          CASE WHEN ok THEN printf('%08d', c0[1:8]::BIGINT + x + kept) || c0[9:] || letter END,
          CASE WHEN ok THEN printf('%08d', c1[1:8]::BIGINT + x + kept) || c1[9:] || letter END,
          CASE WHEN ok THEN printf('%08d', c3[1:8]::BIGINT + x + kept) || c3[9:] || letter END) AS c2,
        least(printf('%08d', c3[1:8]::BIGINT + 3) || c3[9:] || 'D', CASE WHEN ok THEN printf('%08d', c2[1:8]::BIGINT + x + CASE WHEN r = 'a' THEN 0 ELSE 2 END) || c2[9:] || CASE WHEN r = 'a' THEN 'K' ELSE 'R' END END) AS c3
      FROM search s JOIN (
        SELECT conv_id, i, r, NOT (blank OR dup) AS ok, cut::BIGINT AS x, CASE WHEN r = 'u' THEN 0 ELSE 2 END AS kept, CASE WHEN r = 'u' THEN 'K' ELSE 'R' END AS letter FROM flags
      ) f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1))
), best AS (
  SELECT s.conv_id, least(s.c0, s.c3) AS label FROM search s JOIN counts c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n
), walk AS (
  SELECT conv_id, label[9:] AS audit, 0::BIGINT AS i, 0::BIGINT AS pos, '' AS last, NULL::VARCHAR AS body FROM best
  UNION ALL
  SELECT w.conv_id, w.audit, CASE WHEN e = 'I' THEN w.i ELSE w.i + 1 END, w.pos + 1,
    CASE e WHEN 'D' THEN w.last WHEN 'K' THEN f.r ELSE CASE WHEN w.last = 'u' THEN 'a' ELSE 'u' END END,
    CASE WHEN e = 'D' THEN w.body ELSE concat(w.body || chr(10), CASE WHEN e = 'K' THEN f.role WHEN w.last = 'u' THEN 'assistant' ELSE 'user' END, ':', CASE WHEN e = 'I' THEN '' ELSE f.text END) END
  FROM (SELECT *, substring(audit, pos + 1, 1) AS e FROM walk WHERE pos < length(audit)) w LEFT JOIN flags f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
), lines AS (
  SELECT conv_id, audit, coalesce(body, '') AS body FROM walk WHERE pos = length(audit)
), known AS (SELECT DISTINCT conv_id FROM conversations)
SELECT k.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(b.label[1:8]::BIGINT, 0) AS cost,
  coalesce(l.audit, '') AS audit, sha256(coalesce(l.body, '')) AS repaired_sha256
FROM known k LEFT JOIN counts c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON k.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN lines l ON k.conv_id IS NOT DISTINCT FROM l.conv_id
"""
