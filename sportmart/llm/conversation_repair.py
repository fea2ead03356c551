"""Cheapest repair of the turns of conversations, decided by shortest paths under one integer weight.

An edit path of a conversation is a path through (turn, role of the last turn kept). Its weight is one integer: the
cost stands in the high digits; below it every turn has two letters of three bits, the letter of an inserted turn before it
and that of its own edit, moved to the front and filled up with zeros. Such pairs of letters are never each other's beginning, so
the order of the integers is cost first and then the ASCII order of the audits, and the least integer decides
everything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sportmart.llm.common import BLANKS, importable, staged

#: Faults of a turn.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Roles by which a repaired conversation is judged: nothing yet, system, user, assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Roles after a turn, by the role before it: an optional system turn, then pairs of user and assistant.
FOLLOWS = {EMPTY: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LEGAL = {"su", "ua", "au"}
#: Letters in ASCII order; 0 ends an audit. Three bits a letter, two letters a turn.
LETTERS = "\0DIKR"
BITS = 3
TURN_BITS = 2 * BITS
DELETE_COST, CHANGE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
#: Turns whose weights grow within one integer before they are joined to the path so far.
BLOCK = 128


def word(value: Column) -> Column:
    """A value as text, null as one blank."""
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` after the trial damage: by the CRC-32 of ``conv_id:turn`` modulo 20, 0 drops a
    row (``copies`` is then 0), 1 empties it, 2 takes ``.!?`` out, 3 doubles it and 4 makes its role user."""
    lot = F.crc32(F.concat(word(F.col("conv_id")), F.lit(":"), word(F.col("turn")))) % 20
    text = word(F.col("text"))
    return turns.select(
        "conv_id", "turn",
        F.when(lot == 4, "user").otherwise(word(F.col("role"))).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("copies"),
    )


def folded(turns: DataFrame) -> DataFrame:
    """Equal turns as one row with their number, and one row with no copy and no turn for each conversation that lost any."""
    there = F.col("copies") > 0
    rows = turns.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"),
        *(F.when(there, word(F.col(c))).alias(c) for c in ("role", "text")), F.col("copies").cast("long").alias("copies"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """Each folded row without its text: its digest, the fault of its first copy and that of the others."""
    bare = F.btrim("text", F.lit(BLANKS))
    slim = rows.select(
        "conv_id", "turn", "role", "copies", F.sha2("text", 256).alias("digest"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    # Of equal turns the first has the least turn; a null one comes before all others.
    first = slim.where("copies > 0").groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("least"), F.count_if(F.col("turn").isNull()).alias("without")
    )
    known = slim.alias("s").join(
        first.alias("f"),
        F.expr("s.conv_id <=> f.conv_id AND s.role = f.role AND s.digest = f.digest"), "left",
    )
    earlier = F.col("s.turn").isNotNull() & ((F.col("without") > 0) | (F.col("s.turn") > F.col("least")))
    later = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    return known.select(
        "s.conv_id", "s.turn", "s.role", "s.digest", "copies",
        F.when(F.col("blank"), BLANK).when(earlier, DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(FINE).alias("fault"),
        later.alias("again"),
    )


def letters(first: int, second: int = 0) -> int:
    return first << BITS | second


def steps() -> dict[tuple[int, int, int], list[tuple[int, int, int]]]:
    """Edges of one turn: by the role before, the initial's role (``EMPTY``: any other) and the fault, the least weight to each
    role after, as (role after, cost, letters). One turn at most is inserted before another: two would cost more than
    a deletion and leave the roles as they were."""
    delete, insert, keep, change = (LETTERS.index(x) for x in "DIKR")
    every = {}
    for before in range(4):
        inserted = next(x for x in FOLLOWS[before] if x != SYSTEM)
        for own in range(4):
            for fault in range(4):
                paths = []
                for cost, at, mark in ((0, before, ()), (INSERT_COST, inserted, (insert,))):
                    paths.append((cost + DELETE_COST, letters(*mark, delete), at))
                    if fault in (FINE, TRUNCATED):
                        more = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
                        paths += [(more, letters(*mark, keep), own)] if own in FOLLOWS[at] else []
                        paths += [(more + CHANGE_COST, letters(*mark, change), x) for x in FOLLOWS[at] if x != SYSTEM]
                best = {}
                for cost, pair, after in sorted(paths):
                    best.setdefault(after, (after, cost, pair))
                every[before, own, fault] = list(best.values())
    return every


STEPS = steps()


class Piece:
    """Consecutive turns of one conversation: counts, and the least weight from each role before to each role after."""

    def __init__(self, entries: tuple[int, ...]):
        self.entries = entries
        self.turns = 0
        # Closed blocks: (number of turns, weights by (before, after)); the open one holds weights of up to BLOCK turns.
        self.blocks: list[tuple[int, dict]] = []
        self.open: list[tuple[int, int]] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.least = self.most = self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None

    def add(self, turn: int | None, initial: str, fault: int, copies: int = 1) -> None:
        if self.first_initial is None:
            self.first_initial, self.first_turn = initial, turn
        else:
            self.illegal += self.last_initial + initial not in LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        if turn is not None:
            if turn != self.last_turn:
                self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.last_turn, self.last_initial = turn, initial
        self.faults[fault] += copies
        self.turns += copies
        for _ in range(copies):
            self.open.append((INITIALS.get(initial, EMPTY), fault))
            if len(self.open) == BLOCK:
                self.close()

    def close(self) -> None:
        if not self.open:
            return
        # Only the piece's first block is entered by its own entries; others by any role.
        entries = self.entries if not self.blocks else range(4)
        n, found = len(self.open), {}
        high = TURN_BITS * n
        for entry in entries:
            now = {entry: 0}
            for at, (own, fault) in enumerate(self.open, 1):
                low, then = high - TURN_BITS * at, {}
                for before, weight in now.items():
                    for after, cost, pair in STEPS[before, own, fault]:
                        total = weight + (cost << high) + (pair << low)
                        if after not in then or total < then[after]:
                            then[after] = total
                now = then
            found.update({(entry, after): weight for after, weight in now.items()})
        self.blocks.append((n, found))
        self.open = []

    def weights(self) -> tuple[int, dict]:
        self.close()
        return joined(self.blocks) if self.blocks else (0, {(e, e): 0 for e in self.entries})


def joined(blocks: list[tuple[int, dict]]) -> tuple[int, dict]:
    """Weights of blocks behind one another, joined in pairs, so that each digit is copied a logarithmic number of times."""
    while len(blocks) > 1:
        blocks = [behind(*blocks[i : i + 2]) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
    return blocks[0]


def behind(left: tuple[int, dict], right: tuple[int, dict]) -> tuple[int, dict]:
    (m, one), (n, other) = left, right
    low, found = TURN_BITS * n, {}
    # The right part's cost goes up to the left part's, its letters stay below.
    ends: dict[int, list] = {}
    for (via, after), weight in other.items():
        cost = weight >> low
        ends.setdefault(via, []).append((after, weight - (cost << low) + (cost << low + TURN_BITS * m)))
    for (before, via), weight in one.items():
        for after, more in ends.get(via, ()):
            total = (weight << low) + more
            if (before, after) not in found or total < found[before, after]:
                found[before, after] = total
    return m + n, found


def decided(n: int, weights: dict) -> tuple[int, str]:
    """Cost and audit of a whole conversation of ``n`` turns: the least weight that ends in nothing or behind an assistant; a
    path that ends behind a user gets an inserted assistant, one that ends behind a system turn cannot be the least."""
    high, ends = TURN_BITS * n, []
    for (before, after), weight in weights.items():
        if before == EMPTY and after in (EMPTY, ASSISTANT):
            ends.append(weight << BITS)
        elif before == EMPTY and after == USER:
            ends.append((weight + (INSERT_COST << high) << BITS) + LETTERS.index("I"))
    least = min(ends)
    cost = least >> high + BITS
    digits = least - (cost << high + BITS)
    octal = f"{digits:0{2 * n + 1}o}" if digits else ""
    return cost, octal.replace("0", "").translate({ord(str(i)): x for i, x in enumerate(LETTERS)})


PIECES = (
    "conv_id {id}, place int, whole boolean, turns long, blank long, duplicate long, truncated long, illegal long,"
    " distinct long, least long, most long, first_turn long, last_turn long, first_initial string, last_initial string,"
    " weights binary, cost long, audit string"
)


def packed(n: int, weights: dict) -> bytes:
    parts = [n.to_bytes(8, "big")]
    for (before, after), weight in sorted(weights.items()):
        raw = weight.to_bytes((weight.bit_length() + 7) // 8, "big")
        parts += [bytes((before, after)), len(raw).to_bytes(8, "big"), raw]
    return b"".join(parts)


def unpacked(raw: bytes) -> tuple[int, dict]:
    n, at, weights = int.from_bytes(raw[:8], "big"), 8, {}
    while at < len(raw):
        size = int.from_bytes(raw[at + 2 : at + 10], "big")
        weights[raw[at], raw[at + 1]] = int.from_bytes(raw[at + 10 : at + 10 + size], "big")
        at += 10 + size
    return n, weights


def row_of(conv_id, piece: Piece, whole: bool) -> tuple:
    n, weights = piece.weights()
    cost, audit, raw = None, None, None
    if whole:
        cost, audit = decided(n, weights)
    else:
        raw = packed(n, weights)
    return (
        conv_id, TaskContext.get().partitionId(), whole, n, *piece.faults[1:], piece.illegal, piece.distinct, piece.least,
        piece.most, piece.first_turn, piece.last_turn, piece.first_initial, piece.last_initial, raw, cost, audit,
    )


def pieces_of(schema: pa.Schema):
    """Rows sorted by conversation in, one piece out for each conversation and partition. A partition's first conversation may have
    begun in the partition before and its last may go on: both leave their weights, all others their result."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, number = [], None, 0
        for batch in batches:
            for conv_id, turn, role, copies, fault, again in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if held is None or held[0] != conv_id:
                    if held is not None:
                        out.append(row_of(*held, number > 1))
                    number += 1
                    held = (conv_id, Piece((EMPTY,) if number > 1 else (EMPTY, SYSTEM, USER, ASSISTANT)))
                if copies:
                    held[1].add(turn, role[:1], fault)
                    # Copies by the block, so that their number bounds no memory but the audit's.
                    if copies > 1:
                        held[1].add(turn, role[:1], again, copies - 1)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out = []
        if held is not None:
            out.append(row_of(*held, False))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return of


def together(pieces: pa.Table) -> pa.Table:
    """The pieces of one conversation as one row."""
    found = sorted(pieces.to_pylist(), key=lambda r: r["place"])
    total = dict(found[0])
    for name in ("turns", "blank", "duplicate", "truncated", "illegal", "distinct"):
        total[name] = sum(r[name] for r in found)
    there = [r for r in found if r["turns"]]
    for one, other in zip(there, there[1:]):
        total["illegal"] += one["last_initial"] + other["first_initial"] not in LEGAL
        total["distinct"] -= one["last_turn"] is not None and one["last_turn"] == other["first_turn"]
    total["least"] = min((r["least"] for r in found if r["least"] is not None), default=None)
    total["most"] = max((r["most"] for r in found if r["most"] is not None), default=None)
    cost, audit = decided(*joined([unpacked(r["weights"]) for r in found]))
    total |= {"whole": True, "weights": None, "cost": cost, "audit": audit}
    return pa.Table.from_pylist([total], schema=pieces.schema)


def repair(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``turns(conv_id, turn, role, text, copies)``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256``.

    Turns are taken by ``turn``, null first, then by role and by the SHA-256 of the text; equal ones stand side by side. A row with
    ``copies`` 0 only says that its conversation exists; one without turns has zeros, an empty audit and the digest of an empty
    text. A null role or text is one blank; a null ``conv_id`` is a conversation of its own. ``gaps`` counts missing numbers between the least and the greatest turn
    (null beyond 64 bits).
    No input row, no row. Other columns are not read.

    A long conversation is no large group while it is judged: rows are dealt by ranges of (conversation, turn), every range leaves the least
    weights between any two roles, and those of one conversation are joined. Its digest is one chain over all its
    bytes; the last step streams the sorted rows of a conversation through one task, which holds the audit (a letter a turn) and one row.
    """
    spark = turns.sparkSession
    importable(spark)
    rows = staged(spark, folded(turns), "turns")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    slim = judged(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    slim = slim.select("conv_id", "turn", "role", "copies", "fault", "again")
    ids = rows.schema["conv_id"].dataType.simpleString()
    schema = spark.createDataFrame([], PIECES.format(id=ids)).schema
    pieces = staged(spark, slim.mapInArrow(pieces_of(to_arrow_schema(schema)), schema), "pieces")
    parts = pieces.where("NOT whole").groupBy("conv_id").applyInArrow(together, schema)
    results = pieces.where("whole").unionByName(parts)
    results = staged(spark, results.drop("place", "whole", "weights"), "repairs")
    digests = repaired(rows, results)
    wide = [F.col(c).cast("decimal(20,0)") for c in ("most", "least", "distinct")]
    span = (wide[0] - wide[1] + 1 - wide[2]).try_cast("long")
    gaps = F.when(F.col("least").isNull(), 0).otherwise(span)
    return results.alias("r").join(digests.alias("d"), F.expr("r.conv_id <=> d.conv_id")).select(
        "r.conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )


def repaired(rows: DataFrame, results: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation. The audit comes first among the sorted rows of its conversation and is followed
    letter by letter."""
    audits = results.select(
        "conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("digest"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"),
    )
    body = rows.where("copies > 0").select(
        "conv_id", F.lit(False).alias("head"), F.col("turn").cast("long").alias("turn"), "role",
        F.sha2("text", 256).alias("digest"), "text", "copies",
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("head").desc()]
    order += [F.col(c).asc_nulls_first() for c in ("turn", "role", "digest")]
    dealt = audits.unionByName(body).repartition("conv_id").sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", "head", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "copies")
    ids = results.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(hashed, f"conv_id {ids}, repaired_sha256 string")


class Chain:
    """The digest of one conversation, turn by turn under its audit."""

    def __init__(self, conv_id, audit: bytes):
        self.conv_id, self.audit, self.at = conv_id, audit, 0
        self.sha, self.last, self.empty = hashlib.sha256(), EMPTY, True

    def put(self, role: bytes, text: bytes) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(role + b":")
        self.sha.update(text)
        self.last = INITIALS[role[:1].decode()]

    def other(self) -> bytes:
        """The role that an inserted or changed turn has here."""
        return b"assistant" if self.last == USER else b"user"

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == b"I":
            self.put(self.other(), b"")
            self.at += 1

    def take(self, role: bytes, text: bytes) -> None:
        self.insertions()
        letter = self.audit[self.at : self.at + 1]
        self.at += 1
        if letter == b"K":
            self.put(role, text)
        elif letter == b"R":
            self.put(self.other(), text)

    def row(self) -> tuple:
        self.insertions()
        return self.conv_id, self.sha.hexdigest()


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, chain, schema = [], None, None
    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field(0).type), ("repaired_sha256", pa.string())])
        ids, heads, copies = (batch.column(k).to_pylist() for k in (0, 1, 4))
        for i, (conv_id, head, times) in enumerate(zip(ids, heads, copies)):
            if head:
                if chain is not None:
                    out.append(chain.row())
                chain = Chain(conv_id, batch.column(3)[i].as_py())
                continue
            role, text = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
            for _ in range(times):
                chain.take(role, text)
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if chain is not None:
        out.append(chain.row())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
