"""Repair of a conversation's structure by a DAG of scalar weights (operator 13).

A conversation is repaired if its roles' initials read ``(s?(ua)+)?``: perhaps
a system message, then user and assistant in turn. Rows may be kept (K), given
the role that is due (R) or deleted (D); empty messages of the role that is due may be
inserted (I). Nodes of the DAG are (row, what came last). The weight of a path
is one integer: its high digits are the cost, its low digits, a fixed number of them,
hold the letters of the edits in order from the highest place on,
with zeros after the last. The least integer is then the cheapest repair, and
of these the one whose letters come first, a repair that ends before any that goes on.

Conversations are sorted by range, so one that holds a large share of all rows
lies in many partitions. It is worked on in pieces: a piece gives the least
weights from each state before it to each state after it; choosing among
these, back from the end, is one more integer minimum. An edit string of a piece
ends with its last row, so two of them never begin with one another, and what
comes after a piece can't change which of two equally cheap ones is first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize

PIECE_ROWS, PIECE_CHARS = 4096, 8 << 20  # where a conversation is cut
#: What came last: nothing, system, user, assistant. Which initial leads where, and the role that is due.
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
DUE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER_DUE = {0: 2, 1: 2, 2: 3, 3: 2}
#: Digits of the letters, in ASCII's order; 0 is the end. KEEP, REROLE, DELETE, INSERT and CUT (a truncated row stays) cost:
LETTERS, DIGIT = " DIKR", {"D": 1, "I": 2, "K": 3, "R": 4}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
BITS = 3  # of a digit
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}


def fault(text: str, seen: bool) -> int:
    """The first fault of a row, ``seen`` if an earlier one of its conversation has its role and text."""
    words = text.rstrip(" \t\n\x0b\x0c\r")
    return BLANK if not words else DUPLICATE if seen else FINE if words[-1] in ".!?" else TRUNCATED


def edit(weight: int, letter: str, cost: int, width: int) -> int:
    """The weight of a path with one more edit before it: its letters move one place down."""
    letters = weight & ((1 << width) - 1)
    return weight - letters + (cost << width) + (DIGIT[letter] << (width - BITS)) + (letters >> BITS)


def least(rows: list[tuple[str, int]], last: dict[int, int], width: int) -> dict[int, int]:
    """For each state before ``rows`` (initial, fault) the least weight of their edits and what follows, ``last`` by state."""
    after = last
    for initial, wrong in reversed(rows):
        here = {}
        for state in range(4):
            ways = []
            if state in after:
                ways.append(edit(after[state], "D", DELETE, width))
            if wrong in (FINE, TRUNCATED):
                more = CUT if wrong == TRUNCATED else 0
                if (to := NEXT.get((initial, state))) in after:
                    ways.append(edit(after[to], "K", KEEP + more, width))
                if (to := AFTER_DUE[state]) in after:
                    ways.append(edit(after[to], "R", REROLE + more, width))
            if ways:
                here[state] = min(ways)
        # Two inserts at most: a third leads back to where the first did.
        for _ in range(2):
            more_due = {s: edit(here[to], "I", INSERT, width) for s, to in AFTER_DUE.items() if to in here}
            here = {s: min(x[s] for x in (here, more_due) if s in x) for s in here | more_due}
        after = here
    return after


def wide(n_rows: int) -> int:
    """Bits of the letters: one for each row, two inserts before each and two at the end."""
    return BITS * (3 * n_rows + 2)


def at_end(width: int) -> dict[int, int]:
    """Weights after the last row: done, or one or two inserts."""
    user = edit(0, "I", INSERT, width)
    return {0: 0, 3: 0, 2: user, 1: edit(user, "I", INSERT, width)}


def letters_of(weight: int, width: int) -> str:
    low = weight & ((1 << width) - 1)
    octal = f"{low:0{width // BITS}o}".rstrip("0")
    return octal.translate(str.maketrans("1234", LETTERS[1:]))


def repaired(rows: list[tuple[str, str]], audit: str, state: int = 0) -> list[str]:
    """``role:text`` of what the edits leave of ``rows``, from ``state`` on."""
    out, left = [], iter(rows)
    for letter in audit:
        role, text = (DUE[state], "") if letter == "I" else next(left)
        if letter == "D":
            continue
        state = NEXT[role[:1], state] if letter == "K" else AFTER_DUE[state]
        out.append(f"{role if letter == 'K' else 'user' if state == 2 else 'assistant'}:{text}")
    return out


class Piece:
    """Rows of one conversation that stand one after another, with what the counts need."""

    def __init__(self, conv: int | None, seq: int) -> None:
        self.conv, self.seq, self.chars = conv, seq, 0
        self.rows: list[tuple[str, str]] = []
        self.faults: list[int] = []
        self.turns: list[int] = []  # the least, the greatest, and how many
        self.illegal, self.ends = 0, ""  # the initials of the first and the last row, parted by a null character

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if self.rows:
            self.illegal += (self.rows[-1][0][:1] + role[:1]) not in LEGAL
        self.rows.append((role, text))
        self.faults.append(fault(text, seen))
        self.chars += len(text)
        if turn is not None:
            self.turns = [turn, turn, 1] if not self.turns else [self.turns[0], turn, self.turns[2] + (turn != self.turns[1])]

    def row(self, whole: bool) -> dict:
        """The piece as a row: of a whole conversation the repair, of another what is needed to go on."""
        steps = [(role[:1], f) for (role, _), f in zip(self.rows, self.faults)]
        low, high, many = self.turns or (None, None, 0)
        out = {"conv_id": self.conv, "whole": whole, "seq": self.seq, "low": low, "high": high, "distinct": many, "blank": self.faults.count(BLANK),
               "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(TRUNCATED), "illegal": self.illegal}
        width = wide(len(self.rows))
        if whole:
            weight = least(steps, at_end(width), width)[0]
            audit = letters_of(weight, width)
            return out | {"cost": weight >> width, "audit": audit, "repaired": "\n".join(repaired(self.rows, audit))}
        ways = []
        for to in range(4):
            for state, weight in least(steps, {to: 0}, width).items():
                ways.append({"state": state, "to": to, "cost": weight >> width, "audit": letters_of(weight, width)})
        first = self.rows[0][0][:1] + "\0" + self.rows[-1][0][:1] if self.rows else None
        return out | {"ends": first, "ways": ways, "roles": [r for r, _ in self.rows], "texts": [t for _, t in self.rows]}


PIECES = pa.schema([("conv_id", pa.int64()), ("whole", pa.bool_()), ("part", pa.int32()), ("seq", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64()),
                    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string()),
                    ("ends", pa.string()), ("ways", pa.list_(pa.struct([("state", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
PIECES_SQL = ("conv_id long, whole boolean, part int, seq long, low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string, "
              "ends string, ways array<struct<state int, to int, cost long, audit string>>, roles array<string>, texts array<string>")
DECIDED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("state", pa.int32()), ("chosen", pa.string()), ("paid", pa.int64()), ("crossed", pa.int64()), ("met", pa.int64())])


def pieces(batches: Iterator[pa.RecordBatch], piece_rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Pieces of a partition's sorted rows; only a conversation that begins and ends within the partition can be whole."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    out: list[dict] = []
    held, size, inner = None, 0, False  # the piece that is open; characters in ``out``; whether it began after another conversation
    for batch in batches:
        for conv, turn, role, text, gone, seen in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "seen"))):
            if held is None:
                held = Piece(conv, 0)
            elif held.conv != conv:
                out.append(held.row(inner and not held.seq))
                size, held, inner = size + held.chars, Piece(conv, 0), True
            elif len(held.rows) >= piece_rows or held.chars >= PIECE_CHARS:
                out.append(held.row(False))
                size, held = size + held.chars, Piece(conv, held.seq + 1)
            if not gone:
                held.add(turn, role, text, seen)
            if size >= PIECE_CHARS or len(out) >= PIECE_ROWS:
                yield pa.RecordBatch.from_pylist([r | {"part": part} for r in out], PIECES)
                out, size = [], 0
    if held is not None:
        out.append(held.row(False))
    if out:
        yield pa.RecordBatch.from_pylist([r | {"part": part} for r in out], PIECES)


def decide(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the pieces of one conversation the state before each and its edits; counts that cross from piece to piece."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["part"], r["seq"]))
    width = BITS * (max((len(w["audit"]) for r in rows for w in r["ways"]), default=0) + 1)
    digits = str.maketrans(LETTERS[1:], "1234")
    number = lambda audit: int(audit.translate(digits).ljust(width // BITS, "0"), 8)
    togo = {0: 0, 3: 0, 2: INSERT, 1: 2 * INSERT}  # after the last piece
    best = []
    for r in reversed(rows):
        choice: dict[int, tuple[int, dict]] = {}
        for w in r["ways"]:
            if w["to"] in togo:
                weight = ((w["cost"] + togo[w["to"]]) << width) + number(w["audit"])
                if w["state"] not in choice or weight < choice[w["state"]][0]:
                    choice[w["state"]] = weight, w
        best.append({s: w for s, (_, w) in choice.items()})
        togo = {s: weight >> width for s, (weight, _) in choice.items()}
    state, out, last, high = 0, [], None, None
    for r, choice in zip(rows, reversed(best)):
        way = choice[state]
        crossed = met = 0
        if r["ends"] is not None:
            a, b = r["ends"].split("\0")
            crossed = int(last is not None and last + a not in LEGAL)
            last = b
        if r["distinct"]:
            met = int(high is not None and high == r["low"])
            high = r["high"]
        out.append({"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "state": state, "chosen": way["audit"], "paid": way["cost"], "crossed": crossed, "met": met})
        state = way["to"]
    close = {0: "", 3: "", 2: "I", 1: "II"}[state]
    tail = {"conv_id": out[-1]["conv_id"], "part": out[-1]["part"], "seq": out[-1]["seq"] + 1, "state": state, "chosen": close, "paid": INSERT * len(close), "crossed": 0, "met": 0}
    yield pa.RecordBatch.from_pylist([*out, tail], DECIDED)


def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that a piece's chosen edits leave."""
    for batch in batches:
        lines = [repaired(list(zip(roles or [], texts or [])), audit, state) for roles, texts, audit, state in zip(*(batch.column(c).to_pylist() for c in ("roles", "texts", "chosen", "state")))]
        kept = [f for f in batch.schema.names if f not in ("roles", "texts")]
        yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in kept), pa.array(["\n".join(x) or None for x in lines], pa.string())], [*kept, "lines"])


COUNTS = ["blank", "duplicate", "truncated"]


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired), one row for each conv_id.

    ``rows`` has conv_id, turn, role, text and perhaps ``gone``: such a row
    only says that its conversation exists. Rows are taken by turn (nulls
    first), rows of one turn by role and text. A null conv_id is a
    conversation of its own; a null role or text is one space, so the text is
    blank; repeated rows are duplicates. An empty table gives no rows; other columns are left out.
    A conversation without rows has zeros and empty strings. One of more than
    ``piece_rows`` rows, or that lies in several partitions, is worked on in pieces.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    named = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), gone.alias("gone"))
    said = F.concat_ws("\0", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), "role", "text")
    # A row that is gone says nothing; its place stands in, so that such rows don't share a null key in the join below.
    place = F.monotonically_increasing_id()
    named = named.withColumn("place", place).withColumn("said", F.when(~F.col("gone"), F.unhex(F.sha2(said, 256))).otherwise(F.col("place").cast("string").cast("binary")))
    named = materialize(named, "turns")
    # What is said more than once: all but the first are duplicates. One row for each such text, not for each of its copies.
    order = F.struct(F.col("turn").isNotNull(), "turn", "place")
    first = named.where("not gone").groupBy("said").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1").select("said", "first")
    flagged = named.join(first, "said", "left").withColumn("seen", F.col("first").isNotNull() & (order != F.col("first")))
    by = ["conv_id", "turn", "role", "text", "seen", "place"]
    sorted_ = flagged.select("conv_id", "turn", "role", "text", "gone", "seen", "place").repartitionByRange(*by).sortWithinPartitions(*by)
    found = materialize(sorted_.select("conv_id", "turn", "role", "text", "gone", "seen").mapInArrow(partial(pieces, piece_rows=piece_rows), PIECES_SQL), "pieces")

    span = lambda low, high, many: F.when(F.col(low).isNull(), F.lit(0)).otherwise(F.col(high) - F.col(low) + 1 - F.col(many)).alias("gaps")
    done = found.where("whole").select("conv_id", span("low", "high", "distinct"), *COUNTS, "illegal", "cost", "audit", "repaired")
    cut = found.where("not whole")
    chosen = cut.select("conv_id", "part", "seq", "low", "high", "distinct", "ends", "ways").groupBy("conv_id").applyInArrow(decide, "conv_id long, part int, seq long, state int, chosen string, paid long, crossed long, met long")
    chosen = chosen.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("seq").alias("_seq"), "state", "chosen", "paid", "crossed", "met")
    # The inserts after the last piece are a piece without rows.
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq"))
    both = chosen.join(cut.select("conv_id", "part", "seq", "low", "high", "distinct", *COUNTS, "illegal", "roles", "texts"), own, "left")
    lines = both.drop("conv_id", "part", "seq").mapInArrow(written, "_conv long, _part int, _seq long, state int, chosen string, paid long, crossed long, met long, low long, high long, distinct long, "
                                                                    "blank long, duplicate long, truncated long, illegal long, lines string")
    inorder = F.array_sort(F.collect_list(F.struct("_part", "_seq", "chosen", "lines")))
    joined = lines.groupBy(F.col("_conv").alias("conv_id")).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), (F.sum("distinct") - F.sum("met")).alias("distinct"), *[F.sum(c).alias(c) for c in COUNTS],
        (F.sum("illegal") + F.sum("crossed")).alias("illegal"), F.sum("paid").alias("cost"), inorder.alias("o"))
    joined = joined.select("conv_id", span("low", "high", "distinct"), *COUNTS, "illegal", "cost", F.array_join("o.chosen", "").alias("audit"), F.array_join("o.lines", "\n").alias("repaired"))
    return done.unionByName(joined)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(``conv_id:turn``) % 20, for ``repair``: 0 drops a row (it is marked ``gone``), 1 empties
    its text, 2 takes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    c = c.withColumn("code", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("code").isin(0, 1), F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("code") == 0).alias("gone"), copies.alias("_copy")).drop("_copy")
