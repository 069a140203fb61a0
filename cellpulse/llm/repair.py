"""Repairing the structure of conversations by target alignment.

A conversation is right if the initials of its roles read `(s?(ua)+)?`. Its turns are aligned (Wagner-Fischer) to
every feasible target string of that grammar: keeping a turn costs nothing, giving it another role 1, deleting it 2,
inserting an empty turn 5, and a truncated turn that stays 5 more. The best cost so far bounds both the lengths that
are tried and the band of diagonals that is filled (Ukkonen); of equally cheap alignments the one whose audit, the
initials of its edits in order, is least in ASCII counts.

Conversations are cut into runs of SPAN turns. A run is aligned from each state of the grammar in which it can begin,
and runs are joined state by state: an alignment of the whole is a chain of alignments of its runs, and of two equally
cheap audits between the same states none is a beginning of the other, so the least audit of the whole is made of
least audits. The rows travel in one order by ranges, so a conversation of any length is spread over tasks, which join
their own runs; the pieces of a conversation, at most one per task, are then joined in turn. Texts are streamed, never
gathered.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpulse.llm.memory import streaming
from cellpulse.staging import written

# Fixed values of the edits.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns that are aligned at once.
SPAN = 32
#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {"s": "system", "u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"


def damaged(told: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of all rows, damaged by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties
    its text, 2 removes `.`, `!` and `?` from it, 3 repeats it, 4 makes its role user. Nulls in role and text are one
    space, a null conv_id or turn is one space in the hashed string."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    return (
        told.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
        .filter("kind != 0")
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def placed(told: DataFrame) -> DataFrame:
    """The written table of turns with `place`, which orders the turns of a conversation by turn (null first), role
    and text, the initial of the role and the first two faults. Equal rows are told apart by their place in the
    input, so that no number of them has to share a task."""
    rows = told.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    ).withColumn("row", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "role", "text", "row"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    return written(
        ordered.select(
            "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place"),
            F.substring("role", 1, 1).alias("initial"), (said == "").alias("blank"),
            (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("truncated"),
        ),
        "turns",
    )


def _firsts(turns: DataFrame) -> DataFrame:
    """Places of turns whose role and text no earlier turn of the conversation has."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return turns.select("conv_id", F.unhex(same).alias("same"), "place").groupBy("conv_id", "same").agg(
        F.min("place").alias("place")
    )


# --- alignment ---------------------------------------------------------------------------------------


def targets(state: int, length: int) -> list[str]:
    """The strings of `length` initials by which the grammar goes on from a state."""
    if not length:
        return [""]
    follow = lambda first: ("ua" if first == "u" else "au") * (length // 2 + 1)
    if state == BEGIN:
        return [follow("u")[:length], "s" + follow("u")[: length - 1]]
    return [follow("a" if state == USER else "u")[:length]]


def _align(rows: tuple[str, ...], target: str, bound: int) -> tuple[int, str] | None:
    """Cheapest alignment of turns to a target if it costs at most `bound`, with its least audit.

    A turn is its initial (upper case: truncated), or `!` if it has to go."""
    n, m = len(rows), len(target)
    never = bound + 1
    # Row i of `costs` holds the cost from (i, j) to the end for j in a band; beyond it the costs exceed the bound.
    back, on = bound // DELETE, bound // INSERT
    costs: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here, below = costs[i], costs[i + 1] if i < n else {}
        # i - j turns more are behind than targets: each was deleted; j - i targets more: each was inserted.
        for j in range(min(m, i + on), max(0, i - back) - 1, -1):
            if i == n and j == m:
                here[j] = 0
                continue
            best = never
            if j < m and target[j] != "s":
                best = min(best, INSERT + here.get(j + 1, never))
            if i < n:
                best = min(best, DELETE + below.get(j, never))
                if j < m and rows[i] != "!":
                    step = _step(rows[i], target[j])
                    if step is not None:
                        best = min(best, step + below.get(j + 1, never))
            if best <= bound:
                here[j] = best
    total = costs[0].get(0)
    if total is None:
        return None
    audit, i, j, left = [], 0, 0, total
    while i < n or j < m:
        # In ASCII order; what is left must be paid exactly.
        if i < n and costs[i + 1].get(j) == left - DELETE:
            audit.append("D")
            i, left = i + 1, left - DELETE
        elif j < m and target[j] != "s" and costs[i].get(j + 1) == left - INSERT:
            audit.append("I")
            j, left = j + 1, left - INSERT
        else:
            left = costs[i + 1][j + 1]
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


def _step(row: str, wanted: str) -> int | None:
    cost = TRUNCATED if row.isupper() else 0
    if row.lower() == wanted:
        return cost
    return cost + RELABEL if wanted != "s" else None


@lru_cache(1 << 14)
def aligned(rows: tuple[str, ...], state: int) -> dict[int, tuple[int, str]]:
    """Of a run of turns that begins in `state`: for each state in which it can end, cost and audit."""
    stay = sum(r != "!" for r in rows)
    found: dict[int, tuple[int, str]] = {}
    # Turns that stay and targets differ by deletions or insertions: the least cost that a length allows.
    least = lambda k: DELETE * (len(rows) - stay) + (DELETE * (stay - k) if k < stay else INSERT * (k - stay))
    # Deleting a turn beside an insertion instead is cheaper and leads to the same state: no best alignment has more
    # targets than the larger of the turns and three.
    for length in sorted(range(len(rows) + 4), key=lambda k: (least(k), k)):
        for target in targets(state, length):
            end = AFTER[target[-1]] if target else state
            bound = found[end][0] if end in found else DELETE * len(rows) + INSERT * length
            if least(length) > bound:
                continue
            made = _align(rows, target, bound)
            if made and (end not in found or made < found[end]):
                found[end] = made
    return found


def _joined(a: dict, b: dict) -> dict:
    """Alignments of two neighbouring runs: {(state before, state after): (cost, audit)}."""
    made: dict = {}
    for (p, q), (cost, audit) in a.items():
        for (q2, r), (more, rest) in b.items():
            if q == q2:
                now = cost + more, audit + rest
                if (p, r) not in made or now < made[p, r]:
                    made[p, r] = now
    return made


def _of_run(codes: list[str], states) -> dict:
    rows = tuple(codes)
    return {(p, q): found for p in states for q, found in aligned(rows, p).items()}


class Piece:
    """Consecutive turns of one conversation in one task."""

    def __init__(self, conv_id, place: int, whole: bool):
        self.conv_id, self.place = conv_id, place
        # What begins inside a task's rows is the beginning of its conversation.
        self.states = (BEGIN,) if whole else tuple(range(4))
        self.chain: dict = {(p, p): (0, "") for p in self.states}
        self.codes: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, initial: str, blank: bool, first: bool, truncated: bool):
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        gone = blank or not first
        self.blank += blank
        self.duplicate += not blank and not first
        self.truncated += not gone and truncated
        # Initials that are none of the grammar's differ from all of them in the same way.
        known = initial if initial in AFTER else "x"
        self.codes.append("!" if gone else known.upper() if truncated else known)
        if len(self.codes) == SPAN:
            self._end_run()

    def _end_run(self):
        if self.codes:
            self.chain = _joined(self.chain, _of_run(self.codes, sorted({q for _, q in self.chain})))
            self.codes = []

    def row(self) -> tuple:
        self._end_run()
        chain = [(p, q, cost, audit) for (p, q), (cost, audit) in sorted(self.chain.items())]
        return (
            self.conv_id, self.place, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
            [{"p": p, "q": q, "cost": c, "audit": a} for p, q, c, a in chain],
        )


CHAIN = "array<struct<p:int,q:int,cost:bigint,audit:string>>"
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _chain_type() -> pa.DataType:
    return pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _columns(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _pieces(id_type: pa.DataType):
    names = ["conv_id", "place", *COUNTS, "first", "last", "chain"]
    types = [id_type, pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), _chain_type()]

    def rows(batches):
        piece, out = None, []
        for batch in batches:
            for conv_id, place, initial, blank, first, truncated in zip(
                *(batch.column(n).to_pylist() for n in ("conv_id", "place", "initial", "blank", "first", "truncated"))
            ):
                if piece is None or piece.conv_id != conv_id:
                    if piece:
                        out.append(piece.row())
                    piece = Piece(conv_id, place, whole=piece is not None)
                piece.add(initial, blank, first, truncated)
            if len(out) > 1024:
                yield _columns(out, names, types)
                out = []
        if piece:
            out.append(piece.row())
        yield _columns(out, names, types)

    return rows


def _chained(id_type: pa.DataType):
    """Joins the pieces of a conversation, which come one after the other, and picks the whole's alignment."""
    names = ["conv_id", *COUNTS, "cost", "audit"]
    types = [id_type, *[pa.int64()] * 5, pa.string()]

    def rows(batches):
        held, out = None, []

        def done():
            chain = held[6]
            cost, audit = min(chain[BEGIN, q] for q in (BEGIN, ASSISTANT) if (BEGIN, q) in chain)
            out.append((held[0], *held[1:5], cost, audit))

        for batch in batches:
            for row in batch.to_pylist():
                chain = {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in row["chain"]}
                counts = [row[n] for n in COUNTS]
                if held and held[0] == row["conv_id"]:
                    counts = [a + b for a, b in zip(held[1:5], counts)]
                    counts[3] += held[5] + row["first"] not in ("su", "ua", "au")
                    held = (row["conv_id"], *counts, row["last"], _joined(held[6], chain))
                else:
                    if held:
                        done()
                    held = (row["conv_id"], *counts, row["last"], chain)
            if len(out) > 1024:
                yield _columns(out, names, types)
                out = []
        if held:
            done()
        yield _columns(out, names, types)

    return rows


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation of `turns`, a table
    that `placed` wrote."""
    kind, id_type = _ids(turns)
    slim = turns.select("conv_id", "place", "initial", "blank", "truncated")
    firsts = _firsts(turns).select("place", F.lit(True).alias("first"))
    marked = slim.join(firsts, "place", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    pieces = marked.repartitionByRange("place").sortWithinPartitions("place").mapInArrow(
        streaming(_pieces(id_type)),
        f"conv_id {kind}, place bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, "
        f"last string, chain {CHAIN}",
    )
    chained = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        streaming(_chained(id_type)),
        f"conv_id {kind}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string",
    )
    gaps = turns.groupBy(F.col("conv_id").alias("of")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    return chained.join(gaps, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "gaps", *COUNTS, "cost", "audit")


# --- applying the audits -----------------------------------------------------------------------------


def _ids(df: DataFrame) -> tuple[str, pa.DataType]:
    kind = dict(df.dtypes)["conv_id"]
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


class _Mender:
    """Follows an audit through the turns of a conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, BEGIN

    def inserted(self):
        """Turns that are inserted before the next given turn, or at the end."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield "I", NAMES[self._next()], ""

    def turn(self, initial: str, role: str, text: str):
        """The edit of the next given turn, and the turn that it leaves, if any."""
        edit = self.audit[self.at]
        if edit == "D":
            self.at += 1
            return None
        if edit == "K":
            self.at, self.state = self.at + 1, AFTER[initial]
            return "K", role, text
        return "R", NAMES[self._next()], text

    def _next(self) -> str:
        self.at += 1
        self.state = ASSISTANT if self.state == USER else USER
        return "a" if self.state == ASSISTANT else "u"


def _merged(told: DataFrame, turns: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation in a run of rows: its id (kind 0), its audit (1) and its turns in order (2)."""
    none = lambda t: F.lit(None).cast(t)
    numbers = ["gaps", *COUNTS, "cost"]
    ids = told.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("place"), none("string").alias("initial"),
        none("string").alias("role"), none("string").alias("text"), *[F.lit(0).cast("bigint").alias(n) for n in numbers],
    )
    notes = found.select(
        "conv_id", F.lit(1), F.lit(0).cast("bigint"), none("string"), none("string"), "audit", *numbers
    )
    rows = turns.select(
        "conv_id", F.lit(2), "place", "initial", "role", "text", *[none("bigint") for _ in numbers]
    )
    return ids.unionAll(notes).unionAll(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "place")


def _walk(batches):
    """(row of the conversation with its notes, None) and then (that row, (edit, role, text)) for each turn that the
    repaired conversation has, conversation by conversation."""
    mender, head = None, None
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            for now in batch.slice(a, 256).to_pylist():
                if now["kind"] < 2:
                    # A conversation's id is followed by its audit, if it has turns.
                    for x in mender.inserted() if mender and now["kind"] == 0 else ():
                        yield head, x
                    mender, head = _Mender(now["text"] or ""), now
                    yield head, None
                    continue
                for x in mender.inserted():
                    yield head, x
                left = mender.turn(now["initial"], now["role"], now["text"])
                if left:
                    yield head, left
    for x in mender.inserted() if mender else ():
        yield head, x


def repaired(told: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role and text of the repaired conversations of `told`.

    `told` has conv_id (bigint, int or string), turn, role and text; other columns are not read. Turns are ordered by
    turn, null first, then role and text. A null role or text is one space, a null conv_id a conversation like any
    other. A role without characters fits no place of the grammar. Blank turns and those whose role and text stand
    earlier in the conversation are deleted. A conversation without turns, and an empty table, give no rows.
    """
    kind, id_type = _ids(told)
    turns = placed(told)
    names, types = ["conv_id", "place", "edit", "role", "text"], [id_type, pa.int64(), *[pa.string()] * 3]

    def rows(batches):
        out, n, size = [], 0, 0
        for head, turn in _walk(batches):
            if turn is None:
                n = 0
                continue
            out.append((head["conv_id"], n, *turn))
            n, size = n + 1, size + len(turn[2])
            if len(out) == 1024 or size > 1 << 24:
                yield _columns(out, names, types)
                out, size = [], 0
        yield _columns(out, names, types)

    return _merged(told, turns, audits(turns)).mapInArrow(
        streaming(rows), f"conv_id {kind}, place bigint, edit string, role string, text string"
    )


def audited(told: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of the repaired turns as
    `role:text`, joined by newlines) of every conversation of `told`, and of `of` (more conv_ids) if given.

    gaps is the last turn less the first plus one less the distinct turns, without nulls (all null: 0); blank,
    duplicate and truncated count the first fault of each turn, illegal neighbouring roles that aren't su, ua or au.
    A conversation without turns has zeros, an empty audit and the digest of nothing. Else as `repaired`.
    """
    kind, id_type = _ids(told)
    turns = placed(told)
    numbers = ["gaps", *COUNTS, "cost"]
    names = ["conv_id", *numbers, "audit", "repaired_sha256"]
    types = [id_type, *[pa.int64()] * len(numbers), pa.string(), pa.string()]

    def rows(batches):
        out, last, digest, n = [], None, None, 0

        def told_row():
            return (last["conv_id"], *(last[k] for k in numbers), last["text"] or "", digest.hexdigest())

        for head, turn in _walk(batches):
            if turn is not None:
                digest.update(("\n" * (n > 0) + f"{turn[1]}:{turn[2]}").encode())
                n += 1
                continue
            if last and head["kind"] == 0:
                out.append(told_row())
                if len(out) == 1024:
                    yield _columns(out, names, types)
                    out = []
            last, digest, n = head, hashlib.sha256(), 0
        if last:
            out.append(told_row())
        yield _columns(out, names, types)

    ids = told.select("conv_id") if of is None else told.select("conv_id").unionAll(of.select("conv_id"))
    return _merged(ids, turns, audits(turns)).mapInArrow(
        streaming(rows),
        f"conv_id {kind}, {', '.join(f'{n} bigint' for n in numbers)}, audit string, repaired_sha256 string",
    )
