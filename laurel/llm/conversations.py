"""Cheapest repair of conversations by depth-first branch and bound, in pieces of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from laurel.session import stored_copy

# Rows, and characters of text, of the pieces that are searched by themselves.
PIECE_ROWS = 256
PIECE_CHARS = 1 << 20

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
SPACES = " \t\n\x0b\x0c\r"
# What a repaired conversation ends with so far: nothing, a system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ENDS = (NOTHING, ASSISTANT)
# State after one more row of the role that is due, by insertion or a new role.
_DUE = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
# State after a row that is kept, by the initial of its role.
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_REACHED = {NOTHING: (NOTHING,), SYSTEM: (NOTHING, SYSTEM), USER: STATES, ASSISTANT: STATES}
_LEGAL = {"su", "ua", "au"}

# A row as the search sees it: initial of the role, whether it has to go, cost of leaving it.
Step = tuple[str, bool, int]


def fault(text: str, repeated: bool) -> str:
    """First fault of a row: 'blank', 'duplicate', 'truncated', or ''."""
    solid = text.strip(SPACES)
    if not solid:
        return "blank"
    return "duplicate" if repeated else "" if solid[-1] in ".!?" else "truncated"


def suffix_bounds(steps: list[Step], end: int) -> tuple[list[int], list[int]]:
    """Least cost from each row on, if a user row is due there and if an assistant row is.

    A relaxation: only the alternation counts, so a system row may stay anywhere. No repair is cheaper.
    """
    user, assistant = (2, 0) if end == USER else (0, 2)
    bounds = [(user, assistant)]
    for initial, forced, extra in reversed(steps):
        due = []
        for own, other, letter in ((user, assistant, "u"), (assistant, user, "a")):
            best = DELETE + own
            if not forced:
                best = min(best, REROLE + extra + other)
                if initial == letter:
                    best = min(best, extra + other)
                elif initial == "s":
                    best = min(best, extra + own)
            due.append(best)
        user, assistant = min(due[0], INSERT + due[1]), min(due[1], INSERT + due[0])
        bounds.append((user, assistant))
    bounds.reverse()
    return [b[0] for b in bounds], [b[1] for b in bounds]


def search(steps: list[Step], start: int, end: int) -> tuple[int, str] | None:
    """Cheapest edits, ties ASCII-least, that lead from state `start` over `steps` to state `end`.

    Depth first with an explicit stack, the most promising edit first. A prefix is dropped if its cost and the
    bound of the rest, or at equal cost its edits, cannot beat the best whole repair so far, or if a prefix of
    the same node was no worse: of equal cost over equal rows, no edits begin with the others, so the order of
    prefixes stays that of the whole repairs. None if `end` cannot be reached.
    """
    n = len(steps)
    to_user, to_assistant = suffix_bounds(steps, end)
    bounds = (to_user, to_user, to_assistant, to_user)
    reached = _REACHED[end]
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")] if start in reached else []
    while stack:
        row, state, cost, audit = stack.pop()
        low = cost + bounds[state][row]
        if best is not None and (low > best[0] or low == best[0] and audit > best[1][: len(audit)]):
            continue
        held = table.get((row, state))
        if held is not None and held <= (cost, audit):
            continue
        table[row, state] = (cost, audit)
        if row == n and state == end:
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        onward = [(row, _DUE[state], cost + INSERT, audit + "I")]
        if row < n:
            initial, forced, extra = steps[row]
            onward.append((row + 1, state, cost + DELETE, audit + "D"))
            if not forced:
                onward.append((row + 1, _DUE[state], cost + REROLE + extra, audit + "R"))
                if initial in _KEPT[state]:
                    onward.append((row + 1, _KEPT[state][initial], cost + KEEP + extra, audit + "K"))
        onward = [x for x in onward if x[1] in reached]
        onward.sort(key=lambda x: (x[2] + bounds[x[1]][x[0]], x[3]), reverse=True)
        stack += onward
    return best


def edited(rows: list[tuple[str, str]], state: int, audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that `audit` leaves of (role, text) rows, beginning in `state`."""
    left = iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = "", ""
        else:
            role, text = next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = _KEPT[state][role[:1]]
        else:
            state = _DUE[state]
            role = _ROLES[state]
        yield edit, role, text


class Chain:
    """The best repair of a conversation's rows so far, for each state it may end in."""

    def __init__(self):
        # State: cost, edits, hash of the repaired text, whether it has a row, the pieces' edits.
        self.live = {NOTHING: (0, "", hashlib.sha256(), False, None)}
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.low = self.high = self.turn = None
        self.initial: str | None = None

    def see(self, turn: int | None, role: str, kind: str) -> None:
        if kind:
            self.faults[kind] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None:
            self.distinct += self.turn != turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn

    def extend(self, part: int, piece: int, rows: list[tuple[str, str]], choices: list[dict]) -> None:
        """Lead every state over one more piece; `choices` are its best edits from state to state."""
        best: dict[int, tuple] = {}
        for choice in choices:
            if choice["start"] in self.live:
                cost, audit, *_ = self.live[choice["start"]]
                found = (cost + choice["cost"], audit + choice["audit"])
                if choice["end"] not in best or found < best[choice["end"]][0]:
                    best[choice["end"]] = (found, choice)
        live = {}
        for end, ((cost, audit), choice) in best.items():
            _, _, digest, begun, pieces = self.live[choice["start"]]
            digest = digest.copy()
            for _, role, text in edited(rows, choice["start"], choice["audit"]):
                digest.update((f"\n{role}:{text}" if begun else f"{role}:{text}").encode("utf-8", "surrogatepass"))
                begun = True
            live[end] = (cost, audit, digest, begun, (pieces, (part, piece, choice["start"], choice["audit"])))
        self.live = live

    def result(self, conv_id) -> dict:
        cost, audit, digest, _, pieces = min((self.live[s] for s in ENDS if s in self.live), key=lambda x: x[:2])
        links = []
        while pieces is not None:
            pieces, link = pieces
            links.append(dict(zip(("part", "piece", "start", "audit"), link)))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {
            "conv_id": conv_id, "gaps": gaps, **self.faults, "illegal": self.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": digest.hexdigest(), "pieces": links[::-1],
        }


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with known damage, by crc32 of `conv_id:turn` modulo 20; nulls are one space.

    0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it the user's.
    A null conv_id or turn stays null and stands for one space in `conv_id:turn`.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *name).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.where("_kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
    return rows.drop("_copy")


def _searched(kind: str, part_rows: int, part_chars: int):
    """Task over sorted rows: the place of each, its fault, and on the last row of a piece the piece's best edits."""
    choice = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, schema = TaskContext.get().partitionId(), None
        held: list[dict] = []
        chars = piece = 0
        conv = None

        def closed(starts: tuple[int, ...], ends: tuple[int, ...]) -> list[dict]:
            steps = []
            for row in held:
                row["fault"] = fault(row["text"], row.pop("repeated"))
                steps.append((row["role"][:1], row["fault"] in ("blank", "duplicate"), int(row["fault"] == "truncated")))
                row |= {"part": part, "piece": piece, "place": len(steps), "choices": None}
            found = [(a, b, search(steps, a, b)) for a in starts for b in ends]
            held[-1]["choices"] = [{"start": a, "end": b, "cost": x[0], "audit": x[1]} for a, b, x in found if x]
            return held

        # A conversation that the range partitioning may have cut begins or ends in any state.
        starts: tuple[int, ...] = STATES
        for batch in batches:
            if schema is None:
                names = [pa.field("conv_id", batch.schema.field("conv_id").type), pa.field("turn", batch.schema.field("turn").type)]
                schema = pa.schema(names + [("role", pa.string()), ("text", pa.string()), ("part", pa.int32()), ("piece", pa.int32()), ("place", pa.int32()), ("fault", pa.string()), ("choices", pa.list_(choice))])
            out: list[dict] = []
            for row in batch.to_pylist():
                if held and row["conv_id"] != conv:
                    out += closed(starts, ENDS)
                    held, chars, piece = [], 0, 0
                    starts = (NOTHING,)
                elif held and (len(held) >= part_rows or chars >= part_chars):
                    out += closed(starts, STATES)
                    held, chars, piece = [], 0, piece + 1
                    starts = STATES
                conv = row["conv_id"]
                held.append(row)
                chars += len(row["text"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(closed(starts, STATES), schema)

    return task, f"{kind}, role string, text string, part int, piece int, place int, fault string, choices array<struct<start int, end int, cost long, audit string>>"


def searched_rows(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Rows (conv_id, turn, role, text) in order, with part, piece, place in the piece, fault, and the pieces' edits.

    Rows are ranged by (conv_id, turn, ...), so a conversation of any length spreads over tasks; equal rows too,
    by a number of their own. A piece is at most `piece_rows` rows of a conversation in a task. It is searched
    from every state it may begin in to every state it may end in; the last row of a piece holds what was found.
    Turns come in ascending order, nulls first; rows of one turn by role, then by the first 64 characters of the
    text, then by its digest. The table is stored, so a lost executor cannot move the cuts.
    """
    texts = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    numbered = rows.select("conv_id", "turn", *texts, F.monotonically_increasing_id().alias("id"))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.isnull("conv_id"), F.length("role"), "role", "text")
    numbered = stored_copy(numbered.withColumn("digest", F.md5(name.cast("binary"))))
    order = F.struct(F.isnotnull("turn").alias("known"), "turn", "id")
    first = numbered.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = numbered.join(first.select("digest", "first"), "digest", "left")
    marked = marked.withColumn("repeated", F.coalesce(order > F.col("first"), F.lit(False)))
    keys = ["conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64), "digest", "id"]
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "repeated")
    kind = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    task, schema = _searched(kind, piece_rows, piece_chars)
    return stored_copy(ordered.mapInArrow(task, schema))


def chained(searched: DataFrame) -> DataFrame:
    """Best whole repair of each conversation of `searched_rows`.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, and `pieces`: the edits
    of each piece and the state it begins in. The rows of a conversation are streamed in order; a task holds one
    piece, and for each of four states the edits so far and the running hash, which is sequential by its nature.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, conv, schema = None, None, None
        held: list[tuple[str, str]] = []
        for batch in batches:
            if schema is None:
                link = pa.struct([("part", pa.int32()), ("piece", pa.int32()), ("start", pa.int32()), ("audit", pa.string())])
                counts = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                schema = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *counts, ("audit", pa.string()), ("repaired_sha256", pa.string()), ("pieces", pa.list_(link))])
            out = []
            for row in batch.to_pylist():
                if chain is not None and row["conv_id"] != conv:
                    out.append(chain.result(conv))
                    chain = None
                if chain is None:
                    chain, conv = Chain(), row["conv_id"]
                chain.see(row["turn"], row["role"], row["fault"])
                held.append((row["role"], row["text"]))
                if row["choices"] is not None:
                    chain.extend(row["part"], row["piece"], held, row["choices"])
                    held = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if chain is not None:
            yield pa.RecordBatch.from_pylist([chain.result(conv)], schema)

    kind = searched.schema["conv_id"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    ordered = searched.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece", "place")
    return ordered.mapInArrow(task, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string, pieces array<struct<part int, piece int, start int, audit string>>")


def repaired_rows(searched: DataFrame, repairs: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: conv_id, part, piece, place, edit, role, text, in the order of the first four.

    Pieces are edited apart, so a conversation of any length spreads over tasks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                yield from batch.to_pylist()

        out: list[dict] = []
        for _, piece in groupby(rows(), lambda r: (r["conv_id"], r["part"], r["piece"])):
            held = list(piece)
            head = {c: held[0][c] for c in ("conv_id", "part", "piece")}
            kept = edited([(r["role"], r["text"]) for r in held], held[0]["start"], held[0]["audit"])
            out += [head | {"place": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(kept, 1)]
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    result = searched.select("conv_id", "part", "piece", "place", F.col("fault").alias("edit"), "role", "text")
    schema = to_arrow_schema(result.schema)
    links = repairs.select(F.col("conv_id").alias("_conv"), F.explode("pieces").alias("link")).select("_conv", "link.*")
    links = links.withColumnsRenamed({"part": "_part", "piece": "_piece"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("piece") == F.col("_piece"))
    joined = searched.drop("choices").join(links, same).select("conv_id", "part", "piece", "place", "role", "text", "start", "audit")
    ordered = joined.repartition("conv_id", "part", "piece").sortWithinPartitions("conv_id", "part", "piece", "place")
    return ordered.mapInArrow(task, result.schema)


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Repairs of `rows`, one row for every conv_id of `conversations`; conversations without rows have zeros.

    Keep costs 0, another role (user, assistant) 2, delete 3, insert an empty user or assistant row 2; a
    truncated row that stays adds 1. Blank rows, and rows whose role and text came before, have to go. The
    result's role initials are `(s?(ua)+)?`; among the cheapest edits those whose initials are ASCII-least.
    Null roles and texts count as one space; an empty role has no initial and is never kept. A null conv_id is a
    conversation like others. Null turns come first. Extra columns are not looked at; no rows give no rows.
    """
    found = chained(searched_rows(rows)).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    joined = every.join(found, every.conv_id.eqNullSafe(found["_conv"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)
