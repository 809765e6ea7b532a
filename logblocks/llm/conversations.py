"""Conversation repair: the cheapest edits that make a damaged conversation legal, by rank-convergence parallel Viterbi.

A legal conversation is empty, or ``user assistant`` any number of times with at most one ``system`` in front. Its
four states (nothing yet, after system, user, assistant) and the edits of a row (Keep, Rerole, Delete, and Insert in
front of it) make a shortest-path problem. ``B[i]`` holds the cost from each state before row i to the end.

1. Rows are range-partitioned by conversation and order, so a conversation of any length lies in many tasks.
   Each task packs what it has of a conversation into chunks of at most ``CHUNK_ROWS`` rows.
2. All chunks run backward at once, each from the same speculative vector at its right end.
3. Fix-up passes: a chunk whose right neighbour ended in another vector runs again from that one, until at
   some row the new and the old vector differ by a constant only; from there on the old run holds, moved by that constant.
   Passes end when no chunk's right vector changed. Chunks of forced deletions alone pass a vector on as it
   is and are skipped over. Vectors are kept with their smallest cost taken out, so equal up to a constant means equal.
4. Every chunk traces the least audit forward from each of the four states; one small row per chunk gives
   the state in which each chunk begins, and all chunks write their edits and repaired rows at once.

Only the digest of a whole repaired conversation is sequential: its pieces pass through one task in order, as a
stream. Nothing else meets in one task but one small row per chunk, and that in a stream as well.

Null ids, roles and texts read as one space; a null conv_id is a conversation of its own and comes back as null. Rows of one
turn stand in the order of role, then of the text's SHA-256; null turns come first. A row with an empty role or one whose
first letter is not s, u or a cannot be kept. Repeated rows are duplicates of the first. An empty table
gives an empty result. Only the four columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logblocks.llm.common import SPACES, partitions
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

CHUNK_ROWS = 2_048
CHUNK_BYTES = 256 << 10
FAULTS = ("blank", "duplicate", "truncated")

# --- the edits of one row -------------------------------------------------------------------------------------------

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# Where the initial of the next role leads; a missing one is not legal there.
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
SPOKEN = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))  # what Rerole and Insert write
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 20
INITIALS = "sua"


def code_of(initial: str, fault: int) -> int:
    """All that the costs of a row depend on: the role's initial and the fault."""
    return (INITIALS.find(initial) if initial else -1) % 4 | (4 if fault in (1, 2) else 8 if fault == 3 else 0)


def edits(state: int, code: int):
    """``(letter, cost, next state, role written)`` of the edits that use up a row, by letter."""
    found = [("D", DELETE, state, None)]
    if not code & 4:
        extra = TRUNCATED if code & 8 else 0
        initial = (INITIALS + " ")[code & 3]
        if initial in STEP[state]:
            found.append(("K", KEEP + extra, STEP[state][initial], ""))
        role, after = SPOKEN[state]
        found.append(("R", REROLE + extra, after, role))
    return found


def with_inserts(costs: list[int]) -> list[int]:
    """Costs before a row when inserts in front of it are allowed."""
    for _ in costs:
        costs = [min(c, INSERT + costs[SPOKEN[q][1]]) for q, c in enumerate(costs)]
    return costs


def pack(costs: list[int]) -> tuple[int, int]:
    """The vector without its smallest cost, four bits a state, and that cost."""
    least = min(costs)
    if max(costs) - least > 15:
        raise AssertionError("costs of two states differ by a few edits at most")
    return sum((c - least) << 4 * q for q, c in enumerate(costs)), least


def unpack(vector: int) -> list[int]:
    return [vector >> 4 * q & 15 for q in range(4)]


END = pack(with_inserts([0, NEVER, NEVER, 0]))[0]  # legal ends are nothing and assistant
_backward: dict[tuple[int, int], tuple[int, int]] = {}
_forward: dict[tuple[int, int, int], tuple[str, int, tuple, str | None]] = {}


def before(vector: int, code: int) -> tuple[int, int]:
    """The packed vector before a row from that behind it, and what was taken out."""
    found = _backward.get((vector, code))
    if found is None:
        costs = unpack(vector)
        used = [min(cost + costs[after] for _, cost, after, _ in edits(q, code)) for q in range(4)]
        found = _backward[vector, code] = pack(with_inserts(used))
    return found


def run_backward(codes: bytes, right: int) -> tuple[array, int]:
    """The vector before each row, and the constants summed."""
    vectors, total = array("H", bytes(2 * len(codes))), 0
    for i in range(len(codes) - 1, -1, -1):
        right, constant = before(right, codes[i])
        vectors[i] = right
        total += constant
    return vectors, total


def fix_up(codes: bytes, vectors: array, total: int, old_right: int, right: int) -> tuple[array, int]:
    """``run_backward`` from another right vector, as far as it changes anything but a constant."""
    vectors = vectors[:]
    for i in range(len(codes) - 1, -1, -1):
        right, new = before(right, codes[i])
        old_right, old = before(old_right, codes[i])
        total += new - old
        if right == old_right:
            break
        vectors[i] = right
    return vectors, total


def edits_before_next(state: int, vector: int, code: int):
    """The least letters that use up a row on a cheapest path: ``(letters, next state, roles inserted, role written)``."""
    found = _forward.get((state, vector, code))
    if found is None:
        behind = unpack(vector)
        packed, constant = before(vector, code)
        here = [c + constant for c in unpack(packed)]
        letters, inserted, at = "", [], state
        while True:
            options = [("I", INSERT + here[SPOKEN[at][1]], SPOKEN[at][1], SPOKEN[at][0])]
            options += [(letter, cost + behind[after], after, role) for letter, cost, after, role in edits(at, code)]
            letter, _, after, role = min(o for o in options if o[1] == here[at])
            letters += letter
            at = after
            if letter != "I":
                break
            inserted.append(role)
        found = _forward[state, vector, code] = (letters, at, tuple(inserted), role)
    return found


def end_state(codes: bytes, vectors: array, right: int, state: int) -> int:
    for i, code in enumerate(codes):
        state = edits_before_next(state, vectors[i + 1] if i + 1 < len(vectors) else right, code)[1]
    return state


def trace(codes: bytes, right: int, state: int, last: bool, roles: list[str], texts: list[str]):
    """A chunk's audit and repaired rows from the state in which it begins."""
    vectors, _ = run_backward(codes, right)
    audit, out_roles, out_texts = [], [], []
    for i, code in enumerate(codes):
        letters, state, inserted, role = edits_before_next(state, vectors[i + 1] if i + 1 < len(vectors) else right, code)
        audit.append(letters)
        out_roles += inserted
        out_texts += [""] * len(inserted)
        if role is not None:
            out_roles.append(role or roles[i])
            out_texts.append(texts[i])
    while last and unpack(END)[state]:
        role, state = SPOKEN[state]
        audit.append("I")
        out_roles.append(role)
        out_texts.append("")
    return "".join(audit), out_roles, out_texts


# --- damage and faults ----------------------------------------------------------------------------------------------


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with one damage per turn, picked by the crc32 of ``conv_id:turn``."""
    kind = F.crc32(F.concat_ws(":", _spaced(F.col("conv_id")), _spaced(F.col("turn"))).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_spaced(F.col("text")), ".!?", "")).otherwise(_spaced(F.col("text")))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = turns.where(kind != 0).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(kind == 4, "user").otherwise(_spaced(F.col("role"))).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with a row number, the text's digest and the first fault: 0 none, 1 blank, 2 duplicate, 3 truncated.

    Of equal rows of a conversation the first is found by an aggregate over digests and joined by row number, which is unique.
    """
    rows = rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "row": F.monotonically_increasing_id()})
    rows = materialize(rows, "turns")
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "row"))["row"].alias("row"))
    seen = rows.join(first.select("row", F.lit(True).alias("first")), "row", "left")
    told = F.translate("text", SPACES, "")
    fault = (
        F.when(told == "", 1)
        .when(F.col("first").isNull(), 2)
        .when(~F.substring(told, -1, 1).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    return seen.withColumn("fault", fault).drop("first")


# --- chunks ---------------------------------------------------------------------------------------------------------

CHUNK = (
    "conv_id long, at long, codes binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
    "illegal long, head string, tail string, live boolean, left int, constant long, vectors binary"
)
LEGAL = {"su", "ua", "au"}


def _chunk(conv_id, at: int, rows: list) -> dict:
    roles, texts, faults = (list(c) for c in zip(*rows))
    initials = [r[:1] for r in roles]
    codes = bytes(map(code_of, initials, faults))
    vectors, constant = run_backward(codes, END)
    return {
        "conv_id": conv_id, "at": at, "codes": codes, "roles": roles, "texts": texts,
        **{name: faults.count(k) for k, name in enumerate(FAULTS, 1)},
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "head": initials[0], "tail": initials[-1], "live": any(not c & 4 for c in codes), "left": vectors[0], "constant": constant, "vectors": vectors.tobytes(),
    }


CHUNK_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("at", pa.int64()), ("codes", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    + [(name, pa.int64()) for name in (*FAULTS, "illegal")]
    + [("head", pa.string()), ("tail", pa.string()), ("live", pa.bool_()), ("left", pa.int32()), ("constant", pa.int64()), ("vectors", pa.binary())]
)


def _packer(chunk_rows: int):
    """Sorted rows to chunks; ``at`` grows with the order over all tasks."""

    def packed(batches):
        at = TaskContext.get().partitionId() << 32
        open_rows, conv_id, size, ready, held = [], None, 0, [], 0

        def close():
            nonlocal at, size
            if open_rows:
                ready.append(_chunk(conv_id, at, open_rows))
                open_rows.clear()
                at, size = at + 1, 0

        for batch in batches:
            for conv, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != conv_id or len(open_rows) >= chunk_rows or size >= CHUNK_BYTES:
                    close()
                    conv_id = conv
                open_rows.append((role, text, fault))
                size += len(text)
                held += len(text) + 64
                if held > 16 * CHUNK_BYTES and ready:
                    yield pa.RecordBatch.from_pylist(ready, CHUNK_ARROW)
                    ready.clear()
                    held = size
        close()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, CHUNK_ARROW)

    return packed


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Written chunks, each run backward from the speculative vector."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "row")]
    ship(rows.sparkSession)
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(dealt.select("conv_id", "role", "text", "fault").mapInArrow(_packer(chunk_rows), CHUNK), "chunks")


def _links(made: DataFrame) -> DataFrame:
    """One small row per chunk: its neighbours in the conversation, ``feeder`` the next one that is not only deletions."""
    inside = Window.partitionBy("conv_id").orderBy("at")
    ahead = inside.rowsBetween(1, Window.unboundedFollowing)
    return made.select(
        "conv_id", "at", "left", "constant",
        F.lag("at").over(inside).isNull().alias("first"),
        F.lead("at").over(inside).isNull().alias("last"),
        F.first(F.when(F.col("live"), F.col("at")), ignorenulls=True).over(ahead).alias("feeder"),
        F.concat("tail", F.lead("head").over(inside)).alias("border"),
    )


RUN = "at long, codes binary, feeder long, right int, left int, constant long, vectors binary"


def _fix_ups(batches):
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            if (right := row.pop("new_right")) != row["right"]:
                old = array("H", row["vectors"])
                vectors, row["constant"] = fix_up(row["codes"], old, row["constant"], row["right"], right)
                row.update(right=right, left=vectors[0], vectors=vectors.tobytes())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_RUN_ARROW)


_RUN_ARROW = pa.schema(
    [("at", pa.int64()), ("codes", pa.binary()), ("feeder", pa.int64()), ("right", pa.int32()), ("left", pa.int32()), ("constant", pa.int64()), ("vectors", pa.binary())]
)


def converged(made: DataFrame, links: DataFrame) -> DataFrame:
    """The chunks of conversations with several, with the vectors that their right neighbours give them."""
    many = links.where(~(F.col("first") & F.col("last"))).select("at", "feeder")
    runs = made.join(many, "at").select("at", "codes", "feeder", F.lit(END).alias("right"), "left", "constant", "vectors")
    runs = materialize(runs, "runs")
    while True:
        given = runs.select(F.col("at").alias("feeder"), F.col("left").alias("given"))
        fed = runs.join(given, "feeder", "left").withColumn("new_right", F.coalesce("given", F.lit(END))).drop("given")
        if fed.where("new_right != right").isEmpty():
            return runs
        runs = materialize(fed.select(*runs.columns, "new_right").mapInArrow(_fix_ups, RUN), "runs")


def _ends(batches):
    for batch in batches:
        found = {"at": batch.column("at"), "conv_id": batch.column("conv_id")}
        ends = []
        for codes, vectors, right in zip(*(batch.column(c).to_pylist() for c in ("codes", "vectors", "right"))):
            vectors = array("H", vectors)
            ends.append(bytes(end_state(codes, vectors, right, q) for q in range(4)))
        yield pa.RecordBatch.from_pydict(found | {"ends": pa.array(ends, pa.binary())})


def _entries(batches):
    """Chunks in order, as a stream: each begins where the one before it ended."""
    conv_id, state = object(), NOTHING
    for batch in batches:
        entry = []
        for conv, ends in zip(batch.column("conv_id").to_pylist(), batch.column("ends").to_pylist()):
            if conv != conv_id:
                conv_id, state = conv, NOTHING
            entry.append(state)
            state = ends[state]
        yield pa.RecordBatch.from_pydict({"at": batch.column("at"), "entry": pa.array(entry, pa.int32())})


def entries(runs: DataFrame, links: DataFrame) -> DataFrame:
    """``(at, entry)``: the state in which each chunk begins."""
    ends = runs.join(links.select("at", "conv_id"), "at").mapInArrow(_ends, "at long, conv_id long, ends binary")
    dealt = ends.repartition(partitions(runs.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at")
    return dealt.mapInArrow(_entries, "at long, entry int")


PIECE = "conv_id long, at long, audit string, roles array<string>, texts array<string>"


def _traced(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            out = []
            for r in batch.slice(start, 64).to_pylist():
                audit, roles, texts = trace(r["codes"], r["right"], r["entry"], r["last"], r["roles"], r["texts"])
                out.append({"conv_id": r["conv_id"], "at": r["at"], "audit": audit, "roles": roles, "texts": texts})
            kinds = CHUNK_ARROW
            kind = pa.schema([kinds.field("conv_id"), kinds.field("at"), ("audit", pa.string()), kinds.field("roles"), kinds.field("texts")])
            yield pa.RecordBatch.from_pylist(out, kind)


def _digested(batches):
    """Pieces in order, as a stream: the digest of the repaired conversation and its whole audit."""
    conv_id, sha, audit, lines = None, None, [], False

    def close():
        return pa.RecordBatch.from_pydict(
            {"conv_id": pa.array([conv_id], pa.int64()), "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]}
        )

    for batch in batches:
        for conv, piece, count, text in zip(*(batch.column(c) for c in ("conv_id", "audit", "n", "lines"))):
            conv = conv.as_py()
            if sha is None or conv != conv_id:
                if sha is not None:
                    yield close()
                conv_id, sha, audit, lines = conv, hashlib.sha256(), [], False
            audit.append(piece.as_py())
            if count.as_py():
                sha.update((b"\n" if lines else b"") + text.as_py().encode())
                lines = True
    if sha is not None:
        yield close()


@dataclass
class Repair:
    """What was found and done: ``pieces`` are the repaired rows and edits of each chunk, ``counts`` sums per conversation."""

    pieces: DataFrame
    counts: DataFrame

    def rows(self) -> DataFrame:
        """The repaired conversations as rows ``(conv_id, piece, idx, role, text)``, in the order of piece and idx."""
        turn = F.posexplode(F.arrays_zip("roles", "texts"))
        return self.pieces.select("conv_id", F.col("at").alias("piece"), turn.alias("idx", "t")).select(
            "conv_id", "piece", "idx", F.col("t.roles").alias("role"), F.col("t.texts").alias("text")
        )

    def digests(self) -> DataFrame:
        """``(conv_id, audit, repaired_sha256)``."""
        line = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
        told = self.pieces.select("conv_id", "at", "audit", F.size("roles").alias("n"), F.array_join(line, "\n").alias("lines"))
        dealt = told.repartition(partitions(told.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at")
        return dealt.drop("at").mapInArrow(_digested, "conv_id long, audit string, repaired_sha256 string")


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Repair:
    """The cheapest legal edits of ``(conv_id, turn, role, text)`` rows."""
    made = chunks(with_faults(rows), chunk_rows)
    links = materialize(_links(made), "links")
    runs = converged(made, links)
    starts = materialize(
        runs.select("at", "right").join(entries(runs, links), "at").join(links.select("at", "last"), "at"), "starts"
    )
    traced = made.select("conv_id", "at", "codes", "roles", "texts").join(broadcast_if_small(starts), "at", "left")
    traced = traced.withColumns(
        {"right": F.coalesce("right", F.lit(END)), "entry": F.coalesce("entry", F.lit(NOTHING)), "last": F.coalesce("last", F.lit(True))}
    )
    pieces = materialize(traced.mapInArrow(_traced, PIECE), "pieces")
    settled = runs.select("at", F.col("left").alias("new_left"), F.col("constant").alias("new_constant"))
    costs = links.join(settled, "at", "left").select(
        "conv_id",
        (F.coalesce("new_constant", "constant") + F.when(F.col("first"), F.coalesce("new_left", "left").bitwiseAND(15)).otherwise(0)).alias("cost"),
        (~F.coalesce(F.col("border").isin(*LEGAL), F.lit(True))).cast("long").alias("illegal"),
    )
    found = made.select("conv_id", *FAULTS, "illegal", F.lit(0).cast("long").alias("cost"))
    found = found.unionByName(costs, allowMissingColumns=True)
    return Repair(pieces, found.groupBy("conv_id").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*FAULTS, "illegal", "cost"))))


def damage_and_repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per original conversation: conv_id, gaps, faults, illegal, cost, audit, repaired_sha256."""
    damaged = materialize(damage(turns.select("conv_id", "turn", "role", "text")), "damaged")
    fixed = repair(damaged, chunk_rows)
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = damaged.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps"))
    parts = turns.select(F.col("conv_id").cast("long"), F.lit(0).cast("long").alias("gaps"))
    for more in (gaps, fixed.counts, fixed.digests()):
        parts = parts.unionByName(more, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return parts.groupBy("conv_id").agg(
        *sums, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256")
    )
