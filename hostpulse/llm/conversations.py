"""Conversation structure repair over a suffix-shared automaton.

Rows of a conversation become one symbol each: the class of their role and their first fault. The rows are sorted by range, which
cuts a conversation of any length over many tasks, and streamed into segments of bounded size. A segment's symbols are its signature.

The distinct signatures of all conversations form an automaton that shares suffixes: a node is a suffix, reached from the end.
Signatures are sorted by their reverse, so that each task walks its part of the automaton depth first, with one path of nodes in
memory, and works every node out once: for each grammar state before the suffix and each state behind it, the least cost and the
best audit (edit initials; the ASCII-least of equal cost). A conversation reads its signature's answers; where it has several
segments, one pass from its end chooses the states between them and one pass from its start applies them.

The grammar of role initials is `(s?(ua)+)?`, with four states: 0 nothing yet, 1 behind the system row, 2 behind a user row, 3 behind
an assistant row; 0 and 3 may end. In every state only one of user and assistant is possible, so an audit fixes the repaired rows.
Two audits of one signature and start never continue one another, so segments can be compared one by one.

Defined cases: a NULL text or role is one space, before damage and in the keys of damage; rows are in order of turn, NULL first, rows
of equal turn by a digest of role and text; equal rows follow each other, all but the first are duplicates; any role initial other
than s, u, a can only be deleted or given a role; a NULL conv_id is a conversation; a conversation without rows has zeros and empty
results; an empty table gives no rows; columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.session import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows and text characters of a segment, at most (one row may have more characters).
SEGMENT_ROWS = 1024
SEGMENT_CHARS = 4_000_000
STATES = 4
ENDS = (0, 3)
#: State -> (the only role that can be inserted or given there, the state behind it).
TURNS = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: Symbols: x for a row that has to go; else the class of its role, as a capital letter if the text is truncated.
GONE = "x"
Answers = list[list[tuple[int, str] | None]]


# Damage and faults: DataFrame expressions.

def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, salt) after the stated damage; salt tells rows apart that are equal otherwise."""
    h = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), h.alias("_h"))
    text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_h") == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(0), F.when(F.col("_h") == 3, 1).otherwise(0))
    kept = rows.where("_h <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))
    return kept.withColumn("salt", F.xxhash64(F.monotonically_increasing_id(), "_copy")).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """Adds print, kind (role class), and the first fault of each row: blank, duplicate, truncated or none."""
    seen = rows.withColumn("print", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    seen = materialise(seen, "damaged")
    first = seen.groupBy("conv_id", "print").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("turn", "salt")).alias("_first"))
    repeated = first.where("_n > 1").select(F.col("conv_id").alias("_conv"), F.col("print").alias("_print"), "_first")
    marked = seen.join(repeated, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("print") == F.col("_print")), "left")
    is_first = F.col("_first.turn").eqNullSafe(F.col("turn")) & (F.col("_first.salt") == F.col("salt"))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("_first").isNotNull() & ~is_first, "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return marked.select("conv_id", "turn", "salt", "print", "role", "text", kind.alias("kind"), fault.alias("fault"))


def symbol() -> Column:
    gone = F.col("fault").isin("blank", "duplicate")
    return F.when(gone, GONE).when(F.col("fault") == "truncated", F.upper("kind")).otherwise(F.col("kind"))


# Segments: the sorted rows, streamed.

SEGMENT = "part int, seq int, signature string, kinds string, roles array<string>, texts array<string>"


def _segments(rows: int, chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, done, held = pa.int64(), [], 0
        current, seq = None, 0
        signature, kinds, roles, texts, size = [], [], [], [], 0

        def close() -> None:
            nonlocal signature, kinds, roles, texts, size, seq, held
            if signature:
                done.append((current[0], current[1], seq, "".join(signature), "".join(kinds), roles, texts))
                held += size
                seq += 1
            signature, kinds, roles, texts, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal done, held
            types = [kind, pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
            columns = list(zip(*done, strict=True)) or [()] * len(types)
            done, held = [], 0
            names = ["conv_id", "part", "seq", "signature", "kinds", "roles", "texts"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            kind = batch["conv_id"].type
            for conv, part, s, k, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "symbol", "kind", "role", "text"))):
                if current != (conv, part):
                    close()
                    current, seq = (conv, part), 0
                elif len(signature) >= rows or size + len(text) > chars:
                    close()
                signature.append(s)
                kinds.append(k)
                roles.append(role)
                texts.append(text)
                size += len(text)
            if held > chars or len(done) > rows:
                yield flush()
        close()
        yield flush()

    return run


def segments(marked: DataFrame, rows: int = SEGMENT_ROWS, chars: int = SEGMENT_CHARS) -> DataFrame:
    """Consecutive rows of one conversation, in order of (part, seq); a range sort cuts long conversations over tasks."""
    order = ["conv_id", "turn", "print", "salt"]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", F.spark_partition_id().alias("part"), symbol().alias("symbol"), "kind", "role", "text")
    return ordered.mapInArrow(_segments(rows, chars), f"conv_id {_type(marked)}, {SEGMENT}")


def _type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


# The automaton.

def _inserted(state: int, n: int) -> int:
    for _ in range(n):
        state = TURNS[state][1]
    return state


def _steps(symbol: str) -> list[dict[int, tuple[int, str]]]:
    """State before a row -> {state behind it: (least cost, best edits)}; rows may be inserted before the row."""
    out: list[dict[int, tuple[int, str]]] = []
    for state in range(STATES):
        best: dict[int, tuple[int, str]] = {}
        for n in range(3):
            there, paid, edits = _inserted(state, n), INSERT * n, "I" * n
            options = [(DELETE, "D", there)]
            if symbol != GONE:
                extra, role = TRUNCATED * symbol.isupper(), symbol.lower()
                given, behind = TURNS[there]
                options.append((REROLE + extra, "R", behind))
                if role == given[0]:
                    options.append((KEEP + extra, "K", behind))
                elif role == "s" and there == 0:
                    options.append((KEEP + extra, "K", 1))
            for cost, edit, to in options:
                option = (paid + cost, edits + edit)
                best[to] = min(best.get(to, option), option)
        out.append(best)
    return out


STEPS = {s: _steps(s) for s in GONE + "suaoSUAO"}
#: The empty suffix: nothing happens.
LAST: Answers = [[(0, "") if x == y else None for y in range(STATES)] for x in range(STATES)]


def extend(node: Answers, symbol: str) -> Answers:
    """The node one symbol further from the end: best answers from each state to each state."""
    out: Answers = []
    for steps in STEPS[symbol]:
        row: list[tuple[int, str] | None] = [None] * STATES
        for there, (cost, edits) in steps.items():
            for end, rest in enumerate(node[there]):
                if rest is not None:
                    option = (cost + rest[0], edits + rest[1])
                    if row[end] is None or option < row[end]:
                        row[end] = option
        out.append(row)
    return out


ANSWERS = "signature string, costs array<long>, audits array<string>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of signatures sorted by their reverse; `path` holds the nodes of the last one, from the end."""
    path, last = [LAST], ""
    for batch in batches:
        signatures, costs, audits = batch["signature"].to_pylist(), [], []
        for signature in signatures:
            reverse = signature[::-1]
            shared = next((k for k, (a, b) in enumerate(zip(reverse, last)) if a != b), min(len(reverse), len(last)))
            del path[shared + 1:]
            for s in reverse[shared:]:
                path.append(extend(path[-1], s))
            last = reverse
            cells = [cell for row in path[-1] for cell in row]
            costs.append([None if c is None else c[0] for c in cells])
            audits.append([None if c is None else c[1] for c in cells])
        yield pa.RecordBatch.from_arrays(
            [pa.array(signatures, pa.string()), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
            ["signature", "costs", "audits"],
        )


def answers(signatures: DataFrame) -> DataFrame:
    """Costs and audits (state before x 4 + state behind) of every distinct signature; NULL where there is no way."""
    ordered = signatures.select("signature").distinct().withColumn("_reverse", F.reverse("signature"))
    ordered = ordered.repartitionByRange("_reverse").sortWithinPartitions("_reverse")
    return ordered.select("signature").mapInArrow(_solve, ANSWERS)


# Choice of the states between segments, from the end; then application, from the start.

def _finish() -> list[tuple[int, str]]:
    """Behind the last row: inserts that lead to a state which may end."""
    out = []
    for state in range(STATES):
        n = next(n for n in range(3) if _inserted(state, n) in ENDS)
        out.append((INSERT * n, "I" * n))
    return out


FINISH = _finish()
CHOICE = "part int, seq int, last boolean, ends array<int>, costs array<long>, audits array<string>"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from the end of their conversation: per state before a segment, the state to leave it in, and cost and audit of the
    segment itself (with closing inserts in the last one)."""
    conv, togo = object(), []
    for batch in batches:
        names = ["conv_id", "part", "seq", "costs", "audits"]
        out = []
        for own, part, seq, costs, audits in zip(*(batch[n].to_pylist() for n in names)):
            last = own != conv or not togo
            if last:
                conv, togo = own, [cost for cost, _ in FINISH]
            ends, paid, edits, before = [], [], [], []
            for x in range(STATES):
                options = []
                for y in range(STATES):
                    if costs[STATES * x + y] is not None:
                        audit = audits[STATES * x + y] + (FINISH[y][1] if last else "")
                        cost = costs[STATES * x + y] + (FINISH[y][0] if last else 0)
                        options.append((costs[STATES * x + y] + togo[y], audit, y, cost))
                total, audit, y, cost = min(options)
                ends.append(y)
                paid.append(cost)
                edits.append(audit)
                before.append(total)
            togo = before
            out.append((own, part, seq, last, ends, paid, edits))
        types = [batch["conv_id"].type, pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "part", "seq", "last", "ends", "costs", "audits"]
        )


PLAN = "part int, seq int, state int, cost long, audit string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from the start of their conversation: the state they begin in, and the cost and audit chosen for it."""
    conv, state = object(), 0
    for batch in batches:
        out = []
        for own, part, seq, ends, costs, audits in zip(*(batch[n].to_pylist() for n in ("conv_id", "part", "seq", "ends", "costs", "audits"))):
            if own != conv:
                conv, state = own, 0
            out.append((own, part, seq, state, costs[state], audits[state]))
            state = ends[state]
        types = [batch["conv_id"].type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "part", "seq", "state", "cost", "audit"]
        )


def plan(found: DataFrame, solved: DataFrame) -> DataFrame:
    """Per segment: the state it begins in, its cost and its audit."""
    kind = _type(found)
    asked = found.select("conv_id", "part", "seq", "signature").join(solved, "signature").drop("signature")
    from_end = asked.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    chosen = from_end.mapInArrow(_choose, f"conv_id {kind}, {CHOICE}")
    # Still dealt by conversation: sorting again inside the same tasks is enough.
    return chosen.sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_apply, f"conv_id {kind}, {PLAN}")


def repaired_rows(state: int, audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each row that an audit leaves or adds."""
    at = 0
    for edit in audit:
        if edit == "I":
            role, state = TURNS[state]
            yield edit, role, ""
            continue
        if edit == "R":
            role, state = TURNS[state]
            yield edit, role, texts[at]
        elif edit == "K":
            state = 1 if roles[at][0] == "s" else TURNS[state][1]
            yield edit, roles[at], texts[at]
        at += 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            state, audit, roles, texts = (batch[c][k].as_py() for c in ("state", "audit", "roles", "texts"))
            rows = list(repaired_rows(state, audit, roles, texts))
            edits, given, said = zip(*rows) if rows else ((), (), ())
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([batch["conv_id"][k].as_py()] * n, batch["conv_id"].type), pa.array([batch["part"][k].as_py()] * n, pa.int32()),
                pa.array([batch["seq"][k].as_py()] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(edits, pa.string()),
                pa.array(given, pa.string()), pa.array(said, pa.string()),
            ], ["conv_id", "part", "seq", "place", "edit", "role", "text"])


DIGEST = "audit string, cost long, illegal long, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its segments in order; a checksum is serial, so a conversation is streamed, not held."""
    conv, cost, illegal, before, audit, digest, empty = object(), 0, 0, "", [], None, True
    for batch in batches:
        done = []
        kind = batch["conv_id"].type

        def close() -> None:
            if digest is not None:
                done.append((conv, "".join(audit), cost, illegal, digest.hexdigest()))

        names = ["conv_id", "state", "cost", "audit", "kinds", "roles", "texts"]
        for own, state, paid, edits, kinds, roles, texts in zip(*(batch[n].to_pylist() for n in names)):
            if own != conv or digest is None:
                close()
                conv, cost, illegal, before, audit, digest, empty = own, 0, 0, "", [], hashlib.sha256(), True
            cost += paid
            audit.append(edits)
            whole = before + kinds
            illegal += sum(whole[i:i + 2] not in ("su", "ua", "au") for i in range(len(whole) - 1))
            before = kinds[-1:]
            for _, role, text in repaired_rows(state, edits, roles, texts):
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "replace"))
                empty = False
        yield _digest_batch(done, kind)
    if digest is not None:
        yield _digest_batch([(conv, "".join(audit), cost, illegal, digest.hexdigest())], kind)


def _digest_batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [()] * 5
    types = [kind, pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "audit", "cost", "illegal", "repaired_sha256"]
    )


@dataclass(frozen=True)
class Repair:
    """Written tables of one run: original ids, marked rows, segments, and the plan of edits."""

    ids: DataFrame
    marked: DataFrame
    segments: DataFrame
    plan: DataFrame

    def _planned(self) -> DataFrame:
        chosen = self.plan.withColumnsRenamed({"conv_id": "_conv", "part": "_part", "seq": "_seq"})
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq"))
        return self.segments.join(chosen, same).drop("_conv", "_part", "_seq")

    def rows(self) -> DataFrame:
        """The repaired rows: conv_id, their order (part, seq, place), the edit that made them, role and text."""
        schema = f"conv_id {_type(self.segments)}, part int, seq int, place int, edit string, role string, text string"
        return self._planned().mapInArrow(_rows, schema)

    def report(self) -> DataFrame:
        """Per original conversation: gaps, faults, illegal neighbours, cost, audit, and the checksum of the repaired text."""
        turns = F.max("turn") - F.min("turn") + 1 - F.sum(F.when(F.col("turn").isNotNull(), 1))
        by_turn = self.marked.groupBy("conv_id", "turn").agg(
            *(F.sum((F.coalesce("fault", F.lit("")) == n).cast("long")).alias(n) for n in ("blank", "duplicate", "truncated"))
        )
        counts = by_turn.groupBy("conv_id").agg(
            F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), *(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated"))
        )
        ordered = self._planned().repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
        digests = ordered.mapInArrow(_digests, f"conv_id {_type(self.segments)}, {DIGEST}")
        out = self.ids
        for name, found in (("_a", counts), ("_b", digests)):
            found = found.withColumnRenamed("conv_id", name)
            out = out.join(found, F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
        numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        nothing = hashlib.sha256().hexdigest()
        return out.select(
            "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
        )


def repair(
    conversations: DataFrame, damaged: DataFrame | None = None, segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS,
) -> Repair:
    """Repair of `conversations`, of the rows `damaged` (conv_id, turn, role, text, salt) if given, else as they are."""
    if damaged is None:
        damaged = conversations.select(
            "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("salt")
        )
    marked = materialise(faults(damaged), "marked")
    found = materialise(segments(marked, segment_rows, segment_chars), "segments")
    solved = materialise(answers(found), "answers")
    chosen = materialise(plan(found, solved), "plan")
    return Repair(conversations.select("conv_id").distinct(), marked, found, chosen)
