import hashlib
import random
import re
import zlib
from itertools import combinations_with_replacement, product

import pytest
from pyspark.sql import functions as F

from hostpulse.llm import conversations
from hostpulse.llm.common import table

GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """(conv, turn, role, text) rows after damage; NULLs are one space."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def options(row, fault):
    """(initial edit, cost, resulting row or None) of one row."""
    yield "D", 2, None
    if fault in (None, "truncated"):
        extra = 5 * (fault == "truncated")
        yield "K", extra, (row[2], row[3])
        for role in ("user", "assistant"):
            yield "R", 1 + extra, (role, row[3])


def exhaustive(rows, found):
    """Every sequence of edits with at most two inserts, by the stated rules only."""
    best = None
    slots = range(len(rows) + 1)
    inserts = [[]] + [[(s, r)] for s in slots for r in ("user", "assistant")]
    inserts += [[(a, r), (b, q)] for a, b in combinations_with_replacement(slots, 2) for r in ("user", "assistant") for q in ("user", "assistant")]
    for edits in product(*(list(options(r, f)) for r, f in zip(rows, found))):
        for added in inserts:
            audit, kept, cost = [], [], 5 * len(added) + sum(e[1] for e in edits)
            for k in slots:
                for s, role in added:
                    if s == k:
                        audit.append("I")
                        kept.append((role, ""))
                if k < len(rows):
                    audit.append(edits[k][0])
                    kept += [edits[k][2]] if edits[k][2] else []
            if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in kept)):
                answer = (cost, "".join(audit), kept)
                best = answer if best is None or answer[:2] < best[:2] else best
    return best


def forward(rows, found):
    """Least cost and audit by a plain pass over (state) from the start; the grammar as a table of its own."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, kept) in list(best.items()):
                for role in ("user", "assistant"):
                    to = step.get((state, role[0]))
                    if to and (to not in best or (cost + 5, audit + "I") < best[to][:2]):
                        best[to] = (cost + 5, audit + "I", [*kept, (role, "")])
        return best

    for row, fault in zip(rows, found):
        new = {}
        for state, (cost, audit, kept) in insert(best).items():
            for edit, price, result in options(row, fault):
                to = step.get((state, result[0][:1])) if result else state
                if to is not None and (to not in new or (cost + price, audit + edit) < new[to][:2]):
                    new[to] = (cost + price, audit + edit, kept + ([result] if result else []))
        best = new
    done = [v for s, v in insert(best).items() if s in ("", "a")]
    return min(done, key=lambda v: v[:2])


def plain_report(rows, solve):
    """{conv: the whole result row} by plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in plain_damage([r for r in rows if r[0] == conv])]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2], r[3])))
        if not mine:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
            continue
        found = plain_faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = solve(mine, found)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        faults = [found.count(n) for n in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def report(spark, rows, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    run = conversations.repair(df, conversations.damage(df), **how)
    got = run.report().collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in got}
    assert len(found) == len(got)
    return found, run


def cases(seed, conversations_, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unicorn"])
            text = rng.choice(["Fine.", "Cut off", "Yes!  \n", "", " \t", None, "So?", "no end ,", f"Own {conv} {turn}."])
            rows.append((conv, None if rng.random() < 0.05 else turn + 2 * (rng.random() < 0.1), role, text))
    return rows


def test_every_short_conversation_against_all_edits(spark):
    rows = cases(1, 110, 4)
    assert report(spark, rows)[0] == plain_report(rows, exhaustive)


@pytest.mark.parametrize("segment_rows", [1, 5])
def test_long_conversations_in_segments(spark, segment_rows):
    """One conversation holds a third of all rows; segments of few rows, over several tasks."""
    rows = cases(2, 60, 12)
    rng = random.Random(3)
    rows += [(1000, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", f"{t}!"])) for t in range(200)]
    rows += [(None, t, "user", "Hm.") for t in range(5)] + [(77_000, 3, "user", "same.")] * 6
    got, run = report(spark, rows, segment_rows=segment_rows)
    want = plain_report(rows, forward)
    assert got == want
    text = {}
    for r in run.rows().orderBy("part", "seq", "place").collect():
        text.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(text.get(c, [])).encode()).hexdigest() == w[-1] for c, w in want.items())


def test_given_table_against_the_plain_version(spark):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert report(spark, rows)[0] == plain_report(rows, forward)


def test_nodes_are_shared_and_sorted_walk_equals_each_alone():
    signatures = ["ua", "sua", "uaua", "xua", "u", "SUA", "ooa", "x", "suaua"]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(sorted(signatures, key=lambda s: s[::-1]))], ["signature"])
    out = next(conversations._solve(iter([batch])))
    for s, costs, audits in zip(*(out[c].to_pylist() for c in ("signature", "costs", "audits"))):
        node = conversations.LAST
        for symbol in reversed(s):
            node = conversations.extend(node, symbol)
        assert [c for row in node for c in row] == [None if c is None else (c, a) for c, a in zip(costs, audits)]


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    run = conversations.repair(empty, conversations.damage(empty))
    assert run.report().count() == 0 and run.rows().count() == 0
    long = "word " * 200_000
    rows = [(1, 1, "user", long + "?"), (1, 2, "assistant", long), (2, None, None, None), (3, 9, "system", "Only.")]
    df = spark.createDataFrame(rows, schema).withColumns(
        {n: F.lit("clash") for n in ["part", "seq", "salt", "kind", "fault", "print", "_h", "_copy", "state", "audit", "signature"]}
    )
    got = {r["conv_id"]: r for r in conversations.repair(df, conversations.damage(df), segment_chars=1_000).report().collect()}
    want = plain_report(rows, exhaustive)
    assert {c: (r["cost"], r["audit"], r["repaired_sha256"]) for c, r in got.items()} == {c: w[-3:] for c, w in want.items()}
    plain = conversations.repair(df).report()  # without damage
    assert plain.count() == 3
