"""Conversation repair against brute force: whole tables, odd rows, long conversations in many chunks."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from logblocks.llm import conversations as cv
from logblocks.llm.common import table
from logblocks.llm.queries import registered

KIND = "conv_id long, turn long, role string, text string, at long, row long, codes string"
SPACE = " \t\n\x0b\x0c\r"


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def choices(row):
    """``(letter, cost, role, text)`` of a row; role None deletes."""
    role, text, fault = row
    found = [("D", 3, None, None)]
    if fault not in ("blank", "duplicate"):
        extra = fault == "truncated"
        if role[:1] in ("s", "u", "a"):
            found.append(("K", extra, role, text))
        found += [("R", 2 + extra, r, text) for r in ("user", "assistant")]
    return found


NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Least (cost, audit) and its repaired rows, by relaxing whole suffixes from the end."""
    after = {"": (0, "", ()), "a": (0, "", ())}
    steps = [[], *([r] for r in reversed(rows))]
    for step in steps:
        now = {} if step else dict(after)
        for state in ("", "s", "u", "a") if step else ():
            for letter, cost, role, text in choices(step[0]):
                to = state if role is None else NEXT.get((state, role[:1]))
                if to in after:
                    c, audit, out = after[to]
                    option = (c + cost, letter + audit, (((role, text),) if role is not None else ()) + out)
                    now[state] = min(now.get(state, option), option, key=lambda o: o[:2])
        for _ in range(5):
            for state, role in itertools.product(("", "s", "u", "a"), ("user", "assistant")):
                to = NEXT.get((state, role[0]))
                if to in now:
                    c, audit, out = now[to]
                    option = (c + 2, "I" + audit, ((role, ""),) + out)
                    now[state] = min(now.get(state, option), option, key=lambda o: o[:2])
        after = now
    return after[""]


def told(rows, conv_id):
    """The contract's row of one conversation from its damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, judged = set(), []
    for _, role, text in rows:
        bare = text.translate({ord(c): None for c in SPACE})
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [r[0] for r in rows if r[0] is not None]
    count = Counter(f for _, _, f in judged)
    cost, audit, out = cheapest(judged)
    assert legal("".join(r[:1] for r, _ in out))
    pairs = zip([r[1][:1] for r in rows], [r[1][:1] for r in rows][1:])
    return {
        "conv_id": conv_id,
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": count["blank"], "duplicate": count["duplicate"], "truncated": count["truncated"],
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def brute(rows):
    damaged = defaultdict(list)
    for conv_id, turn, role, text in rows:
        damaged[conv_id] += []
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv_id] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv_id: told(found, conv_id) for conv_id, found in damaged.items()}


def got(df):
    rows = [r.asDict() for r in df.collect()]
    found = {r["conv_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_every_conversation(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()
    df = registered()["op13_conversation_repair"](spark, sf_dir)
    assert got(df) == brute(map(tuple, rows))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint"] * 7 + ["string"] * 2


ROLES = ["user", "assistant", "system", "tool", "", None, "User"]
TEXTS = ["Fine.", "Fine.", "What?", "cut", None, "", "  \n", "Yes!  ", "a. b", "ü?"]


def made_up(seed, n, conversations):
    rng = random.Random(seed)
    turn = lambda: None if rng.random() < 0.05 else rng.randint(0, 40)
    conv = lambda: None if rng.random() < 0.1 else rng.randrange(conversations)
    return [(conv(), turn(), rng.choice(ROLES[: rng.choice((2, 3, 7))]), rng.choice(TEXTS) if rng.random() < 0.5 else f"t{k}.") for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "x") for r in rows], KIND)


@pytest.mark.parametrize("chunk", [2, 2048])
def test_odd_rows_in_chunks_of_any_size(spark, chunk):
    rows = made_up(chunk, 700, 40)
    rows += rows[:30]  # repeated rows
    rows += [(500, None, None, None), (501, 3, "user", "only.")]
    assert got(cv.damage_and_repair(frame(spark, rows), chunk)) == brute(rows)


def test_one_long_conversation(spark):
    """A third of the rows in one conversation, with long runs of duplicates that only pass vectors on."""
    rng = random.Random(5)
    rows = [(1, k, ("user", "assistant")[k % 2], "same." if 300 < k < 900 else f"{rng.random()}.") for k in range(1500)]
    rows += made_up(8, 1000, 300)
    assert got(cv.damage_and_repair(frame(spark, rows), 50)) == brute(rows)


def test_empty_table_and_all_dropped(spark):
    assert cv.damage_and_repair(frame(spark, [])).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    row = got(cv.damage_and_repair(frame(spark, [(gone, 0, "user", "x")])))[gone]
    assert row == {**dict.fromkeys(("gaps", *cv.FAULTS, "illegal", "cost"), 0), "conv_id": gone, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}


def test_repaired_rows_are_legal(spark):
    rows = made_up(4, 300, 30)
    fixed = cv.repair(spark.createDataFrame([(c, t, r or " ", x or " ") for c, t, r, x in rows], "conv_id long, turn long, role string, text string"))
    said = defaultdict(str)
    for r in sorted(fixed.rows().collect(), key=lambda r: (r["piece"], r["idx"])):
        said[r["conv_id"]] += r["role"][:1]
    assert said and all(map(legal, said.values()))


def test_every_short_conversation_by_listing_all_edits():
    """Least audits from the backward costs equal the least over all edit sequences, written out."""
    kinds = [(r, f) for r in "sua " for f in (0, 1, 3)]
    rng = random.Random(1)
    for rows in [list(p) for n in range(3) for p in itertools.product(kinds, repeat=n)] + [rng.choices(kinds, k=3) for _ in range(60)]:
        best = None
        for picks in itertools.product(*[[("D", 3, "")] + ([] if f == 1 else [("K", f == 3, r), ("R", 2 + (f == 3), "u"), ("R", 2 + (f == 3), "a")]) for r, f in rows]):
            for inserts in itertools.product(("", "u", "a", "ua", "au", "uu", "aa"), repeat=len(rows) + 1):
                initials = inserts[0] + "".join(p[2] + i for p, i in zip(picks, inserts[1:]))
                if legal(initials) and len("".join(inserts)) <= 2 * len(rows):
                    cost = sum(p[1] for p in picks) + 2 * len("".join(inserts))
                    audit = "I" * len(inserts[0]) + "".join(p[0] + "I" * len(i) for p, i in zip(picks, inserts[1:]))
                    best = min(best or (cost, audit), (cost, audit))
        codes = bytes(cv.code_of(r, f) for r, f in rows)
        vectors, total = cv.run_backward(codes, cv.END)
        audit, roles, _ = cv.trace(codes, cv.END, cv.NOTHING, True, [r for r, _ in rows], [""] * len(rows))
        cost = total + ((vectors[0] if rows else cv.END) & 15)
        assert (cost, audit) == best and legal("".join(r[:1] for r in roles))


def test_fix_up_equals_a_new_run():
    rng = random.Random(2)
    ends = {cv.END} | {cv.run_backward(bytes(rng.choices(range(8), k=5)), cv.END)[0][0] for _ in range(40)}
    for right in ends:
        codes = bytes(rng.choices([0, 1, 2, 3, 5, 6, 9, 10], k=60))
        old = cv.run_backward(codes, cv.END)
        assert cv.fix_up(codes, *old, cv.END, right) == cv.run_backward(codes, right)
