"""Every operator against brute force or SQL on small tables with nulls, ties, copies and clashing columns."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logblocks.llm import (
    decontamination,
    exact_dedup,
    language_id,
    licenses,
    mixing,
    preferences,
    repeats,
    simhash,
    toxicity,
    warc,
)
from logblocks.llm.common import table
from logblocks.llm.queries import registered, statements
from tests.compare import connect, difference

DOCS = "doc_id long, text string, lang string, source string, digest string, shard long, fp long, size long"


def documents(spark, rows):
    """Rows (doc_id, text[, lang, source]) with extra columns whose names the operators use inside."""
    full = [(*r, *(None,) * (4 - len(r)), "x", 1, 2, 3) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


ODD = [
    (1, "a b"), (2, " a\tb "), (3, "ab"), (4, None), (5, ""), (None, "ab"), (None, None),
    (6, prose(1)), (7, prose(1)), (7, prose(1)), (8, prose(1) + " x"), (9, prose(2, 40_000)), (10, "é" * 300), (11, "  \n"),
]


@pytest.mark.parametrize("name", sorted(statements()))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert difference(registered()[name](spark, sf_dir), connect(sf_dir), statements()[name]) == ""


def against_sql(df, sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    return difference(df, con, sql)


def test_exact_dedup_of_odd_rows(spark):
    docs = documents(spark, ODD)
    assert against_sql(exact_dedup.exact_dedup(docs), exact_dedup.SQL, documents=docs) == ""
    assert exact_dedup.exact_dedup(documents(spark, [])).count() == 0


def test_index_tells_members_from_others(spark):
    index, shards = exact_dedup.build_index(exact_dedup.distinct_digests(exact_dedup.digests(documents(spark, ODD))))
    batch = exact_dedup.digests(documents(spark, [(20, "a  b"), (21, "new"), (22, "n ew"), (23, "other")]))
    got = {r["doc_id"]: (r["in_history"], r["keep_id"], r["kept"]) for r in exact_dedup.dedup_batch(batch, index, shards).collect()}
    assert got == {20: (True, 2, False), 21: (False, 22, False), 22: (False, 22, True), 23: (False, 23, True)}


def test_perfect_hash_is_minimal():
    words = np.frombuffer(b"".join(hashlib.sha256(str(k).encode()).digest() for k in range(5000)), "<u8").reshape(-1, 4)
    assert sorted(exact_dedup.Levels.build(words).slots(words)) == list(range(5000))


def test_language_profiles(spark):
    a, b = "the cat and the dog ran home", "der hund und die katze liefen heim"
    rows = [(k, (a if k % 2 else b) + f" {k}", "en" if k % 2 else "de", None) for k in range(40)]
    rows += [(50, "the dog and the cat", None, None), (51, None, "en", None), (52, "12 34 !", "de", None), (None, "der hund", None, None)]
    got = {r["doc_id"]: r for r in language_id.language_id(documents(spark, rows)).collect()}
    assert got[50]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert (got[51]["lang_pred"], got[51]["score"], got[52]["lang_pred"]) == ("und", 0.0, "und")
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.language_id(documents(spark, [])).count() == 0
    assert language_id.language_id(documents(spark, [(1, "abc")])).first()["lang_pred"] == "und"


def test_language_distance_is_brute_force():
    text, other = prose(3), prose(4)
    profile = language_id.ranked(language_id.letters(other))
    found = language_id.Profiles(["x"], [profile], language_id.PROFILE).predict(text)[1]
    own, ranks = language_id.ranked(language_id.letters(text)).tolist(), {g: k for k, g in enumerate(profile.tolist())}
    distance = sum(abs(k - ranks[g]) if g in ranks else language_id.PROFILE for k, g in enumerate(own))
    assert found == pytest.approx(1 - distance / (len(own) * language_id.PROFILE))


def test_language_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = language_id.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95


def test_preference_pairs_of_odd_turns(spark):
    kind = "conv_id long, turn long, role string, text string, k int"
    left = [(1, 0, "user", "q", 0), (1, 1, "assistant", "good", 0), (2, 0, None, None, 0), (2, 1, "assistant", "same", 0), (None, 0, "user", "x", 0)]
    right = [(1, 0, "user", "q", 0), (1, 1, "assistant", "bad", 0), (1, 2, "user", "?", 0), (2, 0, None, None, 0), (2, 1, "assistant", "same", 0)]
    got = {r["conv_id"]: r for r in preferences.format_pairs(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind)).collect()}
    one = got[1]
    assert one["prompt"] == "<|im_start|>user\nq<|im_end|>\n" and one["prompt_turns"] == 1
    assert [one["chosen"][s["start"] : s["end"]] for s in one["chosen_spans"]] == ["good<|im_end|>\n"]
    assert [one["rejected"][s["start"] : s["end"]] for s in one["rejected_spans"]] == ["bad<|im_end|>\n"]
    assert (got[2]["prompt_turns"], got[2]["chosen"], got[2]["usable"]) == (2, "", False)
    assert got[None]["rejected"] == "" and got[None]["prompt_turns"] == 0
    empty = spark.createDataFrame([], kind)
    assert preferences.format_pairs(empty, empty).count() == 0


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for doc, data in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        mark = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                mark[s : s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(c for c, m in zip(data, mark) if not m)
        runs = len(re.findall(b"\1+", bytes(mark)))
        out[doc] = (len(data), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot_class", [1, 1000])
def test_repeats_are_brute_force(spark, hot_class):
    rng = random.Random(5)
    passage, line = prose(7, 40), prose(8, 18)
    rows = [(k, prose(100 + k, rng.randint(1, 80)) + rng.choice(["", passage, line, line + line]) + prose(200 + k, 20)) for k in range(60)]
    rows += [(70, "ab" * 400), (71, "xab" + "ab" * 300), (72, None), (73, ""), (74, "é" * 120), (None, passage), (75, rows[3][1]), (76, passage[:99])]
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(documents(spark, rows), hot_class).collect()}
    assert got == brute_repeats([(d, (t or "").encode()) for d, t in rows])
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_repeats_of_repeated_ids(spark):
    rows = [(1, prose(1)), (1, prose(1)), (1, prose(2)), (2, prose(2))]
    got = sorted(tuple(r)[:3] for r in repeats.remove_repeats(documents(spark, rows)).collect())
    n, m = len(prose(1)), len(prose(2))
    assert got == sorted([(1, n, 0), (1, n, 0), (1, m, 0), (2, m, m)])


def test_repeats_of_rows_without_ids(spark):
    """Every row has one answer of its own; among null ids equal places do not remove each other."""
    one, two, three = prose(11), prose(12), prose(13)
    rows = [(None, one), (None, two), (None, three + one), (None, three + one), (1, two + " tail"), (1, None), (None, one)]
    got = sorted((tuple(r) for r in repeats.remove_repeats(documents(spark, rows)).collect()), key=repr)
    kept = lambda text: hashlib.sha256(text.encode()).hexdigest()
    n, m, t = len(one), len(two), len(three)
    want = [(None, n, 0, 0, kept(one))] * 2  # its copies in other null rows start elsewhere, later
    want += [(None, m, m, 1, kept(""))] + [(None, t + n, n, 1, kept(three))] * 2
    want += [(1, m + 5, 0, 0, kept(two + " tail")), (1, 0, 0, 0, kept(""))]
    assert got == sorted(want, key=repr)


def test_maximal_repeats_are_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(40)).encode() for _ in range(4)]
    joined = b"\xff".join(texts) + b"\xff"
    want = {}
    for n in range(6, 41):
        places = {}
        for s in range(len(joined) - n + 1):
            if b"\xff" not in joined[s : s + n]:
                places.setdefault(joined[s : s + n], []).append(s)
        for word, at in places.items():
            lefts = {joined[s - 1] if s and joined[s - 1] != 255 else -s for s in at}
            rights = {joined[s + n] if joined[s + n] != 255 else -s for s in at}
            if len(at) > 1 and len(lefts) > 1 and len(rights) > 1:
                want[word] = at
    got = {joined[min(p) : min(p) + n]: sorted(p.tolist()) for n, p in repeats.maximal_repeats(texts, 6)}
    assert got == want


def test_mix_meets_targets(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents")).collect()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(table(spark, sf_dir, "documents").repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken = {}
    for r in rows:
        got = taken.setdefault(r["source"], [0, r["target"]])
        got[0] += r["taken"]
    assert all(abs(a - t) <= 2 * mixing.BLOCK_WORDS for a, t in taken.values())


def test_mix_targets_are_brute_force(spark):
    sizes = {"a": 10, "b": 1000, "c": 300, "d": 0, "e": 5, None: 700}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, want = sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 3 * sizes[s]
            left -= want[s]
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    assert got == pytest.approx(want)


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(1)
    claims = {k: rng.choice([1, 5, 30, 400, 5000]) for k in range(30)}
    seats = 173
    df = spark.createDataFrame([(k, c, seats, 10**6) for k, c in claims.items()], "k int, c long, s long, m long")
    got = {r["k"]: r["quota"] for r in mixing.apportion(df, [], "k", "c", "s", "m").collect()}
    order = sorted(((-c / (2 * i + 1), k) for k, c in claims.items() for i in range(seats)))[:seats]
    assert got == {k: sum(1 for _, x in order if x == k) for k in claims}


def test_apportionment_of_groups_with_ties_and_limits(spark):
    rng = random.Random(6)
    rows = [(g, k, rng.choice([0, 7, 7, 90]), {"a": 500, None: 41, "z": 0}[g], 40) for g in ("a", None, "z") for k in (*range(200 if g == "a" else 9), None)]
    df = spark.createDataFrame(rows, "g string, k int, c long, s long, m long")
    got = {(r["g"], r["k"]): r["quota"] for r in mixing.apportion(df, ["g"], "k", "c", "s", "m").collect()}
    for g in ("a", None, "z"):
        mine = [r for r in rows if r[0] == g]
        order = sorted((-c / (2 * i + 1), k is None, k or 0, k) for _, k, c, _, m in mine for i in range(m) if c)[: mine[0][3]]
        assert {r[1]: got[g, r[1]] for r in mine} == {r[1]: sum(1 for o in order if o[3] == r[1]) for r in mine}


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b c", None, "s"), (2, None, None, "s"), (None, "x " * 500, None, None), (3, "", None, None), (4, "w " * 900, None, "t"), (4, "w " * 900, None, "t")]
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == 6 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(documents(spark, [])).count() == 0


def test_decontamination_finds_exact_and_edited_passages(spark):
    item = prose(11, 30)
    edited = item[:40].upper() + "zz" + item[41:90] + item[92:]
    rows = [(1, prose(1) + " " + item + " " + prose(2)), (2, prose(3) + "\n" + edited), (3, prose(4)), (4, None), (5, "tiny x"), (None, item), (6, item[:50]), (7, prose(5, 30_000) + item)]
    bench = spark.createDataFrame([(1, item), (2, "Tiny  X"), (3, None), (4, "")], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["first_item"]) for r in decontamination.decontaminate(documents(spark, rows), bench).collect()}
    assert got == {1: (True, 1), 2: (True, 1), 3: (False, None), 4: (False, None), 5: (True, 2), None: (True, 1), 6: (False, None), 7: (True, 1)}
    assert decontamination.decontaminate(documents(spark, rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontaminate(documents(spark, []), bench).count() == 0


def test_decontamination_finds_every_stretch():
    item = prose(21, 70)[:394]
    index = decontamination.Index([(1, item)])
    for a in range(0, len(item) - 96, 7):
        part = item[a : a + 96]
        edited = part[:20] + "zz" + part[21:50] + "z" + part[50:80] + "z" + part[81:]
        for quote in (part, edited):
            assert index.find(prose(1, 30) + " Q" + quote + "q " + prose(2, 30)), a
        assert not index.find(prose(1, 30) + " Q" + part[:40] + prose(3, 9) + part[56:] + "q " + prose(2, 30))


@pytest.mark.parametrize("block_chars", [10, 4_000_000])
def test_decontamination_keeps_every_item(spark, block_chars):
    """Items without an id, items of one text and short ones; short ones stand as whole words."""
    item = prose(11, 30)
    bench = spark.createDataFrame([(None, item), (7, "Tiny  X"), (3, "tiny x"), (4, ""), (5, None), (None, "ok?"), (6, prose(12, 30))], "item_id long, text string")
    rows = [(1, prose(1) + item + prose(2)), (2, "so tiny x it is"), (3, "tiny xy"), (4, "this is ok?"), (5, prose(3)), (6, f"ok? TINY\tX {item}"), (7, "")]
    found = decontamination.decontaminate(documents(spark, rows), bench, block_chars).collect()
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["first_item"], r["least_edits"]) for r in found}
    clean = (False, 0, None, None)
    assert got == {1: (True, 1, None, 0), 2: (True, 2, 3, 0), 3: clean, 4: (True, 1, None, 0), 5: clean, 6: (True, 3, 3, 0), 7: clean}


def test_decontamination_is_brute_force(spark):
    """Short items against the least edits of any stretch of any item and any substring of a text."""

    def nearest(part, text):
        row = [0] * (len(text) + 1)
        for k, char in enumerate(part, 1):
            new = [k]
            for j, other in enumerate(text, 1):
                new.append(min(row[j - 1] + (char != other), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = random.Random(12)
    items = [(k, prose(300 + k, 40)[: rng.choice((30, 60, 96, 110))].strip()) for k in range(5)]

    def damaged(text, edits):
        for _ in range(edits):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(("", "q", text[at] + "z")) + text[at + 1 :]
        return text

    rows = [(k, prose(400 + k, 6) + " " + damaged(rng.choice(items)[1], k % 9) + " " + prose(500 + k, 6)) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["first_item"]) for r in decontamination.decontaminate(documents(spark, rows), bench).collect()}
    for doc, text in rows:
        flat, held = decontamination.normal(text), []
        for item, words in items:
            words = decontamination.normal(words)
            width = min(len(words), decontamination.WINDOW)
            stretches = [words[s : s + width] for s in range(len(words) - width + 1)]
            if min(nearest(part, flat) for part in stretches) <= decontamination.budget(width):
                held.append(item)
        assert got[doc] == (bool(held), len(held), min(held, default=None)), doc


@pytest.mark.parametrize("block_chars", [10, 4_000_000])
def test_decontamination_answers_by_row(spark, block_chars):
    item, other = prose(11, 30), prose(12, 30)
    rows = [(None, prose(1) + item), (None, prose(2)), (5, prose(3)), (5, item + prose(4) + other), (6, other + prose(5))]
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    found = decontamination.decontaminate(documents(spark, rows), bench, block_chars).collect()
    got = sorted((r["doc_id"] or 0, r["n_items"], r["n_regions"], r["first_item"] or 0, r["contaminated"]) for r in found)
    assert got == [(0, 0, 0, 0, False), (0, 1, 1, 1, True), (5, 0, 0, 0, False), (5, 2, 2, 1, True), (6, 1, 1, 2, True)]


def test_banded_alignment_is_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        part = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
        row = [0] * (len(text) + 1)
        for k, char in enumerate(part, 1):
            new = [k]
            for j, other in enumerate(text, 1):
                new.append(min(row[j - 1] + (char != other), row[j] + 1, new[-1] + 1))
            row = new
        for edits in (0, 1, 3):
            hit = decontamination.align(decontamination.codes(part), decontamination.codes(text), edits)
            assert (hit[2] if hit else None) == (min(row) if min(row) <= edits else None)


def test_simhash_is_brute_force(spark):
    from xxhash import xxh64_intdigest

    rows = ODD + [(100 + k, prose(9, 80).replace("a", "b" if k else "a", k)) for k in range(30)]
    prints = {}
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        parts = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        h = [xxh64_intdigest(p.encode(), 42) for p in parts]
        prints[text] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    values = sorted(set(prints.values()))
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for v in values:
            best = min(root[u] for u in values if (u ^ v).bit_count() <= 4)
            changed |= best < root[v]
            root[v] = best
    first = {}
    for doc, text in rows:
        if doc is not None:
            r = root[prints[text]]
            first[r] = min(doc, first.get(r, doc))
    want = sorted(((d, f"{prints[t]:016x}", first.get(root[prints[t]])) for d, t in rows), key=repr)
    got = simhash.simhash_dedup(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert simhash.simhash_dedup(documents(spark, [])).count() == 0


def test_simhash_tiles_lose_no_link(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 5))) for b in base for _ in range(5)]
    df = spark.createDataFrame([(k, p - (1 << 64) if p >> 63 else p) for k, p in enumerate(prints)], "doc_id long, fp long")
    edges = simhash.links(df.select("fp").distinct(), 4, tile=16).collect()
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        u, v = e["u"] % (1 << 64), e["v"] % (1 << 64)
        parent[find(u)] = find(v)
    got = {p: find(p) for p in prints}
    assert all(got[p] == got[q] for p in prints for q in prints if (p ^ q).bit_count() <= 4)


PAGES = [
    (1, "u", "a WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1."), (2, None, None), (3, "u\r\nx", ""),
    (4, "u", "a WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1."), (None, "é", ""),
    (5, "x", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 40\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "x", "WARC/WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"), (7, "z", "é" * 100_000), (7, "z", "é" * 100_000),
]


@pytest.mark.parametrize("split", ["128m", "7000"])
def test_archives_come_back_whole(spark, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = warc.round_trip(pages, records_per_archive=20)
        assert against_sql(found, warc.SQL, pages=pages) == ""
        assert warc.round_trip(pages.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_license_base_phrases_are_brute_force(spark):
    texts = ["Released under the MIT License.", "under the mit-license under THE\nMIT license", None, "", "Apache License, Version 2.0 cc BY-NC 4", "underé the mit license", "x " * 5000 + "cc by nc"]
    got = licenses.license_scan(documents(spark, list(enumerate(texts)))).collect()
    for row, text in zip(sorted(got), texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hits = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        assert (row["n_words"], row["n_base"]) == (len(words), len(hits))
        assert row["base_labels"] == ",".join(sorted({label for _, label in hits}))
        assert row["first_word"] == min((k for k, _ in hits), default=None)
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1
    assert licenses.license_scan(documents(spark, [])).count() == 0


def written(markup, fill="ACME, Inc."):
    """A text of the template: capitals, punctuation, all optional parts, replaceable ones filled."""
    text = re.sub(r"\{\{[^}]*\}\}", fill, markup).replace("[[", "").replace("]]", "")
    return ". ".join(part.strip().capitalize() for part in re.split(r"(?<= the software) ", text))


@pytest.mark.parametrize("label", ["mit-license", "bsd-2-clause", "bsd-3-clause", "isc", "apache-2-header"])
def test_whole_licenses(label):
    markup = licenses.TEMPLATES[label]
    automaton, whole = licenses.Automaton(markup), written(markup)
    found = licenses.words("Some words before. " + whole + " And some after.")
    assert automaton.accept(found, 3) == len(licenses.words(whole)) + 3
    bare = licenses.words(re.sub(r"\[\[.*?\]\]", "", re.sub(r"\{\{[^}]*\}\}", "x", markup)))
    assert automaton.accept(bare, 0) == len(bare) and label in licenses.Scanner().scan(whole)["labels"].split(",")
    for k in range(len(bare)):  # one mandatory word changed, left out or doubled
        if bare[k] == b"x":
            continue
        for wrong in ([b"zzz"], [], [bare[k], b"zzz"]):
            text = bare[:k] + wrong + bare[k + 1 :]
            end = automaton.accept(text, 0)
            beside_replaceable = b"x" in bare[max(0, k - 1) : k + 2]
            last = k == len(bare) - 1 and wrong[:1] == [bare[k]]
            assert end == -1 or last or beside_replaceable, (k, bare[k], wrong)


def test_templates_are_brute_force():
    """Every end of every start, against the markup as a regular expression over words."""
    rng = random.Random(8)
    for markup in ("a [[b c]] {{x:1-2}} d", "a [[b [[c]] a]] b", "{{x:0-2}} a b", "[[a]] [[b]] c {{x:2-3}}", "a {{x:0-1}} {{y:1-2}} [[d]] c"):
        expression = re.sub(r"\{\{[^}]*:(\d)-(\d)\}\}", r"(?:\\S+ ){\1,\2}", re.sub(r"(?<![{\w:])([a-d])(?![\w:])", r"\1 ", markup))
        expression = re.sub(r"\]\] ?", ")?", expression.replace("[[", "(?:"))
        expression = re.compile(re.sub(r"(?<=[)}?]) +|(?<= ) +", "", expression))
        automaton = licenses.Automaton(markup)
        for _ in range(300):
            text = [rng.choice("abcd") for _ in range(rng.randint(0, 9))]
            ends = [e for e in range(len(text) + 1) if expression.fullmatch("".join(f"{w} " for w in text[:e]))]
            assert automaton.accept([w.encode() for w in text], 0) == max(ends, default=-1), (markup, text)


def test_template_markup():
    automaton = licenses.Automaton("a [[b c]] {{x:1-2}} d")
    accept = lambda text: automaton.accept(licenses.words(text), 0)
    assert [accept(t) for t in ("a q d", "a b c q d", "a q r d", "a q r s d", "a d", "a b c d", "a b q d")] == [3, 5, 4, -1, -1, 4, 4]


def test_toxicity(spark):
    rows = [(k, prose(k, 50) + (" you utter scoundrel " if k % 4 == 0 else " you kind friend ") + prose(k + 900, 20)) for k in range(240)]
    rows += [(300, None), (301, ""), (None, "scoundrel")]
    labels = spark.createDataFrame([(k, int(k % 4 == 0), "x") for k in range(240)] + [(0, None, "x"), (500, 1, "x")], "doc_id long, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents(spark, rows), labels).collect()}
    held = [k for k in range(240) if got[k]["held_out"]]
    assert len(held) > 40 and all(got[k]["predicted"] == (k % 4 == 0) for k in held)
    assert got[300]["score"] == got[301]["score"] and len(got) == 243
    assert toxicity.toxicity(documents(spark, []), labels).count() == 0
    assert toxicity.toxicity(documents(spark, rows), labels.limit(0)).agg(F.min("score"), F.max("score")).first()[:] == (0.5, 0.5)


def test_toxicity_fit_in_chunks(monkeypatch):
    assert toxicity.FIT_ROWS >= 20_000
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(40) < share).astype("<u2") for share in rng.choice([0, 0.1, 0.9], 200)]
    ratio, label = rng.normal(size=40), (rng.random(200) < 0.3).astype(float)
    whole, bias = toxicity.fit_logistic(rows, ratio, label)
    monkeypatch.setattr(toxicity, "CHUNK", 25)
    parts, bias_too = toxicity.fit_logistic(rows, ratio, label)
    assert parts == pytest.approx(whole) and bias_too == pytest.approx(bias)


def test_toxicity_map_is_the_likeliest():
    rng = np.random.default_rng(3)
    score = rng.normal(size=4000) * 3
    label = (rng.random(4000) < 1 / (1 + np.exp(-(1.7 * score - 2)))).astype(float)
    assert toxicity.fit_map(score, label, 0.0) == pytest.approx((1.7, -2), abs=0.25)
    shift = toxicity.fit_map(score, label, 1.0)[1] - toxicity.fit_map(score, label, 0.0)[1]
    assert shift == pytest.approx(np.log((label == 0).sum() / label.sum()))
    assert toxicity.fit_map(score, np.ones(4000)) == toxicity.fit_map(-score, label) == (1.0, 0.0)


def test_toxicity_scores_of_unseen_rows():
    """A row's score does not depend on its own label or marks' counts."""
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(60)]
    label = (rng.random(60) < 0.4).astype(float)
    counts = lambda y: [sum((np.bincount(r, minlength=30) for r, k in zip(rows, y) if k == c), np.zeros(30, int)) for c in (0, 1)]
    scores = lambda y: toxicity.unseen_scores(rows, y, *counts(y), (int((y == 0).sum()), int(y.sum())))
    other = label.copy()
    other[::3] = 1 - other[::3]  # all of part 0
    assert scores(other)[::3] == pytest.approx(scores(label)[::3])
    assert not np.allclose(scores(other)[1::3], scores(label)[1::3])


def test_toxicity_held_out(spark):
    """sf0.1 marks some 300 training documents as toxic: the ranking is right, nine tenths are caught, clean documents left alone."""
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = toxicity.toxicity(docs, labels).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = (np.array([r["score"] for r in held if r["toxic"] == k]) for k in (1, 0))
    assert (toxic[:, None] > clean).mean() > 0.95
    assert (clean >= 0.7).mean() < 0.01 and (toxic >= 0.7).mean() >= 0.9


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns
        docs = spark.createDataFrame(found.toArrow())
        kept.append({r["doc_id"] for r in docs.collect()})
    assert all(a >= b for a, b in zip(kept, kept[1:]))
    exact = {r["doc_id"] for r in exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).where("kept").collect()}
    assert kept[1] == kept[0] & exact
    mixed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in mixed.collect()} == kept[-1]


def test_pipeline_decides_by_row(spark, tmp_path):
    import corpus_pipeline

    item = prose(11, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaking = [(None, prose(1) + item), (None, prose(2)), (5, prose(3)), (5, item + prose(4)), (6, prose(5))]
    left = corpus_pipeline.drop_benchmark_leaks(spark, documents(spark, leaking), str(tmp_path))
    assert sorted(r["text"] for r in left.collect()) == sorted([prose(2), prose(3), prose(5)])

    same = [(None, prose(1)), (None, " " + prose(1)), (None, prose(2)), (3, prose(2)), (None, prose(3)), (4, prose(4)), (4, prose(4)), (4, prose(5)), (None, None), (None, None)]
    left = corpus_pipeline.drop_copies(spark, documents(spark, same), str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) == sorted([(0, " " + prose(1)), (3, prose(2)), (0, prose(3)), (4, prose(4)), (4, prose(5)), (0, "")])

    long = prose(9, 400)
    near = [(None, long), (None, long + " x"), (None, prose(2)), (8, long + " y"), (7, prose(3)), (7, prose(3)), (7, prose(4))]
    left = corpus_pipeline.drop_near_copies(spark, documents(spark, near), str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(0, prose(2)), (8, long + " y"), (7, prose(3)), (7, prose(4))])


def test_pipeline_keeps_what_it_cannot_judge(spark, tmp_path):
    """Columns of the stages' own names stay, no language to learn keeps all rows, a script of many letters is no reason to go."""
    import corpus_pipeline

    spark.createDataFrame([(1, prose(11, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kind = "doc_id long, text string, lang string, source string, row string, Guess int, _row int, row_ int"
    rng = random.Random(6)
    han = lambda n: "".join(chr(0x4E00 + int(rng.paretovariate(0.4)) % 3000) for _ in range(n))
    rows = [(k, han(rng.randint(15, 200)), "zh", "s", "r", 1, 2, 3) for k in range(200)]
    rows += [(300, "12 34", "zh", "s", "r", 1, 2, 3), (301, None, "zh", "s", "r", 1, 2, 3)]
    docs = spark.createDataFrame(rows, kind)
    judged = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert judged.columns == docs.columns and {r["doc_id"] for r in judged.collect()} == set(range(200))
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, unknown, str(tmp_path)).count() == 202
    for name, stage in corpus_pipeline.STAGES[1:4]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns and left.where("Guess = 1 and _row = 2 and row_ = 3 and row = 'r'").count() == left.count() > 190
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
