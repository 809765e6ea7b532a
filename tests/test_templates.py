"""Template mining against a plain one-line-at-a-time clustering."""

import random

import pytest

from logblocks.operators import templates
from logblocks.operators.templates import mine_templates

WILD = "<*>"


def one_by_one(messages, depth=4, max_children=100, similarity=0.4):
    """(event, template as of the line) per message, by walking a nested dict."""
    roots, made, out = {}, [], []
    for message in messages:
        tokens = message.replace("_", " ").split()
        levels = max(0, min(depth - 3, len(tokens) - 1))
        root = roots.setdefault(len(tokens), {"kids": {}, "ids": []})
        node = root
        for token in tokens[:levels]:
            node = node and (node["kids"].get(token) or node["kids"].get(WILD))
        best = None
        for c in node["ids"] if node else []:
            template = made[c]
            equal = sum(a == b and a != WILD for a, b in zip(template, tokens))
            key = (equal, template.count(WILD))
            if best is None or key > best[0]:
                best = (key, c)
        if best and (len(tokens) == 0 or best[0][0] / len(tokens) >= similarity):
            c = best[1]
            made[c] = [a if a == b else WILD for a, b in zip(made[c], tokens)]
        else:
            c = len(made)
            made.append(tokens)
            node = root
            for token in tokens[:levels]:
                kids = node["kids"]
                if token not in kids:
                    crowded = len(kids) + (WILD not in kids) >= max_children
                    token = WILD if crowded or any(x.isdigit() for x in token) else token
                node = kids.setdefault(token, {"kids": {}, "ids": []})
            node["ids"].append(c)
        out.append((f"E{c + 1}", " ".join(made[c])))
    return out, [" ".join(t) for t in made]


def random_log(seed, size):
    """Messages whose clusters merge, overlap and overflow."""
    draw = random.Random(seed)
    words = ["open", "close", "blk_1", "7", "10.0.0.1", "to", "from", "fail_x", "ok", WILD]
    out = []
    for i in range(size):
        shape = draw.choice([1, 2, 3, 4, 4, 5, 5, 6])
        pool = words[: 3 + (7 * i) // size]
        out.append(" ".join(draw.choice(pool) for _ in range(shape)) if draw.random() > 0.02 else "")
    return out


def frame(spark, messages, partitions):
    rows = spark.createDataFrame(list(enumerate(messages)), "line_no long, message string")
    return rows.repartition(partitions) if partitions else rows.coalesce(1)


def mined(result):
    return [(r.event_id, r.template_at_line) for r in result.assigned.orderBy("line_no").collect()]


@pytest.mark.parametrize("partitions,similarity,depth,children", [(0, 0.4, 4, 100), (4, 0.4, 4, 100), (16, 0.4, 4, 100), (4, 0.7, 5, 3), (4, 0.2, 6, 4)])
def test_equals_one_pass(spark, partitions, similarity, depth, children):
    messages = random_log(similarity, 1500)
    expected, final = one_by_one(messages, depth, children, similarity)
    result = mine_templates(frame(spark, messages, partitions), depth=depth, max_children=children, similarity=similarity)
    assert mined(result) == expected
    catalog = {r.event_id: r for r in result.catalog.collect()}
    assert {e: r.template for e, r in catalog.items()} == {f"E{i + 1}": t for i, t in enumerate(final)}
    assert all(r.size == sum(e == event for e, _ in expected) for event, r in catalog.items())
    assert tuple(result.metadata.select("total_lines", "total_templates").first()) == (1500, len(final))


def test_thinning_keeps_the_result(spark, monkeypatch):
    monkeypatch.setattr(templates, "REPLAY_ROWS", 40)
    messages = random_log(5, 1500)
    assert mined(mine_templates(frame(spark, messages, 16))) == one_by_one(messages)[0]


@pytest.mark.parametrize("first_lines", [0, 1, 200])
def test_any_head_start_gives_the_same_result(spark, first_lines):
    messages = random_log(6, 1500)
    expected, final = one_by_one(messages)
    result = mine_templates(frame(spark, messages, 6), first_lines=first_lines)
    assert mined(result) == expected
    assert {r.event_id: r.template for r in result.catalog.collect()} == {f"E{i + 1}": t for i, t in enumerate(final)}


def test_hot_message(spark):
    """Two thirds of the lines are one message; the clusters change around them."""
    messages = random_log(9, 600)
    hot = [m for pair in zip(messages, ["open to 7"] * 600, ["open to 8"] * 600) for m in pair]
    assert mined(mine_templates(frame(spark, hot, 8))) == one_by_one(hot)[0]


@pytest.mark.parametrize("cut", [1, 700])
def test_resume_continues(spark, cut):
    messages = random_log(3, 1400)
    expected, final = one_by_one(messages)
    log = frame(spark, messages, 4)
    first = mine_templates(log.where(f"line_no < {cut}"))
    second = mine_templates(log.where(f"line_no >= {cut}"), prior=first.catalog)
    assert mined(first) + mined(second) == expected
    assert {r.event_id: r.template for r in second.catalog.collect()} == {f"E{i + 1}": t for i, t in enumerate(final)}


def test_resume_ends_when_thinning_drops_a_needed_line(spark, monkeypatch):
    """Alone, the later lines look like the old template; the first must not be thinned away with them."""
    monkeypatch.setattr(templates, "REPLAY_ROWS", 1)
    messages = ["a b c d e", "a b x y e", "a q x y r", "a q z w r"]
    log = frame(spark, messages, 3)
    first = mine_templates(log.where("line_no < 1"))
    second = mine_templates(log.where("line_no >= 1"), prior=first.catalog)
    assert mined(first) + mined(second) == one_by_one(messages)[0]


def test_three_messages(spark):
    log = frame(spark, ["Receiving block blk_1 src", "Receiving block blk_2 src", "PacketResponder terminating now ok"], 1)
    result = mine_templates(log, similarity=0.5)
    ids = sorted(r.event_id for r in result.catalog.collect())
    assert len(ids) >= 2 and ids == [f"E{i + 1}" for i in range(len(ids))]
    assert result.metadata.first().total_lines == 3


def test_missing_column(spark):
    with pytest.raises(KeyError, match="message"):
        mine_templates(spark.range(1).selectExpr("id as line_no", "'x' as body"))


def test_any_column_name(spark):
    log = spark.createDataFrame([(0, "a b")], "line_no long, `log text` string")
    assert mine_templates(log, message="log text").catalog.first().template == "a b"


def test_runs_of_token_counts_give_the_same_result(spark):
    """A plan beyond the broadcast bound goes out in several runs."""
    messages = random_log(1, 600)
    expected, final = one_by_one(messages)
    log = frame(spark, messages, 3)
    assert mined(mine_templates(log, plan_tokens=5)) == expected
    first = mine_templates(log.where("line_no < 300"), plan_tokens=1)
    second = mine_templates(log.where("line_no >= 300"), prior=first.catalog, plan_tokens=30)
    assert mined(first) + mined(second) == expected
    assert {r.event_id: r.template for r in second.catalog.collect()} == {f"E{i + 1}": t for i, t in enumerate(final)}


def test_crowded_leaf(spark):
    """4,000 unlike lines under one leaf, all clusters of their own."""
    messages = [f"start {' '.join(f'v{i}x{j}' for j in range(6))}" for i in range(4000)]
    result = mine_templates(frame(spark, messages, 4))
    assert mined(result) == [(f"E{i + 1}", m) for i, m in enumerate(messages)]


def test_empty_log(spark):
    result = mine_templates(frame(spark, ["a b"], 1).where("line_no > 5"))
    assert result.assigned.count() == 0 and result.catalog.count() == 0
    assert tuple(result.metadata.select("total_lines", "total_templates").first()) == (0, 0)
