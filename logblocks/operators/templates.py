"""Message templates: exact sequential clustering without a sequential job.

Clusters change at few lines only (a new cluster, or a new wildcard); all other
lines fit the clusters as they are. So:

1. the partitions that hold the first lines cluster them, each from scratch, and
   report the lines that changed something;
2. the reported lines are replayed in line order, one task per leaf of the prefix tree, which yields the
   lines that do change clusters (the plan) and the clusters after them, both as tables;
3. with the plan broadcast, every partition knows the clusters as of each of its lines and assigns
   all its lines without any shuffle. A plan above ``PLAN_TOKENS`` goes out in runs of leaves;
4. a line anywhere that changes clusters but is not in the plan is added to the report,
   and steps 2 and 3 run again for its token count: only its lines share clusters. The first such line
   moves on in every round. When none is left, by induction on the line order, the result
   equals one pass over the whole log.

The prefix tree of step 2 comes from first appearances. Below a node, a token that comes before the node's wildcard child is a child
from its first line on; the wildcard child appears with the first token that has a digit, or with the one that finds the node
full. These are aggregates over (token count, node, token). A later token stays with the wildcard child until one of its lines opens
a cluster of its own; so the wildcard child and what is undecided beside it is one replay, which tells where further children begin.
Every other line goes down to its child. Thus lines part by leaf, not by token count.

Step 1 only saves rounds of step 4. No group of lines ever gathers in one task,
however common one message is; a task holds the clusters and the plan of the leaves it works on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logblocks.functions.clusters import WILDCARD, Clusters, Rules, has_digit
from logblocks.functions.text import words
from logblocks.operators.ordering import SMALL_ROWS, number_rows
from logblocks.operators.staging import broadcast_if_small, fits, materialize, require_columns
from logblocks.shipping import ship

FIRST_LINES = 1_000_000
REPLAY_ROWS = 50_000
PLAN_TOKENS = 4_000_000

CHANGES = "line_no long, tokens array<string>"
# Known clusters have a path and, as line, their negative cluster number.
REPORTED = CHANGES + ", path array<string>"
# What a replay tells of a leaf ``(n, leaf)``. A leaf that ends in a wildcard is that child and the undecided tokens beside it.
# known, change: what a partition needs; cluster: what is there in the end, by the line that opened it;
# child: a token that has a node of its own from that line on (of ``leaf`` without its end); pass: a line that goes down to it.
REPLAYED = "kind string, n int, leaf array<string>, line_no long, tokens array<string>, path array<string>, text string"
ALWAYS = -2  # from this line on a known child is there


def message_tokens(message, extra_delimiters: str = "_"):
    """Tokens of a message; an absent message has none."""
    return words(F.coalesce(message, F.lit("")), extra_delimiters, controls=True)


@dataclass
class Seed:
    """What a run starts from. By leaf ``(n, path)``: known clusters ``(line, tokens, path)`` and change lines; by node: its children's lines.

    ``own`` are the leaves of this run and ``others`` those of other runs; without both, all lines are its own.
    """

    rules: Rules
    known: dict[tuple, list[tuple]]
    changes: dict[tuple, tuple[np.ndarray, list[list[str]]]]
    tree: dict[tuple, dict[str, tuple[int, bool]]]
    own: set | None = None
    others: set | None = None

    @staticmethod
    def of(rules: Rules, rows, own=None, others=None) -> "Seed":
        """From ``(kind, n, leaf, line_no, tokens, path)`` rows in any order, each line of a leaf once."""
        known, changes, tree = {}, {}, {}
        for kind, n, leaf, line, tokens, path in sorted(rows, key=lambda row: abs(row[3])):
            leaf = tuple(leaf)
            if kind == "child":  # path is set for a child that the replay of its undecided line found
                tree.setdefault((n, leaf[:-1]), {})[leaf[-1]] = (line, path is None)
            else:
                (known if kind == "known" else changes).setdefault((n, leaf), []).append((line, tokens, path))
        split = {key: (np.array([c[0] for c in group], np.int64), [c[1] for c in group]) for key, group in changes.items()}
        return Seed(rules, known, split, tree, own, others)

    def clusters(self, key: tuple) -> Clusters:
        n, leaf = key
        start = Clusters(n, self.rules)
        if leaf[-1:] == (WILDCARD,):
            start.open(leaf[:-1], [t for t, (_, early) in self.tree.get((n, leaf[:-1]), {}).items() if early])
        else:
            start.open(leaf)
        for line, tokens, path in self.known.get(key, ()):
            start.restore(tokens, tuple(path), line)
        return start

    def leaves(self, n: int, codes: np.ndarray, words: list[str], lines: np.ndarray):
        """``(leaf, rows)`` for lines of ``n`` tokens, ``codes`` numbers into ``words``."""
        stack, prefix = [((), np.arange(len(lines)))], self.rules.prefix(n)
        places = {w: k for k, w in enumerate(words)} if prefix and any(key[0] == n for key in self.tree) else {}
        while stack:
            node, rows = stack.pop()
            if len(node) == prefix:
                yield node, rows
                continue
            begins = np.full(len(words), np.iinfo(np.int64).max)
            for token, (line, _) in self.tree.get((n, node), {}).items():
                if token in places:
                    begins[places[token]] = line
            tokens = codes[rows, len(node)]
            down = lines[rows] >= begins[tokens]
            if not down.all():
                yield (*node, WILDCARD), rows[~down]
            for token in np.unique(tokens[down]).tolist():
                stack.append(((*node, words[token]), rows[down & (tokens == token)]))

    def mine(self, key: tuple) -> bool:
        return (self.own is None or key in self.own) if self.others is None else key not in self.others


class _Track:
    """Clusters of one leaf, moved along the lines of a partition."""

    def __init__(self, seed: Seed, key: tuple):
        self.seed, self.key = seed, key
        self.lines, self.tokens = seed.changes.get(key, (np.empty(0, np.int64), []))
        self._restart()

    def _restart(self) -> None:
        self.at, self.state, self.last, self.left_plan = 0, self.seed.clusters(self.key), -1, False

    def _step(self) -> int:
        cluster, _ = self.state.add(self.tokens[self.at], int(self.lines[self.at]))
        self.at += 1
        return cluster

    def assign(self, codes, words_, lines):
        """(the cluster's first line, text, unplanned change) for rows in line order."""
        chosen, texts = np.empty(len(lines), np.int64), np.empty(len(lines), object)
        changed = np.zeros(len(lines), bool)
        if lines[0] < self.last:
            # the next file of the partition; a change found after later lines would hide earlier ones
            self._restart()
        self.last, i = lines[-1], 0
        while i < len(lines):
            j = len(lines)
            if not self.left_plan:
                while self.at < len(self.lines) and self.lines[self.at] < lines[i]:
                    self._step()
                if self.at < len(self.lines):
                    if self.lines[self.at] == lines[i]:
                        chosen[i] = self._step()
                        texts[i] = self.state.texts[chosen[i]]
                        i += 1
                        continue
                    j = int(np.searchsorted(lines, self.lines[self.at]))
            chosen[i:j], texts[i:j], changed[i:j] = self.state.advance(codes[i:j], words_, lines[i:j])
            self.left_plan |= bool(changed[i:j].any())
            i = j
        return np.array(self.state.first_lines, np.int64)[chosen], texts, changed


def _assigned(batches: Iterator[pa.RecordBatch], seed: Seed) -> Iterator[tuple]:
    """Per batch: (batch, token count, cluster's first line, text, unplanned change) row arrays, of the rows that are the run's own."""
    tracks: dict[tuple, _Track] = {}
    for batch in batches:
        tokens = batch.column("_tokens")
        lines = batch.column("line_no").to_numpy()
        counts = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(counts) - counts
        coded = tokens.flatten().dictionary_encode()
        codes, vocabulary = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        first, text = np.empty(len(lines), np.int64), np.empty(len(lines), object)
        changed, own = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
        for n in np.unique(counts).tolist():
            rows = np.flatnonzero(counts == n)
            rows = rows[np.argsort(lines[rows], kind="stable")]
            matrix = codes[starts[rows][:, None] + np.arange(n)].reshape(len(rows), n)
            for leaf, some in seed.leaves(n, matrix, vocabulary, lines[rows]):
                if not seed.mine((n, leaf)):
                    continue
                if (n, leaf) not in tracks:
                    tracks[n, leaf] = _Track(seed, (n, leaf))
                at = rows[some]
                first[at], text[at], changed[at] = tracks[n, leaf].assign(matrix[some], vocabulary, lines[at])
                own[at] = True
        if own.all():
            yield batch, counts, first, text, changed
        else:
            yield batch.filter(pa.array(own)), counts[own], first[own], text[own], changed[own]


def _change_lines(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines that change the clusters of their own partition, from scratch."""
    fresh = Seed(rules, {}, {}, {})

    def find(batches):
        for batch, _, _, _, changed in _assigned(batches, fresh):
            kept = batch.filter(pa.array(changed))
            yield pa.RecordBatch.from_arrays([kept.column("line_no"), kept.column("_tokens")], ["line_no", "tokens"])

    return lines.select("line_no", "_tokens").mapInArrow(find, CHANGES)


def _rows(table: pa.Table) -> list[tuple]:
    """The ``(line_no, tokens, path)`` rows in line order, each line once; known clusters first."""
    columns = [table[c].to_pylist() if c in table.column_names else [None] * len(table) for c in ("line_no", "tokens", "path")]
    return sorted({row[0]: row for row in zip(*columns)}.values(), key=lambda row: (row[2] is None, abs(row[0])))


REPLAYED_ARROW = pa.schema(
    [("kind", pa.string()), ("n", pa.int32()), ("leaf", pa.list_(pa.string())), ("line_no", pa.int64()), ("tokens", pa.list_(pa.string()))]
    + [("path", pa.list_(pa.string())), ("text", pa.string())]
)


def _replay(rules: Rules, undecided: bool):
    """Replays the reported lines of one leaf (rows n, node, line_no, tokens, path; a row without tokens names a child of the node)."""

    def replay(table: pa.Table) -> pa.Table:
        n, node = table["n"][0].as_py(), tuple(table["node"][0].as_py())
        leaf, level, out = (*node, WILDCARD) if undecided else node, len(node), []
        tell = lambda kind, line, tokens, path=None, text=None, at=leaf: out.append((kind, n, list(at), line, tokens, path, text))
        state, created = Clusters(n, rules), set()
        is_kid = table["tokens"].is_null()
        state.open(node, [path[0] for path in table.filter(is_kid)["path"].to_pylist()])
        for line, tokens, path in _rows(table.filter(pc.invert(is_kid))):
            if path is not None:
                state.restore(tokens, tuple(path), line)
                tell("known", line, tokens, path)
            elif undecided and tokens[level] in created:
                tell("pass", line, tokens)
            else:
                cluster, changed = state.add(tokens, line)
                if not changed:
                    continue
                tell("change", line, tokens)
                opened = state.paths[cluster][level] if undecided and state.first_lines[cluster] == line else WILDCARD
                if undecided and opened != WILDCARD:
                    created.add(opened)
                    tell("child", line, None, [], at=(*node, opened))
                    tell("pass", line, tokens)
        for template, path, line, text in zip(state.templates, state.paths, state.first_lines, state.texts):
            if not undecided or path[level] == WILDCARD:
                tell("cluster", line, template, list(path), text)
        columns = list(zip(*out)) if out else [()] * len(REPLAYED_ARROW)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, REPLAYED_ARROW)], schema=REPLAYED_ARROW)

    return replay


@cache
def _digits() -> str:
    """The characters that ``has_digit`` finds, as a pattern."""
    return "[" + "".join(c for c in map(chr, range(0x110000)) if has_digit(c)) + "]"


def _children(open_rows: DataFrame, level: int, rules: Rules) -> DataFrame:
    """``(n, node, token, line)``: the children that are there before their node's wildcard child."""
    known = F.col("path").isNotNull()
    token = F.when(known, F.get("path", F.lit(level))).otherwise(F.get("tokens", F.lit(level))).alias("token")
    line = F.when(~known, F.col("line_no")).when(token == WILDCARD, ALWAYS + 1).otherwise(ALWAYS)
    firsts = open_rows.groupBy("n", "node", token).agg(F.min(line).alias("line"))
    wild = (F.col("token") == WILDCARD) | F.col("token").rlike(_digits())
    place = F.row_number().over(Window.partitionBy("n", "node").orderBy("line", "token"))
    plain = firsts.where(~wild).withColumn("place", place).where(F.col("place") <= rules.max_children)
    full = plain.where(F.col("place") == rules.max_children).select("n", "node", "line")
    begins = firsts.where(wild).select("n", "node", "line").unionByName(full).groupBy("n", "node").agg(F.min("line").alias("wild"))
    found = plain.join(begins, ["n", "node"], "left")
    early = F.col("wild").isNull() | (F.col("line") < F.col("wild")) | (F.col("line") == ALWAYS)
    return found.where(early).select("n", "node", "token", "line")


def _replayed(reported: DataFrame, rules: Rules) -> DataFrame:
    """The plan, the tree and the final clusters of all reported lines, one task per leaf."""
    levels = max(0, rules.depth - 3)
    n = F.size("tokens")
    open_rows = reported.select(
        n.alias("n"), F.expr("cast(array() as array<string>)").alias("node"), "line_no", "tokens", "path"
    ).withColumn("prefix", F.greatest(F.lit(0), F.least(F.lit(levels), F.col("n") - 1)))
    told, kinds = [], [f.name for f in REPLAYED_ARROW]
    columns = ["n", "node", "line_no", "tokens", "path"]
    leaves = open_rows.where(F.col("prefix") == 0).select(*columns)
    for level in range(levels):
        open_rows = open_rows.where(F.col("prefix") > level)
        if level:
            open_rows = materialize(open_rows, "open-lines")
        children = materialize(_children(open_rows, level, rules), "children")
        token = F.when(F.col("path").isNotNull(), F.get("path", F.lit(level))).otherwise(F.get("tokens", F.lit(level)))
        parted = open_rows.withColumn("token", token).join(children.withColumnRenamed("line", "begins"), ["n", "node", "token"], "left")
        down = F.concat("node", F.array("token")).alias("node")
        going = parted.where("begins is not null").select("n", down, "line_no", "tokens", "path", "prefix")
        beside = parted.where("begins is null")
        kids = children.select(
            "n", "node", F.lit(None).cast("long").alias("line_no"), F.lit(None).cast("array<string>").alias("tokens"), F.array("token").alias("path")
        )
        undecided = beside.select(*columns).unionByName(kids).groupBy("n", "node")
        undecided = materialize(undecided.applyInArrow(_replay(rules, True), REPLAYED), "replayed")
        told.append(undecided.where("kind != 'pass'"))
        told.append(
            children.select(
                F.lit("child").alias("kind"), "n", F.concat("node", F.array("token")).alias("leaf"), F.col("line").alias("line_no"),
                *(F.lit(None).cast(REPLAYED_KINDS[c]).alias(c) for c in ("tokens", "path", "text")),
            )
        )
        passed = undecided.where("kind = 'pass'")
        node = F.concat(F.slice("leaf", 1, F.lit(level)), F.array(F.get("tokens", F.lit(level)))).alias("node")
        prefix = F.greatest(F.lit(0), F.least(F.lit(levels), F.col("n") - 1)).alias("prefix")
        open_rows = going.unionByName(passed.select("n", node, "line_no", "tokens", F.lit(None).cast("array<string>").alias("path"), prefix))
        leaves = leaves.unionByName(open_rows.where(F.col("prefix") == level + 1).select(*columns))
    told.append(materialize(leaves.groupBy("n", "node").applyInArrow(_replay(rules, False), REPLAYED), "replayed"))
    return reduce(DataFrame.unionByName, (part.select(*kinds) for part in told))


REPLAYED_KINDS = {"tokens": "array<string>", "path": "array<string>", "text": "string"}


def _thin(changes: DataFrame, rules: Rules) -> DataFrame:
    """Drops reported lines that change nothing when replayed together, range by range.

    Thinning is a saving only: a needed line that it drops is found again. The first reported
    line of each token count is a real change and always stays, so every round adds one.
    """
    reported = changes

    def replay(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        state = Clusters(len(rows[0][1]), rules)
        kept = [row for row in rows if state.add(row[1], row[0])[1]]
        return pa.table({"line_no": pa.array([r[0] for r in kept], pa.int64()), "tokens": pa.array([r[1] for r in kept], pa.list_(pa.string()))})

    total = changes.count()
    while total > REPLAY_ROWS:
        groups = -(-total // REPLAY_ROWS)
        width = (changes.agg(F.max("line_no")).first()[0] + 1) / groups
        cells = [F.size("tokens").alias("_n"), F.floor(F.col("line_no") / width).alias("_cell")]
        thinner = materialize(changes.groupBy(*cells).applyInArrow(replay, CHANGES), "changes")
        left = thinner.count()
        changes = thinner
        if left > total * 0.9:
            break
        total = left
    if changes is not reported:
        first = reported.groupBy(F.size("tokens").alias("_n")).agg(F.min(F.struct("line_no", "tokens")).alias("_first"))
        changes = changes.unionByName(first.select("_first.line_no", "_first.tokens"))
    return changes.withColumn("path", F.lit(None).cast("array<string>"))


def _runs(plan: DataFrame, wanted: list[int] | None, most: int) -> list[list[tuple]]:
    """Leaves dealt into runs of at most ``most`` planned tokens; a leaf above that is a run of its own."""
    tokens = F.sum(F.col("n") + 1).alias("tokens")
    sizes = plan.where("kind in ('known', 'change')").groupBy("n", "leaf").agg(tokens).orderBy("n", "leaf").toLocalIterator()  # one row a leaf
    runs, room = [[]], most
    for n, leaf, tokens in sizes:
        if wanted is not None and n not in wanted:
            continue
        if tokens > room and runs[-1]:
            runs.append([])
            room = most
        runs[-1].append((n, tuple(leaf)))
        room -= tokens
    return runs


def _seed(plan: DataFrame, rules: Rules, runs: list[list[tuple]], i: int) -> Seed:
    """What run ``i`` starts from: the plan of its leaves, and the tree of their token counts.

    Lines of leaves without a plan go with the first run.
    """
    counts = sorted({n for n, _ in runs[i]})
    others = {key for other in runs[:i] + runs[i + 1 :] for key in other}
    columns = ("kind", "n", "leaf", "line_no", "tokens", "path")
    if len(runs) == 1:
        return Seed.of(rules, map(tuple, plan.where("kind != 'cluster'").select(*columns).collect()))  # PLAN_TOKENS at most
    own = plan.sparkSession.createDataFrame([(n, list(leaf)) for n, leaf in runs[i]], "n int, leaf array<string>")
    mine = plan.where("kind in ('known', 'change')").join(F.broadcast(own), ["n", "leaf"], "left_semi").select(*columns)
    tree = plan.where("kind = 'child'").select(*columns)
    rows = mine.unionByName(tree.where(F.col("n").isin(counts)) if i else tree).collect()  # as above
    return Seed.of(rules, map(tuple, rows), set(runs[i]), others if i == 0 else None)


@dataclass
class Templates:
    """``assigned``: the kept columns plus ``event_id`` and ``template_at_line``;
    ``catalog``: one row per template; ``metadata``: one row of totals."""

    assigned: DataFrame
    catalog: DataFrame
    metadata: DataFrame


def mine_templates(
    log: DataFrame,
    message: str = "message",
    keep: tuple[str, ...] = ("line_no",),
    depth: int = 4,
    max_children: int = 100,
    similarity: float = 0.4,
    extra_delimiters: str = "_",
    prior: DataFrame | None = None,
    source: str = "",
    plan_tokens: int = PLAN_TOKENS,
    first_lines: int = FIRST_LINES,
) -> Templates:
    """Clusters messages into templates in ``line_no`` order.

    Events are named ``E1, E2, ...`` by the first line of their cluster. With a
    ``prior`` catalog, its clusters and event names carry on. ``plan_tokens`` bounds what
    is broadcast at a time and ``first_lines`` how far step 1 reads; any values
    give the same result.
    """
    require_columns(log, [message, "line_no", *keep], "log")
    spark = log.sparkSession
    ship(spark)
    rules = Rules(depth, max_children, similarity)
    passed = ["line_no", *[c for c in keep if c != "line_no"]]
    # one row per generator input: filters stay above it and do not split the message again
    tokens = F.explode(F.array(message_tokens(F.col(message), extra_delimiters)))
    lines = materialize(log.select(*passed, tokens.alias("_tokens")), "tokens")  # every round reads them

    reported = materialize(_change_lines(lines.where(F.col("line_no") < first_lines), rules), "changes")
    reported = _thin(reported, rules)
    if prior is not None:
        known = prior.select((-F.col("cluster_id")).alias("line_no"), F.col("log_template_tokens").alias("tokens"), "path")
        reported = reported.unionByName(materialize(known, "known"))
    parts, again, front = [], None, {}
    while True:
        replayed = _replayed(reported, rules)
        plan = replayed if again is None else replayed.where(F.col("n").isin(again))
        runs = _runs(plan, again, plan_tokens)
        staged = []
        for i, run in enumerate(runs):
            seed = _seed(plan, rules, runs, i)
            todo = lines
            if again is not None or i:  # the first round's first run takes the token counts without a plan too
                todo = lines.where(F.size("_tokens").isin(again if i == 0 else sorted({n for n, _ in run})))
            staged.append(materialize(_assign(todo, passed, seed), "assigned"))
        staged = reduce(DataFrame.unionByName, staged)
        found = staged.where(F.col("_change").isNotNull()).select("line_no", F.col("_change").alias("tokens"))
        firsts = {r[0]: r[1] for r in found.groupBy(F.size("tokens")).agg(F.min("line_no")).collect()}  # one row per token count
        if any(line <= front.get(n, -1) for n, line in firsts.items()):
            raise RuntimeError("a round of template mining did not move on")
        again, front = sorted(firsts), front | firsts
        if not again:
            parts.append(staged)
            break
        parts.append(staged.where(~F.col("_n").isin(again)))
        reported = reported.unionByName(_thin(found, rules))
    whole = reduce(DataFrame.unionByName, parts).drop("_change")
    events = materialize(_events(replayed.where("kind = 'cluster'"), prior), "events")
    names = broadcast_if_small(events.select(F.col("line_no").alias("_first"), "event_id"))
    assigned = whole.join(names, "_first").select(*keep, "event_id", "template_at_line")
    sizes = materialize(whole.groupBy("_first").agg(F.count("*").alias("_lines")).join(names, "_first"), "sizes")
    metadata = sizes.agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("total_lines"), F.count("*").alias("total_templates")
    ).select(
        F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"),
        F.lit(source).alias("source"),
        "total_lines",
        "total_templates",
    )
    catalog = events.join(sizes.select("event_id", "_lines"), "event_id", "left").select(
        "event_id",
        F.substring("event_id", 2, 20).cast("bigint").alias("cluster_id"),
        (F.col("size") + F.coalesce("_lines", F.lit(0))).alias("size"),
        "template",
        "log_template_tokens",
        "path",
        "first_line",
    )
    return Templates(assigned, catalog, metadata)


def _events(clusters: DataFrame, prior: DataFrame | None) -> DataFrame:
    """Clusters with their event names, numbered by first line after the known ones, and the known ones' sizes."""
    content = [F.col("text").alias("template"), F.col("tokens").alias("log_template_tokens"), "path"]
    last = 0 if prior is None else prior.agg(F.max(F.substring("event_id", 2, 20).cast("bigint"))).first()[0] or 0
    fresh = clusters.where(F.col("line_no") >= 0)
    if fits(fresh, SMALL_ROWS):
        numbered = fresh.withColumn("_number", F.row_number().over(Window.orderBy("line_no")) - 1)
    else:
        numbered = number_rows(fresh, "line_no", name="_number")
    new = numbered.select(
        "line_no",
        F.concat(F.lit("E"), (F.col("_number") + last + 1).cast("string")).alias("event_id"),
        *content,
        F.lit(0).cast("bigint").alias("size"),
        F.col("line_no").alias("first_line"),
    )
    if prior is None:
        return new
    old = prior.select((-F.col("cluster_id")).alias("line_no"), "event_id", "size", "first_line")
    return clusters.join(old, "line_no").select("line_no", "event_id", *content, "size", "first_line").unionByName(new)


def _assign(lines: DataFrame, passed: list[str], seed: Seed) -> DataFrame:
    """Kept columns, cluster, template as of the line, and the tokens of an unplanned change."""
    shared = lines.sparkSession.sparkContext.broadcast((seed.rules._asdict(), seed.known, seed.changes, seed.tree, seed.own, seed.others))
    schema = T.StructType(
        [lines.schema[c] for c in passed]
        + [
            T.StructField("_n", T.IntegerType()),
            T.StructField("_first", T.LongType()),
            T.StructField("template_at_line", T.StringType()),
            T.StructField("_change", T.ArrayType(T.StringType())),
        ]
    )

    def assign(batches):
        rules, *rest = shared.value
        start = Seed(Rules(**rules), *rest)
        for batch, counts, first, text, changed in _assigned(batches, start):
            tokens = batch.column("_tokens")
            change = pa.nulls(len(counts), tokens.type)
            if changed.any():
                change = pc.if_else(pa.array(changed), tokens, pa.scalar(None, tokens.type))
            columns = [batch.column(c) for c in passed] + [pa.array(counts, pa.int32()), pa.array(first, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(text, pa.string()), change], schema.names)

    return lines.mapInArrow(assign, schema)


def with_final_template(assigned: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds the template text the catalog ended with."""
    final = catalog.select("event_id", F.col("template").alias("template_final"))
    return assigned.join(broadcast_if_small(final), "event_id")
