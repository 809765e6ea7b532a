"""The registered queries as plain SQL over the same tables, for the result check."""

from __future__ import annotations

from logblocks.plans.logview import lines_sql

_LOG = lines_sql("strftime(ts,'%y%m%d %H%M%S')", "events")

_BASE = (
    ("log", _LOG),
    ("parts", "select line_no, line, list_filter(string_split(line,' '), lambda x: x <> '') as p from log"),
    (
        "typed",
        """select *, epoch(try_strptime(concat(p[1],' ',p[2]), '%y%m%d %H%M%S'))::bigint as epoch,
           try_cast(p[3] as integer) as pid from parts""",
    ),
    (
        "judged",
        """select *, case when len(p) < 5 then 'too few parts' when epoch is null then 'timestamp'
           when pid is null then 'pid' end as reason from typed""",
    ),
    (
        "parsed",
        """select line_no, epoch as "timestamp", pid,
           case when p[4] in ('INFO','WARN') then p[4] else 'UNKNOWN' end as severity,
           regexp_replace(p[5], ':$', '') as component, array_to_string(p[6:], ' ') as message
           from judged where reason is null""",
    ),
    (
        "kinds",
        """select p.*, case when e.event_id % 53 = 0 then 'heartbeat' else e.event_type end as kind,
           nullif(regexp_extract(p.message, '(blk_[0-9\\-]+)', 1), '') as block_id
           from parsed p join events e on e.event_id = p.line_no""",
    ),
    (
        "names",
        """select kind, first_kind_line, row_number() over (order by first_kind_line) as number
           from (select kind, min(line_no) as first_kind_line from kinds group by kind)""",
    ),
    ("mined", "select k.*, 'E' || n.number as event_id from kinds k join names n using (kind)"),
    ("refs", "select block_id, line_no, event_id, severity from mined where block_id is not null"),
    (
        "positions",
        """select line_no, kind, unnest(t) as tok, generate_subscripts(t, 1) as pos
           from (select line_no, kind, string_split(replace(message, '_', ' '), ' ') as t from kinds)""",
    ),
    (
        "at_line",
        """select line_no, string_agg(tok, ' ' order by pos) as template_at_line from (
           select line_no, pos, case when min(tok) over w = max(tok) over w then tok else '<*>' end as tok
           from positions window w as (partition by kind, pos order by line_no)) group by line_no""",
    ),
    (
        "finals",
        """select kind, string_agg(tok, ' ' order by pos) as template_final from (
           select kind, pos, case when min(tok) = max(tok) then min(tok) else '<*>' end as tok
           from positions group by kind, pos) group by kind""",
    ),
    (
        "totals",
        """select block_id, count(*) as n_events, min(line_no) as first_line,
           sum(case when severity = 'WARN' then 1 else 0 end) as warns from refs group by block_id""",
    ),
    (
        "known",
        """select first_line * 2 as label_row, block_id as "BlockId", case when warns * 2 > n_events then 1 else 0 end as label
           from totals where (abs(regexp_extract(block_id, '(-?[0-9]+)$', 1)::bigint) // 1000) % 10 <> 9""",
    ),
    (
        "labels_",
        """select * from known union all
           select label_row + 1, "BlockId", 1 from known where label_row % 1000 = 0 union all
           select max(label_row) + 2, 'blk_0', 1 from known""",
    ),
    (
        "first_labels",
        """select "BlockId" as block_id, min(label_row) as label_row, arg_min(label, label_row) as label
           from labels_ group by "BlockId" """,
    ),
    ("labelled", "select l.block_id, l.label_row, l.label, t.n_events, t.first_line, t.warns from first_labels l join totals t using (block_id)"),
    ("sequences", "select block_id, count(*) as n_events, min(line_no) as first_line, string_agg(event_id, ' ' order by line_no) as events from refs group by block_id"),
    ("vocab", "select event_id as event, row_number() over (order by event_id) - 1 as idx from (select distinct event_id from refs)"),
    ("info_vocab", "select distinct event_id from refs where severity = 'INFO'"),
    ("counts", "select block_id, event_id, count(*) as cnt from refs group by block_id, event_id"),
    (
        "ranked_split",
        """select block_id, label, row_number() over (partition by label order by md5('42:' || block_id), block_id) as rn from labelled""",
    ),
    (
        "split_sizes",
        """select label, n_train, (n_c * n_train) // n as base, row_number() over (order by (n_c * n_train) % n desc, label) as turn
           from (select label, n_c, n, n - ceil(0.3::double * n)::bigint as n_train from
             (select label, count(*) as n_c, (sum(count(*)) over ())::bigint as n from labelled group by label))""",
    ),
    (
        "split",
        """select block_id, label, rn > base + case when turn <= spare then 1 else 0 end as is_test from ranked_split
           join (select *, n_train - (sum(base) over ()) as spare from split_sizes) using (label)""",
    ),
    (
        "ranked_cal",
        """select block_id, label, row_number() over (partition by label order by md5('43:' || block_id), block_id) as rn
           from split where not is_test""",
    ),
    (
        "cal_sizes",
        """select label, n_train, (n_c * n_train) // n as base, row_number() over (order by (n_c * n_train) % n desc, label) as turn
           from (select label, n_c, n, n - ceil(0.2::double * n)::bigint as n_train from
             (select label, count(*) as n_c, (sum(count(*)) over ())::bigint as n from ranked_cal group by label))""",
    ),
    (
        "cal",
        """select block_id, case when rn > base + case when turn <= spare then 1 else 0 end then 'calibration' else 'fit' end as part
           from ranked_cal join (select *, n_train - (sum(base) over ()) as spare from cal_sizes) using (label)""",
    ),
    ("scores", "select block_id, first_line as row_idx, 1 - warns / n_events as anomaly_score, label from labelled"),
    ("by_score", "select anomaly_score as score, sum(label) as pos, count(*) as n from scores group by 1"),
    (
        "curve",
        """select score, tp, n_flagged, tp / n_flagged as "precision", case when p > 0 then tp / p else 1.0 end as recall from (
           select score, (sum(pos) over w)::bigint as tp, (sum(n) over w)::bigint as n_flagged, (sum(pos) over ())::bigint as p
           from by_score window w as (order by score rows unbounded preceding))""",
    ),
    (
        "up_curve",
        """select score, tp, n_flagged, tp / n_flagged as "precision", case when p > 0 then tp / p else 1.0 end as recall from (
           select score, (sum(pos) over w)::bigint as tp, (sum(n) over w)::bigint as n_flagged, (sum(pos) over ())::bigint as p
           from (select 1 - anomaly_score as score, sum(label) as pos, count(*) as n from scores group by 1)
           window w as (order by score desc rows unbounded preceding))""",
    ),
    (
        "rated",
        """select *, 5.0::double * "precision" * recall / greatest(4.0::double * "precision" + recall, 1e-12::double) as f_beta,
           2.0::double * "precision" * recall / greatest(1.0::double * "precision" + recall, 1e-12::double) as f1 from curve""",
    ),
    (
        "threshold",
        """select 'isolation-forest' as algorithm, score as score_threshold, 'lower' as score_direction, "precision", recall, f1, f_beta,
           (select count(*) from scores) as calibration_size, 2.0::double as calibration_beta, 0.75::double as min_calibration_precision
           from rated order by ("precision" >= 0.75::double) desc, f_beta desc, n_flagged desc limit 1""",
    ),
    (
        "preds",
        """select s.block_id, s.row_idx, s.label, case when s.anomaly_score < t.score_threshold then 1 else 0 end as prediction,
           s.anomaly_score, t.score_threshold as decision_threshold, t.score_direction, t.algorithm from scores s, threshold t""",
    ),
    (
        "cells",
        """select coalesce(sum(case when prediction = 1 and label = 1 then 1 else 0 end),0)::bigint as true_positives,
           coalesce(sum(case when prediction = 1 and label = 0 then 1 else 0 end),0)::bigint as false_positives,
           coalesce(sum(case when prediction = 0 and label = 0 then 1 else 0 end),0)::bigint as true_negatives,
           coalesce(sum(case when prediction = 0 and label = 1 then 1 else 0 end),0)::bigint as false_negatives from preds""",
    ),
    (
        "label_counts",
        """select count(*) as total_sequences, sum(case when label = 0 then 1 else 0 end)::bigint as labeled_normals,
           sum(case when label = 1 then 1 else 0 end)::bigint as labeled_anomalies from labelled""",
    ),
    (
        "flag_counts",
        "select count(*) as total_predictions, sum(case when prediction = 1 then 1 else 0 end)::bigint as anomalies_flagged from preds",
    ),
    (
        "confusion",
        """select *, case when true_positives + false_positives > 0 then true_positives / (true_positives + false_positives) end as "precision",
           case when true_positives + false_negatives > 0 then true_positives / (true_positives + false_negatives) end as recall,
           case when true_positives + false_positives > 0 and true_positives + false_negatives > 0
             then 2 * true_positives / (2 * true_positives + false_positives + false_negatives) end as f1 from cells""",
    ),
    (
        "ranked",
        """select row_number() over (order by severity desc, row_idx) as rank, block_id, severity from (
           select block_id, row_idx, case when anomaly_score = 0 and decision_threshold = 0 then 0.0::double
             else decision_threshold - anomaly_score end as severity from preds where prediction = 1)""",
    ),
    ("mentions", "select distinct line_no, line, unnest(regexp_extract_all(line, '(blk_[0-9\\-]+)', 1)) as block_id from log"),
    (
        "excerpts",
        """select block_id, row_number() over (partition by block_id order by line_no) as line_rank, line_no, line
           from mentions where block_id in (select block_id from preds where prediction = 1)""",
    ),
    (
        "body",
        """select rank as section, -1 as line_no, 'Block ' || rank || ': ' || block_id as text from ranked where rank <= 20
           union all select r.rank, coalesce(e.line_no, 0), coalesce('  • ' || e.line, '(No log lines found for this block)')
           from ranked r left join (select * from excerpts where line_rank <= 5) e using (block_id) where r.rank <= 20
           union all select rank, 4611686018427387904, '' from ranked where rank <= 20""",
    ),
    (
        "prompt",
        """select 'You are an on-call assistant.' || chr(10) || chr(10)
           || 'Analyze the following anomalous Hadoop Distributed File System (HDFS) blocks and provide a concise '
           || 'incident-oriented summary for an on-call site reliability engineer. Highlight root causes, impacted '
           || 'components, and any remediation suggestions.' || chr(10) || chr(10)
           || string_agg(text, chr(10) order by section, line_no) || chr(10)
           || 'Summarize the most critical issues, probable causes, and recommended next steps.' || chr(10) as prompt from body""",
    ),
    (
        "report_row",
        """select *, case when p is not null and r is not null and p + r > 0 then round(2 * p * r / (p + r), 4) end as f from (
           select *, case when true_positives + false_positives > 0 then round(true_positives / (true_positives + false_positives), 4) end as p,
             case when true_positives + false_negatives > 0 then round(true_positives / (true_positives + false_negatives), 4) end as r
           from cells)""",
    ),
    ("seen", "select distinct event_id from refs where block_id in (select block_id from labelled)"),
    (
        "info_check",
        """select *, case when abs(o - v) / v > 0.25::double
             then format('Observed event count {} deviates from vocab size {} by {:.2f}%', o, v, 100 * abs(o - v) / v) end as drifted,
           case when u > 0 then format('Encountered {} events not present in vocabulary (samples: [''{}''])', u, s) end as missed
           from (select name, count(*) as o, (select count(*) from info_vocab) as v, count(*) filter (i is null) as u,
             string_agg(event_id, ''', ''' order by event_id) filter (i is null) as s
             from (select 'all' as name, event as event_id from vocab union all select 'labelled', event_id from seen) x
             left join (select event_id as i from info_vocab) k on k.i = x.event_id group by name)""",
    ),
    (
        "vocab_check",
        """select o, v, u, abs(o - v) / v as drift, case when abs(o - v) / v > 0.25::double or u > 0 then 'fail' else 'ok' end as status
           from (select (select count(*) from seen) as o, (select count(*) from vocab) as v,
             (select count(*) from seen where event_id not in (select event from vocab)) as u)""",
    ),
    (
        "per_class",
        """select c.cls, c.class, coalesce(sum(case when label = cls and prediction = cls then 1 else 0 end),0)::bigint as tp,
           coalesce(sum(case when prediction = cls then 1 else 0 end),0)::bigint as predicted,
           coalesce(sum(case when label = cls then 1 else 0 end),0)::bigint as support
           from preds, (values (0,'Normal'),(1,'Anomaly')) c(cls, class) group by c.cls, c.class""",
    ),
    (
        "class_rows",
        """select cls, class, case when predicted > 0 then tp / predicted else 0.0::double end as "precision",
           case when support > 0 then tp / support else 0.0::double end as recall,
           case when predicted + support > 0 then 2 * tp / (predicted + support) else 0.0::double end as f1, tp, support from per_class""",
    ),
    ("n", "select * from class_rows where cls = 0"),
    ("a", "select * from class_rows where cls = 1"),
)


# The isolation forest of the labelled blocks, all trees of it. Draws are SplitMix64 of (seed, tree, node).
_TREES, _SEED, _SHARE, _WORD = 100, 42, 0.75, 1 << 64


def _mixed(value: str) -> str:
    """SplitMix64 of a number below 2^64, as SQL; the list only names each step's result."""
    text = f"[(({value})::uhugeint + 11400714819323198485::uhugeint) % {_WORD}::uhugeint]"
    for shift, factor in ((30, 13787848793156543929), (27, 10723151780598845931), (31, 1)):
        text = f"list_transform({text}, lambda v: (xor(v, v // {1 << shift}::uhugeint) * {factor}::uhugeint) % {_WORD}::uhugeint)"
    return f"({text})[1]"


def _draw(stream: int, tree: str, item: str) -> str:
    """A number in [0, 1) per (tree, item)."""
    start = _mixed(f"xor(({tree})::uhugeint, {_mixed(str(_SEED * 16 + stream))})")
    return f"(({_mixed(f'xor({start}, {_mixed(item)})')} // 2048::uhugeint)::double / {1 << 53}::double)"


_PATH = "case when s <= 1 then 0.0::double when s <= 2 then 1.0::double else 2.0::double * (ln(s - 1) + 0.5772156649::double) - 2.0::double * (s - 1) / s end"

_FOREST = (
    (
        "block_vecs",
        """select block_id, string_agg(idx || ':' || cnt, ' ' order by idx) as vec from counts join vocab on event = event_id
           where block_id in (select block_id from labelled) group by block_id""",
    ),
    ("vecs", "select vec, count(*) filter (part = 'fit') as weight, row_number() over (order by vec) as v from block_vecs left join cal using (block_id) group by vec"),
    ("forest_size", "select sum(weight)::double as s, ceil(log2(greatest(sum(weight), 2)))::bigint as depth_limit from vecs"),
    (
        "forest_cells",
        """select v, weight, idx as feature, coalesce(list_filter(string_split(vec, ' '), lambda e: starts_with(e, idx || ':'))[1], '0:0') as cell
           from vecs, vocab""",
    ),
    ("vals", "select v, weight, feature, string_split(cell, ':')[2]::double as value from forest_cells"),
    (
        "allowed",
        f"""select tree, feature from (select tree, feature, row_number() over (partition by tree order by u, feature) as place
           from (select tree, idx as feature, {_draw(0, 'tree', 'idx')} as u from range({_TREES}) t(tree), vocab))
           where place <= greatest(1, floor({_SHARE}::double * (select count(*) from vocab)))""",
    ),
    (
        "walk",
        f"""select tree, 1::bigint as node, v, 0::bigint as depth from range({_TREES}) t(tree), vecs
           union all
           select w.tree, 2 * w.node + (x.value > c.cut)::bigint, w.v, w.depth + 1
           from walk w join (
             select tree, node, r[p].feature as feature, case when r[p].low + u * (r[p].high - r[p].low) >= r[p].high then r[p].low
               else r[p].low + u * (r[p].high - r[p].low) end as cut
             from (select tree, node, r, least(floor({_draw(1, 'tree', 'node')} * len(r))::bigint, len(r) - 1) + 1 as p, {_draw(2, 'tree', 'node')} as u
               from (select tree, node, list({{'feature': feature, 'low': low, 'high': high}} order by feature) as r
                 from (select w.tree, w.node, a.feature, min(x.value) as low, max(x.value) as high
                   from walk w join allowed a on a.tree = w.tree join vals x on x.v = w.v and x.feature = a.feature
                   where x.weight > 0 and w.depth < (select depth_limit from forest_size)
                   group by w.tree, w.node, a.feature having min(x.value) < max(x.value))
                 group by tree, node))
           ) c on c.tree = w.tree and c.node = w.node join vals x on x.v = w.v and x.feature = c.feature""",
    ),
    ("node_sizes", "select tree, node, sum(weight) as s from walk join vecs using (v) group by tree, node"),
    ("ends", "select tree, v, max(node) as node, max(depth) as depth from walk group by tree, v"),
    ("paths", f"select v, sum(depth + {_PATH}) as path from ends join node_sizes using (tree, node) group by v"),
    ("raw", f"select v, weight, -pow(2.0::double, -path / ({_TREES} * (select {_PATH} from forest_size))) as score from paths join vecs using (v)"),
    (
        "forest_cut",
        """select a + (b - a) * (place - floor(place)) as cut from (
           select place, min(score) filter (upto > floor(place)) as a, min(score) filter (upto > ceil(place)) as b
           from (select score, sum(weight) over (order by score) as upto from raw where weight > 0),
             (select greatest(sum(label) / count(*), 1e-6::double) * (count(*) - 1) as place
              from labelled join cal using (block_id) where part = 'fit') group by place)""",
    ),
    (
        "forest_scores",
        """select block_id, label, is_test, first_line, score - cut as anomaly_score
           from block_vecs join (select vec, v from vecs) using (vec) join (select v, score from raw) using (v) join split using (block_id)
           join (select block_id, first_line from labelled) using (block_id), forest_cut""",
    ),
    (
        "forest_curve",
        """select score, (sum(pos) over w)::bigint as tp, (sum(n) over w)::bigint as n_flagged, (sum(pos) over ())::bigint as p from (
           select anomaly_score as score, sum(label) as pos, count(*) as n from forest_scores join cal using (block_id)
           where part = 'calibration' group by 1) window w as (order by score rows unbounded preceding)""",
    ),
    (
        "forest_threshold",
        """select score as decision_threshold from (select score, n_flagged, tp / n_flagged as "precision", case when p > 0 then tp / p else 1.0 end as recall
           from forest_curve)
           order by ("precision" >= 0.75::double) desc,
             5.0::double * "precision" * recall / greatest(4.0::double * "precision" + recall, 1e-12::double) desc, n_flagged desc limit 1""",
    ),
    (
        "forest_preds",
        """select *, case when anomaly_score < decision_threshold then 1 else 0 end as prediction from forest_scores, forest_threshold""",
    ),
    (
        "forest_per_class",
        """select c.cls, c.class, count(*) filter (label = cls and prediction = cls) as tp, count(*) filter (prediction = cls) as predicted,
           count(*) filter (label = cls) as support
           from (select label, prediction from forest_preds where is_test), (values (0,'Normal'),(1,'Anomaly')) c(cls, class) group by c.cls, c.class""",
    ),
    (
        "forest_class_rows",
        """select cls, class, case when predicted > 0 then tp / predicted else 0.0::double end as "precision",
           case when support > 0 then tp / support else 0.0::double end as recall,
           case when predicted + support > 0 then 2 * tp / (predicted + support) else 0.0::double end as f1, tp, support from forest_per_class""",
    ),
    (
        "forest_sums",
        """select sum(support)::bigint as total, sum(tp) / sum(support) as hit, avg("precision") as mp, avg(recall) as mr, avg(f1) as mf,
           sum("precision" * support) / sum(support) as wp, sum(recall * support) / sum(support) as wr, sum(f1 * support) / sum(support) as wf
           from forest_class_rows""",
    ),
)


def _with(select: str, more: tuple = ()) -> str:
    parts = [f"{name} as ({body})" for name, body in _BASE + more]
    return f"with {'recursive ' if more else ''}" + ",\n".join(parts) + "\n" + select


_THRESHOLD = "select * from threshold"

_SELECTS = {
    "raw_line_scan": "select line_no, line from log",
    "parsed_csv_scan": 'select row_number() over (order by line_no) - 1 as line_no, "timestamp", pid, severity, component, message from parsed',
    "label_scan": 'select row_number() over (order by label_row) - 1 as label_row, "BlockId", label from labels_',
    "flagged_prediction_scan": "select block_id, prediction, anomaly_score, decision_threshold, score_direction from preds where prediction = 1",
    "vocabulary_scan": "select event, idx from vocab",
    "threshold_scan": _THRESHOLD,
    "parse_log_lines": "select * from parsed",
    "rejected_lines": "select line_no, line, reason from judged where reason is not null",
    "rejected_lines_by_reason": "select reason, count(*) as lines from judged where reason is not null group by reason",
    "block_first_reference": "select line_no, block_id from kinds where block_id is not null",
    "block_all_references": "select line_no, block_id from mentions",
    "messages_without_block": "select count(*) as messages, sum(case when block_id is null then 1 else 0 end)::bigint as without_block from kinds",
    "template_assignment": "select line_no, event_id, template_at_line, template_final from mined join at_line using (line_no) join finals using (kind)",
    "template_catalog": """select 'E' || number as event_id, number as cluster_id, size, template_final as template,
        template_final as log_template_tokens from names join finals using (kind) join (select kind, count(*) as size from kinds group by kind) using (kind)""",
    "template_metadata": "select count(*) as total_lines, count(distinct kind) as total_templates from kinds",
    "template_resume": "select line_no, event_id from mined",
    "block_sequences": "select block_id, first_line, n_events, events from sequences",
    "ordered_events": "select block_id, row_number() over (partition by block_id order by line_no) - 1 as pos, line_no, event_id from refs",
    "labelled_sequences": "select label_row, block_id, events, label from sequences join first_labels using (block_id)",
    "missing_labelled_blocks": """select label_row, "BlockId" as block_id from labels_ where label_row not in (select label_row from labelled)""",
    "unused_blocks": 'select block_id, n_events, first_line from totals where block_id not in (select "BlockId" from labels_)',
    "block_index": 'select row_number() over (order by label_row) - 1 as "Index", block_id as "BlockId", label as "Label" from labelled',
    "unlabelled_block_index": 'select row_number() over (order by first_line) - 1 as "Index", block_id as "BlockId" from totals',
    "event_vocabulary": "select event, idx from vocab",
    "train_vocabulary": """select event_id as event, row_number() over (order by event_id) - 1 as idx from (
        select distinct event_id from refs where block_id in (select block_id from split where not is_test))""",
    "event_counts_long": "select block_id, idx, cnt from counts join vocab on event = event_id",
    "event_count_vectors": """select block_id, string_agg(idx::varchar, ' ' order by idx) as idxs, string_agg(cnt::varchar, ' ' order by idx) as cnts
        from counts join vocab on event = event_id group by block_id""",
    "unseen_events": "select distinct event_id from refs where event_id not in (select event_id from info_vocab)",
    "matrix_shape": "select (select count(*) from totals) as blocks, (select count(*) from vocab) as features",
    "run_counters": """select (select count(*) from kinds) as messages, (select count(*) from judged where reason is not null) as rejected,
        (select count(*) from kinds where block_id is null) as without_block,
        (select count(*) from labels_ where label_row not in (select label_row from labelled)) as missing_blocks,
        (select count(*) from labelled) as blocks, (select sum(label) from labelled)::bigint as anomalies,
        (select sum(n_events) from labelled)::bigint as events, (select count(*) from vocab) as features""",
    "label_stats": "select * from label_counts",
    "contamination": "select greatest(sum(label) / count(label), 1e-6::double) as contamination from labelled",
    "stratified_split": "select block_id, label, is_test from split",
    "calibration_split": "select block_id, part from cal",
    "threshold_curve": "select * from curve",
    "calibrate_threshold": _THRESHOLD,
    "calibrate_threshold_higher": """select 'random-forest' as algorithm, score as score_threshold, 'higher' as score_direction, "precision", recall,
        f as f1, f as f_beta, (select count(*) from scores) as calibration_size, 1.0::double as calibration_beta, null::double as min_calibration_precision
        from (select *, 2.0::double * "precision" * recall / greatest(1.0::double * "precision" + recall, 1e-12::double) as f from up_curve)
        order by f desc, n_flagged desc limit 1""",
    "apply_threshold": "select block_id, prediction, anomaly_score, decision_threshold, score_direction, algorithm from preds",
    "default_threshold": """select block_id, case when anomaly_score >= 0.5::double then 1 else 0 end as prediction, 0.5::double as decision_threshold,
        'higher' as score_direction, 'random-forest' as algorithm from scores""",
    "confusion_metrics": "select * from confusion",
    "classification_report": """select class, "precision", recall, f1, support from class_rows
        union all select 'accuracy', (n.tp + a.tp) / (n.support + a.support), (n.tp + a.tp) / (n.support + a.support),
          (n.tp + a.tp) / (n.support + a.support), n.support + a.support from n, a
        union all select 'macro avg', (n."precision" + a."precision") / 2, (n.recall + a.recall) / 2, (n.f1 + a.f1) / 2, n.support + a.support from n, a
        union all select 'weighted avg', (n."precision" * n.support + a."precision" * a.support) / (n.support + a.support),
          (n.recall * n.support + a.recall * a.support) / (n.support + a.support),
          (n.f1 * n.support + a.f1 * a.support) / (n.support + a.support), n.support + a.support from n, a""",
    "prediction_stats": "select * from flag_counts",
    "top_k_anomalies": "select block_id, anomaly_score, prediction from preds where prediction = 1 order by anomaly_score, block_id limit 5",
    "rank_by_severity": "select rank, block_id, severity from ranked where rank <= 20",
    "rank_every_anomaly": "select rank, block_id, severity from ranked",
    "block_excerpts": """select block_id, line_rank, line_no, line from excerpts where line_rank <= 5
        and block_id in (select block_id from ranked where rank <= 20)""",
    "block_excerpts_unlimited": "select block_id, line_rank, line_no, line from excerpts",
    "incident_prompt_rows": "select section, line_no, text from body",
    "incident_prompt": "select prompt from prompt",
    "summarize_static": "select (length(prompt) - length(replace(prompt, chr(10), ''))) || ' lines' as summary from prompt",
    "guardrail_sequences": """select 'npz_schema' as name, case when n = 0 then 'fail' else 'ok' end as status,
        case when n = 0 then 'x_data is empty' else '' end as issues,
        '{"num_sequences":' || n || ',"has_labels":true,"issues":[' || case when n = 0 then '"x_data is empty"' else '' end || ']}' as details
        from (select count(*) as n from sequences join first_labels using (block_id))""",
    "guardrail_index": """select 'block_index' as name, case when issue = '' then 'ok' else 'fail' end as status, issue as issues,
        '{"path":"index","rows":' || n || ',"issues":[' || case when issue = '' then '' else '"' || issue || '"' end || ']}' as details
        from (select n, case when n <> m then 'Block index row count ' || n || ' does not match expected ' || m else '' end as issue
          from (select (select count(*) from labelled) as n, (select count(*) from totals) as m))""",
    "guardrail_vocabulary": """select 'vocabulary' as name, case when coalesce(drifted, missed) is null then 'ok' else 'fail' end as status,
        concat_ws('; ', drifted, missed) as issues,
        '{"vocab_size":' || v || ',"observed_event_count":' || o || ',"drift":' || (abs(o - v) / v) || ',"unknown_event_count":' || u
          || case when coalesce(drifted, missed) is null then '' else ',"issues":["' || concat_ws('","', drifted, missed) || '"]' end || '}' as details
        from info_check where name = 'all'""",
    "observed_events": "select count(distinct event_id) as observed_events from refs where block_id in (select block_id from labelled)",
    "run_counts": "select * from label_counts, flag_counts, confusion",
    "run_summary": """select l.*, f.*, 'lower' as score_direction,
        (select block_id from preds where prediction = 1 order by anomaly_score, block_id limit 1) as top_block,
        c.true_positives, c.false_positives, c.true_negatives, c.false_negatives, c.p as "precision", c.r as recall, c.f as f1,
        case when l.total_sequences > 0 then 'ok' else 'fail' end as npz_schema, l.total_sequences as num_sequences, true as has_labels,
        'ok' as block_index, 'index' as "path", l.total_sequences as "rows", v.status as vocabulary, v.v as vocab_size, v.o as observed_event_count,
        v.drift, v.u as unknown_event_count from label_counts l, flag_counts f, report_row c, vocab_check v""",
    "failed_run": """select status, case when status = 'fail' then error end as error, case when status = 'fail' then error end as raised,
        status as guardrails_status
        from (select case when coalesce(drifted, missed) is null then 'ok' else 'fail' end as status,
          'Guardrail checks failed: vocabulary: [' || concat_ws(', ', chr(39) || drifted || chr(39), chr(34) || missed || chr(34)) || ']' as error
          from info_check where name = 'labelled')""",
    "metrics_history_row": """select 'sequences' as data_csv, 'predictions' as predictions_csv, 'isolation-forest' as algorithm,
        c.true_positives, c.false_positives, c.true_negatives, c.false_negatives, c.p as "precision", c.r as recall, c.f as f1,
        f.anomalies_flagged, l.*, case when l.total_sequences > 0 then round(l.labeled_anomalies / l.total_sequences, 6) end as contamination,
        v.status as guardrails_status from label_counts l, flag_counts f, report_row c, vocab_check v""",
    "structured_scan": "select line_no, message, event_id from mined",
    "sequence_scan": """select row_number() over (order by label_row) - 1 as row_idx, block_id, events, label
        from sequences join first_labels using (block_id)""",
    "sequence_id_scan": """select 'sequence_' || (row_number() over (order by label_row) - 1) as "SequenceId", events
        from sequences join first_labels using (block_id)""",
    "block_index_scan": 'select row_number() over (order by label_row) - 1 as "Index", block_id as "BlockId", label as "Label" from labelled',
    "prediction_scan": 'select block_id as "BlockId", prediction, anomaly_score, decision_threshold, score_direction, algorithm from preds',
    "catalog_metadata_scan": """select 'events.parquet' as source, count(*) as total_lines, count(distinct kind) as total_templates,
        true as dated from kinds""",
    "prompt_file_scan": """select line_no - 1 as line_no, line from (select generate_subscripts(t, 1) as line_no, unnest(t) as line
        from (select string_split(rtrim(prompt, chr(10)), chr(10)) as t from prompt))""",
    "summary_file_scan": "select 0::bigint as line_no, (length(prompt) - length(replace(prompt, chr(10), ''))) || ' lines' as line from prompt",
    "default_cut_forest": """select block_id, case when anomaly_score - 0.5::double < 0 then 1 else 0 end as prediction, anomaly_score - 0.5::double as anomaly_score,
        0.0::double as decision_threshold, 'lower' as score_direction, 'isolation-forest' as algorithm from scores""",
    "forest_round_trip": "select block_id, true as same_score from labelled",
    "rforest_round_trip": "select block_id, true as same_score from labelled",
}


_FOREST_SELECTS = {
    "iforest_scores": """select block_id, label, is_test, round(anomaly_score, 9) + 0.0::double as anomaly_score,
        case when anomaly_score < 0 then -1 else 1 end as if_class, case when anomaly_score < 0 then 1 else 0 end as native_prediction from forest_scores""",
    "iforest_predictions": """select block_id, prediction, round(anomaly_score, 9) + 0.0::double as anomaly_score,
        round(decision_threshold, 9) + 0.0::double as decision_threshold, 'lower' as score_direction, 'isolation-forest' as algorithm from forest_preds""",
    "iforest_scores_on_jvm": """select block_id, label, is_test, round(anomaly_score, 9) + 0.0::double as anomaly_score,
        case when anomaly_score < 0 then -1 else 1 end as if_class, case when anomaly_score < 0 then 1 else 0 end as native_prediction from forest_scores""",
    "pipeline_predictions": """select block_id, prediction, round(anomaly_score, 9) + 0.0::double as anomaly_score,
        round(decision_threshold, 9) + 0.0::double as decision_threshold, 'lower' as score_direction, 'isolation-forest' as algorithm from forest_preds""",
    "grid_folds": "select block_id, cast(ntile(3) over (order by block_id) - 1 as integer) as fold from split where not is_test",
    "input_checks": """select 'features match the vocabulary' as "check", count(*) as looked_at, true as accepted from vocab
        union all select 'one feature too many', count(*) + 1, false from vocab
        union all select 'default calibration', 2, true
        union all select 'beta of zero', 0, false
        union all select 'precision floor of one', 1, false
        union all select 'predictions have their columns', count(*), true from labelled
        union all select 'predictions lack a column', count(*), false from labelled
        union all select 'random forest without consent', count(*), false from labelled""",
    "iforest_test_report": """select class, round("precision", 9) as "precision", round(recall, 9) as recall, round(f1, 9) as f1, support from (
        select class, "precision", recall, f1, support from forest_class_rows
        union all select 'accuracy', hit, hit, hit, total from forest_sums
        union all select 'macro avg', mp, mr, mf, total from forest_sums
        union all select 'weighted avg', wp, wr, wf, total from forest_sums)""",
    "detected_incidents": """select rank, block_id, severity, anomaly_score, line_rank, line from (
        select row_number() over (order by decision_threshold - anomaly_score desc, first_line) as rank, block_id,
          round(decision_threshold - anomaly_score, 9) + 0.0::double as severity, round(anomaly_score, 9) + 0.0::double as anomaly_score
        from forest_preds where prediction = 1) left join (
        select block_id, row_number() over (partition by block_id order by line_no) as line_rank, line from mentions
        where block_id in (select block_id from forest_preds where prediction = 1)) using (block_id)
        where rank <= 20 and coalesce(line_rank, 0) <= 5""",
}


def statements() -> dict[str, str]:
    """SQL per query; queries without a twin are checked against brute force in the tests."""
    plain = {name: _with(select) for name, select in _SELECTS.items()}
    return plain | {name: _with(select, _FOREST) for name, select in _FOREST_SELECTS.items()}
