"""Schemas of the tables that pass between the stages."""

PARSED = "timestamp long, pid int, severity string, component string, message string"
THRESHOLD = (
    "algorithm string, score_threshold double, score_direction string, "
    "calibration_metrics struct<precision: double, recall: double, f1: double, f_beta: double>, "
    "calibration_size long, calibration_beta double, min_calibration_precision double"
)
STRUCTURED = "line_no long, " + PARSED + ", event_id string, template_at_line string"
SEQUENCES = "row_idx long, block_id string, events array<string>, label int"
