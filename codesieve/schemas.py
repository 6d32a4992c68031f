"""Declared schemas; nothing is inferred from data."""

LABELLED = "code string, language string, safety string"
FIX_PAIRS = "pair_id bigint, vulnerable_code string, fixed_code string"
TRAIN = "code string, target int"
HARVESTED = "code string, target int, source string"
FINDINGS = "array<struct<line:int,rule_order:int,type:string,severity:string,snippet:string,detail:string>>"
REPORT = f"file_id bigint, path string, language string, verdict string, score double, ml_prob double, findings {FINDINGS}"
GATE = "file string, verdict string, score double"
PROFILE = "part string, language string, n bigint, columns array<string>, code_columns array<string>"
COMMITS = "sha string, message string"
