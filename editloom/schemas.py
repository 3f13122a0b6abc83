"""Record types. Reading with a schema keeps the scan columnar and free of inference; absent fields are null."""

from __future__ import annotations

S = "string"
TEXTS = f"array<{S}>"
COMMIT = f"commit {S}, old_contents {S}, new_contents {S}, message {S}"
ONE_SHOT = f"code_before {S}, instruct_descriptive {S}, instruct_lazy {S}"
PROMPT = f"commit {TEXTS}, system {S}, user {TEXTS}, code_snippet {TEXTS}, commit_message {TEXTS}"
REWRITE = f"commit {S}, system {S}, user {S}, old_code {S}, new_code {S}, commit_message {S}"
#: commit and user may be arrays or text in the files: read as text and normalised
RESPONSE = f"commit {S}, system {S}, user {S}, code_snippet {TEXTS}, commit_message {TEXTS}, response_1 {S}, response_2 {S}, response {TEXTS}, sample_index int"
TRIPLET = f"commit {S}, code_snippet {TEXTS}, code_before {S}, code_after {S}, instruct_descriptive {S}, instruct_lazy {S}"
CLEAN = TRIPLET + f", code_before_purify {S}, code_after_purify {S}, instruct_descriptive_purify {S}, instruct_lazy_purify {S}"
MIX = f"commit {S}, code_snippet {TEXTS}, code_before_purify {S}, code_after_purify {S}, instruct_purify {S}, instr_type {S}"
MESSAGE = f"struct<role:{S},content:{S}>"
CHAT = f"messages array<{MESSAGE}>, commit {S}, instr_type {S}, old_code {S}, new_code {S}"
ALPACA = f"instruction {S}, system {S}, output {S}, commit {S}, instr_type {S}, old_code {S}, new_code {S}"
PROBLEM = f"full_name {S}, before {S}, instruction_descriptive {S}, instruction_lazy {S}, instruction {S}, declaration {S}"
RESULT = (
    f"id int, before {S}, instr_kind {S}, temperature double, taxonomy struct<change_kind:{S}>, "
    f"results array<struct<status:{S},exit_code:int,program_no_test:{S},coverage:double,coverage_missing:array<int>>>"
)
