"""Line diffs. difflib's matching is neither a longest common subsequence nor expressible in SQL, so it runs in Arrow batches."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("added", "removed", "modified", "hunk_num", "diff_hunk_num")])


def stats(old: str, new: str, context: int = 3) -> tuple[int, int, int, int, int]:
    """Lines added, removed and modified; runs of changes with at most 2 * context equal lines between them; hunk headers."""
    a, b = old.splitlines(), new.splitlines()
    matcher = difflib.SequenceMatcher(None, a, b)
    codes = matcher.get_opcodes()
    count = {"insert": 0, "delete": 0, "replace": 0}
    hunks, is_open = 0, False
    for tag, i, j, k, m in codes:
        if tag == "equal":
            if j - i > 2 * context:
                is_open = False
                continue
        else:
            count[tag] += max(j - i, m - k)
        hunks += not is_open
        is_open = True
    headers = sum(1 for _ in matcher.get_grouped_opcodes(context))  # a header each in the unified form
    return count["insert"], count["delete"], count["replace"], hunks, headers


def pairs(old: pa.Array, new: pa.Array) -> Iterator[tuple[str, str]]:
    """Null as empty. Beside its Arrow batch a worker holds one pair of texts as Python strings, not those of the batch."""
    for a, b in zip(old, new, strict=True):
        yield a.as_py() or "", b.as_py() or ""


@F.arrow_udf(STATS)
def diff_stats(old: pa.Array, new: pa.Array) -> pa.Array:
    rows = [stats(a, b) for a, b in pairs(old, new)]
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int32()) for k in range(len(STATS))], STATS.names)


@F.arrow_udf(T.StringType())
def unified_diff(old: pa.Array, new: pa.Array) -> pa.Array:
    return pa.array(["\n".join(difflib.unified_diff(a.splitlines(), b.splitlines(), lineterm="")) for a, b in pairs(old, new)], pa.string())


@F.arrow_udf(T.LongType())
def differ_lines(old: pa.Array, new: pa.Array) -> pa.Array:
    """Lines of the full comparison, common and hint lines included."""
    return pa.array([sum(1 for _ in difflib.Differ().compare(a.splitlines(), b.splitlines())) for a, b in pairs(old, new)], pa.int64())
