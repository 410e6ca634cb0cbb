"""Source-level rules: explicit broadcasts only where the size is bounded, no driver collects, no UDFs."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parent.parent / "opsmetrics"


def sources():
    """The library without the optional subpackage, whose operators may run numpy inside tasks."""
    return {n: p.read_text() for p in PKG.rglob("*.py") if not (n := p.relative_to(PKG).as_posix()).startswith("llm/")}


def test_nothing_is_broadcast_by_hand():
    for f, s in sources().items():
        assert not re.search(r"\bbroadcast\(", s), f


def test_no_python_udfs_or_rdds():
    for f, s in sources().items():
        assert "udf(" not in s and "pandas_udf" not in s and ".rdd." not in s, f
        assert "localCheckpoint" not in s, f


def test_driver_collects_are_scalars():
    # .first() is used only for single-row aggregates (high-water mark, newest stamp, span of a window table, state of a source table),
    # .collect() only for distinct days or hours of one window or micro-batch.
    first = {"operators/intervals.py": 1, "plans/incremental.py": 1, "plans/committed.py": 1, "sources/testdata.py": 1, "streaming/hourly_time.py": 1}
    collect = {"plans/incremental.py": 1, "plans/late_hours.py": 1, "streaming/hourly_job.py": 1}
    for f, s in sources().items():
        assert ".toPandas()" not in s, f
        assert s.count(".first()") == first.get(f, 0), f
        assert s.count(".collect()") == collect.get(f, 0), f


def test_nothing_else_imports_the_optional_subpackage():
    for f, s in sources().items():
        assert not re.search(r"\bllm\b", s), f
