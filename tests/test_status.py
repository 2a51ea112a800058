"""The status file: sections, the parts of one section, the order of keys."""

import pytest

from tidemark.config import UsageError
from tidemark.plans import report as R

T1, T2, T3 = "2026-10-05T10:00:00.000Z", "2026-10-05T12:00:00.000Z", "2026-10-12T10:00:00.000Z"


def test_sections_are_exchanged_whole_and_in_order():
    one = R.with_section({"moduleLinks": {"a": 1}, "docs": {"x": 1}}, "docs", {"indexUrls": 3}, T1, "7")
    assert list(one) == ["schemaVersion", "docs", "moduleLinks"] and one["docs"] == {"generatedAt": T1, "runId": "7", "indexUrls": 3}
    two = R.with_section(one, "learn", {}, T2)
    assert list(two) == ["schemaVersion", "learn", "docs", "moduleLinks"] and one["docs"] is two["docs"] and "learn" not in one


def test_each_part_keeps_the_others_keys_and_the_oldest_stamp_counts():
    one = R.contributed({}, "catalog", {"removed": 2, "modules": 9, "zeta": 1, "alpha": 2}, T2)
    assert list(one["learn"]) == ["generatedAt", "runId", "modules", "removed", "catalogGeneratedAt", "alpha", "zeta"] and one["learn"]["generatedAt"] == T2
    two = R.contributed(one, "content", {"content": {"exams": 1}}, T3)
    assert two["learn"]["generatedAt"] == T2 and two["learn"]["contentGeneratedAt"] == T3 and two["learn"]["modules"] == 9
    three = R.contributed(two, "catalog", {"modules": 10}, T3)
    assert three["learn"]["generatedAt"] == T3 and three["learn"]["content"] == {"exams": 1}
    assert R.contributed({"learn": {"catalogGeneratedAt": "soon"}}, "content", {}, T1)["learn"]["generatedAt"] == T1
    assert R.contributed({"learn": 3}, "content", {}, T1)["learn"]["generatedAt"] == T1
    with pytest.raises(UsageError):
        R.contributed({}, "docs", {}, T1)


def test_files(spark, tmp_path):
    path = str(tmp_path / "status.json")
    assert R.read_status(spark, path) == {}
    R.write_status(spark, path, R.with_section({}, "docs", {"é": 1}, T1))
    held = R.read_status(spark, path)
    assert held == {"schemaVersion": 1, "docs": {"generatedAt": T1, "runId": None, "é": 1}} and open(path, encoding="utf-8").read().startswith('{\n  "schemaVersion": 1')
    for damaged in ("{", "[1]", ""):
        (tmp_path / "status.json").write_text(damaged)
        (tmp_path / ".status.json.crc").unlink(missing_ok=True)
        assert R.read_status(spark, path) == {}
