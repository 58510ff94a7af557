"""Landed records of several schema versions."""

import json

from conftest import rows

from martwright.sources.evolution import read_evolving

DDL = "id bigint, name string, amount double, price decimal(8,2), day date, tags array<string>, seen boolean"


def land(folder, name, records):
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def test_rules_by_file(spark, tmp_path):
    full = {"id": 1, "name": "a", "amount": 1.5, "price": 2.25, "day": "2024-01-31", "tags": ["x"], "seen": True}
    land(tmp_path, "1.json", [full, {**full, "id": 2, "name": None, "amount": 3}, "", "{broken", "[1]", "null"])
    land(tmp_path, "2.json", [{**full, "id": 3, "extra": {"k": 1}, "amount": 4}, {"id": 4}])
    land(tmp_path, "3.json", [{**full, "id": "5"}, {**full, "id": 6}])
    land(tmp_path, "4.json", [{**full, "id": 7, "price": 1.234}])
    land(tmp_path, "5.json", [{"name": None}])
    land(tmp_path, "6.json", [{"id": 8, "day": "2024-02-31"}])
    good, bad, versions = read_evolving(spark, str(tmp_path), DDL)
    assert [(r.id, r.name, r.amount) for r in good.orderBy("id").collect()] == [
        (None, None, None), (1, "a", 1.5), (2, None, 3.0), (3, "a", 4.0), (4, None, None)]
    assert sorted((r.file[-6:], r.value[:7], r.problem.split(":")[0]) for r in bad.collect()) == [
        ("1.json", "[1]", "no JSON object"), ("1.json", "null", "no JSON object"), ("1.json", "{broken", "no JSON object"),
        ("3.json", '{"id": ', "id"), ("3.json", '{"id": ', "id"), ("4.json", '{"id": ', "price"), ("6.json", '{"id": ', "a value of another kind")]
    told = {(r.file[-6:], r.column): r.verdict for r in versions.collect()}
    names = [f.split()[0] for f in DDL.split(", ")]
    assert {c: told["1.json", c] for c in names} == {**dict.fromkeys(names, "same"), "amount": "widened", "price": "widened"}
    assert told["2.json", "extra"] == "added" and told["3.json", "id"] == told["4.json", "price"] == "changed"
    assert {c: told["5.json", c] for c in names} == {**dict.fromkeys(names, "missing"), "name": "same"}
    assert len(told) == 6 * len(names) + 1


def test_nothing_landed(spark, tmp_path):
    land(tmp_path, "1.json", [""])
    assert [df.count() for df in read_evolving(spark, str(tmp_path), DDL)] == [0, 0, 0]


def test_whole_records_come_back(spark, tmp_path):
    land(tmp_path, "1.json", [{"id": k, "name": f"n{k}"} for k in range(500)])
    good, bad, _ = read_evolving(spark, str(tmp_path), "id bigint, name string")
    assert rows(good) == sorted([(k, f"n{k}") for k in range(500)], key=repr) and bad.count() == 0
