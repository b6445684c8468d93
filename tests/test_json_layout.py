"""JSON layouts: lines, documents cut into records in parallel, all against Python's parser or DuckDB."""

from __future__ import annotations

import json
import os
import random

import duckdb
import pytest

from strata.sources import json_layout
from strata.sources.readers import load

TRICKY = ['use { here', "a } b", '"quoted"', "back\\slash", '\\"', "\\\\", "line\nend", "[", "]", "é日本🎉", "", "{}" * 20, "a b", "\\u007b"]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def _record(rng, i):
    return {
        "id": i,
        "text": "".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 6))),
        "in": {"x": rng.randint(0, 9), "list": [{"k": rng.choice(TRICKY)} for _ in range(rng.randint(0, 3))]},
    }


def _documents(records):
    """The same records in several layouts."""
    half = len(records) // 2
    return {
        "array": json.dumps(records),
        "array_ascii_off": json.dumps(records, ensure_ascii=False),
        "pretty": json.dumps(records, indent=2),
        "one_a_line": "[\n" + ",\n".join(json.dumps(r) for r in records) + "\n]\n",
        "several": "\n".join(json.dumps(r, indent=1) for r in records),
        "two_arrays": json.dumps(records[:half], indent=1) + "\r\n" + json.dumps(records[half:], indent=1),
        "nested": json.dumps([records[:half], [[r] for r in records[half:]]], indent=1),
        "blank_first": "\n \n\t" + json.dumps(records, indent=1),
    }


def _found(frame):
    return sorted((json.loads(r) for r in frame.toJSON().collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("split", ["400", "128m"])
def test_layouts_equal_the_parser(spark, tmp_dir, split):
    rng = random.Random(int(split.rstrip("m")))
    records = [_record(rng, i) for i in range(16)]
    records[7]["text"] = "} { \\" * 250  # longer than several blocks
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, text in _documents(records).items():
            path = _write(f"{tmp_dir}/{name} 1.json", text)
            got = _found(load(spark, path, "json"))
            assert got == records, name
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_array_is_read_by_many_tasks(spark, tmp_dir):
    """A single line of many blocks: every block is a task, rows as DuckDB reads them."""
    rng = random.Random(1)
    path = _write(f"{tmp_dir}/line.json", json.dumps([_record(rng, i) for i in range(1500)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(path) // 20))
    try:
        pieces = json_layout._pieces(spark, [path])
        assert pieces.select("block").distinct().count() >= 20 and pieces.rdd.getNumPartitions() >= 20
        maps = json_layout.block_maps(pieces)
        assert maps.count() == pieces.select("block").distinct().count()
        frame = load(spark, path, "json")
        got = sorted((r.id, r.text, r["in"].x) for r in frame.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = duckdb.sql(f"SELECT id, text, \"in\".x FROM read_json_auto('{path}', maximum_object_size=100000000)").fetchall()
    assert got == sorted(want)
    assert json_layout._large_documents(spark, path) == []  # smaller than a split again


def test_more_blocks_than_are_broadcast(spark, tmp_dir, monkeypatch):
    rng = random.Random(2)
    records = [_record(rng, i) for i in range(40)]
    path = _write(f"{tmp_dir}/array.json", json.dumps(records, indent=1))
    monkeypatch.setattr(json_layout, "BROADCAST_BLOCKS", 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert _found(load(spark, path, "json")) == records
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_with_braces_in_strings(spark, tmp_dir):
    records = [{"id": i, "t": t} for i, t in enumerate(TRICKY)]
    path = _write(f"{tmp_dir}/lines.json", "\n".join(json.dumps(r) for r in records))
    assert _found(load(spark, path, "json")) == records
    assert json_layout.document_files(spark, path) == []


def test_good_lines_are_read_once(spark, tmp_dir, monkeypatch):
    """Without a rejected line the parser's own pass for the types is the only one."""
    path = _write(f"{tmp_dir}/lines.json", '{"a": "{"}\n{"a": "x"}\n')
    monkeypatch.setattr(json_layout, "rejected_first", lambda *a: pytest.fail("a second pass"))
    assert load(spark, path, "json").count() == 2


def test_a_bad_line_among_good_ones_stays_a_line(spark, tmp_dir):
    path = _write(f"{tmp_dir}/lines.json", '{"a": 1}\n{"a": \n{"a": 3}\n')
    rows = load(spark, path, "json").collect()
    assert sorted(r.a for r in rows if r.a is not None) == [1, 3] and len(rows) == 3
    path = _write(f"{tmp_dir}/noise.json", 'noise\n{"a": 1}\n{"a": 3}\n')
    assert json_layout.document_files(spark, path) == []


def test_folder_of_both_layouts_has_one_schema(spark, tmp_dir):
    _write(f"{tmp_dir}/lines.json", '{"id": 1, "v": 1}\n{"id": 2, "v": 2}\n')
    _write(f"{tmp_dir}/doc [1] 100%25 {{x,y}}.json", '[\n{"id": 3, "v": 1.5},\n{"id": 4, "w": "x"}\n]')
    _write(f"{tmp_dir}/empty.json", "")
    _write(f"{tmp_dir}/none.json", "[\n]\n")
    frame = load(spark, tmp_dir, "json")
    assert dict(frame.dtypes) == {"id": "bigint", "v": "double", "w": "string"}
    assert sorted(map(tuple, frame.select("id", "v", "w").collect())) == [(1, 1.0, None), (2, 2.0, None), (3, 1.5, None), (4, None, "x")]
    typed = load(spark, tmp_dir, "json", schema="id int, w string")
    assert sorted(r.id for r in typed.collect()) == [1, 2, 3, 4]


def test_maps_compose():
    """Block maps fed piece by piece give the state of one parser over the whole text."""
    rng = random.Random(3)
    text = json.dumps([_record(rng, i) for i in range(50)], indent=1).encode()
    whole, parts = json_layout.BlockMap(), json_layout.BlockMap()
    whole.feed(text)
    pieces = text.split(b"}")
    for piece in pieces[:-1]:
        parts.feed(piece + b"}")
    parts.feed(pieces[-1])
    assert (whole.inside, whole.depth, whole.lowest) == (parts.inside, parts.depth, parts.lowest)
    assert whole.depth[0] == 0 and whole.inside[0] == 0 and whole.lowest[0] == 0


@pytest.mark.parametrize(("text", "size"), [("134217728b", 1 << 27), ("128m", 1 << 27), ("1GB", 1 << 30), ("77", 77), ("2kb", 2048)])
def test_sizes(text, size):
    assert json_layout._bytes(text) == size
