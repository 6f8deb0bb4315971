"""JSON arrays read in ranges, against the reader of whole files."""

import json
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartorio.sources import files, json_arrays

NAMES = ["a", "b", "nested", "absent"]


def written(folder, *texts):
    folder.mkdir(parents=True, exist_ok=True)
    for k, t in enumerate(texts):
        (folder / f"{k}.json").write_bytes(t if isinstance(t, bytes) else t.encode())
    return str(folder)


def records(seed, n):
    r = random.Random(seed)
    text = lambda: "".join(r.choice(['{', '}', '"', '\\', '\n', '[', ']', ',', 'é', 'x', ' ', '\\"', '"}']) for _ in range(r.randint(0, 60)))
    return [{"a": text(), "b": r.choice([i, i / 4, None, True, text()]), **({"nested": {"x": [text(), {"y": {}}], "}": "{"}} if i % 3 == 0 else {}), **({"more": text()} if i % 4 == 0 else {})} for i in range(n)]


@pytest.mark.parametrize("indent,size", [(None, 400), (2, 701), (None, 3000), (1, 1 << 20)])
def test_ranges_read_as_the_whole_file_does(spark, tmp_path, indent, size):
    path = written(tmp_path / "in", json.dumps(records(1, 120), indent=indent, ensure_ascii=False), "[]", "", "[\n]", "﻿" + json.dumps(records(2, 30)))
    own = [json.loads(r["record"]) for r in json_arrays.json_records(spark, path, size).collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, own)) == sorted(map(key, records(1, 120) + records(2, 30)))
    got = files.read_json_array(spark, path, NAMES, range_bytes=size)
    assert got.columns == [*NAMES, "_corrupt", "_rescued"] and got.filter("_corrupt is not null").isEmpty()
    whole = files.read_json_array(spark, path, NAMES).filter("_corrupt is null and (a is not null or b is not null)")
    plain = lambda r: (r["a"], r["b"], r["absent"], r["nested"] and json.dumps(json.loads(r["nested"])))
    assert sorted(map(str, map(plain, got.collect()))) == sorted(map(str, map(plain, whole.collect())))
    assert {json.loads(r[0])["more"] for r in got.select("_rescued").dropna().collect()} == {r["more"] for r in records(1, 120) + records(2, 30) if "more" in r}


def test_a_file_is_cut_and_a_record_may_fill_many_ranges(spark, tmp_path):
    rows = [{"a": "x" * 40, "b": i} for i in range(400)] + [{"a": "}{" * 5000, "b": 400}, {"a": "y" * 9000, "b": 401}, {"a": "", "b": 402}]
    path = written(tmp_path / "in", json.dumps(rows))
    with json_arrays._ranges_of(spark, 500):
        assert json_arrays._pieces(spark, path).select("block").distinct().count() >= 8
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    got = files.read_json_array(spark, path, ["a", "b"], range_bytes=500)
    assert sorted((int(r["b"]), r["a"]) for r in got.collect()) == [(r["b"], r["a"]) for r in rows]


@pytest.mark.parametrize("text,good,bad", [
    ('[{"a": "1"}, 5, "te}xt", {"a": "2"}]', ["1", "2"], ['5, "te}xt"']),
    ('[{"a": "1"}, {"a": }, {"a": "3"}]', ["1", "3"], ['{"a": }']),
    ('[{"a": "1"}, {"a": "2", "b": 3', ["1"], ['{"a": "2", "b": 3']),
    ('[{"a": "1"}}, {"a": "2"}]', ["1", "2"], ["}"]),
    ('{"a": "1"}\n{"a": "2"}', ["1", "2"], []),
    ('{"a": "1"}', ["1"], []),
])
def test_what_is_not_a_record_is_kept(spark, tmp_path, text, good, bad):
    for size in (7, 1000):
        rows = files.read_json_array(spark, written(tmp_path / "in", text), ["a"], range_bytes=size).collect()
        assert sorted(r["a"] for r in rows if r["_corrupt"] is None) == good
        told = "".join(sorted(r["_corrupt"] for r in rows if r["_corrupt"] is not None))
        assert sorted(told.replace(" ", "").replace(",", "")) == sorted("".join(bad).replace(" ", "").replace(",", ""))


def test_states_of_many_ranges_by_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_arrays, "FEW", 0)
    path = written(tmp_path / "in", json.dumps(records(5, 60)), json.dumps(records(6, 60), indent=3))
    own = [json.loads(r["record"]) for r in json_arrays.json_records(spark, path, 300).collect()]
    assert sorted(map(str, own)) == sorted(map(str, records(5, 60) + records(6, 60)))


def test_many_small_ranges_take_few_tasks(spark, tmp_path, monkeypatch):
    """The number of ranges tells in rows of the states, not in tasks or in files of the checkpoints."""
    tasks, keep = [], json_arrays.materialised
    monkeypatch.setattr(json_arrays, "materialised", lambda df: tasks.append(df.rdd.getNumPartitions()) or keep(df))
    path = written(tmp_path / "in", json.dumps(records(7, 400)), json.dumps(records(8, 400), indent=2))
    with json_arrays._ranges_of(spark, 300):
        assert json_arrays._pieces(spark, path, 300).select("path", "block").distinct().count() > 300
    own = [json.loads(r["record"]) for r in json_arrays.json_records(spark, path, 300).collect()]
    assert sorted(map(str, own)) == sorted(map(str, records(7, 400) + records(8, 400)))
    assert len(tasks) == 2 and max(tasks) <= json_arrays.EACH * spark.sparkContext.defaultParallelism


def test_states_of_ranges_against_a_plain_walk(spark):
    r, rows, want = random.Random(9), [], {}
    for path in ("a", "b", "c"):
        inside = depth = since = 0
        for block in range(0, 3000, 10):
            quotes, (up0, up1), (low0, low1) = r.randint(0, 1), (r.randint(-3, 3), r.randint(-3, 3)), (-r.randint(0, 3), -r.randint(0, 3))
            low0, low1 = min(low0, up0), min(low1, up1)
            rows.append((path, block, 3000, 10, quotes, up0, low0, up1, low1))
            want[path, block] = inside, depth, since, path == "b" and block == 2990
            up, low = (up1, low1) if inside else (up0, low0)
            since = block if depth == 0 or depth + low <= 0 else since
            inside, depth = (inside + quotes) % 2, max(depth + up, up - low)
    rows = [(*x[:2], 2999 if x[0] == "b" else 3000, *x[3:]) for x in rows]
    summary = spark.createDataFrame(r.sample(rows, len(rows)), "path string, block bigint, size bigint, bytes bigint, quotes bigint, up0 bigint, low0 bigint, up1 bigint, low1 bigint")
    assert {(x["path"], x["block"]): tuple(x)[2:] for x in json_arrays._states(summary).collect()} == want


def test_escaped_quotes_of_any_run_of_backslashes():
    r = random.Random(10)
    for _ in range(300):
        text = bytes(r.choice(b'"\\\\{}x') for _ in range(r.randint(0, 40)))
        place, want, n, quoted = [], [], 0, 0
        for i, c in enumerate(text):
            if c in b"{}":
                place, want = [*place, i], [*want, quoted % 2]
            quoted += c == json_arrays.QUOTE and n % 2 == 0
            n = n + 1 if c == json_arrays.ESCAPE else 0
        walk = json_arrays.Walk(np.frombuffer(text, np.uint8))
        assert (walk.at.tolist(), walk.inside.tolist(), walk.quotes) == (place, want, quoted)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text(max_size=4), st.recursive(st.none() | st.text(max_size=12) | st.integers(), lambda x: st.lists(x, max_size=3), max_leaves=4), max_size=4), max_size=12), st.integers(5, 60))
def test_any_records(spark, tmp_path_factory, rows, size):
    path = written(tmp_path_factory.mktemp("any"), json.dumps(rows, ensure_ascii=False))
    own = [json.loads(r["record"]) for r in json_arrays.json_records(spark, path, size).collect()]
    assert sorted(json.dumps(r, sort_keys=True) for r in own) == sorted(json.dumps(r, sort_keys=True) for r in rows)
