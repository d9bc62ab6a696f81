"""File digests: one root for any number of tasks, equal to a tree built in plain Python."""

import hashlib
import random

import pytest

from decisionkit.sources import files


def tree(data: bytes, chunk: int, fan: int) -> str:
    level = [hashlib.sha256(data[i : i + chunk]).hexdigest() for i in range(0, len(data), chunk)] or [hashlib.sha256(b"").hexdigest()]
    while len(level) > 1:
        level = [hashlib.sha256(("node" + "".join(level[i : i + fan])).encode()).hexdigest() for i in range(0, len(level), fan)]
    return level[0]


def test_roots_do_not_depend_on_tasks(spark, tmp_path):
    draw = random.Random(7)
    sizes = {"empty": 0, "one": 1, "exact": 300, "more": 301, "deep": 100 * 27 + 1, "deeper of many": 54_321, "a%20b+#1": 777}
    data = {name: draw.randbytes(n) for name, n in sizes.items()}
    (tmp_path / "sub").mkdir()
    for name, body in data.items():
        (tmp_path / ("sub" if name == "deep" else "") / name).write_bytes(body)
    for tasks in (1, 3, 17):
        got = files.file_digests(spark, str(tmp_path), chunk=100, fan=3, tasks=tasks).collect()
        assert len(got) == len(data) - 1  # Spark lists no empty file
        for r in got:
            name = r["path"].rsplit("/", 1)[1]
            assert (r["bytes"], r["chunks"], r["root"]) == (sizes[name], max(1, -(-sizes[name] // 100)), tree(data[name], 100, 3))
    changed = bytearray(data["deep"])
    changed[-1] ^= 1
    assert tree(bytes(changed), 100, 3) != tree(data["deep"], 100, 3)


def test_one_node_above_other_files_changes_no_root(spark, tmp_path):
    (tmp_path / "small").write_bytes(b"abc")
    alone = files.file_digests(spark, str(tmp_path)).first()
    assert alone["root"] == hashlib.sha256(b"abc").hexdigest()
    (tmp_path / "large").write_bytes(bytes(5000))
    both = {r["path"]: r["root"] for r in files.file_digests(spark, str(tmp_path), chunk=7, fan=2).collect()}
    assert both[alone["path"]] == alone["root"]


def test_wrong_sizes(spark, tmp_path):
    with pytest.raises(ValueError):
        files.file_digests(spark, str(tmp_path), chunk=0)
    with pytest.raises(ValueError):
        files.file_digests(spark, str(tmp_path), fan=1)
