"""Loads that are repeated, and files that change, shrink, empty and break in between."""

import os

import pytest

from lotwise.sources import ledger as L

SCHEMA = "k int, v string"


@pytest.fixture
def put(tmp_path):
    (tmp_path / "in").mkdir()
    clock = [1_700_000_000]

    def write(name, text):
        path = tmp_path / "in" / name
        path.write_text(text)
        clock[0] += 10
        os.utime(path, (clock[0], clock[0]))

    return write


def test_loads(spark, rows, tmp_path, put):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    load = lambda: L.load_files(spark, folder, SCHEMA, root)
    state = lambda: rows(L.loaded_rows(spark, SCHEMA, root), "k", "v")
    bad = lambda: rows(L.rejected_lines(spark, SCHEMA, root), "line")
    assert (load(), state(), bad()) == (L.Loaded(0, 0, 0, 0), [], [])
    put("a.csv", "k,v\n1,a\n2,b\nbad,x\n")
    put("b.csv", "k,v\n3,c\n")
    assert load() == L.Loaded(2, 0, 3, 1)
    assert load() == L.Loaded(0, 0, 0, 0) and state() == [(1, "a"), (2, "b"), (3, "c")] and bad() == [("bad,x",)]
    put("b.csv", "k,v\n3,c\n")  # touched
    assert load() == L.Loaded(0, 1, 0, 0) and load() == L.Loaded(0, 0, 0, 0)
    put("b.csv", "k,v\n3,d\n")  # same length, other rows
    assert load() == L.Loaded(1, 0, 1, 0) and state() == [(1, "a"), (2, "b"), (3, "d")]
    put("a.csv", "k,v\n2,b\n")  # shrinks, and the bad row goes
    assert load() == L.Loaded(1, 0, 1, 0) and state() == [(2, "b"), (3, "d")] and bad() == []
    put("a.csv", "k,v\nx,1\n")  # only bad rows are left
    assert load() == L.Loaded(1, 0, 0, 1) and state() == [(3, "d")] and bad() == [("x,1",)]
    put("b.csv", "")  # empties
    put("c.csv", "k,v\n9,new\n")
    assert load() == L.Loaded(2, 0, 1, 0) and state() == [(9, "new")]
    os.remove(tmp_path / "in" / "c.csv")
    assert load() == L.Loaded(0, 0, 0, 0) and state() == [(9, "new")]
    known = {os.path.basename(r["path"]): (r["good"], r["bad"]) for r in L.ledger(spark, root).collect()}
    assert known == {"a.csv": (0, 1), "b.csv": (0, 0), "c.csv": (1, 0)}


def test_a_load_that_was_cut_off(spark, rows, tmp_path, put, monkeypatch):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    put("a.csv", "k,v\n1,a\n")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(L, "_publish", stop)
        with pytest.raises(KeyboardInterrupt):
            L.load_files(spark, folder, SCHEMA, root)
    assert rows(L.loaded_rows(spark, SCHEMA, root)) == []
    assert L.load_files(spark, folder, SCHEMA, root) == L.Loaded(1, 0, 1, 0)
    assert rows(L.loaded_rows(spark, SCHEMA, root), "k", "v") == [(1, "a")]


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    root, entry = str(tmp_path / "root"), spark.createDataFrame([], L.LEDGER)
    L._publish(entry, root)
    monkeypatch.setattr(L, "_newest", lambda *_: 0)
    with pytest.raises(RuntimeError, match="meanwhile"):
        L._publish(entry, root)


def test_quoted_line_breaks(spark, rows, tmp_path, put):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    put("a.csv", 'k,v\n1,"two\nlines ""x"""\nq,z\n')
    assert L.load_files(spark, folder, SCHEMA, root, multi_line=True) == L.Loaded(1, 0, 1, 1)
    assert rows(L.loaded_rows(spark, SCHEMA, root), "k", "v") == [(1, 'two\nlines "x"')]


def test_names_that_need_care(spark, rows, tmp_path, put):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    for k, name in enumerate(("a b.csv", "a[1].csv", "a1.csv", "p%20q.csv", "é{x,y}*.csv")):
        put(name, f"k,v\n{k},a\n")
    assert L.load_files(spark, folder, SCHEMA, root) == L.Loaded(5, 0, 5, 0)
    assert L.load_files(spark, folder, SCHEMA, root) == L.Loaded(0, 0, 0, 0)
    assert rows(L.loaded_rows(spark, SCHEMA, root), "k") == [(k,) for k in range(5)]


def test_only_empty_files(spark, tmp_path, put):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    put("a.csv", "")
    assert L.load_files(spark, folder, SCHEMA, root) == L.Loaded(1, 0, 0, 0)
    assert L.load_files(spark, folder, SCHEMA, root) == L.Loaded(0, 0, 0, 0)
    assert L.loaded_rows(spark, SCHEMA, root).collect() == [] == L.rejected_lines(spark, SCHEMA, root).collect()
