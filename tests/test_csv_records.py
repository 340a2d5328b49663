"""The splittable CSV reader against Python's sequential one, with splits of a few bytes."""

import csv
import io
import random

import pytest

from fusework.sources import catalog_csv, csv_records
from fusework.sources.csv_records import PLAIN, QUOTED, RECORD, Lines

SPLITS = "spark.sql.files.maxPartitionBytes"


def sequential(text, backslash):
    reader = csv.reader(io.StringIO(text, newline=""), doublequote=True, escapechar="\\" if backslash else None)
    return [r for r in reader if r and not (len(r) == 1 and not r[0].strip())]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in (SPLITS, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda n: spark.conf.set(SPLITS, str(n))
    for key in (SPLITS, "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, old[key]) if key in old else spark.conf.unset(key)


def random_csv(rng, rows, backslash):
    def field():
        text = "".join(rng.choice(['a', 'é', ' ', ',', '"', "\n", "x", "7"] + (["\\"] if backslash else [])) for _ in range(rng.choice([0, 1, 3, 9, 40])))
        if rng.random() < 0.3:
            # unquoted: nothing that ends a field, but a quote inside or an escape may stand there
            plain = text.replace(",", "").replace("\n", "").replace("\\", "").lstrip('"') or "z"
            return plain + ("\\," if backslash and rng.random() < 0.3 else "") + ("\\\n" if backslash and rng.random() < 0.1 else "")
        if backslash:
            text = text.replace("\\", "\\\\")
        return '"' + "".join((rng.choice(['""', '\\"']) if backslash else '""') if c == '"' else c for c in text) + '"'

    lines = ["one,two,three"]
    for _ in range(rows):
        lines.append(",".join(field() for _ in range(3)))
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "   "]))
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("backslash", [False, True])
def test_equal_to_a_sequential_reader(spark, store, tmp_path, small_splits, backslash):
    rng = random.Random(3 + backslash)
    for trial, size in enumerate((64, 150, 1000, 100_000)):
        folder = tmp_path / f"t{trial}"
        folder.mkdir()
        want, number = [], 0
        for k in range(3):
            text = random_csv(rng, 40, backslash)
            (folder / f"f{k}.csv").write_text(text, newline="")
            for at, fields in enumerate(sequential(text, backslash)):
                want.append((k, at, number if at else None, fields))
                number += at > 0
        small_splits(size)
        rows = csv_records.read_records(spark, str(folder), store.save, backslash, header=True).collect()
        got = sorted((int(r.file[-5]), r.record, r.number if r.record else None, r.fields) for r in rows)
        assert got == want
        loaded = catalog_csv.load_csv_source(spark, str(folder), "x", backslash, row_id="row_id").orderBy("row_id")
        assert loaded.columns == ["one", "two", "three", "_source", "row_id"]
        na = set(catalog_csv.CSV_NA_VALUES)
        assert [tuple(r)[:3] + (r.row_id,) for r in loaded.collect()] == [
            (*[None if v in na else v for v in fields], n) for _, at, n, fields in want if at
        ]


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} with ""quotes"", commas' for i in range(400))
    text = f'a,b\n1,"{long}"\n2,"x\r\ny"\n\n3,"' + "z" * 500 + '"\n'
    (tmp_path / "f.csv").write_text(text, newline="")
    small_splits(100)
    rows = catalog_csv.load_csv_source(spark, str(tmp_path / "f.csv"), "x", multi_line=True)
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", long.replace('""', '"')), ("2", "x\r\ny"), ("3", "z" * 500)]


def test_broken_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n2,3\n')
    with pytest.raises(ValueError, match="ends inside a quoted field"):
        catalog_csv.load_csv_source(spark, str(tmp_path / "open.csv"), "x", multi_line=True)
    (tmp_path / "many.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="too many fields"):
        catalog_csv.load_csv_source(spark, str(tmp_path / "many.csv"), "x", multi_line=True).collect()
    (tmp_path / "few.csv").write_text('﻿A B,b\n1\n""\n')
    few = catalog_csv.load_csv_source(spark, str(tmp_path / "few.csv"), "x", multi_line=True)
    assert sorted(map(tuple, few.select("a_b", "b").collect()), key=str) == [("1", None), (None, None)]
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError):
        catalog_csv.load_csv_source(spark, str(tmp_path / "none.csv"), "x", multi_line=True)
    (tmp_path / "head.csv").write_text("a,b\n")
    assert catalog_csv.load_csv_source(spark, str(tmp_path / "head.csv"), "x", multi_line=True).collect() == []


def test_two_sources_in_one_store(spark, store, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"k\n{name}\n")
    one, two = (catalog_csv.load_csv_source(spark, str(tmp_path / f"{n}.csv"), n, row_id="i", stage=store.save) for n in "ab")
    assert [tuple(r) for r in one.unionByName(two).orderBy("k").collect()] == [("a", "a", 0), ("b", "b", 0)]


def test_states_follow_the_reader():
    plain, escaped = Lines(False), Lines(True)
    assert plain.after('a,"b', RECORD) == QUOTED and plain.after('b",c', QUOTED) == RECORD and plain.after('a"b,"c""', RECORD) == QUOTED
    assert plain.after('5" disk,x', RECORD) == RECORD and plain.after("a\\", RECORD) == RECORD
    assert escaped.after('a,"b\\"', RECORD) == QUOTED and escaped.after("a\\", RECORD) == PLAIN and escaped.after('b,"c"\\', PLAIN) == RECORD
    assert escaped.after('"', PLAIN) == RECORD and escaped.after("\\", QUOTED) == QUOTED
