"""Files cut by many tasks give the records of the reader of whole files."""

import csv
import hashlib
import io
import json
import random

import pytest

from ledgerloom.sources import files, split_files


def listed(spark, *rows):
    return spark.createDataFrame([("s", "d", str(p), "snap", sha, fmt, "") for p, sha, fmt in rows], files.FILES)


def rows_of(df):
    return sorted((r["file_ord"], r["record_no"], r["record"]) for r in df.collect())


@pytest.fixture(params=[40, 150, 4096])
def range_bytes(request, spark):
    """Byte ranges so short that they begin inside strings, escapes and nested values."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def values(rng, depth=0):
    """A random JSON value whose strings hold quotes, backslashes, brackets and commas."""
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([1, -2.5, True, None, 10**9])
    if kind < 4:
        return "".join(rng.choice('ab"\\{}[],: é漢\n') for _ in range(rng.randrange(25)))
    if kind == 4:
        return [values(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f'k{i}}}"': values(rng, depth + 1) for i in range(rng.randrange(4))}


def document(rng, shape):
    records = [values(rng) for _ in range(rng.randrange(2, 25))]
    form = {"indent": rng.choice([None, 1]), "ensure_ascii": rng.random() < 0.5}
    if shape == "array":
        return json.dumps(records, **form)
    if shape == "wrapped":
        return json.dumps({"meta": {"data": [values(rng)], "n": "data"}, "data": records, "rest": [values(rng), {"data": [1]}]}, **form)
    if shape == "nested":
        return json.dumps({"page": {"n": 2}, "_embedded": {"other": [values(rng)], "enheter": records}, "_links": {"x": values(rng)}, "records": records[:3]}, **form)
    return "\n".join(json.dumps({"v": r}) + rng.choice(["", " ", "\r"]) for r in records) + rng.choice(["", "\n", "\n\n"])


@pytest.mark.parametrize("shape", ["array", "wrapped", "nested", "lines"])
def test_json_cut_by_many_tasks(spark, tmp_path, range_bytes, shape):
    rng = random.Random(f"{shape}{range_bytes}")
    given = []
    for i in range(4):
        path = tmp_path / f"f{i}.{'jsonl' if shape == 'lines' else 'json'}"
        data = (b"\xef\xbb\xbf" if i == 1 else b"") + document(rng, shape).encode()
        path.write_bytes(data)
        given.append((path, hashlib.sha256(data).hexdigest(), path.suffix[1:]))
    table = listed(spark, *given)
    want = rows_of(files.json_records(spark, table, split_from=1 << 30))
    assert len(want) > 8
    assert rows_of(files.json_records(spark, table, split_from=1)) == want


def test_csv_cut_by_many_tasks(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    given = []
    for i in range(3):
        out = io.StringIO(newline="")
        writer = csv.writer(out, delimiter=";", lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(["name", "the\ncode" if i == 2 else "code", "drop", "note"])
        for _ in range(30):
            writer.writerow(["".join(rng.choice('a b;"\né') for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 6))])
        text = out.getvalue() + '\n 12" pipe;x"y; "open ""quoted"" field"z;"last' + "\n" * i + '";\n   \n'
        path = tmp_path / f"f{i}.csv"
        path.write_bytes(b"\xef\xbb\xbf" * (i == 1) + text.encode())
        given.append((path, "", "csv"))
    table, name = listed(spark, *given), lambda h: "" if h == "drop" else h.upper()
    want = rows_of(files.csv_records(spark, table, ";", name, split_from=1 << 30))
    assert len(want) > 60
    if range_bytes >= 150:
        assert rows_of(files.csv_records(spark, table, ";", name, split_from=1)) == want


def test_odd_files(spark, tmp_path):
    """Empty files, empty arrays, documents that are one record, a wrong checksum, and what is neither."""
    texts = {"a.json": "", "b.json": "[]", "c.json": ' {"x": {"data": 1}} ', "d.json": '{"data": []}', "e.json": "  \n", "f.json": '[{"a":1}]'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    table = listed(spark, *[(tmp_path / n, "", "json") for n in texts])
    assert rows_of(files.json_records(spark, table, split_from=1)) == rows_of(files.json_records(spark, table)) == [(2, 0, '{"x": {"data": 1}}'), (5, 0, '{"a":1}')]
    with pytest.raises(ValueError, match="checksum"):
        files.json_records(spark, listed(spark, (tmp_path / "f.json", "00", "json")), split_from=1)
    (tmp_path / "g.json").write_text('"text"}')
    with pytest.raises(ValueError, match="neither"):
        files.json_records(spark, listed(spark, (tmp_path / "g.json", "", "json")), split_from=1)
    assert files.json_records(spark, spark.createDataFrame([], files.FILES)).collect() == []


def test_a_large_file_uses_many_tasks(spark, tmp_path):
    path = tmp_path / "large.json"
    path.write_text("[" + ",\n".join(json.dumps({"id": i, "text": "x{[" * (i % 90)}) for i in range(60_000)) + "]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        assert split_files.pieces(spark, [str(path)], "}").rdd.getNumPartitions() >= 8
        got = files.json_records(spark, listed(spark, (path, "", "json")))
        assert [json.loads(r["record"])["id"] for r in got.orderBy("record_no").collect()] == list(range(60_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
