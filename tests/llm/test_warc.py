import gzip
import hashlib
import io
import random

from cdclake.llm import warc


def pages():
    rng = random.Random(9)
    body = lambda: "".join(rng.choice("<p>é ab\r\n\r\n") for _ in range(rng.randint(100, 400)))
    rows = [(k, f"http://x/{k}", body()) for k in range(40)]
    rows += [(100 + k, "http://x/é\r\nbad: 1", rows[3][2]) for k in range(5)] + [(2, "u", rows[30][2]), (1, None, rows[30][2])]
    rows += [(200, "u", None), (201, "u", ""), (202, "u", "small"), (203, "u", "small"), (None, "u", rows[5][2]), (None, None, None)]
    return rows + [(300, "u", "x" * 100), (300, "u", "x" * 100), (301, "u", "x" * 100)]


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if i is not None and len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in data:
        again = b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    table = spark.createDataFrame([(*r, "x") for r in pages()], "page_id long, url string, html string, digest string")
    assert sorted(map(tuple, warc.archive_round_trip(table).collect()), key=repr) == expected(pages())
    assert warc.archive_round_trip(table.limit(0)).count() == 0


def test_any_splits_give_every_record_once(spark, root):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string")
    files = warc.write_pages(table, f"file://{root}/a")
    whole = sorted((r.path, r.offset, r.record_id, bytes(r.payload)) for r in warc.read_records(files).collect())
    assert len(whole) == len(pages())
    for size in (61, 700, 5000):
        parts = warc.read_records(files, split_bytes=size).collect()
        assert sorted((r.path, r.offset, r.record_id, bytes(r.payload)) for r in parts) == whole
    assert warc.read_records(files.limit(0)).count() == 0


def _record(name, payload):
    return warc.record_bytes({"record_id": name, "uri": None, "refers_to": None}, payload, "d", False, "2020-01-01T00:00:00Z")


def _names(data, step):
    found = []
    for start in range(0, len(data), step):
        file = warc._Bytes(io.BytesIO(data), len(data))
        for offset, record in warc.members(file, start, min(start + step, len(data))):
            found.append((offset, warc.parse_record(record)[0]["warc-record-id"]))
    return found


def test_magic_inside_records_and_damage(spark):
    inner = b"".join(_record(f"inner{k}", b"y" * 30) for k in range(3))
    # An archive inside a record that is stored without compression shows its own members.
    plain = gzip.compress(b"WARC/1.1\r\nWARC-Record-ID: <outer>\r\nContent-Length: 9\r\n\r\n" + inner + b"\r\n\r\n", 0)
    records = [_record("a", b"x" * 500), plain, _record("b", b"\x1f\x8b\x08" * 50), _record("c", b"")]
    data = b"".join(records)
    names = [f"<{n}>" for n in ("a", "outer", "b", "c")]
    for step in (37, 200, len(data)):
        assert [n for _, n in _names(data, step)] == names
    broken = bytearray(data)
    at = len(records[0]) + len(records[1]) + len(records[2]) // 2
    broken[at : at + 8] = b"\x00" * 8
    assert [n for _, n in _names(bytes(broken), len(data))] == ["<a>", "<outer>", "<c>"]
    assert _names(b"no archive at all", 5) == []


def test_stored_archives_of_any_length_are_not_taken_for_the_file():
    outer = lambda name, inner: gzip.compress(
        b"WARC/1.1\r\nWARC-Record-ID: <" + name + b">\r\nContent-Length: 9\r\n\r\n" + inner + b"\r\n\r\n", 0)
    for count in (40, 100, 1000):
        inner = b"".join(_record(f"inner{k}", b"y" * 30) for k in range(count))
        records = [_record("a", b"x" * 500), outer(b"o1", inner), _record("b", b""), outer(b"o2", inner), *(_record(f"c{k}", b"z") for k in range(3))]
        data = b"".join(records)
        whole = _names(data, len(data))
        assert [n for _, n in whole] == ["<a>", "<o1>", "<b>", "<o2>", "<c0>", "<c1>", "<c2>"]
        for step in (len(data) // 2, len(data) // 7):
            assert _names(data, step) == whole


def test_splits_are_read_by_tasks_of_their_own(spark, root):
    table = spark.createDataFrame(pages() * 5, "page_id long, url string, html string")
    files = warc.write_pages(table, f"file://{root}/t")
    found = warc.read_records(files, split_bytes=4000, payloads=False)
    tasks = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    # Splits meet in a task by chance only.
    assert sum(n > 0 for n in tasks) >= 5 and sum(tasks) == len(pages()) * 5
