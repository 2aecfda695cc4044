import gzip
import hashlib
import random
import zlib

import pytest
from odd import prose

from riskloom.llm import warc as wa
from riskloom.llm.common import shared_folder


def pages(spark, data):
    return spark.createDataFrame([(*r, None, "x") for r in data], "page_id long, url string, html string, first long, digest string").repartition(3)


LONG = prose(1, 9000)
DATA = [
    (1, "http://a/", LONG), (2, "http://b/\r\nX: y", LONG), (3, None, "short"), (4, "u", "short"), (5, "ü", None), (6, "", ""), (7, "c", "x" * 99), (8, "c", "x" * 99), (9, "c", "x" * 100),
    (10, "c", "x" * 100), (10, "c", "x" * 100), (None, "n", LONG), (11, "d", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 20), (0, "e", LONG + "\r\n\r\n"), (-3, "f", LONG),
]


def expected(data):
    smallest = {}
    for key, _, html in data:
        if key is not None:
            smallest[html] = min(key, smallest.get(html, key))
    for key, _, html in data:
        body = (html or "").encode()
        again = len(body) >= 100 and key is not None and key > smallest[html]
        yield key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", smallest[html] if again else None


@pytest.mark.parametrize("archive_bytes", [1, 50_000, 1 << 30])
def test_round_trip(spark, archive_bytes):
    uri, archives = wa.write_archives(pages(spark, DATA), archive_bytes=archive_bytes)
    got = wa.read_records(uri, wa.normalise(uri, archives)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(expected(DATA), key=key)


def test_empty(spark):
    uri, archives = wa.write_archives(pages(spark, []))
    assert wa.read_records(uri, wa.normalise(uri, archives)).count() == 0


def test_normalised_members_stand_alone(spark):
    uri, archives = wa.write_archives(pages(spark, DATA).coalesce(1))
    (row,) = wa.normalise(uri, archives).collect()
    fs, root = shared_folder(uri)
    whole = fs.open_input_stream(f"{root}/{row['name']}.warc.gz", compression=None).read()
    members = fs.open_input_stream(f"{root}/{row['name']}.records.warc.gz", compression=None).read()
    assert gzip.decompress(whole) == gzip.decompress(members) and row["n_records"] == len(DATA)
    with fs.open_input_file(f"{root}/{row['name']}.records.warc.gz") as f:
        import json

        for line in fs.open_input_stream(f"{root}/{row['name']}.index", compression=None).read().splitlines():
            entry = json.loads(line)
            assert gzip.decompress(members[entry["offset"] : entry["offset"] + entry["length"]]).startswith(b"WARC/1.1")
            assert wa.read_member(f, entry["offset"], entry["length"])[0]["WARC-Type"] == entry["type"]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_streams_of_any_block_size_and_member_count(size):
    rng = random.Random(size)
    made = [wa.record(i, f"u{i}", bytes(rng.randrange(256) for _ in range(rng.randrange(300))), "0" * 64, None) for i in range(20)]
    single = gzip.compress(b"".join(b"".join(r) for r in made))
    several = b"".join(gzip.compress(b"".join(r)) for r in made)
    for stream in (single, several):
        blocks = [stream[i : i + size] for i in range(0, len(stream), size)]
        got = [(head, b"".join(pieces)) for _, head, pieces in wa.records(wa.inflated(blocks))]
        assert got == [(r[0], r[1] + r[2]) for r in made]
    with pytest.raises(ValueError):
        list((f, list(p)) for f, _, p in wa.records([b"".join(made[0])[:-9]]))


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_cut_archives_raise(size):
    made = [b"".join(wa.record(i, f"u{i}", bytes([65 + i]) * n, "0" * 64, None)) for i, n in enumerate((200, 5 << 20))]
    stream = zlib.compressobj(9, zlib.DEFLATED, 31)
    border = stream.compress(made[0]) + stream.flush(zlib.Z_FULL_FLUSH)
    whole = border + stream.compress(made[1]) + stream.flush()
    read = lambda data: [b"".join(p) for _, _, p in wa.records(wa.inflated([data[i : i + size] for i in range(0, len(data), size)]))]
    assert [len(r) for r in read(whole)] == [len(r) - r.index(b"\r\n\r\n") - 4 for r in made]
    for bad in (border, whole[:-1], whole[:-8], whole[:-9], whole + whole[:5], whole + b"\0" * 20, whole + b"x", b""):
        with pytest.raises((ValueError, zlib.error)):
            read(bad)
