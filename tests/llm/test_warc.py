import base64
import gzip
import hashlib
import random

import pytest

from acervo.llm import warc

DATE = b"2024-01-01T00:00:00Z"


def pages():
    rnd = random.Random(1)
    copied = "<p>" + "same é " * 200
    rows = [(i, f"http://a.example/{i}", "<html>" + "".join(rnd.choices("abc\r\n \x1fé", k=rnd.randrange(0, 4000))), "x") for i in range(60)]
    rows += [(100 + i, "http://b.example/\nx", copied, "x") for i in range(5)]
    rows += [(200, "u", "small", "x"), (201, "u", "small", "x"), (202, None, None, "x"), (203, "u", "", "x"), (None, "u", copied, "x"), (104, "v", copied, "x")]
    rows += [(300, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50, "x"), (301, "u", "long " * 200_000, "x")]
    return rows


def expected(rows):
    largest = {}
    for i, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            largest[data] = max(i, largest.get(data, i))
    out = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        keep = largest.get(data, i)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if keep == i else "revisit", None if keep == i else keep))
    return sorted(map(str, out))


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip(spark, tmp_path, compressed):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(pages(), "page_id long, url string, html string, digest string")
    warc.write(warc.with_types(frame), str(tmp_path / "a"), compressed=compressed)
    got = warc.read(spark, str(tmp_path / "a"))
    assert warc.gaps(got).count() == 0
    records = warc.records(got).select(
        warc.page_number(F.col("record_id")).alias("i"), "size", "digest", "kind", warc.page_number(F.col("refers_to")).alias("r"), "payload"
    ).collect()
    assert sorted(str((r["i"], r["size"], r["digest"], r["kind"], r["r"])) for r in records) == expected(pages())
    bodies = {r["i"]: bytes(r["payload"]) for r in records if r["kind"] == "response"}
    assert all(bodies[i] == (html or "").encode() for i, _, html, _ in pages() if i in bodies and i is not None)


def test_files_are_plain_gzip(spark, tmp_path):
    frame = spark.createDataFrame(pages()[:5], "page_id long, url string, html string, x string")
    warc.write(warc.with_types(frame.coalesce(1)), str(tmp_path / "a"))
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "a").glob("part-*"))
    assert whole.count(b"WARC-Record-ID") == 5


def archive(n=12, compressed=True):
    rnd = random.Random(2)
    parts = []
    for i in range(n):
        payload = bytes(rnd.choices(b"abcd <>\r\n", k=rnd.randrange(50, 900)))
        data = warc.record(i, b"http://x", payload, hashlib.sha1(payload).hexdigest(), None, DATE)
        parts.append(warc.member(data) if compressed else data)
    return parts


def ids(found):
    return [r["record_id"] for r in found if r["kind"] != "gap"]


@pytest.mark.parametrize("compressed", [True, False])
def test_damage_costs_only_the_damaged_records(compressed):
    rnd = random.Random(3)
    parts = archive(compressed=compressed)
    for _ in range(80):
        hit = rnd.sample(range(12), rnd.randrange(1, 4))
        damaged = list(parts)
        for k in hit:
            own = bytearray(damaged[k])
            kind = rnd.randrange(3)
            if kind == 0:
                own[rnd.randrange(30, len(own) - 12)] ^= 0x55
            elif kind == 1:
                del own[rnd.randrange(20, len(own) - 30) :]
            else:
                own = bytearray(rnd.randbytes(rnd.randrange(1, 300)))
            damaged[k] = bytes(own)
        data = b"".join(damaged)
        found = list(warc.salvaged(data))
        kept = ids(found)
        assert all(f"<urn:page:{k}>" in kept for k in range(12) if k not in hit and (k - 1 not in hit or compressed))
        assert len(kept) == len(set(kept))
        covered = sorted((r["start"], r["end"]) for r in found)
        edges = [0] + [e for _, e in covered]
        assert all(a <= e for (a, _), e in zip(covered, edges[:-1])) and covered[-1][1] == len(data)


def test_gap_in_front_and_at_the_end():
    parts = archive(3)
    data = b"junk" + b"".join(parts) + parts[0][:40]
    found = list(warc.salvaged(data))
    assert [r["kind"] for r in found] == ["gap", "response", "response", "response", "gap"]
    assert (found[0]["start"], found[0]["end"]) == (0, 4) and found[-1]["end"] == len(data)
    assert list(warc.salvaged(b"")) == [] and [r["kind"] for r in warc.salvaged(b"nothing")] == ["gap"]


def test_version_line_inside_a_payload_is_no_record():
    inner = warc.record(7, b"u", b"x", hashlib.sha1(b"x").hexdigest(), None, DATE)
    outer = warc.record(8, b"u", inner, hashlib.sha1(inner).hexdigest(), None, DATE)
    assert ids(warc.salvaged(outer)) == ["<urn:page:8>"]


def foreign(i, payload):
    """A record as other tools write it: base32 digests, a folded header line."""
    block = warc.HTTP + payload
    told = lambda x: b"sha1:" + base64.b32encode(hashlib.sha1(x).digest())
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nX-Note: two\r\n lines\r\n" % i
    head += b"WARC-Block-Digest: " + told(block) + b"\r\nWARC-Payload-Digest: " + told(payload)
    return head + b"\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(block), block)


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_archives_of_other_tools(pack):
    found = list(warc.salvaged(b"".join(pack(foreign(i, b"body %d" % i)) for i in range(5))))
    assert ids(found) == [f"<urn:page:{i}>" for i in range(5)] and len(found) == 5
    assert [r["digest"] for r in found] == [hashlib.sha1(b"body %d" % i).hexdigest() for i in range(5)]
    bad = foreign(1, b"body").replace(b"\r\n\r\nbody", b"\r\n\r\nbode")
    assert [r["kind"] for r in warc.salvaged(pack(bad))] == ["gap"]


def test_members_of_several_records():
    rnd = random.Random(4)
    parts = [foreign(i, rnd.randbytes(3000)) for i in range(9)]
    names = [f"<urn:page:{i}>" for i in range(9)]
    whole = warc.member(b"".join(parts))
    assert ids(warc.salvaged(whole)) == names
    bad = [*parts[:4], parts[4][:-9] + b"#" + parts[4][-8:], *parts[5:]]
    found = list(warc.salvaged(warc.member(b"".join(bad)) + warc.member(parts[0])))
    assert ids(found) == [*names[:4], *names[5:], names[0]]
    assert [r["reason"].rpartition(": ")[2] for r in found if r["kind"] == "gap"] == ["block digest"]
    for damaged in (whole[: len(whole) * 2 // 3], whole[:-6] + b"\0" + whole[-5:], whole[:-8000] + b"\xff" * 8000):
        for tail, more in ((b"", []), (warc.member(foreign(20, b"x")), ["<urn:page:20>"])):
            found = list(warc.salvaged(damaged + tail))
            kept = ids(found)
            assert kept[:5] == names[:5] and kept == names[: len(kept) - len(more)] + more
            assert any(r["kind"] == "gap" for r in found) and max(r["end"] for r in found) == len(damaged + tail)


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(warc.with_types(frame), str(tmp_path / "a"))
    assert warc.read(spark, str(tmp_path / "a")).collect() == []


@pytest.mark.parametrize("compressed", [True, False])
def test_files_end_by_bytes(spark, tmp_path, monkeypatch, compressed):
    monkeypatch.setattr(warc, "VALUE_BYTES", 20_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 100_000)
    rows = [(i, f"http://a/{i}", random.Random(i).randbytes(3000).hex()) for i in range(200)] + [(900 + i, "http://a", "") for i in range(50)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    typed = warc.with_types(frame).coalesce(1)
    warc.write(typed, str(tmp_path / "a"), compressed=compressed)
    sizes = [f.stat().st_size for f in (tmp_path / "a").glob("part-*")]
    assert len(sizes) > 5 and max(sizes) < 100_000 + 5 * 10_000
    read = warc.read(spark, str(tmp_path / "a")).collect()
    assert sorted((r["record_id"], bytes(r["payload"]).decode()) for r in read) == sorted((f"<urn:page:{i}>", h) for i, _, h in rows)
