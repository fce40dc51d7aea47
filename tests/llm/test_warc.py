import hashlib
import io
import random

from locusweave.llm import warc
from locusweave.llm.common import fresh_path


def read(data):
    log = warc.Salvage()
    got = [(f["warc-record-id"], b) for f, b in warc.read_records(io.BytesIO(data).read, log)]
    return got, log.gaps


def archive(packed, n=12):
    rng = random.Random(1)
    payloads = [bytes(rng.randrange(32, 127) for _ in range(rng.choice([0, 5, 300, 90_000]))) for _ in range(n)]
    parts = [warc.record(i, "http://a/é \n", p, warc.sha1_32(p)) for i, p in enumerate(payloads)]
    return payloads, [warc.member(p) for p in parts] if packed else parts


def test_salvage():
    for packed in (True, False):
        payloads, parts = archive(packed)
        got, gaps = read(b"".join(parts))
        assert [b.partition(b"\r\n\r\n")[2] for _, b in got] == payloads and gaps == []
        hurt = list(parts)
        hurt[3] = hurt[3][:30] + bytes(40) + hurt[3][70:]
        hurt[7] = hurt[7][: len(hurt[7]) // 2]
        got, gaps = read(b"".join(hurt))
        assert [k for k, _ in got] == [f"<urn:page:{i}>" for i in range(12) if i not in (3, 7)]
        starts = [sum(map(len, hurt[:k])) for k in (3, 7)]
        assert [(o, n) for o, n, _ in gaps] == [(starts[0], len(hurt[3])), (starts[1], len(hurt[7]))]
        junk = b"x" * 200_000
        got, gaps = read(junk + b"".join(parts) + b"tail")
        assert len(got) == 12 and [(o, n) for o, n, _ in gaps] == [(0, 200_000), (200_000 + sum(map(len, parts)), 4)]
        got, gaps = read(b"".join(parts)[:-5])
        assert len(got) == (12 if packed else 11) and len(gaps) == 1  # only the member's checksum is cut
        assert read(b"") == ([], [])


def test_salvage_inside_a_member():
    payloads = [b"a" * 500, b"b" * 700, b"c" * 900]
    parts = [warc.record(i, "u", p, warc.sha1_32(p)) for i, p in enumerate(payloads)]
    for k in range(3):
        hurt = list(parts)
        hurt[k] = hurt[k].replace(payloads[k][:20], b"!" * 20, 1)
        got, gaps = read(warc.member(b"".join(hurt)) + warc.member(parts[0]))
        assert [n for n, _ in got] == [f"<urn:page:{i}>" for i in (0, 1, 2) if i != k] + ["<urn:page:0>"] and len(gaps) == 1
    rng = random.Random(4)
    big = [bytes(rng.randrange(32, 127) for _ in range(3000)) for _ in range(3)]
    whole = warc.member(b"".join(warc.record(i, "u", p, warc.sha1_32(p)) for i, p in enumerate(big)))
    got, gaps = read(whole[: len(whole) * 5 // 6] + warc.member(parts[1]))
    assert [n for n, _ in got] == ["<urn:page:0>", "<urn:page:1>", "<urn:page:1>"] and gaps


def test_wrong_length_in_a_plain_archive_loses_one_record():
    payload = b"x" * 1_000_000
    parts = [warc.record(i, "u", payload, warc.sha1_32(payload)) for i in range(60)]
    parts[1] = warc.re.sub(rb"Content-Length: (\d+)\r\n\r\nHTTP", rb"Content-Length: 9\g<1>\r\n\r\nHTTP", parts[1])
    most = 0

    class Stream(io.BytesIO):
        def read(self, n):
            nonlocal most
            most = max(most, self.tell())
            return super().read(n)

    log, whole = warc.Salvage(), b"".join(parts)
    first = [(f["warc-record-id"], most) for f, _ in warc.read_records(Stream(whole).read, log, lambda n, at: whole[at : at + n])]
    assert [n for n, _ in first] == [f"<urn:page:{i}>" for i in range(60) if i != 1] and len(log.gaps) == 1
    assert first[1][1] < 8_000_000


def test_a_record_stands_whatever_its_payload_holds():
    inner = warc.record(7, "in", b"i" * 1000, warc.sha1_32(b"i" * 1000))
    for size in (1000, 3_000_000, 6_000_000):
        payload = inner + b"x" * size + inner
        parts = [warc.record(i, "u", p, warc.sha1_32(p)) for i, p in ((1, payload), (2, b"two"))]
        for data in (b"".join(parts), warc.member(b"".join(parts))):
            for peek in (None, lambda n, at: data[at : at + n]):  # noqa: B023
                log = warc.Salvage()
                got = [(f["warc-record-id"], len(b)) for f, b in warc.read_records(io.BytesIO(data).read, log, peek)]
                assert [n for n, _ in got] == ["<urn:page:1>", "<urn:page:2>"] and got[0][1] > 2000 + size and log.gaps == []
        # where the outer one fails its check, those inside come forward
        hurt = parts[0].replace(b"x" * 100, b"y" * 100, 1)
        got, gaps = read(hurt + parts[1])
        assert [n for n, _ in got] == ["<urn:page:7>", "<urn:page:7>", "<urn:page:2>"] and gaps


def test_one_large_member_takes_memory_of_a_record():
    import tracemalloc
    import zlib

    rng = random.Random(5)
    payload = rng.randbytes(200_000)
    packer, total = zlib.compressobj(1, zlib.DEFLATED, 31), 600

    def chunks():
        for i in range(total):
            yield packer.compress(warc.record(i, "u", payload, warc.sha1_32(payload)))
        yield packer.flush()

    source, held = chunks(), bytearray()

    def stream(n):
        while len(held) < n and (c := next(source, None)) is not None:
            held.extend(c)
        out = bytes(held[:n])
        del held[:n]
        return out

    log = warc.Salvage()
    tracemalloc.start()
    n = sum(1 for _ in warc.read_records(stream, log))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == total and log.gaps == [] and most < 10_000_000


def test_a_cut_member_does_not_hide_the_next():
    rng = random.Random(6)
    payload = [rng.randbytes(rng.choice([10, 3000, 150_000])) for _ in range(40)]
    parts = [warc.record(i, "u", p, warc.sha1_32(p)) for i, p in enumerate(payload)]
    first, second = warc.member(b"".join(parts[:20])), warc.member(b"".join(parts[20:]))
    for cut in [1, 9, *(rng.randrange(len(first)) for _ in range(25))]:
        got, gaps = read(first[:cut] + second)
        names = [n for n, _ in got]
        assert names[-20:] == [f"<urn:page:{i}>" for i in range(20, 40)] and gaps
        assert names[:-20] == [f"<urn:page:{i}>" for i in range(len(names) - 20)]


def test_round_trip(spark):
    pages = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\nv", None), (0, "z", ""), (5, "é", "é" * 50_000), (5, "é", "é" * 50_000), (6, "é", "é" * 50_000), (None, "n", "<p>x</p>")]
    table = spark.createDataFrame([(*p, "y") for p in pages], "page_id long, url string, html string, record_type string")
    got = warc.read_archives(warc.write_archives(table, fresh_path(spark, "warc"))).collect()
    assert all(r["gap_reason"] is None for r in got)
    seen = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
    first = {"<p>x</p>": 1, "": 0, "é" * 50_000: 5}
    want = []
    for i, _, h in pages:
        data = (h or "").encode()
        back = first[h or ""] if i is not None and i > first[h or ""] else None
        want.append((i, len(data), warc.sha1_32(data), "response" if back is None else "revisit", back))
    assert seen == sorted(want, key=str)
    assert warc.sha1_32(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and hashlib.sha1(b"").hexdigest().startswith("da39")
    least = warc.read_archives(warc.write_archives(table, fresh_path(spark, "warc"), least=9)).where("record_type = 'revisit'").collect()
    assert [r["page_id"] for r in least] == [6]
    assert warc.read_archives(warc.write_archives(table.limit(0), fresh_path(spark, "warc"))).collect() == []
