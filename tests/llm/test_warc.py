import base64
import hashlib
import random
import struct

import pytest
import zstandard

from ledgerline.llm import warc as WA


def pages(spark):
    rng = random.Random(8)
    html = [f"<html><p>{' '.join(rng.choices('aé<>&xyz', k=300))}</p></html>" for _ in range(30)]
    rows = [(i, f"http://h/{i}?é\r\nX: y%41", html[i % 30 if i % 3 else 0]) for i in range(90)]
    rows += [(90, None, None), (91, "u", ""), (None, "n", html[0]), (None, None, "alone"),
             (92, "u", "x" * 200_000), (93, "u", "twice"), (93, "u", "twice")]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_round_trip(spark):
    df, rows = pages(spark)
    got = WA.unpack(WA.pack(df)).collect()
    assert len(got) == len(rows) and all(r.error is None for r in got)
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", -1))
    want = []
    for i, url, h in rows:
        raw = (h or "").encode()
        first = best.get(h or "")
        again = first is not None and i != first
        want.append((str(i), str(url), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if again else "response", str(first) if again else "None",
                     "None" if again else h or ""))
    assert sorted((str(r.page_id), str(r.url), r.payload_bytes, r.payload_digest, r.record_type,
                   str(r.refers_to), str(r.payload)) for r in got) == sorted(want)


def test_files_read_back(spark, tmp_path):
    df, rows = pages(spark)
    made = WA.write_archives(df.repartition(3), f"file://{tmp_path}/w").collect()
    assert sum(r.n_records for r in made) == len(rows)
    assert WA.read_archives(spark, f"file://{tmp_path}/w").where("error IS NULL").count() == len(rows)


def test_archive_starts_with_a_trained_dictionary():
    rng = random.Random(1)
    archive = WA.ArchiveWriter()
    for i in range(1500):
        archive.add(WA.build_record(i, "http://x", " ".join(rng.choices(
            ["alpha", "beta", "gamma", "delta", "<p>", "</p>"], k=200)).encode()))
    body = archive.close()
    magic, size = struct.unpack("<II", body[:8])
    assert magic == 0x184D2A5D and size > 256
    frame = body[8 + size:]
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(frame, max_output_size=1 << 20)
    assert [WA.parse_record(r)["page_id"] for r in WA.records_of(body)] == list(range(1500))


def test_compressed_dictionary_and_no_dictionary():
    head = zstandard.train_dictionary(4096, [b"abcdefgh" * 20 + bytes([i]) * 40 for i in range(200)], k=64, d=8).as_bytes()
    record = WA.build_record(1, "u", b"abcdefgh" * 30)
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(head)).compress(record)
    packed = zstandard.ZstdCompressor().compress(head)
    assert list(WA.records_of(struct.pack("<II", WA.DICTIONARY_MAGIC, len(packed)) + packed + frame)) == [record]
    assert list(WA.records_of(zstandard.ZstdCompressor().compress(record) * 2)) == [record] * 2


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), lambda r: r.replace(b"WARC-Type: response\r\n", b""),
    lambda r: r[:-5], lambda r: r + b"x", lambda r: r.replace(b"payload!", b"payl0ad!"),
    lambda r: r.replace(b"WARC-Date:", b"no colon"), lambda r: r.replace(b"HTTP/1.1 200", b"FTP/1.1 2000"),
    lambda r: b""])
def test_wrong_records_are_refused(change):
    with pytest.raises(ValueError):
        WA.parse_record(change(WA.build_record(5, "u", b"payload!")))


def test_errors_become_rows(spark):
    good = zstandard.ZstdCompressor().compress(WA.build_record(1, "u", b"p"))
    bad = zstandard.ZstdCompressor().compress(b"nonsense")
    df = spark.createDataFrame([(bytearray(good + bad + good),), (bytearray(good + b"rubbish"),),
                                (bytearray(good[:-3]),), (None,), (bytearray(b""),)], "content binary")
    got = WA.unpack(df).collect()
    assert sum(r.error is None for r in got) == 3 and sum(r.error is not None for r in got) == 3
    assert WA.pack(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
