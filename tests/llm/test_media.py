"""MPEG audio: exact round trips, lost synchronisation, checksums, seeking."""

import hashlib
import zlib
from fractions import Fraction

from quillmesh.llm import media_mpeg as m


def test_round_trip_at_any_length():
    for raw in (b"", b"\xff", b"\xff\xfb" * 400, bytes(range(256)) * 9, b"x" * 576):
        payload = m.padded(raw)
        assert payload and not len(payload) % 576 and payload.startswith(raw)
        s = m.parse(data := m.encode(payload))
        assert m.decode(data, s) == payload
        assert (s.skipped, s.crc_bad, s.table["frames"]) == (0, 0, len(s.offsets))
        assert s.duration == Fraction(576 * len(s.offsets), 16_000)


def test_resynchronises_and_checks():
    data = m.encode(m.padded(b"q" * 5000))
    whole = m.parse(data)
    assert m.parse(data + b"\xff\xf2garbage").offsets == whole.offsets
    cut = m.parse(data[:10] + b"\xff\x00junk" * 9 + data[10:])
    assert len(cut.offsets) == len(whole.offsets) and cut.skipped == 54
    hurt = bytearray(data)
    hurt[whole.offsets[3] + 7] ^= 1
    assert m.parse(bytes(hurt)).crc_bad == 1


def test_seek():
    s = m.parse(m.encode(m.padded(b"q" * 5000)))
    assert s.seek(0) == s.offsets[0]
    assert s.seek(0.0361) == s.offsets[1]
    assert s.seek(float(s.duration) + 1) is None and s.seek(-1) is None
    assert m.parse(b"").offsets == [] and m.parse(b"\xff" * 3000).offsets == []


def test_query(spark):
    texts = [None, "", "äé\U0001f600", "x" * 100_000, "x" * 576, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS media", "2 AS feature")
    rows = {r["doc_id"]: r for r in m.op10(docs).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(payload[-32:])
    assert rows[5][1:] == rows[6][1:]
    assert m.op10(docs.limit(0)).count() == 0


def test_payload_that_looks_like_a_tag():
    from quillmesh.llm import media_mpeg

    for blocks in (1, 3):
        raw = b"x" * (576 * (blocks - 1) + 505) + b"TAG" + b"y" * 68
        assert media_mpeg.decode(media_mpeg.encode(raw)) == raw
    stream = media_mpeg.encode(b"z" * 1152)
    tagged = media_mpeg.parse(stream + b"TAG" + b"title".ljust(125, b"\0"))
    assert tagged.tags["ID3v1:title"] == "title" and len(tagged.offsets) == 2
