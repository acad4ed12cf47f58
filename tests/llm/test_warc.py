import io
import random

from spanlink.llm import warc


def _records(n=8):
    return [warc.record(k, f"http://x/{k}\r\n", bytes([65 + k]) * (200 + 50 * k)) for k in range(n)]


def _ids(found):
    return [warc._id(f.headers["warc-record-id"]) for f in found if f.headers]


def test_round_trip_of_members_and_bare_records():
    raw = _records()
    mixed = b"".join(warc.member(r) if k % 2 else r for k, r in enumerate(raw))
    found = list(warc.salvage(io.BytesIO(mixed)))
    assert _ids(found) == list(range(8)) and not any(f.reason for f in found)
    assert found[3].payload == b"D" * 350


def test_damage_is_skipped_logged_and_later_records_recovered():
    for pack in (warc.member, bytes):
        parts = [pack(r) for r in _records()]
        hurt = bytearray(parts[3])
        hurt[len(hurt) // 2] ^= 0xFF
        whole = b"".join([*parts[:3], bytes(hurt), *parts[4:]])
        found = list(warc.salvage(io.BytesIO(whole)))
        assert _ids(found) == [0, 1, 2, 4, 5, 6, 7]
        gaps = [(f.offset, f.length) for f in found if f.reason]
        assert gaps == [(sum(map(len, parts[:3])), len(hurt))]


def test_every_byte_is_in_a_record_or_a_gap():
    rng = random.Random(3)
    for trial in range(60):
        data = bytearray(b"".join(warc.member(r) if rng.random() < 0.5 else r for r in _records()))
        for _ in range(rng.randrange(4)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        if rng.random() < 0.3:
            del data[rng.randrange(len(data)) :]
        if rng.random() < 0.3:
            data[:0] = bytes(rng.randrange(256) for _ in range(50))
        at = 0
        for f in warc.salvage(io.BytesIO(bytes(data))):
            assert f.offset == at
            at += f.length
        assert at == len(data)


def test_digests_of_other_kinds_and_spellings():
    raw = warc.record(1, "http://x/", b"A" * 300)
    own = warc.hashlib.sha1(b"A" * 300)
    hexed, base32 = own.hexdigest().encode(), warc.base64.b32encode(own.digest())
    for said in (base32, base32.lower(), hexed.upper()):
        (found,) = warc.salvage(io.BytesIO(warc.member(raw.replace(b"Payload-Digest: sha1:" + hexed, b"Payload-Digest: sha1:" + said))))
        assert found.reason is None and found.payload == b"A" * 300
    for said, fine in ((b"sha256:" + warc.hashlib.sha256(b"A" * 300).hexdigest().encode(), True), (b"sha256:00", False), (b"blake9:00", True), (b"sha1:" + hexed[::-1], False)):
        (found,) = warc.salvage(io.BytesIO(warc.member(raw.replace(b"Payload-Digest: sha1:" + hexed, b"Payload-Digest: " + said))))
        assert (found.reason is None) == fine


def test_long_records_and_members_that_inflate_without_end():
    long = warc.record(1, "http://x/", b"A" * (300 << 20))
    for pack in (warc.member, bytes):
        found = list(warc.salvage(io.BytesIO(pack(long) + pack(_records(1)[0]))))
        assert _ids(found) == [1, 0] and len(found[0].payload) == 300 << 20
    bomb = warc.member(_records(1)[0] + b"\0" * (64 << 20))
    found = list(warc.salvage(io.BytesIO(bomb + warc.member(_records()[3]))))
    assert _ids(found) == [3] and found[0].length == len(bomb)


def test_empty_stream():
    assert list(warc.salvage(io.BytesIO(b""))) == []
