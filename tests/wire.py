"""Capture records made and read one by one, as a yardstick for the fast way."""

import io
import lzma
import math
import struct
import tarfile

from tickloom.fixtures.capture_files import blocked_xz

EPOCH_NS = 315_513_000 * 1_000_000_000


def record(kind="N", cap_s=1_700_000_000, cap_ns=5, pad0=0, pad1=0, msg_len=36, stream=3, seq=7, ts=1_000,
           id_a=11.0, id_b=12.0, token=45_000, side="B", price=100, qty=5):
    if kind in "TCK":
        body = struct.pack("<qddiii", ts, id_a, id_b, token, price, qty)
    elif kind == "Z":
        body = struct.pack("<i", price)
    else:
        body = struct.pack("<qdi", ts, id_a, token) + side.encode() + struct.pack("<ii", price, qty)
    head = struct.pack("<IIII10xhhiB", cap_s, pad0, cap_ns, pad1, msg_len, stream, seq, ord(kind))
    return head + body.ljust(37, b"\x55")


def message(raw):
    """Message fields of one record, ids as text."""
    cap_s, _, cap_ns, _ = struct.unpack_from("<IIII", raw, 0)
    _, stream, seq, code = struct.unpack_from("<hhiB", raw, 26)
    kind, body = chr(code), raw[35:]
    exchange, token, side, ids, qty = 0, 0, "", [math.nan] * 3, 0
    if kind in "NMXGHJ":
        exchange = struct.unpack_from("<q", body, 0)[0] + EPOCH_NS
        ids[0] = struct.unpack_from("<d", body, 8)[0]
        token, = struct.unpack_from("<i", body, 16)
        side = chr(body[20])
        price, qty = struct.unpack_from("<ii", body, 21)
    elif kind in "TCK":
        exchange = struct.unpack_from("<q", body, 0)[0] + EPOCH_NS
        ids[1], ids[2] = struct.unpack_from("<dd", body, 8)
        token, price, qty = struct.unpack_from("<iii", body, 24)
    else:
        price, = struct.unpack_from("<i", body, 0)
    return (cap_s * 10**9 + cap_ns, exchange, stream, seq, kind, token, side, *map(str, ids), price, qty)


def shown(row):
    return tuple(str(value) if isinstance(value, float) else value for value in row)


def archive(path, **captures):
    with tarfile.open(path, "w:xz") as target:
        for name, data in captures.items():
            member = tarfile.TarInfo(name.replace("__", "."))
            member.size = len(data)
            target.addfile(member, io.BytesIO(data))


def blocked_archive(path, block_bytes, **captures):
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as target:
        for name, data in captures.items():
            member = tarfile.TarInfo(name.replace("__", "."))
            member.size = len(data)
            target.addfile(member, io.BytesIO(data))
    packed = blocked_xz(plain.getvalue(), block_bytes)
    assert lzma.decompress(packed) == plain.getvalue()
    with open(path, "wb") as out:
        out.write(packed)
