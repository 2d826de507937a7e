"""miniSEED records for tests."""

import struct

import numpy as np


def steim_body(x, kind):
    """Frames of one record, every difference in the widest packing but where a narrow one fits four or seven."""
    d = [0, *np.diff(x).tolist()]
    words, k = [], 0
    while k < len(d):
        some = d[k : k + 7]
        if kind == 11 and len(some) == 7 and all(-8 <= v < 8 for v in some):
            words.append((3, (2 << 30) | sum((v & 15) << (4 * (6 - j)) for j, v in enumerate(some))))
            k += 7
        elif len(some) >= 4 and all(-128 <= v < 128 for v in some[:4]):
            words.append((1, sum((v & 255) << (8 * (3 - j)) for j, v in enumerate(some[:4]))))
            k += 4
        else:
            words.append((3, d[k] & 0xFFFFFFFF) if kind == 10 else (2, (1 << 30) | (d[k] & 0x3FFFFFFF)))
            k += 1
    words = [(0, x[0] & 0xFFFFFFFF), (0, x[-1] & 0xFFFFFFFF), *words]
    body = b""
    for f in range(0, len(words), 15):
        part = words[f : f + 15] + [(0, 0)] * (15 - len(words[f : f + 15]))
        body += struct.pack(">16I", sum(c << (28 - 2 * j) for j, (c, _) in enumerate(part)), *[w for _, w in part])
    return body


def mseed_record(x, encoding, second, rate=20, station="AB", channel="EHZ", minute=2, hour=1):
    body = {3: lambda: struct.pack(f">{len(x)}i", *x), 4: lambda: struct.pack(f">{len(x)}f", *x)}.get(encoding, lambda: steim_body(x, encoding))()
    size = 9
    while (1 << size) < 64 + len(body):
        size += 1
    head = b"000001D " + station.ljust(5).encode() + b"  " + channel.encode() + b"NN" + struct.pack(">HHBBBBH", 2018, 227, hour, minute, second, 0, 5000) + struct.pack(">Hhh", len(x), rate, 1) + bytes([0, 0, 0, 1]) + struct.pack(">iHH", 0, 64, 48)
    return (head + struct.pack(">HHBBBB", 1000, 0, encoding, 1, size, 0) + bytes(8) + body).ljust(1 << size, b"\0")
