"""Documents with everything that can go wrong in them, and brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, _row string, "
    "_fp string, at long, `a.b` string, fingerprint int, kept boolean, tags map<string,string>"
)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    words = ["Alpha", "beta,", "gamma", "Δelta", "été", "zeta.", "eta", "theta", "iota", "kappa"]

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))

    passage, near = prose(70), prose(120)
    texts = [
        None, "", " \n\t ", "word", "x" * 700, "a b " * 90, prose(80), prose(60) + "\n" + passage, passage + " " + prose(75),
        near, near + " end", near.replace("eta", "Eta", 1), prose(9000), "!!! ???", "α β γ δ " * 30, "line one\nline one\n" * 30,
        "Released under the MIT License.\n" + prose(55), "\x00\x1c a b c", "  lead and  trail  ",
    ]
    rows = []
    for k, text in enumerate(texts):
        i = None if k == 4 else k * 3 - 6
        lang, source = (None if k % 5 == 0 else ("en", "fr")[k % 2]), (None if k % 7 == 3 else f"s{k % 3}")
        rows.append((i, text, lang, source, k, 1, "r", "f", 7, "dot", 2, True, {"k": "v"}))
    rows += rows[6:9]  # repeated rows
    rows.append((12, prose(65), "en", "s0", 1, 1, "r", "f", 7, "dot", 2, None, None))  # an id with two texts
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def cut(rows: list[tuple], length: int) -> list[tuple[bytes, bytes, bytearray]]:
    """(bytes, kept bytes, mask) of rows (doc_id, text) in order; ids are unique."""
    seen, result = set(), []
    for _, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for start in range(len(data) - length + 1):
            string = data[start:start + length]
            if string in seen:
                mask[start:start + length] = b"\x01" * length
            seen.add(string)
        result.append((data, bytes(b for b, m in zip(data, mask) if not m), mask))
    return result


def substrings(rows: list[tuple], length: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256)."""
    return [
        (row[0], len(data), sum(mask), sum(mask[k] and (k == 0 or not mask[k - 1]) for k in range(len(mask))),
         hashlib.sha256(kept).hexdigest())
        for row, (data, kept, mask) in zip(rows, cut(rows, length))
    ]


def remaining(rows: list[tuple], length: int) -> list[bytes]:
    return [kept for _, kept, _ in cut(rows, length)]


def passing(rows: list[tuple]) -> list[bool]:
    """Whether each (text, host) passes the base rules and its host's shrunk failure rate."""
    failed = []
    for text, _ in rows:
        words = WORDS.findall(text or "")
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        covered = {k + n for k, w in enumerate(windows) if counts[w] > 1 for n in range(3)}
        failed.append(len(words) < 50 or 100 * len(covered) > 50 * len(words))
    n, bad = Counter(host for _, host in rows), Counter(host for (_, host), f in zip(rows, failed) if f)
    rates = [bad[h] / n[h] for h in n]
    mean = sum(rates) / len(rates)
    spread = sum((r - mean) ** 2 for r in rates) / len(rates)
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
    rejected = {h for h in n if (bad[h] + mean * weight) / (n[h] + weight) > 0.5}
    return [not f and host not in rejected for (_, host), f in zip(rows, failed)]


def taken(rows: list[tuple]) -> list[int]:
    """How often the mix takes each (doc_id, text, source); ids are unique."""
    sizes = [len(WORDS.findall(text or "")) for _, text, _ in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    whole = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, full = 1.5 * sum(whole.values()), set()
    while True:  # the excess goes to the others by weight until none is above
        level = (total - 2 * sum(whole[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and level * weight[s] > 2 * whole[s]}
        if not above:
            break
        full |= above
    result = [0] * len(rows)
    for s in names:
        target = 2.0 * whole[s] if s in full else level * weight[s]
        rate = target / whole[s] if whole[s] else 0.0
        name = "no source" if s is None else f"source {s}"
        offset = int(hashlib.md5(name.encode()).hexdigest()[:4], 16) / 65536
        mine = sorted((n, r[0], k) for k, (n, r) in enumerate(zip(sizes, rows)) if r[2] == s)
        for place, (_, _, k) in enumerate(mine):
            result[k] = math.floor(offset + (place + 1) * rate) - math.floor(offset + place * rate)
    return result


def simhash(text: str | None, size: int = 3) -> int:
    from xxhash import xxh64_intdigest

    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxh64_intdigest(" ".join(words[k:k + size]).encode(), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: list[int], radius: int) -> list[int]:
    """The smallest index that each print is connected to."""
    root = list(range(len(prints)))

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def chunked(rows: list[tuple], gears: list[int], least_run: int, zero_bits: int = 5, least: int = 24, most: int = 256) -> list[tuple]:
    """(doc_id, n_removed, n_spans, sha256) of rows (doc_id, text) in order, the hash rolled byte by byte."""
    seen, result = set(), []
    for doc_id, text in rows:
        data, ends, start, h, hashes = (text or "").encode(), [], 0, 0, []
        for byte in data:
            h = ((h << 1) + gears[byte]) & 0xFFFFFFFF
            hashes.append(h)
        allowed = [k + 1 for k, h in enumerate(hashes) if h >> (32 - zero_bits) == 0]
        for end in [*allowed, len(data)]:
            while end - start > most:  # the greatest value where none allows an end
                window = range(start + least - 1, start + most)
                start = max(window, key=lambda k: (hashes[k], -k)) + 1
                ends.append(start)
            if end - start >= least or end == len(data) > start:
                ends.append(end)
                start = end
        spans = []
        for a, b in zip([0, *ends[:-1]], ends):
            if data[a:b] in seen:
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            seen.add(data[a:b])
        lines = [0, *(k + 1 for k, byte in enumerate(data) if byte == 10)]
        ends_of_lines = {len(data), *lines, *(k - 1 for k in lines)}
        gone = [(a, b) for a, b in spans if b - a >= least_run or a in lines and b in ends_of_lines]
        kept, at = b"", 0
        for a, b in gone:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        result.append((doc_id, len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
    return result
