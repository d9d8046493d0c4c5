"""Plain Python versions of the operators, straight from their contracts."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def sha(spans: list[tuple]) -> tuple[str, str]:
    text = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))
    return text, hashlib.sha256(text.encode()).hexdigest()


def pii_base(text: str | None) -> list[tuple]:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def secret_base(text: str | None) -> list[tuple]:
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes: list, links: list[tuple]) -> dict:
    """The least node that each node reaches."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash(rows: list[tuple]) -> dict:
    """doc_id -> (fingerprint, component) of (doc_id, text)."""
    fps = {d: fingerprint(t) for d, t in rows}
    ids, values = list(fps), np.array(list(fps.values()), np.uint64)
    links = []
    for i in range(len(ids)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2)
        links += [(ids[i], ids[j]) for j in near if j != i]
    found = components(ids, links)
    return {d: (f"{fps[d]:016x}", found[d]) for d in ids}
