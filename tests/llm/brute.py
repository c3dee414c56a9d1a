"""Plain versions of the operators, one text or one table at a time."""

from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text):
    words = WORD.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable for each (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
            parent[root(i)] = root(j)
    least = {}
    for i, (one, _) in enumerate(prints):
        if one is not None:
            least[root(i)] = min(one, least.get(root(i), one))
    return [least.get(root(i)) for i in range(len(prints))]


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed)


def kept_lines(docs):
    """(id, lines, dropped, kept text) per (id, text) row."""
    keys = {}
    for one, text in docs:
        for line in (text or "").split("\n"):
            key = low(line.strip(SPACE))
            if len(key) >= 20:
                keys.setdefault(key, set()).add(one)
    out = []
    for one, text in docs:
        lines = (text or "").split("\n")
        stay = [li for li in lines if not (len(holders := keys.get(low(li.strip(SPACE)), ())) >= 3 and max(holders) != one)]
        out.append((one, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def feistel(left, lefts, right, rights, key, tweak):
    def mix(value, turn, bound):
        return int(hashlib.sha256(f"{key}|{tweak}|{turn}|{value}".encode()).hexdigest()[:15], 16) % bound

    for turn in range(10):
        if turn % 2 == 0:
            left = (left + mix(right, turn, lefts)) % lefts
        else:
            right = (right + mix(left, turn, rights)) % rights
    return left, right


def moved_day(day: dt.date, key):
    n = (day - dt.date(1900, 1, 1)).days
    left, right = feistel(n // 4297, 17, n % 4297, 4297, key, "date")
    return dt.date(1900, 1, 1) + dt.timedelta(days=left * 4297 + right)


def moved_card(digits, key):
    payload = digits[:-1]
    half = len(payload) // 2
    left, right = feistel(int(payload[:half]), 10 ** half, int(payload[half:]), 10 ** (len(payload) - half), key, "card")
    moved = str(left).zfill(half) + str(right).zfill(len(payload) - half)
    return next(moved + c for c in "0123456789" if luhn(moved + c))


def moved_ip(text, key):
    a, b, c, d = map(int, text.split("."))
    left, right = feistel(a * 256 + b, 65536, c * 256 + d, 65536, key, "ip")
    return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"


def common_length(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(best[j] + 1 if x == y else max(best[j + 1], row[-1]))
        best = row
    return best[-1]


def held_items(docs, items):
    """(document, item) of all that are held: every stretch with enough words of a passage is compared."""
    found = set()
    passages = [decontaminate.Passage(*p) for item in items for p in decontaminate.passages(*item)]
    passages += [p.context for p in passages if p.context]
    for one, text in docs:
        words = decontaminate.words_of(text)
        for p in passages:
            if (one, p.item_id) in found:
                continue
            # A common subsequence is no longer than the passage's words that occur in the stretch.
            for start in range(0, max(1, len(words) - 32), 32):
                near = set(words[max(0, start - p.size):start + 64 + p.size])
                if sum(m.bit_count() for w, m in p.masks.items() if w in near) >= 0.5 * p.size and p.holds(*p.compare(words, start, start + 64)):
                    found.add((one, p.item_id))
                    break
    return found


def distrust(links, seeds, damping, iterations):
    """Scores against (src, dst, n): a source takes the share of its links that lead to what is distrusted."""
    out = Counter()
    for src, _, n in links:
        out[src] += n
    base = {s: 1 - damping for s in seeds}
    scores = dict(base)
    for _ in range(iterations):
        new = Counter(base)
        for src, dst, n in links:
            new[src] += damping * scores.get(dst, 0) * n / out[src]
        scores = dict(new)
    return scores


def page_rank(links, seeds, damping, iterations):
    """Scores along (src, dst, n), each seed starting with 1 - damping."""
    out = Counter()
    for src, _, n in links:
        out[src] += n
    base = {s: 1 - damping for s in seeds}
    scores = dict(base)
    for _ in range(iterations):
        new = dict(base)
        for src, dst, n in links:
            if src in scores:
                new[dst] = new.get(dst, 0) + damping * scores[src] * n / out[src]
        scores = new
    return scores


def trie(rows):
    """Nodes of the trie of rebuilt conversations; rows are (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, key, role, text))
    said = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    paths = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = said.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids, leaves, saved = Counter(node[:-1] for node in members if node), Counter(), Counter()
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((found[0], len(node), members[node[:-1]][0] if node else None, len(found), kids[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in found if len(paths[c]) == len(node)).encode()).hexdigest())
                  for node, found in members.items())


def without_passages(docs, n):
    """(id, words, words removed, text left) of each document."""
    place = lambda one: (one is not None, one or 0)
    words = [WORD.findall(text or "") for _, text in docs]
    first = {}
    for (one, _), found in zip(docs, words):
        for i in range(len(found) - n + 1):
            key = tuple(found[i:i + n])
            first[key] = min(first.get(key, (place(one), i)), (place(one), i))
    out = []
    for (one, text), found in zip(docs, words):
        gone = set()
        for i in range(len(found) - n + 1):
            if first[tuple(found[i:i + n])] < (place(one), i):
                gone.update(range(i, i + n))
        left = " ".join(w for i, w in enumerate(found) if i not in gone) if gone else text
        out.append((one, len(found), len(gone), left))
    return out


def vector_codes(rows, n_parts, n_entries, rounds=2, scale=256):
    """(id, code, error, error of the label, digest of the codebooks) of each kept row."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in kept) // n_parts)
    whole = [[math.floor(Fraction(x) * scale) for x in r[1]] + [0] * (width * n_parts - len(r[1])) for r in kept]
    parts = [[v[p * width:(p + 1) * width] for v in whole] for p in range(n_parts)]
    books = [found[:n_entries] for found in parts]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            used = defaultdict(list)
            for part in parts[p]:
                used[nearest(part, book)[1]].append(part)
            books[p] = [[sum(v) // len(v) for v in zip(*used[i])] if used[i] else entry for i, entry in enumerate(book)]
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    found = [[nearest(parts[p][i], books[p]) for p in range(n_parts)] for i in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    errors = [e if e < 2**63 else None for e in errors]
    by_label = defaultdict(list)
    for r, e in zip(kept, errors):
        by_label[r[2]].append(e)
    total = {k: None if None in v or sum(v) >= 2**63 else sum(v) for k, v in by_label.items()}
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in f), error, total[r[2]], digest) for r, f, error in zip(kept, found, errors)), key=str)
