"""Plain single-machine versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, linked):
    """Smallest index reachable from each of n nodes."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            w = r[i:i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def secrets(text):
    """Base spans as (start, kind, end), by the contract's patterns."""
    text = text or ""
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 18:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m.group()) >= 16:
            out.append((m.start(), 2, m.end()))
    return sorted(out)


def top_k(vectors, every=50, k=5, scale=256):
    """(query_id, rank, vec_id, score) rows, sorted."""
    rows = []
    for vid, v in vectors:
        if vid is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        rows.append((vid, [math.floor(scale * x) for x in v]))
    out = []
    for i, (qid, q) in enumerate(rows):
        if qid % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), vid) for j, (vid, v) in enumerate(rows) if j != i and len(v) == len(q))
        out += [(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(found[:k])]
    return sorted(out)


def targets(sizes, max_epochs=3):
    """Target words of each source (dict), by clamping and resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > max_epochs * sizes[s]] if w else []
        if not over:
            return {s: fixed[s] if s in fixed else left * weight[s] / w for s in names}
        fixed.update({s: float(max_epochs * sizes[s]) for s in over})


UNITS = set("""mm cm m km in inch inches ft feet yd yards mile miles mg g kg lb lbs oz ton tons ml l litre litres liter liters gallon
gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years kb mb gb tb hz khz mhz ghz v w kw j kj
cal kcal pa kpa mph kmh percent degrees dollars euros pounds cents""".split())


def canonical(text):
    """([(placeholder or word, slot value or None, first plain token)], [plain token])."""
    out, plain, last = [], [], "end"
    for t in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[.!?\n%$€£°]", text or ""):
        low, was = t.lower(), last
        if t in ".!?\n":
            last = "end"
            continue
        last = "number" if t[0].isdigit() else "unit" if t in "%$€£°" or low in UNITS else "name" if len(t) > 1 and t[0].isupper() and t[1:] == t[1:].lower() else "word"
        kind = "word" if last == "name" and was == "end" or last == "unit" and was != "number" else last
        if kind == "name" and out and out[-1][0] == "<name>":
            out[-1] = ("<name>", out[-1][1] + " " + low, out[-1][2])
        else:
            out.append((low, None, len(plain)) if kind == "word" else (f"<{kind}>", low, len(plain)))
        plain.append(low)
    return out, plain


def contaminated(texts, items, width=5, min_words=3, threshold=0.8):
    """{(text number, item number)}: every window against every window, diagonals by their origins."""
    def told(tokens, p, size):
        return sum(v is None for _, v, _ in tokens[p:p + size]) >= min(min_words, size)

    def ids(tokens, p, size):
        return tuple(t[0] for t in tokens[p:p + size])

    sizes = {j: min(width, len(canonical(item)[0])) for j, item in enumerate(items)}
    known = {(sizes[j], ids(canonical(item)[0], a, sizes[j])) for j, item in enumerate(items) for a in range(len(canonical(item)[0]) - sizes[j] + 1)}

    def backed(tokens, size):
        """Positions of known windows in a run of known windows with a telling one."""
        hits = [p for p in range(len(tokens) - size + 1) if (size, ids(tokens, p, size)) in known]
        runs = []
        for p in hits:
            if runs and runs[-1][-1] == p - 1:
                runs[-1].append(p)
            else:
                runs.append([p])
        return {p for run in runs if any(told(tokens, p, size) for p in run) for p in run}

    found = set()
    for j, item in enumerate(items):
        tokens, plain = canonical(item)
        if not plain:
            continue
        size, raw = min(width, len(tokens)), min(width, len(plain))
        total, ends = len(plain) - raw + 1, [t[2] for t in tokens] + [len(plain)]
        for i, text in enumerate(texts):
            there, words = canonical(text)
            lines = {}
            for p in range(len(words) - raw + 1):
                for a in range(total):
                    if words[p:p + raw] == plain[a:a + raw]:
                        lines.setdefault(("plain", p - a), []).append((a, a, p, True, []))
            for p in backed(there, size):
                for a in range(len(tokens) - size + 1):
                    if ids(there, p, size) == ids(tokens, a, size):
                        slots = [(x[1], y[1]) for x, y in zip(tokens[a:a + size], there[p:p + size], strict=True) if x[1] is not None]
                        lines.setdefault(("slots", p - a), []).append((ends[a], ends[a + size] - raw, there[p][2], told(tokens, a, size), slots))
            kept = []
            for met in lines.values():
                pairs = {s for m in met for s in m[4]}
                if any(m[3] for m in met) and len(pairs) == len({s for s, _ in pairs}):
                    kept.append((min(m[2] - m[0] for m in met), {n for m in met for n in range(m[0], m[1] + 1)}))
            stretch = max(width, -(-len(plain) // 2))
            if any(len(set().union(*[n for o, n in kept if begin <= o <= begin + stretch])) / total >= threshold for begin, _ in kept):
                found.add((i, j))
    return found


def tiny_docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)
