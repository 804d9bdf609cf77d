"""The operators against plain versions, on small tables with every awkward case."""

import base64
import hashlib
import json
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from courtview.llm import (benchmark_decontam, license_scan, line_dedup, mixing, quality_gam, secret_scan, sharding, simhash_dedup,  # noqa: E402
                           suffix_dedup, topk_search)


def by_id(df, *cols):
    return Counter((r["doc_id"], *[r[c] for c in cols]) for r in df.collect())


def test_line_dedup(spark, edge_docs, edge_rows, no_docs):
    lines = sorted({x for _, t, *_ in edge_rows if t for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")})
    short = [x for x in lines if len(x) < 400]

    def linked(i, j):
        a, b = short[i], short[j]
        limit = int(line_dedup.max_edits(min(len(a), len(b))))
        return abs(len(a) - len(b)) <= limit and brute.edit_distance(a, b) <= limit

    roots = brute.components(len(short), linked)
    cls = {x: f"c{r}" for x, r in zip(short, roots, strict=True)} | {x: x for x in lines if len(x) >= 400}
    seen, want = set(), []
    for doc_id, text, *_ in sorted(edge_rows, key=lambda r: (r[0] is None, r[0] or 0)):
        gone = []
        for n, x in enumerate((text or "").split("\n") if text else []):
            if x in cls:
                if cls[x] in seen:
                    gone.append(n)
                seen.add(cls[x])
        want.append((doc_id, len(text.split("\n")) if text else 0, tuple(gone)))
    rows = line_dedup.dedup_lines(edge_docs).collect()
    assert Counter((r.doc_id, r.n_lines, tuple(r.removed)) for r in rows) == Counter(want)
    named = defaultdict(set)
    texts = {d: t for d, t, *_ in edge_rows if d is not None}
    for r in rows:
        if r.doc_id is not None and texts[r.doc_id]:
            for x, c in zip(texts[r.doc_id].split("\n"), r.classes, strict=True):
                if x in cls:
                    named[cls[x]].add(c)
    assert all(len(v) == 1 for v in named.values()) and len({min(v) for v in named.values()}) == len(named)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    kept = spark.createDataFrame([("a\nb\nc", [1]), ("a", [])], "t string, r array<int>").select(line_dedup.keep_lines(F.col("t"), F.col("r")))
    assert [r[0] for r in kept.collect()] == ["a\nc", "a"]


def test_line_tiles_split_large_buckets(spark, monkeypatch):
    """A segment that many lines share: tiles of two lines each lose no class."""
    monkeypatch.setattr(line_dedup, "TILE", 2)
    head = "a common beginning of very many lines "
    docs = brute.tiny_docs(spark, [(i, head + "qwertyuiopas"[i % 12:] + "z" * 30 + "qwertyuiopas"[:i % 12], "en", "s", 0) for i in range(12)] +
                           [(50 + i, head + "m" * 40 + str(i), "en", "s", 0) for i in range(9)])
    rows = {r.doc_id: r.classes[0] for r in line_dedup.dedup_lines(docs, ((16, 1), (32, 2))).collect()}
    assert len({rows[50 + i] for i in range(9)}) == 1
    texts = {d: t for d, t, *_ in [(r.doc_id, r.text) for r in docs.collect()]}
    ids = sorted(texts)
    roots = brute.components(len(ids), lambda i, j: brute.edit_distance(texts[ids[i]], texts[ids[j]]) <= 2)
    assert all((rows[ids[i]] == rows[ids[j]]) == (roots[i] == roots[j]) for i in range(len(ids)) for j in range(i))


def test_line_links_are_all_counted(spark):
    """Clusters of mutually similar lines, of equal and of different lengths: every link counts, not only a forest."""
    rng = random.Random(11)
    heads = ["see the page number {} of the whole catalogue for more", "zzzzzzzzzzzzzzzzzzzzzzzz{}zzzzzzzzzzzzzzzzzzzzz", "a menu line {} here"]
    lines = sorted({h.format(x) for h in heads for x in [*range(0, 130, 3), "", "z", "zz", "zzz", "1z1"]} | {"".join(rng.choice("ab") for _ in range(rng.randrange(14, 18))) for _ in range(40)})
    linked = lambda a, b: abs(len(a) - len(b)) <= (m := int(line_dedup.max_edits(min(len(a), len(b))))) and brute.edit_distance(a, b) <= m
    want = {x: sum(x != y and linked(x, y) for y in lines) for x in lines}
    texts = [*lines, "\n".join(lines[:3]) + "\n\n" + lines[0], "\n", None]
    rows = line_dedup.dedup_lines(brute.tiny_docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
    assert max(want.values()) > 40
    for r in rows:
        mine = texts[r.doc_id].split("\n") if texts[r.doc_id] else []
        assert r.links == [want.get(x) for x in mine] and r.n_links == sum(want.get(x, 0) for x in mine)


def test_line_edits_that_grow_with_the_length(spark):
    """Steps of the caller: at a similarity of 0.95 a replaced word of a long line is a link, short lines keep few edits."""
    steps = line_dedup.similarity_steps(0.95, 12)
    assert steps[0] == (20, 1) and steps[-1] == (240, 12) and [int(line_dedup.max_edits(n, steps)) for n in (19, 20, 39, 40, 239, 240, 9000)] == [0, 1, 1, 2, 11, 12, 12]
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcde fgh") for _ in range(n)).replace("  ", " a") + "."
    lines = set()
    for n in (25, 60, 110, 180, 233, 260):
        base = noise(n)
        lines.add(base)
        for edits in (1, 2, 3, 5, 8, 11, 12, 13, 16):
            x = list(base)
            for _ in range(edits):
                at = rng.randrange(len(x))
                x[at:at + rng.randrange(2)] = rng.choice(["", "Q", "R", "S"])
            lines.add("".join(x))
        at = n // 2
        lines.add(base[:at] + "replaced" + base[at + 7:])
    lines = sorted(x for x in lines if x.strip())
    linked = lambda a, b: abs(len(a) - len(b)) <= (m := int(line_dedup.max_edits(min(len(a), len(b)), steps))) and brute.edit_distance(a, b) <= m
    want = {x: sum(x != y and linked(x, y) for y in lines) for x in lines}
    fixed = {x: sum(x != y and abs(len(x) - len(y)) <= 2 and brute.edit_distance(x, y) <= 2 for y in lines) for x in lines}
    assert sum(want.values()) > 2 * sum(fixed.values())
    rows = line_dedup.dedup_lines(brute.tiny_docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(lines)]), steps).collect()
    assert {lines[r.doc_id]: r.n_links for r in rows} == want
    roots = brute.components(len(lines), lambda i, j: linked(lines[i], lines[j]))
    cls = {r.doc_id: r.classes[0] for r in rows}
    assert all((cls[i] == cls[j]) == (roots[i] == roots[j]) for i in range(len(lines)) for j in range(i))
    for bad in (((10, 2), (20, 1)), ((2, 2),), ((16, 1), (16, 2))):
        with pytest.raises(ValueError):
            line_dedup.dedup_lines(brute.tiny_docs(spark, []), bad)


def test_line_entries_are_few_and_meet():
    """A line of 96 code points or more has about a dozen entries, the edits of few lines reach another bucket; two lines
    within the edits share the key of a segment of the shorter one, also where they fall into two buckets or steps."""
    rng = random.Random(3)

    def entries(lines, steps):
        out = defaultdict(set)
        batches = [pa.RecordBatch.from_pydict({"id": pa.array(range(len(lines)), pa.int64()), "line": lines})]
        for b in line_dedup._entries(steps)(iter(batches)):
            for key, entry in zip(b.column("key").to_pylist(), b.column("entry").to_pylist(), strict=True):
                out[entry >> 7 & (1 << line_dedup.ID_BITS) - 1, entry >> 62].add((key, entry & 127))
        return out

    noise = lambda n, of="abcdefgh ": "".join(rng.choice(of) for _ in range(n))
    many = entries([noise(n) for n in range(96, 600)], line_dedup.EDITS)
    assert 13 * 504 <= sum(map(len, many.values())) <= 18 * 504
    for steps in (line_dedup.EDITS, line_dedup.similarity_steps(0.9, 7), ((4, 3), (5, 4), (9, 5))):
        bounds, pairs = line_dedup._bounds(400, steps).tolist()[1:], []
        for n in [b + d for b in bounds for d in range(-3, 4) for _ in range(12) if b + d > 0]:
            a = noise(n, rng.choice(("ab", "abcdefgh ")))
            x, limit = list(a), int(line_dedup.max_edits(n, steps))
            for _ in range(limit):
                at = rng.choice((0, len(x) - 1, rng.randrange(len(x)))) if x else 0
                x[at:at + rng.randrange(2)] = rng.choice(("", "Q", "a"))
            a, b = sorted((a, "".join(x)), key=len)
            if len(b) - len(a) <= (m := int(line_dedup.max_edits(len(a), steps))) and m and a != b and brute.edit_distance(a, b) <= m:
                pairs += [a, b]
        found = entries(pairs, steps)
        assert len(pairs) > 300
        for i in range(0, len(pairs), 2):
            a, b, m = pairs[i], pairs[i + 1], int(line_dedup.max_edits(len(pairs[i]), steps))
            shared = {s for _, s in found[i, 0] & (found[i + 1, 0] | found[i + 1, 1])}
            width = line_dedup._bucket(np.array([len(a)]), steps)[0] // (m + 1)
            assert shared, (a, b)
            assert [line_dedup._shares_earlier(a, b, m, int(width), s) for s in range(m + 2)] == [s > min(shared) for s in range(m + 2)]


def test_mixing(spark, edge_docs, edge_rows, no_docs):
    sizes = defaultdict(int)
    for _, text, _, source, _ in edge_rows:
        sizes[source] += len(brute.WORD.findall(text or ""))
    want = brute.targets(dict(sizes))
    rows = mixing.mix_sources(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    taken, copies, rest = defaultdict(int), Counter((r.source, r.doc_id, r["size"]) for r in rows), defaultdict(list)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        rest[r.source].append((r.repeats, r["size"] * copies[r.source, r.doc_id, r["size"]]))
    for s in want:
        least = min(n for n, _ in rest[s])
        open_sizes = [size for n, size in rest[s] if n == least and size]
        assert abs(taken[s] - want[s]) <= max(0.001 * want[s], min(open_sizes, default=1))
    again = mixing.mix_sources(edge_docs).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)
    wide = mixing.repeat_rows(mixing.mix_sources(edge_docs, keep_columns=True))
    assert wide.columns == edge_docs.columns and Counter(r.doc_id for r in wide.collect()) == sum((Counter({r.doc_id: r.repeats}) for r in rows), Counter())
    assert mixing.mix_sources(no_docs).count() == 0


def test_mixing_passes_documents_that_do_not_fit(spark):
    """One document larger than what is wanted; sizes over four orders of magnitude; one document as many equal rows."""
    rnd = random.Random(8)
    groups = {"a": [50] * 200 + [20000], "b": [rnd.choice([3, 40, 500, 6000]) for _ in range(120)], "c": [9000, 2, 2, 1, 300, 40], "d": [7] * 90}
    rows = [(s, n) for s, sizes in groups.items() for n in sizes]
    docs = brute.tiny_docs(spark, [(0 if s == "d" else i, "w " * n, "en", s, 0) for i, (s, n) in enumerate(rows)])
    got = mixing.mix_sources(docs).collect()
    for s, sizes in groups.items():
        mine = [r for r in got if r.source == s]
        target, taken = mine[0].target, sum(r.taken for r in mine)
        least = int(target // sum(sizes))
        assert {r.repeats - least for r in mine} <= {0, 1}
        missing, left = target - taken, [r["size"] for r in mine if r.repeats == least]
        if s == "d":
            assert abs(missing) <= sum(sizes) / 2
        elif missing > 0.001 * target:
            assert all(abs(missing - n) >= missing for n in left)  # no document left comes nearer
        else:  # the last document at most is too much, by less than was missing without it
            assert -missing <= max((r["size"] for r in mine if r.repeats > least), default=0) / 2
        if s == "b":
            assert abs(missing) <= mixing.NEAR * target


def test_components_of_chains_hubs_and_rings(spark):
    from courtview.llm.components import connected_components
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, n) for n in range(1001, 1080)] + [(2000, n) for n in range(1050, 1060)]
    ring = [(-i, -(i % 30) - 1) for i in range(1, 31)]
    loose = [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(70)]
    links = chain + hub + ring + loose + [(7, 7), (8, 9), (9, 8)]
    parent = {n: n for pair in links for n in pair}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    wanted = {n: find(n) for n in parent if any(n in p and p[0] != p[1] for p in links)}
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(wanted) and {r["node"]: r["root"] for r in got} == wanted
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_water_filling_clamps_in_rounds(spark):
    sizes = {"a": 1000, "b": 1, "c": 10, "d": 100, "e": 0, None: 5}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(brute.targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_secret_scan(edge_docs, edge_rows, no_docs):
    want = Counter()
    for doc_id, text, *_ in edge_rows:
        base = brute.secrets(text)
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        want[(doc_id, *[sum(k == i for _, k, _ in base) for i in range(3)], hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert by_id(secret_scan.scan_secrets(edge_docs), "n_assign", "n_access", "n_hex", "base_sha256") == want
    assert secret_scan.scan_secrets(no_docs).count() == 0
    # a short match is dropped, not searched again
    assert secret_scan.base_spans("password:token:abcdefghijklmnop") == brute.secrets("password:token:abcdefghijklmnop") == []


def test_secret_structures():
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    der = b"\x30\x26\x02\x01\x00\x04\x21" + bytes(range(33))
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", bytes(range(32))))
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in secret_scan.confirmed_spans(t)]
    assert kinds(f"x {jwt} y") == ["jwt"] and kinds(f"x {jwt[1:]} y") == []
    assert kinds(f"MI {base64.b64encode(der).decode()} y") == ["der"] and kinds(der.hex()) == ["der"]
    assert kinds(base64.b64encode(der[:-1] + b"xx").decode()) == []
    assert kinds("ssh-ed25519 " + base64.b64encode(ssh).decode()) == ["sshkey"]


def test_secret_candidates_are_cut_where_the_key_ends():
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    body = b"\x02\x01\x00\x04\x81\xb5" + bytes(range(181))
    ders = [b"\x30\x81" + bytes([len(b)]) + b for b in (body, body + b"\x02\x01\x05", body + b"\x02\x02\x05\x06")]
    name = b"ssh-ed25519"
    ssh = base64.b64encode(b"".join(len(x).to_bytes(4, "big") + x for x in (name, bytes(range(32))))).decode()
    spans = lambda t: [(secret_scan.KINDS[k], t[a:b]) for a, k, b in secret_scan.confirmed_spans(t)]
    assert len(ssh) == 68 and spans(f"ssh-ed25519 {ssh}\nThen we go\non") == [("sshkey", ssh)]
    assert spans(f"ssh-ed25519 {ssh}\nssh-ed25519 {ssh}\n") == [("sshkey", ssh)] * 2
    for der in ders:
        flat = base64.b64encode(der).decode()
        lines = [flat[i:i + 64] for i in range(0, len(flat), 64)]
        for gap in ("\n", "\r\n", "\\n", "\\r\\n", "\n    ", " \n\t"):
            key = gap.join(lines)
            assert spans(f"-----BEGIN PRIVATE KEY-----{gap}{key}{gap}-----END") == [("der", key)]
        assert spans("\n".join(["A" * 64, *lines, "Then we go"])) == [("der", "\n".join(lines))]
    for before in ("my-token.", "A sentence.", "x.eyJhIjoxfQ.", ""):
        assert spans(f"{before}{jwt} y") == [("jwt", jwt)]


def test_secret_scan_does_not_stall_on_candidate_lines():
    """Thousands of lines that begin like keys: the work grows with the lines (thousands took hours before)."""
    import time
    head = base64.b64encode(b"openssh-key-v1\x00" + b"\x00\x00\x00\x04none" + b"\xff" * 21).decode()
    der = base64.b64encode(b"\x30\x82\xff\xff\x02\x01\x00" + bytes(range(41))).decode()
    ssh = base64.b64encode(b"\x00\x00\x00\x07ssh-rsa\x00\x00\x00\x03\x01\x00\x01\x00\x01\x00\x00" + bytes(26)).decode()
    for line in (head, der, ssh):
        began = time.process_time()
        assert len(line) >= 40 and secret_scan.confirmed_spans("\n".join([line] * 4000)) == []
        assert time.process_time() - began < 1, line


def test_private_key_ends_by_its_own_lengths():
    field = lambda x: len(x).to_bytes(4, "big") + x
    public = field(field(b"ssh-ed25519") + field(bytes(32)))
    raw = b"openssh-key-v1\x00" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + public + field(bytes(range(137)))
    flat = base64.b64encode(raw).decode()
    lines = [flat[i:i + 70] for i in range(0, len(flat), 70)]
    spans = lambda t: [(secret_scan.KINDS[k], t[a:b]) for a, k, b in secret_scan.confirmed_spans(t)]
    key = "\n".join(lines)
    assert spans(f"-----BEGIN OPENSSH PRIVATE KEY-----\n{key}\n-----END") == [("sshkey", key)]
    whole = key.rstrip("=")
    if whole == key:
        assert spans(f"{key}\nThen we go on\n{key}\n") == [("sshkey", key)] * 2
    cut = "\n".join(lines[:-1])  # cut short: to the last line
    assert spans(cut) == [("sshkey", cut)]


def test_line_dedup_of_a_text_with_many_lines(spark):
    lines = [hashlib.md5(str(i).encode()).hexdigest() if i % 7 else "" for i in range(40_000)]
    rows = line_dedup.dedup_lines(brute.tiny_docs(spark, [(1, "\n".join(lines), "en", "a", 0), (2, f"{lines[3]}\n\nnew", "en", "a", 0)])).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_lines == 40_000 == len(by[1].classes) == len(by[1].links)
    assert all((c is None) == (i % 7 == 0) for i, c in enumerate(by[1].classes))
    assert by[2].removed == [0] and by[2].classes[1] is None


def test_topk(spark):
    vectors = [(i, [float((i * 7 + j * 3) % 11 - 5) / 3 for j in range(8)]) for i in range(0, 260)]
    vectors += [(50, vectors[50][1]), (7, [float("nan")] * 8), (100, None), (None, [1.0] * 8), (8, [1.0, None] * 4), (150, [0.5] * 3), (9, [0.25] * 3), (200, []), (300, [1e300] * 8),
                (301, [1e17] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, block int").repartition(3)
    got = sorted(tuple(r) for r in topk_search.exact_top_k(df, shard_rows=32, query_rows=3, fan_in=3).collect())
    most = (1 << 63) - 1
    want = [(q, r, v, max(-most - 1, min(most, s))) for q, r, v, s in brute.top_k(vectors)]
    assert [x for x in got if abs(x[3]) < most] == [x for x in want if abs(x[3]) < most] and len(got) == len(want)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk_search.exact_top_k(empty).count() == 0


def test_license_scan(spark, edge_docs, edge_rows, no_docs):
    names = license_scan.TEMPLATES
    mixed = " ".join(f"filler{i}" for i in range(40))
    texts = [None, "", "one"] + [f"{mixed} {t} {mixed}" for t in names.values()] + [names["MIT"].replace("charge", "fees"), mixed + names["BSD"][:60], " ".join([mixed, *names.values()] * 3)]
    docs = brute.tiny_docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    scanner = license_scan.Scanner(names, license_scan.WIDTH, license_scan.THRESHOLD, license_scan.BANDS)
    rows = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        plain = scanner.scan(t, plain=True)
        assert rows[i].licenses == ",".join(sorted({n for n, *_ in plain})) and rows[i].n_matches == len(plain)
    for i, name in enumerate(names, start=3):
        assert name in rows[i].licenses.split(",")
    assert license_scan.scan_licenses(edge_docs).count() == len(edge_rows) and license_scan.scan_licenses(no_docs).count() == 0


def test_license_notices_in_other_words(spark):
    """Each text is resolved as a reader would, and independently of the scanner: by whole words, in order."""
    texts = {"Licensed under the MIT license.": "MIT", "Distributed under the MIT License.": "MIT", "Licensed under CC BY 4.0.": "CC-BY-4.0",
             "                Apache License\n      Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n  TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION": "Apache-2.0",
             "GNU LESSER GENERAL PUBLIC LICENSE\n  Version 2.1, February 1999": "LGPL-2.1", "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991": "GPL-2.0",
             "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", "available under the terms of the GPLv3": "GPL-3.0", "Released under the Apache License, Version 2.0": "Apache-2.0",
             "under no license at all, MIT or other": "", "Licensed premises under the bridge": ""}
    fill = " ".join(f"filler{i}" for i in range(60))
    docs = brute.tiny_docs(spark, [(i, f"{fill} {t} {fill}", "en", "s", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: r.license_ids for r in license_scan.scan_licenses(docs).collect()}
    assert got == dict(enumerate(texts.values()))
    words = lambda t: f" {' '.join(license_scan._WORD.findall(t.lower()))} "
    for i, (text, want) in enumerate(texts.items()):  # templates contained word for word, without shingles or bands
        whole = {license_scan._KIND.split(n)[0] for n, t in license_scan.TEMPLATES.items() if words(t) in words(text)}
        assert whole <= set(got[i].split(",")) and want in (whole or {""})


def test_suffix_dedup(edge_docs, edge_rows, no_docs):
    for length in (120, 400):
        want = Counter((r[0], *w) for r, w in zip(edge_rows, brute.repeats([t[:20000] if t else t for _, t, *_ in edge_rows], length), strict=True))
        got = by_id(suffix_dedup.remove_repeats(edge_docs.withColumn("text", F.substring("text", 1, 20000)), length), "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == want
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_dedup_over_pieces(edge_docs, edge_rows, monkeypatch):
    """Pieces far shorter than the texts give the same spans."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 1500)
    want = Counter((r[0], *w) for r, w in zip(edge_rows, brute.repeats([t[:20000] if t else t for _, t, *_ in edge_rows], 130), strict=True))
    got = by_id(suffix_dedup.remove_repeats(edge_docs.withColumn("text", F.substring("text", 1, 20000)), 130), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == want


def test_suffix_dedup_keeps_unique_bytes_at_a_piece_boundary(spark):
    """A passage of under ``length`` bytes across the boundary also stands elsewhere: no string of ``length`` bytes recurs."""
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows = []
    for i, size in enumerate((399, 399, 300)):
        passage = noise(size)
        rows += [(2 * i, noise(suffix_dedup.PIECE) + passage + noise(2000), "en", "s", 0), (2 * i + 1, noise(1000) + passage + noise(1000), "en", "s", 0)]
    got = suffix_dedup.remove_repeats(brute.tiny_docs(spark, rows)).collect()
    assert {(r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(i, 0, 0, hashlib.sha256(t.encode()).hexdigest()) for i, t, *_ in rows}


def test_sharding(edge_docs, edge_rows, no_docs):
    rows = sharding.hilbert_shards(edge_docs).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(edge_rows) and set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((d, len((t or "").encode()) + 1) for d, t, *_ in edge_rows)
    assert sharding.hilbert_shards(no_docs).count() == 0


def test_hilbert_curve_steps_to_neighbours(spark):
    bits = 3
    grid = spark.range(8).withColumnRenamed("id", "x").crossJoin(spark.range(8).withColumnRenamed("id", "y")).crossJoin(spark.range(8).withColumnRenamed("id", "z"))
    path = grid.select("x", "y", "z", sharding.hilbert_index([F.col(c) for c in "xyz"], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in path] == list(range(512))
    assert all(sum(abs(a[i] - b[i]) for i in range(3)) == 1 for a, b in zip(path[:-1], path[1:], strict=True))


def test_decontamination(spark, edge_docs, edge_rows, no_docs):
    question = "In 1999 Maria Lopez paid 30 dollars for 12 apples and then sold the same 12 apples for 45 dollars to her neighbour"
    changed = "In 2004 John Smith paid 31 dollars for 15 apples and then sold the same 15 apples for 46 dollars to her neighbour"
    broken = changed.replace("same 15", "same 16")
    bench = spark.createDataFrame([(1, question), (2, question), (3, None), (4, ""), (5, "one two three"), (6, "The quick survey of seven rivers shows that every bridge older than "
                                   "forty years needs repair before winter comes again.")], "item_id long, text string")
    extra = brute.tiny_docs(spark, [(200, f"Intro text. {question}. More text.", "", "", 0), (201, f"Intro text. {changed}. More text.", "", "", 0),
                                    (202, f"Intro text. {broken}. More text.", "", "", 0), (203, "we count one two three here", "", "", 0)])
    docs = edge_docs.select(*extra.columns).unionByName(extra)
    got = {(r.doc_id, r.item_id): r.reparameterised for r in benchmark_decontam.contaminated(docs, bench).collect()}
    want = {(d, 6): False for d, t, *_ in edge_rows if t and "seven rivers" in t}
    want |= {(200, 1): False, (200, 2): False, (201, 1): True, (201, 2): True, (203, 5): False}
    assert got == want
    kept = benchmark_decontam.clean_documents(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}
    assert benchmark_decontam.contaminated(no_docs, bench).count() == 0
    assert benchmark_decontam.contaminated(docs, bench.limit(0)).count() == 0


def _found(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = brute.tiny_docs(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    return {(r.doc_id, r.item_id) for r in benchmark_decontam.contaminated(docs, bench).collect()}


def test_decontamination_of_items_that_are_mostly_slots(spark):
    """Verbatim copies of items of figures and names are found; a few common words do not stand for the whole item."""
    items = ["What is 48 + 127 * 6 - 35?", "Who wrote Hamlet?", "Alice Bob 3 7 Carol 9 Dave 11 Erin", "the cat sat on 5 7 11 13 17 19 23 29 31"]
    texts = [f"Some words before. {x} Some words after." for x in items] + ["What is 49 + 127 * 6 - 35?", "Nobody knows: the cat sat on 8 chairs.", "Who wrote the letter?"]
    assert _found(spark, items, texts) == {(i, i) for i in range(len(items))}


def test_decontamination_in_any_context_and_letter_case(spark):
    items = ["What is the capital of France?", "Who led the first crossing of Lake Victoria with Ann Miller in 1871?"]
    texts = [f"{before}{x}" for x in items for before in ("Question: ", 'He asked "', "see (", "and ")] + [x.lower() for x in items] + [x.upper() for x in items]
    assert _found(spark, items, texts) == {(i, i // 4) for i in range(8)} | {(8, 0), (9, 1), (10, 0), (11, 1)}


def test_decontamination_adds_up_windows_of_one_stretch_only(spark):
    item = "the old mill by the river was sold to a young baker who wanted to grind her own flour there again"
    words = item.split()
    filler = lambda a, n=40: " ".join(f"filler{a}x{i}" for i in range(n))
    scattered = " ".join(f"{filler(i)} {' '.join(words[i:i + 5])}" for i in reversed(range(len(words) - 4)))
    halves = f"{filler(1)} {' '.join(words[:11])} {filler(2, 400)} {' '.join(words[7:])} {filler(3)}"
    inserted = f"{filler(1)} {' '.join(words[:13])} that is to say {' '.join(words[9:])} {filler(2)}"  # four words again, and four new ones
    often = " ".join(f"{filler(i)} {item}" for i in range(50))
    assert _found(spark, [item, "Paris"], [scattered, halves, inserted, often, "He lives in Paris now."]) == {(2, 0), (3, 0), (4, 1)}


def test_decontamination_keeps_documents_with_a_one_word_item_and_reports_null_ids(spark):
    bench = spark.createDataFrame([(0, "Paris"), (1, "Who wrote Hamlet?")], "item_id long, text string")
    docs = brute.tiny_docs(spark, [(1, "He lives in Paris now.", "en", "s", 0), (2, "Then: who wrote Hamlet?", "en", "s", 0), (None, "Who wrote Hamlet? Paris.", "en", "s", 0)])
    found = {(r.doc_id, r.item_id) for r in benchmark_decontam.contaminated(docs, bench).collect()}
    assert found == {(1, 0), (2, 1), (None, 0), (None, 1)}
    assert [r.doc_id for r in benchmark_decontam.clean_documents(docs, bench).collect()] == [1]


def test_decontamination_equals_the_plain_version(spark):
    """Random texts over few words, with items in them whole, shifted, shortened, with other figures and cut in pieces."""
    import random
    rnd = random.Random(11)
    vocabulary = "river stone bridge Anna Peter Lake paid sold 12 30 kg miles for the and of to London 7 old".split()
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [some(n) for n in (1, 2, 4, 5, 6, 9, 14, 20, 30)]
    texts = ["", None]
    for item in items:
        w = item.split()
        cut = rnd.randrange(len(w))
        texts += [f"{some(20)}. {item} {some(20)}", f"{some(9)} {' '.join(w[:cut])} {some(3)} {' '.join(w[cut:])} {some(9)}", f"{some(9)} {' '.join(w[:cut])} {some(60)} {' '.join(w[cut:])}",
                  " ".join("99" if x in ("12", "30", "7") else x for x in w), " ".join("Otto" if x in ("Anna", "Peter") else x for x in w), item.upper(), some(200)]
    assert _found(spark, items, texts) == brute.contaminated(texts, items)


def test_simhash(edge_docs, edge_rows, no_docs):
    prints = [brute.fingerprint(t[:30000] if t else t) for _, t, *_ in edge_rows]
    roots = brute.components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    first = {}
    for (doc_id, *_), r in zip(edge_rows, roots, strict=True):
        first[r] = min((x for x in (first.get(r), doc_id) if x is not None), default=None)
    want = Counter((row[0], f"{p:016x}", first[r]) for row, p, r in zip(edge_rows, prints, roots, strict=True))
    cut = edge_docs.withColumn("text", F.substring("text", 1, 30000))
    for limit in (simhash_dedup.BUCKET_LIMIT, 1):  # 1: every bucket takes the way of crowded ones
        found = simhash_dedup.simhash_components(cut, bucket_limit=limit).withColumn("fingerprint", simhash_dedup.hex_fingerprint(F.col("fp")))
        assert by_id(found, "fingerprint", "component_id") == want
    kept = simhash_dedup.keep_one(cut)
    assert kept.columns == cut.columns and Counter(r.doc_id for r in kept.collect()) == Counter(first.values())
    assert simhash_dedup.simhash_components(no_docs).count() == 0 and simhash_dedup.keep_one(no_docs).count() == 0


def test_simhash_pairs_near_every_distance(spark):
    """Random fingerprints with planted neighbours at one to three bits, both ways of search."""
    import random
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:
        for bits in (1, 2, 3):
            x = b
            for i in rnd.sample(range(64), bits):
                x ^= 1 << i
            fps.add(x)
    fps = sorted(fps)
    roots = brute.components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    df = spark.createDataFrame([(simhash_dedup._signed(x),) for x in fps], "fp long")
    for limit in (1024, 1):
        got = {r.fp: r.root for r in simhash_dedup.component_roots(df, 2, limit).collect()}
        same = [got[simhash_dedup._signed(x)] for x in fps]
        assert all((same[i] == same[j]) == (roots[i] == roots[j]) for i in range(len(fps)) for j in range(i))


def test_quality(spark, edge_docs, edge_rows, no_docs):
    words = ["tree", "river", "stone", "cloud", "grass", "light", "winter", "summer"]
    good = [(i, " ".join(words[(i * 3 + j) % 8] for j in range(20 + i % 30)) + ".", "en", "s", 0) for i in range(300)]
    bad = [(1000 + i, " ".join(words[(i * 5 + j) % 8] + "###" for j in range(20 + i % 30)), "en", "s", 0) for i in range(100)]
    docs = brute.tiny_docs(spark, good + bad)
    labels = spark.createDataFrame([(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad] + [(None, 1, 0), (3, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_gam.classify_quality(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 170 and sum((r.predicted == 1) == (r.doc_id < 1000) for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    none = quality_gam.classify_quality(edge_docs, labels.limit(0)).collect()
    assert len(none) == len(edge_rows) and {r.score for r in none} == {0.5}
    assert quality_gam.classify_quality(no_docs, labels).count() == 0


def test_pair_tables_learn_an_interaction():
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs and ((model.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
